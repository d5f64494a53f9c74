from __future__ import annotations

import importlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from triangulum.llm import mixing, quality

from .texts import odd_documents

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_on_labels(spark, labels):
    scored = quality.score(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = scored.join(labels, "doc_id").collect()
    good = [r["keep"] for r in rows if r["quality"] == 1]
    bad = [r["keep"] for r in rows if r["quality"] == 0]
    assert scored.count() == 1000
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.3


def test_expectation_maximisation():
    """Votes drawn from known accuracies: the estimates come back."""
    draw, counts, rates = random.Random(1), {}, (0.95, 0.85, 0.75, 0.9)
    for _ in range(20_000):
        bad = draw.random() < 0.3
        pattern = "".join(
            "0" if draw.random() < 0.2 else str(2 if bad == (draw.random() < rate) else 1) for rate in rates
        )
        counts[pattern] = counts.get(pattern, 0) + 1
    found = quality.estimate(counts)
    assert found.prior == pytest.approx(0.3, abs=0.02)
    for k, rate in enumerate(rates):
        assert found.rates[k, 1, 2] / found.rates[k, 1, 1:].sum() == pytest.approx(rate, abs=0.03)
    assert found.posterior("2222") > 0.95 > 0.05 > found.posterior("1111")


def test_quality_of_odd_documents(spark):
    docs = odd_documents(spark)
    assert quality.score(docs).count() == 17
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {1, 2} <= ids
    assert quality.score(odd_documents(spark, empty=True)).count() == 0


def projected(tokens, p, targets, weights):
    """Exact minimum on a small case, by very many small projected steps."""
    r = np.ones(len(tokens))
    for _ in range(200_000):
        g = p @ (weights * ((p * tokens[:, None] * r[:, None]).sum(axis=0) - targets))
        r = np.maximum(0, r - 1e-3 * g * targets.sum() / tokens.sum())
    return ((p * tokens[:, None] * r[:, None]).sum(axis=0) - targets) ** 2 @ weights


@pytest.mark.parametrize("targets", [[60.0, 30.0, 10.0], [100.0, 0.0, 0.0], [30.0, 30.0, 140.0]])
def test_rates_against_small_steps(spark, targets):
    draw = np.random.default_rng(1)
    p = draw.dirichlet([0.3, 0.3, 0.3], 40)
    tokens = draw.integers(1, 9, 40)
    rows = spark.createDataFrame([(int(n), [float(x) for x in q]) for n, q in zip(tokens, p)], "_tokens int, _p array<double>")
    got = mixing.fit_rates(rows, targets).collect()
    goal = np.array(targets)
    weights = 1 / np.maximum(goal, goal.sum() * mixing.EPSILON)
    totals = sum(np.array(r["_p"]) * r["_tokens"] * r["_rate"] for r in got)
    assert all(r["_rate"] >= 0 for r in got)
    want = projected(tokens.astype(float), p, goal, weights)
    assert ((totals - goal) ** 2) @ weights <= want * 1.05 + 1e-3


def test_mixing_meets_its_targets(spark, labels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labelled = mixing.domains_of(labels)
    rows = mixing.rates(docs, labelled).toPandas()
    for domain, share in mixing.SHARES.items():
        total = (rows.tokens * rows[f"p_{domain}"] * rows.rate).sum()
        assert total == pytest.approx(share * rows.tokens.sum(), rel=0.01)
    kept = mixing.resample(docs, labelled, corpus_pipeline.SHARES, "clean").join(labelled, "doc_id")
    count = dict(map(tuple, kept.groupBy("domain").count().collect()))
    all_clean = labelled.filter("domain = 'clean'").count()
    assert count["clean"] >= 0.99 * all_clean and count.get("toxic", 0) < 20
    doubled = mixing.resample(docs, labelled, {"clean": 0.2, "toxic": 0.8}, "clean", most=3.0)
    assert doubled.count() > doubled.distinct().count()


def test_mixing_of_odd_documents(spark, labels):
    docs, labelled = odd_documents(spark), mixing.domains_of(labels)
    assert mixing.rates(docs, labelled).filter("rate IS NULL OR rate < 0").count() == 0
    assert mixing.rates(docs, labelled.limit(0)).count() == 17
    kept = mixing.resample(docs, labelled, corpus_pipeline.SHARES, "clean")
    assert kept.columns == docs.columns
    assert mixing.rates(odd_documents(spark, empty=True), labelled).count() == 0


def test_pipeline_stages(spark):
    docs = odd_documents(spark)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert number == 4 or out.columns == docs.columns
        out.count()
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_pipeline(spark):
    got = corpus_pipeline.run(spark, SF)
    labelled = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1 AND toxic = 0")
    near = __spark_entry__.queries()["op5_chosen_path"](spark, SF)
    alone = near.filter("n_links = 0").join(labelled, "doc_id")
    kept = alone.join(got.select("doc_id"), "doc_id").count()
    assert kept >= 0.98 * alone.count()
    assert got.agg(F.count("*"), F.countDistinct("doc_id")).first()[0] == got.count()
    assert [name for name, _ in corpus_pipeline.STAGES][1] == "n-gram Jaccard join"


def test_steps_write_no_tables(spark, monkeypatch):
    """A step reads the posteriors; no step writes a table of its own."""
    draw = np.random.default_rng(2)
    p, tokens = draw.dirichlet([0.3, 0.3, 0.3], 50), draw.integers(0, 9, 50)
    rows = spark.createDataFrame([(int(n), [float(x) for x in q]) for n, q in zip(tokens, p)], "_tokens long, _p array<double>")
    written = []
    monkeypatch.setattr(mixing, "materialize", lambda df, label: written.append(label) or df)
    steps = mixing.fit_steps(rows, [100.0, 40.0, 20.0], most=1.5)
    assert len(steps) > 2 and not written
    got = rows.withColumn("_rate", mixing.rate_of(steps, 1.5)).collect()
    sums, _ = mixing._totals(rows, steps, 1.5, 3)
    assert sums == pytest.approx(list(sum(np.array(r["_p"]) * r["_tokens"] * r["_rate"] for r in got)))


def test_steps_run_no_python(spark, monkeypatch):
    """The totals after the steps are column expressions; they equal those of the steps followed one by one."""
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", None)
    draw = np.random.default_rng(3)
    p, tokens = draw.dirichlet([0.3, 0.3, 0.3], 50), draw.integers(0, 9, 50)
    rows = spark.createDataFrame([(int(n), [float(x) for x in q]) for n, q in zip(tokens, p)], "_tokens long, _p array<double>")
    steps = mixing.fit_steps(rows, [100.0, 40.0, 20.0], most=1.0)
    rate = before = np.ones(50)
    for length, gradient in steps:
        rate, before = np.where(tokens > 0, np.clip(rate - p @ (length * np.array(gradient)), 0, 1), 1), rate
    sums, change = mixing._totals(rows, steps, 1.0, 3)
    assert len(steps) > 2 and sums == pytest.approx(list((tokens * rate) @ p))
    assert change == pytest.approx(tokens @ (rate - before) ** 2)
    assert mixing._totals(rows, [], 1.0, 3) == (pytest.approx(list(tokens @ p)), 0.0)
    assert mixing._totals(rows.limit(0), steps, 1.0, 3) == ([0.0, 0.0, 0.0], 0.0)


def test_steps_read_no_documents(spark, labels, monkeypatch):
    """What each step reads holds no text."""
    read, follow = [], mixing.fit_steps
    monkeypatch.setattr(mixing, "fit_steps", lambda rows, *more: read.append(rows.columns) or follow(rows, *more))
    mixing.resample(odd_documents(spark), mixing.domains_of(labels), corpus_pipeline.SHARES, "clean")
    assert read == [["_tokens", "_p"]]


def test_components_in_small_plans(spark, monkeypatch):
    """Paths, a star, a ring and repeated edges; no written plan holds the joins of more than one star."""
    at, written = importlib.import_module("triangulum.llm.components"), []
    write = at.materialize

    def counted(df, label):
        written.append(df._jdf.queryExecution().sparkPlan().toString().count("Join"))
        return write(df, label)

    monkeypatch.setattr(at, "materialize", counted)
    pairs = [(k, k + 1) for k in range(1, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(200 + k, 200 + (k + 1) % 9) for k in range(9)]
    edges = spark.createDataFrame([x for x in pairs for _ in range(2)] + [(7, 7), (300, 300)], "a long, b long")
    got = {r.node: r.root for r in at.components(edges).collect()}
    want = {n: min(g) for g in (range(1, 41), range(100, 130), range(200, 209)) for n in g}
    assert got == want and at.components(edges).count() == len(want)
    assert max(written) == 1


def test_small_tables_have_few_files(spark, monkeypatch):
    """Near copies write no file per shuffle partition of the tables whose rows are counted; classes are as planted."""
    path, parts = importlib.import_module("triangulum.llm.chosen_path"), importlib.import_module("triangulum.llm.components")
    write, files = path.materialize, []

    def counted(df, label):
        out = write(df, label)
        files.append((label, len(out.inputFiles())))
        return out

    monkeypatch.setattr(path, "materialize", counted)
    monkeypatch.setattr(parts, "materialize", counted)
    monkeypatch.setattr(path, "NODE_ROWS", 40)
    settings = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    draw = random.Random(11)
    words = [[f"w{draw.randrange(9999)}" for _ in range(80)] for _ in range(12)]
    texts = [" ".join([*w[:79], f"end{k}"]) for w in words for k in range(3)]
    texts += [" ".join([*words[0], f"more{k}"]) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        kept = sorted(r.doc_id for r in path.keep_one(docs).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert kept == list(range(0, 36, 3))
    first = [next(i for i, f in enumerate(files) if f[0] == "edges")]
    first.append(next(i for i, f in enumerate(files) if f[0] == "links") + 1)
    assert [files[i][0] for i in first] == ["edges", "edges"]  # their rows are not known yet
    known = {"texts", "nodes", "members", "joined", "stars", "edges", "near", "classes", "copies"}
    most = spark.sparkContext.defaultParallelism
    found = [f for i, f in enumerate(files) if f[0] in known and i not in first]
    assert {label for label, _ in found} == known and max(n for _, n in found) <= most


def test_sample_has_few_files(spark, monkeypatch):
    """The bounded sample is written in few files, however many tasks scan the texts."""
    text = F.when(F.col("doc_id") % 3 == 0, "|*#$ !!! BUY || NOW !!").otherwise("the cat and the dog sat on a mat, as they do.")
    docs = spark.range(600).select(F.col("id").alias("doc_id")).withColumn("text", F.concat(text, F.lit(" "), F.col("doc_id"))).repartition(40)
    parts, write = [], quality.materialize
    monkeypatch.setattr(quality, "materialize", lambda df, label: parts.append(df.rdd.getNumPartitions()) or write(df, label))
    assert quality.score(docs).count() == 600
    assert len(parts) == 1 and parts[0] <= quality.SAMPLE_FILES
