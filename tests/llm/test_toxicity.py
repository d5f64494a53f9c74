import numpy as np
import pytest
from pyspark.sql import functions as F

from triangulum.llm import toxicity

DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"
RUDE = ("blockhead", "nitwit", "dunderhead", "scoundrel")


def corpus(n=900, seed=5):
    """Invented prose; every third text holds two or three rude words."""
    rng = np.random.default_rng(seed)
    parts = ["an", "ter", "lo", "mi", "ra", "sto", "ne", "vi", "cu", "pel"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(rng.integers(40, 80))]
        toxic = int(i % 3 == 0)
        for _ in range(toxic * int(rng.integers(2, 4))):
            words[int(rng.integers(len(words)))] = str(rng.choice(RUDE))
        rows.append((i, " ".join(words) + ".", toxic))
    return rows


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS).union(
        spark.createDataFrame([(-1, None), (-2, ""), (-3, " \n. "), (-4, rows[0][1]), (-4, rows[0][1]), (None, "an"), (-5, "a" * 200_000)], DOCS)
    )
    docs = docs.withColumn("toxic", F.lit("clash")).withColumn("cells", F.lit(0)).repartition(4)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows] + [(1, None), (2, 0)], LABELS)
    return rows, toxicity.score(docs, labels).collect()


def test_held_out_accuracy(scored):
    rows, got = scored
    truth = {i: t for i, _, t in rows}
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 200
    caught = [p for t, p in held if t == 1]
    false = [p for t, p in held if t == 0]
    assert np.mean(caught) > 0.85
    assert np.mean(false) < 0.05


def test_every_row_and_equal_texts(scored):
    rows, got = scored
    assert len(got) == len(rows) + 7
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[-1].score == by_id[-2].score == by_id[-3].score < 0.7
    assert by_id[-4].score == by_id[0].score
    assert sum(r.doc_id == -4 for r in got) == 2
    assert not by_id[None].held_out


def test_held_out_labels_are_not_used(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], LABELS)
    turned = labels.withColumn(
        "toxic", F.when(toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    first, second = (sorted(map(tuple, toxicity.score(docs, x).collect())) for x in (labels, turned))
    assert first == second


def test_too_few_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs.filter("false"), none).collect() == []
    toxic = spark.createDataFrame([(1, 1), (2, 1)], LABELS)
    assert {r.score for r in toxicity.score(docs, toxic).collect()} == {1.0}


def test_cells_prefer_the_own_dictionary():
    ordinary, toxic = b" the weather in the valley was mild ", b" nitwit blockhead dunderhead "
    cell = toxicity.Distance(ordinary, toxic).cells([b"blockhead", b"weather"])
    (rude_o, rude_t), (mild_o, mild_t) = [(c >> 16, c >> 8 & 255) for c in cell]
    assert rude_t < rude_o and mild_o < mild_t


def test_weights_without_the_second_compression():
    words = sorted({w for _, text, _ in corpus(200) for w in toxicity.windows(text)})
    ordinary, toxic = b" ".join(words[::2]), b" ".join(w.encode() for w in RUDE)
    cells = {c: (1.5 if i % 3 else -0.5) for i, c in enumerate(sorted(set(toxicity.Distance(ordinary, toxic).cells(words))))}
    scorer = toxicity.Scorer(ordinary, toxic, cells)
    every = toxicity.Distance(ordinary, toxic).cells(words)
    assert scorer._known(words) == [max(0.0, cells[c]) for c in every]


def test_windows_are_words():
    """Signs and every kind of white space part words; the lower-case bytes of a word are cut every 48."""
    signs = str.maketrans({c: " " for c in map(chr, range(33, 127)) if not c.isalnum()})

    def plain(text):
        raw = [w.encode() for w in text.lower().translate(signs).split()]
        return {w[at : at + toxicity.WINDOW_BYTES] for w in raw for at in range(0, len(w), toxicity.WINDOW_BYTES)}

    every = "x".join(map(chr, [*range(0xD800), *range(0xE000, 0x3100), *range(0xFE00, 0x10400)]))
    texts = ["", " \n. ", "A,b\x1cc\x1fd\x85e\xa0f g　h\x7fi\x00j", "ΑΣ ΑΣ Σ", "é" * 40 + " " + "a" * 100, every, every.replace("x", "")]
    assert [toxicity.windows(t) for t in texts] == [plain(t) for t in texts]


def test_texts_are_split_in_few_calls(monkeypatch):
    """Each distinct word of a text is looked at once, and words that are kept are never compressed again."""
    scorer = toxicity.Scorer(b" the weather was mild ", b" nitwit blockhead ", {0: 1.0})
    asked = []
    monkeypatch.setattr(scorer, "_known", lambda words: asked.append(words) or [1.0] * len(words))
    assert scorer.sums(["b a b", "a c a"]) == [(2.0, 2), (2.0, 2)] and scorer.sums(["c a d"]) == [(3.0, 3)]
    assert asked == [[b"a", b"b", b"c"], [b"d"]]
