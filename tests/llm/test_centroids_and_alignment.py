import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from triangulum.llm import alignment, centroids, queries

SF = "/root/testdata/sf0.01"
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def brute_clusters(rows, clusters=16, rounds=3, dims=64):
    kept = [
        (i, [math.floor(64 * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centres = [
            [sum(x) // len(groups[k]) for x in zip(*groups[k])] if k in groups else c for k, c in enumerate(centres)
        ]
    found = [(i, *near(v)) for i, v in kept]
    per = Counter()
    for _, d, k in found:
        per[k] += d
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, k, d, per[k], sum(per.values()), marks[k]) for i, d, k in found)


def clustered(df, **options):
    return Counter(map(tuple, centroids.cluster(df, **options).collect()))


def test_clusters_equal_brute_force_and_sql(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute_clusters([(r.vec_id, r.embedding) for r in df.collect()])
    assert clustered(df) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert Counter(con.execute(centroids.oracle()).fetchall()) == want


def test_clusters_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    one = [float(x) for x in rng.normal(size=64)]
    rows = [(1, one), (1, one), (2, one), (None, one), (3, None), (4, one[:5]), (5, [None, *one[1:]]), (6, [math.nan, *one[1:]])]
    rows += [(7, [math.inf, *one[1:]]), (8, [0.0] * 64), (9, [-x for x in one])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("x"))
    assert clustered(df) == brute_clusters(rows)
    assert clustered(df.filter("false")) == Counter()
    huge = spark.createDataFrame([(1, [1e300] * 64), (2, [-1e300] * 64)], "vec_id long, embedding array<double>")
    assert {r.distance for r in centroids.cluster(huge).collect()} == {0}


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(queries.tokenizer_path(BYTES))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path(PIECES))
    signs = alignment.byte_alphabet()
    texts, counts = [], Counter()
    for doc_id, text in rows:
        ids_a, ids_b, groups, links = [], [], [], []
        if text:
            ids_a, ids_b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
            raw_a = [bytes(signs[c] for c in a_side.id_to_token(i)) for i in ids_a]
            raw_b = [
                bytes([int(p[3:-1], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in zip(ids_b, b_side.id_to_piece(ids_b))
            ]
            if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
                ids_a, ids_b = [], []
        if ids_a:
            ends_a, ends_b = np.cumsum([len(x) for x in raw_a]), np.cumsum([len(x) for x in raw_b])
            i = j = 0
            own = ([], [])
            while i < len(ids_a):
                links.append((ids_a[i], ids_b[j]))
                own[0].append(i), own[1].append(j)
                if ends_a[i] == ends_b[j]:
                    sides = [",".join(str(ids[x]) for x in sorted(set(at))) for ids, at in zip((ids_a, ids_b), own)]
                    groups.append("|".join(sides))
                    own = ([], [])
                i, j = i + (ends_a[i] <= ends_b[j]), j + (ends_b[j] <= ends_a[i])
        counts.update(links)
        texts.append((doc_id, len(ids_a), len(ids_b), groups, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return Counter(
        (
            doc_id, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        )
        for doc_id, n_a, n_b, groups, links in texts
    )


def aligned(df):
    paths = queries.tokenizer_path(BYTES), queries.tokenizer_path(PIECES)
    return Counter(map(tuple, alignment.align(df, *paths).collect()))


def test_alignment_equals_brute_force_on_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = Counter(map(tuple, queries.op13_token_alignment(spark, SF).collect()))
    assert got == brute_alignment(rows)


@pytest.mark.parametrize("block_bytes", [64, 4 << 20])
def test_alignment_of_odd_texts(spark, monkeypatch, block_bytes):
    # small blocks also show that counts are those of the corpus, not of a block
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block_bytes)
    rows = [(1, None), (2, ""), (3, " "), (4, "a▁b"), (5, "<|endoftext|> <s> </s> <unk>"), (6, "x\0y"), (9, "a" * 50_000)]
    rows += [(7, "ﬁ ½ é é 日本 😀\n\n\t  end  "), (8, "hello"), (8, "hello"), (None, "hello world"), (10, " " * 3000), (11, "\r\n x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit(1)).repartition(3)
    assert aligned(df) == brute_alignment(rows)
    assert aligned(df.filter("false")) == Counter()


def test_other_merge_orders_are_refused(tmp_path):
    bad = '{"model": {"vocab": {"a": 0, "b": 1, "ab": 3, "ba": 2}, "merges": ["a b", "b a"]}}'
    (tmp_path / "bad.json").write_text(bad)
    with pytest.raises(ValueError):
        alignment.byte_level(str(tmp_path / "bad.json"))
