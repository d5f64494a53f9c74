from __future__ import annotations

import hashlib

import numpy as np
import pytest

from triangulum.llm import cross_polytope, fingerprint

from .texts import odd_documents

SF = "/root/testdata/sf0.01"


def brute(vectors, queries, k):
    out = {}
    for q in queries:
        others = [(i, np.array(v) - np.array(vectors[q])) for i, v in vectors.items() if i != q and len(v) == len(vectors[q])]
        with np.errstate(over="ignore"):
            near = sorted((float(np.sqrt((d * d).sum())), i) for i, d in others)
        out[q] = [i for _, i in near[:k]]
    return out


def test_recall(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = cross_polytope.nearest_neighbours(table, table.filter("vec_id % 20 = 0")).collect()
    vectors = {r["vec_id"]: [float(x) for x in r["embedding"]] for r in table.collect()}
    queries = [i for i in vectors if i % 20 == 0]
    want = brute(vectors, queries, 10)
    found = {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in queries}
    assert all(len(found[q]) == 10 for q in queries)
    assert sum(len(set(found[q]) & set(want[q])) for q in queries) >= 0.9 * 10 * len(queries)
    for r in got:
        apart = np.array(vectors[r["query_id"]]) - np.array(vectors[r["vec_id"]])
        assert r["score"] == pytest.approx(float(np.sqrt((apart * apart).sum())), rel=1e-14)


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(cross_polytope, "BLOCK_ROWS", 16)
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(60)] + [(100, [1.0, 0.1, 0.5]), (200, [-1.0, 0.0, 0.0]), (300, [1.0, 2.0])]
    rows += [(400, None), (500, [0.0, 0.0, 0.0]), (600, [1.0, None, 2.0]), (700, [1.0, float("nan"), 2.0])]
    rows += [(None, [1.0, 0.0, 0.5]), (800, [float("inf"), 1.0, 1.0]), (900, []), (100, [1.0, 0.1, 0.5]), (1000, [1e200, 1.0, 1.0])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, id int")
    got = cross_polytope.nearest_neighbours(table, table.filter("vec_id % 100 = 0")).collect()
    found = {q: [(r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in {r["query_id"] for r in got}}
    usable = {i: v for i, v in rows if i is not None and (i < 60 or i in (100, 200, 1000))}
    assert set(found) == {0, 100, 200, 1000}
    for q, want in brute(usable, found, 10).items():
        assert found[q] == list(enumerate(want, 1))
    assert cross_polytope.nearest_neighbours(table.limit(0), table.limit(0)).count() == 0


def test_repeated_rows_and_ids(spark):
    draw = np.random.default_rng(8)
    rows = [(i, draw.normal(size=4).tolist()) for i in range(40)] * 2
    rows += [(50, rows[0][1])] * 20 + [(51 + i, rows[0][1]) for i in range(3)]
    rows += [(70, (np.array(rows[1][1]) + 0.001 * i).tolist()) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = cross_polytope.nearest_neighbours(table, table.filter("vec_id IN (0, 1, 2, 70)"), tables=1, probes=8).collect()
    for q in (0, 1, 2, 70):
        best = {}
        for i, v in rows:
            if i != q:
                near = min(float(np.linalg.norm(np.array(v) - np.array(w))) for j, w in rows if j == q)
                best[i] = min(near, best.get(i, np.inf))
        want = [i for _, i in sorted((d, i) for i, d in best.items())][:10]
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == want


def test_edited_fingerprints(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(7)
    got = {r["doc_id"]: r for r in fingerprint.edited_fingerprints(docs).collect()}
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    for (doc_id, text), (_, after) in zip(rows, [*rows[1:], rows[0]]):
        cut = len(text) // 3
        edited = (text[: len(text) - cut] + after[:cut]).encode()
        r = got[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited).hexdigest())
        assert r["fingerprint"] == fingerprint.digest(text.encode())
        assert r["edited_fingerprint"] == fingerprint.digest(edited)
        assert r["near_edited"] == fingerprint.likeness([r["fingerprint"]], [r["edited_fingerprint"]])[0]
        assert r["near_next"] == fingerprint.likeness([r["fingerprint"]], [fingerprint.digest(after.encode())])[0]
    assert sum(r["near_edited"] > r["near_next"] for r in got.values()) > 0.97 * len(got)


def test_digest_by_hand():
    data = bytes(range(200)) * 3
    counts = [0] * 256
    for a, b, c in zip(data, data[1:], data[2:]):
        counts[((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 24] += 1
    assert fingerprint.bucket_counts(data).tolist() == counts
    ordered = sorted(counts)
    codes = [sum(n > ordered[q] for q in (63, 127, 191)) for n in counts]
    packed = bytes(a << 6 | b << 4 | c << 2 | d for a, b, c, d in zip(*[iter(codes)] * 4))
    assert fingerprint.digest(data)[4:] == packed.hex()
    assert fingerprint.likeness([fingerprint.digest(data)], [fingerprint.digest(data)])[0] == 1.0


def test_odd_fingerprints(spark):
    rows = fingerprint.edited_fingerprints(odd_documents(spark)).collect()
    assert len(rows) == 17 and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert all(r["n_chars"] is not None and r["fingerprint"] for r in rows)
    assert fingerprint.edited_fingerprints(odd_documents(spark, empty=True)).count() == 0
    one = spark.createDataFrame([(1, "abcdefghi")], "doc_id long, text string")
    assert fingerprint.edited_fingerprints(one).first()["edited_sha256"] == hashlib.sha256(b"abcdefabc").hexdigest()
