from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from triangulum.llm import arrow_files, sharding
from triangulum.llm.queries import tokenizer_path

from .texts import odd_documents

DOCS = "/root/testdata/sf0.001/documents.parquet"


def walked(ring, positions, room):
    """The ring walk of single keys, turn by turn, as counts per (arc, shard)."""
    points, owners, left = ring.points, ring.owners, list(room)
    arcs = sorted(sum(p < x for p in points) % len(points) for x in positions)
    waiting, out = [(a, 0) for a in arcs], Counter()
    while waiting:
        still = []
        for arc, step in waiting:
            shard = owners[(arc + step) % len(points)]
            if left[shard]:
                left[shard] -= 1
                out[arc, shard] += 1
            else:
                still.append((arc, step + 1))
        waiting = still
    return out


@pytest.mark.parametrize(("slack", "vnodes"), [(0.0, 4), (0.25, 8)])
def test_ring_walk(spark, slack, vnodes):
    ids = spark.range(3000).withColumn("key", F.when(F.col("id") < 1000, 7).otherwise(F.col("id")))
    placed = sharding.place(ids, "key", 5, vnodes, slack)
    ring = sharding.Ring.build(5, vnodes)
    rows = placed.withColumn("p", F.pmod(F.xxhash64("key"), F.lit(sharding.SPAN))).collect()
    got = Counter((sum(p < r["p"] for p in ring.points) % len(ring.points), r["shard"]) for r in rows)
    assert got == walked(ring, [r["p"] for r in rows], sharding.capacities(3000, 5, slack))
    for shard in range(5):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
        assert len(slots) <= 600 * (1 + slack)
    assert len({r["id"] for r in rows}) == 3000


def test_hot_cells_are_cut(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 50)
    rows = sharding.place(spark.range(2000).withColumn("key", F.lit(None).cast("long")), "key", 4).collect()
    assert Counter(r["shard"] for r in rows) == {s: 500 for s in range(4)}
    assert len({(r["shard"], r["slot"]) for r in rows}) == 2000


def test_limited_movement(spark):
    ids = spark.range(4000)
    before = {r["id"]: r["shard"] for r in sharding.place(ids, "id", 8, 64, 0.25).collect()}
    after = {r["id"]: r["shard"] for r in sharding.place(ids, "id", 9, 64, 0.25).collect()}
    assert sum(before[i] != after[i] for i in before) < 4000 * 0.25


def test_shards_of_odd_documents(spark):
    rows = sharding.shard_documents(odd_documents(spark)).collect()
    assert len(rows) == 17
    assert sorted(Counter(r["shard"] for r in rows).values()) == [1] * 15 + [2]
    for r in rows:
        if r["size"] == 1:
            assert r["text_crc32"] == 0
    assert sharding.shard_documents(odd_documents(spark, empty=True)).count() == 0


def brute_files(docs, end_id):
    from tokenizers import Tokenizer

    tokens, start, out = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json")), 0, []
    for doc_id, text in docs:
        ids = [*tokens.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_match_the_tokenizer(spark):
    docs = spark.read.parquet(DOCS)
    got = arrow_files.round_trip(docs, tokenizer_path("byte_bpe_50k.json")).collect()
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert sorted(map(tuple, got)) == brute_files(rows, 2)


def test_files_of_odd_documents(spark):
    docs = odd_documents(spark).coalesce(1)
    got = arrow_files.round_trip(docs, tokenizer_path("byte_bpe_50k.json")).collect()
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute_files(rows, 2)
    assert arrow_files.round_trip(odd_documents(spark, True), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_sequences_and_masks(tmp_path):
    path = str(tmp_path / "x.arrows")
    with pa.OSFile(path, "wb") as sink:
        writer = arrow_files.SequenceWriter(sink, np.dtype("<u2"), sequence=4, rows=2)
        for n in (3, 7, 0, 9):
            writer.write(np.arange(n, dtype="<u2"))
        writer.close()
    stored = arrow_files.SequenceFile(path)
    flat = [*range(3), *range(7), *range(9)]
    for first, count in ((0, 3), (3, 7), (10, 9), (7, 6), (18, 1), (5, 0)):
        views = list(stored.ids(first, count))
        assert [int(x) for v in views for x in v] == flat[first : first + count]
        assert all(not v.flags.owndata for v in views)
    ids, mask = stored.sequences(len(stored.batches) - 1)
    assert mask.sum() == 3 and not ids[~mask].any()
    assert [b.num_rows for b in stored.batches] == [2, 2, 1]
