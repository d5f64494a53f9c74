"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) turns a
unit vector, and the signed axis nearest to it is its bucket.  Rows are put into one
bucket of each table; a query probes, in each table, the axes nearest to it.  A bucket's
rows meet its queries block by block inside one task, which keeps the exact nearest of
the block for each query, so candidate pairs never become rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

TABLES, PROBES, SEED = 12, 8, 5
BLOCK_ROWS = 4096
QUERIES_AT_ONCE = 256

_KEYS = "dim int, tab int, axis int"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of each line; the width is a power of two."""
    n, width, half = len(x), x.shape[1], 1
    while half < width:
        pairs = x.reshape(n, width // (2 * half), 2, half)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2)
        x = x.reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def rotate(unit: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    """The pseudo-rotation of one table; narrower vectors are filled up with zeros."""
    width = 1 << max(unit.shape[1] - 1, 1).bit_length()
    signs = np.random.default_rng([seed, table, unit.shape[1]]).choice([-1.0, 1.0], (3, width))
    x = np.zeros((len(unit), width))
    x[:, : unit.shape[1]] = unit
    for s in signs:
        x = hadamard(x * s)
    return x


def axes(unit: np.ndarray, table: int, probes: int, seed: int = SEED) -> np.ndarray:
    """The signed axes nearest to each vector, nearest first: 2i for +i, 2i + 1 for -i."""
    x = rotate(unit, table, seed)
    both = np.stack([x, -x], axis=2).reshape(len(x), -1)
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def _unit(vectors: np.ndarray) -> np.ndarray:
    top = np.abs(vectors).max(axis=1, keepdims=True)  # large components must not overflow when squared
    scaled = vectors / top
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _hashed(tables: int, probes: int | None):
    """(id, vector) to (id, dim, tab, axis, vector), one row for each table and probed axis."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                vectors = batch.column("vector")
                widths = np.asarray(vectors.value_lengths())
                for dim in np.unique(widths):
                    rows = np.flatnonzero(widths == dim)
                    part = batch.take(pa.array(rows))
                    unit = _unit(np.asarray(part.column("vector").flatten(), np.float64).reshape(-1, dim))
                    for table in range(tables):
                        found = axes(unit, table, probes or 2 * unit.shape[1] * 2)
                        index = pa.array(np.repeat(np.arange(len(rows)), found.shape[1]))
                        copies = part.take(index)
                        n = len(index)
                        yield pa.RecordBatch.from_arrays(
                            [copies.column("id"), pa.array(np.full(n, dim, np.int32)),
                             pa.array(np.full(n, table, np.int32)), pa.array(found.ravel().astype(np.int32)),
                             copies.column("vector")],
                            names=["id", "dim", "tab", "axis", "vector"],
                        )

    return run


def nearest(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and exact distances of its k nearest ids, each with its nearest row, ties to the smaller id."""
    out = []
    with np.errstate(over="ignore", invalid="ignore"):
        square = (rows * rows).sum(axis=1)
        rough = square - 2 * queries @ rows.T
        for query, line in zip(queries, rough):
            own, need = float(query @ query), k
            while True:  # until the rows at hand hold k ids, or are all rows
                close = np.arange(len(rows))
                if len(rows) > need:
                    bound = np.partition(line, need - 1)[need - 1]
                    slack = 1e-9 * (own + square.max() + 1)
                    if np.isfinite(bound) and np.isfinite(slack):  # else all rows are measured exactly
                        close = np.flatnonzero(line <= bound + slack)
                apart = rows[close] - query
                exact = np.sqrt((apart * apart).sum(axis=1))
                order = np.lexsort((ids[close], exact))
                _, first = np.unique(ids[close][order], return_index=True)
                if len(first) >= k or len(close) == len(rows):
                    break
                need *= 4
            best = order[np.sort(first)[:k]]
            out.append((ids[close][best], exact[best]))
    return out


def _blocks(k: int):
    """Sorted by block, rows before queries: the nearest rows of each block to each of its queries."""
    names = ["dim", "tab", "axis", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, rows = None, [], []
        for whole in batches:
            for at in range(0, whole.num_rows, QUERIES_AT_ONCE):
                batch = whole.slice(at, QUERIES_AT_ONCE)
                keys = list(zip(*(batch.column(c).to_pylist() for c in [*names, "query"])))
                vectors, own = batch.column("vector"), batch.column("id").to_numpy()
                cuts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]] + [len(keys)]
                found: list[tuple[int, np.ndarray, np.ndarray]] = []
                for lo, hi in zip(cuts, cuts[1:]):
                    *key, is_query = keys[lo]
                    matrix = np.asarray(vectors.slice(lo, hi - lo).flatten(), np.float64).reshape(hi - lo, -1)
                    if key != group:
                        group, ids, rows = key, [], []
                    if not is_query:
                        ids.append(own[lo:hi])
                        rows.append(matrix)
                    elif ids:
                        ids, rows = [np.concatenate(ids)], [np.concatenate(rows)]
                        for q, (near, apart) in zip(own[lo:hi], nearest(matrix, rows[0], ids[0], k)):
                            found.append((q, near, apart))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([q for q, _, _ in found], [len(n) for _, n, _ in found])),
                         pa.array(np.concatenate([n for _, n, _ in found])),
                         pa.array(np.concatenate([a for _, _, a in found]))],
                        names=["query_id", "vec_id", "score"],
                    )

    return run


def _search(rows: DataFrame, queries: DataFrame, k: int, tables: int, probes: int | None) -> DataFrame:
    """query_id, vec_id, score: the k nearest that the probed buckets hold."""
    hashed = "id long, dim int, tab int, axis int, vector array<double>"
    put = rows.mapInArrow(_hashed(tables, 1), hashed)
    asked = queries.mapInArrow(_hashed(tables, probes), hashed)
    # Buckets larger than a block are cut; their queries go to every block.
    sizes = materialize(
        put.groupBy("dim", "tab", "axis").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")), "buckets"
    )
    keys = ["dim", "tab", "axis"]
    put = put.join(sizes, keys).select(
        *keys, F.pmod(F.xxhash64("id", "vector"), "blocks").cast("int").alias("block"), F.lit(0).alias("query"),
        "id", "vector",
    )
    asked = asked.join(sizes, keys).select(
        *keys, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("query"), "id", "vector"
    )
    both = put.unionByName(asked).repartition(*keys, "block").sortWithinPartitions(*keys, "block", "query")
    met = both.mapInArrow(_blocks(k), "query_id long, vec_id long, score double")
    met = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def usable(vectors: DataFrame) -> DataFrame:
    """id and vector (doubles) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    return vectors.select(F.col("vec_id").cast("bigint").alias("id"), v.alias("vector")).filter(
        F.col("id").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 10, tables: int = TABLES, probes: int = PROBES
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows by Euclidean distance, ties to the smaller vec_id.

    ``queries`` are rows of ``vectors``; a row with the query's own vec_id is no candidate.
    Null or zero vectors, vectors with null or non-finite components and rows without a
    vec_id take no part; vectors of different length never meet; a vec_id that occurs
    twice counts with its nearest vector.  Distances are exact, on the original vectors.

    Of equal vectors only the k + 1 with the smallest vec_ids can be among the nearest, so
    no more are put into buckets, and equal queries are searched once.  Queries whose
    buckets held too few rows search every bucket of one table, which is exact.
    """
    all_rows = usable(vectors).distinct()
    turn = Window.partitionBy("vector").orderBy("id")
    rows = all_rows.withColumn("_n", F.row_number().over(turn)).filter(F.col("_n") <= k + 1).drop("_n")
    rows = materialize(rows, "vectors")
    asked = materialize(usable(queries).distinct(), "queries")
    heads = asked.groupBy("vector").agg(F.min("id").alias("head"))
    members = materialize(asked.join(heads, "vector").select("head", "id"), "query-members")
    heads = materialize(heads.select(F.col("head").alias("id"), "vector"), "query-heads")
    met = materialize(_search(rows, heads, k + 1, tables, probes), "nearest")
    short = heads.join(
        met.groupBy("query_id").count().filter(F.col("count") > k).select(F.col("query_id").alias("id")), "id", "left_anti"
    )
    if not short.isEmpty():
        again = materialize(_search(rows, short, k + 1, 1, None), "nearest-all")
        met = met.join(again.select("query_id").distinct(), "query_id", "left_anti").unionByName(again)
    each = met.join(members, met["query_id"] == members["head"]).filter(F.col("vec_id") != F.col("id"))
    each = each.groupBy(members["id"], "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("id").orderBy("score", "vec_id")
    ranked = each.select(F.col("id"), "vec_id", "score", F.row_number().over(order).alias("rank"))
    return ranked.filter(F.col("rank") <= k).select(F.col("id").alias("query_id"), "rank", "vec_id", "score")
