"""Document fingerprints: a quartile bucket digest of hashed byte triplets.

Every three adjacent bytes are hashed into one of 256 buckets.  The digest writes for
each bucket the quartile its count falls into (two bits), the length on a logarithmic
scale and the spread of the quartiles.  Two digests are compared by a difference that
is bounded per bucket and in total.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, rows_of, text_of, with_row_number

BUCKETS = 256
LENGTH_BASE = 1.1
LENGTH_BOUND = 24
SPREAD_STEPS = 15
# A quartile apart costs one, the two ends of the scale cost six.
STEP_COST = np.array([0, 1, 2, 6], np.int32)
DIFFERENCE_BOUND = 512
BLOCK = 1 << 22


def bucket_counts(data: bytes) -> np.ndarray:
    """How often the hashed byte triplets of the whole text fall into each bucket."""
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(len(data) - 2, 0), BLOCK):
        part = np.frombuffer(data, np.uint8, min(BLOCK + 2, len(data) - at), at).astype(np.uint32)
        triplet = (part[:-2] << 16) | (part[1:-1] << 8) | part[2:]
        counts += np.bincount((triplet * np.uint32(2654435761)) >> np.uint32(24), minlength=BUCKETS)
    return counts


def digest(data: bytes) -> str:
    """132 hex digits: length, spread, then two bits per bucket.  Texts under three bytes have no triplet."""
    counts = bucket_counts(data)
    q1, q2, q3 = np.partition(counts, (63, 127, 191))[[63, 127, 191]]
    code = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).reshape(-1, 4)
    packed = (code << np.array([6, 4, 2, 0], np.uint8)).sum(axis=1).astype(np.uint8)
    length = min(int(np.log(len(data) + 1) / np.log(LENGTH_BASE)), 255)
    spread = int(SPREAD_STEPS * q1 / q3) * 16 + int(SPREAD_STEPS * q2 / q3) if q3 else 0
    return bytes([length, spread]).hex() + packed.tobytes().hex()


def _codes(digests: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex("".join(digests)), np.uint8).reshape(len(digests), -1)
    spread = np.stack([raw[:, 1] >> 4, raw[:, 1] & 15], axis=1).astype(np.int32)
    codes = (raw[:, 2:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3
    return raw[:, 0].astype(np.int32), spread, codes.reshape(len(digests), -1).astype(np.int8)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """1 for equal digests, 0 from a difference of 512 on; pair by pair."""
    if not left:
        return np.zeros(0)
    (n1, s1, c1), (n2, s2, c2) = _codes(left), _codes(right)
    apart = STEP_COST[np.abs(c1 - c2)].sum(axis=1) + np.abs(s1 - s2).sum(axis=1)
    apart = apart + np.minimum(np.abs(n1 - n2), LENGTH_BOUND)
    return 1.0 - np.minimum(apart, DIFFERENCE_BOUND) / DIFFERENCE_BOUND


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("part", pa.int32()),
        ("first", pa.string()),
        ("last", pa.string()),
    ]
)


def _results(ids: list, texts: list[str], prints: list[str], following: list[tuple[str, str]]) -> dict[str, list]:
    edited_sha, edited_print = [], []
    for text, (after, _) in zip(texts, following):
        cut = len(text) // 3
        edited = (text[: len(text) - cut] + after[:cut]).encode()
        edited_sha.append(hashlib.sha256(edited).hexdigest())
        edited_print.append(digest(edited))
    n = len(ids)
    return {
        "doc_id": ids,
        "n_chars": [len(x) for x in texts],
        "edited_sha256": edited_sha,
        "fingerprint": prints,
        "edited_fingerprint": edited_print,
        "near_edited": likeness(prints, edited_print),
        "near_next": likeness(prints, [p for _, p in following]),
        "part": [None] * n,
        "first": [None] * n,
        "last": [None] * n,
    }


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One ordered part: every document but the last, and one row with both edges of the part."""
    first, held = None, None
    for batch in rows_of(batches):
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        prints = [digest(x.encode()) for x in texts]
        if first is None:
            first = texts[0]
        if held is not None:
            ids, texts, prints = [held[0], *ids], [held[1], *texts], [held[2], *prints]
        held = ids.pop(), texts.pop(), prints.pop()
        if ids:
            following = list(zip([*texts[1:], held[1]], [*prints[1:], held[2]]))
            yield pa.RecordBatch.from_pydict(_results(ids, texts, prints, following), schema=_ARROW)
    if held is not None:
        edge = {name: [None] for name in _ARROW.names} | {
            "doc_id": [held[0]],
            "part": [TaskContext.get().partitionId()],
            "first": [first],
            "last": [held[1]],
        }
        yield pa.RecordBatch.from_pydict(edge, schema=_ARROW)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_of(batches):
        texts, after = batch.column("last").to_pylist(), batch.column("first").to_pylist()
        ids = batch.column("doc_id").to_pylist()
        prints = [digest(x.encode()) for x in texts]
        rows = _results(ids, texts, prints, [(x, digest(x.encode())) for x in after])
        yield pa.RecordBatch.from_pydict({k: v for k, v in rows.items() if k not in ("part", "first", "last")})


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Digest of every whole text and of its edited text, with their likeness.

    The edited text replaces the last floor(n / 3) code points by the first as many of
    the next document in descending doc_id; the last document is followed by the first.
    Null texts count as empty, null doc_ids come last, rows of one doc_id keep the order
    of the input; a table of one row is followed by itself, an empty one gives no rows.
    Columns other than doc_id and text are not looked at.

    The texts are shuffled once, by ranges of doc_id (ties by row, so that no doc_id is
    too hot).  A part knows the next document of all its rows but the last; those meet
    the first of the following part in a second step over one row per part.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("_row")]
    rows = with_row_number(docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text")))
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    walked = materialize(parts.mapInArrow(_walk, f"{RESULT}, part int, first string, last string"), "digests")
    inner = walked.filter("part IS NULL").drop("part", "first", "last")
    edges = walked.filter("part IS NOT NULL").select("part", "doc_id", "first", "last")
    turn = Window.orderBy("part")
    after = edges.select("part").select(
        "part", F.lead("part").over(turn).alias("_after"), F.min("part").over(Window.partitionBy()).alias("_start")
    )
    after = after.select("part", F.coalesce("_after", "_start").alias("_after"))
    firsts = edges.select(F.col("part").alias("_after"), "first")
    met = edges.drop("first").join(after, "part").join(firsts, "_after").select("doc_id", "last", "first")
    return inner.unionByName(met.mapInArrow(_edges, RESULT))

