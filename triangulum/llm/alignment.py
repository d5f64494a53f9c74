"""Alignment of two tokenizers' ids over the same bytes.

A block of texts is encoded by both tokenizers, and all further work on it is Arrow's:
flattened lists with their parent rows, cumulative sums of token bytes, and a hash join
on the byte offsets where tokens end.  The outer join of both sides' ends has one row per
link, because two tokens that overlap share exactly one stretch without an end inside.
Each block counts its id pairs, Spark adds the counts up, brings each block the totals of
its own pairs, and the block's documents are finished beside them.  No pair is counted or
joined per document outside its block, and a frequent pair has one row per block.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_of, materialize, text_of

BLOCK_BYTES = 4 << 20
# Fixed value: how byte-level tokenizers part a text.
PRE_TOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

BLOCK = "block string, pairs array<bigint>, counts array<bigint>, docs binary, links binary"
RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The sign that stands for each byte: itself where it can be seen, else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def byte_level(path: str):
    """Encoder and bytes per id of a byte-level tokenizer file whose ids follow its merges."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    signs = byte_alphabet()
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [model["vocab"][m] for m in merged]
    if ids != sorted(ids):
        raise ValueError(f"the ids of {path} do not follow its merges")
    ranks = {bytes(signs[s] for s in entry): model["vocab"][entry] for entry in (*signs, *merged)}
    table = [b""] * (max(ranks.values()) + 1)
    for entry, number in ranks.items():
        table[number] = entry
    encoder = tiktoken.Encoding("aligned", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
    return encoder, pa.array(table, pa.binary())


@lru_cache(maxsize=1)
def pieces(path: str):
    """Encoder and bytes per id of a piece tokenizer file."""
    import sentencepiece

    encoder = sentencepiece.SentencePieceProcessor(model_file=path)
    table = [
        bytes([int(p[3:-1], 16)]) if encoder.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in enumerate(encoder.id_to_piece(list(range(encoder.get_piece_size()))))
    ]
    return encoder, pa.array(table, pa.binary())


def _lists(ids: list) -> pa.ListArray:
    ends = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=ends[1:])
    flat = np.concatenate([np.asarray(x, np.int32) for x in ids]) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def _joined_bytes(ids: pa.ListArray, table: pa.Array) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, table.take(ids.flatten())), b"")


def _kept(ids: pa.ListArray, keep: np.ndarray) -> pa.ListArray:
    return ids.filter(pa.array(keep))


def _ends(ids: pa.ListArray, table: pa.Array, name: str) -> pa.Table:
    """One row per token: where it ends in the bytes of all texts, and its number."""
    flat = pc.list_flatten(ids)
    ends = pc.cumulative_sum(pc.binary_length(table).cast(pa.int64()).take(flat))
    return pa.table({"end": ends, name: pa.array(np.arange(len(flat)))})


def _cut(values: pa.Array, ends: np.ndarray) -> pa.ListArray:
    """Lists of the values between consecutive ends."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), values)


def _digests(a: pa.ListArray, b: pa.ListArray, cut_a: np.ndarray, cut_b: np.ndarray, per_doc: np.ndarray) -> list[str]:
    """sha256 of every text's groups, written as decimal ids."""
    left = pc.binary_join(_cut(pc.list_flatten(a).cast(pa.string()), cut_a), ",")
    right = pc.binary_join(_cut(pc.list_flatten(b).cast(pa.string()), cut_b), ",")
    groups = pc.binary_join_element_wise(left, right, "|")
    texts = pc.binary_join(_cut(groups, np.cumsum(per_doc)), ";")
    return [hashlib.sha256(t.encode()).hexdigest() for t in texts.to_pylist()]


def align_block(texts: pa.Array, byte_path: str, piece_path: str) -> tuple[pa.Table, pa.Table, pa.Array]:
    """Of a block: counts and digest per text, its id pairs with counts, and the pair of every link in order."""
    encode_a, bytes_a = byte_level(byte_path)
    encode_b, bytes_b = pieces(piece_path)
    rows = len(texts)
    raw = texts.fill_null("").to_pylist()
    ids_a = _lists([encode_a.encode_to_numpy(" " + t, disallowed_special=()) if t else () for t in raw])
    ids_b = _lists([x if t else () for t, x in zip(raw, encode_b.encode(raw, num_threads=1))])
    whole = pc.binary_join_element_wise(" ", texts.fill_null(""), "").cast(pa.binary())
    same = pc.and_(pc.equal(_joined_bytes(ids_a, bytes_a), whole), pc.equal(_joined_bytes(ids_b, bytes_b), whole))
    keep = same.to_numpy(zero_copy_only=False) & np.array([bool(t) for t in raw], bool)
    del whole, raw
    ids_a, ids_b = _kept(ids_a, keep), _kept(ids_b, keep)
    links = _ends(ids_a, bytes_a, "a").join(_ends(ids_b, bytes_b, "b"), "end", join_type="full outer", use_threads=False)
    links = links.sort_by("end").combine_chunks()
    at_a, at_b = links.column("a").combine_chunks(), links.column("b").combine_chunks()
    cut = np.flatnonzero(pc.and_(pc.is_valid(at_a), pc.is_valid(at_b)).to_numpy(zero_copy_only=False))
    cut_a, cut_b = at_a.take(pa.array(cut)).to_numpy() + 1, at_b.take(pa.array(cut)).to_numpy() + 1
    at_a, at_b = pc.fill_null_backward(at_a), pc.fill_null_backward(at_b)
    parent = pc.list_parent_indices(ids_a).to_numpy()
    kept = int(keep.sum())
    per_doc = np.bincount(parent[cut_a - 1], minlength=kept) if kept else np.zeros(0, np.int64)
    n_links = np.bincount(parent[at_a.to_numpy()], minlength=kept) if kept else np.zeros(0, np.int64)
    found = {
        "n_a": pc.list_value_length(ids_a).to_numpy(), "n_b": pc.list_value_length(ids_b).to_numpy(),
        "n_groups": per_doc, "n_links": n_links,
    }
    spread = {}
    for name, values in found.items():
        spread[name] = np.zeros(rows, np.int64)
        spread[name][keep] = values
    digests = np.full(rows, "", object)
    digests[keep] = _digests(ids_a, ids_b, cut_a, cut_b, per_doc)
    docs = pa.table(spread | {"groups_sha256": pa.array(digests, pa.string())})
    high = pc.shift_left(pc.list_flatten(ids_a).cast(pa.int64()).take(at_a), 32)
    pair = pc.bit_wise_or(high, pc.list_flatten(ids_b).cast(pa.int64()).take(at_b))
    place = pair.dictionary_encode()
    counts = pa.table({"place": place.indices}).group_by("place", use_threads=False).aggregate([("place", "count")])
    counts = counts.sort_by("place")
    pairs = pa.table({"pair": place.dictionary, "n": counts.column("place_count")})
    return docs, pairs, place.indices


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(data) as reader:
        return reader.read_all()


def _blocks(byte_path: str, piece_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for block in blocks_of(batches, "text", BLOCK_BYTES):
            docs, pairs, places = align_block(block.column("text"), byte_path, piece_path)
            docs = docs.add_column(0, "doc_id", block.column("doc_id"))
            one = {
                "block": [f"{task}-{number}"],
                "pairs": pa.array([pairs.column("pair").to_numpy()], pa.list_(pa.int64())),
                "counts": pa.array([pairs.column("n").to_numpy()], pa.list_(pa.int64())),
                "docs": pa.array([_packed(docs)], pa.binary()),
                "links": pa.array([_packed(pa.table({"place": places}))], pa.binary()),
            }
            number += 1
            yield pa.RecordBatch.from_pydict(one)

    return run


def _finish(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of one block, beside the corpus-wide totals of the block's id pairs."""
    docs = _unpacked(left.column("docs")[0].as_py())
    place = _unpacked(left.column("links")[0].as_py()).column("place")
    own = pa.table({"pair": left.column("pairs")[0].values, "place": pa.array(np.arange(len(left.column("pairs")[0].values)))})
    totals = own.join(right.select(["pair", "total", "best"]), "pair", use_threads=False).sort_by("place")
    n_links = docs.column("n_links").to_numpy()
    doc = pa.array(np.repeat(np.arange(docs.num_rows), n_links))
    links = pa.table({
        "doc": doc,
        "total": totals.column("total").take(place),
        "best": totals.column("best").take(place).cast(pa.int64()),
    })
    sums = links.group_by("doc", use_threads=False).aggregate([("total", "sum"), ("best", "sum")])
    at = sums.column("doc").to_numpy()
    spread = {}
    for name, column in (("n_best", "best_sum"), ("count_sum", "total_sum")):
        spread[name] = np.zeros(docs.num_rows, np.int64)
        spread[name][at] = sums.column(column).to_numpy()
    docs = docs.append_column("n_best", pa.array(spread["n_best"])).append_column("count_sum", pa.array(spread["count_sum"]))
    return docs.select([field.split(" ")[0] for field in RESULT.split(", ")])


def pair_counts(blocks: DataFrame) -> DataFrame:
    """block and pair with the pair's corpus-wide number of links, and whether no other pair of its second id has more.

    The window holds the pairs of one second id, at most the first vocabulary.
    """
    parts = blocks.select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("_one"))
    parts = parts.select("block", F.col("_one.pairs").alias("pair"), F.col("_one.counts").alias("n"))
    totals = parts.groupBy("pair").agg(F.sum("n").alias("total"))
    second = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    totals = totals.withColumn("best", F.col("total") == F.max("total").over(Window.partitionBy(second)))
    return parts.select("block", "pair").join(totals, "pair")


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256, one row per document.

    A is the byte-level tokenizer on a space and the text, B the piece tokenizer on the text, to
    which it adds a space; strings of special tokens are plain text.  Texts that are null or
    empty, or that a tokenizer does not give back byte by byte, have no tokens: zeros and ''.
    Repeated rows are documents of their own and count each time; ties for the highest count
    all count as best; null doc_ids are kept; an empty table gives no rows.  A text longer than
    a block is a block of its own.  Columns other than doc_id and text are not looked at.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    blocks = materialize(texts.mapInArrow(_blocks(byte_path, piece_path), BLOCK), "aligned")
    counts = pair_counts(blocks).withColumnRenamed("block", "_block")
    left = blocks.select("block", "pairs", "docs", "links").groupBy("block")
    return left.cogroup(counts.groupBy("_block")).applyInArrow(_finish, RESULT)
