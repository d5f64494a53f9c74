"""Token ids as Arrow stream files of fixed-size lists.

A file holds one ordered part of the corpus: the ids of its documents one after the
other, cut into sequences of equal length, with a mask that is false on the padding of
the last one.  All batches but the last have the same number of sequences, so a token's
place follows from its number, and a memory-mapped file is read without a copy.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_of, materialize, scratch_path, text_of, with_row_number

SEQUENCE = 1024
BATCH_SEQUENCES = 256
MEMO = 400_000
# Signs that make one pre-token when they follow letters; apostrophes do not.
SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "'<|>")


def id_type(vocabulary: int) -> np.dtype:
    """The narrowest unsigned type that holds every id."""
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


class Encoder:
    """The tokenizer's ids of whole texts, as little-endian bytes.

    A byte-level tokenizer's pre-tokens never cross a single space from a sign to a sign,
    so a text is cut there.  Runs of letters, which are one pre-token each, are encoded once,
    many in one call, the signs after them on their own, and other pieces one by one.  The
    memo keeps the runs and other pieces met last.  A text with a piece that is empty, that begins or ends
    with white space or that holds a special token's string goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = id_type(self.tokenizer.get_vocab_size(with_added_tokens=True))
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[str, bytes] = {}  # a piece that must not be cut off has no ids here
        self.older: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def head(self, piece: str) -> bytes:
        """Ids of a text's first piece, which has no space before it; empty where no cut may follow."""
        if not self.plain(piece):
            return b""
        if piece not in self.heads:
            if len(self.heads) >= MEMO:
                self.heads.clear()
            self.heads[piece] = self.whole(piece)
        return self.heads[piece]

    def plain(self, piece: str) -> bool:
        return piece != "" and piece.strip() == piece and not any(a in piece for a in self.added)

    def _letters(self, runs: list[str]) -> None:
        """Encode runs of letters, each after a space, in one call; each is one pre-token."""
        if not runs:
            return
        encoded = self.tokenizer.encode(" " + " ".join(runs), add_special_tokens=False)
        words = np.array(encoded.word_ids)
        if int(words[-1]) + 1 != len(runs):
            self.memo.update((x, self.whole(" " + x)) for x in runs)
            return
        raw = np.array(encoded.ids, self.dtype).tobytes()
        at = (np.searchsorted(words, np.arange(len(runs) + 1)) * self.dtype.itemsize).tolist()
        self.memo.update(zip(runs, map(raw.__getitem__, map(slice, at, at[1:]))))

    def _recall(self, runs: list[str], others: list[str]) -> None:
        """Bring distinct runs of letters and other pieces, each after a space, into the memo."""
        if len(self.memo) > MEMO:  # what was not met since the last time goes
            self.older, self.memo = self.memo, {}
        memo, older = self.memo, self.older
        for x in (*runs, *others) if older else ():
            if x not in memo and x in older:
                memo[x] = older[x]
        self._letters([x for x in runs if x not in memo])
        memo.update((x, self.whole(" " + x) if self.plain(x) else b"") for x in others if x not in memo)

    def _sign(self, signs: str) -> bytes:
        if signs not in self.signs:
            if len(self.signs) >= MEMO:
                self.signs.clear()
            self.signs[signs] = self.whole(signs)
        return self.signs[signs]

    def _known(self, pieces: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Entries of ids, and two per distinct piece after a space: its run (or all of it) and its signs.

        Where there are no signs the second number is -1.
        """
        trimmed = pc.utf8_rtrim(pieces, SIGNS)
        signs = pc.subtract(pc.binary_length(pieces), pc.binary_length(trimmed)).to_numpy()
        runs = trimmed.dictionary_encode()
        names, first = runs.dictionary.to_pylist(), runs.indices.to_numpy().astype(np.int64)
        letters = np.fromiter(map(str.isalpha, names), bool, len(names))
        in_run = letters[first]
        other = np.flatnonzero(~in_run)
        others = pieces.take(pa.array(other)).to_pylist()
        self._recall([x for x, is_run in zip(names, letters.tolist()) if is_run], others)
        entries = [*map(self.memo.get, names, repeat(b"")), *map(self.memo.__getitem__, others)]
        first[other] = np.arange(len(names), len(entries))
        second = np.full(len(pieces), -1)
        for k in np.unique(signs[in_run & (signs > 0)]).tolist():
            marked = np.flatnonzero(in_run & (signs == k))
            ends = pc.utf8_slice_codeunits(pieces.take(pa.array(marked)), start=-k).dictionary_encode()
            second[marked] = ends.indices.to_numpy() + len(entries)
            entries.extend(map(self._sign, ends.dictionary.to_pylist()))
        return entries, first, second

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and the number of ids of each text."""
        cut = pc.split_pattern(texts, " ")
        starts = cut.offsets.to_numpy()[:-1] - cut.offsets[0].as_py()
        words = cut.flatten().dictionary_encode()
        which = words.indices.to_numpy().copy()
        entries, first, second = self._known(words.dictionary)
        # A text's first piece has no space before it and gets an entry of its own.
        heads = words.dictionary.take(words.indices.take(pa.array(starts))).to_pylist()
        which[starts] = np.arange(len(first), len(first) + len(heads))
        first = np.concatenate([first, np.arange(len(entries), len(entries) + len(heads))])
        second = np.concatenate([second, np.full(len(heads), -1)])
        entries += [*map(self.head, heads), b""]  # the last one stands for no signs
        second[second < 0] = len(entries) - 1
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // self.dtype.itemsize
        parts = _lists(sizes, pa.array(np.frombuffer(b"".join(entries), self.dtype)))
        both = parts.take(pa.array(np.stack([first, second], axis=1).ravel())).flatten()
        sizes = sizes[first] + sizes[second]
        flat = _lists(sizes, both).take(pa.array(which)).flatten().to_numpy()
        counts = np.add.reduceat(sizes[which], starts)
        uncut = np.flatnonzero(np.logical_or.reduceat(sizes[which] == 0, starts))
        if not len(uncut):
            return flat, counts
        parts = np.split(flat, np.cumsum(counts)[:-1])
        for k in uncut:
            parts[k] = np.frombuffer(self.whole(texts[int(k)].as_py()), self.dtype)
        return np.concatenate(parts), np.array([len(x) for x in parts])


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def schema(dtype: np.dtype, sequence: int) -> pa.Schema:
    ids = pa.from_numpy_dtype(dtype)
    return pa.schema([("input_ids", pa.list_(ids, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])


class SequenceWriter:
    """Streams ids into one Arrow stream file; holds at most one batch."""

    def __init__(self, sink, dtype: np.dtype, sequence: int = SEQUENCE, rows: int = BATCH_SEQUENCES):
        self.dtype, self.sequence, self.full = dtype, sequence, sequence * rows
        self.schema = schema(dtype, sequence)
        self.stream = pa.ipc.new_stream(sink, self.schema)
        self.held, self.count = [], 0

    def _batch(self, ids: np.ndarray) -> None:
        short = -len(ids) % self.sequence
        mask = np.ones(len(ids) + short, bool)
        if short:
            mask[len(ids) :] = False
            ids = np.concatenate([ids, np.zeros(short, self.dtype)])
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (ids, mask)]
        self.stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def write(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.count += len(ids)
        if self.count >= self.full:
            joined = np.concatenate(self.held)
            while len(joined) >= self.full:
                self._batch(joined[: self.full])
                joined = joined[self.full :]
            self.held, self.count = [joined], len(joined)

    def close(self) -> None:
        if self.count:
            self._batch(np.concatenate(self.held))
        self.stream.close()


class SequenceFile:
    """Random access to a written file; a local one is memory-mapped and not copied."""

    def __init__(self, uri: str):
        store, path = pafs.FileSystem.from_uri(uri)
        source = pa.memory_map(path) if isinstance(store, pafs.LocalFileSystem) else store.open_input_file(path)
        self.batches = list(pa.ipc.open_stream(source))
        self.sequence = self.batches[0].schema.field("input_ids").type.list_size if self.batches else SEQUENCE
        self.size = self.batches[0].num_rows * self.sequence if self.batches else 1

    def sequences(self, batch: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of a batch, one sequence per line; the ids are a view of the file."""
        ids = self.batches[batch].column("input_ids").flatten().to_numpy(zero_copy_only=True)
        mask = self.batches[batch].column("mask").flatten().to_numpy(zero_copy_only=False)
        return ids.reshape(-1, self.sequence), mask.reshape(-1, self.sequence)

    def ids(self, offset: int, count: int) -> Iterable[np.ndarray]:
        """The ids from ``offset`` on, as views, one per batch touched."""
        while count > 0:
            batch, at = divmod(offset, self.size)
            values = self.batches[batch].column("input_ids").flatten()
            view = values.slice(at, count).to_numpy(zero_copy_only=True)
            yield view
            offset, count = offset + len(view), count - len(view)


def part_uri(folder: str, part: int) -> str:
    return f"{folder}/part-{part:06d}.arrows"


def _write_part(folder: str, path: str, end_id: int, sequence: int, batch_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tokens = TaskContext.get().partitionId(), encoder(path)
        store, target = pafs.FileSystem.from_uri(part_uri(folder, part))
        draft, writer, at = f"{target}.{uuid.uuid4().hex}", None, 0
        for batch in blocks_of(batches, "text"):
            if writer is None:
                store.create_dir(target.rpartition("/")[0], recursive=True)
                sink = store.open_output_stream(draft)
                writer = SequenceWriter(sink, tokens.dtype, sequence, batch_rows)
            flat, counts = tokens.encode(batch.column("text"))
            # One end id after each document.
            flat = np.insert(flat, np.cumsum(counts), end_id)
            writer.write(flat)
            counts = counts + 1
            offsets = at + np.cumsum(counts) - counts
            at += len(flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(counts), part, np.int32)), pa.array(offsets),
                 pa.array(counts)],
                names=["doc_id", "part", "first", "n_tokens"],
            )
        if writer is not None:
            writer.close()
            sink.close()
            store.move(draft, target)  # a retried task replaces the file by an equal one

    return run


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    sequence: int = SEQUENCE,
    batch_rows: int = BATCH_SEQUENCES,
) -> DataFrame:
    """Encode all texts in ascending doc_id order into files below ``folder``; return their index.

    The index has doc_id, part (the file), first (place of its ids there) and n_tokens
    with the end id.  Null texts count as empty; null doc_ids come first; rows of one
    doc_id keep the order of the input.  An empty table writes no file.

    Texts cross the network once, by ranges of (doc_id, row), so no doc_id is too hot.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("_row")]
    rows = with_row_number(docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text")))
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    index = parts.mapInArrow(
        _write_part(folder, tokenizer, end_id, sequence, batch_rows),
        "doc_id bigint, part int, first bigint, n_tokens bigint",
    )
    return materialize(index, "token-index")


def _checksums(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[int, SequenceFile] | None = None
        for batch in batches:
            sums = []
            columns = (batch.column(c).to_pylist() for c in ("part", "first", "n_tokens"))
            for part, first, count in zip(*columns):
                if opened is None or opened[0] != part:
                    opened = part, SequenceFile(part_uri(folder, part))
                crc = 0
                for view in opened[1].ids(first, count):
                    crc = zlib.crc32(view.astype("<u4").tobytes(), crc)
                sums.append(crc)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "part", "first", "n_tokens")], pa.array(sums, pa.int64())],
                names=["doc_id", "part", "first", "n_tokens", "ids_crc32"],
            )

    return run


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """doc_id, start over all files, n_tokens and the checksum of the ids as read from the files."""
    turn = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("_ids"))
    before = sizes.select(F.col("part"), F.coalesce(F.sum("_ids").over(turn), F.lit(0)).alias("_before"))
    read = index.mapInArrow(
        _checksums(folder), "doc_id bigint, part int, first bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return read.join(before, "part").select(
        "doc_id", (F.col("_before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the token files of a table into the shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id), folder)
