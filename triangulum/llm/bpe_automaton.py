"""Byte-pair encoding as a deterministic automaton over tokens.

The automaton accepts exactly the token sequences that the merge list produces.  It
starts as one loop over the base symbols and grows by one gadget per merge u v -> w, in
the order of the list.  Every token's arcs end in a state of its own, so the gadget is:

* state w goes on as state v does at this moment,
* arc w leaves every state that arc u leaves at this moment (for u = v: but u's own),
* arc v no longer leaves state u.

States and arcs therefore keep what they took over and when (the rank of the merge); the
row of a state is read off that table when a transition is first asked for, and kept.
A pre-split word has one accepted path: its token ids are the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of, text_of

MEMO = 300_000
ARCS = 500_000
# Longer pieces and words are not kept, so that entries bound the bytes; texts are worked on in blocks.
KEPT_CHARS = 64
BLOCK = 1 << 17


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else from U+0100 on."""
    kept = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


class Automaton:
    """States and arcs are token ids; ``forbidden`` tells whether an arc leaves a state."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.token = vocabulary
        self.label = {i: t for t, i in vocabulary.items()}
        self.cut: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            u, v = vocabulary[left], vocabulary[right]
            w = vocabulary[left + right]
            if w in self.made:
                raise ValueError(f"two merges make {left + right!r}")
            self.made[w] = rank, u, v
            self.cut[u, v] = rank
        # The labels from their last symbol on as a trie: a symbol to what may stand before it, and the token or -1 where
        # it is none.
        self.ends: dict[str, list] = {}
        for label, token in vocabulary.items():
            n = len(label.removesuffix(suffix)) or 1
            level, node = self.ends, [None, -1]
            for symbol in (label[n - 1 :], *label[: n - 1][::-1]):
                if level is None:
                    level = node[0] = {}
                node = level.setdefault(symbol, [None, -1])
                level = node[0]
            node[1] = token
        self.arcs: dict[tuple[int, int], bool] = {}

    def forbidden(self, state: int, arc: int) -> bool:
        """Whether no transition reads ``arc`` in ``state`` once all gadgets are in place."""
        key = state, arc
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= ARCS:
                self.arcs.clear()
            known = self.arcs[key] = self._resolve(state, arc)
        return known

    def _resolve(self, state: int, arc: int) -> bool:
        now = len(self.cut)
        while True:
            if self.cut.get((state, arc), now) < now:
                return True
            born_state, born_arc = self.made.get(state), self.made.get(arc)
            if born_state is None and born_arc is None:
                return False
            if born_state is None or (born_arc is not None and born_arc[0] >= born_state[0]):
                now, u, v = born_arc
                if u == v and state == u:
                    return True
                if state == arc:  # the state took over v's arcs, the arc left where u left
                    state = v
                arc = u
            else:
                now, _, state = born_state

    def path(self, word: str, n: int) -> list[int]:
        """Token ids of a word of n base symbols: n characters, then the suffix of the last one."""
        arcs, symbols = self.arcs, [*word[: n - 1], word[n - 1 :]]
        last, back = [-1] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            level, start = self.ends, end
            while start and level is not None:
                start -= 1
                node = level.get(symbols[start])
                if node is None:
                    break
                level, arc = node
                if arc < 0:
                    continue
                # The one arc into this prefix that the state before it lets through.
                if start:
                    shut = arcs.get((last[start], arc))
                    if shut is None:
                        shut = self.forbidden(last[start], arc)
                    if shut:
                        continue
                last[end], back[end] = arc, start
                break
        found, end = [], n
        while end:
            found.append(last[end])
            end = back[end]
        return found[::-1]


class WordTokenizer:
    """Normalisation, pre-split and automaton of a word-level BPE file with byte symbols."""

    def __init__(self, path: str, memo: int = MEMO):
        self.limit = memo
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, self.suffix)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.symbols = byte_symbols()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.label = self.automaton.label | {i: s for s, i in self.special.items()}
        self.added = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.labels = pa.array([self.label.get(i) for i in range(max(self.label) + 1)], pa.large_binary())
        # The ids of pieces and words as little-endian 32-bit integers.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.met: dict[str, bytes] = {}

    @staticmethod
    def normalise(piece: str) -> str:
        # Lower case character by character: a final sigma stays a plain one.
        return unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()

    def word(self, word: str) -> bytes:
        """Ids of a lower-case word."""
        known = self.met.get(word)
        if known is None:
            # Letters and signs of ASCII are their own symbols.
            symbols = word if word.isascii() and word.isprintable() else "".join([self.symbols[b] for b in word.encode()])
            ids = self.automaton.path(symbols + self.suffix, len(symbols))
            known = struct.pack(f"<{len(ids)}I", *ids)
            if len(self.met) >= 2 * self.limit // 3:
                self.met.clear()
            if len(word) <= KEPT_CHARS:
                self.met[word] = known
        return known

    def split(self, piece: str) -> list[str]:
        """The words of a piece, lower case; a letter run with or without one mark after it needs no pattern."""
        piece = piece.lower() if piece.isascii() else self.normalise(piece)
        if piece.isalpha():
            return [piece]
        if piece[-1:] in (".", ",") and piece[:-1].isalpha():
            return [piece[:-1], piece[-1]]
        return self.words.findall(piece)

    def ids(self, piece: str) -> bytes:
        """Ids of a piece of text without white space."""
        if not self.added.search(piece):
            return b"".join(map(self.word, self.split(piece)))
        out = []
        for part in self.added.split(piece):
            if part in self.special:
                out.append(struct.pack("<I", self.special[part]))
            elif part:
                out += map(self.word, self.split(part))
        return b"".join(out)

    def encode(self, text: str) -> tuple[int, bytes, str]:
        """Number of ids, the ids as little-endian 32-bit integers, the decoded text."""
        blocks = [block for block in self.blocks(text) if block[0]]
        return sum(b[0] for b in blocks), b"".join([b[1] for b in blocks]), b" ".join([b[2] for b in blocks]).decode()

    def blocks(self, text: str) -> Iterator[tuple[int, bytes, bytes]]:
        """The same for consecutive blocks of a text, which end at white space; some may have no ids."""
        at = 0
        while at < len(text):
            cut = _WHITE.search(text, at + BLOCK)
            end = cut.start() if cut else len(text)
            raw = self._block(text[at:end])
            yield len(raw) // 4, raw, self._decoded(raw)
            at = end

    def _block(self, text: str) -> bytes:
        # White space only ever separates words; these four count as white space for str.split alone.
        pieces = _WHITE_RUN.split(text) if _SEPARATORS.search(text) else text.split()
        found = list(map(self.memo.get, pieces))
        for at in [i for i, known in enumerate(found) if known is None]:
            found[at] = self._piece(pieces[at])
        return b"".join(found)

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece, kept for the next time."""
        known = self.memo.get(piece)
        if known is not None:
            return known
        if len(self.memo) >= self.limit:  # pieces not met since the last time go
            self.older, self.memo = self.memo, {}
        known = self.older.get(piece)
        if known is None:
            known = self.ids(piece)
        if len(piece) <= KEPT_CHARS:
            self.memo[piece] = known
        return known

    def _decoded(self, raw: bytes) -> bytes:
        """The labels of the ids, parted by spaces."""
        labels = self.labels.take(pa.array(np.frombuffer(raw, "<u4")))
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(labels)], labels), pa.scalar(b" ", pa.large_binary()))
        return joined[0].as_py()

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids and of the decoded text, block by block."""
        count, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for n, raw, labels in self.blocks(text):
            if n:
                ids.update(raw)
                decoded.update(b" " + labels if count else labels)
                count += n
        return count, ids.hexdigest(), decoded.hexdigest()

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, parted by spaces (the file names no decoder)."""
        return " ".join(self.label[i] for i in ids if i in self.label)


_SEPARATORS = re.compile("[\x1c-\x1f]")
_WHITE = re.compile(r"[^\S\x1c-\x1f]")
_WHITE_RUN = re.compile(r"[^\S\x1c-\x1f]+")


@lru_cache(maxsize=1)
def tokenizer(path: str, memo: int = MEMO) -> WordTokenizer:
    return WordTokenizer(path, memo)


RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _encode(path: str, memo: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path, memo)
        for batch in rows_of(batches):
            found = [words.digest(text.as_py()) for text in batch.column("text")]
            counts, ids, decoded = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
                 pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def encode_ids(path: str):
    """mapInArrow function: doc_id and text to doc_id, ids array and the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        for batch in rows_of(batches, 128):
            found = [words.encode(t) for t in batch.column("text").to_pylist()]
            flat = np.frombuffer(b"".join(x[1] for x in found), "<u4").astype(np.int32)
            offsets = np.cumsum([0, *(x[0] for x in found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, flat), pa.array([x[2] for x in found], pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    return run


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and decoded text of every whole text; null texts count as empty and have no ids."""
    rows = docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    return rows.mapInArrow(encode_ids(path), "doc_id bigint, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, memo: int = MEMO) -> DataFrame:
    """doc_id, number of ids, and SHA-256 of ids and decoded text of every whole text.

    One pass without a shuffle; repeated rows give repeated results, an empty table none,
    and columns other than doc_id and text are not looked at.  A worker keeps the
    ``memo`` to twice ``memo`` pieces it met last, which changes speed and memory alone.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    return rows.mapInArrow(_encode(path, memo), RESULT)
