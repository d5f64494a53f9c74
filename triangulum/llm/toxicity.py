"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text.  A window
is a word; it is compressed with either dictionary behind a short carrier that both hold,
so that even a word is coded by matches and never stored raw.  The two compressed lengths
and the window's own length make a cell, and the cell's log ratio of toxic to ordinary
texts is the window's weight.  A text is judged by its heaviest windows; their sum and the
number of windows it was chosen from are calibrated to a probability.

The dictionaries are fitted on a bounded sample of labelled texts.  The cells' weights and
the calibration count every other labelled text, and every text is scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from math import log
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks_of, materialize, rows_of, text_of

FOLDS, HELD_OUT, CUT = 3, 1, 0.7
# Bounds of the fitted sample: ordinary and toxic texts for the dictionaries, the same for refining the toxic
# one, and distinct windows kept of a text.
FIT_TEXTS, WEIGH_TEXTS, TEXT_WINDOWS = (1000, 1500), (2500, 1500), 300
FIT_SHARE = 0.5  # of the labelled texts; the rest weighs cells and calibrates
FIRST_BYTES, REFINED_BYTES, REFINEMENTS, LEAN = 110 << 10, 16 << 10, 4, 2.0
LEVEL, MIN_MATCH = 19, 3
CARRIER = b"0123456789 jump "
WINDOW_BYTES, HEAVIEST, SMOOTHING = 48, 3, 3.0
MEMO = 400_000
BROADCAST_BYTES = 64 << 20

# Signs of ASCII part words as white space does, and so do the four separators, which bytes.split leaves.
_SIGNS = bytes(32 if c < 127 and not chr(c).isalnum() and (c > 32 or chr(c).isspace()) else c for c in range(256))
# White space beyond ASCII.
_WIDE = re.compile("[" + "".join(c for c in map(chr, range(128, 0x10000)) if c.isspace()) + "]")

Cells = dict[int, float]


def windows(text: str) -> set[bytes]:
    """The distinct words of a text in lower case; longer ones are cut into pieces."""
    text = text.lower()
    if not text.isascii():
        text = _WIDE.sub(" ", text)
    found = set(text.encode().translate(_SIGNS).split())
    for word in [w for w in found if len(w) > WINDOW_BYTES]:
        found.remove(word)
        found.update(word[at : at + WINDOW_BYTES] for at in range(0, len(word), WINDOW_BYTES))
    return found


def trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; too few samples to train on are the dictionary themselves."""
    groups = [b" " + b"  ".join(samples[at : at + 4]) + b" " for at in range(0, len(samples), 4)]
    try:
        return zstandard.train_dictionary(size, groups, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(samples))[:size]


class Distance:
    """Cells of windows: compressed length with either dictionary, and own length."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.sides = [self._compressor(d) for d in (ordinary, toxic)]

    @staticmethod
    def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
        content = zstandard.ZstdCompressionDict(raw + b" " + CARRIER)
        size = len(content.as_bytes())
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=128, dict_size=size, min_match=MIN_MATCH,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        content.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(compression_params=params, dict_data=content)

    def lengths(self, side: int, words: list[bytes]) -> list[int]:
        """Compressed length of every window with one dictionary."""
        if not words:
            return []
        packed = self.sides[side].multi_compress_to_buffer([CARRIER + b" " + w + b" " for w in words], threads=1)
        return [len(packed[i]) for i in range(len(words))]

    def cells(self, words: list[bytes], ordinary: list[int] | None = None) -> list[int]:
        """The cells; lengths with the ordinary dictionary may be known already."""
        ordinary = self.lengths(0, words) if ordinary is None else ordinary
        return [a << 16 | b << 8 | len(w) for a, b, w in zip(ordinary, self.lengths(1, words), words)]


def weights(ordinary: Counter, toxic: Counter) -> Cells:
    """Smoothed log ratio of a cell's share of the windows of toxic and of ordinary texts."""
    all_ordinary, all_toxic = sum(ordinary.values()), sum(toxic.values())
    if not all_ordinary or not all_toxic:
        return {}
    prior = SMOOTHING * all_toxic / all_ordinary
    return {
        c: log((toxic[c] + prior) / all_toxic) - log((ordinary[c] + SMOOTHING) / all_ordinary)
        for c in ordinary.keys() | toxic.keys()
    }


def total(found: Iterable[float]) -> float:
    """Sum of the largest weights of a text's windows, none of them negative."""
    return float(sum(sorted(found, reverse=True)[:HEAVIEST]))


def _counted(texts: list[list[bytes]], known: dict[bytes, int]) -> Counter:
    return Counter(known[w] for words in texts for w in words)


def dictionaries(fit: dict[int, list[list[bytes]]], weigh: dict[int, list[list[bytes]]]) -> tuple[bytes, bytes]:
    """Ordinary and toxic dictionary from the windows of sampled texts, by label.

    Toxic texts are mostly ordinary words.  So the first toxic dictionary is trained on all
    their windows, and later ones on those windows whose cells lean to toxic texts, as
    counted on texts that no dictionary has seen.
    """
    ordinary = trained([w for words in fit[0] for w in words], FIRST_BYTES)
    toxic = trained([w for words in fit[1] for w in words], FIRST_BYTES)
    every = sorted({w for part in (*weigh.values(), fit[1]) for words in part for w in words})
    by_ordinary = Distance(ordinary, toxic).lengths(0, every)
    for _ in range(REFINEMENTS):
        known = dict(zip(every, Distance(ordinary, toxic).cells(every, by_ordinary)))
        cells = weights(_counted(weigh[0], known), _counted(weigh[1], known))
        leaning = [w for words in fit[1] for w in words if cells.get(known[w], 0.0) > LEAN]
        if not leaning:
            break
        toxic = trained(leaning, REFINED_BYTES)
    return ordinary, toxic


def logistic(points: dict[tuple[float, float, int], int], steps: int = 50) -> list[float]:
    """Weights of the sum, the logarithm of the windows and 1 for the log odds of label 1, by damped Newton steps."""
    rows = np.array([[s, n, 1.0] for s, n, _ in points])
    y = np.array([label for *_, label in points], float)
    times = np.array(list(points.values()), float)
    if not len(rows) or y.min() == y.max():
        return [0.0, 0.0, 40.0 if len(rows) and y[0] else -40.0]
    found, ridge = np.array([0.0, 0.0, log((times * y).sum() / (times * (1 - y)).sum())]), 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ found, -40, 40)))
        slope = rows.T @ (times * (y - p)) - ridge * found
        bend = (rows * (times * p * (1 - p))[:, None]).T @ rows + ridge * np.eye(3)
        step = np.linalg.solve(bend, slope)
        found = found + step / max(1.0, float(np.abs(step).max()))
    return found.tolist()


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic and a number in 0 to 1 of the distinct texts of labelled documents outside the held-out fold.

    A text with both labels counts as toxic.  Documents meet their labels without moving:
    the labels are broadcast while their counted rows fit 64 MB.
    """
    known = labels.filter(F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    small = known.count() * 24 <= BROADCAST_BYTES
    texts = docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    rows = texts.join(F.broadcast(known) if small else known, "doc_id").filter("text != ''")
    keyed = rows.withColumn("key", F.md5("text"))
    first = keyed.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    first = materialize(first, "labelled")
    few = first.count() * 64 <= BROADCAST_BYTES
    rows = texts.withColumn("key", F.md5("text")).join(F.broadcast(first) if few else first, ["doc_id", "key"])
    # Repeated rows agree in doc_id and key and are folded; the share decides what a text is used for.
    share = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / (1 << 20)
    return rows.groupBy("doc_id", "key").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic", share.alias("share"))


def shuffled(text: str) -> bytes:
    """Bounded windows of a text in an order that differs between texts, so that no two keep the same neighbours."""
    salt = crc32(text.encode())
    return b" ".join(sorted(windows(text), key=lambda w: (crc32(w, salt), w))[:TEXT_WINDOWS])


def _sampled(rows: DataFrame, most: tuple[int, int]) -> list[list[list[bytes]]]:
    """Windows of a bounded sample of texts, by label 0 and 1."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            kept = [shuffled(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(kept, pa.binary())], names=["toxic", "words"])

    found = []
    for label in (0, 1):
        picked = rows.filter(F.col("toxic") == label).select(F.col("toxic").cast("int"), "text", "share")
        picked = picked.orderBy("share", F.md5("text")).limit(most[label])
        found.append([r.words.split(b" ") for r in picked.mapInArrow(cut, "toxic int, words binary").collect() if r.words])
    return found


class Scorer:
    """Windows of whole texts by cell, or by weight where the cells' weights are known; windows met before are kept.

    No weight below zero counts.  So a window whose length with the toxic dictionary is in no
    cell of positive weight weighs nothing, and needs no second compression.
    """

    def __init__(self, ordinary: bytes, toxic: bytes, cells: Cells | None = None):
        self.distance, self.cells = Distance(ordinary, toxic), cells
        self.memo: dict[bytes, float] = {}
        self.heavy = {c & 0xFFFF for c, w in (cells or {}).items() if w > 0}

    def _known(self, words: list[bytes]) -> list[float]:
        if self.cells is None:
            return self.distance.cells(words)
        low = [b << 8 | len(w) for b, w in zip(self.distance.lengths(1, words), words)]
        at = [i for i, c in enumerate(low) if c in self.heavy]
        found = [0.0] * len(words)
        for i, a in zip(at, self.distance.lengths(0, [words[i] for i in at])):
            found[i] = max(0.0, self.cells.get(a << 16 | low[i], 0.0))
        return found

    def found(self, texts: list[str]) -> list[list[float]]:
        """Cells or weights of the windows of every text."""
        split, memo = [windows(t) for t in texts], self.memo
        fresh = {w for words in split for w in words if w not in memo}
        if len(memo) + len(fresh) > MEMO:
            memo.clear()
            fresh = set().union(*split)
        ordered = sorted(fresh)
        memo.update(zip(ordered, self._known(ordered)))
        return [[memo[w] for w in words] for words in split]

    def sums(self, texts: list[str]) -> list[tuple[float, int]]:
        """The sum of every text and the number of its windows."""
        return [(total(found), len(found)) for found in self.found(texts)]


def _cells(ordinary: bytes, toxic: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(ordinary, toxic)
        for part in rows_of(batches):
            for batch in blocks_of([part], "text", 1 << 20):
                found = scorer.found(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "cells"]
                )

    return run


def _sums(ordinary: bytes, toxic: bytes, cells: Cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(ordinary, toxic, cells)
        for part in rows_of(batches):
            for batch in blocks_of([part], "text", 1 << 20):
                sums, sizes = zip(*scorer.sums(batch.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sums, pa.float64()), pa.array(sizes, pa.int32())],
                    names=["doc_id", "_sum", "_n"],
                )

    return run


def _of_cells(cells: Cells) -> Column:
    """A text's sum from its list of cells, as a column."""
    if not cells:
        return F.lit(0.0)
    table = F.create_map(*[F.lit(x) for c, w in sorted(cells.items()) for x in (c, max(0.0, w))])
    weight = F.transform("cells", lambda c: F.coalesce(table[c], F.lit(0.0)))
    return F.aggregate(F.slice(F.sort_array(weight, asc=False), 1, HEAVIEST), F.lit(0.0), lambda s, x: s + x)


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Dictionaries, weights of the cells and of the calibration; only a score where a label has no texts."""
    rows = materialize(labelled_texts(docs, labels), "labelled-texts")
    kinds = {int(r.toxic > 0): r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rows = rows.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    if len(kinds) < 2:
        return {"score": 1.0 if 1 in kinds else 0.0}
    parts = [
        _sampled(rows.filter(F.col("share") < FIT_SHARE), FIT_TEXTS),
        _sampled(rows.filter(F.col("share") >= FIT_SHARE), WEIGH_TEXTS),
    ]
    ordinary, toxic = dictionaries(*[dict(enumerate(p)) for p in parts])
    rest = rows.filter(F.col("share") >= FIT_SHARE).select("toxic", "text")
    found = materialize(rest.mapInArrow(_cells(ordinary, toxic), "toxic int, cells array<int>"), "cells")
    each = found.select("toxic", F.explode("cells").alias("cell")).groupBy("toxic", "cell").agg(F.count("*").alias("n"))
    counts = {0: Counter(), 1: Counter()}
    for r in each.collect():  # at most a few thousand cells: three lengths below 100
        counts[r.toxic][r.cell] = r.n
    cells = weights(counts[0], counts[1])
    sums = found.select(F.round(_of_cells(cells), 1).alias("s"), F.round(F.log1p(F.size("cells")), 1).alias("n"), "toxic")
    points = {(r.s, r.n, r.toxic): r.times for r in sums.groupBy("s", "n", "toxic").agg(F.count("*").alias("times")).collect()}
    return {"ordinary": ordinary, "toxic": toxic, "cells": cells, "odds": logistic(points)}


def score(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per document.

    The score is the probability of toxic = 1.  Labels are learned from the documents whose
    crc32 of the doc_id modulo 3 is not 1; the others, and a null doc_id never, are held out.
    Null texts count as empty; a text without a word has the sum 0 and its score.  Equal texts
    have equal scores, repeated rows are documents of their own.  Where no labelled text is
    left of one kind, all scores are 1 or 0, as the other kind says; without any they are 0.
    An empty table gives no rows.  Of a label table with repeated or conflicting rows the
    highest label of a document counts.  Columns other than doc_id and text, and doc_id and
    toxic of the labels, are not looked at.
    """
    model = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    if "cells" in model:
        sums = _sums(model["ordinary"], model["toxic"], model["cells"])
        rows = rows.mapInArrow(sums, "doc_id bigint, _sum double, _n int")
        by_sum, by_size, offset = model["odds"]
        chance = 1 / (1 + F.exp(-(F.col("_sum") * by_sum + F.log1p("_n") * by_size + offset)))
    else:
        chance = F.lit(model["score"])
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), chance.alias("score")).withColumn(
        "predicted", (F.col("score") >= cut).cast("int")
    )
