"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring.  A row walks clockwise from the hash of
its key to the first point whose shard still has room; a full shard is passed over.
The walk is decided per arc, not per row: one count per arc goes to the driver (their
number is shards x vnodes, a parameter), which settles how many rows of each arc go to
which shard, and the rows then follow by their rank within the arc.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_of, with_row_number

VNODES = 64
SPAN = 1 << 32
CELL_ROWS = 100_000


@dataclass(frozen=True)
class Ring:
    """Points of the ring in clockwise order and the shard that owns each."""

    points: tuple[int, ...]
    owners: tuple[int, ...]

    @classmethod
    def build(cls, shards: int, vnodes: int = VNODES) -> Ring:
        """A shard's points depend on its own number alone, so another shard moves no point."""
        placed = {}
        for shard in range(shards):
            for v in range(vnodes):
                place = int.from_bytes(hashlib.sha256(f"{shard}/{v}".encode()).digest()[:4], "big")
                placed.setdefault(place, shard)
        points = tuple(sorted(placed))
        return cls(points, tuple(placed[p] for p in points))


@dataclass(frozen=True)
class Run:
    """Ranks lo to hi - 1 of an arc go to ``shard``, there from ``slot`` on."""

    arc: int
    lo: int
    hi: int
    shard: int
    slot: int


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Room per shard.  Without slack the rooms add up to the rows, so every shard ends exactly full."""
    if slack:
        return [max(1, -int(-rows * (1 + slack) // shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def settle(ring: Ring, counts: dict[int, int], room: list[int]) -> list[Run]:
    """Walk the overflow clockwise, one point per turn for every arc that still has rows."""
    n, left, used = len(ring.points), list(room), [0] * len(room)
    waiting = [(arc, 0, count) for arc, count in sorted(counts.items())]
    runs: list[Run] = []
    for step in range(n):
        still = []
        for arc, done, count in waiting:
            shard = ring.owners[(arc + step) % n]
            take = min(count - done, left[shard])
            if take:
                runs.append(Run(arc, done, done + take, shard, used[shard]))
                left[shard] -= take
                used[shard] += take
            if done + take < count:
                still.append((arc, done + take, count))
        waiting = still
    if waiting:
        raise ValueError("the shards have less room than there are rows")
    return runs


def _arc(position: Column, ring: Ring) -> Column:
    """Index of the first point at or after the position, clockwise."""
    points = F.array(*[F.lit(p) for p in ring.points])
    # A coarse table of 4096 sectors leaves few points to compare with.
    sectors = [[p for p in ring.points if p >> 20 < s] for s in range(4097)]
    first = F.array(*[F.lit(len(x)) for x in sectors])
    sector = F.shiftright(position, 20).cast("int")
    low, high = F.element_at(first, sector + 1), F.element_at(first, sector + 2)
    within = F.slice(points, low + 1, high - low)
    at = low + F.size(F.filter(within, lambda p: p < position))
    return F.pmod(at, F.lit(len(ring.points))).cast("int")


def place(rows: DataFrame, key: str, shards: int, vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """``rows`` with shard int and slot long (gapless from 0 in each shard).

    slack 0 fills all shards to counts at most one apart; with slack e no shard holds
    more than (1 + e) times the mean and fewer rows leave their first place.  Rows of
    one key share a place and overflow together, so equal keys end in as few shards as
    room allows.  Null keys are a key of their own.

    The rows are written once with a row number that breaks ties.  Arcs are counted in
    cells; a cell with more than 100,000 rows, because one key is that frequent or the
    table that large, is ranked in pieces.
    """
    taken = {c.lower() for c in rows.columns} & {"_row", "_position", "_arc", "_cell", "_piece", "shard", "slot"}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are in use")
    ring = Ring.build(shards, vnodes)
    position = F.pmod(F.xxhash64(F.col(key)), F.lit(SPAN))
    placed = with_row_number(rows).withColumn("_position", position)
    placed = materialize(placed.withColumn("_arc", _arc(F.col("_position"), ring)), "ring")
    cells = max(1, -(-placed.count() // (CELL_ROWS * len(ring.points))))
    placed = placed.withColumn("_cell", F.pmod(F.floor(F.col("_position") * cells / F.lit(SPAN // 4096)), F.lit(cells)))
    large = (
        placed.groupBy("_arc", "_cell").count().filter(F.col("count") > CELL_ROWS)
        .select("_arc", "_cell", F.ceil(F.col("count") / CELL_ROWS).alias("_pieces"))
    )
    placed = placed.join(large, ["_arc", "_cell"], "left").withColumn(
        "_piece", F.pmod(F.xxhash64("_row"), F.coalesce(F.col("_pieces"), F.lit(1)))
    )
    groups = materialize(placed.groupBy("_arc", "_cell", "_piece").agg(F.count("*").alias("_n")), "ring-cells")
    before = Window.partitionBy("_arc").orderBy("_cell", "_piece")
    groups = groups.withColumn("_before", F.sum("_n").over(before) - F.col("_n"))
    counts = {r["_arc"]: r["n"] for r in groups.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}
    runs = settle(ring, counts, capacities(sum(counts.values()), shards, slack))
    session = rows.sparkSession
    # At most shards x points rows, whatever the data.
    plan = session.createDataFrame(
        [(r.arc, r.lo, r.hi, r.shard, r.slot) for r in runs], "_arc int, _lo long, _hi long, shard int, _slot long"
    )
    rank = F.row_number().over(Window.partitionBy("_arc", "_cell", "_piece").orderBy("_position", "_row"))
    ranked = placed.join(groups.drop("_n"), ["_arc", "_cell", "_piece"]).withColumn(
        "_rank", F.col("_before") + rank - 1
    )
    within = (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi"))
    landed = ranked.alias("r").join(F.broadcast(plan).alias("p"), (F.col("r._arc") == F.col("p._arc")) & within)
    slot = (F.col("_slot") + F.col("_rank") - F.col("_lo")).alias("slot")
    return landed.select(*[F.col(f"r.`{c}`") for c in rows.columns], "shard", slot)


def shard_documents(docs: DataFrame, shards: int = 16, vnodes: int = VNODES) -> DataFrame:
    """doc_id, size, text_crc32 and place of every document, counts at most one apart.

    A null text has size 1 and the checksum of the empty string.  An empty table gives
    no rows; columns other than doc_id and text are not looked at.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text_of()) + 1).cast("bigint").alias("size"),
        F.crc32(text_of()).alias("text_crc32"),
    )
    return place(rows, "doc_id", shards, vnodes)
