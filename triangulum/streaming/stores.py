"""Keyed parquet tables that grow by batches: an extendible-hash directory of buckets, and mergeable partials.

A store is a sequence of versions and one manifest per version.  The manifest names the live
buckets, each a set of low bits of the key's hash, and the versions that hold rows of it.
A merge writes the whole state of the keys of its batch, and of no others; readers take
every key from its newest version.  A bucket that has taken more rows than it may hold is
rewritten alone: it is split by one more bit, or, if one key fills it, only folded.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sketches
from ..operators.skew import bounded_broadcast

BUCKET_ROWS = 5_000_000
# Bits by which a bucket is split at once, at most.
SPLIT_BITS = 6
# A split that leaves less than this share of the rows on one side is not worth it: one key fills the bucket.
LEAST_SHARE = 0.1
# Directories up to this depth are a literal array, deeper ones a joined table.
LITERAL_DEPTH = 12


@dataclass(frozen=True)
class Bucket:
    """Rows whose key hash ends in ``bits`` (``depth`` of them); ``rows`` bounds what it holds or took since it was folded."""

    depth: int
    bits: int
    rows: int = 0
    versions: tuple[int, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.depth}_{self.bits}"

    def halves(self) -> tuple[Bucket, Bucket]:
        return Bucket(self.depth + 1, self.bits), Bucket(self.depth + 1, self.bits | 1 << self.depth)


@dataclass(frozen=True)
class Manifest:
    version: int = -1
    buckets: dict[str, Bucket] = field(default_factory=dict)
    marks: dict[str, int] = field(default_factory=dict)  # stream -> newest batch merged


class KeyedStore:
    """Rows by key in extendible-hash buckets; one writer at a time.

    ``buckets`` is the number a new store starts with, a power of two that readers must
    repeat; it grows as buckets pass ``bucket_rows``.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64, bucket_rows: int = BUCKET_ROWS
    ) -> None:
        if buckets < 1 or buckets & (buckets - 1):
            raise ValueError(f"the first number of buckets must be a power of two, not {buckets}")
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.buckets, self.bucket_rows = buckets, bucket_rows

    # --- files ---

    def _folder(self, name: str):
        """File system and path of a folder of this table."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _versions(self, name: str) -> dict[int, object]:
        """version -> path of the version folders below a folder."""
        files, path = self._folder(name)
        found = [x.getPath() for x in files.listStatus(path)] if files.exists(path) else []
        return {int(x.getName().split("=")[1]): x for x in found if x.getName().startswith("version=")}

    def _manifest(self) -> Manifest:
        """The newest committed manifest."""
        files, _ = self._folder("manifest")
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        done = [v for v, path in self._versions("manifest").items() if files.exists(path_of(path, "_SUCCESS"))]
        if not done:
            depth = self.buckets.bit_length() - 1
            first = [Bucket(depth, bits) for bits in range(self.buckets)]
            return Manifest(buckets={b.name: b for b in first})
        text = self.spark.read.text(f"{self.path}/manifest/version={max(done)}", wholetext=True).first()[0]
        found = json.loads(text)
        if found["first_buckets"] != self.buckets:
            raise ValueError(f"{self.path} was written with {found['first_buckets']} buckets first, not {self.buckets}")
        live = [Bucket(d, b, n, tuple(v)) for d, b, n, v in found["buckets"]]
        return Manifest(max(done), {b.name: b for b in live}, found["marks"])

    def _commit(self, manifest: Manifest) -> None:
        rows = [[b.depth, b.bits, b.rows, list(b.versions)] for b in manifest.buckets.values()]
        text = json.dumps({"first_buckets": self.buckets, "buckets": rows, "marks": manifest.marks})
        frame = self.spark.createDataFrame([(text,)], "value string").coalesce(1)
        frame.write.mode("overwrite").text(f"{self.path}/manifest/version={manifest.version}")

    # --- keys and buckets ---

    def _with_key(self, rows: DataFrame, marks: DataFrame, how: str) -> DataFrame:
        """Null-safe join on the key; the key columns of ``marks`` are called _k0, _k1, ..."""
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)]
        return rows.join(marks, reduce(Column.__and__, same), how)

    def _keys(self) -> list[Column]:
        return [F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)]

    def _in_buckets(self, rows: DataFrame, live: Mapping[str, Bucket]) -> DataFrame:
        """The rows with the name of their bucket."""
        depth = max(b.depth for b in live.values())
        slots = {}
        for b in live.values():
            for high in range(1 << (depth - b.depth)):
                slots[b.bits | high << b.depth] = b.name
        slot = F.xxhash64(*self.keys).bitwiseAND(F.lit((1 << depth) - 1).cast("bigint"))
        if depth <= LITERAL_DEPTH:
            names = F.array(*[F.lit(slots[i]) for i in range(1 << depth)])
            return rows.withColumn("bucket", F.get(names, slot.cast("int")))
        directory = self.spark.createDataFrame(list(slots.items()), "_slot bigint, bucket string")
        return rows.withColumn("_slot", slot).join(bounded_broadcast(directory), "_slot").drop("_slot")

    def _read(self, buckets: Sequence[Bucket]) -> DataFrame:
        """The rows of every key's newest version."""
        single = [b for b in buckets if len(b.versions) == 1]
        several = [b for b in buckets if len(b.versions) > 1]
        parts = []
        for some in (single, several):
            if some:
                paths = [f"{self.path}/data/version={v}/bucket={b.name}" for b in some for v in b.versions]
                parts.append(self.spark.read.option("basePath", f"{self.path}/data").parquet(*paths).drop("bucket"))
        if several:
            # Only keys changed since their bucket was rewritten have more than one version to choose from.
            rows = parts[-1]
            newest = rows.filter("NOT _base").groupBy(*self._keys()).agg(F.max("version").alias("_newest"))
            chosen = self._with_key(rows, newest, "left").filter("_newest IS NULL OR version = _newest")
            parts[-1] = chosen.select(rows.columns)
        return reduce(DataFrame.unionByName, parts).drop("version", "_base")

    def _write(self, rows: DataFrame, version: int, base: bool) -> dict[str, int]:
        """Write rows that know their bucket; the number of rows of each bucket."""
        # rebalance: one bucket per task, but a large bucket is split into several files
        (
            rows.withColumn("_base", F.lit(base))
            .hint("rebalance", F.col("bucket"))
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{self.path}/data/version={version}")
        )
        written = self.spark.read.schema("bucket string").parquet(f"{self.path}/data/version={version}")
        return {r.bucket: r.n for r in written.groupBy("bucket").agg(F.count("*").alias("n")).collect()}

    def _touched(self, keys: DataFrame, manifest: Manifest) -> list[Bucket]:
        """The buckets of some keys, as many rows as there are buckets at most."""
        found = self._in_buckets(keys, manifest.buckets).select("bucket").distinct().collect()
        return [manifest.buckets[r.bucket] for r in found]

    def _known(self, keys: DataFrame, touched: Sequence[Bucket]) -> DataFrame | None:
        """The stored rows of some keys, read from their buckets alone."""
        filled = [b for b in touched if b.versions]
        if not filled:
            return None
        return self._with_key(self._read(filled), keys.select(*self._keys()).distinct(), "left_semi")

    def _append(self, rows: DataFrame, manifest: Manifest, marks: Mapping[str, int] | None = None) -> None:
        """Commit the whole state of some keys as a new version, then rewrite the buckets that are too full."""
        version = manifest.version + 1
        counts = self._write(self._in_buckets(rows, manifest.buckets), version, base=version == 0)
        live = dict(manifest.buckets)
        for name, n in counts.items():
            b = live[name]
            live[name] = replace(b, rows=b.rows + n, versions=(*b.versions, version))
        after = Manifest(version, live, {**manifest.marks, **(marks or {})})
        self._commit(after)
        full = [b for b in live.values() if b.rows > self.bucket_rows]
        if full:
            self._rewrite(after, full)

    def _split(self, bucket: Bucket, counts: Mapping[int, int], bits: int = SPLIT_BITS) -> list[Bucket]:
        """The bucket cut by further bits until its parts fit; ``counts`` has its rows by the next ``bits`` bits."""
        total = sum(counts.values())
        sides = [{c >> 1: n for c, n in counts.items() if c & 1 == side} for side in (0, 1)]
        least = min(sum(x.values()) for x in sides)
        if total <= self.bucket_rows or not bits or least < LEAST_SHARE * total:
            return [replace(bucket, rows=0, versions=())]
        return [part for half, own in zip(bucket.halves(), sides) for part in self._split(half, own, bits - 1)]

    def _rewrite(self, manifest: Manifest, full: Sequence[Bucket]) -> None:
        """Split, or only fold, the buckets that are too full into one new version."""
        bits = F.expr(f"shiftrightunsigned(xxhash64({', '.join(f'`{k}`' for k in self.keys)}), int(split(bucket, '_')[0]))")
        rows = self._in_buckets(self._read(full), manifest.buckets)
        ahead = rows.groupBy("bucket", bits.bitwiseAND(F.lit((1 << SPLIT_BITS) - 1)).alias("next")).agg(F.count("*").alias("n"))
        counts: dict[str, dict[int, int]] = {}
        for r in ahead.collect():  # 2^SPLIT_BITS rows for each full bucket at most
            counts.setdefault(r.bucket, {})[r.next] = r.n
        live = dict(manifest.buckets)
        for b in full:
            del live[b.name]
            live.update({part.name: part for part in self._split(b, counts[b.name])})
        version = manifest.version + 1
        written = self._write(self._in_buckets(self._read(full), live), version, base=True)
        for name, n in written.items():
            # a bucket that one key fills counts from here on, so that it is folded again only after as many new rows
            live[name] = replace(live[name], rows=n if n <= self.bucket_rows else 0, versions=(version,))
        self._commit(Manifest(version, live, manifest.marks))

    # --- maintenance and reading ---

    def compact(self) -> None:
        """Fold the versions of every bucket that has several; a maintenance step, no part of an update."""
        manifest = self._manifest()
        several = [b for b in manifest.buckets.values() if len(b.versions) > 1]
        if several:
            live, version = dict(manifest.buckets), manifest.version + 1
            counts = self._write(self._in_buckets(self._read(several), live), version, base=True)
            live.update({n: replace(live[n], rows=c, versions=(version,)) for n, c in counts.items()})
            self._commit(Manifest(version, live, manifest.marks))

    def vacuum(self) -> None:
        """Remove versions and manifests that the newest manifest does not name; no reader may be at work."""
        manifest = self._manifest()
        kept = {"data": {v for b in manifest.buckets.values() for v in b.versions}, "manifest": {manifest.version}}
        for name, versions in kept.items():
            files, _ = self._folder(name)
            for version, path in self._versions(name).items():
                if version not in versions:
                    files.delete(path, True)

    def depths(self) -> dict[str, int]:
        """Name and depth of every live bucket."""
        return {b.name: b.depth for b in self._manifest().buckets.values()}

    def rows(self) -> DataFrame:
        """The newest state of every key."""
        filled = [b for b in self._manifest().buckets.values() if b.versions]
        if not filled:
            raise ValueError(f"nothing at {self.path}")
        return self._read(filled)


# How a partial of each kind is made from rows and merged with others.
_MADE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "sketch": sketches.sketch}
_MERGED = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "sketch": sketches.merged}


class PartialTable(KeyedStore):
    """Aggregates by key as mergeable partials, brought up to date with the partials of new rows alone.

    ``partials`` maps a name to (kind, input column): sums, counts, extremes and quantile sketches
    (those merge, but estimate; see ``operators.sketches``).  Sums of doubles
    are kept as decimals, so that the state does not depend on how rows were dealt to batches.
    A partial is not idempotent; so every batch carries its stream's name and number, the manifest
    keeps the newest number of each stream, and a batch that comes again is passed over.  Counts
    of rows per key are kept as ``_rows``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Mapping[str, Column | str],
        partials: Mapping[str, tuple[str, Column | str]],
        buckets: int = 16,
        bucket_rows: int = BUCKET_ROWS,
    ) -> None:
        super().__init__(spark, path, list(keys), buckets, bucket_rows)
        self.key_columns, self.partials = dict(keys), dict(partials)

    def partials_of(self, rows: DataFrame) -> DataFrame:
        """One row per key of the rows, combined before the shuffle."""
        keys = [(F.expr(c) if isinstance(c, str) else c).alias(n) for n, c in self.key_columns.items()]
        made = []
        for name, (kind, column) in self.partials.items():
            value = F.expr(column) if isinstance(column, str) else column
            made.append(_MADE[kind](value.cast("decimal(28,6)") if kind == "sum" else value).alias(name))
        return rows.groupBy(*keys).agg(*made, F.count("*").alias("_rows"))

    def merge(self, batch: DataFrame, stream: str, number: int) -> bool:
        """Add a batch; False where it has been added before."""
        manifest = self._manifest()
        if manifest.marks.get(stream, -1) >= number:
            return False
        fresh = self.partials_of(batch).persist()
        try:
            touched = self._touched(fresh, manifest)
            if touched:
                known = self._known(fresh, touched)
                self._append(fresh if known is None else self._merged(known, fresh), manifest, {stream: number})
            return True
        finally:
            fresh.unpersist()

    def _merged(self, known: DataFrame, fresh: DataFrame) -> DataFrame:
        kinds = {n: kind for n, (kind, _) in self.partials.items()} | {"_rows": "count"}
        both = known.unionByName(fresh)
        merged = [_MERGED[k](n).cast(both.schema[n].dataType).alias(n) for n, k in kinds.items()]
        return both.groupBy(*self.keys).agg(*merged)


def partial_stream(source: DataFrame, table: PartialTable, checkpoint: str, after: Callable[[int], None] | None = None):
    """Add every available micro-batch of an append-only stream to the partials.

    The checkpoint names the stream: a retried batch is added once.  With another checkpoint
    the source is read anew, which is a full refresh and needs a new table.
    """

    def fold(batch: DataFrame, number: int) -> None:
        table.merge(batch, checkpoint, number)
        if after is not None:
            after(number)

    query = (
        source.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
