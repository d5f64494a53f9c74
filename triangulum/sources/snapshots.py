"""Published tables: numbered versions of several outputs, seen all at once or not at all."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


class Snapshots:
    """Outputs below one folder; a manifest per publication names the path of every output.

    ``publish`` writes each output to a path of its own number and only then its manifest, by
    a rename that fails where the number is taken.  A write that fails leaves the newest
    manifest and every published path as they were; what it left behind is no output and goes
    with the next ``vacuum``.  Readers ask for the newest manifest once, or for a number, and
    keep reading its paths whatever is published meanwhile.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        files, path = self._at(folder)
        return [x.getPath().getName() for x in files.listStatus(path)] if files.exists(path) else []

    def numbers(self) -> list[int]:
        """Numbers of the publications, oldest first."""
        return sorted(int(n.removesuffix(".json")) for n in self._names("_published") if n[0].isdigit())

    def paths(self, number: int | None = None) -> dict[str, str]:
        """Output -> path, of one publication or of the newest."""
        known = self.numbers()
        if number is None and not known:
            raise ValueError(f"nothing is published at {self.path}")
        number = known[-1] if number is None else number
        if number not in known:
            raise ValueError(f"{self.path} has no publication {number}")
        text = self.spark.read.text(f"{self.path}/_published/{number}.json", wholetext=True).first()[0]
        return {name: f"{self.path}/{part}" for name, part in json.loads(text).items()}

    def read(self, name: str, number: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.paths(number)[name])

    def publish(self, outputs: Mapping[str, DataFrame]) -> int:
        """Write all outputs, then make them the newest publication; outputs not named stay as they are."""
        known = self.numbers()
        number = known[-1] + 1 if known else 0
        current = {n: p.removeprefix(f"{self.path}/") for n, p in self.paths().items()} if known else {}
        for name, df in outputs.items():
            part = f"{name}/version={number}"
            df.write.mode("overwrite").parquet(f"{self.path}/{part}")
            current[name] = part
        self._swap(number, current)
        return number

    def _swap(self, number: int, current: Mapping[str, str]) -> None:
        files, target = self._at(f"_published/{number}.json")
        _, draft = self._at(f"_published/.draft-{number}")
        out = files.create(draft, True)
        out.write(bytearray(json.dumps(dict(current)).encode()))
        out.close()
        if files.exists(target) or not files.rename(draft, target):
            raise ValueError(f"{target} is there already: another writer published")

    def vacuum(self, keep: int = 1) -> None:
        """Remove all but the newest publications, and what failed writes left; older readers must be done."""
        kept = self.numbers()[-keep:]
        live = {p for n in kept for p in self.paths(n).values()}
        files, _ = self._at("")
        for name in self._names(""):
            for part in self._names(name) if not name.startswith(("_", ".")) else ():
                if part.startswith("version=") and f"{self.path}/{name}/{part}" not in live:
                    files.delete(self._at(f"{name}/{part}")[1], True)
        for number in set(self.numbers()) - set(kept):
            files.delete(self._at(f"_published/{number}.json")[1], True)
