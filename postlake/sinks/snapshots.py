"""Tables whose folders are listed in snapshots.

A snapshot is a small JSON file that names, for each slot of a table (a hash bucket, a day), the folder that holds its rows
now. Writers put new rows into new folders and then commit the next snapshot, so a reader sees the rows of one snapshot
whatever is written meanwhile, and a writer that fails leaves nothing but folders that no snapshot names. One writer
at a time: a commit that finds another one since its base is refused.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another writer has committed in between."""


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    slots: dict[str, str] = field(default_factory=dict)
    meta: dict = field(default_factory=dict)


class Snapshots:
    """The snapshots of the table below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _system(self):
        return self._path("snapshots").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        folder, system = self._path("snapshots"), self._system()
        if not system.exists(folder):
            return []
        names = [x.getPath().getName() for x in system.listStatus(folder)]
        return sorted(int(x.removesuffix(".json")) for x in names if x.endswith(".json"))

    def read(self, number: int | None = None) -> Snapshot:
        """A snapshot, by default the latest one. Before the first there is an empty one, number 0."""
        known = self.numbers()
        number = (known[-1] if known else 0) if number is None else number
        if number == 0:
            return Snapshot()
        stream = self._system().open(self._path(f"snapshots/{number:012d}.json"))
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Snapshot(number, found["slots"], found["meta"])

    def commit(self, base: Snapshot, slots: dict[str, str], meta: dict, branch: bool = False) -> Snapshot:
        """The next snapshot. With ``branch`` it may follow on an older one, for a table whose current snapshot is
        named elsewhere."""
        latest = max(self.numbers(), default=0)
        if latest != base.number and not branch:
            raise Conflict(f"{self.root} is at snapshot {latest}, not {base.number}")
        number, system = latest + 1, self._system()
        system.mkdirs(self._path("snapshots"))
        hidden, final = self._path(f"snapshots/.{uuid.uuid4().hex}"), self._path(f"snapshots/{number:012d}.json")
        file = system.create(hidden, False)
        file.write(json.dumps({"slots": slots, "meta": meta}).encode())
        file.close()
        if system.exists(final) or not system.rename(hidden, final):
            raise Conflict(f"snapshot {number} of {self.root} is there already")
        return Snapshot(number, slots, meta)

    def new_folder(self) -> str:
        """The name of a folder for new rows, below ``root``."""
        return f"data/{uuid.uuid4().hex}"

    def parts(self, folder: str) -> list[str]:
        """The partitions (``name=value``) that a write has left in a folder."""
        found = self._system().listStatus(self._path(folder))
        return [x.getPath().getName() for x in found if "=" in x.getPath().getName()]

    def remove(self, folder: str) -> None:
        """Remove a folder that no snapshot names."""
        self._system().delete(self._path(folder), True)

    def rows(self, snapshot: Snapshot, row_type: T.StructType, slots=None) -> DataFrame:
        """The rows of a snapshot, or of some of its slots; only their folders are listed and read."""
        names = sorted(snapshot.slots) if slots is None else sorted(x for x in slots if x in snapshot.slots)
        if not names:
            return self.spark.createDataFrame([], row_type)
        return self.spark.read.schema(row_type).parquet(*[f"{self.root}/{snapshot.slots[x]}" for x in names])

    def expire(self, keep: int = 1) -> int:
        """Remove all but the last ``keep`` snapshots, and the folders that only they name. Gives the folders removed."""
        numbers, system = self.numbers(), self._system()
        kept = {f for n in numbers[-keep:] for f in self.read(n).slots.values()}
        gone = {f for n in numbers[:-keep] for f in self.read(n).slots.values()} - kept
        for number in numbers[:-keep]:
            system.delete(self._path(f"snapshots/{number:012d}.json"), False)
        for folder in gone:
            self.remove(folder)
        return len(gone)
