"""A log of micro-batches that merges itself."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import ranking
from millrace.session import child_names, publish_text, read_text, remove_dir

Reduce = Callable[[DataFrame], DataFrame]


def newest(keys: Sequence[str], latest_by: Sequence[str] = ("batch_id",)) -> Reduce:
    """Keep the newest row per key."""
    return lambda rows: ranking.dedup_keep_latest(rows, keys, list(latest_by))


@dataclass(frozen=True)
class Segment:
    """A folder with the rows of the batches ``first`` to ``last``, merged ``level`` times."""

    folder: str
    level: int
    first: int
    last: int


class LeveledLog:
    """What a stream emitted, in segments whose sizes grow geometrically.

    A batch becomes a segment of level 0. Where ``fan_in`` segments of a level
    have come together they are merged into one of the next level, and
    ``reduce`` keeps what readers need of their rows. So a row is written once
    per level, a batch costs the batch (and its share of merges), and reading
    opens at most ``fan_in`` segments a level, whatever the number of batches.

    One manifest names the live segments; it is replaced as a whole, by a
    rename, and what it does not name does not count. Writing a batch again
    replaces its segment: the newest batch is never merged, as it may come again
    after a failure, and those before it never do. Folders that a merge has
    replaced are deleted one batch later, so readers of the manifest before can
    end; a writer that died at any point leaves folders that no manifest names,
    which the next batch deletes.

    The log belongs to one query and its checkpoint: one writer, batch ids that grow.
    """

    def __init__(self, spark: SparkSession, path: str, reduce: Reduce | None = None, fan_in: int = 8):
        if fan_in < 2:
            raise ValueError("a merge takes two segments at least")
        self.spark, self.path, self.reduce, self.fan_in = spark, path.rstrip("/"), reduce, fan_in

    def _manifests(self) -> list[str]:
        return sorted(n for n in child_names(self.spark, f"{self.path}/_manifests") if n.endswith(".json"))

    def _load(self) -> tuple[list[Segment], list[str]]:
        """Live segments, oldest first, and folders to delete."""
        names = self._manifests()
        if not names:
            return [], []
        held = json.loads(read_text(self.spark, f"{self.path}/_manifests/{names[-1]}"))
        return [Segment(**segment) for segment in held["segments"]], held["dropped"]

    def _commit(self, segments: Sequence[Segment], dropped: Sequence[str]) -> None:
        names = self._manifests()
        number = int(names[-1].removesuffix(".json")) + 1 if names else 0
        content = json.dumps({"segments": [vars(segment) for segment in segments], "dropped": list(dropped)})
        publish_text(self.spark, f"{self.path}/_manifests/{number:010d}.json", content)
        for name in names[:-1]:
            remove_dir(self.spark, f"{self.path}/_manifests/{name}")

    def segments(self) -> list[Segment]:
        return self._load()[0]

    def exists(self) -> bool:
        return bool(self._manifests())

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch, or replace it when it is the newest one."""
        segments, doomed = self._load()
        if any(s.last > batch_id for s in segments):
            raise ValueError(f"batch {batch_id} comes after a newer one")
        replaced = [s for s in segments if s.last == batch_id]
        new = Segment(self._write(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")), 0), 0, batch_id, batch_id)
        segments = [*[s for s in segments if s not in replaced], new]
        dropped = [s.folder for s in replaced]
        self._commit(segments, dropped)
        level = 0
        while len(due := [s for s in segments[:-1] if s.level == level]) >= self.fan_in:
            merged = self._merge(due)
            segments = [merged if s == due[0] else s for s in segments if s == due[0] or s not in due]
            dropped += [s.folder for s in due]
            self._commit(segments, dropped)
            level += 1
        self.sweep({s.folder for s in segments} | (set(dropped) - set(doomed)))

    def _write(self, rows: DataFrame, level: int) -> str:
        folder = f"segment-{level}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        return folder

    def _merge(self, due: Sequence[Segment]) -> Segment:
        rows = self._rows(due)
        level = due[0].level + 1
        return Segment(self._write(rows if self.reduce is None else self.reduce(rows), level), level, due[0].first, due[-1].last)

    def sweep(self, keep: set[str]) -> None:
        """Delete the segments that neither this nor the last manifest names."""
        for name in child_names(self.spark, self.path):
            if name.startswith("segment-") and name not in keep:
                remove_dir(self.spark, f"{self.path}/{name}")

    def _rows(self, segments: Sequence[Segment]) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.path}/{s.folder}" for s in segments])

    def read(self) -> DataFrame:
        """All rows that merges have left, with their ``batch_id``."""
        if not (segments := self.segments()):
            raise ValueError(f"no batch has been written to {self.path}")
        return self._rows(segments)

    def current(self) -> DataFrame:
        """The rows ``reduce`` leaves of the whole log."""
        return self.read() if self.reduce is None else self.reduce(self.read())
