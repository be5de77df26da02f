"""Keyed tables of hash buckets: an upsert rewrites the buckets it hits."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import idempotent, ranking, skew
from millrace.session import child_names, publish_text, read_text, remove_dir, temporary


class BucketTable:
    """A table dealt into ``buckets`` folders by a hash of its keys.

    A manifest says which folder holds each bucket. An upsert finds the
    buckets its keys fall in, reads and merges those, writes them into new folders and
    publishes the next manifest by a rename; all other buckets stay where they
    are. So a batch costs the buckets it hits, and choosing their number is choosing how
    much of the table a key rewrites: aim at a few hundred MB a bucket. The driver
    sees bucket numbers only.

    A failed upsert changes nothing, and repeating one gives the same rows. Folders that were replaced
    are deleted one upsert later, so readers of the manifest before can end;
    what a writer that died left behind goes with them. NULL is a key like any other. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], latest_by: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.latest_by, self.buckets = spark, path.rstrip("/"), list(keys), list(latest_by), buckets

    def _manifests(self) -> list[str]:
        return sorted(n for n in child_names(self.spark, f"{self.path}/_manifests") if n.endswith(".json"))

    def folders(self) -> dict[int, str]:
        """The folder of every bucket that has rows, by its number, below the table's path."""
        return self._load()[0]

    def _load(self) -> tuple[dict[int, str], list[str]]:
        names = self._manifests()
        if not names:
            return {}, []
        held = json.loads(read_text(self.spark, f"{self.path}/_manifests/{names[-1]}"))
        if held["keys"] != self.keys or held["buckets"] != self.buckets:
            raise ValueError(f"the table is dealt into {held['buckets']} buckets by {held['keys']}")
        return {int(number): folder for number, folder in held["folders"].items()}, held["dropped"]

    def bucket(self) -> Column:
        """The bucket of a row."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.path}/{folder}" for folder in folders])

    def read(self) -> DataFrame | None:
        """The table; None before the first upsert."""
        folders = self.folders()
        return self._rows(sorted(folders.values())) if folders else None

    def lookup(self, wanted: DataFrame) -> DataFrame | None:
        """The rows of the given keys (a DataFrame of the key columns); only their buckets are opened."""
        folders = self.folders()
        hit = [row[0] for row in wanted.select(self.bucket()).distinct().collect()]
        held = [folders[number] for number in sorted(hit) if number in folders]
        if not held:
            return None
        return skew.keyed_join(self._rows(held), wanted.select(*self.keys), self.keys, "left_semi", null_safe=True)

    def upsert(self, batch: DataFrame, batch_id: int | None = None) -> None:
        """Update the rows of known keys, insert the others; of one key the latest row counts. Runs jobs."""
        folders, _ = self._load()
        updates = ranking.dedup_keep_latest(batch, self.keys, self.latest_by)
        with temporary(updates, "bucket-updates") as latest:
            hit = sorted(row[0] for row in latest.select(self.bucket()).distinct().collect())
            if not hit:
                return
            held = [folders[number] for number in hit if number in folders]
            target = self._rows(held) if held else None
            merged = idempotent.merge_upsert(target, latest, self.keys, self.latest_by)
            folder = f"data-{uuid.uuid4().hex}"
            dealt = merged.withColumn("_bucket", self.bucket()).repartition(len(hit), "_bucket")
            dealt.write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        now = folders | {number: f"{folder}/_bucket={number}" for number in hit}
        self._commit(now, held)
        self._sweep(set(now.values()) | set(held))

    def _commit(self, folders: dict[int, str], dropped: Sequence[str]) -> None:
        names = self._manifests()
        number = int(names[-1].removesuffix(".json")) + 1 if names else 0
        content = json.dumps({"keys": self.keys, "buckets": self.buckets, "folders": folders, "dropped": list(dropped)})
        publish_text(self.spark, f"{self.path}/_manifests/{number:010d}.json", content)
        for name in names[:-1]:
            remove_dir(self.spark, f"{self.path}/_manifests/{name}")

    def _sweep(self, keep: set[str]) -> None:
        """Delete what neither this manifest nor the one before names."""
        for name in child_names(self.spark, self.path):
            if name.startswith("data-"):
                parts = [f"{name}/{part}" for part in child_names(self.spark, f"{self.path}/{name}") if part.startswith("_bucket=")]
                if not keep.intersection(parts):
                    remove_dir(self.spark, f"{self.path}/{name}")
                    continue
                for part in parts:
                    if part not in keep:
                        remove_dir(self.spark, f"{self.path}/{part}")
