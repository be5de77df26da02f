"""Parquet tables: partition overwrite, versions, evolution, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import ranking
from millrace.session import child_names


def partition_overwrite(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Rewrite only the partitions the rows fall in."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def schema_evolve_union(*loads: DataFrame) -> DataFrame:
    """Union of loads whose columns grew; absent columns read as NULL."""
    combined = loads[0]
    for load in loads[1:]:
        combined = combined.unionByName(load, allowMissingColumns=True)
    return combined


def read_evolving(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet folders with differing columns under their merged schema."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def snapshot_as_of(versions: DataFrame, keys: Sequence[str], version: str, number: int | Column, ties: Sequence[str] = ()) -> DataFrame:
    """The table as of a version: latest row per key not above it."""
    visible = versions.filter(F.col(version) <= number)
    return ranking.dedup_keep_latest(visible, keys, [version, *ties])


class VersionedTable:
    """A Parquet table published as whole versions.

    A version is a folder; Spark's ``_SUCCESS`` marker, written last, makes it
    visible. Readers take the newest finished one, so a table can be computed
    from itself, a failed write changes nothing, and a repeated publish of the
    same content is a new version with the same rows. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folder(self, number: int) -> str:
        return f"{self.path}/version-{number:010d}"

    def versions(self) -> list[int]:
        """Finished versions, oldest first."""
        names = [name for name in child_names(self.spark, self.path) if name.startswith("version-")]
        return sorted(
            int(name.removeprefix("version-"))
            for name in names
            if "_SUCCESS" in child_names(self.spark, f"{self.path}/{name}")
        )

    def read(self, number: int | None = None) -> DataFrame | None:
        """The newest version, or a given one; None before the first."""
        available = self.versions()
        if number is None:
            number = available[-1] if available else None
        elif number not in available:
            raise ValueError(f"version {number} is not published")
        return None if number is None else self.spark.read.parquet(self._folder(number))

    def publish(self, df: DataFrame) -> int:
        """Write the next version and return its number."""
        available = self.versions()
        number = available[-1] + 1 if available else 0
        df.write.mode("overwrite").parquet(self._folder(number))
        return number
