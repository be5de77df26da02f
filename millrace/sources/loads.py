"""Full, timestamp-based and sequence-based loads with their watermarks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators import ranking
from millrace.session import has_data
from millrace.sources import tables

# Fixed value: where a first timestamp load starts.
FIRST_WATERMARK = datetime(1970, 1, 1)


def full_load(source: DataFrame, loaded_at: Column) -> DataFrame:
    """A snapshot with its load time and date."""
    return source.withColumns({"load_timestamp": loaded_at, "load_date": loaded_at.cast("date")})


def write_full_load(source: DataFrame, path: str, loaded_at: Column) -> None:
    """Replace the snapshot of the load's date; other dates stay."""
    tables.partition_overwrite(full_load(source, loaded_at), path, ["load_date"])


def incremental_timestamp(
    source: DataFrame, column: str, last: Column | None, inclusive: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows changed since the last watermark, and the next watermark (one row).

    ``inclusive`` also re-reads rows at the watermark itself, for sources whose
    rows can share a timestamp; the load then has to drop repeats by key.
    """
    since = F.lit(FIRST_WATERMARK).cast(source.schema[column].dataType) if last is None else last
    newer = F.col(column) >= since if inclusive else F.col(column) > since
    batch = source.filter(newer)
    return batch, batch.agg(F.coalesce(F.max(column), since).alias("watermark"), F.count("*").alias("rows"))


def incremental_sequence(source: DataFrame, column: str, last_id: int) -> tuple[DataFrame, DataFrame]:
    """Rows above the last id in id order, and the next last id (one row)."""
    batch = source.filter(F.col(column) > last_id)
    return batch.orderBy(column), batch.agg(F.coalesce(F.max(column), F.lit(last_id)).alias("last_id"), F.count("*").alias("rows"))


def pushed_incremental_query(table: str, column: str, last: datetime | int | None) -> str:
    """The subquery a JDBC source runs for an incremental load.

    Unordered: the order of a subquery is lost in a parallel read.
    """
    if isinstance(last, int):
        return f"SELECT * FROM {table} WHERE {column} > {last}"
    since = (FIRST_WATERMARK if last is None else last).isoformat(sep=" ")
    return f"SELECT * FROM {table} WHERE {column} > TIMESTAMP '{since}'"


class WatermarkLedger:
    """Append-only table of the watermark each load of a table reached."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def last(self, table: str) -> object | None:
        if not has_data(self.spark, self.path):
            return None
        rows = self.spark.read.parquet(self.path).filter(F.col("table") == table)
        return rows.agg(F.max("watermark")).first()[0]

    def loads(self, table: str) -> int:
        """How many loads of the table are recorded; the number of the next one."""
        if not has_data(self.spark, self.path):
            return 0
        return self.spark.read.parquet(self.path).filter(F.col("table") == table).count()

    def record(self, table: str, watermark: object) -> None:
        row = self.spark.createDataFrame([(table, watermark)], ["table", "watermark"])
        row.coalesce(1).write.mode("append").parquet(self.path)


def run_incremental_load(
    source: DataFrame,
    column: str,
    ledger: WatermarkLedger,
    table: str,
    path: str,
    loaded_at: Column,
    partition_by: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> int:
    """Append what is new and record the watermark; return the rows loaded.

    A load is one folder (``load=<number>``) that its write replaces as a whole;
    the ledger follows it, so a load that died in between is repeated and not
    doubled. Rows and watermark come from the one write, through an observation;
    an empty batch writes nothing to the ledger. With ``keys`` the watermark is
    inclusive and rows already in the target are left out.
    """
    last, number = ledger.last(table), ledger.loads(table)
    batch, _ = incremental_timestamp(source, column, None if last is None else F.lit(last), inclusive=bool(keys))
    if keys:
        batch = ranking.dedup_keep_latest(batch, keys, [column])
        if has_data(ledger.spark, path):
            loaded = ledger.spark.read.parquet(path).filter(F.col("load") < number).select(*keys, column)
            loaded = loaded if last is None else loaded.filter(F.col(column) >= F.lit(last))
            batch = batch.join(loaded, [*keys, column], "left_anti")
    seen = Observation("load")
    observed = batch.observe(seen, F.count("*").alias("rows"), F.max(column).alias("watermark"))
    own = observed.withColumn("ingestion_timestamp", loaded_at).write.mode("overwrite").option("partitionOverwriteMode", "static")
    own.partitionBy(*partition_by).parquet(f"{path}/load={number}")
    rows, watermark = seen.get["rows"], seen.get["watermark"]
    if rows:
        ledger.record(table, watermark)
    return rows
