"""Bounded reads: Parquet, JSON under a declared schema, JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"
JSON_MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def scan_parquet(spark: SparkSession, path: str, partition: Column | None = None) -> DataFrame:
    """A whole table, or the partitions a predicate selects.

    The predicate stays a filter on the partition column, which Spark turns
    into a partition filter: no path is spliced and the column survives.
    """
    df = spark.read.parquet(path)
    return df if partition is None else df.filter(partition)


def scan_json_modes(
    spark: SparkSession, path: str | list[str], schema: StructType, mode: str = "PERMISSIVE"
) -> DataFrame:
    """JSON lines under a declared schema.

    ``PERMISSIVE`` keeps malformed rows with their text in ``_corrupt_record``;
    ``DROPMALFORMED`` drops them; ``FAILFAST`` fails the job.

    Lines are parsed by ``from_json`` and not by the JSON file format: that
    one parses only the columns a query asks for, so whether a row counts as
    malformed would change with the query.
    """
    return parse_json_lines(spark.read.text(path), schema, mode)


def parse_json_lines(lines: DataFrame, schema: StructType, mode: str = "PERMISSIVE", keep: Sequence[str] = ()) -> DataFrame:
    """Rows of JSON lines in ``value``, bounded or streaming, with the columns of the lines named in ``keep``."""
    if mode not in JSON_MODES:
        raise ValueError(f"mode must be one of {JSON_MODES}")
    lines = lines.filter(F.trim("value") != "")
    if mode == "FAILFAST":
        return lines.select(*keep, F.from_json("value", schema, {"mode": mode}).alias("_row")).select("_row.*", *keep)
    read_schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = lines.select(*keep, F.from_json("value", read_schema, options).alias("_row")).select("_row.*", *keep)
    return rows if mode == "PERMISSIVE" else rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and malformed ones with their text."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(F.col(CORRUPT).isNotNull())


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: object | None = None,
    upper_bound: object | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read of a table, or of a subquery pushed as one.

    With a partition column and bounds the read runs as ``num_partitions``
    parallel range queries; without, the database hands over one stream.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "dbtable": table if table is not None else f"({query}) as source", "fetchsize": str(fetch_size)}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    split = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(value is not None for value in split):
        if any(value is None for value in split):
            raise ValueError("a partitioned read needs column, both bounds and the number of partitions")
        options |= {
            "partitionColumn": str(partition_column),
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(num_partitions),
        }
    return options


def scan_jdbc(spark: SparkSession, **kwargs: object) -> DataFrame:
    """Read from a database; see :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()
