"""Session settings the operators are written for."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Event times are compared across engines, so pin the zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A key may hold a third of a table: let AQE split its join partition even
    # where that costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows with whole texts are large: ten times fewer of them to an Arrow batch than by default.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

# For joins and groups over most rows of large tables. A shuffle's partitions are of this size however many rows
# there are: many to start with, which AQE joins up to the size. Scans are cut likewise. A hash table or
# sort takes up to 30 times the compressed bytes its task reads.
SPREAD_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "960",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
}
_BEFORE = "millrace.before."


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session, take back those of ``spread_shuffles``, and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    for key in SPREAD_SETTINGS:
        before = spark.conf.get(f"{_BEFORE}{key}", None)
        if before is None:
            continue
        if before:
            spark.conf.set(key, before)
        else:
            spark.conf.unset(key)
        spark.conf.unset(f"{_BEFORE}{key}")
    return spark


def spread_shuffles(spark: SparkSession) -> None:
    """Bound what a task reads, whatever the size of the tables, until ``configure`` is called again.

    The number of shuffle partitions is a constant of a session, so a task's share of a shuffle, and the memory of its
    sorts and hash tables, would grow with the tables.
    """
    for key, value in SPREAD_SETTINGS.items():
        if spark.conf.get(f"{_BEFORE}{key}", None) is None:
            spark.conf.set(f"{_BEFORE}{key}", spark.conf.get(key, None) or "")
            spark.conf.set(key, value)


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, as ``spark.checkpoint.dir`` names it.

    Where it is unset, a session of one JVM (``local[n]``: tests, benchmarks)
    gets a new folder below ``/tmp``. Executors of a cluster do not share that,
    so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_DIRS[context.applicationId]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for this run, below the shared folder."""
    return f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    For results several jobs use: it survives the loss of an executor, where
    cached blocks would have to be computed again.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextlib.contextmanager
def temporary(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """As ``materialize``, removed again at the end of the block."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.parquet(path)
    finally:
        remove_dir(df.sparkSession, path)


def publish_text(spark: SparkSession, path: str, content: str) -> None:
    """Create a small file that readers see as a whole or not at all, by a rename; it must not exist."""
    final, draft = (spark._jvm.org.apache.hadoop.fs.Path(name) for name in (path, f"{path}.{uuid.uuid4().hex}.tmp"))
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(draft, True)
    out.write(bytearray(content.encode()))
    out.close()
    if not fs.rename(draft, final):
        raise OSError(f"cannot publish {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when it does not exist."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds anything beside hidden files and markers."""
    return any(not name.startswith(("_", ".")) for name in child_names(spark, path))
