"""Where intermediate tables go, and which sides may be broadcast."""

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Estimates of stored tables are compressed sizes; long repeated labels unpack to many times that.
BROADCAST_BYTES = 8 * 1024 * 1024
#: Bytes of rows that a broadcast may hold in memory, and those of a row and of a column besides its text.
UNPACKED_BYTES = 96 * 1024 * 1024
ROW_BYTES, COLUMN_BYTES = 40, 8
#: Estimates so many times below UNPACKED_BYTES are believed.
UNPACKING = 1000


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder (a temporary one in local mode)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="statbank-")
    return f"{base.rstrip('/')}/statbank-{name}-{uuid.uuid4().hex}"


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; exact enough for written tables, pessimistic after joins."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def row_bytes(df: DataFrame) -> int:
    """What the rows of a frame take in memory, by their number and their texts: one pass over them."""
    plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    texts = [F.coalesce(F.sum(F.octet_length(F.col(f"`{f.name}`").cast("string"))), F.lit(0)) for f in df.schema.fields if not isinstance(f.dataType, plain)]
    n, *lengths = df.agg(F.count("*"), *texts).first()
    return n * (ROW_BYTES + COLUMN_BYTES * len(df.columns)) + sum(lengths)


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES, unpacked: int = UNPACKED_BYTES) -> DataFrame:
    """Hint a broadcast when the estimate is within `limit` and the rows are within `unpacked`; otherwise leave the join to AQE.

    Sorted numbers and repeated labels are stored in a hundredth of their size, so an estimate that is not far below is
    checked by the rows. A side whose rows are too many for a broadcast is merged, or Spark's own threshold, which knows
    the estimate only, would send it to the driver.
    """
    size, own = plan_bytes(df), df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if size > max(limit, own):
        return df
    if size * UNPACKING > unpacked and row_bytes(df) > unpacked:
        return df.hint("merge")
    return F.broadcast(df) if size <= limit else df


def literal_table(spark: SparkSession, values: Sequence[object], name: str, kind: str) -> DataFrame:
    """One column of plan-time values; its size is known to the optimizer."""
    row = spark.range(1)
    if not values:
        return row.select(F.lit(None).cast(kind).alias(name)).where(F.lit(False))
    return row.select(F.explode(F.array(*[F.lit(v).cast(kind) for v in values])).alias(name))


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, so later passes do not recompute it."""
    path = workspace(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that `materialized` wrote, once everything that reads them is written itself."""
    for table in tables:
        discard_folders(table.sparkSession, *{file.rsplit("/", 1)[0] for file in table.inputFiles()})


def discard_folders(spark: SparkSession, *folders: str) -> None:
    """Delete folders below a `workspace`; others stay."""
    for folder in folders:
        if "/statbank-" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def exchanges_dropped(spark: SparkSession) -> Iterator[None]:
    """What a write inside exchanged is deleted when that write ends; else it stays until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
