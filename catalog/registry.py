"""Named queries with their oracle SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.fixtures import Tables
from catalog.oracle import with_tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}
WHOLE = (T.ByteType, T.ShortType, T.IntegerType)


def query(name: str, oracle: str | None = None):
    """Register a query; the oracle may use every table of catalog.oracle by name."""

    def keep(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = with_tables(oracle)
        return build

    return keep


def widened(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, so both engines return the same types."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("bigint").alias(f.name) if isinstance(f.dataType, WHOLE) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def runnable(build: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: widened(build(Tables(spark, folder)))
