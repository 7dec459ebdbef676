"""A layout by series: one row for a series, with all its years beside each other.

Ranking, points and axes of a selection then need no exchange of facts: a series' mean is inside its row.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statbank import schema as S

SERIES = ["variable_id", "unitId", "unitLevel"]
ROW = T.StructType(
    [
        S.FACT["variable_id"],
        S.FACT["unitId"],
        T.StructField("points", T.ArrayType(T.StructType([S.FACT["year"], S.FACT["value"]]))),
        S.FACT["unitLevel"],
    ]
)


def series_rows(facts: DataFrame, dealt: bool = False) -> DataFrame:
    """(variable_id, unitId, points, unitLevel): a point for each year in ascending order; repeated years keep the
    largest value, and a year without any value has a NULL. A series is as long as there are years.
    `dealt` says that the rows of a variable lie in one partition already."""
    rows = facts.select(*SERIES, "year", "value")
    yearly = (rows if dealt else rows.repartition(*SERIES)).groupBy(*SERIES, "year").agg(F.max("value").alias("value"))
    rows = yearly.groupBy(*SERIES).agg(F.array_sort(F.collect_list(F.struct("year", "value"))).alias("points"))
    return rows.select(*ROW.names)


def write_series(facts: DataFrame, path: str, dealt: bool = False) -> None:
    rows = series_rows(facts, dealt).repartitionByRange("unitLevel", "variable_id", "unitId").sortWithinPartitions("unitLevel", "variable_id", "unitId")
    rows.write.option("compression", "zstd").partitionBy("unitLevel").parquet(path)


def read_series(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROW).parquet(path)
