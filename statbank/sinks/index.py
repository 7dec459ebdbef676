"""A sparse key index of the fact files: where each key's rows begin, in each file that holds some.

Files are sorted by key, so a key's rows in a file are one stretch. The index has one row for a (file, key)
pair and is kept sorted by level and key beside the manifest; the manifest has a part's key range, the index
tells the ranges' gaps and a part's files apart.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statbank import schema as S

ENTRY = T.StructType(
    [
        T.StructField("unitLevel", T.ByteType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("variable_id", T.IntegerType()),
        T.StructField("file", T.StringType()),
        T.StructField("first_row", T.LongType()),
        T.StructField("rows", T.LongType()),
    ]
)


def key_entries(spark: SparkSession, facts_root: str) -> DataFrame:
    """(unitLevel, part, variable_id, file below the root, first row, rows) of laid-out facts.

    Of the facts only the key column is read; the row numbers are the reader's.
    """
    held = T.StructType([S.FACT["variable_id"], S.FACT["unitLevel"], T.StructField("part", T.IntegerType())])
    rows = spark.read.schema(held).parquet(facts_root).select(
        "unitLevel",
        "part",
        "variable_id",
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.row_index").alias("row"),
    )
    stretches = rows.groupBy("unitLevel", "part", "variable_id", "name").agg(F.min("row").alias("first_row"), F.count("*").alias("rows"))

    def folder(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))

    file = F.concat(F.lit("unitLevel="), folder("unitLevel"), F.lit("/part="), folder("part"), F.lit("/"), "name")
    return stretches.select("unitLevel", "part", "variable_id", file.alias("file"), "first_row", "rows")


def write_key_index(spark: SparkSession, root: str) -> None:
    """The index of `root`/facts, written beside it."""
    entries = key_entries(spark, f"{root}/facts")
    ordered = entries.repartitionByRange("unitLevel", "variable_id").sortWithinPartitions("unitLevel", "variable_id")
    ordered.write.option("compression", "zstd").parquet(f"{root}/key_index")


def read_key_index(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(ENTRY).parquet(f"{root}/key_index")
