"""Places in a global order, found by range partitions and their sizes."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statbank.session import materialized

#: A row number inside a partition takes the lower 33 bits of an increasing id.
_INSIDE = (1 << 33) - 1


def placed(rows: DataFrame, order: Sequence[Column | str], name: str = "place") -> DataFrame:
    """Rows with their place, from 1, in the order of `order`, which should be a total one.

    Rows are dealt out by ranges of the order, sorted inside a range and stored once with their number in it. The
    ranges' sizes, one row each, give the offsets; no task sees all rows, and no row is counted by another.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    keys = [k if isinstance(k, Column) else F.col(k).asc_nulls_last() for k in order]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = materialized(dealt.select(row.alias("row"), F.monotonically_increasing_id().alias("id")), "placed")
    part = F.shiftright("id", 33)
    inside = F.col("id").bitwiseAND(F.lit(_INSIDE))
    sizes = stored.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")))
    found = stored.withColumn("part", part).join(offsets, "part")
    return found.select(*[F.col("row").getField(c).alias(c) for c in rows.columns], (F.col("offset") + inside + 1).alias(name))


def placed_by_key(rows: DataFrame, key: str, order: Sequence[Column | str], name: str = "place") -> DataFrame:
    """`placed` in the order of `key`, NULL first, and then `order`, for rows whose equal keys lie in one partition
    already: they are numbered there, and only the keys' numbers of rows are dealt out by ranges and summed up.

    No row is exchanged, but `rows` is computed twice, once for the numbers. They join the rows by the key.
    """
    sizes = materialized(rows.groupBy(key).agg(F.count("*").alias("n")), "sizes")
    dealt = sizes.repartitionByRange(F.col(key).asc_nulls_first())
    stored = materialized(dealt.withColumn("part", F.spark_partition_id()), "sizes-by-range")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored.groupBy("part").agg(F.sum("n").alias("n"))
    offsets = F.broadcast(parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")))
    inside = Window.partitionBy("part").orderBy(F.col(key).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    before = stored.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(offsets, "part")
    before = before.select(F.col(key).alias("_key"), (F.col("offset") + F.col("before")).alias("_before"))
    number = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    # A NULL key finds no number: nothing comes before it.
    found = rows.withColumn("_number", number).join(before, F.col(key) == F.col("_key"), "left")
    place = F.coalesce("_before", F.lit(0)) + F.col("_number")
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], place.alias(name))
