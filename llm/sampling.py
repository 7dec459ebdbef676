"""Bounded samples of labelled rows, for fitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1 << 20


def thinned(rows: DataFrame, mark: Column, sample: int) -> DataFrame:
    """About 1.2 times `sample` rows by the hash `mark`, or all if there are no more: what is ordered and cut
    afterwards then does not grow with the table or its partitions."""
    share = min(1.0, 1.2 * sample / max(1, rows.count()))
    return rows.where(F.pmod(mark, F.lit(_PARTS)) <= int(share * _PARTS))


def bounded_sample(rows: DataFrame, columns: Sequence[str], sample: int) -> DataFrame:
    """At most `sample` different rows, by a hash of `columns`. The choice is made on the hashes alone and sent,
    as at most `sample` numbers, to where the rows are."""
    mark = F.xxhash64(*columns)
    few = thinned(rows.select(mark.alias("_mark")), F.col("_mark"), sample)
    chosen = F.broadcast(few.orderBy("_mark").limit(sample).distinct())
    return rows.withColumn("_mark", mark).join(chosen, "_mark", "left_semi").dropDuplicates(["_mark"]).drop("_mark")
