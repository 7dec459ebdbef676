"""Data-quality profiles, kept as states that merge."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statbank.functions import text
from statbank.operators.filters import leading_zero

def profile_state(facts: DataFrame) -> DataFrame:
    """What a profile is made of: (tbl, of_units, slot, bits, levels, n), by one pass over the facts.

    A fact counts once for its variable and once for its unit; both counts are combined where the facts are read, and
    only different keys are exchanged. Variables become bits of bitmaps, a slot for every 64 ids; a unit's slot is its
    id. Levels are bits too, those outside 0 to 62 sharing one. A level that is NULL or unknown belongs to the table
    NULL.
    """
    keys = ["unitLevel", "variable_id", "unitId"]
    sets = [[F.col("unitLevel"), F.col("variable_id")], [F.col("unitLevel"), F.col("unitId")]]
    counted = facts.select(*keys).groupingSets(sets, *keys).agg(F.count("*").alias("n"), F.grouping("variable_id").cast("int").alias("of_units"))
    slot = F.when(F.col("of_units") == 0, F.shiftright("variable_id", 6).cast("string")).otherwise(F.col("unitId"))
    bit = F.when(F.col("of_units") == 0, F.expr("shiftleft(1L, variable_id & 63)"))
    level = F.when(F.col("unitLevel").between(0, 62), F.col("unitLevel")).when(F.col("unitLevel").isNotNull(), 63)
    named = counted.select(
        text.fact_table_name(F.col("unitLevel")).alias("tbl"), "of_units", slot.alias("slot"), bit.alias("bits"), level.cast("int").alias("level"), "n"
    )
    return _combined(named.withColumn("levels", F.expr("shiftleft(1L, level)")))


def _combined(rows: DataFrame) -> DataFrame:
    return rows.groupBy("tbl", "of_units", "slot").agg(F.bit_or("bits").alias("bits"), F.bit_or("levels").alias("levels"), F.sum("n").alias("n"))


def merged_states(*states: DataFrame) -> DataFrame:
    """The state of all the facts that the given states are of."""
    return _combined(reduce(DataFrame.unionByName, states))


def profile_of(state: DataFrame) -> DataFrame:
    """Rows, distinct keys and levels, and id lengths of each fact table."""
    of_units = F.col("of_units") == 1
    return state.groupBy("tbl").agg(
        F.sum(F.when(~of_units, F.col("n"))).alias("nrows"),
        F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("bigint").alias("nvars"),
        F.count(F.when(of_units, F.col("slot"))).alias("nunits"),
        F.min(F.when(of_units, F.length("slot"))).alias("min_idlen"),
        F.max(F.when(of_units, F.length("slot"))).alias("max_idlen"),
        F.coalesce(F.bit_count(F.bit_or("levels")), F.lit(0)).cast("bigint").alias("nlevels"),
    )


def profile(facts: DataFrame) -> DataFrame:
    """The profile of each fact table; facts with a NULL or unknown level are the table NULL."""
    return profile_of(profile_state(facts))


def leading_zero_count(facts: DataFrame) -> DataFrame:
    return facts.where(leading_zero()).agg(F.count("*").alias("n"))


def label_check(labels: DataFrame) -> DataFrame:
    """Rows and different ids: ids become bits of bitmaps where they are read, a slot for every 64."""
    slots = labels.groupBy(F.shiftright("id", 6).alias("slot")).agg(F.count("*").alias("n"), F.bit_or(F.expr("shiftleft(1L, id & 63)")).alias("bits"))
    return slots.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("bigint").alias("u"))
