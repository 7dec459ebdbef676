"""Chart-ready series over observations."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statbank import schema as S
from statbank.functions import text

SERIES = ["variable_id", "unitId", "unitLevel"]


def points(observations: DataFrame, dealt: bool = False) -> DataFrame:
    """One non-null value per series and year; repeats keep the largest, nulls never count.

    `dealt` says that the rows of a variable lie in one partition already, so that no exchange is needed.
    """
    held = observations.where(F.col("value").isNotNull()).select(*SERIES, "year", "value")
    # Dealt out by series once: the yearly and the series aggregation both stay within a task.
    rows = held if dealt else held.repartition(*SERIES)
    return rows.groupBy(*SERIES, "year").agg(F.max("value").alias("value"))


def series(observations: DataFrame, dealt: bool = False) -> DataFrame:
    """Mean and length of every series that has a value."""
    means = points(observations, dealt).groupBy(*SERIES)
    return means.agg(F.avg("value").alias("mean"), F.count("*").alias("n_points"))


def top_series(observations: DataFrame, k: int = S.MAX_SERIES, dealt: bool = False) -> DataFrame:
    """The k series with the highest mean."""
    return _best(series(observations, dealt), k)


def _best(means: DataFrame, k: int) -> DataFrame:
    order = [F.col("mean").desc(), F.col("variable_id"), F.col("unitLevel").desc(), F.col("unitId")]
    return means.orderBy(*order).limit(k)


def ranked(means: DataFrame, k: int = S.MAX_SERIES) -> DataFrame:
    """The k best series with the number of all series beside them."""
    total = means.agg(F.count("*").alias("n_series"))
    return _best(means, k).withColumn("n_series", total.scalar())


def points_of(observations: DataFrame, keys: DataFrame) -> DataFrame:
    """Points of chosen series. The few keys are broadcast, so this pass over the observations
    drops everything else before it aggregates."""
    return points(observations.join(F.broadcast(keys.select(*SERIES)), SERIES, "left_semi"))


def top_points(observations: DataFrame, k: int = S.MAX_SERIES, dealt: bool = False) -> DataFrame:
    """Points of the top series; at most 8 keys are chosen."""
    if not 0 <= k <= S.MAX_SERIES:
        raise ValueError(f"at most {S.MAX_SERIES} series")
    return points_of(observations, top_series(observations, k, dealt))


def with_means(rows: DataFrame, year_from: int | None = None, year_to: int | None = None) -> DataFrame:
    """Rows of the layout by series, cut to the years: points, those with a value (`held`), their mean and number."""
    low, high = (F.lit(y).cast("int") if y is not None else None for y in (year_from, year_to))

    def within(p: Column) -> Column:
        test = F.lit(True) if low is None else p["year"] >= low
        return test if high is None else test & (p["year"] <= high)

    cut = rows.select(*SERIES, F.filter("points", within).alias("points")).where(F.size("points") > 0)
    cut = cut.withColumn("held", F.filter("points", lambda p: p["value"].isNotNull())).withColumn("n_points", F.size("held"))
    total = F.aggregate("held", F.lit(0.0), lambda a, p: a + p["value"])
    return cut.withColumn("mean", F.when(F.col("n_points") > 0, total / F.col("n_points")))


def best_rows(means: DataFrame, k: int = S.MAX_SERIES) -> DataFrame:
    """The k rows of `with_means` with the highest mean; no row is exchanged but the k of each task."""
    return _best(means.where(F.col("n_points") > 0), k)


def points_of_rows(rows: DataFrame) -> DataFrame:
    """(variable_id, unitId, unitLevel, year, value) of rows of `with_means`."""
    return rows.select(*SERIES, F.explode("held").alias("p")).select(*SERIES, "p.year", "p.value")


def named_points(
    points: DataFrame, units: DataFrame, codebook: DataFrame, many_levels: bool, many_variables: bool, lang: str = "pl"
) -> DataFrame:
    """Points with the series' name, in Polish or, from a bilingual codebook, in English where there is one."""
    labelled = points.join(units.select("unitId", "unitLevel", "unitName"), ["unitId", "unitLevel"], "left")
    title = F.col("variable_full_name")
    if lang == "en" and "variable_full_name_en" in codebook.columns:
        title = text.bilingual(title, F.col("variable_full_name_en"), lang)[0]
    labelled = labelled.join(codebook.select("variable_id", title.alias("variable_full_name")), "variable_id", "left")
    variable = F.coalesce("variable_full_name", F.col("variable_id").cast("string"))
    name = text.series_name(
        F.col("unitName"), F.col("unitLevel"), variable, F.lit(many_levels), F.lit(many_variables)
    )
    return labelled.select(*SERIES, name.alias("series_name"), "year", "value")


def domain(observations: DataFrame, shown: DataFrame) -> DataFrame:
    """Axis ranges: years of all observations, values of the shown points, zero included."""
    years = observations.select("year").distinct()
    values = shown.agg(F.min("value").alias("low"), F.max("value").alias("high"))
    both = years.unionByName(values, allowMissingColumns=True)
    return both.agg(
        F.count("year").alias("n_years"),
        F.min("year").alias("year_min"),
        F.max("year").alias("year_max"),
        F.least(F.lit(0.0), F.min("low")).alias("y_min"),
        F.max("high").alias("y_max"),
    )


def mixed_measures(variables: DataFrame) -> DataFrame:
    """Do the selected variables use more than one measure unit, and which?"""
    unit = F.coalesce("measureUnitName", F.lit(""))
    per_unit = variables.select("variable_id", unit.alias("unit")).distinct().groupBy("unit").agg(
        F.count("*").alias("n")
    )
    return per_unit.agg(
        F.count("*").alias("n_measures"),
        ((F.sum("n") > 1) & (F.count("*") > 1)).alias("mixed"),
        F.expr("listagg(unit, ', ') WITHIN GROUP (ORDER BY unit)").alias("measures"),
    )
