"""Breakdown facets of a subject: active dimensions, their values, and picking by ticks."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statbank import schema as S
from statbank.functions import text
from statbank.operators.filters import all_of


def unpivot_dims(codebook: DataFrame) -> DataFrame:
    """(subjectId, variable_id, dim, value, value_en), non-missing values only."""
    triples = ", ".join(f"'{d}', {d}, {d}_en" for d in S.DIMS)
    out = codebook.selectExpr(
        "subjectId", "variable_id", f"stack({len(S.DIMS)}, {triples}) AS (dim, value, value_en)"
    )
    return out.where(F.col("value").isNotNull() & (F.col("value") != S.MISSING))


def _distinct_values(codebook: DataFrame) -> DataFrame:
    return unpivot_dims(codebook).groupBy("subjectId", "dim", "value").agg(
        F.count("*").alias("n_variables")
    )


def active_dims(codebook: DataFrame) -> DataFrame:
    """Dimensions with more than one value inside a subject."""
    per_dim = _distinct_values(codebook).groupBy("subjectId", "dim")
    return per_dim.agg(F.count("*").alias("n_values")).where(F.col("n_values") > 1)


def total_first(value: Column) -> list[Column]:
    """Sort keys: the total leads, the rest follows Polish alphabetical order."""
    return [(value != S.TOTAL).asc(), F.collate(value, "pl").asc(), value.asc()]


def facet_values(codebook: DataFrame) -> DataFrame:
    """Values of active dimensions with their English value (that of the last variable)."""
    translated = F.nullif(F.col("value_en"), F.lit(""))
    english = (
        unpivot_dims(codebook)
        .where(translated.isNotNull())
        .groupBy("subjectId", "dim", "value", "value_en")
        .agg(F.max("variable_id").alias("last_id"))
        .groupBy("subjectId", "dim", "value")
        .agg(F.max_by("value_en", "last_id").alias("value_en"))
    )
    values = _distinct_values(codebook).join(
        active_dims(codebook).select("subjectId", "dim"), ["subjectId", "dim"], "left_semi"
    )
    return values.join(english, ["subjectId", "dim", "value"], "left")


def ranked_values(values: DataFrame) -> DataFrame:
    """Adds the position of each distinct value inside its facet."""
    order = Window.partitionBy("subjectId", "dim").orderBy(*total_first(F.col("value")))
    return values.withColumn("position", F.row_number().over(order))


def facet_text(values: DataFrame, query: str) -> DataFrame:
    """Values whose lower-cased Polish or English text contains the folded query."""
    label = F.concat(F.col("value"), F.lit(" "), F.coalesce(F.col("value_en"), F.lit("")))
    return values.where(F.lower(label).contains(text.fold_literal(query)))


def facet_defaults(codebook: DataFrame) -> DataFrame:
    """Initial tick of each active dimension: the total if there is one, else the first value."""
    values = _distinct_values(codebook).groupBy("subjectId", "dim")
    chosen = values.agg(
        F.count("*").alias("n_values"),
        F.coalesce(
            F.max(F.when(F.col("value") == S.TOTAL, F.col("value"))),
            F.min_by("value", F.collate(F.col("value"), "pl")),
        ).alias("value"),
    )
    return chosen.where(F.col("n_values") > 1).select("subjectId", "dim", "value")


def pick_ticks(codebook: DataFrame, ticks: DataFrame) -> DataFrame:
    """Variables ticked in every active dimension; `ticks` holds (subjectId, dim, value)."""
    active = active_dims(codebook).select("subjectId", "dim")
    needed = active.groupBy("subjectId").agg(F.count("*").alias("n_active"))
    hits = (
        unpivot_dims(codebook)
        .join(active, ["subjectId", "dim"], "left_semi")
        .join(ticks.select("subjectId", "dim", "value"), ["subjectId", "dim", "value"], "left_semi")
        .groupBy("variable_id")
        .agg(F.count("*").alias("n_hits"))
    )
    return (
        codebook.select("subjectId", "variable_id")
        .join(needed, "subjectId", "left")
        .join(hits, "variable_id", "left")
        .where(F.coalesce("n_hits", F.lit(0)) == F.coalesce("n_active", F.lit(0)))
        .select("subjectId", "variable_id")
    )


def active_flags(codebook: DataFrame) -> DataFrame:
    """One row per subject with an active dimension and a boolean per dimension."""
    flags = [F.max(F.col("dim") == d).alias(f"{d}_active") for d in S.DIMS]
    return active_dims(codebook).groupBy("subjectId").agg(*flags)


def pick(codebook: DataFrame, ticks: Mapping[str, Sequence[str]]) -> DataFrame:
    """The same ticks for every given subject; an active dimension without ticks picks nothing."""
    tests = []
    for d in S.DIMS:
        given = ticks.get(d, ())
        ticked = F.coalesce(text.non_missing(F.col(d)).isin(*given), F.lit(False)) if given else F.lit(False)
        tests.append(~F.coalesce(F.col(f"{d}_active"), F.lit(False)) | ticked)
    joined = codebook.join(active_flags(codebook), "subjectId", "left")
    return joined.where(all_of(tests)).select(*codebook.columns)


def pick_all(codebook: DataFrame) -> DataFrame:
    """Everything ticked: variables with a value in each active dimension."""
    tests = [
        ~F.coalesce(F.col(f"{d}_active"), F.lit(False)) | ~text.is_missing(F.col(d)) for d in S.DIMS
    ]
    joined = codebook.join(active_flags(codebook), "subjectId", "left")
    return joined.where(all_of(tests)).select(*codebook.columns)


def pick_none(codebook: DataFrame) -> DataFrame:
    """Nothing ticked: only subjects without active dimensions still resolve."""
    return pick(codebook, {})


def axes(codebook: DataFrame) -> DataFrame:
    """(subjectId, dim, axis, label, label_en) of each active dimension, labels from the title."""
    titles = (
        codebook.select("subjectId", "subject_name", "subject_name_en")
        .distinct()
        .groupBy("subjectId")
        .agg(F.min("subject_name").alias("name"), F.min("subject_name_en").alias("name_en"))
    )
    dims = active_dims(codebook).groupBy("subjectId").agg(F.sort_array(F.collect_list("dim")).alias("dims"))
    n = F.size("dims")
    labelled = dims.join(titles, "subjectId").select(
        "subjectId",
        "dims",
        text.axis_labels_or_default(F.col("name"), n).alias("labels"),
        text.axis_labels(F.col("name_en"), n, "en").alias("labels_en"),
    )
    return labelled.select("subjectId", "labels", "labels_en", F.posexplode("dims").alias("i", "dim")).select(
        "subjectId",
        "dim",
        (F.col("i") + 1).alias("axis"),
        F.get("labels", F.col("i")).alias("label"),
        F.get("labels_en", F.col("i")).alias("label_en"),
    )


def panel(codebook: DataFrame) -> DataFrame:
    """Everything a facet panel shows: axes, labels, ordered values and initial ticks."""
    ticked = facet_defaults(codebook).withColumn("tick", F.lit(True))
    values = ranked_values(facet_values(codebook))
    return (
        values.join(axes(codebook), ["subjectId", "dim"])
        .join(ticked, ["subjectId", "dim", "value"], "left")
        .select(
            "subjectId", "dim", "axis", "label", "label_en", "value", "value_en", "position",
            F.coalesce("tick", F.lit(False)).alias("ticked"),
        )
    )
