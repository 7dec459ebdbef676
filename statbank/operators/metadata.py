"""Codebook, bilingual codebook and territorial units."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statbank import schema as S
from statbank.functions import text


def codebook(variables: DataFrame, subjects: DataFrame) -> DataFrame:
    """One readable row per variable; variables of unknown subjects keep NULL names."""
    named = subjects.select(
        F.col("id").alias("subjectId"),
        F.col("name").alias("subject_name"),
        F.col("description").alias("subject_description"),
        F.col("parentId").alias("subject_parent_id"),
    )
    dims = text.dim_label([text.non_missing(F.col(d)) for d in S.DIMS])
    return variables.join(named, "subjectId", "left").select(
        F.col("id").alias("variable_id"),
        "subjectId",
        "subject_name",
        "subject_description",
        "subject_parent_id",
        *S.DIMS,
        dims.alias("variable_dimensions"),
        F.col("level").alias("unit_level"),
        "measureUnitId",
        "measureUnitName",
        text.full_name(F.col("subject_name"), dims).alias("variable_full_name"),
    )


def english_labels(raw: DataFrame) -> DataFrame:
    """Typed English labels: both spellings of missing become NULL."""
    dims = [text.null_tokens(F.col(d)) for d in S.DIMS]
    return raw.select(
        "id",
        *[c.alias(d) for c, d in zip(dims, S.DIMS_EN)],
        F.col("measureUnitName").alias("measureUnitName_en"),
        text.dim_label(dims).alias("variable_dimensions_en"),
    )


def bilingual_codebook(
    codebook: DataFrame,
    subjects_en: DataFrame | None = None,
    variables_en: DataFrame | None = None,
) -> DataFrame:
    """Codebook with English columns (NULL where a side is absent) and search keys."""
    out = codebook
    if subjects_en is None:
        out = out.withColumn("subject_name_en", F.lit(None).cast("string"))
    else:
        names = subjects_en.select("subjectId", F.col("name_en").alias("subject_name_en"))
        out = out.join(names, "subjectId", "left")
    labels = [*S.DIMS_EN, "measureUnitName_en", "variable_dimensions_en"]
    if variables_en is None:
        out = out.withColumns({c: F.lit(None).cast("string") for c in labels})
        full_en = F.col("subject_name_en")
    else:
        side = variables_en.select(F.col("id").alias("variable_id"), *labels)
        out = out.join(side, "variable_id", "left")
        full_en = text.full_name_en(F.col("subject_name_en"), F.col("variable_dimensions_en"))
    out = out.withColumn("variable_full_name_en", full_en)
    return text.with_search_keys(out).select(
        "variable_id",
        "subjectId",
        "subject_name",
        "variable_dimensions",
        *S.DIMS,
        *S.DIMS_EN,
        "unit_level",
        "measureUnitName",
        "measureUnitName_en",
        "variable_full_name",
        "subject_name_en",
        "variable_dimensions_en",
        "variable_full_name_en",
        "search_key",
        "subj_norm",
        "subj_en_norm",
        "search_key_en",
    )


def units(facts: DataFrame) -> DataFrame:
    """Units with their span of years.

    Names are grouped first and reduced afterwards: the pass over the facts then keeps only
    numeric buffers (hash aggregation with map-side combine), and the string minimum runs on
    a few rows per unit.
    """
    spans = facts.groupBy("unitId", "unitLevel", "unitName").agg(
        F.min("year").alias("lo"), F.max("year").alias("hi")
    )
    per_unit = spans.groupBy("unitId", "unitLevel").agg(
        F.min("unitName").alias("unitName"),
        F.min("lo").alias("first_year"),
        F.max("hi").alias("last_year"),
    )
    return per_unit.select(
        "unitId",
        "unitName",
        "unitLevel",
        text.voivodeship(F.col("unitId")).alias("voivod_teryt"),
        "first_year",
        "last_year",
    )


def unit_search_keys(units: DataFrame) -> DataFrame:
    return units.select(
        "unitId", "unitName", "unitLevel", text.fold(F.col("unitName")).alias("search_key")
    )


def any_of_group(rows: DataFrame, group: str, value: str) -> DataFrame:
    """`value` replaced by the largest one of the row's group: a join with one row for each group,
    so no group has to meet in one task."""
    largest = rows.groupBy(group, value).agg(F.count("*").alias("n")).groupBy(group).agg(F.max(value).alias(value))
    return rows.drop(value).join(largest, group, "left")


def label_sample(variables_en: DataFrame, n: int = 4) -> DataFrame:
    """The first labels by id, to look at after a build."""
    return variables_en.orderBy("id").limit(n).select("id", "n1_en", "variable_dimensions_en", "measureUnitName_en")
