"""Search over subjects, variables and units: single queries and batches of queries."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statbank import schema as S
from statbank.functions import text
from statbank.operators import filters
from statbank.operators.lookup import match_indexed
from statbank.operators.match import match_terms
from statbank.sinks.text_index import TextIndex

SEARCH_KEYS = ["search_key", "search_key_en"]
NAME_KEYS = ["subj_norm", "subj_en_norm"]
VARIABLE_ROW = [
    "variable_id",
    "subjectId",
    "subject_name",
    "variable_dimensions",
    "variable_full_name",
    "measureUnitName",
    "unit_level",
]


def search_subjects(codebook: DataFrame, query: str, level: int | None = None) -> DataFrame:
    """One row per subject whose name contains the query, with its size and breakdown values."""
    found = codebook.where(filters.contains_any(query, ["subject_name"]))
    if level is not None:
        found = found.where(filters.level_exact(level))
    headline = F.coalesce(filters.aggregate_predicate(), F.lit(False)).cast("int")
    # Numeric part first: one row per (subject, name, n1), then the distinct strings of a subject.
    partial = found.groupBy("subjectId", "subject_name", "n1").agg(
        F.count("*").alias("n"), F.sum(headline).alias("agg"), F.min("variable_id").alias("first_id")
    )
    return partial.groupBy("subjectId").agg(
        F.max("subject_name").alias("subject_name"),
        F.sum("n").alias("n_variables"),
        F.sum("agg").alias("n_aggregate"),
        F.expr("listagg(DISTINCT n1, ' | ') WITHIN GROUP (ORDER BY n1)").alias("n1_breakdowns"),
        F.min("first_id").alias("example_variable_id"),
    ).orderBy("subject_name", "subjectId")


def search_variables(codebook: DataFrame, query: str, level: int | None = None) -> DataFrame:
    columns = ["subject_name", "variable_dimensions", "variable_full_name"]
    found = codebook.where(filters.contains_any(query, columns))
    if level is not None:
        found = found.where(filters.level_exact(level))
    return found.select(*VARIABLE_ROW).orderBy("subjectId", "variable_id")


def subject_dims(codebook: DataFrame, subject: str) -> DataFrame:
    rows = codebook.where(F.col("subjectId") == subject)
    return rows.select("variable_id", *S.DIMS, "variable_dimensions").orderBy("variable_id")


def top_subjects(subjects: DataFrame) -> DataFrame:
    return subjects.where(F.col("id").startswith("K")).select("id", "name").orderBy("id")


def codebook_rows(codebook: DataFrame, ids: DataFrame) -> DataFrame:
    rows = codebook.join(ids.select("variable_id"), "variable_id", "left_semi")
    return rows.orderBy("variable_id")


def browse(codebook: DataFrame, prefix: str) -> DataFrame:
    rows = codebook.where(filters.subject_prefix(prefix)).select(*VARIABLE_ROW)
    return rows.orderBy("subjectId", "variable_id")


def _subject_hits(found: DataFrame, keys: list[str]) -> DataFrame:
    """Per subject (and query): a name in both languages, keys, matching variables, a unit."""
    names = ["subject_name", "subject_name_en", *NAME_KEYS, "measureUnitName"]
    partial = found.groupBy(*keys, *names).agg(F.count("*").alias("n"))
    picked = [F.min(c).alias(c) for c in names]
    return partial.groupBy(*keys).agg(F.sum("n").alias("n_vars"), *picked)


def subject_hits(found: DataFrame) -> DataFrame:
    return _subject_hits(found, ["subjectId"])


def _ranking(name_match: Column, prefix: Column) -> dict[str, Column]:
    """Rank columns; a test that is NULL counts as not met."""
    name = F.col("subject_name")
    commas = F.length(name) - F.length(F.replace(name, F.lit(","), F.lit("")))
    return {
        "name_match": F.when(name_match, 0).otherwise(1),
        "is_prefix": F.when(prefix, 0).otherwise(1),
        "commas": commas,
        "namelen": F.length(name),
    }


RANK_ORDER = ("name_match", "is_prefix", "commas", "namelen")


def _rank_keys() -> list[Column]:
    keys = [F.col(c).asc_nulls_last() for c in RANK_ORDER]
    return keys + [F.col("n_vars").desc(), F.col("subjectId").asc_nulls_last()]


def _ranked_row() -> list[Column]:
    return [
        F.col("subjectId"),
        F.col("subject_name").alias("name"),
        F.col("subject_name_en").alias("name_en"),
        F.col("n_vars"),
        F.col("measureUnitName").alias("unit"),
        *[F.col(c) for c in RANK_ORDER],
    ]


def ranked_search(
    codebook: DataFrame, query: str, levels: Sequence[int] = (), k: int = S.MAX_SUBJECTS
) -> DataFrame:
    """Ranked subjects of one query, on a bilingual codebook."""
    if len(text.strip_literal(query)) < S.MIN_QUERY:
        found = codebook.where(F.lit(False))
    else:
        found = codebook.where(filters.level_available(levels)).where(
            filters.terms_all(query, SEARCH_KEYS)
        )
    start = text.fold_literal(query)
    ranks = _ranking(
        filters.terms_all(query, NAME_KEYS),
        filters.any_of(F.col(c).startswith(start) for c in NAME_KEYS),
    )
    hits = subject_hits(found).withColumns(ranks)
    return hits.orderBy(*_rank_keys()).limit(k).select(*_ranked_row())


def ranked_search_batch(
    codebook: DataFrame, queries: DataFrame, levels: Sequence[int] = (), k: int = S.MAX_SUBJECTS, index: TextIndex | None = None
) -> DataFrame:
    """Ranked subjects of every query of a (qid, query) table; with an index of the codebook's search keys, by that."""
    pool = codebook.where(filters.level_available(levels))
    matched = match_terms(pool, queries, "variable_id", SEARCH_KEYS) if index is None else match_indexed(index, queries)
    found = matched.join(
        pool.select(
            "variable_id", "subjectId", "subject_name", "subject_name_en", *NAME_KEYS, "measureUnitName"
        ),
        "variable_id",
    )
    forms = F.transform(text.terms(F.col("query")), text.term_variants)
    asked = queries.select("qid", forms.alias("forms"), text.fold_query(F.col("query")).alias("start"))
    hits = _subject_hits(found, ["qid", "subjectId"]).join(asked, "qid")

    def in_name(form: Column) -> Column:
        return filters.any_of(F.coalesce(F.contains(F.col(c), form), F.lit(False)) for c in NAME_KEYS)

    every_word = F.forall("forms", lambda any_form: F.exists(any_form, in_name))
    starts = filters.any_of(F.startswith(F.col(c), F.col("start")) for c in NAME_KEYS)
    order = Window.partitionBy("qid").orderBy(*_rank_keys())
    return (
        hits.withColumns(_ranking(every_word, starts))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("qid", *_ranked_row(), "rank")
    )


def search_hint(ranked: DataFrame) -> DataFrame:
    """One row: were there hits, and does the best one match only inside its breakdowns?"""
    return ranked.agg(
        F.count("*").alias("n_subjects"),
        F.coalesce(F.min("name_match") == 1, F.lit(False)).alias("only_breakdowns"),
    )


UNIT_KEY = "unit"


def unit_key() -> Column:
    return F.struct("unitId", "unitLevel")


def unit_search(
    units: DataFrame, query: str, levels: Sequence[int], k: int = S.MAX_UNITS
) -> DataFrame:
    """Units at the levels whose folded name contains every word; input has search_key."""
    if len(text.strip_literal(query)) < S.MIN_QUERY or not levels:
        found = units.where(F.lit(False))
    else:
        found = units.where(F.col("unitLevel").isin(*levels)).where(
            filters.terms_all(query, ["search_key"], stems=False)
        )
    order = [F.col("unitLevel").desc(), F.col("unitName").asc_nulls_last(), F.col("unitId")]
    return found.select("unitId", "unitName", "unitLevel").orderBy(*order).limit(k)


def unit_search_batch(
    units: DataFrame, queries: DataFrame, levels: Sequence[int], k: int = S.MAX_UNITS, index: TextIndex | None = None
) -> DataFrame:
    """Units of every query of a (qid, query) table; with an index of the units' search keys by UNIT_KEY, by that."""
    pool = units.where(F.col("unitLevel").isin(*levels))
    if index is None:
        found = match_terms(pool.withColumn(UNIT_KEY, unit_key()), queries, UNIT_KEY, ["search_key"], stems=False)
    else:
        found = match_indexed(index, queries, stems=False)
    rows = found.select("qid", "unit.unitId", "unit.unitLevel").join(
        pool.select("unitId", "unitLevel", "unitName"), ["unitId", "unitLevel"]
    )
    order = Window.partitionBy("qid").orderBy(
        F.col("unitLevel").desc(), F.col("unitName").asc_nulls_last(), F.col("unitId")
    )
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("qid", "unitId", "unitName", "unitLevel", "rank")
