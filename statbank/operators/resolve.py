"""From subject codes and dimension filters to variable ids, without collecting ids."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statbank import schema as S
from statbank.operators.filters import aggregate_predicate, dims_predicate
from statbank.operators.match import substring_pairs
from statbank.session import literal_table

KEYWORD_MIN = 4


def level_of(alias: str) -> int:
    wanted = alias.strip().lower()
    for code, names in S.LEVEL_ALIASES.items():
        if wanted in names:
            return code
    raise ValueError(
        f"unknown level {alias!r}; use gmina, powiat, subregion, voivod or macroregion"
    )


def is_category(code: Column) -> Column:
    return code.startswith("K")


def by_subject(variables: DataFrame, codes: DataFrame) -> DataFrame:
    """Variables whose subject is among the codes that are not categories."""
    wanted = codes.where(~is_category(F.col("code"))).select(F.col("code").alias("subjectId"))
    return variables.join(wanted, "subjectId", "left_semi").select(F.col("id").alias("variable_id"))


def category_keyword(name: Column) -> Column:
    """First word of four or more characters, else the whole name."""
    words = F.filter(F.split(name, r"\s+"), lambda w: F.length(w) >= KEYWORD_MIN)
    return F.coalesce(F.get(words, 0), name)


def category_subjects(subjects: DataFrame, codebook: DataFrame, codes: DataFrame) -> DataFrame:
    """(code, subjectId): subjects whose name contains the category's keyword."""
    wanted = codes.where(is_category(F.col("code"))).select(F.col("code").alias("id"))
    categories = subjects.join(wanted, "id", "left_semi").select(
        F.col("id").alias("code"), F.lower(category_keyword(F.col("name"))).alias("needle")
    )
    names = (
        codebook.where(F.col("subject_name").isNotNull())
        .select("subjectId", F.lower("subject_name").alias("haystack"))
        .distinct()
    )
    return substring_pairs(categories, names).select("code", "subjectId").distinct()


def category_keywords(subjects: DataFrame, codes: Sequence[str]) -> list[str]:
    """The keywords of the named categories: at most one for each code of a request."""
    if not codes:
        return []
    held = subjects.where(F.col("id").isin(*codes) & F.col("name").isNotNull())
    return sorted({r.needle for r in held.select(F.lower(category_keyword(F.col("name"))).alias("needle")).collect()})


def by_category(
    variables: DataFrame, subjects: DataFrame, codebook: DataFrame, codes: DataFrame
) -> DataFrame:
    matched = category_subjects(subjects, codebook, codes).select("subjectId")
    return variables.join(matched, "subjectId", "left_semi").select(F.col("id").alias("variable_id"))


def union_ids(*ids: DataFrame) -> DataFrame:
    out = ids[0]
    for more in ids[1:]:
        out = out.unionByName(more)
    return out.distinct()


def narrow_ids(ids: DataFrame, codebook: DataFrame, predicate: Column) -> DataFrame:
    """Requested ids that the codebook predicate also admits."""
    admitted = codebook.where(predicate).select("variable_id")
    return ids.join(admitted, "variable_id", "left_semi")


def resolve_ids(
    codebook: DataFrame,
    subjects: DataFrame,
    variable_ids: Sequence[int] | None = None,
    codes: Sequence[str] | None = None,
    dims: Mapping[str, object] | None = None,
    aggregate: bool = False,
) -> DataFrame:
    """Distinct variable ids of a request; a request that names nothing known is empty."""
    if variable_ids is None and codes is None:
        raise ValueError("give variables, subjects or both")
    predicate = aggregate_predicate() if aggregate else None if dims is None else dims_predicate(dims)
    literal = None if variable_ids is None else [int(i) for i in variable_ids]
    plain = [c for c in codes or () if not c.startswith("K")]
    # One pass over the codebook: every request is a condition on its rows.
    asked = F.col("subjectId").isin(*plain) if plain else F.lit(False)
    if literal is not None and predicate is not None:
        asked = asked | F.col("variable_id").isin(*literal)
    for keyword in category_keywords(subjects, [c for c in codes or () if c.startswith("K")]):
        asked = asked | F.coalesce(F.contains(F.lower("subject_name"), F.lit(keyword)), F.lit(False))
    if predicate is not None:
        return codebook.where(asked & predicate).select("variable_id").distinct()
    found = [codebook.where(asked).select("variable_id")] if codes is not None else []
    if literal is not None:
        found.append(literal_table(codebook.sparkSession, literal, "variable_id", "int"))
    return union_ids(*found)
