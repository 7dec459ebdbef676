"""Label, search-key and naming expressions. Everything is a Column, so it stays inside the JVM."""

import re
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statbank import schema as S

SPACE = r"[\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]+"
# Suffixes of the light English stemmer, in the order they are tried, and
# spacing marks that a typed query loses together with its accents.
SUFFIXES = ("ments", "ment", "tions", "tion", "sions", "sion", "ing", "ers", "ed", "es", "s")
SPACING_MARKS = "^`¨¯´·¸"
STEM_MIN_TERM = 6
STEM_MIN_LEFT = 4


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """translate() arguments, by rule over all of Unicode: a lower-case letter whose decomposition
    is one base character plus marks becomes the base, a bare mark disappears, ł becomes l, and a
    letter with several bases stays."""
    source, target, dropped = ["ł"], ["l"], []
    for code in range(0x80, 0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        char = chr(code)
        if unicodedata.category(char) == "Mn":
            dropped.append(char)
            continue
        base = [c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"]
        if char == char.lower() and len(base) == 1 and base[0] != char:
            source.append(char)
            target.append(base[0])
    return "".join(source + dropped), "".join(target)


@lru_cache(maxsize=1)
def _literal_table() -> dict[int, str | None]:
    source, target = _fold_table()
    letters = dict(zip(map(ord, source), target, strict=False))
    return letters | {ord(c): None for c in source[len(target) :] + SPACING_MARKS}


def fold(c: Column) -> Column:
    """Lower-cased text without accents; ł counts as l, other stroked letters stay."""
    source, target = _fold_table()
    return F.translate(F.lower(c), source, target)


def fold_query(c: Column) -> Column:
    """`fold` for text a user typed: spacing accent marks go as well."""
    source, target = _fold_table()
    return F.translate(F.lower(c), source + SPACING_MARKS, target)


def fold_literal(text: str) -> str:
    """`fold_query` of a plan-time string."""
    return text.lower().translate(_literal_table())


def stripped(c: Column) -> Column:
    """A query without blanks of any kind at its ends."""
    return F.regexp_replace(c, f"^{SPACE}|{SPACE}$", "")


def strip_literal(text: str) -> str:
    """`stripped` of a plan-time string."""
    return re.sub(f"^{SPACE}|{SPACE}$", "", text, flags=re.ASCII)


def query_terms(text: str) -> list[str]:
    return [t for t in re.split(SPACE, fold_literal(text), flags=re.ASCII) if t]


def terms(c: Column) -> Column:
    """Array of the folded, non-empty words of a query column."""
    return F.filter(F.split(fold_query(c), SPACE), lambda t: t != "")


def words(c: Column) -> Column:
    """The different words of a text. Splitting at the common blanks is enough to look up
    query words, which contain no blank of any kind, and much faster than splitting at all."""
    return F.array_distinct(F.split(c, r"\s+"))


def null_tokens(c: Column) -> Column:
    """NULL for the empty string and for 'NA' (English labels)."""
    return F.nullif(F.nullif(c, F.lit("")), F.lit(S.MISSING))


def non_missing(c: Column) -> Column:
    """NULL for 'NA' only: Polish dimensions keep the empty string."""
    return F.nullif(c, F.lit(S.MISSING))


def is_missing(c: Column) -> Column:
    return c.isNull() | (c == S.MISSING)


def dim_label(dims: Sequence[Column]) -> Column:
    """Dimension values joined with ' | '; pass them through non_missing or null_tokens first."""
    return F.trim(F.concat_ws(" | ", *dims))


def full_name(subject: Column, dims: Column) -> Column:
    return F.concat_ws(": ", subject, dims)


def full_name_en(subject: Column, dims: Column) -> Column:
    return F.nullif(F.concat_ws(": ", subject, F.nullif(dims, F.lit(""))), F.lit(""))


def search_key(subject: Column, dims: Column) -> Column:
    """NULL when the subject has no name, so such variables are not searchable."""
    return fold(F.concat(subject, F.lit(" "), F.coalesce(dims, F.lit(""))))


def search_key_en(subject: Column, dims: Column) -> Column:
    """Lower-cased but not folded."""
    empty = F.lit("")
    return F.lower(F.concat(F.coalesce(subject, empty), F.lit(" "), F.coalesce(dims, empty)))


def voivodeship(unit: Column) -> Column:
    return F.substring(unit, 3, 2)


def unit_id(c: Column) -> Column:
    """Digits-only ids get their leading zeros back; longer ids and other text stay."""
    trimmed = F.trim(c, F.lit(" \t\r\n"))
    short_number = trimmed.rlike("^[0-9]+$") & (F.length(trimmed) < 12)
    return F.when(short_number, F.lpad(trimmed, 12, "0")).otherwise(trimmed)


def _named(c: Column, names: dict[int, str]) -> Column:
    chain = None
    for code, name in names.items():
        chain = F.when(c == code, name) if chain is None else chain.when(c == code, name)
    return chain


def level_name(c: Column, doc: bool = False) -> Column:
    return _named(c, S.DOC_LEVEL_NAMES if doc else S.LEVEL_NAMES).otherwise(c.cast("string"))


def level_name_short(c: Column) -> Column:
    return _named(c, S.SHORT_LEVEL_NAMES)


def fact_table_name(c: Column) -> Column:
    return _named(c, S.FACT_TABLES)


def level_code(c: Column) -> Column:
    """Level aliases to codes; an unknown alias raises."""
    alias = F.lower(F.trim(c, F.lit(" \t\r\n")))
    chain = None
    for code, names in S.LEVEL_ALIASES.items():
        hit = alias.isin(*names)
        chain = F.when(hit, F.lit(code)) if chain is None else chain.when(hit, F.lit(code))
    message = F.concat(F.lit("unknown level: "), F.coalesce(c, F.lit("NULL")))
    return chain.otherwise(F.raise_error(message).cast("int"))


def bilingual(pl: Column, en: Column, lang: str) -> tuple[Column, Column]:
    """(main, sub) label: the active language leads, the other follows if it differs."""
    pl, en = F.nullif(pl, F.lit("")), F.nullif(en, F.lit(""))
    first, second = (pl, en) if lang == "pl" else (en, pl)
    main = F.coalesce(first, second, F.lit(""))
    sub = F.when(second.isNotNull() & ~second.eqNullSafe(first), second)
    return main, sub


def measure_shown(c: Column) -> Column:
    return F.nullif(F.nullif(c, F.lit("-")), F.lit(""))


def axis_labels(name: Column, n: Column, lang: str) -> Column:
    """Names of the n breakdown axes taken from a subject title, else NULL."""
    if lang == "en":
        pattern, separator = r"(?i)\bby\s+(.+)$", r"\s*,\s*|\s+and\s+"
    else:
        pattern, separator = r"(?iu)(?:wg|według)\s+(.+)$", r"\s*,\s*|\s+i\s+"
    words = F.split(F.regexp_extract(name, pattern, 1), separator)
    parts = F.filter(F.transform(words, lambda w: F.trim(w)), lambda w: w != "")
    titled = F.transform(
        parts, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.right(w, F.length(w) - 1))
    )
    return F.when(name.rlike(pattern) & (F.size(parts) == n), titled)


def axis_labels_or_default(name: Column, n: Column, word: str = "Breakdown") -> Column:
    numbered = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit(f"{word} "), i.cast("string")))
    default = F.when(n > 1, numbered).when(n == 1, F.array(F.lit(word)))
    return F.coalesce(axis_labels(name, n, "pl"), default)


def term_variants(c: Column) -> Column:
    """The term, its ies→y form and one light stem, as an array without repeats."""
    long_enough = F.length(c) >= STEM_MIN_TERM
    singular = F.when(
        long_enough & c.endswith("ies"), F.concat(F.left(c, F.length(c) - 3), F.lit("y"))
    )
    stem = None
    for suffix in SUFFIXES:
        fits = c.endswith(suffix) & (F.length(c) - len(suffix) >= STEM_MIN_LEFT)
        cut = F.left(c, F.length(c) - len(suffix))
        stem = F.when(fits, cut) if stem is None else stem.when(fits, cut)
    return F.array_distinct(F.array_compact(F.array(c, singular, F.when(long_enough, stem))))


def literal_variants(term: str) -> list[str]:
    """`term_variants` of a plan-time string."""
    found = [term]
    if len(term) >= STEM_MIN_TERM:
        if term.endswith("ies"):
            found.append(term.removesuffix("ies") + "y")
        fitting = (s for s in SUFFIXES if term.endswith(s) and len(term) - len(s) >= STEM_MIN_LEFT)
        suffix = next(fitting, None)
        if suffix:
            found.append(term.removesuffix(suffix))
    return list(dict.fromkeys(found))


def series_name(
    unit: Column, level: Column, variable: Column, many_levels: Column, many_variables: Column
) -> Column:
    return F.concat_ws(
        " — ",
        F.nullif(unit, F.lit("")),
        F.when(many_levels, level_name_short(level)),
        F.when(many_variables, F.nullif(variable, F.lit(""))),
    )


def with_search_keys(codebook: DataFrame) -> DataFrame:
    name, dims = F.col("subject_name"), F.col("variable_dimensions")
    name_en, dims_en = F.col("subject_name_en"), F.col("variable_dimensions_en")
    return codebook.withColumns(
        {
            "search_key": search_key(name, dims),
            "subj_norm": fold(name),
            "subj_en_norm": F.lower(F.coalesce(name_en, F.lit(""))),
            "search_key_en": search_key_en(name_en, dims_en),
        }
    )
