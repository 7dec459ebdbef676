"""Predicates. Each returns a Column, so Catalyst can push it to the scan."""

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from statbank import schema as S
from statbank.functions import text


def all_of(parts: Iterable[Column]) -> Column:
    return reduce(and_, parts, F.lit(True))


def any_of(parts: Iterable[Column]) -> Column:
    return reduce(or_, parts, F.lit(False))


def variables_in(ids: Sequence[int]) -> Column:
    """One expression text: a long list of single literals takes the driver seconds to hand over."""
    return F.expr(f"variable_id IN ({', '.join(str(int(i)) for i in ids)})") if ids else F.lit(False)


def years_in(years: Sequence[int]) -> Column:
    return F.col("year").isin(*[int(y) for y in years])


def year_range(first: int | None = None, last: int | None = None) -> Column:
    ends = []
    if first is not None:
        ends.append(F.col("year") >= first)
    if last is not None:
        ends.append(F.col("year") <= last)
    return all_of(ends)


def unit_ids_in(ids: Sequence[str]) -> Column:
    return F.col("unitId").isin(*ids)


def units_any(units: Sequence[str]) -> Column:
    """Digits are unit ids (zeros restored), anything else an exact unit name."""
    given = [str(u).strip() for u in units]
    numbers = [u.rjust(12, "0") for u in given if u.isascii() and u.isdigit()]
    names = [u for u in given if not (u.isascii() and u.isdigit())]
    tests = []
    if numbers:
        tests.append(F.col("unitId").isin(*numbers))
    if names:
        tests.append(F.col("unitName").isin(*names))
    return any_of(tests)


def dims_predicate(dims: Mapping[str, object]) -> Column:
    """AND over dimensions, IN within one; None among the values admits a missing one."""
    tests = []
    for dim, given in dims.items():
        if dim not in S.DIMS:
            raise ValueError(f"unknown dimension: {dim}")
        values = [given] if given is None or isinstance(given, str) else list(given)
        named = [v for v in values if v is not None]
        choices = []
        if named:
            choices.append(F.col(dim).isin(*named))
        if len(named) < len(values) or not named:
            choices.append(text.is_missing(F.col(dim)))
        tests.append(any_of(choices))
    return all_of(tests)


def aggregate_predicate() -> Column:
    """The headline figure: total in the first dimension, total or missing in the next two."""
    return dims_predicate({"n1": S.TOTAL, "n2": [S.TOTAL, None], "n3": [S.TOTAL, None]})


def level_exact(level: int) -> Column:
    return F.col("unit_level") == level


def level_available(levels: Sequence[int]) -> Column:
    """Published at some selected level: the finest level is at or below the coarsest one."""
    return F.col("unit_level") >= min(levels, default=1)


def subject_prefix(prefix: str) -> Column:
    return F.col("subjectId").startswith(prefix)


def contains_any(query: str, columns: Sequence[str]) -> Column:
    """Case-insensitive substring in any column; % and _ are ordinary characters."""
    needle = F.lower(F.lit(query))
    return any_of(F.contains(F.lower(F.col(c)), needle) for c in columns)


def term_in(term: str, columns: Sequence[str], stems: bool = True) -> Column:
    forms = text.literal_variants(term) if stems else [term]
    return any_of(F.col(c).contains(form) for form in forms for c in columns)


def terms_all(query: str, columns: Sequence[str], stems: bool = True) -> Column:
    """Every word of the query, in some form, in some column; nothing if no word is left."""
    terms = text.query_terms(query)
    return all_of(term_in(t, columns, stems) for t in terms) if terms else F.lit(False)


def long_enough(query: Column) -> Column:
    return F.length(text.stripped(query)) >= S.MIN_QUERY


def level_in_or_unknown(levels: Sequence[int]) -> Column:
    """Units of the levels, and units whose level is not known."""
    return F.col("unitLevel").isNull() | F.col("unitLevel").isin(*levels)


def key_range(lo: int, hi: int, key: str = "variable_id") -> Column:
    return F.col(key).between(lo, hi)


def leading_zero(c: str = "unitId") -> Column:
    return F.col(c).startswith("0")
