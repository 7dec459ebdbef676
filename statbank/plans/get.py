"""Observations by variable, subject, level, year, unit and dimension."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statbank import schema as S
from statbank.operators import filters
from statbank.operators.dataset import with_labels
from statbank.operators.resolve import level_of, resolve_ids
from statbank.plans.store import Store
from statbank.sources.scan import indexed_scan, of_ids, settled_ids


def get(
    store: Store,
    variables: Sequence[int] | None = None,
    subjects: Sequence[str] | None = None,
    level: str = "gmina",
    years: Sequence[int] | None = None,
    units: Sequence[str] | None = None,
    dims: Mapping[str, object] | None = None,
    aggregate: bool = False,
    add_labels: bool = True,
) -> DataFrame:
    """Resolve ids on the codebook, scan the level, attach labels.

    The ids are computed here, once, by one pass over the codebook; a laid-out store then reads only the files that
    hold one of them. The rest is lazy.

    `subjects` takes subject codes and category codes, `units` ids or exact names, `dims`
    values per dimension with None for a missing one. A request that resolves to no variable
    returns no rows.
    """
    if variables is None and subjects is None:
        raise ValueError("give variables, subjects or both")
    if aggregate and dims is not None:
        raise ValueError("give aggregate or dims, not both")
    of_level = F.col("unitLevel") == level_of(level)
    if subjects is None and dims is None and not aggregate:
        ids = tuple(int(i) for i in variables)
    else:
        ids = settled_ids(resolve_ids(store.codebook, store.subjects, variables, subjects, dims, aggregate))
    facts = store.facts.where(of_level)
    if store.index is None:
        facts = of_ids(facts, ids)
    else:
        facts = indexed_scan(facts, store.root, store.index.where(of_level), store.manifest.where(of_level), ids)
    if years is not None:
        facts = facts.where(filters.years_in(years))
    if units is not None:
        facts = facts.where(filters.units_any(units))
    observations = facts.select(*S.OBSERVATION)
    return with_labels(observations, store.codebook) if add_labels else observations
