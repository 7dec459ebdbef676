"""The explorer: resolve a facet choice, collect a selection, build and export its dataset."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from statbank import schema as S
from statbank.operators import dataset, facets, filters, series
from statbank.plans.store import Store
from statbank.session import literal_table, materialized
from statbank.sinks.datasets import write_csv, write_dataset
from statbank.sources.scan import Ids, of_ids, scan_ids, settled_ids


def bounded_ids(ids: DataFrame, limit: int = S.MAX_VARIABLES) -> tuple[int, ...] | None:
    """The distinct ids if there are at most `limit`, else None; never reads more than that."""
    rows = ids.select("variable_id").distinct().limit(limit + 1).collect()
    return None if len(rows) > limit else tuple(sorted(r.variable_id for r in rows))


@dataclass(frozen=True)
class Selection:
    """An immutable selection: variables, optional units, levels and years.

    The explorer's selection holds at most 60 variables. With limit=None it holds any number: up to a few thousand
    as values, more of them as a stored table of ids.
    """

    variables: Ids = ()
    units: tuple[str, ...] = ()
    levels: tuple[int, ...] = ()
    year_from: int | None = None
    year_to: int | None = None
    limit: int | None = S.MAX_VARIABLES

    @property
    def many_variables(self) -> bool:
        return not isinstance(self.variables, tuple) or len(self.variables) > 1

    def _held(self, spark: SparkSession) -> DataFrame:
        if not isinstance(self.variables, tuple):
            return self.variables
        return literal_table(spark, self.variables, "variable_id", "int")

    def add(self, ids: DataFrame) -> "Selection":
        """Add resolved variables; refused beyond the limit unless all are in already."""
        if self.limit is None:
            both = self._held(ids.sparkSession).unionByName(ids.select("variable_id"))
            return replace(self, variables=settled_ids(both.distinct()))
        found = bounded_ids(ids, self.limit)
        if found is None:
            raise ValueError(f"too many variables: a selection holds {self.limit}")
        held = set(self.variables)
        if len(held) + len(found) > self.limit and not held.issuperset(found):
            raise ValueError(f"too many variables: a selection holds {self.limit}")
        return replace(self, variables=tuple(sorted(held.union(found))))

    def remove(self, ids: Sequence[int]) -> "Selection":
        if not isinstance(self.variables, tuple):
            return replace(self, variables=settled_ids(self.variables.where(~filters.variables_in(ids))))
        return replace(self, variables=tuple(v for v in self.variables if v not in set(ids)))

    def clear(self) -> "Selection":
        return replace(self, variables=())

    def with_levels(self, levels: Sequence[int], units: DataFrame) -> "Selection":
        """Change the levels and drop selected units known to be of another level."""
        kept = self.units
        if kept:
            chosen = units.where(filters.unit_ids_in(kept)).select("unitId", "unitLevel")
            stale = chosen.groupBy("unitId").agg(
                F.max(F.col("unitLevel").isin(*levels)).alias("fits")
            )
            gone = {r.unitId for r in stale.where(~F.col("fits")).collect()}
            kept = tuple(u for u in kept if u not in gone)
        return replace(self, levels=tuple(levels), units=kept)


def selection_add(current: DataFrame, more: DataFrame, limit: int = S.MAX_VARIABLES) -> DataFrame:
    """`Selection.add` on frames: (variable_id, added). Where the union is refused, the rows are the
    current ids and `added` is false, with one row of a NULL id if there are none."""
    held = current.select("variable_id", F.lit(True).alias("held"))
    both = held.unionByName(more.select("variable_id", F.lit(False).alias("held"))).where("variable_id IS NOT NULL")
    ids = both.groupBy("variable_id").agg(F.max("held").alias("held"), F.min("held").alias("both"))
    counts = ids.agg(
        F.count_if("held").alias("held"), F.count_if(~F.col("held") | ~F.col("both")).alias("added"), F.count_if(~F.col("held")).alias("fresh")
    )
    refused = counts.select((F.col("added") > limit) | ((F.col("held") + F.col("added") > limit) & (F.col("fresh") > 0))).first()[0]
    if not refused:
        return ids.select("variable_id", F.lit(True).alias("added"))
    kept = ids.where("held").select("variable_id")
    nothing = current.sparkSession.range(1).select(F.lit(None).cast(kept.schema["variable_id"].dataType).alias("variable_id"))
    return (kept if not kept.isEmpty() else nothing).select("variable_id", F.lit(False).alias("added"))


def selection_remove(current: DataFrame, gone: DataFrame) -> DataFrame:
    """`Selection.remove` on frames."""
    return current.select("variable_id").join(gone.select("variable_id"), "variable_id", "left_anti")


def resolve(store: Store, subject: str, ticks: Mapping[str, Sequence[str]]) -> DataFrame:
    """Variables of a subject whose value is ticked in every active dimension."""
    rows = store.bilingual.where(F.col("subjectId") == subject)
    return facets.pick(rows, ticks).select(
        "variable_id", "variable_full_name", "variable_full_name_en", "measureUnitName"
    )


def observations(store: Store, selection: Selection) -> DataFrame:
    """The selected slice of the fact table."""
    facts = store.facts.where(F.col("unitLevel").isin(*selection.levels))
    facts = facts.where(filters.year_range(selection.year_from, selection.year_to))
    if selection.units:
        facts = facts.where(filters.unit_ids_in(selection.units))
    found = scan_ids(facts, store.manifest, selection.variables)
    return found.select(*S.OBSERVATION)


def build(store: Store, selection: Selection) -> tuple[DataFrame, DataFrame]:
    """(one-row total, preview) of a selection."""
    rows = observations(store, selection)
    return rows.agg(F.count("*").alias("total")), dataset.preview(rows)


def series_chart(store: Store, selection: Selection, lang: str = "pl") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(named points of the top series with the number of all series, axis domain, measure check) of a selection.

    Series are ranked once: their stored keys serve the points, the names and the axes. A store with a layout by
    series is read once for all of them.
    """
    if store.series is not None:
        return _series_chart(store, selection, lang)
    rows = observations(store, selection)
    ranked = series.series(rows)
    keys = materialized(series.ranked(ranked), "series")
    shown = series.points_of(rows, keys)
    named, measures = _named(store, selection, shown, lang)
    named = named.join(F.broadcast(keys.select(*series.SERIES, "n_series")), series.SERIES)
    return named, series.domain(rows, shown), measures


def _named(store: Store, selection: Selection, shown: DataFrame, lang: str) -> tuple[DataFrame, DataFrame]:
    chosen = store.bilingual if store.subjects_en is not None and store.variables_en is not None else store.codebook
    chosen = of_ids(chosen, selection.variables)
    many = len(selection.levels) > 1, selection.many_variables
    return series.named_points(shown, store.units, chosen, *many, lang), series.mixed_measures(chosen)


def selected_series(store: Store, selection: Selection) -> DataFrame:
    """The selection's rows of the layout by series, with their means."""
    rows = of_ids(store.series.where(F.col("unitLevel").isin(*selection.levels)), selection.variables)
    if selection.units:
        rows = rows.where(filters.unit_ids_in(selection.units))
    return series.with_means(rows, selection.year_from, selection.year_to)


def _series_chart(store: Store, selection: Selection, lang: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`series_chart` by one pass over the layout by series: what the axes and the note need is observed on the way
    to the best rows, which are stored."""
    seen = Observation("series")
    years = F.array_distinct(F.flatten(F.collect_set(F.transform("points", lambda p: p["year"]))))
    rows = selected_series(store, selection).observe(seen, F.count_if(F.col("n_points") > 0).alias("n_series"), years.alias("years"))
    shown = series.points_of_rows(materialized(series.best_rows(rows).select(*series.SERIES, "held"), "series"))
    named, measures = _named(store, selection, shown, lang)
    held = sorted(seen.get["years"] or [])
    domain = shown.agg(
        F.lit(len(held)).cast("bigint").alias("n_years"),
        F.lit(held[0] if held else None).cast("smallint").alias("year_min"),
        F.lit(held[-1] if held else None).cast("smallint").alias("year_max"),
        F.least(F.lit(0.0), F.min("value")).alias("y_min"),
        F.max("value").alias("y_max"),
    )
    return named.withColumn("n_series", F.lit(seen.get["n_series"]).cast("bigint")), domain, measures


def export(
    store: Store,
    selection: Selection,
    path: str,
    layout: str = "long",
    per_level: bool = False,
    docs: bool = True,
) -> None:
    """Write the dataset of a selection as CSV, with its documentation table beside it."""
    chosen = of_ids(store.bilingual, selection.variables)
    rows = observations(store, selection)
    data = dataset.wide(rows, chosen, limit=selection.limit) if layout == "wide" else dataset.long(rows, chosen)
    write_dataset(data, f"{path}/data", per_level and len(selection.levels) > 1)
    if docs:
        write_csv(dataset.codebook_doc(chosen, chosen.select("variable_id")).orderBy("variable_id"), f"{path}/codebook")
