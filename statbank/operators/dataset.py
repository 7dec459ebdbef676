"""Labelled long and wide datasets, their documentation, previews and size reports."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statbank import schema as S
from statbank.functions import text
from statbank.operators.order import placed
from statbank.session import materialized, small_side

#: Columns of a wide dataset that one aggregation makes.
COLUMNS = 50
#: Units that a join with facts may broadcast.
FEW_UNITS = 50_000
LABELS = ["subject_name", "variable_dimensions", "measureUnitName", "variable_full_name"]


def export_order(*first: str) -> list[Column]:
    return [F.col(c) for c in first] + [F.col("unitLevel").desc(), F.col("unitId"), F.col("year")]


def with_labels(facts: DataFrame, codebook: DataFrame) -> DataFrame:
    labels = codebook.select("variable_id", *LABELS)
    return facts.join(small_side(labels), "variable_id", "left").select(*S.OBSERVATION, *LABELS)


def with_metadata(facts: DataFrame, codebook: DataFrame, *columns: str) -> DataFrame:
    """Facts of the codebook's variables only, with columns of it beside them."""
    return facts.join(small_side(codebook.select("variable_id", *columns)), "variable_id")


def with_units(facts: DataFrame, units: DataFrame, most: int = FEW_UNITS) -> DataFrame:
    """Facts with the columns of their units, a stored table of one row for (unitId, unitLevel).

    Upper levels have few units with many facts each: these levels meet their units by a broadcast, `most` rows of all
    of them together. Only the facts of the other levels are exchanged.
    """
    keys, few = ["unitId", "unitLevel"], []
    # One row per level.
    for r in units.where("unitLevel IS NOT NULL").groupBy("unitLevel").count().orderBy("count", "unitLevel").collect():
        most -= r["count"]
        if most < 0:
            break
        few.append(r.unitLevel)
    upper = F.col("unitLevel").isin(*few)
    near = facts.where(upper).join(F.broadcast(units.where(upper)), keys)
    return near.unionByName(facts.where(~upper).join(units.where(~upper), keys))


def preview(observations: DataFrame, n: int = S.PREVIEW_ROWS) -> DataFrame:
    return observations.orderBy(*export_order("variable_id")).limit(n)


def table(observations: DataFrame, n: int = S.TABLE_ROWS) -> DataFrame:
    return preview(observations, S.PREVIEW_ROWS).limit(n)


def shown_of_total(observations: DataFrame, n: int = S.TABLE_ROWS) -> DataFrame:
    counted = observations.agg(F.count("*").alias("total"))
    return counted.select(F.least("total", F.lit(n)).alias("shown"), "total")


def level_counts(observations: DataFrame) -> DataFrame:
    return observations.groupBy("unitLevel").agg(F.count("*").alias("n"))


def estimate(total: DataFrame) -> DataFrame:
    """Size text and feasibility flag from a one-row frame with the column `total`."""
    size = F.col("total") * S.BYTES_PER_ROW
    kilobytes = F.concat(F.greatest(F.lit(1), F.floor(size / 1e3 + 0.5)).cast("string"), F.lit(" KB"))
    small_mb = F.concat(F.format_number(size / 1e6, 1), F.lit(" MB"))
    large_mb = F.concat(F.floor(size / 1e6 + 0.5).cast("string"), F.lit(" MB"))
    return total.select(
        "total",
        size.alias("bytes"),
        F.when(size < 1_000_000, kilobytes).when(size < 10_000_000, small_mb).otherwise(large_mb).alias("size"),
        F.when(F.col("total") > S.HEAVY_ROWS, "heavy")
        .when(F.col("total") > S.WARN_ROWS, "warn")
        .otherwise("ok")
        .alias("feasibility"),
    )


def summary(observations: DataFrame) -> DataFrame:
    """Scope of a selection in one row, by one pass: rows are reduced to their distinct keys where they are read."""
    keys = ["variable_id", "unitLevel", "unitId"]
    sets = [[F.col("variable_id"), F.col("unitLevel")], [F.col("unitId")]]
    counted = observations.select(*keys, "year").groupingSets(sets, *keys).agg(
        F.count("*").alias("n"), F.min("year").alias("lo"), F.max("year").alias("hi"), F.grouping("variable_id").alias("of_units")
    )
    of_variable = F.col("of_units") == 0
    return counted.agg(
        F.coalesce(F.sum(F.when(of_variable, F.col("n"))), F.lit(0)).alias("observations"),
        F.countDistinct("variable_id").alias("variables"),
        F.countDistinct("unitLevel").alias("levels"),
        F.count(F.when(~of_variable, F.col("unitId"))).alias("units"),
        F.min("lo").alias("year_from"),
        F.max("hi").alias("year_to"),
    )


def long(observations: DataFrame, codebook: DataFrame) -> DataFrame:
    """One labelled row per observation."""
    names = codebook.select("variable_id", F.col("variable_full_name").alias("variable_name"))
    return observations.join(small_side(names), "variable_id", "left").select(
        "variable_id",
        "variable_name",
        "unitId",
        "unitName",
        "unitLevel",
        text.level_name(F.col("unitLevel")).alias("level"),
        "year",
        "value",
    )


def indicator_labels(codebook: DataFrame, key: str = "variable_full_name", limit: int | None = S.MAX_VARIABLES) -> list[str]:
    """Column headings of a wide dataset; refused beyond `limit`, if there is one."""
    found = codebook.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("label")).distinct()
    rows = (found if limit is None else found.limit(limit + 1)).collect()
    if limit is not None and len(rows) > limit:
        raise ValueError(f"a wide dataset takes at most {limit} indicators")
    return sorted(r.label for r in rows)


def wide(
    observations: DataFrame,
    codebook: DataFrame,
    labels: Sequence[str] | None = None,
    key: str = "variable_full_name",
    limit: int | None = S.MAX_VARIABLES,
) -> DataFrame:
    """Unit × year rows with one column per indicator.

    Columns are gathered in blocks of COLUMNS: a first aggregation has one row for a unit, year and block, a second one
    puts the blocks beside each other. So neither has more aggregates than a block or the number of blocks, and
    its generated code stays small for thousands of indicators.

    Indicators that share a name share a column, which takes the smallest variable's value;
    key="variable_id" keeps them apart.
    """
    if labels is None:
        labels = indicator_labels(codebook, key, limit)
    names = codebook.select("variable_id", F.col(key).cast("string").alias("indicator")) if (
        key != "variable_id"
    ) else codebook.select("variable_id", F.col("variable_id").cast("string").alias("indicator"))
    # The heading becomes a small number beside the metadata; facts are grouped by narrow keys.
    place = F.array_position(F.array(*map(F.lit, labels)).cast("array<string>"), F.col("indicator"))
    names = names.select("variable_id", F.when(place > 0, place - 1).cast("int").alias("column"))
    keyed = observations.join(small_side(names), "variable_id", "left")
    key_columns = ["unitId", "unitName", "unitLevel", "year"]
    lanes = range(min(COLUMNS, max(1, len(labels))))
    keyed = keyed.select(*key_columns, "variable_id", "value", F.expr(f"column DIV {COLUMNS}").alias("block"), F.expr(f"column % {COLUMNS}").alias("lane"))
    lane_values = [F.expr(f"min_by(value, variable_id) FILTER (WHERE lane = {i})").alias(f"v{i}") for i in lanes]
    if len(labels) <= COLUMNS:
        data = keyed.groupBy(*key_columns).agg(*lane_values)
        cells = [F.col(f"v{i}") for i in range(len(labels))]
    else:
        blocks = keyed.groupBy(*key_columns, "block").agg(*lane_values)
        row = F.struct(*[F.col(f"v{i}") for i in lanes])
        gathered = [F.first(F.when(F.col("block") == b, row), ignorenulls=True).alias(f"b{b}") for b in range(-(-len(labels) // COLUMNS))]
        data = blocks.groupBy(*key_columns).agg(*gathered)
        cells = [F.col(f"b{i // COLUMNS}.v{i % COLUMNS}") for i in range(len(labels))]
    level = text.level_name(F.col("unitLevel")).alias("level")
    return data.select("unitId", "unitName", "unitLevel", level, "year", *[c.alias(x) for c, x in zip(cells, labels, strict=True)])


def wide_blocks(observations: DataFrame, codebook: DataFrame, key: str = "variable_full_name") -> tuple[DataFrame, DataFrame]:
    """`wide` for any number of indicators: (data, headings).

    A table has no room for a column per variable once there are many thousands. So the columns are numbered by their
    headings, in order, and cut into blocks of COLUMNS: data has a row for each unit, year and block with a fact of
    it (`block`, then v0, v1, ...), and headings tells which indicator a block's column shows (indicator, block, lane).
    The plan is as large for any number of indicators, and headings are never sent to the driver.
    """
    names = codebook.where(F.col(key).isNotNull()).select("variable_id", F.col(key).cast("string").alias("indicator"))
    numbered = placed(names.select("indicator").distinct(), ["indicator"])
    headings = materialized(
        numbered.select("indicator", F.expr(f"CAST((place - 1) DIV {COLUMNS} AS int)").alias("block"), F.expr(f"CAST((place - 1) % {COLUMNS} AS int)").alias("lane")),
        "headings",
    )
    columns = names.join(small_side(headings), "indicator").select("variable_id", "block", "lane")
    keyed = observations.join(small_side(columns), "variable_id")
    if key == "variable_id":
        # Hardly two facts of a row lie in one task, and a row of a block is far wider than its facts: they are exchanged, by
        # block, where `block_cells` meets the headings as well. Names in common are combined before the exchange.
        keyed = keyed.select("unitId", "unitName", "unitLevel", "year", "variable_id", "value", "block", "lane").repartition("block")
    lanes = [F.expr(f"min_by(value, variable_id) FILTER (WHERE lane = {i})").alias(f"v{i}") for i in range(COLUMNS)]
    data = keyed.groupBy("unitId", "unitName", "unitLevel", "year", "block").agg(*lanes)
    level = text.level_name(F.col("unitLevel")).alias("level")
    return data.select("unitId", "unitName", "unitLevel", level, "year", "block", *[f"v{i}" for i in range(COLUMNS)]), headings


def block_cells(data: DataFrame, headings: DataFrame) -> DataFrame:
    """`wide_blocks` read as rows again: a row for each cell with a value (unitId, unitName, unitLevel, year, indicator, value)."""
    # The headings of a block are one row, so rows find them by the block and cells by their places.
    names = headings.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("lane", "indicator"))).alias("names"))
    names = names.select("block", F.col("names.indicator").alias("names")).hint("shuffle_hash")
    rows = data.select("unitId", "unitName", "unitLevel", "year", "block", *[f"v{i}" for i in range(COLUMNS)]).join(names, "block")
    cells = F.array(*[F.struct(F.get("names", F.lit(i)).alias("indicator"), F.col(f"v{i}").alias("value")) for i in range(COLUMNS)])
    filled = F.explode(F.filter(cells, lambda x: x["value"].isNotNull())).alias("x")
    return rows.select("unitId", "unitName", "unitLevel", "year", filled).select("unitId", "unitName", "unitLevel", "year", "x.*")


def codebook_doc(codebook: DataFrame, ids: DataFrame) -> DataFrame:
    """Documentation of the selected variables, from a bilingual codebook."""
    chosen = codebook.join(ids.select("variable_id"), "variable_id", "left_semi")
    return chosen.select(
        "variable_id",
        F.col("variable_full_name").alias("variable_name"),
        F.col("variable_full_name_en").alias("variable_name_en"),
        F.col("subject_name").alias("subject_pl"),
        F.col("subject_name_en").alias("subject_en"),
        F.col("variable_dimensions").alias("breakdown_pl"),
        F.col("variable_dimensions_en").alias("breakdown_en"),
        F.col("measureUnitName").alias("measure_unit"),
        F.col("measureUnitName_en").alias("measure_unit_en"),
        text.level_name(F.col("unit_level"), doc=True).alias("lowest_level"),
        "subjectId",
    )
