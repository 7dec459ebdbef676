"""Layout, store, scans, selection and export."""

from dataclasses import replace
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from catalog.sources import _damaged, _extracts
from statbank import Selection, Store, build_store, export, export_store, get
from statbank import schema as S
from statbank.operators import dataset, facets, metadata, series
from statbank.operators.resolve import resolve_ids
from statbank.plans import explore
from statbank.plans.store import lay_out, with_series
from statbank.session import COLUMN_BYTES, ROW_BYTES, literal_table, plan_bytes, row_bytes, small_side, workspace
from statbank.sinks import datasets, layout
from statbank.sinks.index import read_key_index
from statbank.sinks.series_table import series_rows
from statbank.sources import files, scan


def rows(frame):
    return sorted(map(repr, frame.collect()))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


FACT_COLUMNS = S.FACT.names


def test_same_total_at_every_level(tables):
    totals = tables.facts.groupBy("unitLevel").agg(F.sum("value").alias("total")).collect()
    assert len(totals) == 5 and len({r.total for r in totals}) == 1


def test_units_cover_facts(tables):
    lost = tables.facts.join(tables.units, ["unitId", "unitLevel"], "left_anti")
    assert lost.count() == 0


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_prefix_sum_is_block_independent(tables, block):
    counts = layout.key_counts(tables.facts_at([1, 2]))
    assert rows(layout.prefix_sum(counts, block)) == rows(layout.prefix_sum(counts, 10**9))


def test_ranges_are_disjoint_sorted_and_covering(tables):
    facts = tables.stored.facts
    ranges = layout.equidepth_ranges(facts, 5).orderBy("unitLevel", "part").collect()
    for level in S.LEVELS:
        mine = [r for r in ranges if r.unitLevel == level]
        assert all(a.hi < b.lo for a, b in zip(mine, mine[1:]))
        assert all(r.lo <= r.hi for r in mine)
        assert sum(r.rows for r in mine) == facts.where(F.col("unitLevel") == level).count()
    assert rows(layout.equidepth_ranges(facts, 1).select("unitLevel", "rows")) == rows(
        facts.groupBy("unitLevel").agg(F.count("*").alias("rows"))
    )


def test_parts_hold_all_rows(tables, store):
    assert rows(store.facts.select(*FACT_COLUMNS)) == rows(tables.facts)
    outside = store.facts.join(store.manifest, ["unitLevel", "part"]).where(
        ~F.col("variable_id").between(F.col("var_min"), F.col("var_max"))
    )
    assert outside.count() == 0
    assert store.manifest.agg(F.sum("rows")).first()[0] == tables.facts.count()


def test_hot_key_is_spread_over_files(spark):
    hot = spark.range(3000).selectExpr(
        "CAST(IF(id % 3 = 0, 7, id % 50) AS int) AS variable_id", "lpad(CAST(id AS string), 12, '0') AS unitId",
        "'u' AS unitName", "CAST(6 AS tinyint) AS unitLevel", "CAST(2000 AS smallint) AS year",
        "CAST(id AS double) AS value", "CAST(0 AS tinyint) AS attr_id",
    )
    folder = workspace(spark, "hot")
    layout.write_parts(hot, folder, 3, rows_per_file=100)
    written = scan.read_parts(spark, folder)
    assert rows(written.select(*FACT_COLUMNS)) == rows(hot)
    sizes = written.groupBy(F.input_file_name().alias("file")).agg(
        F.count("*").alias("n"), F.sum((F.col("variable_id") == 7).cast("int")).alias("hot")
    )
    found = sizes.agg(F.max("n"), F.count_if(F.col("hot") > 0)).first()
    assert found[0] < 400 and found[1] >= 10


def test_located_parts_equal_range_join(spark, store):
    ids = store.codebook.select("variable_id")
    found = scan.locate(ids, store.manifest, block=3)
    a, b = ids.alias("a"), store.manifest.alias("b")
    brute = a.join(b, F.col("variable_id").between(F.col("var_min"), F.col("var_max")))
    assert rows(found) == rows(brute.select("unitLevel", "part", "variable_id"))


def parts_read(frame, metric="numPartitions"):
    """Partitions (or files) that the scans of an executed plan have read."""
    frame.collect()
    total, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if kind == "FileSourceScanExec" and node.metrics().contains(metric):
                total += node.metrics().apply(metric).value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


@pytest.mark.parametrize("limit", ["1m", "-1"])
def test_parts_read_do_not_depend_on_estimates(spark, store, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        of_level = store.manifest.where("unitLevel = 6")
        for one in (3, 150):
            holding = of_level.where(F.lit(one).between(F.col("var_min"), F.col("var_max"))).count()
            assert parts_read(get(store, variables=[one], level="gmina", add_labels=False)) == holding < 16
            everywhere = store.manifest.where(F.lit(one).between(F.col("var_min"), F.col("var_max"))).count()
            assert parts_read(scan.literal_scan(store.facts, store.manifest, [one])) == everywhere
            # At run time levels and parts are pruned one by one.
            pruned = parts_read(scan.pruned_scan(store.facts, store.manifest, literal_table(spark, [one], "variable_id", "int")))
            assert everywhere <= pruned < store.manifest.count()
        ids = store.codebook.where("subjectId = 'P0012'").select("variable_id")
        touched = scan.locate(ids, of_level).select("part").distinct().count()
        assert parts_read(get(store, subjects=["P0012"], level="gmina", add_labels=False)) == touched
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_layout_keeps_rows_without_key(spark):
    facts = spark.createDataFrame(
        [(v, "u", "n", lv, 2000, 1.0, 0) for v in (1, 2, None) for lv in (6, 1, None)] * 2, S.FACT.simpleString().replace("struct<", "").replace(">", "")
    )
    folder = workspace(spark, "nulls")
    placed = layout.write_parts(facts, f"{folder}/facts")
    written = scan.read_parts(spark, f"{folder}/facts")
    assert rows(written.select(*S.FACT.names)) == rows(facts.select(*S.FACT.names))
    assert layout.manifest(placed).agg(F.sum("rows")).first()[0] == 18 == written.count()


def test_parts_grow_with_the_rows(tables):
    few, many = (layout.ranges_of(layout.key_parts(layout.key_counts(tables.facts), rows_per_file=n)).where("unitLevel = 6") for n in (10**9, 300))
    assert few.count() <= 16 < many.count()
    assert few.agg(F.sum("rows")).first() == many.agg(F.sum("rows")).first()


def test_csv_is_read_by_name_and_with_doubled_quotes(spark, tmp_path):
    names = S.LABELS_RAW.names
    row = dict.fromkeys(names, "") | {"id": "1", names[1]: 'a ""q"" b, c', names[2]: "two\nlines", names[-1]: " edge "}
    for order in (names, names[::-1]):
        path = tmp_path / f"labels{order[0]}.csv"
        path.write_text(",".join(order) + "\n" + ",".join(f'"{row[c]}"' for c in order) + "\n")
        got = files.read_csv(spark, str(path), S.LABELS_RAW, lines=True).first()
        assert (got["id"], got[names[1]], got[names[2]], got[names[-1]]) == ("1", 'a "q" b, c', "two\nlines", " edge ")
    broken = tmp_path / "broken.csv"
    broken.write_text("id,other\n1,2\n")
    with pytest.raises(ValueError):
        files.read_csv(spark, str(broken), S.LABELS_RAW)
    (tmp_path / "facts").mkdir()
    for k, order in enumerate((S.FACT.names, S.FACT.names[::-1])):
        (tmp_path / "facts" / f"{k}.csv").write_text(",".join(order) + "\n")
    (tmp_path / "facts" / "0.csv").write_text(",".join(S.FACT.names) + "\n1,u,n,6,2000,1.5\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
        files.read_csv(spark, str(tmp_path / "facts"), S.FACT).collect()


def test_csv_bytes(spark, tmp_path):
    frame = spark.createDataFrame([('Ludnosc: ', '5" pipe, x', " y", 'back\\slash', None)], "a string, b string, c string, d string, e string")
    datasets.write_csv(frame.coalesce(1), str(tmp_path / "out"))
    lines = next((tmp_path / "out").glob("part-*.csv")).read_text().splitlines()
    assert lines == ["a,b,c,d,e", 'Ludnosc: ,"5"" pipe, x", y,back\\slash,']
    assert files.read_csv(spark, str(tmp_path / "out"), frame.schema).collect() == frame.collect()


def test_repeated_pages_and_answers_count_once(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"page": 0, "totalRecords": 1, "results": [{"id": 7}]}\n' * 2)
    assert [r.id for r in files.load_pages(spark, str(tmp_path / "p.json")).collect()] == [7]
    ids = spark.createDataFrame([("P1",)], "subjectId string")
    answers = spark.createDataFrame([("P1", "x"), ("P1", None), ("P1", "x")], "id string, name string")
    assert files.subject_names(ids, answers).collect() == [("P1", "x")]
    (tmp_path / "ids").write_text("P1\n")
    (tmp_path / "bad.json").write_text('{"id": "P1", "name":\n')
    with pytest.raises(Exception, match="MALFORMED"):
        files.load_subject_names(spark, str(tmp_path / "ids"), str(tmp_path / "bad.json")).collect()


def test_a_refused_union_says_so(spark):
    ids = lambda *values: literal_table(spark, values, "variable_id", "int")
    add = lambda a, b: sorted(map(tuple, explore.selection_add(a, b, 3).collect()), key=str)
    assert add(ids(1, 2), ids(2, 3)) == [(1, False), (2, False)]
    assert add(ids(1, 2, 3), ids(2, 3)) == [(1, True), (2, True), (3, True)]
    assert add(ids(), ids(1, 2, 3, 4)) == [(None, False)]
    assert add(ids(1), ids(2)) == [(1, True), (2, True)]


def test_series_are_dealt_out_once(store):
    text = plan(dataset.preview(store.facts))  # a plan without an exchange of facts by series
    assert "hashpartitioning(variable_id" not in text
    assert plan(series.series(store.facts)).count("Exchange hashpartitioning") == 1


def test_pruned_scan_prunes_partitions(store):
    ids = store.codebook.where(F.col("n1") == "small")
    want = rows(store.facts.join(ids, "variable_id", "left_semi").select(*FACT_COLUMNS))
    many = scan.pruned_scan(store.facts, store.manifest, scan.settled_ids(ids, most=0))
    assert "dynamicpruning" in plan(many) and rows(many) == want
    few = scan.pruned_scan(store.facts, store.manifest, scan.settled_ids(ids))
    assert "dynamicpruning" not in plan(few) and "PushedFilters: [In(variable_id" in plan(few) and rows(few) == want


def test_key_index_has_every_stretch(spark, store):
    """One row for each file and key; its first row and length are those of the file itself."""
    assert store.index.agg(F.sum("rows")).first()[0] == store.facts.count()
    assert rows(store.index.groupBy("unitLevel", "part", "variable_id").agg(F.sum("rows").alias("n"))) == rows(
        store.facts.groupBy("unitLevel", "part", "variable_id").agg(F.count("*").alias("n"))
    )
    one = store.index.where("unitLevel = 5").orderBy("file").first().file
    entries = store.index.where(F.col("file") == one).orderBy("variable_id").collect()
    ids = pq.ParquetFile(f"{store.root}/facts/{one}".removeprefix("file:")).read(["variable_id"])["variable_id"].to_pylist()
    assert ids == [e.variable_id for e in entries for _ in range(e.rows)]
    assert [e.first_row for e in entries] == [sum(x.rows for x in entries[:k]) for k in range(len(entries))]


def test_get_computes_ids_once_and_opens_only_their_files(spark, tables):
    store = export_store(tables.stored, workspace(spark, "small-files"), parts=12, rows_per_file=300)
    asked = dict(subjects=["P0012", "K2"], dims={"n1": "small"})
    ids = resolve_ids(store.codebook, store.subjects, None, asked["subjects"], asked["dims"])
    assert plan(ids).count("ReadSchema: struct<variable_id") == 1  # the codebook; the other scans are of subjects' names
    level = store.index.where("unitLevel = 6")
    holding = {r.file for r in level.join(ids, "variable_id", "left_semi").select("file").distinct().collect()}
    found = get(store, level="gmina", add_labels=False, **asked)
    assert len(found.inputFiles()) == len(holding) < level.select("file").distinct().count()
    assert parts_read(found, "numFiles") == len(holding) and plan(found).count("FileScan") == 1
    want = store.facts.where("unitLevel = 6").join(ids, "variable_id", "left_semi").select(*S.OBSERVATION)
    assert rows(found) == rows(want) and found.count()
    for most in (1, 10**6):  # by parts beyond so many files; ids as a table
        by = scan.indexed_scan(store.facts.where("unitLevel = 6"), store.root, level, store.manifest.where("unitLevel = 6"), scan.settled_ids(ids, 0), most)
        assert rows(by.select(*S.OBSERVATION)) == rows(want)
    none = get(store, subjects=["P404"], level="gmina", add_labels=False)
    assert none.count() == 0 and none.columns == found.columns


def test_key_index_keeps_rows_without_key(spark, tmp_path):
    facts = spark.createDataFrame([(i % 3 or None, "u", "n", 6 if i % 2 else None, 2000, 1.0, 0) for i in range(30)], S.FACT)
    lay_out(Store.of(facts, *[spark.createDataFrame([], t) for t in (S.VARIABLES, S.SUBJECTS)]), str(tmp_path / "x"))
    entries = read_key_index(spark, str(tmp_path / "x"))
    assert rows(entries.groupBy("unitLevel", "variable_id").agg(F.sum("rows").alias("n"))) == rows(facts.groupBy("unitLevel", "variable_id").agg(F.count("*").alias("n")))


def test_literal_scan_prunes_parts_and_row_groups(store):
    found = scan.literal_scan(store.facts, store.manifest, [3, 5])
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in text.split("Filter")[1] and "variable_id" in text
    assert "PushedFilters: [In(variable_id, [3,5])" in plan(found)
    assert rows(found.select(*FACT_COLUMNS)) == rows(store.facts.where("variable_id IN (3, 5)").select(*FACT_COLUMNS))
    assert scan.literal_scan(store.facts, store.manifest, [10**6]).count() == 0
    assert scan.literal_scan(store.facts, None, [3, 5]).count() == found.count()


def test_get_reads_files_of_the_level_and_pushes_ids_and_years(store):
    found = get(store, subjects=["P0012"], level="gmina", years=[1997])
    assert "PushedFilters: [In(variable_id" in plan(found) and "EqualTo(year,1997)" in plan(found)
    opened = [f for f in found.inputFiles() if "/facts/" in f]
    assert opened and all("/facts/unitLevel=6/" in f for f in opened)


def test_preview_is_a_top_k(store):
    assert "TakeOrderedAndProject" in plan(dataset.preview(store.facts))


def test_get_arguments(store):
    with pytest.raises(ValueError):
        get(store)
    with pytest.raises(ValueError):
        get(store, variables=[1], aggregate=True, dims={"n1": "x"})
    with pytest.raises(ValueError):
        get(store, variables=[1], level="kraj")
    some = get(store, variables=[1, 2], level="makro" + "region", add_labels=False)
    assert some.columns == S.OBSERVATION and some.count() > 0
    assert get(store, subjects=["P404", "K404"], level="woj").count() == 0
    assert get(store, variables=[], level="woj").count() == 0
    assert get(store, variables=[1], level="woj", units=["nowhere"]).count() == 0
    both = get(store, variables=[1], subjects=["P0012"], level="woj", add_labels=False)
    expected = store.facts.where("unitLevel = 2").join(
        store.codebook.where("variable_id = 1 OR subjectId = 'P0012'"), "variable_id", "left_semi"
    )
    assert both.count() == expected.count()


def test_get_is_the_same_on_a_plain_store(tables, store):
    arguments = dict(subjects=["P0012", "K3"], level="podregion", dims={"n1": ["small", "ogółem"]})
    assert rows(get(tables.store, **arguments)) == rows(get(store, **arguments))


def test_build_store_round_trip(spark, tables):
    folder = workspace(spark, "raw")
    extracts = {}
    for name, level in S.RAW_FILE_LEVELS.items():
        extracts[name] = f"{folder}/{name}_all_long.csv"
        datasets.write_csv(tables.facts_at([level]), extracts[name])
    built = build_store(spark, extracts, tables.variables, tables.subjects, workspace(spark, "built"))
    assert rows(built.facts) == rows(tables.facts)
    assert built.facts.schema.names == FACT_COLUMNS
    assert built.facts.where("length(unitId) <> 12").count() == 0
    laid_out = export_store(built, workspace(spark, "laid"), parts=3)
    assert laid_out.subjects_en is None
    assert laid_out.bilingual.where("subject_name_en IS NOT NULL").count() == 0
    assert rows(Store.open(spark, laid_out.codebook.inputFiles()[0].rsplit("/", 2)[0], english=False).units) == rows(tables.units)


def test_wrong_level_in_an_extract_fails(spark, tables):
    folder = workspace(spark, "raw")
    datasets.write_csv(tables.facts_at([1]), folder)
    with pytest.raises(PySparkException, match="expected level 2"):
        files.load_fact_csv(spark, folder, 2).collect()


def test_cast_facts(spark):
    good = ("1", "010000000000", "A", "6", "2000", "1.5", "0")
    raw = spark.createDataFrame([good], ", ".join(f"{c} string" for c in FACT_COLUMNS))
    assert files.cast_facts(raw).schema.simpleString() == S.FACT.simpleString()
    bad = raw.withColumn("unitLevel", F.lit("300"))
    with pytest.raises(PySparkException):
        files.cast_facts(bad).collect()
    assert files.cast_facts(bad, lenient=True).first().unitLevel is None


def test_page_gaps(spark):
    folder = workspace(spark, "pages")
    spark.createDataFrame(
        [('{"page":0,"totalRecords":250,"results":[{"id":1,"subjectId":"P1","n1":"a"},{"id":2}]}',),
         ('{"page":2,"totalRecords":250,"results":[]}',)], "value string",
    ).write.text(folder)
    landed = files.landed_pages(spark, folder)
    assert [r.page for r in files.page_gaps(landed, 250).collect()] == [1]
    assert tuple(files.page_report(landed, 250).first()) == (2, 2, 1)
    records = files.in_page_order(files.load_pages(spark, folder)).collect()
    assert [(r.id, r.subjectId, r.n1, r.n2) for r in records] == [(1, "P1", "a", ""), (2, "", "", "")]


def test_views(spark, store):
    store.register_views()
    counted = spark.sql("SELECT count(*) AS n FROM facts_all").first().n
    parts = sum(spark.table(name).count() for name in S.FACT_TABLES.values())
    assert counted == parts
    assert spark.sql("SELECT c.subject_name FROM facts_gminy f JOIN codebook c USING (variable_id)").count() > 0


def test_selection(spark, store):
    ids = lambda *v: literal_table(spark, v, "variable_id", "int")
    chosen = Selection(levels=(6,)).add(ids(3, 1, 3))
    assert chosen.variables == (1, 3)
    assert chosen.add(ids(2)).remove([1]).variables == (2, 3)
    assert chosen.clear().variables == ()
    full = Selection().add(ids(*range(60)))
    assert full.add(ids(5, 6)).variables == full.variables
    with pytest.raises(ValueError):
        full.add(ids(60))
    with pytest.raises(ValueError):
        Selection().add(ids(*range(61)))
    units = [r.unitId for r in store.units.where("unitLevel = 2").limit(2).collect()]
    picked = Selection(units=(*units, "unknown"), levels=(2,))
    assert set(picked.with_levels((2, 5), store.units).units) == {*units, "unknown"}
    moved = picked.with_levels((5,), store.units.where("unitLevel IN (2, 5)"))
    assert moved.units == ("unknown",) and moved.levels == (5,)


def test_empty_selection_builds_nothing(store):
    total, preview = explore.build(store, Selection(levels=(1,)))
    assert total.first().total == 0 and preview.count() == 0


@pytest.mark.parametrize("format", ["long", "wide"])
@pytest.mark.parametrize("per_level", [True, False])
def test_export(spark, store, format, per_level):
    ids = store.codebook.where("n1 = 'ogółem'")
    chosen = Selection(levels=(1, 2, 6), year_from=1996).add(ids)
    folder = workspace(spark, "export")
    export(store, chosen, folder, format, per_level)
    found = spark.read.options(**S.CSV).csv(f"{folder}/data")
    observed = explore.observations(store, chosen)
    if format == "long":
        assert found.count() == observed.count()
    else:
        assert found.count() == observed.select("unitId", "unitLevel", "year").distinct().count()
    assert {len(r.unitId) for r in found.select("unitId").distinct().collect()} == {12}
    doc = spark.read.options(**S.CSV).csv(f"{folder}/codebook")
    assert doc.count() == len(chosen.variables)


def test_series_chart(store):
    ids = store.codebook.where("n1 = 'ogółem'")
    named, domain, measures = explore.series_chart(store, Selection(levels=(1, 2)).add(ids))
    assert named.select("variable_id", "unitId", "unitLevel").distinct().count() == S.MAX_SERIES
    assert all("woj." in r.series_name or "makro" in r.series_name for r in named.collect())
    assert domain.first().n_years > 0 and measures.count() == 1


def test_series_chart_by_series_reads_once(spark, store):
    """The layout by series gives the same chart, from one scan and without an exchange of facts."""
    by_series = with_series(store, workspace(spark, "by-series"))
    ids = store.codebook.where("n1 = 'ogółem'")
    for chosen in (Selection(levels=(1, 2)).add(ids), Selection(levels=(4,), year_from=1994, year_to=1996).add(ids.limit(1)), Selection(levels=(1,), year_from=2090).add(ids)):
        for mine, other in zip(explore.series_chart(by_series, chosen), explore.series_chart(store, chosen), strict=True):
            assert rows(mine.select(*other.columns)) == rows(other)
        ranked = plan(series.best_rows(explore.selected_series(by_series, chosen)))
        assert "Exchange" not in ranked and ranked.count("FileScan") == 1 and "TakeOrderedAndProject" in ranked
        assert "In(variable_id" in ranked or "EqualTo(variable_id" in ranked
    few = by_series.units.where("unitLevel = 2").orderBy("unitId").limit(2)
    chosen = Selection(levels=(2,), units=tuple(r.unitId for r in few.collect())).add(ids)
    assert rows(explore.series_chart(by_series, chosen)[0]) == rows(explore.series_chart(store, chosen)[0].select(*explore.series_chart(by_series, chosen)[0].columns))


def test_series_rows_keep_every_year(spark):
    facts = [(1, "u", "n", 6, 2001, None, 0), (1, "u", "n", 6, 2000, 2.0, 0), (1, "u", "n", 6, 2000, 3.0, 0), (1, "u", "n", 6, 2000, None, 0), (None, "u", None, None, 2000, 1.0, 0)]
    got = series_rows(spark.createDataFrame(facts, S.FACT)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", [(2000, 3.0), (2001, None)], 6), (None, "u", [(2000, 1.0)], None)], key=str)


def test_resolve_by_default_ticks(store):
    rows_of = store.bilingual.where("subjectId = 'P0012'")
    ticks = {}
    for r in facets.facet_defaults(rows_of).collect():
        ticks.setdefault(r.dim, []).append(r.value)
    picked = explore.resolve(store, "P0012", ticks).select("variable_id")
    batch = facets.pick_ticks(rows_of, facets.facet_defaults(rows_of)).select("variable_id")
    assert rows(picked) == rows(batch)


def test_broadcast_only_within_the_limit(spark):
    side = spark.range(1000).withColumn("k", F.col("id"))
    assert "BroadcastHashJoin" in plan(spark.range(10).join(small_side(side), "id"))
    assert small_side(side, limit=10) is side


def test_a_side_is_small_by_its_rows(spark, tmp_path):
    """Sorted numbers and repeated texts: a small file, and rows of many times that."""
    side = spark.range(0, 100_000, 1, 4).selectExpr("id", "CAST(id DIV 50 AS int) AS block", "repeat('name ', 20) AS name")
    side.write.option("compression", "zstd").parquet(f"{tmp_path}/side")
    side, rows = spark.read.parquet(f"{tmp_path}/side"), spark.range(10)
    few = 100_000 * (ROW_BYTES + 3 * COLUMN_BYTES + 100) - 1
    assert row_bytes(side) == few + 1 > 5 * plan_bytes(side)
    assert "BroadcastHashJoin" in plan(rows.join(small_side(side, unpacked=few + 1), "id"))
    # Neither by the hint nor by Spark's own threshold, which only knows the estimate.
    assert "BroadcastHashJoin" not in plan(rows.join(small_side(side, unpacked=few), "id", "left"))
    assert "BroadcastHashJoin" not in plan(side.join(small_side(side, limit=10, unpacked=few), "id"))
    assert small_side(side, limit=10, unpacked=few + 1) is side
    odd = spark.createDataFrame([(None, None, None), ("ab", ["x", "y"], 1)], "a string, `b.c` array<string>, d int")
    assert row_bytes(odd) > 2 * (ROW_BYTES + 3 * COLUMN_BYTES) + 2 and row_bytes(odd.limit(0)) == 0


def test_a_whole_selection_is_not_cut(spark, store, tmp_path):
    ids = store.facts.select("variable_id").distinct()
    many = Selection(levels=(1, 2), limit=None).add(spark.range(5000).select(F.col("id").cast("int").alias("variable_id")))
    assert not isinstance(many.variables, tuple) and many.many_variables
    assert many.add(ids).variables.count() == many.remove([3]).variables.count() + 1
    few = Selection(levels=(1, 2), limit=None).add(ids)
    assert len(few.variables) == ids.count() > 60
    wanted = store.facts.where("unitLevel IN (1, 2)").count()
    for chosen in (few, replace(few, variables=ids)):
        total, _ = explore.build(store, chosen)
        assert total.first().total == wanted
        explore.export(store, chosen, f"{tmp_path}/{chosen.many_variables}{isinstance(chosen.variables, tuple)}")
        assert spark.read.csv(f"{tmp_path}/{chosen.many_variables}{isinstance(chosen.variables, tuple)}/data", header=True).count() == wanted
    with pytest.raises(ValueError):
        Selection().add(ids)


def test_wide_blocks_have_a_bounded_plan(spark):
    n = 3 * dataset.COLUMNS + 7
    facts = spark.range(n).selectExpr("CAST(id AS int) AS variable_id", "'u' AS unitId", "'U' AS unitName", "CAST(1 AS tinyint) AS unitLevel", "CAST(2000 AS smallint) AS year", "IF(id = 5, NULL, id + 0.5D) AS value")
    codebook = spark.range(2 * n).selectExpr("CAST(id AS int) AS variable_id")
    data, headings = dataset.wide_blocks(facts, codebook, key="variable_id")
    assert len(data.columns) == 6 + dataset.COLUMNS and headings.count() == 2 * n
    cells = {r.indicator: r.value for r in dataset.block_cells(data, headings).collect()}
    assert cells == {str(i): i + 0.5 for i in range(n) if i != 5}


def test_wide_blocks_meet_their_headings_by_block(spark):
    """Headings are as many as variables, so they are not broadcast, and facts are exchanged once, narrow."""
    n = 2 * dataset.COLUMNS + 9
    facts = spark.range(3 * n).selectExpr(f"CAST(id % {n} AS int) AS variable_id", f"concat('u', id DIV {n}) AS unitId", "'U' AS unitName", "CAST(1 AS tinyint) AS unitLevel", "CAST(2000 AS smallint) AS year", "IF(id = 5, NULL, id + 0.5D) AS value")
    codebook = spark.range(2 * n).selectExpr("CAST(id AS int) AS variable_id", "concat('n', id % 70) AS variable_full_name")
    cells = dataset.block_cells(*dataset.wide_blocks(facts, codebook, key="variable_id"))
    found = plan(cells)
    assert "ShuffledHashJoin [block" in found and not [x for x in found.splitlines() if "HashedRelationBroadcastMode" in x and "lane" in x]
    assert [x for x in found.splitlines() if "Exchange hashpartitioning(block" in x and "lane" not in x] and "Exchange hashpartitioning(unitId" not in found
    got = {(r.unitId, r.indicator): r.value for r in cells.collect()}
    assert got == {(f"u{i // n}", str(i % n)): i + 0.5 for i in range(3 * n) if i != 5}
    by_name = dataset.block_cells(*dataset.wide_blocks(facts, codebook)).collect()
    assert {(r.unitId, r.indicator): r.value for r in by_name} == {(f"u{u}", f"n{k}"): u * n + k + 0.5 for u in range(3) for k in range(70) if (u, k) != (0, 5)}


def test_datasets_are_compressed_in_order(spark, tables, tmp_path):
    data = dataset.long(tables.facts_at([1]), tables.codebook)
    datasets.write_dataset(data, f"{tmp_path}/d")
    files = sorted(tmp_path.glob("d/part-*"))
    assert files and all(f.name.endswith(".gz") for f in files)
    assert spark.read.schema(data.schema).options(**S.CSV).csv(f"{tmp_path}/d").exceptAll(data).isEmpty()


def test_sales_are_exchanged_by_variable_once(tables):
    for frame in (dataset.long(tables.facts, tables.codebook), series.series(tables.facts, dealt=True), series_rows(tables.facts, dealt=True)):
        exchanges = [line for line in plan(frame).splitlines() if "Exchange hashpartitioning" in line]
        assert exchanges and not any("unitId" in line for line in exchanges)


def test_parts_without_a_table_of_all_keys(spark, tmp_path):
    rows = spark.range(40_000).selectExpr(
        "CAST(IF(id % 97 = 0, NULL, IF(id % 3 = 0, 7, id % 9000 - 4500)) AS int) AS variable_id", "CAST(id AS string) AS unitId", "'U' AS unitName",
        "CAST(IF(id % 89 = 0, NULL, 1 + id % 2) AS tinyint) AS unitLevel", "CAST(2000 AS smallint) AS year", "1.0D AS value", "CAST(0 AS tinyint) AS attr_id",
    )
    rows.write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    placed = layout.write_parts(stored, f"{tmp_path}/parts", 3, rows_per_file=2_000)
    written = spark.read.schema("variable_id int, unitId string, unitLevel tinyint, part int").parquet(f"{tmp_path}/parts")
    assert written.select("unitId", "variable_id", "unitLevel").exceptAll(stored.select("unitId", "variable_id", "unitLevel")).isEmpty() and written.count() == 40_000
    key = ["unitLevel", "variable_id", "part"]
    assert written.select(*key).distinct().exceptAll(placed.select(*key)).isEmpty()


def test_extracts_are_not_dealt_out_by_endpoint(tables):
    for name, folder in _damaged(tables).items():
        files = list(Path(folder).glob("part-*"))
        firsts = {f.read_text(encoding="utf-8").split("\n", 1)[0] for f in files}
        assert firsts == {"variable_id,unitId,unitName,unitLevel,year,value,attr_id"}
        assert name != "gminy" or len(files) > 3


def test_extracts_are_compressed(spark, tables):
    extracts = _extracts(tables)
    for folder in extracts.values():
        written = list(Path(folder).glob("part-*"))
        assert written and all(f.name.endswith(".csv.gz") for f in written)
    assert rows(files.load_raw_extracts(spark, extracts)) == rows(tables.facts)


def test_units_of_upper_levels_are_broadcast(spark, tables, tmp_path):
    odd = spark.createDataFrame([(1, None, "n", 6, 2000, 1.0, 0), (1, "u", "n", None, 2000, 1.0, 0)], S.FACT)
    tables.facts.unionByName(odd).write.parquet(f"{tmp_path}/facts")
    facts = scan.read_facts(spark, f"{tmp_path}/facts")
    metadata.units(facts).select("unitId", "unitLevel", "first_year").write.parquet(f"{tmp_path}/units")
    units = spark.read.parquet(f"{tmp_path}/units")
    whole = rows(facts.join(units, ["unitId", "unitLevel"]))
    for most in (0, 40, 10**6):
        assert rows(dataset.with_units(facts, units, most)) == whole
    counts = {r["unitLevel"]: r["count"] for r in units.groupBy("unitLevel").count().collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(dataset.with_units(facts, units, counts[1] + counts[2]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 1


def test_a_task_writes_a_slice_of_a_part(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "ROWS_PER_TASK", 200)
    facts = tables.stored.facts
    placed = layout.write_parts(facts, f"{tmp_path}/parts", 2)
    written = scan.read_parts(spark, f"{tmp_path}/parts")
    assert rows(written.select(*FACT_COLUMNS)) == rows(facts)
    hottest = placed.agg(F.max("n")).first()[0]
    found = written.groupBy(F.input_file_name().alias("file")).agg(
        F.count("*").alias("n"), F.min("variable_id").alias("lo"), F.max("variable_id").alias("hi"), F.first("unitLevel").alias("level")
    ).collect()
    assert max(f.n for f in found) <= 200 + hottest and len(found) > 2 * len(S.LEVELS)
    for level in S.LEVELS:
        mine = sorted((f.lo, f.hi) for f in found if f.level == level)
        assert all(a[1] <= b[0] for a, b in zip(mine, mine[1:]))
    same = layout.equidepth_ranges(facts, 2).select("unitLevel", "part", "rows")
    assert rows(same) == rows(written.groupBy("unitLevel", "part").agg(F.count("*").alias("rows")))


def test_stored_facts_are_in_order(tables):
    frame = tables.stored.facts
    held = frame.select(F.input_file_name().alias("file"), F.col("_metadata.row_index").alias("at"), "unitLevel", "variable_id", "unitId", "year").orderBy("file", "at").collect()
    keys = [(r.file, r.unitLevel, r.variable_id, r.unitId, r.year) for r in held]
    assert keys and keys == sorted(keys)
