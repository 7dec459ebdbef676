"""Two-way ingest, places in an order, and profiles as states."""

import random

import pytest
from pyspark.sql import functions as F

from statbank import schema as S
from statbank.operators import dataset, quality
from statbank.operators.order import placed, placed_by_key
from statbank.plans.store import Store, grown, lay_out
from statbank.sinks import layout
from statbank.sources.ingest import ingest_extracts

HEADER = "unitId,variable_id,unitName,unitLevel,year,value,attr_id,extra"


def extract(tmp_path, name, *files):
    folder = tmp_path / name
    folder.mkdir()
    for k, lines in enumerate(files):
        (folder / f"{k}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def test_every_line_goes_one_way(spark, tmp_path):
    good = ["011,1,\"Łódź, \"\"old\"\"\",6,2000,1.5,1,x", "012,2,,6,2001,,,", "013,3, n ,6,2002,1e3,-5,\"a,b\""]
    bad = {
        "014,4,n,6,2000,1.5,1": "cells",
        "014,4,n,6,2000,1.5,1,x,y": "cells",
        "014,4.5,n,6,2000,1.5,1,x": "type of variable_id",
        "014,4,n,6,40000,1.5,1,x": "type of year",
        "014,4,n,300,2000,1.5,1,x": "type of unitLevel",
        "014,4,n,6,2000,one,1,x": "type of value",
        ",4,n,6,2000,1.5,1,x": "no unitId",
        "014,,n,6,2000,1.5,1,x": "no variable_id",
        "014,4,n,,2000,1.5,1,x": "no unitLevel",
        "014,4,n,5,2000,1.5,1,x": "level",
        "variable_id,unitId,unitName,unitLevel,year,value,attr_id": "cells",
    }
    lines = list(bad)
    gminy = extract(tmp_path, "g", [HEADER, good[0], *lines[:5], ""], [HEADER, *good[1:], *lines[5:]])
    country = extract(tmp_path, "c", [",".join(S.FACT.names), "7,u,n,1,1999,2,0", "7,u,n,2,1999,2,0"])
    got = ingest_extracts(spark, {"gminy": gminy, "country": country}, str(tmp_path / "out"))
    assert got.facts.schema.simpleString() == S.FACT.simpleString()
    assert sorted(map(tuple, got.facts.collect()), key=str) == sorted(
        [(1, "011", 'Łódź, "old"', 6, 2000, 1.5, 1), (2, "012", None, 6, 2001, None, None), (3, "013", " n ", 6, 2002, 1000.0, -5), (7, "u", "n", 1, 1999, 2.0, 0)], key=str
    )
    assert {(r.endpoint, r.line): r.reason for r in got.quarantine.collect()} == {("gminy", k): v for k, v in bad.items()} | {("country", "7,u,n,2,1999,2,0"): "level"}
    assert got.counts == {"gminy": {"lines": 14, "good": 3, "bad": 11}, "country": {"lines": 2, "good": 1, "bad": 1}}


def test_ingest_needs_its_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="attr_id"):
        ingest_extracts(spark, {"gminy": extract(tmp_path, "g", ["variable_id,unitId,unitName,unitLevel,year,value", "1,u,n,6,2000,1"])}, str(tmp_path / "out"))
    none = ingest_extracts(spark, {"gminy": extract(tmp_path, "h", [HEADER])}, str(tmp_path / "none"))
    assert none.facts.count() == none.quarantine.count() == 0 and none.counts == {"gminy": {"lines": 0, "good": 0, "bad": 0}}


def test_places_follow_the_order(spark, tables):
    facts = tables.facts.drop("attr_id")
    order = dataset.export_order("variable_id")
    got = placed(facts.repartition(7), order).orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, facts.count() + 1))
    keys = [(r.variable_id, -r.unitLevel, r.unitId, r.year) for r in got]
    assert keys == sorted(keys)
    plan = placed(facts, order)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "rangepartitioning" not in plan  # the stored rows, and their ranges' sizes


def test_places_of_odd_tables(spark):
    rows = spark.createDataFrame([(i % 3 if i % 5 else None, i, "x") for i in range(50)], "row int, place2 int, id string")
    got = placed(rows, ["row", F.col("place2").desc()]).orderBy("place").collect()
    assert [(r.row, r.place2) for r in got] == sorted(((i % 3 if i % 5 else None, i) for i in range(50)), key=lambda x: (x[0] is None, x[0] or 0, -x[1]))
    assert placed(rows.limit(0), ["id"]).collect() == [] and placed(rows, ["id"]).columns == ["row", "place2", "id", "place"]


def test_places_by_key_exchange_no_rows(spark, tables):
    rows = spark.createDataFrame([(i % 7 if i % 5 else None, i, "x") for i in range(200)], "row int, place2 int, id string").repartition(5, "row")
    frame = placed_by_key(rows, "row", [F.col("place2").desc()])
    got = frame.orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, 201))
    assert [(r.row, r.place2) for r in got] == sorted(((i % 7 if i % 5 else None, i) for i in range(200)), key=lambda x: (x[0] is not None, x[0] or 0, -x[1]))
    assert placed_by_key(rows.limit(0), "row", ["id"]).collect() == [] and frame.columns == ["row", "place2", "id", "place"]
    long = dataset.long(tables.facts, tables.codebook)
    plan = placed_by_key(long, "variable_id", dataset.export_order())._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("unitId" in line or "rangepartitioning" in line for line in exchanges)


def test_profile_is_one_pass_and_merges(spark, tables):
    facts = tables.stored.facts
    plan = quality.profile(facts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<variable_id:int,unitId:string,unitLevel:tinyint>" in plan
    assert dataset.summary(facts)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    whole = {tuple(r) for r in quality.profile(facts).collect()}
    parts = [quality.profile_state(facts.where(F.pmod(F.xxhash64("unitId", "year"), F.lit(3)) == k)) for k in range(3)]
    assert {tuple(r) for r in quality.profile_of(quality.merged_states(*parts)).collect()} == whole


def test_profile_of_odd_facts(spark):
    facts = [(v, u, "n", level, 2000, 1.0, 0) for v, u, level in [
        (1, "a", 6), (1, "bb", 6), (-70000, "bb", 6), (None, "a", 6), (99999, None, 6), (32768, "c", None), (32769, "dd", 3), (32768, "dd", 0),
    ]]
    got = {r.tbl: tuple(r)[1:] for r in quality.profile(spark.createDataFrame(facts, S.FACT)).collect()}
    assert got == {"facts_gminy": (5, 3, 2, 1, 2, 1), None: (3, 2, 2, 1, 2, 2)}
    assert quality.profile(spark.createDataFrame([], S.FACT)).collect() == []
    assert quality.label_check(spark.createDataFrame([(1,), (1,), (40000,), (None,), (-3,)], "id int")).first() == (5, 3)
    assert quality.label_check(spark.createDataFrame([], "id int")).first() == (0, 0)


def test_wide_with_thousands_of_indicators(spark):
    """2,000 columns with gaps, names in common and a variable without name, equal to a plain pivot."""
    rng = random.Random(4)
    book = spark.createDataFrame([(i, f"n{i % 1990:04d}" if i else None) for i in range(2001)], "variable_id int, variable_full_name string")
    facts = [(v, f"u{u}", "n", 6, 2000 + u % 2, float(v + u)) for u in range(12) for v in rng.sample(range(2001), 900)]
    found = dataset.wide(spark.createDataFrame(facts, "variable_id int, unitId string, unitName string, unitLevel int, year int, value double"), book, limit=2000)
    assert len(found.columns) == 5 + 1990
    want = {}
    for v, u, *_, value in sorted(facts, reverse=True):
        want.setdefault(u, {})
        if v:
            want[u][f"n{v % 1990:04d}"] = value
    got = {r.unitId: {k: x for k, x in r.asDict().items() if k.startswith("n") and x is not None} for r in found.drop("unitName").collect()}
    assert got == want
    few = dataset.wide(found.select(F.lit(3).alias("variable_id"), "unitId", "unitName", "unitLevel", "year", F.lit(1.0).alias("value")), book, labels=["n0003", "n0004"])
    assert {(r["n0003"], r["n0004"]) for r in few.collect()} == {(1.0, None)}


def test_a_grown_store_counts_only_what_is_new(spark, tables, tmp_path):
    old, new = tables.stored.facts.where("year < 1996"), tables.stored.facts.where("year >= 1996")
    metadata = (tables.variables, tables.subjects)
    first = lay_out(Store.of(old, *metadata), str(tmp_path / "first"), parts=5)
    more = lay_out(first, str(tmp_path / "more"), parts=5)
    assert sorted(map(str, more.manifest.collect())) == sorted(map(str, first.manifest.collect()))
    whole = lay_out(Store.of(tables.stored.facts, *metadata), str(tmp_path / "whole"), parts=5)
    both = grown(first, new, str(tmp_path / "both"), parts=5)
    for table in ("manifest", "facts"):
        assert sorted(map(str, getattr(both, table).collect())) == sorted(map(str, getattr(whole, table).collect()))
    counts = [spark.read.parquet(f"{s.root}/key_counts") for s in (both, whole)]
    assert sorted(map(tuple, counts[0].collect())) == sorted(map(tuple, counts[1].collect()))
    plan = layout.merged_counts(spark.read.parquet(f"{first.root}/key_counts"), layout.key_counts(new))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("ReadSchema: struct<variable_id:int,unitLevel:tinyint,year:smallint>") == 1
    with pytest.raises(ValueError):
        grown(Store.of(old, *metadata), new, str(tmp_path / "none"))
