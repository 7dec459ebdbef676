"""Every registered query against its oracle, and a look at its plan."""

import glob
import gzip
import math
import time

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog import sources
from catalog.registry import QUERIES as OWN
from statbank import session
from statbank.session import exchanges_dropped
from statbank.sinks import layout
from tests.conftest import FOLDER

ORACLES = {name: sql for name, sql in oracle_sql().items() if name in OWN}
# The queries of the optional subpackage have tests of their own.
QUERIES = {name: build for name, build in queries().items() if name in OWN}
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "Scan ExistingRDD")


def canonical(rows):
    def cell(x):
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return (0, "")
        if isinstance(x, bool):
            return (1, str(x))
        return (2, repr(float(x))) if isinstance(x, (int, float)) else (3, x)

    return sorted(tuple(cell(x) for x in row) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(name, spark, duck):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    rows = frame.select(*[f"`{c}`" for c in columns]).collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    result = duck.execute(ORACLES[name])
    order = [d[0] for d in result.description]
    assert sorted(order) == columns
    places = [order.index(c) for c in columns]
    expected = [tuple(row[i] for i in places) for row in result.fetchall()]
    assert canonical(rows) == canonical(expected)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0


def _own_tables(spark, folder, chosen):
    """Small tables of which `chosen` variables are in the choice of the explorer's queries, and 30 are not."""
    n = chosen + 30
    given = {
        "region": (2, ["CAST(id AS int) AS r_regionkey", "concat('R', id) AS r_name"]),
        "nation": (4, ["CAST(id AS int) AS n_nationkey", "concat('N', id) AS n_name", "CAST(id % 2 AS int) AS n_regionkey"]),
        "customer": (12, ["id AS c_custkey", "concat('C', id) AS c_name", "CAST(id % 4 AS int) AS c_nationkey", "IF(id % 3 = 0, 'BUILDING', 'MACHINERY') AS c_mktsegment"]),
        "part": (n, [
            "id AS p_partkey", "concat(IF(id % 2 = 0, 'red', 'blue'), ' ring') AS p_name", f"IF(id < {chosen}, 'Brand#12', 'Brand#21') AS p_brand",
            "'STANDARD' AS p_type", "CAST(id % 50 AS int) AS p_size",
        ]),
        "orders": (50, ["id AS o_orderkey", "id % 12 AS o_custkey", "make_timestamp(1995 + id % 7, 6, 1, 0, 0, 0) AS o_orderdate"]),
        "lineitem": (3 * n, ["id % 50 AS l_orderkey", f"id % {n} AS l_partkey", "CAST(id % 7 AS int) AS l_linenumber", "CAST(1 + id % 11 AS double) AS l_quantity"]),
    }
    duck = duckdb.connect()
    for name, (rows, columns) in given.items():
        spark.range(rows).selectExpr(*columns).write.parquet(f"{folder}/{name}.parquet")
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return duck


def _matches(frame, duck, name):
    columns = frame.columns
    expected = duck.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({ORACLES[name]}) o").fetchall()
    return len(expected) > 0 and canonical(frame.collect()) == canonical(expected)


# More than the explorer's 60 variables, and more than a request holds as values.
@pytest.mark.parametrize("chosen", [70, 2100])
@pytest.mark.parametrize("name", ["api_build_total", "api_export", "api_export_docs", "api_export_wide", "api_series_chart"])
def test_a_choice_of_any_size(name, chosen, spark, tmp_path):
    duck = _own_tables(spark, str(tmp_path), chosen)
    assert _matches(QUERIES[name](spark, str(tmp_path)), duck, name)


def test_facts_are_written_without_an_exchange_of_their_own(spark, tmp_path, monkeypatch):
    """src_fact_parquet exchanges the narrow sales by variable, and not the facts of every level by their keys."""
    duck, written, write = _own_tables(spark, str(tmp_path), 70), [], layout.write_parquet
    monkeypatch.setattr(layout, "write_parquet", lambda df, path: (written.append(df), write(df, path)))
    assert _matches(QUERIES["src_fact_parquet"](spark, str(tmp_path)), duck, "src_fact_parquet")
    lines = [df._jdf.queryExecution().executedPlan().toString().splitlines() for df in written]
    exchanges = [line for plan in lines for line in plan if "Exchange hashpartitioning" in line]
    assert any("variable_id" in line for line in exchanges) and not any("unitId" in line for line in exchanges)


def _of_workspace(monkeypatch, folder, name):
    """Workspaces lie in `folder` and are not deleted; the path of the one called `name` is put into the list."""
    made = []
    monkeypatch.setattr(sources, "discard_folders", lambda *_: None, raising=False)
    monkeypatch.setattr(sources, "workspace", lambda _, x: (made.append(f"{folder}/statbank-{x}"), made[-1])[1])
    return lambda: [x for x in made if x.endswith(name)]


def test_damaged_extracts_are_compressed_in_order(spark, tmp_path, monkeypatch):
    duck, made = _own_tables(spark, str(tmp_path / "in"), 70), _of_workspace(monkeypatch, tmp_path, "damaged")
    assert _matches(QUERIES["src_fact_csv_good"](spark, str(tmp_path / "in")), duck, "src_fact_csv_good")
    files = [f for f in glob.glob(f"{made()[0]}/endpoint=*/part-*") if not f.endswith(".txt")]
    assert all(f.endswith(".csv.gz") for f in files) and len([f for f in files if "endpoint=gminy" in f]) > 3
    for file in files:
        header, *lines = gzip.open(file, "rt", encoding="utf-8").read().splitlines()
        assert header == "variable_id,unitId,unitName,unitLevel,year,value,attr_id"
        ids = [int(line.split(",")[0]) for line in lines]
        assert ids == sorted(ids)


def test_extracts_and_exchanges_go_once_they_are_ingested(spark, tmp_path, monkeypatch):
    """src_fact_csv_quarantine keeps what it ingested, and neither the extracts nor what was exchanged for them."""
    duck, made = _own_tables(spark, str(tmp_path / "in"), 70), []
    monkeypatch.setattr(sources, "workspace", lambda _, x: (made.append(tmp_path / f"statbank-{x}"), str(made[-1]))[1])
    found = QUERIES["src_fact_csv_quarantine"](spark, str(tmp_path / "in"))
    assert [x.name for x in made] == ["statbank-damaged", "statbank-ingested"]
    assert not list(made[0].glob("**/part-*")) and list(made[1].glob("good=true/unitLevel=6/part-*"))
    assert _matches(found, duck, "src_fact_csv_quarantine")


def test_exchanges_are_dropped_with_their_write(spark, tmp_path):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        return {x for x in manager.getAllBlocks().mkString("\n").split("\n") if x.startswith("shuffle_")}

    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", held()
    was = spark.conf.get(key, None)
    spark.range(1000).repartition(7, "id").write.parquet(f"{tmp_path}/kept")
    assert held() - before
    before = held()
    with exchanges_dropped(spark):
        spark.range(1000).repartition(7, "id").write.parquet(f"{tmp_path}/dropped")
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.1)
    assert not held() - before and spark.conf.get(key, None) == was
    assert spark.read.parquet(f"{tmp_path}/dropped").count() == 1000
    with pytest.raises(RuntimeError), exchanges_dropped(spark):
        raise RuntimeError
    assert spark.conf.get(key, None) == was


def test_labels_of_many_variables_are_not_broadcast(spark, tmp_path, monkeypatch):
    """export_store with a codebook of which only the file is small."""
    duck = _own_tables(spark, str(tmp_path), 70)
    frame = QUERIES["export_store"](spark, str(tmp_path))
    assert "BroadcastHashJoin" in frame._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(session, "UNPACKING", 10**9, raising=False)
    monkeypatch.setattr(session, "row_bytes", lambda _: 10**12, raising=False)
    frame = QUERIES["export_store"](spark, str(tmp_path))
    assert "BroadcastHashJoin" not in frame._jdf.queryExecution().executedPlan().toString()
    assert _matches(frame, duck, "export_store")
