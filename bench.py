"""Headline queries over a laid-out store at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from catalog.fixtures import Tables  # noqa: E402
from catalog.filters import queries_table  # noqa: E402
from statbank import Selection, Store, export_store, get  # noqa: E402
from statbank.operators import dataset, facets, lookup, metadata, quality, search, series  # noqa: E402
from statbank.plans import explore  # noqa: E402
from statbank.plans.store import with_series  # noqa: E402
from statbank.session import workspace  # noqa: E402
from statbank.sinks import layout  # noqa: E402
from statbank.sinks.text_index import build_text_index  # noqa: E402
from statbank.sources import scan  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("statbank-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def consume(df: DataFrame) -> None:
    """Compute every row and column without keeping the result."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, FOLDER)
    timings: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        result = work()
        if isinstance(result, DataFrame):
            consume(result)
        timings[name] = round(time.perf_counter() - start, 3)
        return result

    consume(t.source("orders"))  # starts the engine
    timed("derive_facts", lambda: t.facts)
    stored: Store = t.stored
    store: Store = timed("export_store", lambda: export_store(stored, workspace(spark, "bench")))
    by_series = timed("build_series", lambda: with_series(store, workspace(spark, "series")))
    facts, bilingual = store.facts, store.bilingual
    title = store.codebook.where((F.col("subjectId") == "P0012") & (F.col("n1") == "ogółem"))
    chosen = Selection(levels=(1, 2, 4, 5, 6)).add(title.where(F.col("n4").isNull()).orderBy("variable_id").limit(40))
    zl = store.codebook.where((F.col("subject_parent_id") == "K2") & (F.col("measureUnitName") == "zł"))
    some_queries = queries_table(t)
    document_words = timed("index_documents", lambda: build_text_index(t.source("documents"), "doc_id", ["text"], workspace(spark, "words"), folded=False))
    work = {
        "get_subject": lambda: get(store, subjects=["P0012"], level="gmina", years=[1997, 1998], dims={"n1": "small"}),
        "get_aggregate": lambda: get(store, subjects=["P0012", "P0013"], level="powiat", aggregate=True),
        "get_category": lambda: get(store, subjects=["K3"], level="wojewodztwo"),
        "get_variables": lambda: get(store, variables=chosen.variables[:5], level="gmina"),
        "pruned_scan": lambda: scan.indexed_scan(facts, store.root, store.index, store.manifest, scan.settled_ids(zl)),
        "build_preview": lambda: explore.build(store, chosen)[1],
        "export_long": lambda: dataset.long(facts, store.codebook),
        "export_wide": lambda: dataset.wide(
            explore.observations(store, chosen), store.codebook.where(F.col("variable_id").isin(*chosen.variables))
        ),
        "series_chart": lambda: explore.series_chart(by_series, chosen)[0],
        "export_csv": lambda: explore.export(store, chosen, workspace(spark, "csv")),
        "top_series": lambda: series.points_of_rows(series.best_rows(series.with_means(by_series.series))),
        "series_mean": lambda: series.series(facts),
        "profile": lambda: quality.profile(facts),
        "summary": lambda: dataset.summary(facts),
        "units": lambda: metadata.units(facts),
        "equidepth": lambda: layout.equidepth_ranges(facts),
        "top_preview": lambda: dataset.preview(facts.select("variable_id", "unitId", "unitName", "unitLevel", "year", "value")),
        "ranked_search": lambda: search.ranked_search(bilingual, "ludność small", [6, 4]),
        "ranked_search_batch": lambda: search.ranked_search_batch(bilingual, some_queries, [6, 4], index=store.codebook_words),
        "facet_panel": lambda: facets.panel(bilingual),
        "unit_search": lambda: search.unit_search(store.searchable_units, "nation_1", [6, 5]),
        "document_terms": lambda: lookup.match_indexed(document_words, some_queries.where(F.col("qid").startswith("name:"))),
    }
    for name, build in work.items():
        timed(name, build)
    line = {
        "metric": "statbank headline queries, total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
