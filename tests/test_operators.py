"""Operators on small hand-made tables."""

import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.filters import queries_table
from statbank import schema as S
from statbank.functions import text
from statbank.operators import dataset, facets, filters, lookup, match, metadata, quality, resolve, search, series
from statbank.session import workspace
from statbank.sinks.text_index import TextIndex, build_text_index


def ids(frame):
    return sorted(r[0] for r in frame.collect())


@pytest.fixture(scope="module")
def codebook(spark):
    variables = spark.createDataFrame(
        [
            (1, "P1", "ogółem", "ogółem", None, None, None, 6, 1, "osoba"),
            (2, "P1", "kobiety", "ogółem", "NA", None, None, 6, 1, "osoba"),
            (3, "P1", "kobiety", "0-4", "NA", None, None, 5, 1, "osoba"),
            (4, "P1", "łodzie", "", None, None, None, 2, 1, "-"),
            (5, "P2", "100%", "a\\b", None, None, None, 6, 2, "zł"),
            (6, "P9", "a", "b", None, None, None, 6, 2, "zł"),
            (7, "P1", "mężczyźni", None, None, None, None, 6, 1, "osoba"),
        ],
        S.VARIABLES,
    )
    subjects = spark.createDataFrame(
        [
            ("P1", "K1", "Ludność wg płci i wieku", None),
            ("P2", "K2", "Ceny, koszty_100%", None),
            ("K1", None, "Ludność", None),
            ("K2", None, "W 1 i my", None),
            ("K3", None, "To są ceny", None),
        ],
        S.SUBJECTS,
    )
    english = spark.createDataFrame([("P1", "Population by sex and age")], S.SUBJECTS_EN)
    plain = metadata.codebook(variables, subjects)
    return variables, subjects, plain, metadata.bilingual_codebook(plain, english)


def test_codebook_keeps_variables_without_subject(codebook):
    row = codebook[2].where("variable_id = 6").first()
    assert (row.subject_name, row.variable_full_name, row.variable_dimensions) == (None, "a | b", "a | b")


def test_absent_english_sides(codebook):
    row = metadata.bilingual_codebook(codebook[2]).where("variable_id = 1").first()
    assert (row.subject_name_en, row.n1_en, row.variable_full_name_en, row.search_key_en) == (None, None, None, " ")


def test_wildcards_are_literal(codebook):
    plain = codebook[2]
    assert ids(search.search_variables(plain, "100%")) == [5]
    assert ids(search.search_variables(plain, "y_1")) == [5]
    assert ids(search.search_variables(plain, "A\\B")) == [5]
    assert ids(search.search_variables(plain, "u%n")) == []
    assert ids(search.search_variables(plain, "LUDNOŚĆ", level=5)) == [3]


def test_search_subjects(codebook):
    row = search.search_subjects(codebook[2], "ludność").first()
    assert row.n_variables == 5 and row.n_aggregate == 1 and row.example_variable_id == 1
    assert row.n1_breakdowns == "kobiety | mężczyźni | ogółem | łodzie"
    assert search.search_subjects(codebook[2], "nothing here").count() == 0


def test_dims(codebook):
    plain = codebook[2]
    pick = lambda dims: ids(plain.where(filters.dims_predicate(dims)).select("variable_id"))
    assert pick({"n1": "kobiety"}) == [2, 3]
    assert pick({"n1": ["kobiety", "ogółem"], "n3": None}) == [1, 2, 3]
    assert pick({"n2": [None]}) == [7]
    assert pick({"n2": ["b", None]}) == [6, 7]
    assert ids(plain.where(filters.aggregate_predicate()).select("variable_id")) == [1]
    with pytest.raises(ValueError):
        filters.dims_predicate({"n6": "x"})


def test_categories(spark, codebook):
    variables, subjects, plain, _ = codebook
    found = lambda *codes: ids(resolve.resolve_ids(plain, subjects, codes=codes))
    assert found("K1") == [1, 2, 3, 4, 7]  # Ludność
    assert found("K2") == []  # no long word: the whole name
    assert found("K3") == [5]  # first long word is "ceny"
    assert found("P9", "K3", "K404") == [5, 6]
    assert found("P404") == []
    assert ids(resolve.resolve_ids(plain, subjects, [6, 99], ["P2"])) == [5, 6, 99]
    assert ids(resolve.resolve_ids(plain, subjects, [6, 99], dims={"n1": "a"})) == [6]


def test_ranked_search(codebook):
    bilingual = codebook[3]
    row = search.ranked_search(bilingual, "ludnosc").first()
    assert (row.subjectId, row.n_vars, row.name_match, row.is_prefix, row.commas) == ("P1", 5, 0, 0, 0)
    assert search.ranked_search(bilingual, "lodzie").first().name_match == 1
    assert search.ranked_search(bilingual, "populations sex").first().n_vars == 5
    assert search.ranked_search(bilingual, "l").count() == 0
    assert search.ranked_search(bilingual, "  ").count() == 0
    assert search.ranked_search(bilingual, "ludnosc", [6]).first().n_vars == 3
    # P9 has no name and therefore no key.
    assert {r.subjectId for r in search.ranked_search(bilingual, "a b").collect()} == {"P1", "P2"}
    hint = search.search_hint(search.ranked_search(bilingual, "lodzie")).first()
    assert (hint.n_subjects, hint.only_breakdowns) == (1, True)


QUERIES = ["ludność", "lodzie", "100% a\\b", "kobiety 0-4", "population sex", "l", "", "zł", "y", "a b", "ogółem ogółem", "ł"]


def test_batch_search_equals_single(spark, codebook):
    bilingual = codebook[3]
    asked = spark.createDataFrame([(q, q) for q in QUERIES], "qid string, query string")
    batch = search.ranked_search_batch(bilingual, asked, [6, 2])
    for q in QUERIES:
        single = [tuple(r) for r in search.ranked_search(bilingual, q, [6, 2]).collect()]
        rows = batch.where(F.col("qid") == q).orderBy("rank").drop("qid", "rank").collect()
        assert [tuple(r) for r in rows] == single, q


def brute(texts, queries, stems):
    hits = set()
    for (key, body), q in itertools.product(texts, queries):
        words = text.query_terms(q)
        forms = [text.literal_variants(w) if stems else [w] for w in words]
        body = text.fold_literal(body)
        if len(q.strip()) >= 2 and words and all(any(f in body for f in fs) for fs in forms):
            hits.add((q, key))
    return hits


TEXTS = [
    (1, "Unemployed people\tand dwellings\nin Łódź"),
    (2, "a bb ccc dddd 😀😀x ąęć"),
    (3, "xx" * 500 + "yz"),
    (4, "the\u00a0unit cities"),
    (5, ""),
]
ASKED = ["unemployment", "dwelling lodz", "bb ccc", "😀x", "xyz", "ąę", "unit the", "city", "cities", "zz", "d dd", "no such"]


@pytest.mark.parametrize("staged", [False, True])
@pytest.mark.parametrize("stems", [True, False])
def test_match_terms_against_brute_force(spark, staged, stems):
    texts = spark.createDataFrame(TEXTS, "id int, body string")
    asked = spark.createDataFrame([(q, q) for q in ASKED], "qid string, query string")
    found = match.match_terms(texts, asked, "id", ["body"], stems, staged, folded=False)
    assert {(r.qid, r.id) for r in found.collect()} == brute(TEXTS, ASKED, stems)
    assert found.count() == len(brute(TEXTS, ASKED, stems))


@pytest.mark.parametrize("stems", [True, False])
def test_index_against_brute_force(spark, tmp_path, stems):
    texts = spark.createDataFrame(TEXTS, "id int, body string")
    asked = spark.createDataFrame([(q, q) for q in ASKED], "qid string, query string")
    index = build_text_index(texts, "id", ["body"], str(tmp_path / "x"), folded=False, buckets=3)
    found = lookup.match_indexed(index, asked, stems)
    assert {(r.qid, r.id) for r in found.collect()} == brute(TEXTS, ASKED, stems)
    assert found.count() == len(brute(TEXTS, ASKED, stems))
    assert rows(TextIndex.open(spark, str(tmp_path / "x"), "id").words) == rows(index.words)


def rows(frame):
    return sorted(map(repr, frame.collect()))


def test_index_with_repeated_and_null_ids(spark, tmp_path):
    """Words of two rows with one id do not add up; a row without id is in no result; ids are not repeated."""
    texts = [(1, "alpha beta", "x"), (1, "gamma", "y"), (2, "alpha gamma", None), (2, "alpha beta gamma", ""), (None, "alpha gamma", "z"), (3, None, None)]
    index = build_text_index(spark.createDataFrame(texts, "id int, body string, row string"), "id", ["body", "row"], str(tmp_path / "x"))
    asked = [("q", "alpha gamma"), ("q", "beta"), (None, "gamma y"), ("r", None), ("s", "a"), ("t", "beta zz"), ("u", "ma x"), ("v", "alp eta")]
    found = lookup.match_indexed(index, spark.createDataFrame(asked, "qid string, query string"))
    assert sorted(map(tuple, found.collect()), key=str) == sorted([("q", 2), ("q", 1), (None, 1), ("v", 1), ("v", 2)], key=str)
    nothing = build_text_index(index.keys.limit(0).select("key", F.lit("").alias("body")), "key", ["body"], str(tmp_path / "y"))
    assert lookup.match_indexed(nothing, spark.createDataFrame(asked, "qid string, query string")).collect() == []


def test_index_reads_no_text_and_compares_few_words(tables, tmp_path):
    """Rows that enter verification are a small multiple of the hits, by a needle's rarest gram; by its first they are more."""
    index = build_text_index(tables.bilingual, "variable_id", search.SEARCH_KEYS, str(tmp_path / "x"))
    asked = match.asked_words(queries_table(tables))
    needles = asked.select(F.explode(F.flatten("forms")).alias("needle")).distinct()
    hits = lookup.needle_words(needles, index)
    entering = index.gram_words.join(lookup.needle_grams(needles, index.grams), "gram").count()
    long = needles.where("length(needle) >= 3")
    rarest = index.gram_words.join(lookup.needle_grams(long, index.grams), "gram").count()
    first = index.gram_words.join(long.withColumn("gram", F.substring("needle", 1, 3)), "gram").count()
    assert hits.count() <= entering <= 2 * hits.count() and rarest <= first
    plan = lookup.match_indexed(index, queries_table(tables))._jdf.queryExecution().executedPlan().toString()
    assert "search_key" not in plan and "words:array" not in plan


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("abcł x", max_size=14), min_size=1, max_size=8),
    st.lists(st.text("abcł", min_size=1, max_size=5), min_size=1, max_size=5, unique=True),
)
def test_needle_words(spark, bodies, needles):
    index = build_text_index(spark.createDataFrame(list(enumerate(bodies)), "id int, body string"), "id", ["body"], workspace(spark, "words"))
    found = lookup.needle_words(spark.createDataFrame([(n,) for n in needles], "needle string"), index)
    words = [w for b in bodies for w in set(b.split(" ")) if w]
    assert sorted(map(tuple, found.collect())) == sorted({(n, w, words.count(w)) for n in needles for w in words if n in w})


def test_match_terms_with_repeated_and_null_qids(spark):
    texts = spark.createDataFrame(TEXTS, "id int, body string")
    asked = [("a", "unit the"), ("a", "cities"), ("a", "the cities"), (None, "bb ccc"), (None, "dwellings"), ("b", None), ("c", "^^"), ("d", "a\t"), ("e", " \u3000x\n")]
    found = match.match_terms(texts, spark.createDataFrame(asked, "qid string, query string"), "id", ["body"], folded=False)
    assert sorted(found.collect(), key=str) == sorted([("a", 4), (None, 2), (None, 1)], key=str)


@pytest.mark.parametrize("query", ["a\t", "^^", " \n", "\u3000bb ccc", "Ludność\t", "´ludność"])
def test_single_and_batch_search_agree(spark, tables, store, query):
    asked = spark.createDataFrame([("q", query)], "qid string, query string")
    pool = tables.bilingual.where(F.col("unit_level").isin(1, 2, 4, 5, 6))
    single = search.ranked_search(pool, query).select("subjectId").collect()
    batch = search.ranked_search_batch(pool, asked).orderBy("rank").select("subjectId").collect()
    assert single == batch
    assert single == search.ranked_search_batch(pool, asked, index=store.codebook_words).orderBy("rank").select("subjectId").collect()
    units = search.unit_search(tables.searchable_units, query, [5, 4]).collect()
    for index in (None, store.unit_words):
        batch = search.unit_search_batch(tables.searchable_units, asked, [5, 4], index=index)
        assert units == batch.orderBy("rank").select("unitId", "unitName", "unitLevel").collect()


def test_candidates_stay_close_to_results(tables):
    """What enters the last join is a small multiple of what comes out."""
    asked = match.asked_words(queries_table(tables))
    words = tables.bilingual.select("variable_id", F.explode(text.words(F.concat_ws(" ", "search_key", "search_key_en"))).alias("word"))
    vocabulary = words.groupBy("word").agg(F.count("*").alias("n")).withColumn("haystack", F.col("word"))
    entering = match.candidates(words, match.rarest_words(asked, vocabulary), "variable_id").count()
    leaving = match.match_terms(tables.bilingual, queries_table(tables), "variable_id", ["search_key", "search_key_en"]).count()
    assert leaving <= entering <= 4 * leaving + 100


def test_match_terms_with_many_words(spark):
    words = [f"w{i}" for i in range(40)]
    texts = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[1:]))], "id int, body string")
    asked = spark.createDataFrame([(7, " ".join(words) + " w1")], "qid int, query string")
    assert [tuple(r) for r in match.match_terms(texts, asked, "id", ["body"]).collect()] == [(7, 1)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("abcł x", max_size=12), min_size=1, max_size=8),
    st.lists(st.text("abcł", min_size=1, max_size=5), min_size=1, max_size=5, unique=True),
)
def test_substring_pairs(spark, bodies, needles):
    bodies = sorted(set(bodies))
    left = spark.createDataFrame([(n,) for n in needles], "needle string")
    right = spark.createDataFrame([(b,) for b in bodies], "haystack string")
    found = sorted((r.needle, r.haystack) for r in match.substring_pairs(left, right).collect())
    assert found == sorted((n, b) for n in needles for b in bodies if n in b)


def test_facets(spark, codebook):
    bilingual = codebook[3].where("subjectId = 'P1'")
    active = {r.dim: r.n_values for r in facets.active_dims(bilingual).collect()}
    assert active == {"n1": 4, "n2": 3}  # '' counts as a value, NULL and 'NA' do not
    order = facets.ranked_values(facets.facet_values(bilingual)).where("dim = 'n1'").orderBy("position")
    assert [r.value for r in order.collect()] == ["ogółem", "kobiety", "łodzie", "mężczyźni"]
    defaults = {r.dim: r.value for r in facets.facet_defaults(bilingual).collect()}
    assert defaults == {"n1": "ogółem", "n2": "ogółem"}
    pick = lambda ticks: ids(facets.pick(bilingual, ticks).select("variable_id"))
    assert pick({"n1": ["kobiety", "ogółem"], "n2": ["ogółem"]}) == [1, 2]
    assert pick({"n1": ["kobiety"]}) == []
    assert pick({}) == []
    assert ids(facets.pick_all(bilingual).select("variable_id")) == [1, 2, 3, 4]
    ticks = spark.createDataFrame([("P1", "n1", "kobiety"), ("P1", "n2", "0-4")], "subjectId string, dim string, value string")
    assert [r.variable_id for r in facets.pick_ticks(bilingual, ticks).collect()] == [3]
    single = codebook[3].where("subjectId = 'P9'")
    assert ids(facets.pick_none(single).select("variable_id")) == [6]
    axes = {r.dim: (r.label, r.label_en) for r in facets.axes(bilingual).collect()}
    assert axes == {"n1": ("Płci", "Sex"), "n2": ("Wieku", "Age")}
    assert [r.value for r in facets.facet_text(facets.facet_values(bilingual), "KOB").collect()] == ["kobiety"]
    # The query is folded, the values are not.
    assert facets.facet_text(facets.facet_values(bilingual), "łodzie").count() == 0


FACTS = [
    (1, "010000000000", "A", 1, 2000, 1.0, 0),
    (1, "010000000000", "A", 1, 2001, 3.0, 0),
    (1, "010000000000", "A", 1, 2001, 2.0, 0),
    (1, "010000000000", "A", 1, 2002, None, 0),
    (1, "020000000000", "B", 1, 2000, -5.0, 0),
    (2, "010000000000", "A", 1, 2000, 7.0, 0),
    (3, "010000000000", "A", 2, 2000, None, 0),
]


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(FACTS, S.FACT)


def test_series(facts):
    rows = {(r.variable_id, r.unitId[:2]): (r.mean, r.n_points) for r in series.series(facts).collect()}
    assert rows == {(1, "01"): (2.0, 2), (1, "02"): (-5.0, 1), (2, "01"): (7.0, 1)}
    top = series.top_series(facts, 2).collect()
    assert [r.mean for r in top] == [7.0, 2.0]
    shown = series.top_points(facts, 2)
    assert sorted(r.value for r in shown.collect()) == [1.0, 3.0, 7.0]
    axis = series.domain(facts, shown).first()
    assert (axis.n_years, axis.year_min, axis.year_max, axis.y_min, axis.y_max) == (3, 2000, 2002, 0.0, 7.0)


def test_mixed_measures(codebook):
    plain = codebook[2]
    row = series.mixed_measures(plain).first()
    assert (row.n_measures, row.mixed, row.measures) == (3, True, "-, osoba, zł")
    assert not series.mixed_measures(plain.where("variable_id < 3")).first().mixed


def test_units(facts):
    row = metadata.units(facts).where("unitId LIKE '01%' AND unitLevel = 1").first()
    assert (row.unitName, row.voivod_teryt, row.first_year, row.last_year) == ("A", "00", 2000, 2002)


def test_estimate(spark):
    totals = [0, 5, 10_527, 50_000, 105_264, 500_000, 500_001, 3_000_000, 3_000_001]
    rows = dataset.estimate(spark.createDataFrame([(n,) for n in totals], "total long")).orderBy("total").collect()
    assert [r["size"] for r in rows] == ["1 KB", "1 KB", "1.0 MB", "4.8 MB", "10 MB", "48 MB", "48 MB", "285 MB", "285 MB"]
    assert [r.feasibility for r in rows][-4:] == ["ok", "warn", "warn", "heavy"]


def test_wide(spark, facts):
    names = spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "variable_id int, variable_full_name string")
    rows = dataset.wide(facts.where("year = 2000"), names, ["x"]).orderBy("unitLevel", "unitId").collect()
    # Variables 1 and 2 share a name: the smaller id wins; a nameless one keeps its row.
    assert [(r.unitId[:2], r.unitLevel, r.x) for r in rows] == [("01", 1, 1.0), ("02", 1, -5.0), ("01", 2, None)]
    apart = dataset.wide(facts.where("year = 2000"), names, key="variable_id")
    assert apart.columns[-3:] == ["1", "2", "3"]
    many = spark.range(61).selectExpr("CAST(id AS int) AS variable_id", "CAST(id AS string) AS variable_full_name")
    with pytest.raises(ValueError):
        dataset.wide(facts, many)


def test_wide_unpivoted_equals_long(tables):
    rows = tables.codebook.where("n1 = 'ogółem' AND subject_name LIKE 'L%'")
    chosen = tables.facts.join(rows, "variable_id", "left_semi").drop("attr_id")
    labels = dataset.indicator_labels(rows)
    wide = dataset.wide(chosen, rows, labels)
    keys = ["unitId", "unitName", "unitLevel", "level", "year"]
    melted = wide.unpivot(keys, labels, "variable_name", "value").where("value IS NOT NULL")
    first = Window.partitionBy("variable_name", *keys).orderBy("variable_id")
    long = dataset.long(chosen, rows).withColumn("n", F.row_number().over(first)).where("n = 1 AND value IS NOT NULL")
    columns = [*keys, "variable_name", "value"]
    assert sorted(map(tuple, melted.select(columns).collect())) == sorted(map(tuple, long.select(columns).collect()))


def test_quality(facts):
    row = quality.profile(facts).where("tbl = 'facts_makroregiony'").first()
    assert (row.nrows, row.nvars, row.nunits, row.min_idlen, row.max_idlen, row.nlevels) == (6, 2, 2, 12, 12, 1)
    assert quality.leading_zero_count(facts).first().n == 7


def test_units_filter(facts):
    kept = lambda *u: facts.where(filters.units_any(u)).count()
    assert kept("10000000000") == 6
    assert kept("B") == 1
    assert kept("b") == 0
    assert kept(" 010000000000 ", "B") == 7
    assert kept("0010000000000") == 0
    assert kept() == 0


def test_unit_search(spark):
    units = spark.createDataFrame(
        [("1", "Łódź", 5), ("2", "Nowa Łódź", 6), ("3", "Łodygowice", 6), ("4", "100%", 6)],
        "unitId string, unitName string, unitLevel int",
    )
    keyed = metadata.unit_search_keys(units)
    found = lambda q, levels=(6, 5): [r.unitId for r in search.unit_search(keyed, q, levels).collect()]
    assert found("LODZ") == ["2", "1"]
    assert found("lod") == ["2", "3", "1"]
    assert found("łódź nowa") == ["2"]
    assert found("0%") == ["4"]
    assert found("l") == []
    assert found("lodz", ()) == []
    asked = spark.createDataFrame([("a", "LODZ"), ("b", "łódź nowa"), ("c", "l")], "qid string, query string")
    batch = search.unit_search_batch(keyed, asked, [6, 5]).orderBy("qid", "rank").collect()
    assert [(r.qid, r.unitId) for r in batch] == [("a", "2"), ("a", "1"), ("b", "2")]
