"""Expressions on literal edge rows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from statbank.functions import text


def values(spark, rows, column, kind="string"):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}").coalesce(1)
    return [r[0] for r in frame.orderBy("i").select(column(F.col("c"))).collect()]


def test_fold(spark):
    rows = ["Ludność", "ŁÓDŹ", "Straße", "Ørsted æther", "ÉÀÇ ñ", "ệ Ѝ", None]
    assert values(spark, rows, text.fold) == [
        "ludnosc", "lodz", "straße", "ørsted æther", "eac n", "e и", None,
    ]
    assert [text.fold_literal(r) for r in rows[:6]] == values(spark, rows[:6], text.fold_query)


def test_query_loses_spacing_marks(spark):
    assert values(spark, ["a^b`c¨"], text.fold_query) == ["abc"]
    assert text.query_terms("  Ludność wg  płci ") == ["ludnosc", "wg", "plci"]
    assert values(spark, ["  Ludność wg  płci "], text.terms) == [["ludnosc", "wg", "plci"]]


def test_missing_tokens(spark):
    rows = ["", "NA", "x", None]
    assert values(spark, rows, text.null_tokens) == [None, None, "x", None]
    assert values(spark, rows, text.non_missing) == ["", None, "x", None]


def test_labels(spark):
    row = spark.range(1)
    label = lambda *dims: row.select(text.dim_label([F.lit(d) for d in dims])).first()[0]
    assert label("a", None, "b") == "a | b"
    assert label("a", "", "b") == "a |  | b"
    assert label(None, None) == ""
    name = lambda s, d: row.select(text.full_name(F.lit(s), F.lit(d))).first()[0]
    assert name("S", "") == "S: "
    assert name(None, "a | b") == "a | b"
    name_en = lambda s, d: row.select(text.full_name_en(F.lit(s), F.lit(d))).first()[0]
    assert name_en("S", "") == "S"
    assert name_en(None, "") is None


def test_search_key_of_nameless_subject_is_null(spark):
    row = spark.range(1).select(
        text.search_key(F.lit(None).cast("string"), F.lit("a")), text.search_key_en(F.lit(None).cast("string"), F.lit("É"))
    )
    assert tuple(row.first()) == (None, " é")


def test_unit_id(spark):
    rows = ["21200000000", " 11212001011 ", "1234567890123", "Bochnia", "", "12a", None]
    assert values(spark, rows, text.unit_id) == [
        "021200000000", "011212001011", "1234567890123", "Bochnia", "", "12a", None,
    ]


def test_level_code(spark):
    assert values(spark, [" Gmina", "WOJ", "podregiony", "makroregion"], text.level_code) == [6, 2, 4, 1]
    with pytest.raises(PySparkException, match="unknown level"):
        values(spark, ["kraj"], text.level_code)


def test_level_name(spark):
    rows = [6, 5, 4, 3, 2, 1, 0]
    names = values(spark, rows, text.level_name, "int")
    assert names == ["gmina", "powiat", "podregion", "3", "wojewodztwo", "makroregion", "0"]
    documented = values(spark, rows, lambda c: text.level_name(c, doc=True), "int")
    assert documented[3] == "region" and documented[6] == "Polska"


WORDS = [
    "unemployment", "dwellings", "activities", "stations", "missions", "workers", "needed", "boxes", "cities",
    "ments", "aments", "abments", "gas", "tables", "ogółem", "singing", "ring", "s", "ties", "copies", "passes",
]


def test_term_variants(spark):
    found = values(spark, WORDS, text.term_variants)
    assert found == [text.literal_variants(w) for w in WORDS]
    by_word = dict(zip(WORDS, found))
    assert by_word["unemployment"] == ["unemployment", "unemploy"]
    assert by_word["activities"] == ["activities", "activity", "activiti"]
    assert by_word["stations"] == ["stations", "station"]
    assert by_word["gas"] == ["gas"]


def test_first_fitting_suffix_wins():
    assert text.literal_variants("missions") == ["missions", "mission"]
    assert text.literal_variants("extensions") == ["extensions", "exten"]
    assert text.literal_variants("aments") == ["aments", "ament"]
    assert text.literal_variants("passes") == ["passes", "pass"]


@pytest.mark.parametrize(
    "name, n, lang, expected",
    [
        ("Ludność wg płci i wieku", 2, "pl", ["Płci", "Wieku"]),
        ("Ludność według płci, wieku i miejsca", 3, "pl", ["Płci", "Wieku", "Miejsca"]),
        ("Ludność wg płci i wieku", 3, "pl", None),
        ("Ludność", 1, "pl", None),
        (None, 1, "pl", None),
        ("Population by sex and age", 2, "en", ["Sex", "Age"]),
        ("Population by sex, age and kind of place", 3, "en", ["Sex", "Age", "Kind of place"]),
        ("Nearby towns", 1, "en", None),
    ],
)
def test_axis_labels(spark, name, n, lang, expected):
    found = spark.range(1).select(text.axis_labels(F.lit(name).cast("string"), F.lit(n), lang)).first()[0]
    assert found == expected


def test_default_axis_labels(spark):
    label = lambda n: spark.range(1).select(text.axis_labels_or_default(F.lit("Ludność"), F.lit(n))).first()[0]
    assert label(1) == ["Breakdown"]
    assert label(2) == ["Breakdown 1", "Breakdown 2"]


@pytest.mark.parametrize(
    "pl, en, lang, expected",
    [
        ("a", "b", "pl", ("a", "b")),
        ("a", "b", "en", ("b", "a")),
        ("a", "a", "en", ("a", None)),
        (None, "b", "pl", ("b", "b")),
        ("a", "", "en", ("a", "a")),
        (None, None, "en", ("", None)),
    ],
)
def test_bilingual(spark, pl, en, lang, expected):
    main, sub = text.bilingual(F.lit(pl).cast("string"), F.lit(en).cast("string"), lang)
    assert tuple(spark.range(1).select(main.alias("m"), sub.alias("s")).first()) == expected


def test_series_name(spark):
    name = text.series_name(F.lit("Bochnia"), F.lit(6), F.lit("X"), F.lit(True), F.lit(False))
    assert spark.range(1).select(name).first()[0] == "Bochnia — gmina"


def test_both_folds_agree_over_all_of_unicode(spark):
    """Every code point that any fold changes, and one in a hundred of the others."""
    every = (chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    chars = [c for i, c in enumerate(every) if text.fold_literal(c) != c or c != c.lower() or i % 100 == 0]
    frame = spark.createDataFrame([(c,) for c in chars], "c string")
    found = frame.select("c", F.lower("c").alias("low"), text.fold_query(F.col("c")).alias("f")).collect()
    # Letters that only one side's Unicode version knows a lower case of say nothing about folding.
    different = [(r.c, r.f) for r in found if r.low == r.c.lower() and r.f != text.fold_literal(r.c)]
    assert different == []
    assert text.fold_literal("\u304c\uac00\u1e69") == "\u304b\uac00s"
