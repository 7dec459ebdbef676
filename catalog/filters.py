"""Predicates over whole tables."""

from pyspark.sql import functions as F

from catalog.registry import query
from statbank import schema as S
from statbank.functions import text
from statbank.operators import facets, filters, lookup, match, search
from statbank.plans.explore import selection_add, selection_remove
from statbank.session import workspace
from statbank.sinks.text_index import build_text_index

TITLE_WORDS = ["ludność typu", "mieszkania", "registered unemployed", "źródła red", "dwellings large"]


@query(
    "flt_variables",
    """SELECT * FROM facts WHERE variable_id IN
(SELECT variable_id FROM codebook WHERE n1 = 'ogółem' AND measureUnitName = 'zł')""",
)
def _(t):
    wanted = t.codebook.where((F.col("n1") == S.TOTAL) & (F.col("measureUnitName") == "zł"))
    return t.facts.join(wanted.select("variable_id"), "variable_id", "left_semi")


@query("flt_years_in", "SELECT * FROM facts WHERE year IN (1996, 1999, 2001)")
def _(t):
    return t.facts.where(filters.years_in([1996, 1999, 2001]))


@query(
    "flt_year_range",
    """SELECT 'both' AS ends, f.* FROM facts f WHERE year BETWEEN 1996 AND 1998
UNION ALL SELECT 'from', f.* FROM facts f WHERE year >= 2000
UNION ALL SELECT 'to', f.* FROM facts f WHERE year <= 1995""",
)
def _(t):
    tests = {"both": (1996, 1998), "from": (2000, None), "to": (None, 1995)}
    tagged = [F.when(filters.year_range(*ends), name) for name, ends in tests.items()]
    hits = t.facts.withColumn("ends", F.explode(F.array_compact(F.array(*tagged))))
    return hits.select("ends", *t.facts.columns)


@query(
    "flt_units",
    """SELECT * FROM facts WHERE unitId IN ('000500000000', '010100000000', '040400000000')
OR unitName IN ('ASIA', 'NATION_7', 'NATION_3 BUILDING')""",
)
def _(t):
    units = ["500000000", "10100000000", " 040400000000", "ASIA", "NATION_7", "NATION_3 BUILDING"]
    return t.facts.where(filters.units_any(units))


@query("flt_unit_ids", "SELECT * FROM facts WHERE unitId IN ('000000000000', '020000000000', '020200000000')")
def _(t):
    return t.facts.where(filters.unit_ids_in(["000000000000", "020000000000", "020200000000"]))


@query(
    "flt_dims",
    """SELECT variable_id, 'mixed' AS kind FROM codebook
WHERE n1 IN ('small', 'ogółem') AND (n2 IN ('red', 'blue') OR n2 IS NULL OR n2 = 'NA')
UNION ALL SELECT variable_id, 'missing' FROM codebook WHERE n4 IS NULL OR n4 = 'NA'""",
)
def _(t):
    mixed = t.codebook.where(filters.dims_predicate({"n1": ["small", S.TOTAL], "n2": ["red", "blue", None]}))
    missing = t.codebook.where(filters.dims_predicate({"n4": [None]}))
    return mixed.select("variable_id", F.lit("mixed").alias("kind")).unionByName(
        missing.select("variable_id", F.lit("missing").alias("kind"))
    )


@query(
    "flt_aggregate",
    """SELECT variable_id, subjectId FROM codebook WHERE n1 = 'ogółem'
AND (n2 = 'ogółem' OR n2 IS NULL OR n2 = 'NA') AND (n3 = 'ogółem' OR n3 IS NULL OR n3 = 'NA')""",
)
def _(t):
    return t.codebook.where(filters.aggregate_predicate()).select("variable_id", "subjectId")


@query("flt_level_exact", "SELECT variable_id, unit_level FROM codebook WHERE unit_level = 5")
def _(t):
    return t.codebook.where(filters.level_exact(5)).select("variable_id", "unit_level")


@query("flt_level_available", "SELECT variable_id, unit_level FROM codebook WHERE unit_level >= 4")
def _(t):
    return t.codebook.where(filters.level_available([6, 4])).select("variable_id", "unit_level")


@query("flt_subject_prefix", "SELECT variable_id, subjectId FROM codebook WHERE starts_with(subjectId, 'P001')")
def _(t):
    return t.codebook.where(filters.subject_prefix("P001")).select("variable_id", "subjectId")


@query("flt_top_subjects", "SELECT id, name FROM subjects WHERE id LIKE 'K%'")
def _(t):
    return search.top_subjects(t.subjects)


@query(
    "flt_substring_any",
    """SELECT variable_id FROM codebook WHERE contains(lower(subject_name), lower('Źródła'))
OR contains(lower(variable_dimensions), lower('Źródła')) OR contains(lower(variable_full_name), lower('Źródła'))
OR contains(lower(variable_full_name), 'bolt')""",
)
def _(t):
    columns = ["subject_name", "variable_dimensions", "variable_full_name"]
    return t.codebook.where(
        filters.contains_any("Źródła", columns) | filters.contains_any("BOLT", columns[2:])
    ).select("variable_id")


def _brute(texts: str, key: str, columns: list[str], queries: str, stems: bool = True) -> str:
    """All queries against all rows, the slow and obvious way."""
    from catalog.projections import _variants

    forms = f"list_filter({_variants('w')}, lambda v: v IS NOT NULL)" if stems else "[w]"
    hit = " OR ".join(f"contains(t.{c}, v)" for c in columns)
    return f"""
SELECT q.qid, t.{key} FROM {texts} t JOIN (
  SELECT qid, list_transform(list_filter(string_split(replace(strip_accents(lower(query)), 'ł', 'l'), ' '),
         lambda w: w <> ''), lambda w: {forms}) AS words FROM ({queries}) asked
  WHERE length(trim(query)) >= 2) q
ON len(list_filter(q.words, lambda fs: len(list_filter(fs, lambda v: coalesce({hit}, false))) > 0)) = len(q.words)"""


# Queries drawn from the data: every product name, every type, and the subject titles.
QUERIES_SQL = """
SELECT DISTINCT 'name:' || p_name AS qid, p_name AS query FROM part
UNION ALL SELECT DISTINCT 'type:' || p_type, p_type FROM part
UNION ALL SELECT 'title:' || id, name FROM subjects WHERE name IS NOT NULL"""


def queries_table(t):
    part = t.source("part")
    tagged = lambda kind, c: F.concat(F.lit(kind), c).alias("qid")
    names = part.select(tagged("name:", F.col("p_name")), F.col("p_name").alias("query")).distinct()
    types = part.select(tagged("type:", F.col("p_type")), F.col("p_type").alias("query")).distinct()
    titles = t.subjects.where(F.col("name").isNotNull()).select(
        tagged("title:", F.col("id")), F.col("name").alias("query")
    )
    return names.unionByName(types).unionByName(titles)


@query(
    "flt_terms_all",
    _brute(
        "bilingual", "variable_id", ["search_key", "search_key_en"],
        " UNION ALL ".join(f"SELECT '{q}' AS qid, '{q}' AS query" for q in TITLE_WORDS),
    ),
)
def _(t):
    keys = ["search_key", "search_key_en"]
    tags = [F.when(filters.terms_all(q, keys), q) for q in TITLE_WORDS]
    return t.bilingual.select(F.explode(F.array_compact(F.array(*tags))).alias("qid"), "variable_id")


ORACLES_OF = {
    "batch": _brute("bilingual", "variable_id", ["search_key", "search_key_en"], QUERIES_SQL),
    "documents": _brute(
        "(SELECT doc_id, replace(strip_accents(lower(text)), 'ł', 'l') AS key FROM documents)",
        "doc_id", ["key"], "SELECT DISTINCT p_name AS qid, p_name AS query FROM part",
    ),
}


@query("flt_terms_all_batch", ORACLES_OF["batch"])
def _(t):
    return match.match_terms(t.bilingual, queries_table(t), "variable_id", ["search_key", "search_key_en"])


@query("flt_terms_all_documents", ORACLES_OF["documents"])
def _(t):
    documents = t.source("documents")
    names = t.source("part").select(F.col("p_name").alias("qid"), F.col("p_name").alias("query")).distinct()
    return match.match_terms(documents, names, "doc_id", ["text"], staged=True, folded=False)


@query("flt_terms_all_indexed", ORACLES_OF["batch"])
def _(t):
    index = build_text_index(t.bilingual, "variable_id", ["search_key", "search_key_en"], workspace(t.spark, "codebook-words"))
    return lookup.match_indexed(index, queries_table(t))


@query("flt_terms_all_documents_indexed", ORACLES_OF["documents"])
def _(t):
    """Documents indexed once, and every product name looked up."""
    names = t.source("part").select(F.col("p_name").alias("qid"), F.col("p_name").alias("query")).distinct()
    index = build_text_index(t.source("documents"), "doc_id", ["text"], workspace(t.spark, "document-words"), folded=False)
    return lookup.match_indexed(index, names)


PICK = """
SELECT b.subjectId, b.variable_id FROM bilingual b
LEFT JOIN (SELECT subjectId, count(*) AS n FROM active_dims GROUP BY subjectId) a ON a.subjectId = b.subjectId
LEFT JOIN (SELECT d.subjectId, d.variable_id, count(*) AS n FROM dim_values d
           JOIN active_dims s ON d.subjectId = s.subjectId AND d.dim = s.dim
           WHERE {ticked} GROUP BY d.subjectId, d.variable_id) h ON h.variable_id = b.variable_id
WHERE coalesce(a.n, 0) = coalesce(h.n, 0)"""


@query(
    "flt_facets",
    PICK.format(
        ticked="""(d.dim = 'n1' AND d.value IN ('ogółem', 'small', 'large')) OR
(d.dim = 'n2' AND d.value IN ('ogółem', 'red', 'small')) OR (d.dim = 'n3' AND d.value IN ('ogółem', 'bolt', 'ring'))"""
    ),
)
def _(t):
    ticks = {
        "n1": [S.TOTAL, "small", "large"],
        "n2": [S.TOTAL, "red", "small"],
        "n3": [S.TOTAL, "bolt", "ring"],
    }
    return facets.pick(t.bilingual, ticks).select("subjectId", "variable_id")


@query(
    "flt_facet_text",
    """SELECT DISTINCT v.subjectId, v.dim, v.value FROM dim_values v
JOIN active_dims a ON v.subjectId = a.subjectId AND v.dim = a.dim
LEFT JOIN (SELECT subjectId, dim, value, max_by(value_en, variable_id) AS en FROM dim_values
           WHERE value_en <> '' GROUP BY subjectId, dim, value) e
  ON e.subjectId = v.subjectId AND e.dim = v.dim AND e.value = v.value
WHERE contains(lower(v.value || ' ' || coalesce(e.en, '')), 'al')""",
)
def _(t):
    return facets.facet_text(facets.facet_values(t.bilingual), "Ál").select("subjectId", "dim", "value")


@query(
    "flt_facet_all_none",
    f"""SELECT 'all' AS ticks, p.* FROM ({PICK.format(ticked="true")}) p
UNION ALL SELECT 'none', p.* FROM ({PICK.format(ticked="false")}) p""",
)
def _(t):
    everything = facets.pick_all(t.bilingual).select(F.lit("all").alias("ticks"), "subjectId", "variable_id")
    nothing = facets.pick_none(t.bilingual).select(F.lit("none").alias("ticks"), "subjectId", "variable_id")
    return everything.unionByName(nothing)


@query(
    "flt_facet_default",
    PICK.format(ticked="(d.subjectId, d.dim, d.value) IN (SELECT subjectId, dim, value FROM facet_defaults)"),
)
def _(t):
    return facets.pick_ticks(t.bilingual, facets.facet_defaults(t.bilingual))


@query(
    "flt_units_search",
    """SELECT unitId, unitName, unitLevel FROM units WHERE unitLevel IN (5, 4)
AND contains(lower(unitName), 'nation_1') AND contains(lower(unitName), 'building')""",
)
def _(t):
    test = filters.terms_all(" Building NATION_1", ["search_key"], stems=False)
    found = t.searchable_units.where(F.col("unitLevel").isin(5, 4) & test)
    return found.select("unitId", "unitName", "unitLevel")


@query(
    "flt_units_search_batch",
    _brute(
        "(SELECT unitId || '/' || unitLevel AS unit, lower(unitName) AS key FROM units WHERE unitLevel IN (6, 5, 4))",
        "unit", ["key"],
        "SELECT DISTINCT c_mktsegment || ' ' || n_name AS qid, c_mktsegment || ' ' || n_name AS query FROM geo",
        stems=False,
    ),
)
def _(t):
    unit = F.concat_ws("/", "unitId", F.col("unitLevel").cast("string"))
    pool = t.searchable_units.where(F.col("unitLevel").isin(6, 5, 4)).withColumn("unit", unit)
    asked = t.geo.select(F.concat_ws(" ", "c_mktsegment", "n_name").alias("qid")).distinct()
    return match.match_terms(pool, asked.withColumn("query", F.col("qid")), "unit", ["search_key"], stems=False)


@query(
    "flt_units_in_levels",
    "SELECT unitId, unitName, unitLevel FROM units WHERE unitLevel IS NULL OR unitLevel IN (2, 5)",
)
def _(t):
    return t.units.where(filters.level_in_or_unknown([2, 5])).select("unitId", "unitName", "unitLevel")


@query(
    "flt_key_range",
    """SELECT f.* FROM facts f, (SELECT max(variable_id) AS hi FROM facts) m
WHERE f.variable_id BETWEEN hi // 4 AND hi // 2""",
)
def _(t):
    hi = t.facts.agg(F.max("variable_id")).first()[0]
    return t.facts.where(filters.key_range(hi // 4, hi // 2))


@query("flt_leading_zero", "SELECT count(*) AS n FROM facts WHERE unitId LIKE '0%'")
def _(t):
    return t.facts.where(filters.leading_zero()).agg(F.count("*").alias("n"))


@query(
    "flt_min_query",
    """SELECT DISTINCT word FROM (SELECT unnest(string_split_regex(text, '[ \\n]+')) AS word FROM documents) w
WHERE length(trim(word)) >= 2""",
)
def _(t):
    words = t.source("documents").select(F.explode(F.split("text", r"[ \n]+")).alias("word"))
    return words.where(filters.long_enough(F.col("word"))).distinct()


HELD = "SELECT variable_id FROM codebook WHERE subjectId = 'P0012' AND n1 = 'ogółem'"
MORE = "SELECT variable_id FROM codebook WHERE subjectId = 'P0013' AND n1 = 'ogółem'"


def _subject_totals(t, subject):
    return t.codebook.where((F.col("subjectId") == subject) & (F.col("n1") == S.TOTAL)).select("variable_id")


@query(
    "flt_cart_limit",
    f"""SELECT 'some' AS kind, variable_id, true AS added FROM ({HELD}) h WHERE (SELECT count(*) FROM ({HELD}) n) <= 60
UNION ALL SELECT 'some', NULL, false WHERE (SELECT count(*) FROM ({HELD}) n) > 60
UNION ALL SELECT 'many', variable_id, true FROM codebook WHERE (SELECT count(*) FROM codebook) <= 60
UNION ALL SELECT 'many', NULL, false WHERE (SELECT count(*) FROM codebook) > 60""",
)
def _(t):
    none = t.codebook.select("variable_id").where(F.lit(False))
    some = selection_add(none, _subject_totals(t, "P0012")).withColumn("kind", F.lit("some"))
    many = selection_add(none, t.codebook.select("variable_id")).withColumn("kind", F.lit("many"))
    return some.unionByName(many).select("kind", "variable_id", "added")


@query(
    "set_selection_add",
    f"""SELECT variable_id, (SELECT count(*) FROM ({HELD}) a) + (SELECT count(*) FROM ({MORE}) b) <= 60 AS added FROM (
SELECT variable_id FROM ({HELD}) h UNION SELECT variable_id FROM ({MORE}) m
WHERE (SELECT count(*) FROM ({HELD}) a) + (SELECT count(*) FROM ({MORE}) b) <= 60) u""",
)
def _(t):
    return selection_add(_subject_totals(t, "P0012"), _subject_totals(t, "P0013"))


@query(
    "set_selection_remove",
    f"SELECT variable_id FROM codebook WHERE variable_id NOT IN ({HELD})",
)
def _(t):
    return selection_remove(t.codebook, _subject_totals(t, "P0012"))
