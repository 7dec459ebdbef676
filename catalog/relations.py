"""Joins, set operations, aggregations and windows."""

from pyspark.sql import functions as F

from catalog.registry import query
from statbank import schema as S
from statbank.operators import dataset, facets, filters, metadata, quality, resolve, search, series
from statbank.operators.order import placed
from statbank.sinks import layout

LABELLED = """
SELECT f.variable_id, f.unitId, f.unitName, f.unitLevel, f.year, f.value, c.subject_name,
       c.variable_dimensions, c.measureUnitName, c.variable_full_name
FROM facts f LEFT JOIN codebook c USING (variable_id)"""


@query("join_codebook", "SELECT * FROM codebook")
def _(t):
    return metadata.codebook(t.variables, t.subjects)


@query("join_bilingual", "SELECT * FROM bilingual")
def _(t):
    return metadata.bilingual_codebook(t.codebook, t.subjects_en, t.variables_en)


@query(
    "join_bilingual_absent",
    """SELECT variable_id, subject_name_en, NULL::VARCHAR AS n1_en, subject_name_en AS variable_full_name_en,
       lower(coalesce(subject_name_en, '') || ' ') AS search_key_en FROM bilingual""",
)
def _(t):
    names_only = metadata.bilingual_codebook(t.codebook, t.subjects_en)
    return names_only.select(
        "variable_id", "subject_name_en", "n1_en", "variable_full_name_en", "search_key_en"
    )


@query("join_fact_labels", LABELLED)
def _(t):
    return dataset.with_labels(t.facts, t.codebook)


@query(
    "join_fact_inner",
    """SELECT f.variable_id, f.unitId, f.year, f.value, c.variable_full_name FROM facts f JOIN codebook c USING (variable_id)
WHERE f.unitLevel = 4 AND f.unitName LIKE 'NATION\\_1%' ESCAPE '\\' AND starts_with(c.subject_name, 'Ludność')""",
)
def _(t):
    places = t.facts.where((F.col("unitLevel") == 4) & F.col("unitName").startswith("NATION_1"))
    people = t.codebook.where(F.col("subject_name").startswith("Ludność"))
    found = dataset.with_metadata(places, people, "variable_full_name")
    return found.select("variable_id", "unitId", "year", "value", "variable_full_name")


def _codes(t):
    """Subject and category codes drawn from the data: those below K1 and K3, and every category."""
    subjects = t.subjects.where(F.col("parentId").isin("K1", "K3") | F.col("id").startswith("K"))
    return subjects.select(F.col("id").alias("code"))


BY_SUBJECT = """
SELECT v.id AS variable_id FROM variables v
WHERE v.subjectId IN (SELECT id FROM subjects WHERE parentId IN ('K1', 'K3') AND NOT starts_with(id, 'K'))"""
CATEGORY = """
SELECT DISTINCT k.id AS code, c.subjectId FROM subjects k JOIN codebook c
ON contains(lower(c.subject_name), lower(coalesce(
     list_filter(string_split_regex(k.name, '\\s+'), lambda w: length(w) > 3)[1], k.name)))
WHERE starts_with(k.id, 'K')"""
BY_CATEGORY = f"SELECT v.id AS variable_id FROM variables v WHERE v.subjectId IN (SELECT subjectId FROM ({CATEGORY}) k)"


@query("join_subject_vars", BY_SUBJECT)
def _(t):
    return resolve.by_subject(t.variables, _codes(t))


@query("join_category_subjects", CATEGORY)
def _(t):
    return resolve.category_subjects(t.subjects, t.codebook, _codes(t))


@query("join_category_vars", BY_CATEGORY)
def _(t):
    return resolve.by_category(t.variables, t.subjects, t.codebook, _codes(t))


@query("set_union_levels", "SELECT * FROM facts WHERE unitLevel IN (1, 2, 4) AND year >= 1998")
def _(t):
    arms = [t.facts.where((F.col("unitLevel") == n) & filters.year_range(1998)) for n in (1, 2, 4)]
    return arms[0].unionByName(arms[1]).unionByName(arms[2])


@query(
    "set_union_ids",
    f"""SELECT id AS variable_id FROM variables WHERE measureUnitName = 'zł'
UNION {BY_SUBJECT} UNION {BY_CATEGORY}""",
)
def _(t):
    direct = t.variables.where(F.col("measureUnitName") == "zł").select(F.col("id").alias("variable_id"))
    codes = _codes(t)
    return resolve.union_ids(
        direct,
        resolve.by_subject(t.variables, codes),
        resolve.by_category(t.variables, t.subjects, t.codebook, codes),
    )


@query(
    "set_narrow_ids",
    f"SELECT variable_id FROM ({BY_SUBJECT}) s WHERE variable_id IN (SELECT variable_id FROM codebook WHERE n1 = 'ogółem' AND (n2 IS NULL OR n2 = 'NA'))",
)
def _(t):
    ids = resolve.by_subject(t.variables, _codes(t))
    return resolve.narrow_ids(ids, t.codebook, filters.dims_predicate({"n1": S.TOTAL, "n2": [None]}))


PROFILE = """
SELECT CASE unitLevel WHEN 6 THEN 'facts_gminy' WHEN 5 THEN 'facts_powiaty' WHEN 4 THEN 'facts_podregiony'
            WHEN 2 THEN 'facts_wojewodztwa' WHEN 1 THEN 'facts_makroregiony' END AS tbl,
       count(*) AS nrows, count(DISTINCT variable_id) AS nvars, count(DISTINCT unitId) AS nunits,
       min(length(unitId)) AS min_idlen, max(length(unitId)) AS max_idlen, count(DISTINCT unitLevel) AS nlevels
FROM {facts} GROUP BY 1"""


@query("agg_profile", PROFILE.format(facts="facts"))
def _(t):
    return quality.profile(t.facts)


@query(
    "agg_profile_unknown_levels",
    PROFILE.format(
        facts="""(SELECT * REPLACE (CASE variable_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 3 WHEN 2 THEN 0 ELSE unitLevel END AS unitLevel,
CASE WHEN variable_id % 7 <> 0 THEN variable_id END AS variable_id, CASE WHEN year <> 1995 THEN unitId END AS unitId) FROM facts) odd"""
    ),
)
def _(t):
    """Facts without a level, of levels that hold none, and without keys; the state of each half is made by itself."""
    v = F.col("variable_id")
    level = F.when(v % 5 == 0, None).when(v % 5 == 1, 3).when(v % 5 == 2, 0).otherwise(F.col("unitLevel")).cast("tinyint")
    keys = {"variable_id": F.when(v % 7 != 0, v), "unitId": F.when(F.col("year") != 1995, F.col("unitId"))}
    facts = t.facts.withColumns({"unitLevel": level} | keys)
    early = F.col("year") < 1996
    return quality.profile_of(quality.merged_states(quality.profile_state(facts.where(early)), quality.profile_state(facts.where(~early))))


@query("agg_count", "SELECT unitLevel, count(*) AS n FROM facts GROUP BY unitLevel")
def _(t):
    return dataset.level_counts(t.facts)


@query("agg_label_check", "SELECT count(*) AS n, count(DISTINCT id) AS u FROM variables_en")
def _(t):
    return quality.label_check(t.variables_en)


SUBJECT_SUMMARY = """
SELECT subjectId, max(subject_name) AS subject_name, count(*) AS n_variables,
       count(*) FILTER (WHERE n1 = 'ogółem' AND coalesce(n2, 'NA') IN ('NA', 'ogółem')
                        AND coalesce(n3, 'NA') IN ('NA', 'ogółem')) AS n_aggregate,
       string_agg(DISTINCT n1, ' | ' ORDER BY n1) AS n1_breakdowns, min(variable_id) AS example_variable_id
FROM codebook WHERE contains(lower(subject_name), lower('{query}')) {more} GROUP BY subjectId"""


@query("agg_subject_summary", SUBJECT_SUMMARY.format(query="O", more=""))
def _(t):
    return search.search_subjects(t.codebook, "O")


@query(
    "agg_subject_hits",
    """SELECT subjectId, min(subject_name) AS subject_name, min(subject_name_en) AS subject_name_en,
       min(subj_norm) AS subj_norm, min(subj_en_norm) AS subj_en_norm, count(*) AS n_vars,
       min(measureUnitName) AS measureUnitName
FROM bilingual WHERE contains(search_key, 'ring') AND unit_level >= 4 GROUP BY subjectId""",
)
def _(t):
    found = t.bilingual.where(F.col("search_key").contains("ring") & filters.level_available([4, 5]))
    return search.subject_hits(found)


@query(
    "agg_distinct_subjects",
    "SELECT DISTINCT subjectId FROM codebook WHERE contains(lower(subject_name), lower('Źródła'))",
)
def _(t):
    found = t.codebook.where(filters.contains_any("ŹRÓDŁA", ["subject_name"]))
    return found.select("subjectId").distinct()


@query("agg_key_counts", "SELECT unitLevel, variable_id, count(*) AS n FROM facts GROUP BY unitLevel, variable_id")
def _(t):
    return layout.key_counts(t.facts)


@query(
    "agg_key_bounds",
    """SELECT CASE unitLevel WHEN 6 THEN 'facts_gminy' WHEN 5 THEN 'facts_powiaty' WHEN 4 THEN 'facts_podregiony'
            WHEN 2 THEN 'facts_wojewodztwa' ELSE 'facts_makroregiony' END AS tbl,
       min(variable_id) AS var_min, max(variable_id) AS var_max FROM facts GROUP BY unitLevel""",
)
def _(t):
    return layout.key_bounds(t.facts)


@query("agg_active_dims", "SELECT * FROM active_dims")
def _(t):
    return facets.active_dims(t.bilingual)


FACET_VALUES = """
SELECT v.subjectId, v.dim, v.value, v.n_variables, e.value_en
FROM (SELECT subjectId, dim, value, count(*) AS n_variables FROM dim_values GROUP BY subjectId, dim, value) v
JOIN active_dims a ON v.subjectId = a.subjectId AND v.dim = a.dim
LEFT JOIN (SELECT subjectId, dim, value, max_by(value_en, variable_id) AS value_en FROM dim_values
           WHERE value_en <> '' GROUP BY subjectId, dim, value) e
  ON e.subjectId = v.subjectId AND e.dim = v.dim AND e.value = v.value"""
RANKED_VALUES = f"""
SELECT *, row_number() OVER (PARTITION BY subjectId, dim ORDER BY value <> 'ogółem', value) AS position
FROM ({FACET_VALUES}) fv"""


@query("agg_facet_values", FACET_VALUES)
def _(t):
    return facets.facet_values(t.bilingual)


@query("win_facet_rank", RANKED_VALUES)
def _(t):
    return facets.ranked_values(facets.facet_values(t.bilingual))


@query("sort_facet", f"SELECT *, row_number() OVER (ORDER BY subjectId, dim, value <> 'ogółem', value) AS place FROM ({FACET_VALUES}) fv")
def _(t):
    values = facets.facet_values(t.bilingual)
    return placed(values, ["subjectId", "dim", *facets.total_first(F.col("value"))])


@query("agg_series_mean", "SELECT * FROM series")
def _(t):
    return series.series(t.facts, dealt=True)


@query(
    "agg_mixed_measures",
    """SELECT count(DISTINCT coalesce(measureUnitName, '')) AS n_measures,
       count(*) > 1 AND count(DISTINCT coalesce(measureUnitName, '')) > 1 AS mixed,
       string_agg(DISTINCT coalesce(measureUnitName, ''), ', ' ORDER BY coalesce(measureUnitName, '')) AS measures
FROM codebook""",
)
def _(t):
    return series.mixed_measures(t.codebook)


TOP = "SELECT variable_id, unitId, unitLevel FROM series ORDER BY mean DESC, variable_id, unitLevel DESC, unitId LIMIT 8"


@query(
    "agg_chart_domain",
    f"""SELECT (SELECT count(DISTINCT year) FROM facts) AS n_years, (SELECT min(year) FROM facts) AS year_min,
       (SELECT max(year) FROM facts) AS year_max, least(0.0, min(value))::DOUBLE AS y_min, max(value) AS y_max
FROM points JOIN ({TOP}) s USING (variable_id, unitId, unitLevel)""",
)
def _(t):
    return series.domain(t.facts, series.top_points(t.facts, dealt=True))


def _estimate(total: str) -> str:
    return f"""
SELECT total, total * 95 AS bytes,
       CASE WHEN total * 95 < 1000000 THEN greatest(1, floor(total * 95 / 1000 + 0.5)::BIGINT) || ' KB'
            WHEN total * 95 < 10000000 THEN printf('%.1f', total * 95 / 1000000) || ' MB'
            ELSE floor(total * 95 / 1000000 + 0.5)::BIGINT || ' MB' END AS size,
       CASE WHEN total > 3000000 THEN 'heavy' WHEN total > 500000 THEN 'warn' ELSE 'ok' END AS feasibility
FROM ({total}) counted"""


@query(
    "agg_estimate",
    _estimate("SELECT count(*) * m AS total FROM facts, (VALUES (1), (8), (80)) f(m) GROUP BY m")
    + " UNION ALL "
    + _estimate("SELECT count(*) AS total FROM facts_1 WHERE year = 1995"),
)
def _(t):
    whole = t.facts.agg(F.count("*").alias("rows"))
    scaled = whole.select(F.explode(F.array(*[F.col("rows") * m for m in (1, 8, 80)])).alias("total"))
    few = t.facts_at([1]).where(F.col("year") == 1995).agg(F.count("*").alias("total"))
    return dataset.estimate(scaled).unionByName(dataset.estimate(few))


@query(
    "agg_summary",
    """SELECT count(*) AS observations, count(DISTINCT variable_id) AS variables, count(DISTINCT unitLevel) AS levels,
       count(DISTINCT unitId) AS units, min(year) AS year_from, max(year) AS year_to FROM facts""",
)
def _(t):
    return dataset.summary(t.facts)


@query(
    "win_cumsum",
    """SELECT unitLevel, variable_id, n,
       (sum(n) OVER (PARTITION BY unitLevel ORDER BY variable_id) - n)::BIGINT AS before,
       (sum(n) OVER (PARTITION BY unitLevel))::BIGINT AS total
FROM (SELECT unitLevel, variable_id, count(*) AS n FROM facts GROUP BY unitLevel, variable_id) k""",
)
def _(t):
    return layout.prefix_sum(layout.key_counts(t.facts))


@query(
    "win_partition_any",
    """SELECT variable_id, subjectId, max(subject_name_en) OVER (PARTITION BY subjectId) AS subject_name_en FROM bilingual""",
)
def _(t):
    rows = t.bilingual.select("variable_id", "subjectId", "subject_name_en")
    return metadata.any_of_group(rows, "subjectId", "subject_name_en")


@query("win_dedup_last", "SELECT * FROM points")
def _(t):
    return series.points(t.facts, dealt=True)
