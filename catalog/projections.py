"""Label, key and naming expressions."""

from pyspark.sql import functions as F

from catalog.registry import query
from statbank import schema as S
from statbank.functions import text
from statbank.operators import facets


@query(
    "proj_null_tokens",
    "SELECT id, " + ", ".join(f"nullif(nullif(n{i}, ''), 'NA') AS n{i}" for i in range(1, 6)) + " FROM labels_raw",
)
def _(t):
    return t.labels_raw.select("id", *[text.null_tokens(F.col(d)).alias(d) for d in S.DIMS])


@query(
    "proj_dim_label",
    """SELECT c.variable_id, c.variable_dimensions, v.variable_dimensions_en
FROM codebook c JOIN variables_en v ON c.variable_id = v.id""",
)
def _(t):
    polish = t.variables.select(
        "id", text.dim_label([text.non_missing(F.col(d)) for d in S.DIMS]).alias("variable_dimensions")
    )
    english = t.labels_raw.select(
        "id", text.dim_label([text.null_tokens(F.col(d)) for d in S.DIMS]).alias("variable_dimensions_en")
    )
    return polish.join(english, "id").withColumnRenamed("id", "variable_id")


@query("proj_full_name", "SELECT variable_id, variable_full_name, variable_full_name_en FROM bilingual")
def _(t):
    return t.bilingual.select("variable_id", "variable_full_name", "variable_full_name_en")


@query("proj_search_keys", "SELECT variable_id, search_key, subj_norm, subj_en_norm, search_key_en FROM bilingual")
def _(t):
    return t.bilingual.select("variable_id", "search_key", "subj_norm", "subj_en_norm", "search_key_en")


@query(
    "proj_search_keys_documents",
    """SELECT doc_id, md5(replace(strip_accents(lower(text)), 'ł', 'l')) AS digest FROM documents""",
)
def _(t):
    return t.source("documents").select("doc_id", F.md5(text.fold(F.col("text"))).alias("digest"))


@query(
    "proj_level_name",
    """SELECT variable_id, unit_level,
       CASE unit_level WHEN 6 THEN 'gmina' WHEN 5 THEN 'powiat' WHEN 4 THEN 'podregion' WHEN 2 THEN 'wojewodztwo'
            WHEN 1 THEN 'makroregion' ELSE unit_level::VARCHAR END AS level,
       CASE 6 - unit_level WHEN 6 THEN 'gmina' WHEN 5 THEN 'powiat' WHEN 4 THEN 'podregion' WHEN 3 THEN 'region'
            WHEN 2 THEN 'wojewodztwo' WHEN 1 THEN 'makroregion' WHEN 0 THEN 'Polska' END AS doc_level,
       CASE unit_level WHEN 6 THEN 'gmina' WHEN 5 THEN 'powiat' WHEN 4 THEN 'podregion' WHEN 2 THEN 'woj.'
            WHEN 1 THEN 'makro' END AS short_level
FROM codebook""",
)
def _(t):
    level = F.col("unit_level")
    return t.codebook.select(
        "variable_id",
        "unit_level",
        text.level_name(level).alias("level"),
        text.level_name(6 - level, doc=True).alias("doc_level"),
        text.level_name_short(level).alias("short_level"),
    )


@query(
    "proj_unit_id",
    """WITH given AS (
  SELECT DISTINCT (unitId::BIGINT)::VARCHAR AS id FROM facts UNION SELECT DISTINCT unitName FROM facts
  UNION SELECT DISTINCT ' 1' || unitId || ' ' FROM facts)
SELECT id, CASE WHEN regexp_full_match(trim(id), '[0-9]+') AND length(trim(id)) < 12
                THEN lpad(trim(id), 12, '0') ELSE trim(id) END AS unitId FROM given""".replace("WITH given AS (", "SELECT id, unitId FROM (WITH given AS (")
    + ") normalised",
)
def _(t):
    units = t.facts.select("unitId", "unitName").distinct()
    given = units.select(
        F.explode(
            F.array(
                F.col("unitId").cast("bigint").cast("string"),
                F.col("unitName"),
                F.concat(F.lit(" 1"), F.col("unitId"), F.lit(" ")),
            )
        ).alias("id")
    ).distinct()
    return given.select("id", text.unit_id(F.col("id")).alias("unitId"))


# The aliases of the levels, written out so that the engine's own table is checked.
LEVEL_ALIASES = """(6, 'gmina'), (6, 'gminy'), (5, 'powiat'), (5, 'powiaty'), (4, 'subregion'), (4, 'podregion'),
(4, 'subregiony'), (4, 'podregiony'), (2, 'voivod'), (2, 'voivodeship'), (2, 'woj'), (2, 'wojewodztwo'),
(2, 'wojewodztwa'), (1, 'macroregion'), (1, 'makroregion'), (1, 'makroregiony')"""


@query(
    "proj_level_alias",
    f"""SELECT a.code, a.alias, count(*) AS n FROM codebook c JOIN (VALUES {LEVEL_ALIASES}) a(code, alias)
ON a.code = c.unit_level GROUP BY a.code, a.alias""",
)
def _(t):
    """Every alias of each variable's level, written in capitals and with blanks around it."""
    known = F.create_map(*[x for k, names in S.LEVEL_ALIASES.items() for x in (F.lit(k), F.array(*map(F.lit, names)))])
    alias = F.explode(F.try_element_at(known, F.col("unit_level").cast("int"))).alias("alias")
    given = t.codebook.select(alias).select(F.concat(F.lit(" "), F.upper("alias"), F.lit("\t")).alias("alias"))
    return given.groupBy(text.level_code(F.col("alias")).alias("code"), F.lower(F.trim("alias", F.lit(" \t"))).alias("alias")).agg(F.count("*").alias("n"))


@query(
    "proj_bilingual",
    """SELECT variable_id,
       coalesce(nullif(variable_full_name, ''), nullif(variable_full_name_en, ''), '') AS main_pl,
       CASE WHEN nullif(variable_full_name_en, '') IS DISTINCT FROM nullif(variable_full_name, '')
            THEN nullif(variable_full_name_en, '') END AS sub_pl,
       coalesce(nullif(variable_full_name_en, ''), nullif(variable_full_name, ''), '') AS main_en,
       CASE WHEN nullif(variable_full_name_en, '') IS DISTINCT FROM nullif(variable_full_name, '')
            THEN nullif(variable_full_name, '') END AS sub_en
FROM bilingual""",
)
def _(t):
    pair = F.col("variable_full_name"), F.col("variable_full_name_en")
    main_pl, sub_pl = text.bilingual(*pair, "pl")
    main_en, sub_en = text.bilingual(*pair, "en")
    return t.bilingual.select(
        "variable_id",
        main_pl.alias("main_pl"),
        sub_pl.alias("sub_pl"),
        main_en.alias("main_en"),
        sub_en.alias("sub_en"),
    )


AXES = """
SELECT a.subjectId, a.dim, a.axis,
       CASE WHEN len(p.parts) = a.n THEN upper(p.parts[a.axis][1:1]) || p.parts[a.axis][2:]
            WHEN a.n = 1 THEN 'Breakdown' ELSE 'Breakdown ' || a.axis END AS label,
       CASE WHEN len(p.parts_en) = a.n THEN upper(p.parts_en[a.axis][1:1]) || p.parts_en[a.axis][2:] END AS label_en
FROM (SELECT subjectId, dim, row_number() OVER (PARTITION BY subjectId ORDER BY dim) AS axis,
             count(*) OVER (PARTITION BY subjectId) AS n FROM active_dims) a
JOIN (SELECT subjectId,
             list_filter(list_transform(string_split_regex(regexp_extract(name, '(wg|według)\\s+(.+)$', 2),
                         '\\s*,\\s*|\\s+i\\s+'), lambda x: trim(x)), lambda x: x <> '') AS parts,
             list_filter(list_transform(string_split_regex(regexp_extract(name_en, '\\bby\\s+(.+)$', 1),
                         '\\s*,\\s*|\\s+and\\s+'), lambda x: trim(x)), lambda x: x <> '') AS parts_en
      FROM (SELECT subjectId, min(subject_name) AS name, min(subject_name_en) AS name_en
            FROM bilingual GROUP BY subjectId) titles) p ON a.subjectId = p.subjectId"""


@query("proj_axis_labels", AXES)
def _(t):
    return facets.axes(t.bilingual)


def _variants(word: str) -> str:
    suffixes = ["ments", "ment", "tions", "tion", "sions", "sion", "ing", "ers", "ed", "es", "s"]
    stems = " ".join(
        f"WHEN {word} LIKE '%{s}' AND length({word}) >= {len(s) + 4} THEN left({word}, length({word}) - {len(s)})"
        for s in suffixes
    )
    return (
        f"list_value({word}, CASE WHEN length({word}) > 5 AND {word} LIKE '%ies' "
        f"THEN left({word}, length({word}) - 3) || 'y' END, CASE WHEN length({word}) > 5 THEN CASE {stems} END END)"
    )


@query(
    "proj_term_variants",
    f"""SELECT word, array_to_string(list_sort(list_distinct({_variants("word")})), '|') AS variants
FROM (SELECT DISTINCT unnest(string_split_regex(lower(text), '[ \\n]+')) AS word FROM documents) w""",
)
def _(t):
    words = t.source("documents").select(F.explode(F.split(F.lower("text"), r"[ \n]+")).alias("word")).distinct()
    variants = F.array_join(F.array_sort(text.term_variants(F.col("word"))), "|")
    return words.select("word", variants.alias("variants"))


@query("proj_measure_shown", "SELECT variable_id, nullif(measureUnitName, '-') AS unit FROM codebook")
def _(t):
    return t.codebook.select("variable_id", text.measure_shown(F.col("measureUnitName")).alias("unit"))


@query(
    "proj_series_name",
    """SELECT DISTINCT f.variable_id, f.unitId, f.unitLevel,
       concat_ws(' — ', nullif(f.unitName, ''),
         CASE f.unitLevel WHEN 6 THEN 'gmina' WHEN 5 THEN 'powiat' WHEN 4 THEN 'podregion' WHEN 2 THEN 'woj.'
              WHEN 1 THEN 'makro' END, nullif(c.variable_full_name, '')) AS series_name
FROM facts f LEFT JOIN codebook c USING (variable_id)""",
)
def _(t):
    series = t.facts.select("variable_id", "unitId", "unitLevel", "unitName").distinct()
    named = series.join(t.codebook.select("variable_id", "variable_full_name"), "variable_id", "left")
    name = text.series_name(
        F.col("unitName"), F.col("unitLevel"), F.col("variable_full_name"), F.lit(True), F.lit(True)
    )
    return named.select("variable_id", "unitId", "unitLevel", name.alias("series_name"))
