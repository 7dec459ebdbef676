"""Sorted and limited reports."""

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.sources import LONG
from statbank.operators import dataset, metadata, search, series
from statbank.operators.order import placed, placed_by_key

PREVIEW = """
SELECT variable_id, unitId, unitName, unitLevel, year, value FROM facts
ORDER BY variable_id, unitLevel DESC, unitId, year LIMIT {n}"""


@query("top_preview", PREVIEW.format(n=3000))
def _(t):
    return dataset.preview(t.facts.drop("attr_id"))


@query("top_table", PREVIEW.format(n=1000))
def _(t):
    return dataset.table(t.facts.drop("attr_id"))


@query("top_table_note", "SELECT least(count(*), 1000) AS shown, count(*) AS total FROM facts")
def _(t):
    return dataset.shown_of_total(t.facts)


RANKED = """
SELECT subjectId, name, name_en, n_vars, unit, (NOT in_name)::BIGINT AS name_match, (NOT leads)::BIGINT AS is_prefix,
       len(string_split(name, ',')) - 1 AS commas, length(name) AS namelen
FROM (SELECT subjectId, name, name_en, n_vars, unit, coalesce({all_in_name}, false) AS in_name,
             coalesce(starts_with(norm, '{start}') OR starts_with(en_norm, '{start}'), false) AS leads
      FROM (SELECT subjectId, min(subject_name) AS name, min(subject_name_en) AS name_en, min(subj_norm) AS norm,
                   min(subj_en_norm) AS en_norm, count(*) AS n_vars, min(measureUnitName) AS unit
            FROM bilingual WHERE ({where}) AND unit_level >= {level} GROUP BY subjectId) s) r
ORDER BY name_match, is_prefix, commas, namelen, n_vars DESC, subjectId LIMIT 40"""


def ranked_oracle(forms: list[list[str]], start: str, level: int) -> str:
    """`forms`: the accepted forms of each word, written out by hand."""

    def every(columns: list[str]) -> str:
        words = [" OR ".join(f"contains({c}, '{f}')" for f in word for c in columns) for word in forms]
        return " AND ".join(f"({w})" for w in words)

    return RANKED.format(
        all_in_name=every(["norm", "en_norm"]),
        where=every(["search_key", "search_key_en"]),
        start=start,
        level=level,
    )


@query("top_subjects", ranked_oracle([["dwellings", "dwelling"]], "dwellings", 4))
def _(t):
    return search.ranked_search(t.bilingual, "Dwellings", [6, 4])


@query(
    "top_units",
    """SELECT unitId, unitName, unitLevel FROM units WHERE unitLevel IN (6, 5) AND contains(lower(unitName), 'customer#00')
ORDER BY unitLevel DESC, unitName, unitId LIMIT 100""",
)
def _(t):
    return search.unit_search(t.searchable_units, "Customer#00", [6, 5])


@query("top_series", "SELECT * FROM series ORDER BY mean DESC, variable_id, unitLevel DESC, unitId LIMIT 8")
def _(t):
    return series.top_series(t.facts)


@query("sort_export", f"SELECT *, row_number() OVER (ORDER BY variable_id, unitLevel DESC, unitId, year) AS place FROM ({LONG}) long")
def _(t):
    return placed_by_key(dataset.long(t.facts, t.codebook), "variable_id", dataset.export_order())


@query(
    "top_sample",
    "SELECT id, n1_en, variable_dimensions_en, measureUnitName_en FROM variables_en ORDER BY id LIMIT 4",
)
def _(t):
    return metadata.label_sample(t.variables_en)


@query(
    "sort_search",
    """SELECT variable_id, subjectId, subject_name, variable_dimensions, variable_full_name, measureUnitName, unit_level,
       row_number() OVER (ORDER BY subjectId, variable_id) AS place
FROM codebook WHERE contains(lower(variable_full_name), 'blue')""",
)
def _(t):
    return placed(search.search_variables(t.codebook, "BLUE"), ["subjectId", "variable_id"])
