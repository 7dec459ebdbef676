"""The derived tables as oracle SQL, written independently of the operators they check."""

import re

from catalog.fixtures import LABELS_SQL, SUBJECTS_EN_SQL, SUBJECTS_SQL, VARIABLES_SQL

UNIT_CODES = {
    1: ("r2 || '0000000000'", "r_name"),
    2: ("r2 || n2 || '00000000'", "n_name"),
    4: ("r2 || n2 || s1 || '0000000'", "n_name || ' ' || c_mktsegment"),
    5: ("r2 || n2 || s1 || b1 || '000000'", "n_name || ' ' || c_mktsegment || ' ' || b1"),
    6: ("r2 || n2 || s1 || b1 || c6", "c_name"),
}


def _facts(level: int) -> str:
    code, name = UNIT_CODES[level]
    return f"""
SELECT l_partkey::BIGINT AS variable_id, {code} AS unitId, min({name}) AS unitName,
       {level}::BIGINT AS unitLevel, year(o_orderdate)::BIGINT AS year,
       CASE WHEN (l_partkey + year(o_orderdate)) % 11 = 0 THEN NULL ELSE sum(l_quantity) END AS value,
       min(l_linenumber)::BIGINT AS attr_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN geo ON o_custkey = geo.c_custkey
GROUP BY l_partkey, {code}, year(o_orderdate)"""


def _label(missing: str) -> str:
    """The dimensions outside the `missing` list, joined."""
    kept = f"list_filter([n1, n2, n3, n4, n5], lambda d: d IS NOT NULL AND d NOT IN ({missing}))"
    return f"array_to_string({kept}, ' | ')"


PL = _label("'NA'")
EN = _label("'NA', ''")

TABLES = {
    "geo": """
SELECT c_custkey, lpad(r_regionkey::VARCHAR, 2, '0') AS r2, lpad(n_nationkey::VARCHAR, 2, '0') AS n2,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '1' WHEN 'BUILDING' THEN '2' WHEN 'FURNITURE' THEN '3'
                         WHEN 'HOUSEHOLD' THEN '4' ELSE '5' END AS s1,
       (c_custkey % 4)::VARCHAR AS b1, lpad(c_custkey::VARCHAR, 6, '0') AS c6,
       r_name, n_name, c_mktsegment, c_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    **{f"facts_{level}": _facts(level) for level in UNIT_CODES},
    "facts": " UNION ALL ".join(f"SELECT * FROM facts_{level}" for level in UNIT_CODES),
    "variables": f"""
SELECT id::BIGINT AS id, subjectId, n1, n2, n3, n4, n5, level::BIGINT AS level,
       measureUnitId::BIGINT AS measureUnitId, measureUnitName
FROM ({VARIABLES_SQL.format(part="part")}) raw_variables""",
    "subjects": SUBJECTS_SQL.format(part="part"),
    "labels_raw": LABELS_SQL.format(variables="variables"),
    "subjects_en": SUBJECTS_EN_SQL.format(part="part"),
    "variables_en": f"""
SELECT id, {", ".join(f"nullif(nullif(n{i}, ''), 'NA') AS n{i}_en" for i in range(1, 6))},
       measureUnitName AS measureUnitName_en, {EN} AS variable_dimensions_en
FROM labels_raw""",
    "level_names": """
SELECT * FROM (VALUES (6, 'gmina', 'gmina'), (5, 'powiat', 'powiat'), (4, 'podregion', 'podregion'),
       (3, NULL, 'region'), (2, 'wojewodztwo', 'wojewodztwo'), (1, 'makroregion', 'makroregion'),
       (0, NULL, 'Polska')) l(code, level, doc_level)""",
    "codebook": f"""
SELECT variable_id, subjectId, subject_name, subject_description, subject_parent_id, n1, n2, n3, n4, n5,
       variable_dimensions, unit_level, measureUnitId, measureUnitName,
       CASE WHEN subject_name IS NULL THEN '' ELSE subject_name || ': ' END || variable_dimensions AS variable_full_name
FROM (SELECT variables.* RENAME (id AS variable_id, level AS unit_level), {PL} AS variable_dimensions,
             subjects.name AS subject_name, subjects.description AS subject_description,
             subjects.parentId AS subject_parent_id
      FROM variables LEFT JOIN subjects ON subjects.id = variables.subjectId) named""",
    "bilingual": """
SELECT * EXCLUDE (folded_dims, subject_description, subject_parent_id, measureUnitId),
       subj_norm || ' ' || folded_dims AS search_key,
       subj_en_norm || ' ' || lower(coalesce(variable_dimensions_en, '')) AS search_key_en
FROM (SELECT codebook.*, variables_en.* EXCLUDE (id), name_en AS subject_name_en,
             nullif(array_to_string(list_filter([name_en, nullif(variable_dimensions_en, '')],
                                                lambda p: p IS NOT NULL), ': '), '') AS variable_full_name_en,
             replace(lower(strip_accents(subject_name)), 'ł', 'l') AS subj_norm,
             replace(lower(strip_accents(variable_dimensions)), 'ł', 'l') AS folded_dims,
             coalesce(lower(name_en), '') AS subj_en_norm
      FROM codebook LEFT JOIN subjects_en USING (subjectId)
      LEFT JOIN variables_en ON variables_en.id = codebook.variable_id) keyed""",
    "units": """
SELECT unitId, min(unitName) AS unitName, unitLevel, substr(unitId, 3, 2) AS voivod_teryt,
       min(year) AS first_year, max(year) AS last_year
FROM facts GROUP BY unitId, unitLevel""",
    "dim_values": " UNION ALL ".join(
        f"SELECT subjectId, variable_id, 'n{i}' AS dim, n{i} AS value, n{i}_en AS value_en FROM bilingual "
        f"WHERE n{i} IS NOT NULL AND n{i} != 'NA'"
        for i in range(1, 6)
    ),
    "active_dims": """
SELECT subjectId, dim, count(DISTINCT value) AS n_values FROM dim_values
GROUP BY subjectId, dim HAVING count(DISTINCT value) > 1""",
    "facet_defaults": """
SELECT d.subjectId, d.dim, coalesce(max(d.value) FILTER (WHERE d.value = 'ogółem'), min(d.value)) AS value
FROM dim_values d JOIN active_dims a ON d.subjectId = a.subjectId AND d.dim = a.dim GROUP BY d.subjectId, d.dim""",
    "ranges": """
SELECT unitLevel, part, min(variable_id) AS lo, max(variable_id) AS hi, sum(n)::BIGINT AS rows
FROM (SELECT unitLevel, variable_id, n,
             least(parts - 1, floor(parts * (sum(n) OVER (PARTITION BY unitLevel ORDER BY variable_id) - n)
                                    / sum(n) OVER (PARTITION BY unitLevel)))::BIGINT AS part
      FROM (SELECT unitLevel, variable_id, count(*) AS n,
                   CASE unitLevel WHEN 6 THEN 16 WHEN 5 THEN 4 ELSE 1 END AS parts
            FROM facts GROUP BY unitLevel, variable_id) key_rows) key_places
GROUP BY unitLevel, part""",
    "points": """
SELECT variable_id, unitId, unitLevel, year, max(value) AS value FROM facts
WHERE value IS NOT NULL GROUP BY variable_id, unitId, unitLevel, year""",
    "series": """
SELECT variable_id, unitId, unitLevel, avg(value) AS mean, count(*) AS n_points FROM points
GROUP BY variable_id, unitId, unitLevel""",
}


def _used(sql: str) -> list[str]:
    return [name for name in TABLES if re.search(rf"\b{name}\b", sql)]


def with_tables(sql: str) -> str:
    """Prefix a query with the derived tables it uses, each after those it builds on."""
    ordered: list[str] = []

    def visit(text: str, skip: str | None = None) -> None:
        for name in _used(text):
            if name != skip and name not in ordered:
                visit(TABLES[name], name)
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql.strip()
    body = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in ordered)
    return f"WITH {body}\n{sql.strip()}"
