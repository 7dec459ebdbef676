"""Sources, sinks and layout: written by Spark to the shared folder and read back."""

from pyspark.sql import functions as F

from catalog.registry import query
from statbank import schema as S
from statbank.functions import text
from statbank.operators import dataset, metadata
from statbank.operators.order import placed
from statbank.plans.store import Store, build_store, export_store, grown, lay_out
from statbank.session import discard_folders, exchanges_dropped, materialized, small_side, workspace
from statbank.sinks import datasets, layout
from statbank.sources import files, scan
from statbank.sources.ingest import Ingested, ingest_extracts

FACTS = "SELECT * FROM facts"
LONG = """
SELECT f.variable_id, c.variable_full_name AS variable_name, f.unitId, f.unitName, f.unitLevel, l.level, f.year, f.value
FROM facts f LEFT JOIN codebook c USING (variable_id) JOIN level_names l ON l.code = f.unitLevel"""
DOC = """
SELECT variable_id, variable_full_name AS variable_name, variable_full_name_en AS variable_name_en,
       subject_name AS subject_pl, subject_name_en AS subject_en, variable_dimensions AS breakdown_pl,
       variable_dimensions_en AS breakdown_en, measureUnitName AS measure_unit,
       measureUnitName_en AS measure_unit_en,
       doc_level AS lowest_level, subjectId
FROM bilingual JOIN level_names ON code = unit_level WHERE measureUnitName = 'zł'"""


def _extracts(t) -> dict[str, str]:
    """Raw CSV extracts, one folder per endpoint name, written in one job."""
    folder = workspace(t.spark, "csv")
    endpoint = F.lit(None).cast("string")
    for name, level in S.RAW_FILE_LEVELS.items():
        endpoint = F.when(F.col("unitLevel") == level, name).otherwise(endpoint)
    # Names and codes are repeated in every line, so the files are gzipped; a task's own are small enough to be read whole.
    extracts = t.facts.withColumn("endpoint", endpoint).sortWithinPartitions("endpoint", "variable_id", "unitId", "year")
    extracts.write.options(header=True, compression="gzip").partitionBy("endpoint").csv(folder)
    return {name: f"{folder}/endpoint={name}" for name in S.RAW_FILE_LEVELS}


@query("src_fact_csv", FACTS)
def _(t):
    return files.load_raw_extracts(t.spark, _extracts(t))


FAULT = """CASE WHEN variable_id % 29 = 3 THEN 'cells' WHEN variable_id % 29 = 5 THEN 'type of year'
            WHEN variable_id % 29 = 7 THEN 'no unitId' WHEN variable_id % 29 = 11 THEN 'level' END"""
LINES = f"""
SELECT *, {FAULT} AS reason  FROM facts"""


def _damaged(t, compression: str = "none") -> dict[str, str]:
    """The extracts with some lines damaged, as text."""
    folder = workspace(t.spark, "damaged")
    fault = F.col("variable_id") % 29
    cells = {
        "variable_id": F.col("variable_id"),
        "unitId": F.when(fault == 7, F.lit("")).otherwise(F.col("unitId")),
        "unitName": F.concat(F.lit('"'), "unitName", F.lit(', ""named"""')),
        "unitLevel": F.when(fault == 11, F.lit(3)).otherwise(F.col("unitLevel")),
        "year": F.when(fault == 5, F.concat(F.lit("y"), F.col("year").cast("string"))).otherwise(F.col("year").cast("string")),
        "value": F.coalesce(F.col("value").cast("string"), F.lit("")),
        "attr_id": F.col("attr_id"),
    }
    line = F.concat_ws(",", *[c.cast("string") for c in cells.values()])
    line = F.when(fault == 3, F.concat(line, F.lit(",one more"))).otherwise(line)
    endpoint = F.lit(None).cast("string")
    for name, level in S.RAW_FILE_LEVELS.items():
        endpoint = F.when(F.col("unitLevel") == level, name).otherwise(endpoint)
    # Lines are far longer than stored facts: sorted as facts they compress well, in files that one task can read whole.
    facts = t.facts.withColumn("endpoint", endpoint).sortWithinPartitions("endpoint", "variable_id", "unitId", "year")
    lines = facts.select(line.alias("value"), "endpoint")
    header = ",".join(cells)
    # The whole line is one column named by the header, so a header leads each file of each task; nothing is quoted again.
    raw = dict(header=True, sep="\x01", quote="\x00", escape="\x00", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    raw |= dict(compression=compression, maxRecordsPerFile=datasets.ROWS_PER_FILE)
    with exchanges_dropped(t.spark):
        lines.select(F.col("value").alias(header), "endpoint").write.options(**raw).partitionBy("endpoint").csv(folder)
    # An endpoint without lines has a header all the same.
    headers = t.spark.range(1).select(F.lit(header).alias("value"), F.explode(F.array(*map(F.lit, S.RAW_FILE_LEVELS))).alias("endpoint"))
    headers.write.mode("append").partitionBy("endpoint").text(folder)
    return {name: f"{folder}/endpoint={name}" for name in S.RAW_FILE_LEVELS}


def _ingested(t) -> Ingested:
    """The damaged extracts, gzipped and ingested. They are deleted then: every line is stored, as a fact or in the quarantine."""
    extracts = _damaged(t, "gzip")
    ingested = ingest_extracts(t.spark, extracts, workspace(t.spark, "ingested"))
    discard_folders(t.spark, *extracts.values())
    return ingested


@query("src_fact_csv_good", f"SELECT * EXCLUDE (reason) REPLACE (unitName || ', ' || chr(34) || 'named' || chr(34) AS unitName) FROM ({LINES}) l WHERE reason IS NULL")
def _(t):
    return _ingested(t).facts


ENDPOINT_OF = " ".join(f"WHEN {level} THEN '{name}'" for name, level in S.RAW_FILE_LEVELS.items())


@query(
    "src_fact_csv_quarantine",
    f"""SELECT CASE unitLevel {ENDPOINT_OF} END AS endpoint, reason,
  variable_id || ',' || CASE WHEN reason = 'no unitId' THEN '' ELSE unitId END || ',"' || unitName || ', ""named""' || '",'
  || CASE WHEN reason = 'level' THEN 3 ELSE unitLevel END || ',' || CASE WHEN reason = 'type of year' THEN 'y' ELSE '' END || year
  || ',' || coalesce(value::VARCHAR, '') || ',' || attr_id || CASE WHEN reason = 'cells' THEN ',one more' ELSE '' END AS line
FROM ({LINES}) l WHERE reason IS NOT NULL""",
)
def _(t):
    return _ingested(t).quarantine


@query("src_labels_csv", "SELECT * FROM variables_en")
def _(t):
    folder = workspace(t.spark, "labels")
    datasets.write_csv(t.labels_raw, folder)
    return files.load_label_csv(t.spark, folder)


PAGES = """
SELECT (id // 100)::BIGINT AS page, row_number() OVER (PARTITION BY id // 100 ORDER BY id) - 1 AS position,
       id, subjectId, coalesce(n1, '') AS n1, coalesce(n2, '') AS n2, coalesce(n3, '') AS n3,
       coalesce(n4, '') AS n4, coalesce(n5, '') AS n5, measureUnitName
FROM labels_raw WHERE (id // 100) % 7 <> 3"""


def _landed(t) -> str:
    folder = workspace(t.spark, "pages")
    t.pages.write.json(folder)
    return folder


@query("src_paged_json", PAGES)
def _(t):
    return files.load_pages(t.spark, _landed(t))


@query("sort_pages", f"SELECT *, row_number() OVER (ORDER BY page, position) AS place FROM ({PAGES}) p")
def _(t):
    return placed(files.load_pages(t.spark, _landed(t)), files.PAGE_ORDER)


@query(
    "src_subject_names",
    """SELECT v.subjectId, coalesce(e.name_en, '') AS name_en
FROM (SELECT DISTINCT subjectId FROM variables) v LEFT JOIN subjects_en e USING (subjectId)""",
)
def _(t):
    ids, answers = workspace(t.spark, "ids"), workspace(t.spark, "answers")
    padded = t.variables.select("subjectId").distinct().select(
        F.explode(F.array(F.concat(F.lit("  "), "subjectId"), F.lit("")))
    )
    padded.write.text(ids)
    t.subjects_en.select(F.col("subjectId").alias("id"), F.col("name_en").alias("name")).write.json(answers)
    return files.load_subject_names(t.spark, ids, answers)


def _gaps(t):
    landed = files.landed_pages(t.spark, _landed(t))
    return landed, landed.agg(F.max("totalRecords")).first()[0]


GAPS = "SELECT unnest(range(0, (SELECT (max(id) + 100) // 100 FROM variables))) AS page"


@query("src_page_gaps", f"SELECT page FROM ({GAPS}) expected_pages WHERE page % 7 = 3")
def _(t):
    landed, total = _gaps(t)
    return files.page_gaps(landed, total)


@query(
    "join_missing_pages",
    f"""SELECT page FROM ({GAPS}) e
WHERE NOT EXISTS (SELECT 1 FROM labels_raw r WHERE r.id // 100 = e.page AND e.page % 7 <> 3)""",
)
def _(t):
    landed, total = _gaps(t)
    return files.page_gaps(landed, total)


@query(
    "src_page_report",
    f"""SELECT (SELECT count(*) FROM labels_raw WHERE (id // 100) % 7 <> 3) AS rows,
       (SELECT count(DISTINCT id // 100) FROM labels_raw WHERE (id // 100) % 7 <> 3) AS pages,
       (SELECT count(*) FROM ({GAPS}) e WHERE page % 7 = 3) AS missing""",
)
def _(t):
    landed, total = _gaps(t)
    return files.page_report(landed, total)


@query("src_fact_parquet", FACTS)
def _(t):
    folder = workspace(t.spark, "facts")
    layout.write_parquet(t.facts, folder)
    return scan.read_facts(t.spark, f"{folder}/*.parquet")


def _laid_out(t):
    """The whole store, laid out: facts are stored once, then planned and written in parts."""
    with exchanges_dropped(t.spark):
        return export_store(t.stored, workspace(t.spark, "store"))


@query(
    "src_pruned_scan",
    """SELECT f.* FROM facts f WHERE f.variable_id IN
(SELECT variable_id FROM codebook WHERE subject_parent_id = 'K2' AND measureUnitName = 'zł')""",
)
def _(t):
    store = lay_out(t.stored, workspace(t.spark, "store"))
    wanted = (F.col("subject_parent_id") == "K2") & (F.col("measureUnitName") == "zł")
    ids = store.codebook.where(wanted).select("variable_id")
    return scan.indexed_scan(store.facts, store.root, store.index, store.manifest, scan.settled_ids(ids))


@query(
    "src_catalog",
    """SELECT f.unitId, f.year, f.value, c.variable_full_name FROM facts_6 f JOIN codebook c USING (variable_id)
WHERE c.subject_name LIKE 'Ludność%' AND f.unitName LIKE 'Customer#%'
UNION ALL SELECT unitId, NULL, NULL, unitName FROM units WHERE unitLevel = 2""",
)
def _(t):
    _laid_out(t).register_views()
    return t.spark.sql(
        """SELECT f.unitId, f.year, f.value, c.variable_full_name
        FROM facts_gminy f JOIN codebook c USING (variable_id)
        WHERE c.subject_name LIKE 'Ludność%' AND f.unitName LIKE 'Customer#%'
        UNION ALL SELECT unitId, NULL, NULL, unitName FROM units WHERE unitLevel = 2"""
    )


@query("layout_equidepth", "SELECT * FROM ranges")
def _(t):
    return layout.equidepth_ranges(t.facts)


@query(
    "layout_write_parts",
    """SELECT f.*, r.part FROM facts f JOIN ranges r
ON f.unitLevel = r.unitLevel AND f.variable_id BETWEEN r.lo AND r.hi""",
)
def _(t):
    folder = workspace(t.spark, "parts")
    layout.write_parts(t.stored.facts, folder)
    return scan.read_parts(t.spark, folder)


@query(
    "layout_grown",
    """SELECT f.*, r.part FROM facts f JOIN ranges r
ON f.unitLevel = r.unitLevel AND f.variable_id BETWEEN r.lo AND r.hi""",
)
def _(t):
    """The facts before 1996 laid out first, and the others added."""
    early = F.col("year") < 1996
    first = lay_out(Store.of(t.stored.facts.where(early), t.variables, t.subjects), workspace(t.spark, "first"))
    return grown(first, t.stored.facts.where(~early), workspace(t.spark, "grown")).facts


@query(
    "layout_manifest",
    """SELECT CASE unitLevel WHEN 6 THEN 'facts_gminy' WHEN 5 THEN 'facts_powiaty' WHEN 4 THEN 'facts_podregiony'
            WHEN 2 THEN 'facts_wojewodztwa' ELSE 'facts_makroregiony' END AS tbl, unitLevel, part,
       'facts/unitLevel=' || unitLevel || '/part=' || part AS file, lo AS var_min, hi AS var_max, rows
FROM ranges""",
)
def _(t):
    folder = workspace(t.spark, "manifest")
    layout.manifest(layout.key_parts(layout.key_counts(t.facts))).write.json(folder)
    return scan.read_manifest(t.spark, folder)


@query("sink_metadata", "SELECT * FROM codebook")
def _(t):
    folder = workspace(t.spark, "codebook")
    layout.write_parquet(t.codebook, folder)
    return t.spark.read.parquet(folder)


@query("sink_labels_parquet", "SELECT * FROM variables_en")
def _(t):
    folder = workspace(t.spark, "labels")
    layout.write_parquet(t.variables_en, folder)
    return t.spark.read.parquet(folder)


@query("sink_dataset_csv", LONG)
def _(t):
    folder = workspace(t.spark, "dataset")
    data = dataset.long(t.facts, t.codebook)
    datasets.write_dataset(data, folder)
    return t.spark.read.schema(data.schema).options(**S.CSV).csv(folder)


@query("sink_per_level", LONG)
def _(t):
    folder = workspace(t.spark, "levels")
    data = dataset.long(t.facts, t.codebook)
    datasets.write_dataset(data, folder, per_level=True)
    return t.spark.read.schema(data.schema).options(**S.CSV).csv(folder)


@query(
    "sink_codebook_doc",
    f"SELECT * REPLACE (nullif(breakdown_pl, '') AS breakdown_pl, nullif(breakdown_en, '') AS breakdown_en) FROM ({DOC}) d",
)
def _(t):
    folder = workspace(t.spark, "doc")
    ids = t.bilingual.where(F.col("measureUnitName") == "zł")
    doc = dataset.codebook_doc(t.bilingual, ids)
    datasets.write_csv(doc, folder)
    return t.spark.read.schema(doc.schema).options(**S.CSV).csv(folder)


@query("proj_codebook_doc", DOC)
def _(t):
    ids = t.bilingual.where(F.col("measureUnitName") == "zł")
    return dataset.codebook_doc(t.bilingual, ids)


@query("proj_fact_cast", FACTS)
def _(t):
    return files.cast_facts(t.facts.select(*[F.col(f.name).cast("string") for f in S.FACT.fields]))


@query("build_store", "SELECT f.*, u.voivod_teryt, u.first_year, u.last_year FROM facts f JOIN units u USING (unitId, unitLevel)")
def _(t):
    store = build_store(t.spark, _extracts(t), t.variables, t.subjects, workspace(t.spark, "built"))
    spans = store.units.select("unitId", "unitLevel", "voivod_teryt", "first_year", "last_year")
    return dataset.with_units(store.facts, materialized(spans, "units"))


@query(
    "export_store",
    """SELECT f.*, c.variable_full_name FROM facts f JOIN codebook c USING (variable_id)""",
)
def _(t):
    store = _laid_out(t)
    labels = store.codebook.select("variable_id", "variable_full_name")
    # The names of millions of variables are a small file, but not a small table.
    return store.facts.drop("part").join(small_side(labels), "variable_id")


@query(
    "join_manifest",
    """SELECT r.unitLevel, r.part, c.variable_id FROM codebook c JOIN ranges r
ON c.variable_id BETWEEN r.lo AND r.hi WHERE c.measureUnitName = 'zł'""",
)
def _(t):
    parts = layout.manifest(layout.key_parts(layout.key_counts(t.facts)))
    return scan.locate(t.codebook.where(F.col("measureUnitName") == "zł"), parts)


@query("proj_voivod_code", "SELECT DISTINCT unitId, substr(unitId, 3, 2) AS voivod_teryt FROM facts")
def _(t):
    units = t.facts.select("unitId").distinct()
    return units.select("unitId", text.voivodeship(F.col("unitId")).alias("voivod_teryt"))


@query("agg_units", "SELECT * FROM units")
def _(t):
    return metadata.units(t.facts)
