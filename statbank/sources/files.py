"""Typed readers: raw fact CSV, label CSV, landed JSON pages, subject names."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statbank import schema as S
from statbank.operators.metadata import english_labels


def cast_facts(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Text columns to fact types; overflow and bad text raise, or become NULL when lenient."""
    columns = []
    for field in S.FACT.fields:
        c = F.col(field.name)
        columns.append((c.try_cast(field.dataType) if lenient else c.cast(field.dataType)).alias(field.name))
    return raw.select(*columns)


def read_csv(spark: SparkSession, path: str, columns: T.StructType, lines: bool = False) -> DataFrame:
    """The named columns of a CSV file or folder, as text, wherever the header puts them.

    A missing column raises, and so does a file whose header differs from that of the folder's first
    file. With `lines` a quoted field may hold line breaks; such files are not split.
    """
    read = spark.read.options(**S.CSV)
    header = read.csv(path).columns
    missing = [c for c in columns.names if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    shape = T.StructType([T.StructField(c, T.StringType()) for c in header])
    typed = read.schema(shape).option("enforceSchema", False).option("mode", "FAILFAST").option("multiLine", lines)
    return typed.csv(path).select(*[F.col(f"`{c}`") for c in columns.names])


def load_fact_csv(spark: SparkSession, path: str, level: int) -> DataFrame:
    """One raw extract. Ids stay text, malformed rows fail, and so does a row of another level."""
    raw = cast_facts(read_csv(spark, path, S.FACT))
    message = F.concat(F.lit(f"expected level {level}, found "), F.col("unitLevel").cast("string"))
    checked = F.when(F.col("unitLevel") == level, F.col("unitLevel")).otherwise(
        F.raise_error(message).cast(T.ByteType())
    )
    return raw.withColumn("unitLevel", checked)


def load_raw_extracts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All extracts by endpoint name; the names do not say which level a file holds."""
    out = None
    for endpoint, path in paths.items():
        facts = load_fact_csv(spark, path, S.RAW_FILE_LEVELS[endpoint])
        out = facts if out is None else out.unionByName(facts)
    return out


def load_label_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = read_csv(spark, path, S.LABELS_RAW, lines=True)
    return english_labels(raw.select(*[F.col(f.name).cast(f.dataType) for f in S.LABELS_RAW.fields]))


def _pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages, one copy of each: the one with the most records."""
    pages = spark.read.schema(S.PAGE).option("mode", "FAILFAST").json(path)
    best = F.max(F.struct(F.size("results").alias("n"), "totalRecords", "results")).alias("p")
    return pages.groupBy("page").agg(best).select("page", "p.totalRecords", "p.results")


def load_pages(spark: SparkSession, path: str) -> DataFrame:
    """Records of landed metadata pages with their page and position; absent fields become ''."""
    pages = _pages(spark, path)
    records = pages.select("page", F.posexplode("results").alias("position", "record"))
    texts = [
        F.coalesce(F.col(f"record.{f.name}"), F.lit("")).alias(f.name)
        for f in S.LABELS_RAW.fields
        if f.name != "id"
    ]
    return records.select("page", "position", "record.id", *texts)


#: The order in which records were fetched.
PAGE_ORDER = ("page", "position")


def in_page_order(records: DataFrame) -> DataFrame:
    return records.orderBy(*PAGE_ORDER)


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    pages = spark.read.schema(S.PAGE).option("mode", "FAILFAST").json(path)
    return pages.select("page", "totalRecords", F.size("results").alias("n_records"))


def page_gaps(landed: DataFrame, total: int, size: int = S.PAGE_SIZE) -> DataFrame:
    """Expected pages that never landed."""
    expected = landed.sparkSession.range(-(-total // size)).select(F.col("id").cast("int").alias("page"))
    return expected.join(landed.select("page"), "page", "left_anti")


def page_report(landed: DataFrame, total: int, size: int = S.PAGE_SIZE) -> DataFrame:
    """Fetched rows, fetched pages and missing pages in one row."""
    expected = -(-total // size)
    got = landed.where(F.col("page").between(0, expected - 1)).groupBy("page").agg(
        F.max("n_records").alias("n_records")
    )
    return got.agg(
        F.coalesce(F.sum("n_records"), F.lit(0)).alias("rows"),
        F.count("*").alias("pages"),
        (F.lit(expected) - F.count("*")).alias("missing"),
    )


def load_subject_names(spark: SparkSession, id_list: str, responses: str) -> DataFrame:
    ids = spark.read.text(id_list).select(F.trim("value", F.lit(" \t\r\n")).alias("subjectId"))
    answers = spark.read.schema(S.SUBJECT_RESPONSE).option("mode", "FAILFAST").json(responses)
    return subject_names(ids.where(F.col("subjectId") != ""), answers)


def subject_names(ids: DataFrame, responses: DataFrame) -> DataFrame:
    """English name per requested subject, '' where no answer carries one."""
    names = responses.groupBy(F.col("id").alias("subjectId")).agg(F.max("name").alias("name"))
    return ids.join(names, "subjectId", "left").select(
        "subjectId", F.coalesce("name", F.lit("")).alias("name_en")
    )
