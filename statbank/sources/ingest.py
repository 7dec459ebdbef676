"""Two-way ingest of raw fact extracts: typed rows, and a quarantine of lines with the reason."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statbank import schema as S

#: The columns that a fact cannot do without.
NEEDED = ("variable_id", "unitId", "unitLevel", "year")
QUARANTINE = T.StructType([T.StructField(c, T.StringType()) for c in ("endpoint", "reason", "line")])


@dataclass(frozen=True)
class Ingested:
    """facts, quarantine (endpoint, reason, line), and how many lines of each endpoint went which way."""

    facts: DataFrame
    quarantine: DataFrame
    counts: dict[str, dict[str, int]]


def _reason(raw: Column, typed: Column, cells: Column, level: int, header: list[str]) -> Column:
    """Why a line is refused, NULL for a good one; the first fault counts."""
    found = F.when(F.size(cells) != len(header), F.lit("cells"))
    for c in S.FACT.names:
        found = found.when(raw[c].isNotNull() & typed[c].isNull(), F.lit(f"type of {c}"))
    for c in NEEDED:
        found = found.when(typed[c].isNull(), F.lit(f"no {c}"))
    return found.when(typed["unitLevel"] != level, F.lit("level"))


def checked_lines(spark: SparkSession, endpoint: str, path: str) -> DataFrame:
    """(endpoint, level, fact, reason, line) of every line of an extract but its headers.

    Columns are found by the first file's header; a file with another header has it in the quarantine. A quoted cell
    may hold commas and doubled quotes, but no line break.
    """
    level = S.RAW_FILE_LEVELS[endpoint]
    header = spark.read.options(**S.CSV).csv(path).columns
    missing = [c for c in S.FACT.names if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    lines = spark.read.text(path).select(F.col("value").alias("line")).where((F.col("line") != "") & (F.col("line") != ",".join(header)))
    # One cell more than the header has shows lines that are too long; cells without text are NULL.
    cells = [f"c{i}" for i in range(len(header) + 1)]
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in S.CSV.items() if k != "header"}
    parsed = F.from_csv("line", ", ".join(f"{c} STRING" for c in cells), options | {"mode": "PERMISSIVE"})
    raw = F.struct(*[F.col("cells")[f"c{header.index(c)}"].alias(c) for c in S.FACT.names])
    typed = F.struct(*[F.col("raw")[f.name].try_cast(f.dataType).alias(f.name) for f in S.FACT.fields])
    # The number of cells, by the commas outside quotes.
    plain = F.regexp_replace("line", r'"(?:[^"]|"")*"', "")
    n_cells = F.split(plain, ",", -1)
    rows = lines.withColumn("cells", parsed).withColumn("raw", raw).withColumn("fact", typed)
    reason = _reason(F.col("raw"), F.col("fact"), n_cells, level, header)
    return rows.select(F.lit(endpoint).alias("endpoint"), F.lit(level).alias("level"), "fact", reason.alias("reason"), "line")


def ingest_extracts(spark: SparkSession, extracts: dict[str, str], root: str) -> Ingested:
    """Raw extracts to `root`: facts by level below good=true, refused lines below good=false.

    Each line is parsed once and written once, either way; the counts are observed in that pass.
    """
    lines = None
    for endpoint, path in extracts.items():
        own = checked_lines(spark, endpoint, path)
        lines = own if lines is None else lines.unionByName(own)
    good = F.col("reason").isNull()
    seen = Observation("ingest")
    counts = [
        F.count_if((F.col("endpoint") == endpoint) & test).alias(f"{endpoint}/{way}")
        for endpoint in extracts
        for way, test in (("lines", F.lit(True)), ("good", good), ("bad", ~good))
    ]
    observed = lines.observe(seen, *counts)
    kept = [F.when(good, F.col("fact")[c]).alias(c) for c in S.FACT.names if c != "unitLevel"]
    refused = [F.when(~good, F.col(c)).alias(c) for c in QUARANTINE.names]
    level = F.when(good, F.col("level").cast("tinyint")).alias("unitLevel")
    observed.select(*kept, *refused, good.alias("good"), level).write.option("compression", "zstd").partitionBy("good", "unitLevel").parquet(root)
    whole = T.StructType([*S.FACT.fields, *QUARANTINE.fields, T.StructField("good", T.BooleanType())])
    stored = spark.read.schema(whole).parquet(root)
    tally: dict[str, dict[str, int]] = {}
    for key, n in seen.get.items():
        endpoint, way = key.rsplit("/", 1)
        tally.setdefault(endpoint, {})[way] = n
    return Ingested(stored.where("good").select(*S.FACT.names), stored.where("NOT good").select(*QUARANTINE.names), tally)
