"""Fact scans: plain, by file list, pruned by the manifest, and by the key index."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statbank import schema as S
from statbank.operators.filters import variables_in
from statbank.session import materialized, small_side
from statbank.sinks.layout import BLOCK, block_of

#: Ids that a request may hold as values; more of them stay a table.
MOST_VALUES = 2_000
#: Files that a scan names one by one; beyond, it prunes by parts.
MOST_FILES = 5_000

LAID_OUT = T.StructType([*S.FACT.fields, T.StructField("part", T.IntegerType())])


def read_facts(spark: SparkSession, *paths: str) -> DataFrame:
    """Facts from a file, several files or a glob, with declared types."""
    return spark.read.schema(S.FACT).parquet(*paths).select(*S.FACT.names)


def read_parts(spark: SparkSession, root: str) -> DataFrame:
    """The laid-out fact table: the fact columns plus the partition column `part`."""
    return spark.read.schema(LAID_OUT).parquet(root).select(*LAID_OUT.names)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.MANIFEST).json(path)


def locate(ids: DataFrame, manifest: DataFrame, block: int = BLOCK) -> DataFrame:
    """(unitLevel, part, variable_id) for ids inside a part's key range.

    A range join as an equi join on key blocks: each part lists the blocks it touches, an id
    meets only the parts of its own block, and the exact bounds decide.
    """
    low, high = block_of("var_min", block), block_of("var_max", block)
    covered = manifest.select(
        "unitLevel", "part", "var_min", "var_max", F.explode(F.sequence(low, high)).alias("block")
    )
    keyed = ids.select("variable_id", block_of("variable_id", block).alias("block"))
    return (
        keyed.join(covered, "block")
        .where(F.col("variable_id").between(F.col("var_min"), F.col("var_max")))
        .select("unitLevel", "part", "variable_id")
    )


Ids = tuple[int, ...] | DataFrame


def settled_ids(ids: DataFrame, most: int = MOST_VALUES) -> Ids:
    """The ids of a plan, computed once: up to `most` as values, more of them as a stored table."""
    few = ids.select("variable_id").limit(most + 1).collect()
    if len(few) <= most:
        return tuple(sorted({r.variable_id for r in few if r.variable_id is not None}))
    return materialized(ids.select("variable_id").distinct(), "ids")


def of_ids(frame: DataFrame, ids: Ids) -> DataFrame:
    """Rows of the ids."""
    if isinstance(ids, tuple):
        return frame.where(variables_in(ids))
    return frame.join(small_side(ids), "variable_id", "left_semi")


def indexed_scan(facts: DataFrame, root: str, index: DataFrame, manifest: DataFrame, ids: Ids, most: int = MOST_FILES) -> DataFrame:
    """Facts of the ids, read from the files that hold at least one of them; index and manifest may be cut to levels.

    The driver gets the names of these files, `most` of them at the most; beyond that the parts are pruned.
    """
    held = of_ids(index, ids).select("file").distinct().limit(most + 1).collect()
    if len(held) > most:
        return pruned_scan(facts, manifest, ids)
    if not held:
        return facts.where(F.lit(False)).select(*S.FACT.names)
    base = f"{root}/facts"
    found = facts.sparkSession.read.schema(LAID_OUT).option("basePath", base).parquet(*sorted(f"{base}/{r.file}" for r in held))
    return of_ids(found, ids).select(*S.FACT.names)


def pruned_scan(facts: DataFrame, manifest: DataFrame, ids: Ids) -> DataFrame:
    """Facts of the ids; the located parts prune partitions.

    Ids as values become literal filters. A table of ids is read twice, so it should be a stored one (`settled_ids`);
    the (level, part) pairs, at most one for each manifest entry, are broadcast and prune at run time, and the
    ids themselves join without a hint.
    """
    if isinstance(ids, tuple):
        return literal_scan(facts, manifest, ids).select(*S.FACT.names)
    located = locate(ids, manifest).groupBy("unitLevel", "part").agg(F.count("*").alias("n"))
    # The filter holds for every row; it tells the optimizer that the pairs are worth pruning by.
    parts = F.broadcast(located.where("n > 0").select("unitLevel", "part"))
    found = facts.join(parts, ["unitLevel", "part"], "left_semi")
    return found.join(ids.select("variable_id").distinct(), "variable_id", "left_semi").select(*S.FACT.names)


def literal_scan(facts: DataFrame, manifest: DataFrame | None, ids: Sequence[int]) -> DataFrame:
    """Facts of a short id list: the parts become literal partition filters by level, the ids reach
    the row-group statistics. No part is read if no part range holds an id."""
    wanted = facts.where(variables_in(ids))
    if manifest is None or not ids:
        return wanted
    within = F.exists(F.array(*[F.lit(int(i)) for i in ids]), lambda i: i.between(F.col("var_min"), F.col("var_max")))
    parts: dict[int, list[int]] = {}
    for r in manifest.where(within & F.col("unitLevel").isNotNull()).select("unitLevel", "part").distinct().collect():
        parts.setdefault(r.unitLevel, []).append(r.part)
    pairs = F.lit(False)
    for level, held in sorted(parts.items()):
        pairs = pairs | ((F.col("unitLevel") == level) & F.col("part").isin(*sorted(held)))
    return wanted.where(pairs)


def scan_ids(facts: DataFrame, manifest: DataFrame | None, ids: Ids) -> DataFrame:
    """Facts of the ids, of a laid-out table (with its manifest) or any other."""
    if isinstance(ids, tuple):
        return literal_scan(facts, manifest, ids)
    return of_ids(facts, ids) if manifest is None else pruned_scan(facts, manifest, ids)
