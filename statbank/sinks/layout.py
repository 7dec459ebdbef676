"""Equi-depth range parts: planning, writing and the manifest."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statbank import schema as S
from statbank.functions import text
from statbank.session import workspace

BLOCK = 4096
ROWS_PER_FILE = 20_000_000
#: Rows that one task sorts and writes; so many fit its memory. A part of more rows has several files.
ROWS_PER_TASK = 2_000_000


def block_of(key: str, block: int = BLOCK) -> Column:
    """Never NULL, so joins on it infer no filter and both users of the counts share a stage."""
    return F.coalesce(F.expr(f"{key} DIV {block}"), F.lit(-1))


def key_counts(facts: DataFrame) -> DataFrame:
    return facts.groupBy("unitLevel", "variable_id").agg(F.count("*").alias("n"))


def key_bounds(facts: DataFrame) -> DataFrame:
    """Smallest and largest variable of each fact table."""
    tagged = facts.withColumn("tbl", text.fact_table_name(F.col("unitLevel")))
    return tagged.groupBy("tbl").agg(
        F.min("variable_id").alias("var_min"), F.max("variable_id").alias("var_max")
    )


def prefix_sum(counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows before each key (`before`) and per level (`total`), without a one-task window.

    Keys are cut into blocks of `block` consecutive ids. Only the block sums run through a
    window per level; inside a block the window sees at most `block` keys.
    """
    blocked = counts.withColumn("block", block_of("variable_id", block))
    sums = blocked.groupBy("unitLevel", "block").agg(F.sum("n").alias("block_rows"))
    by_level = Window.partitionBy("unitLevel")
    before = by_level.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "unitLevel",
        "block",
        F.coalesce(F.sum("block_rows").over(before), F.lit(0)).alias("offset"),
        F.sum("block_rows").over(by_level).alias("total"),
    )
    inside = Window.partitionBy("unitLevel", "block").orderBy("variable_id")
    running = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = blocked.withColumn("local", F.coalesce(F.sum("n").over(running), F.lit(0)))
    offsets = offsets.select(F.col("unitLevel").alias("_level"), F.col("block").alias("_block"), "offset", "total")
    same = F.col("unitLevel").eqNullSafe(F.col("_level")) & (F.col("block") == F.col("_block"))
    return local.join(offsets, same).select(
        "unitLevel", "variable_id", "n", (F.col("offset") + F.col("local")).alias("before"), "total"
    )


def bucket(n_parts: Column, before: Column, total: Column) -> Column:
    """Part of a key: its share of the rows before it, scaled to the number of parts."""
    return F.least(n_parts - 1, F.floor(n_parts * before / total)).cast("int")


def _parts_of(level: Column, parts: Mapping[int, int] | int) -> Column:
    if isinstance(parts, int):
        return F.lit(parts)
    chain = None
    for code, n in parts.items():
        chain = F.when(level == code, n) if chain is None else chain.when(level == code, n)
    return chain.otherwise(1)


def merged_counts(*counts: DataFrame) -> DataFrame:
    """Rows of each key in all the tables that were counted."""
    return reduce(DataFrame.unionByName, counts).groupBy("unitLevel", "variable_id").agg(F.sum("n").alias("n"))


def key_parts(
    counts: DataFrame, parts: Mapping[int, int] | int = S.LEVEL_PARTS, rows_per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """Placement of each key by the counts of all keys: its part, the slice of the part that one task writes, and the
    number of files a single oversized key is spread over."""
    # The given number of parts is a minimum: beyond a file's rows in each, parts grow with the table.
    n_parts = F.greatest(_parts_of(F.col("unitLevel"), parts), F.ceil(F.col("total") / rows_per_file))
    most = min(rows_per_file, ROWS_PER_TASK)
    return prefix_sum(counts).select(
        "unitLevel",
        "variable_id",
        "n",
        bucket(n_parts, F.col("before"), F.col("total")).alias("part"),
        F.floor(F.col("before") / ROWS_PER_TASK).cast("int").alias("slice"),
        F.ceil(F.col("n") / most).cast("int").alias("spread"),
    )


def ranges_of(placed: DataFrame, *finer: str) -> DataFrame:
    return placed.groupBy("unitLevel", "part", *finer).agg(
        F.min("variable_id").alias("lo"), F.max("variable_id").alias("hi"), F.sum("n").alias("rows")
    )


def equidepth_ranges(facts: DataFrame, parts: Mapping[int, int] | int = S.LEVEL_PARTS) -> DataFrame:
    """Contiguous key ranges with about equally many rows, per level."""
    return ranges_of(key_parts(key_counts(facts), parts))


def manifest(placed: DataFrame) -> DataFrame:
    """(tbl, unitLevel, part, file, var_min, var_max, rows) of every part."""
    level, part = F.col("unitLevel").cast("string"), F.col("part").cast("string")
    folder = F.concat(F.lit("facts/unitLevel="), level, F.lit("/part="), part)
    return ranges_of(placed).select(
        text.fact_table_name(F.col("unitLevel")).alias("tbl"),
        "unitLevel",
        "part",
        folder.alias("file"),
        F.col("lo").alias("var_min"),
        F.col("hi").alias("var_max"),
        "rows",
    )


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.option("compression", "zstd").parquet(path)


def write_parts(
    facts: DataFrame,
    path: str,
    parts: Mapping[int, int] | int = S.LEVEL_PARTS,
    rows_per_file: int = ROWS_PER_FILE,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Write facts as unitLevel/part folders of sorted zstd files; returns the key placement with its counts.

    Parts are cut into slices of about ROWS_PER_TASK rows, which are ranges of keys too. Slices are numbered, and a
    number is a task, so no two of them share one by accident and a task sorts in memory. The rows of a key that
    alone exceeds a task are spread by unit and year over several numbers, so a hot key never ends up in one
    task. Files are sorted by key, which lets the reader skip row groups. `facts` should be a stored table: it is
    counted first, unless the `counts` of its keys are given, and written next.
    """
    spark = facts.sparkSession
    facts = facts.select(*S.FACT.names)  # those of a laid-out table have a part already
    index = workspace(spark, "keys")
    write_parquet(key_parts(key_counts(facts) if counts is None else counts, parts, rows_per_file), index)
    placed = spark.read.parquet(index)
    files = placed.groupBy("unitLevel", "part", "slice").agg(F.max("spread").alias("files"))
    # Numbers go on from slice to slice inside a level, and from level to level: the levels are few.
    levels = files.groupBy("unitLevel").agg(F.sum("files").alias("files"))
    n_tasks = levels.agg(F.sum("files")).first()[0] or 1
    of_levels = Window.orderBy("unitLevel").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("unitLevel").orderBy("part", "slice").rowsBetween(Window.unboundedPreceding, -1)
    levels = levels.select(F.col("unitLevel").alias("_of"), F.coalesce(F.sum("files").over(of_levels), F.lit(0)).alias("_offset"))
    numbered = files.join(F.broadcast(levels), F.col("unitLevel").eqNullSafe(F.col("_of"))).select(
        F.col("unitLevel").alias("_unitLevel"), F.col("part").alias("_part"), F.col("slice").alias("_slice"),
        (F.col("_offset") + F.coalesce(F.sum("files").over(inside), F.lit(0))).alias("first_task"),
    )
    # Slices are ranges of keys, so the rows find them by the blocks of keys that a slice touches: both tables below stay
    # small for any number of keys. A NULL level is a level like any other; NULL keys and those of several files are few.
    of_part = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("unitLevel", "part", "slice")]
    bounds = ranges_of(placed.where("variable_id IS NOT NULL"), "slice").join(F.broadcast(numbered), of_part)
    touched = F.explode(F.sequence(block_of("lo"), block_of("hi"))).alias("_block")
    covered = bounds.select(F.col("unitLevel").alias("_level"), touched, "lo", "hi", "part", "first_task")
    alone = placed.where("variable_id IS NULL OR spread > 1").join(F.broadcast(numbered), of_part).select(
        F.col("unitLevel").alias("_of"), F.col("variable_id").alias("_id"), F.col("part").alias("_own"), F.col("first_task").alias("_first"), "spread"
    )
    level = F.col("unitLevel").eqNullSafe(F.col("_level"))
    inside = level & (block_of("variable_id") == F.col("_block")) & F.col("variable_id").between(F.col("lo"), F.col("hi"))
    same = F.col("unitLevel").eqNullSafe(F.col("_of")) & F.col("variable_id").eqNullSafe(F.col("_id"))
    found = facts.join(F.broadcast(covered), inside, "left").join(F.broadcast(alone), same, "left")
    tagged = found.select(
        *S.FACT.names, F.coalesce("_own", "part").alias("part"), F.coalesce("_first", "first_task").alias("first_task"),
        F.coalesce("spread", F.lit(1)).alias("spread"),
    )
    salt = F.pmod(F.xxhash64("unitId", "year"), F.col("spread"))
    spread = tagged.repartitionById(n_tasks, (F.col("first_task") + salt).cast("int"))
    ordered = spread.sortWithinPartitions("unitLevel", "part", "variable_id", "unitId", "year")
    (
        ordered.select(*S.FACT.names, "part")
        .write.option("compression", "zstd")
        .option("parquet.block.row.count.limit", S.ROW_GROUP_ROWS)
        .option("maxRecordsPerFile", 2 * rows_per_file)
        .partitionBy("unitLevel", "part")
        .parquet(path)
    )
    return placed
