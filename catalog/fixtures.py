"""The regional-statistics tables derived from the given test tables (see FIXTURES.md)."""

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statbank import schema as S
from statbank.operators import metadata
from statbank.plans.store import Store
from statbank.session import materialized, plan_bytes, small_side

# Metadata derivations in the SQL that Spark and the oracle engine share; {name} is a table.
VARIABLES_SQL = """
SELECT CAST(p_partkey AS int) AS id, 'P' || lpad(replace(p_brand, 'Brand#', ''), 4, '0') AS subjectId,
       CASE p_type WHEN 'STANDARD' THEN 'ogółem' ELSE lower(p_type) END AS n1,
       CASE WHEN p_partkey % 5 = 0 THEN 'NA' WHEN p_partkey % 7 = 0 THEN NULL
            WHEN p_partkey % 3 = 0 THEN 'ogółem' ELSE split_part(p_name, ' ', 1) END AS n2,
       CASE WHEN p_partkey % 2 = 0 THEN NULL WHEN p_partkey % 9 = 0 THEN 'ogółem'
            ELSE split_part(p_name, ' ', 2) END AS n3,
       CASE WHEN p_size > 40 THEN 'NA' WHEN p_size > 25 THEN 'duże' ELSE NULL END AS n4,
       CAST(NULL AS string) AS n5,
       CAST(CASE p_size % 5 WHEN 0 THEN 6 WHEN 1 THEN 5 WHEN 2 THEN 4 WHEN 3 THEN 2 ELSE 1 END AS tinyint) AS level,
       CAST(p_size % 3 AS int) AS measureUnitId,
       CASE p_size % 3 WHEN 0 THEN 'szt.' WHEN 1 THEN 'zł' ELSE '-' END AS measureUnitName
FROM {part}"""

SUBJECTS_SQL = """
SELECT 'P' || lpad(CAST(b AS string), 4, '0') AS id, 'K' || CAST(b % 5 + 1 AS string) AS parentId,
       CASE b % 4 WHEN 0 THEN 'Ludność ' || CAST(b AS string) || ' wg typu i koloru'
                  WHEN 1 THEN 'Bezrobotni zarejestrowani ' || CAST(b AS string) || ' wg typu, koloru i rodzaju'
                  WHEN 2 THEN 'Mieszkania ' || CAST(b AS string)
                  ELSE 'Źródła dochodów gmin ' || CAST(b AS string) || ' według koloru' END AS name,
       CAST(NULL AS string) AS description
FROM (SELECT DISTINCT CAST(replace(p_brand, 'Brand#', '') AS int) AS b FROM {part}) x WHERE b % 13 <> 12
UNION ALL
SELECT id, CAST(NULL AS string) AS parentId, name, CAST(NULL AS string) AS description
FROM (VALUES ('K1', 'Ludność'), ('K2', 'Rynek pracy'), ('K3', 'Źródła dochodów'),
             ('K4', 'Mieszkania'), ('K5', 'Dla gmin')) k(id, name)"""

LABELS_SQL = """
SELECT id, subjectId, CASE WHEN n1 = 'ogółem' THEN 'total' ELSE n1 END AS n1,
       CASE WHEN n2 = 'ogółem' THEN 'total' WHEN n2 IS NULL THEN '' ELSE n2 END AS n2,
       CASE WHEN n3 = 'ogółem' THEN 'total' ELSE n3 END AS n3,
       CASE WHEN n4 = 'duże' THEN 'large' ELSE n4 END AS n4, '' AS n5,
       CASE measureUnitName WHEN 'szt.' THEN 'pcs' WHEN 'zł' THEN 'PLN' ELSE '-' END AS measureUnitName
FROM {variables} WHERE id % 10 <> 9"""

SUBJECTS_EN_SQL = """
SELECT 'P' || lpad(CAST(b AS string), 4, '0') AS subjectId,
       CASE b % 4 WHEN 0 THEN 'Population ' || CAST(b AS string) || ' by type and colour'
                  WHEN 1 THEN 'Registered unemployed ' || CAST(b AS string) || ' by type, colour and kind'
                  WHEN 2 THEN 'Dwellings ' || CAST(b AS string)
                  ELSE 'Sources of municipal revenue ' || CAST(b AS string) || ' by colour' END AS name_en
FROM (SELECT DISTINCT CAST(replace(p_brand, 'Brand#', '') AS int) AS b FROM {part}) x WHERE b % 6 <> 5"""

#: Bytes of stored sales that one task turns into facts: each sale becomes a row for every level, in memory.
SALES_BYTES = 4 * 1024 * 1024


def _padded(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


class Tables:
    """Lazy frames over one data folder; nothing is computed before an action."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _located(self, buyers: DataFrame) -> DataFrame:
        """Rows with a customer's columns, and the pieces of the customer's territorial code beside them."""
        places = (
            buyers.join(small_side(self.source("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(small_side(self.source("region")), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        segment = F.col("c_mktsegment")
        digit = (
            F.when(segment == "AUTOMOBILE", "1").when(segment == "BUILDING", "2")
            .when(segment == "FURNITURE", "3").when(segment == "HOUSEHOLD", "4").otherwise("5")
        )
        return places.withColumns(
            {
                "r2": _padded(F.col("r_regionkey"), 2),
                "n2": _padded(F.col("n_nationkey"), 2),
                "s1": digit,
                "b1": (F.col("c_custkey") % 4).cast("string"),
                "c6": _padded(F.col("c_custkey"), 6),
            }
        )

    @cached_property
    def geo(self) -> DataFrame:
        """Customers with the pieces of their territorial code."""
        return self._located(self.source("customer")).select(
            "c_custkey", "r2", "n2", "s1", "b1", "c6", "r_name", "n_name", "c_mktsegment", "c_name"
        )

    @cached_property
    def sales(self) -> DataFrame:
        """Quantities by variable, year and place: the input of every level's aggregation.

        Orders meet their customers before their lines, and the sales are dealt out by variable while they are
        narrow: the levels, their aggregation and a join by variable then follow without another exchange.
        """
        customers = self.source("customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_name")
        orders = self.source("orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("smallint").alias("year"))
        lines = self.source("lineitem")
        sold = (
            lines.join(orders.join(customers, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
            .withColumn("variable_id", F.col("l_partkey").cast("int"))
            .select("variable_id", "year", "l_quantity", "l_linenumber", *customers.columns)
        )
        tasks = max(self.spark.sparkContext.defaultParallelism, 1 + plan_bytes(lines) // SALES_BYTES)
        return self._located(sold.repartition(tasks, "variable_id"))

    def facts_at(self, levels: Sequence[int]) -> DataFrame:
        """Fact rows of the given levels: each sale counts once per level, one aggregation."""
        c = F.col
        words = lambda *parts: F.concat_ws(" ", *[c(p) for p in parts])
        code = lambda *parts: F.rpad(F.concat(*[c(p) for p in parts]), 12, "0")
        units = {
            1: (code("r2"), c("r_name")),
            2: (code("r2", "n2"), c("n_name")),
            4: (code("r2", "n2", "s1"), words("n_name", "c_mktsegment")),
            5: (code("r2", "n2", "s1", "b1"), words("n_name", "c_mktsegment", "b1")),
            6: (code("r2", "n2", "s1", "b1", "c6"), c("c_name")),
        }
        options = [
            F.struct(F.lit(n).cast("tinyint").alias("unitLevel"), units[n][0].alias("unitId"), units[n][1].alias("unitName"))
            for n in levels
        ]
        per_level = self.sales.select(
            "variable_id", "year", "l_quantity", "l_linenumber", F.explode(F.array(*options)).alias("u")
        ).select("variable_id", "year", "l_quantity", "l_linenumber", "u.*")
        # A unit code fixes its name, so the name is a key and every buffer stays numeric.
        merged = per_level.groupBy("variable_id", "unitLevel", "unitId", "unitName", "year").agg(
            F.sum("l_quantity").alias("quantity"), F.min("l_linenumber").alias("line")
        )
        gap = (F.col("variable_id") + F.col("year")) % 11 == 0
        value, attr = F.when(~gap, F.col("quantity")), F.col("line").cast("tinyint")
        return merged.withColumns({"value": value, "attr_id": attr}).select(*S.FACT.names)

    @cached_property
    def facts(self) -> DataFrame:
        return self.facts_at(S.LEVELS)

    @cached_property
    def variables(self) -> DataFrame:
        return self.spark.sql(VARIABLES_SQL, part=self.source("part")).to(S.VARIABLES)

    @cached_property
    def subjects(self) -> DataFrame:
        return self.spark.sql(SUBJECTS_SQL, part=self.source("part")).to(S.SUBJECTS)

    @cached_property
    def labels_raw(self) -> DataFrame:
        return self.spark.sql(LABELS_SQL, variables=self.variables).to(S.LABELS_RAW)

    @cached_property
    def subjects_en(self) -> DataFrame:
        return self.spark.sql(SUBJECTS_EN_SQL, part=self.source("part")).to(S.SUBJECTS_EN)

    @cached_property
    def variables_en(self) -> DataFrame:
        return metadata.english_labels(self.labels_raw)

    @cached_property
    def codebook(self) -> DataFrame:
        return metadata.codebook(self.variables, self.subjects)

    @cached_property
    def bilingual(self) -> DataFrame:
        return metadata.bilingual_codebook(self.codebook, self.subjects_en, self.variables_en)

    @cached_property
    def units(self) -> DataFrame:
        return metadata.units(self.facts)

    @cached_property
    def searchable_units(self) -> DataFrame:
        return metadata.unit_search_keys(self.units)

    @cached_property
    def store(self) -> Store:
        return Store.of(self.facts, self.variables, self.subjects, self.subjects_en, self.variables_en)

    @cached_property
    def stored(self) -> Store:
        """The store with its facts written once, as build_store leaves them.

        They are sorted inside the tasks that make them: neighbours are then alike, in the files and when a layout
        exchanges them.
        """
        facts = materialized(self.facts.sortWithinPartitions("unitLevel", "variable_id", "unitId", "year"), "facts")
        return Store.of(facts, self.variables, self.subjects, self.subjects_en, self.variables_en)

    @cached_property
    def pages(self) -> DataFrame:
        """Landed metadata pages of 100 ids each; every seventh page never arrived."""
        record = F.struct(*[F.col(f.name) for f in S.LABELS_RAW.fields])
        by_page = self.labels_raw.withColumn("page", F.floor(F.col("id") / S.PAGE_SIZE).cast("int"))
        total = self.variables.agg(F.max("id") + 1).first()[0]
        return (
            by_page.where(F.col("page") % 7 != 3)
            .groupBy("page")
            .agg(F.array_sort(F.collect_list(record)).alias("results"))
            .select("page", F.lit(total).cast("long").alias("totalRecords"), "results")
        )
