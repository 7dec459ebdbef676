"""A store of facts and metadata: build it from raw extracts, lay it out, open it."""

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statbank import schema as S
from statbank.operators import metadata
from statbank.operators.search import SEARCH_KEYS, UNIT_KEY, unit_key
from statbank.session import materialized
from statbank.sinks.index import read_key_index, write_key_index
from statbank.sinks.layout import ROWS_PER_FILE, key_counts, manifest, merged_counts, write_parquet, write_parts
from statbank.sinks.series_table import read_series, write_series
from statbank.sinks.text_index import TextIndex, build_text_index
from statbank.sources import scan
from statbank.sources.files import load_raw_extracts


@dataclass(frozen=True)
class Store:
    """The tables queries run on.

    A laid-out store also has a root, a manifest, a key index, the stored forms of its two search tables and
    their text indexes. `with_series` adds a layout by series.
    """

    facts: DataFrame
    variables: DataFrame
    subjects: DataFrame
    codebook: DataFrame
    units: DataFrame
    subjects_en: DataFrame | None = None
    variables_en: DataFrame | None = None
    manifest: DataFrame | None = None
    search_codebook: DataFrame | None = None
    search_units: DataFrame | None = None
    root: str | None = None
    index: DataFrame | None = None
    codebook_words: TextIndex | None = None
    unit_words: TextIndex | None = None
    series: DataFrame | None = None

    @property
    def spark(self) -> SparkSession:
        return self.facts.sparkSession

    @property
    def bilingual(self) -> DataFrame:
        if self.search_codebook is not None:
            return self.search_codebook
        return metadata.bilingual_codebook(self.codebook, self.subjects_en, self.variables_en)

    @property
    def searchable_units(self) -> DataFrame:
        return metadata.unit_search_keys(self.units) if self.search_units is None else self.search_units

    @staticmethod
    def of(
        facts: DataFrame,
        variables: DataFrame,
        subjects: DataFrame,
        subjects_en: DataFrame | None = None,
        variables_en: DataFrame | None = None,
    ) -> "Store":
        """A store over frames that were not laid out."""
        # Stored, so that joins with the facts know its size.
        codebook = materialized(metadata.codebook(variables, subjects), "codebook")
        units = metadata.units(facts)
        return Store(facts, variables, subjects, codebook, units, subjects_en, variables_en)

    @staticmethod
    def open(spark: SparkSession, root: str, english: bool = True) -> "Store":
        """A store written by export_store; english=False if it was written without labels."""

        def table(name: str) -> DataFrame:
            return spark.read.parquet(f"{root}/{name}")

        return Store(
            facts=scan.read_parts(spark, f"{root}/facts"),
            variables=table("variables"),
            subjects=table("subjects"),
            codebook=table("codebook"),
            units=table("units"),
            subjects_en=table("subjects_en") if english else None,
            variables_en=table("variables_en") if english else None,
            manifest=scan.read_manifest(spark, f"{root}/manifest"),
            search_codebook=table("search_codebook"),
            search_units=table("search_units"),
            root=root,
            index=read_key_index(spark, root),
            codebook_words=TextIndex.open(spark, f"{root}/codebook_words", "variable_id"),
            unit_words=TextIndex.open(spark, f"{root}/unit_words", UNIT_KEY),
        )

    def register_views(self) -> None:
        """The tables under their SQL names, for use in spark.sql."""
        columns = S.FACT.names
        facts = self.facts.select(*columns)
        facts.createOrReplaceTempView("facts_all")
        for level, name in S.FACT_TABLES.items():
            facts.where(F.col("unitLevel") == level).createOrReplaceTempView(name)
        for name in ("codebook", "units", "variables", "subjects", "subjects_en", "variables_en"):
            frame = getattr(self, name)
            if frame is not None:
                frame.createOrReplaceTempView(name)


def build_store(
    spark: SparkSession,
    extracts: dict[str, str],
    variables: DataFrame,
    subjects: DataFrame,
    root: str,
    subjects_en: DataFrame | None = None,
    variables_en: DataFrame | None = None,
) -> Store:
    """Raw extracts to a typed fact table per level; each extract is parsed once."""
    path = f"{root}/facts"
    facts = load_raw_extracts(spark, extracts)
    facts.write.option("compression", "zstd").partitionBy("unitLevel").parquet(path)
    return Store.of(scan.read_facts(spark, path), variables, subjects, subjects_en, variables_en)


def lay_out(
    store: Store,
    root: str,
    parts: Mapping[int, int] | int = S.LEVEL_PARTS,
    rows_per_file: int = ROWS_PER_FILE,
    counts: DataFrame | None = None,
) -> Store:
    """Write the facts in equi-depth parts with their manifest, key counts and key index; the metadata stays as it is.

    `counts` are those of the facts' keys, if they are known.
    """
    placed = write_parts(store.facts, f"{root}/facts", parts, rows_per_file, counts)
    write_parquet(placed.select("unitLevel", "variable_id", "n"), f"{root}/key_counts")
    # One row per part.
    manifest(placed).coalesce(1).write.json(f"{root}/manifest")
    write_key_index(store.spark, root)
    facts = scan.read_parts(store.spark, f"{root}/facts")
    return replace(store, facts=facts, manifest=scan.read_manifest(store.spark, f"{root}/manifest"), root=root, index=read_key_index(store.spark, root))


def with_series(store: Store, root: str, dealt: bool = False) -> Store:
    """The store with its facts laid out by series as well, below `root`; `dealt` as for `series_rows`."""
    path = f"{root}/series"
    write_series(store.facts, path, dealt)
    return replace(store, series=read_series(store.spark, path))


def grown(
    store: Store,
    more: DataFrame,
    root: str,
    parts: Mapping[int, int] | int = S.LEVEL_PARTS,
    rows_per_file: int = ROWS_PER_FILE,
) -> Store:
    """A laid-out store's facts and `more` of them, laid out together below a new root.

    The stored key counts are merged with those of `more`, so the facts that were counted once are not counted
    again; the parts are those that a layout of all facts would have.
    """
    if store.root is None:
        raise ValueError("only a laid-out store can grow")
    held = store.spark.read.parquet(f"{store.root}/key_counts")
    more = more.select(*S.FACT.names)
    counts = merged_counts(held, key_counts(more))
    together = replace(store, facts=store.facts.select(*S.FACT.names).unionByName(more))
    return lay_out(together, root, parts, rows_per_file, counts)


def export_store(
    store: Store,
    root: str,
    parts: Mapping[int, int] | int = S.LEVEL_PARTS,
    rows_per_file: int = ROWS_PER_FILE,
) -> Store:
    """Write facts in equi-depth parts, the manifest and key index, the metadata, and the search tables with their indexes."""
    lay_out(store, root, parts, rows_per_file)
    english = store.subjects_en is not None and store.variables_en is not None
    names = ["codebook", "units", "variables", "subjects"]
    for name in names + (["subjects_en", "variables_en"] if english else []):
        write_parquet(getattr(store, name), f"{root}/{name}")
    stored = replace(store, **{name: store.spark.read.parquet(f"{root}/{name}") for name in ("codebook", "units")})
    write_parquet(stored.bilingual, f"{root}/search_codebook")
    write_parquet(stored.searchable_units, f"{root}/search_units")
    searched = {name: store.spark.read.parquet(f"{root}/{name}") for name in ("search_codebook", "search_units")}
    build_text_index(searched["search_codebook"], "variable_id", SEARCH_KEYS, f"{root}/codebook_words")
    units = searched["search_units"].withColumn(UNIT_KEY, unit_key())
    build_text_index(units, UNIT_KEY, ["search_key"], f"{root}/unit_words")
    return Store.open(store.spark, root, english)
