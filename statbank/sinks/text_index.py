"""A stored inverted index of texts: folded words with the rows that hold them, and grams with their words.

Built once, it answers batches of substring searches without a pass over the texts. A query word has no blank, so
it occurs in a text exactly if one of the text's words contains it; so words lead to rows, and grams to words.

Grams are a word's three-letter windows, one for each letter, cut short at the word's end. A needle of three
letters or more is looked up by its rarest window; a shorter one by all grams that start with it.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statbank.functions import text

GRAM = 3
BUCKETS = 32
POSTING = "word string, row bigint, bucket int"
TABLES = ("keys", "postings", "words", "gram_words", "grams")


@dataclass(frozen=True)
class TextIndex:
    """keys (row, key), postings (bucket, word, row), words (word, n), gram_words (gram, word, n), grams (gram, n)."""

    keys: DataFrame
    postings: DataFrame
    words: DataFrame
    gram_words: DataFrame
    grams: DataFrame
    key: str

    @staticmethod
    def open(spark: SparkSession, root: str, key: str) -> "TextIndex":
        # A table in buckets has no file if it has no row, so its schema is declared.
        read = {name: spark.read.schema(POSTING) if name == "postings" else spark.read for name in TABLES}
        return TextIndex(*[read[name].parquet(f"{root}/{name}") for name in TABLES], key=key)


def windows(c: Column) -> Column:
    """The different grams of a word."""
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(c), F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(c, i, F.lit(GRAM))))


def build_text_index(texts: DataFrame, key: str, columns: Sequence[str], root: str, folded: bool = True, buckets: int = BUCKETS) -> TextIndex:
    """Index the columns of rows that have a key; columns that are not `folded` yet are folded word by word.

    Rows are numbered, so rows that share a key are told apart. Postings are dealt out by bucket of the word, and a
    bucket that a common word fills is split.
    """
    spark = texts.sparkSession

    def written(df: DataFrame, name: str, *by: str) -> DataFrame:
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(*by) if by else writer).parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    found = text.words(F.concat_ws(" ", *[F.col(f"`{c}`") for c in columns]))
    if not folded:
        found = F.array_distinct(F.transform(found, text.fold))
    rows = texts.where(F.col(f"`{key}`").isNotNull()).select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"), found.alias("words"))
    rows = written(rows, "keys")
    postings = rows.select("row", F.explode("words").alias("word")).where(F.col("word") != "")
    postings = postings.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int"))
    # A rebalanced bucket is split where it is large.
    postings = written(postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "word", "row"), "postings", "bucket")
    words = written(postings.groupBy("word").agg(F.count("*").alias("n")), "words")
    gram_words = words.select(F.explode(windows(F.col("word"))).alias("gram"), "word", "n")
    gram_words = written(gram_words.repartition("gram").sortWithinPartitions("gram"), "gram_words")
    grams = written(gram_words.groupBy("gram").agg(F.count("*").alias("n")), "grams")
    return TextIndex(rows.select("row", "key"), postings.select("bucket", "word", "row"), words, gram_words, grams, key)
