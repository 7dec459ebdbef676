"""Batches of substring searches on a stored text index: no text is read."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statbank.operators.match import asked_words
from statbank.session import BROADCAST_BYTES, materialized, plan_bytes, small_side
from statbank.sinks.text_index import GRAM, TextIndex, windows


def needle_grams(needles: DataFrame, grams: DataFrame) -> DataFrame:
    """(needle, gram): for each needle the grams under which every word that contains it is listed.

    That is the rarest of a long needle's grams, by the stored frequencies; a needle with a gram that no word has is
    left out. Of a short needle it is every gram that starts with it.
    """
    long = needles.where(F.char_length("needle") >= GRAM)
    parts = long.select("needle", F.explode(F.filter(windows(F.col("needle")), lambda g: F.char_length(g) == GRAM)).alias("gram"))
    known = parts.join(grams, "gram", "left").groupBy("needle")
    rarest = known.agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.count_if(F.col("n").isNull()).alias("missing"))
    rarest = rarest.where("missing = 0").select("needle", "gram")
    starts = F.explode(F.array(*[F.substring("gram", 1, n) for n in range(1, GRAM)])).alias("needle")
    short = needles.where(F.char_length("needle") < GRAM)
    return rarest.unionByName(grams.select(starts, "gram").distinct().join(short, "needle").select("needle", "gram"))


def needle_words(needles: DataFrame, index: TextIndex) -> DataFrame:
    """(needle, word, n): the index's words that contain each needle, with the number of rows that hold them.

    A word is compared with a needle only if it is listed under the needle's gram.
    """
    grams = materialized(needle_grams(needles, index.grams), "grams")
    listed = index.gram_words.join(small_side(grams), "gram")
    return listed.where(F.contains("word", F.col("needle"))).select("needle", "word", "n").distinct()


def _as_it_is(table: DataFrame) -> DataFrame:
    return table


def match_indexed(index: TextIndex, queries: DataFrame, stems: bool = True) -> DataFrame:
    """(qid, key) where every word of a query of that qid occurs in the row; each pair once.

    A query's candidates are the rows that hold its rarest word. Of its other words only the listed rows that are
    candidates are kept, and a row that is left for each word is a hit. Asked words and candidates are stored, so
    that their size decides the joins.
    """
    asked = materialized(asked_words(queries, stems), "queries")
    forms = asked.select("query", F.size("forms").alias("n_terms"), F.posexplode("forms").alias("pos", "any_form"))
    forms = forms.select("query", "n_terms", "pos", F.explode("any_form").alias("needle"))
    found = needle_words(forms.select("needle").distinct(), index)
    wanted = materialized(forms.join(found, "needle").select("query", "n_terms", "pos", "word", "n").distinct(), "words")
    costs = wanted.groupBy("query", "n_terms", "pos").agg(F.sum("n").alias("cost"))
    rarest = costs.groupBy("query", "n_terms").agg(F.count("*").alias("found"), F.min_by("pos", F.struct("cost", "pos")).alias("rarest"))
    rarest = rarest.where("found = n_terms").select("query", "rarest")
    # What is cut from a small table is small, whatever its estimate.
    small = F.broadcast if plan_bytes(wanted) <= BROADCAST_BYTES else _as_it_is
    wanted = wanted.join(small(rarest), "query")
    rows = wanted.where("pos = rarest").select("query", "word")
    candidates = materialized(index.postings.join(small(rows), "word").select("query", "row").distinct(), "candidates")
    others = wanted.where("pos <> rarest").select("query", "n_terms", "pos", "word")
    listed = index.postings.join(small(others), "word").join(small_side(candidates), ["query", "row"], "left_semi")
    every = listed.select("query", "n_terms", "pos", "row").distinct().groupBy("query", "row", "n_terms").agg(F.count("*").alias("held"))
    several = every.where("held = n_terms - 1").select("query", "row")
    single = asked.where(F.size("forms") == 1).select("query")
    hits = several.unionByName(candidates.join(small_side(single), "query", "left_semi"))
    keyed = hits.join(index.keys, "row").select("query", F.col("key").alias(index.key))
    names = queries.select("qid", "query").where(F.col("query").isNotNull()).distinct()
    return names.join(keyed, "query").select("qid", index.key).distinct()
