"""Batch substring search as hash joins.

A query word has no white space, so it occurs in a text exactly if it occurs in one of the
text's words. Words are reduced to a distinct vocabulary, needles and vocabulary meet on a
short character gram (an equi join), and the few candidates are verified with contains().
No text is compared with all queries, and no text is shuffled: only its distinct words are.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statbank.functions import text
from statbank.operators.filters import long_enough
from statbank.session import materialized, small_side

GRAM = 3


def _gram_set(c: Column) -> Column:
    """All character grams of length 1..GRAM, without repeats."""
    chars = F.split(c, "")
    grams = F.transform(
        chars,
        lambda ch, i: F.array(
            ch,
            F.concat(ch, F.get(chars, i + 1)),
            F.concat(ch, F.get(chars, i + 1), F.get(chars, i + 2)),
        ),
    )
    return F.array_distinct(F.array_compact(F.flatten(grams)))


def _first_gram(c: Column) -> Column:
    return F.array_join(F.slice(F.split(c, ""), 1, GRAM), "")


def substring_pairs(needles: DataFrame, haystacks: DataFrame) -> DataFrame:
    """Rows of both sides joined where the column `haystack` contains the column `needle`, which is not empty.

    A needle has one gram and a haystack has each of its grams once, so a pair comes up once.
    """
    left = needles.select("*", _first_gram(F.col("needle")).alias("gram"))
    right = haystacks.select("*", F.explode(_gram_set(F.col("haystack"))).alias("gram"))
    # Most grams of the texts are no query's: they go before anything is joined.
    right = right.join(left.select("gram").distinct(), "gram", "left_semi")
    return (
        right.join(left, "gram")
        .where(F.contains(F.col("haystack"), F.col("needle")))
        .drop("gram")
    )


def asked_words(queries: DataFrame, stems: bool = True) -> DataFrame:
    """(query, forms): the forms of each word of each different usable query text."""
    asked = queries.select("query").where(long_enough(F.col("query"))).distinct()
    asked = asked.withColumn("terms", text.terms(F.col("query"))).where(F.size("terms") > 0)
    forms = F.transform("terms", text.term_variants if stems else lambda t: F.array(t))
    return asked.select("query", F.array_distinct(forms).alias("forms"))


def rarest_words(asked: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(query, word): the text words that match a query's rarest term, for queries whose terms all occur.

    vocabulary: (word, haystack, n), with the number of rows that hold each word.
    """
    forms = asked.select("query", F.size("forms").alias("n_terms"), F.posexplode("forms").alias("pos", "any_form"))
    forms = forms.select("query", "n_terms", "pos", F.explode("any_form").alias("needle"))
    pairs = substring_pairs(forms.select("needle").distinct(), vocabulary).select("needle", "word", "n")
    wanted = forms.join(pairs, "needle").select("query", "n_terms", "pos", "word", "n").distinct()
    costs = wanted.groupBy("query", "n_terms", "pos").agg(F.sum("n").alias("cost"))
    cheapest = costs.groupBy("query", "n_terms").agg(F.count("*").alias("found"), F.min_by("pos", F.struct("cost", "pos")).alias("pos"))
    cheapest = cheapest.where("found = n_terms").select("query", "pos")
    return wanted.join(cheapest, ["query", "pos"]).select("query", "word").distinct()


def candidates(words: DataFrame, rare: DataFrame, key: str) -> DataFrame:
    """(query, key) of rows that hold a word of the query's rarest term."""
    return words.join(rare, "word").select("query", key).distinct()


def match_terms(
    texts: DataFrame,
    queries: DataFrame,
    key: str,
    columns: list[str],
    stems: bool = True,
    staged: bool = False,
    folded: bool = True,
) -> DataFrame:
    """(qid, key) where every word of a query of that qid occurs in some column of the row; each pair once.

    Rows are counted for each different word of the texts. A query's candidates are the rows with a word that
    holds its rarest term; the other terms are looked up in these rows only. Columns that are not `folded` yet
    are folded word by word, once per different word, and again in the candidates.

    With `staged`, for large corpora, the queries and the rarest words are stored, so that their size decides
    the joins.
    """
    asked = asked_words(queries, stems)
    if staged:
        asked = small_side(materialized(asked, "queries"))
    joined = F.concat_ws(" ", *[F.col(c) for c in columns])
    words = texts.select(key, F.explode(text.words(joined)).alias("word"))
    vocabulary = words.groupBy("word").agg(F.count("*").alias("n"))
    vocabulary = vocabulary.withColumn("haystack", F.col("word") if folded else text.fold(F.col("word")))
    rare = rarest_words(asked, vocabulary)
    if staged:
        rare = small_side(materialized(rare, "words"))
    body = (joined if folded else text.fold(joined)).alias("body")
    # A text meets all of its candidate queries at once, so it is moved at most once.
    found = candidates(words, rare, key).join(asked, "query").groupBy(key).agg(F.collect_set(F.struct("query", "forms")).alias("asked"))
    found = found.join(texts.select(key, body), key)
    holds = F.filter(
        "asked", lambda q: F.forall(q["forms"], lambda any_form: F.exists(any_form, lambda form: F.contains(F.col("body"), form)))
    )
    found = found.select(key, F.explode(holds).alias("hit")).select("hit.query", key)
    return queries.select("qid", "query").join(found, "query").select("qid", key).distinct()
