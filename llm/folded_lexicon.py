"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded text.

Folding lower-cases, maps homoglyphs and digit or symbol substitutions to the Latin letters they
imitate, removes invisible characters and turns everything that is no letter or digit into one blank.
The lexicon holds beginnings of words, learned from labelled documents: those in far more toxic than
clean ones, weighted by the logarithm of that ratio, the shortest sufficient beginning only. Exception
phrases are two-word contexts of an entry that are common in clean documents; a hit inside one does
not count. The score is a logistic function of the weight found, alone and per word of the text.

Fitting uses at most `SAMPLE` different labelled rows, chosen by a hash; scoring covers every text
from end to end.

Defined results: a null or empty text finds nothing and gets the score of a text without hits. Without
labels, or with labels of one kind only, the lexicon is empty and every score is the share of toxic
labels (0 if there are none). A label on several rows counts once per row; a null label does not count.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.sampling import bounded_sample, thinned
from statbank.session import materialized

#: Bounds of fitting: labelled rows, lexicon entries, exception phrases.
SAMPLE, ENTRIES, EXCEPTIONS = 20_000, 3_000, 1_000
#: Letters of a word's beginning; an entry's least share of toxic rows, least likelihood-ratio statistic, least ratio.
STEMS = (3, 4, 5, 6, 7, 8)
SHARE, EVIDENCE, LIFT = 0.005, 16.0, 15.0
#: A phrase is an exception in at least so many clean rows and at this ratio of clean to toxic shares.
CLEAN_COUNT, CLEAN_LIFT = 3, 2.0
CUT = 0.7

# Letters of other scripts that look like Latin ones, and what each is folded to (fixed values).
HOMOGLYPHS = dict(
    zip(
        "аеорсухіјѕһԁԛԝьвкмнтгпзαοερτυνικηωχγβσ",
        "aeopcyxijshdqwbbkmhtrnzaoeptuvikhwxybs",
        strict=True,
    )
)
# Digits and symbols written for letters (fixed values).
SUBSTITUTES = {"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g"}
SUBSTITUTES |= {"@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "+": "t"}
_INVISIBLE = "­​‌‍⁠﻿"
_TABLE = str.maketrans(HOMOGLYPHS | {c: None for c in _INVISIBLE})
#: A substitute counts as a letter only beside a letter on its right, so closing marks stay marks.
_WRITTEN_FOR = re.compile(r"[0-9@$!|€+]+(?=[^\W\d_])|(?<=[^\W\d_])[0-9@$|€+]+(?=[\s.,;:?!]|$)")
#: No word has a letter three times in succession, so a symbol written so is a mark.
_MARKS = re.compile(r"([@$!|€+])\1\1")
_APART = re.compile(r"[\W_]+")
_TO_LETTERS = str.maketrans(SUBSTITUTES)


def folded(text: str) -> str:
    """The text as blank-separated folded words, with a blank before the first and after the last."""
    text = text.lower().translate(_TABLE)
    text = _WRITTEN_FOR.sub(lambda m: " " if _MARKS.search(m[0]) else m[0].translate(_TO_LETTERS), text)
    return f" {_APART.sub(' ', text).strip()} "


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


@dataclass
class Lexicon:
    entries: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    #: intercept, weight of log(1 + found), weight of found per word
    logistic: tuple[float, float, float] = (-20.0, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for stem, weight in self.entries.items():
            found.add_word(" " + stem, (len(stem) + 1, weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
        if len(found):
            found.make_automaton()
        return found

    def hits(self, automaton, text: str) -> Iterator[tuple[int, int, float]]:
        """(start, end, weight) of counted hits in folded text: one a word, none inside an exception phrase."""
        if not len(automaton):
            return
        spared, found = [], {}
        for end, (size, weight) in automaton.iter(text):
            if weight:
                start = end + 1 - size
                if weight > found.get(start, (0, 0.0))[1]:
                    found[start] = (end, weight)
            else:
                spared.append((end + 1 - size, end))
        # The furthest end of the phrases that begin at or before a place decides; no hit meets every phrase.
        spared.sort()
        starts, upto = [a for a, _ in spared], list(accumulate((b for _, b in spared), max))
        for start, (end, weight) in found.items():
            before = bisect_right(starts, start)
            if not before or upto[before - 1] < end:
                yield start + 1, end + 1, weight

    def measured(self, automaton, text: str | None) -> tuple[float, int]:
        """(weight found, words)."""
        if not text:
            return 0.0, 0
        clean = folded(text)
        return sum(w for _, _, w in self.hits(automaton, clean)), clean.count(" ") - 1 if len(clean) > 2 else 0

    def score(self, weight: np.ndarray, words: np.ndarray) -> np.ndarray:
        a, b, c = self.logistic
        return 1 / (1 + np.exp(-np.clip(a + b * np.log1p(weight) + c * weight / (words + 10), -30, 30)))


def _counted(rows: DataFrame, parts, flush: int = 400_000) -> DataFrame:
    """rows (text, y) -> part, toxic, clean: rows that have the part, summed in the task before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally: tuple[Counter[str], Counter[str]] = (Counter(), Counter())

        def out() -> pd.DataFrame:
            keys = list(dict.fromkeys([*tally[0], *tally[1]]))
            got = pd.DataFrame({"part": keys, "toxic": [tally[1][k] for k in keys], "clean": [tally[0][k] for k in keys]})
            for t in tally:
                t.clear()
            return got

        for batch in batches:
            for text, y in zip(batch["text"], batch["y"], strict=True):
                tally[y].update(parts(folded(text)))
                if len(tally[0]) + len(tally[1]) > flush:
                    yield out()
        yield out()

    return rows.mapInPandas(count, "part string, toxic bigint, clean bigint").groupBy("part").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def stems(text: str) -> set[str]:
    words = set(text.split())
    return {w[:n] for w in words for n in STEMS if len(w) >= n}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method with a small ridge, which bounds the weights of separable data."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fitted(rows: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """A lexicon from labelled rows (doc_id, text, y 0 or 1), of which at most `sample` are used."""
    rows = rows.where(F.col("y").isin(0, 1)).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("y").cast("int").alias("y"))
    rows = materialized(bounded_sample(rows, ["doc_id", "y", "text"], sample).select("text", "y"), "labelled")
    total = {int(r["y"]): int(r["n"]) for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = total.get(1, 0), total.get(0, 0)
    if not toxic or not clean:
        return Lexicon(logistic=(20.0 if toxic else -20.0, 0.0, 0.0))
    lift = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    both, part = F.col("toxic") + F.col("clean"), toxic / (toxic + clean)
    evidence = sum(
        F.when(F.col(k) > 0, 2 * F.col(k) * F.log(F.col(k) / (both * share))).otherwise(0.0) for k, share in (("toxic", part), ("clean", 1 - part))
    )
    telling = _counted(rows, stems).withColumn("lift", lift)
    telling = telling.where((F.col("toxic") >= SHARE * toxic) & (evidence >= EVIDENCE) & (F.col("lift") >= LIFT))
    entries: dict[str, float] = {}
    for r in sorted(telling.orderBy(F.desc("toxic"), "part").limit(ENTRIES).collect(), key=lambda r: (len(r["part"]), r["part"])):
        if not any(r["part"][:n] in entries for n in STEMS):
            entries[r["part"]] = min(6.0, math.log(r["lift"]))
    lexicon = Lexicon(entries)

    def phrases(text: str) -> set[str]:
        words = text.split()
        at = [i for i, w in enumerate(words) if any(w[:n] in entries for n in STEMS)]
        return {" ".join(words[i - k : i - k + 2]) for i in at for k in (0, 1) if 0 <= i - k and i - k + 2 <= len(words)}

    harmless = ((F.col("clean") + 0.5) / (clean + 1)) / ((F.col("toxic") + 0.5) / (toxic + 1))
    spared = _counted(rows, phrases).where((F.col("clean") >= CLEAN_COUNT) & (harmless >= CLEAN_LIFT))
    lexicon.exceptions = tuple(r["part"] for r in spared.orderBy(F.desc("clean"), "part").limit(EXCEPTIONS).collect())

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for batch in batches:
            got = [lexicon.measured(automaton, t) for t in batch["text"]]
            yield pd.DataFrame({"w": [g[0] for g in got], "n": [g[1] for g in got], "y": batch["y"].to_numpy()})

    seen = rows.mapInPandas(measure, "w double, n bigint, y int").toPandas().sort_values(["w", "n", "y"])
    x = np.column_stack([np.log1p(seen["w"]), seen["w"] / (seen["n"] + 10)])
    lexicon.logistic = tuple(float(v) for v in logistic(x, seen["y"].to_numpy(float)))
    return lexicon


def toxicity(docs: DataFrame, lexicon: Lexicon, cut: float = CUT, spans: bool = False) -> DataFrame:
    """docs (doc_id, text) -> doc_id, score, predicted; with `spans` also the hits in the folded text."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for batch in batches:
            got = [lexicon.measured(automaton, t) for t in batch["text"]]
            score = lexicon.score(np.array([g[0] for g in got]), np.array([g[1] for g in got], float))
            out = pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": score, "predicted": (score >= cut).astype(np.int32)})
            if spans:
                clean = [folded(t) if t else "" for t in batch["text"]]
                out["hits"] = [[t[a:b] for a, b, _ in lexicon.hits(automaton, t)] for t in clean]
            yield out

    return docs.select("doc_id", "text").mapInPandas(judge, "doc_id bigint, score double, predicted int" + ", hits array<string>" * spans)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, y) of the rows to learn from: labelled documents that are not held out."""
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    return docs.select("doc_id", "text").where(~held_out(F.col("doc_id"))).join(known, "doc_id")


def sampled_labels(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most twice `sample` labels of documents that are not held out, by a hash of their ids: few enough to
    be sent to where the texts are."""
    own = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return F.broadcast(thinned(own, F.xxhash64("doc_id"), 2 * sample).orderBy(F.xxhash64("doc_id")).limit(2 * sample))


def op9_folded_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity; learned from labels of documents that are not held out."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    lexicon = fitted(labelled(docs, sampled_labels(spark.read.parquet(f"{folder}/labels.parquet"))))
    return toxicity(docs, lexicon).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def as_rows(lexicon: Lexicon) -> Sequence[tuple[str, float]] | Iterable[tuple[str, float]]:
    """The lexicon's entries and exception phrases (weight 0), for inspection."""
    return [*sorted(lexicon.entries.items()), *((p, 0.0) for p in sorted(lexicon.exceptions))]
