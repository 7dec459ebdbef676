"""Spelling variants grouped by blocked Gram matrices of letter counts.

Words are counted over whole texts. A word's letter counts fall into `CLASSES` classes of letters (by code
point); a cell holds the words with the same counts by class, so its words have one length. One replaced
letter moves a word within its cell or to a cell with one more of one class and one less of another; one
inserted letter moves it to a cell with one more of one class, which lies in the next length block. So near
words lie in the same or in neighbouring cells of the same or adjacent length blocks, and only these meet.

A cell is cut into tiles of about `TILE` words by a hash, and each pair of tiles is one row of a join. There
the product of the two letter-count matrices (each with its own squares beside it) is the matrix of squared
distances: 2 for one replaced letter, 1 for one inserted. Pairs with that distance are verified letter by
letter. Of a tile pair only each word's number of near words and its best one leave the task, and these are
combined by word; no list of pairs is made, and neither the words nor a block are ever in one place.

Roots follow forms by pointer jumping; a form has at least twice its word's count, so chains are short.

Defined results: a null text has no words; a null doc_id counts as empty text before the colon. Repeated rows
count again. Words of any length are handled, a very long one is a tile of its own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statbank.session import materialized

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
#: Every how manieth (document, run) by its checksum loses a letter.
DAMAGED = 97
MIN_LENGTH, MIN_COUNT = 5, 3
CLASSES, TILE = 5, 1024
#: Squared distance of two words of equal length, and of adjacent lengths.
REPLACED, INSERTED = 2, 1
#: Candidate pairs verified at once.
_STEP = 1 << 18


def damaged_words(docs: DataFrame, every: int = DAMAGED) -> DataFrame:
    """docs (doc_id, text) -> word: every maximal run of letters, some without one letter."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("_run"),
    )
    h = F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary"))
    at = F.pmod(h, F.char_length("_run").cast("bigint")).cast("int")
    cut = F.concat(F.expr("substring(_run, 1, _at)"), F.expr("substring(_run, _at + 2)"))
    return runs.withColumn("_h", h).withColumn("_at", at).select(F.when(F.col("_h") % every == 0, cut).otherwise(F.col("_run")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """words (word) -> word, n: those long and common enough."""
    long_enough = words.where(F.char_length("word") >= min_length)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _class_counts(word: Column, classes: int) -> list[Column]:
    out = []
    for c in range(classes):
        own = "".join(x for x in LETTERS if ord(x) % classes == c)
        out.append(F.char_length(word) - F.char_length(F.translate(word, own, "")))
    return out


def _cell_name(counts: list[Column]) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in counts])


def _neighbours(counts: list[Column]) -> Column:
    """(distance, cell) of the cell itself, and of those with one letter replaced or one inserted; of two cells that
    are each other's neighbours by a replaced letter only one names the other."""
    n = range(len(counts))

    def moved(up: int | None, down: int | None = None) -> Column:
        return _cell_name([c + int(i == up) - int(i == down) for i, c in enumerate(counts)])

    found = [(REPLACED, moved(None))] + [(REPLACED, moved(i, j)) for i in n for j in n if i < j] + [(INSERTED, moved(i)) for i in n]
    return F.array(*[F.struct(F.lit(d).alias("distance"), cell.alias("cell")) for d, cell in found])


def tiles_of(words: DataFrame, classes: int = CLASSES, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """words (word, n) -> tiles (cell, tile, letters, ns, near), and cells (cell, tiles)."""
    counts = [f"_c{i}" for i in range(classes)]
    placed = words.withColumns(dict(zip(counts, _class_counts(F.col("word"), classes), strict=True)))
    placed = placed.withColumn("cell", _cell_name([F.col(c) for c in counts]))
    cells = placed.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    placed = placed.join(cells, "cell").withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles").cast("bigint")).cast("int"))
    packed = placed.groupBy("cell", "tile", *counts).agg(F.collect_list(F.struct("word", "n")).alias("x"))
    # All words of a cell are of one length, so their letters need no separator.
    letters, ns = F.array_join(F.col("x.word"), ""), F.col("x.n")
    return packed.select("cell", "tile", letters.alias("letters"), ns.alias("ns"), _neighbours([F.col(c) for c in counts]).alias("near")), cells


class Tile:
    """Some words of one length: letters, counts and code-point order."""

    def __init__(self, letters: str, ns: np.ndarray):
        self.n = np.asarray(ns, np.int64)
        self.length = len(letters) // len(self.n)
        # Words hold letters up to U+00FF only.
        self.codes = np.frombuffer(letters.encode("latin-1"), np.uint8).reshape(-1, self.length)
        self.words = [letters[i : i + self.length] for i in range(0, len(letters), self.length)]

    def letter_counts(self, place: np.ndarray, width: int, kind: type) -> np.ndarray:
        at = np.arange(len(self.n))[:, None] * width + place[self.codes]
        return np.bincount(at.ravel(), minlength=len(self.n) * width).reshape(-1, width).astype(kind)


def at_distance(a: Tile, b: Tile, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose letter counts have this squared distance, by one matrix product."""
    used = np.zeros(256, bool)
    used[a.codes] = used[b.codes] = True
    place, width = np.cumsum(used) - 1, int(used.sum())
    kind = np.float32 if max(a.length, b.length) < 2000 else np.float64  # sums of squares stay exact
    x, y = a.letter_counts(place, width, kind), b.letter_counts(place, width, kind)
    ones = np.ones((len(y), 1), kind)
    left = np.hstack([-2 * x, (x * x).sum(axis=1, keepdims=True), ones[:1].repeat(len(x), axis=0)])
    right = np.hstack([y, ones, (y * y).sum(axis=1, keepdims=True)])
    found = np.flatnonzero(left @ right.T == distance)
    return found // len(y), found % len(y)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of letters, equally long or b by one longer: do they differ by exactly one replaced or inserted letter?"""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    head = np.minimum.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    tail = np.minimum.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= a.shape[1]


def near_pairs(a: Tile, b: Tile, distance: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of near words; of a tile with itself each pair once."""
    i, j = at_distance(a, b, distance)
    if same:
        i, j = i[i < j], j[i < j]
    step = max(1, _STEP * 8 // a.length)
    good = [one_edit(a.codes[i[k : k + step]], b.codes[j[k : k + step]]) for k in range(0, len(i), step)]
    good = np.concatenate(good) if good else np.zeros(0, bool)
    return i[good], j[good]


def _best(own: Tile, other: Tile, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, count of the commonest one, that one) for words of `own` with near words in `other`."""
    rank = np.empty(len(other.n), np.int64)
    rank[sorted(range(len(other.words)), key=other.words.__getitem__)] = np.arange(len(other.words))
    order = np.lexsort((rank[j], -other.n[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.diff(i, prepend=-1))
    for k, count in zip(first.tolist(), np.diff(np.append(first, len(i))).tolist(), strict=True):
        yield own.words[i[k]], count, int(other.n[j[k]]), other.words[j[k]]


def near_words(words: DataFrame, classes: int = CLASSES, tile: int = TILE) -> DataFrame:
    """words (word, n) -> word, n_near, best (the near word of largest n, the smallest of equals), best_n."""
    tiles, cells = tiles_of(words, classes, tile)
    tiles = materialized(tiles, "tiles")
    near = tiles.select("cell", "tile", F.explode("near").alias("x")).select("cell", "tile", "x.distance", F.col("x.cell").alias("cell2"))
    near = near.join(cells.select(F.col("cell").alias("cell2"), "tiles"), "cell2")
    near = near.select("cell", "tile", "distance", "cell2", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile2"))
    near = near.where((F.col("cell") != F.col("cell2")) | (F.col("tile") <= F.col("tile2")))
    jobs = near.join(tiles.select("cell", "tile", "letters", "ns"), ["cell", "tile"])
    other = tiles.select(F.col("cell").alias("cell2"), F.col("tile").alias("tile2"), F.col("letters").alias("letters2"), F.col("ns").alias("ns2"))
    same = (F.col("cell") == F.col("cell2")) & (F.col("tile") == F.col("tile2"))
    jobs = jobs.join(other, ["cell2", "tile2"]).select("distance", same.alias("same"), "letters", "ns", "letters2", "ns2")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple[str, int, int, str]] = []
        for batch in batches:
            for distance, same, letters, ns, letters2, ns2 in batch.itertuples(index=False):
                a = Tile(letters, ns)
                b = a if same else Tile(letters2, ns2)
                i, j = near_pairs(a, b, distance, same)
                if len(i):
                    out += _best(a, b, i, j)
                    out += _best(b, a, j, i)
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=["word", "n_near", "best_n", "best"])
                    out = []
        yield pd.DataFrame(out, columns=["word", "n_near", "best_n", "best"])

    parts = jobs.mapInPandas(compare, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct(F.negative("best_n").alias("n"), F.col("best").alias("word"))).alias("x")
    found = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", F.col("x.word").alias("best"), F.negative("x.n").alias("best_n"))


def rooted(forms: DataFrame) -> DataFrame:
    """forms (word, form), without cycles -> word, root: the last form that a word's forms lead to."""
    roots = materialized(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        above = roots.select(F.col("word").alias("root"), F.col("root").alias("above"))
        step = materialized(roots.join(above, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        roots = step.select("word", "root")


def variant_groups(words: DataFrame, classes: int = CLASSES, tile: int = TILE) -> DataFrame:
    """words (word, n) -> word, form, root, n, n_near, form_n."""
    words = materialized(words.select("word", "n"), "vocabulary")
    found = words.join(near_words(words, classes, tile), "word", "left")
    common = F.col("best_n") >= 2 * F.col("n")
    found = found.select(
        "word", F.when(common, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(common, F.col("best_n")).alias("form_n")
    )
    found = materialized(found, "forms")
    roots = rooted(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every common word of the documents with its form and root."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return variant_groups(vocabulary(damaged_words(docs)))
