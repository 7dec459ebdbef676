"""Benchmark decontamination: test items found in documents within an edit budget.

Texts are lower-cased and runs of white space become one blank. An item of m characters may differ
in `e = floor(rate * m)` edits. It is split into e + 1 pieces of nearly equal length; e edits leave one
piece intact, so an Aho-Corasick automaton over all pieces finds every place worth a look. There the
item is aligned by Myers' bit-parallel edit distance: first the part beside the piece, which rejects
chance hits early, then the whole item with free ends in the text.

Test items are a stated set that is small against the corpus. They reach the tasks in blocks of at most
`BLOCK_CHARS` characters, one pass over the documents for each block.

Defined results: null or empty texts hold no item; an item without a character but white space, or
null, matches nothing; equal items are reported each under its own item_id; rows without item_id are
left out. A document's row without doc_id is reported with a null doc_id.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RATE = 0.08
BLOCK_CHARS = 4_000_000
MATCHES = "doc_id bigint, item_id bigint, start bigint, end bigint, distance int"


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def masks_of(pattern: str) -> dict[str, int]:
    """For each character, the bits of its places in the pattern."""
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def best_match(masks: dict[str, int], m: int, text: str, anchored: bool = False) -> tuple[int, int]:
    """(least edit distance of the pattern to a substring of text, where its first such end is).

    The substring may begin anywhere, or with `anchored` only at the start of text.
    """
    full = (1 << m) - 1
    last = 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, at = m, 0
    for j, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(across | plus)
        down = plus & across
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up = up << 1 | anchored
        down <<= 1
        plus = (down | ~(vertical | up)) & full
        minus = up & vertical & full
        if score < best:
            best, at = score, j
    return best, at


@dataclass
class Item:
    item_id: int
    text: str
    budget: int

    def __post_init__(self):
        m, parts = len(self.text), self.budget + 1
        cuts = [k * m // parts for k in range(parts + 1)]
        self.pieces = list(zip(cuts, cuts[1:], strict=False))
        self.masks, self.back = masks_of(self.text), masks_of(self.text[::-1])
        self.beside = [self._beside(a, b) for a, b in self.pieces]

    def _beside(self, a: int, b: int) -> tuple[bool, dict[str, int], int]:
        """What follows a piece (or precedes it, reversed), long enough to tell chance hits."""
        size = 2 * self.budget + 16
        right = len(self.text) - b >= a
        part = self.text[b : b + size] if right else self.text[max(0, a - size) : a][::-1]
        return right, masks_of(part), len(part)

    def near(self, text: str, piece: int, start: int) -> bool:
        """Whether the part beside a piece that stands at `start` of the text agrees within the budget."""
        right, masks, m = self.beside[piece]
        if m <= self.budget:
            return True
        a, b = self.pieces[piece]
        reach = m + self.budget
        at = start + b - a
        part = text[at : at + reach] if right else text[max(0, start - reach) : start][::-1]
        return best_match(masks, m, part, anchored=True)[0] <= self.budget

    def align(self, text: str, first: int) -> tuple[int, int, int] | None:
        """(start, end, distance) of the item near `first`, where it would begin without edits."""
        low = max(0, first - self.budget)
        window = text[low : first + len(self.text) + self.budget]
        distance, end = best_match(self.masks, len(self.text), window)
        if distance > self.budget:
            return None
        _, size = best_match(self.back, len(self.text), window[:end][::-1], anchored=True)
        return low + end - size, low + end, distance


def items_of(rows: Sequence[tuple[int, str | None]], rate: float = RATE) -> list[Item]:
    return [Item(k, t, math.floor(rate * len(t))) for k, t in ((k, normal(t)) for k, t in rows) if t]


def _whole(text: str, start: int, end: int) -> bool:
    """Whether no word of the text goes on beyond the match."""
    return not (start and text[start - 1].isalnum() and text[start].isalnum()) and not (end < len(text) and text[end].isalnum() and text[end - 1].isalnum())


class Finder:
    def __init__(self, items: list[Item]):
        import ahocorasick

        self.items, self.automaton = items, ahocorasick.Automaton()
        where: dict[str, list[tuple[int, int]]] = {}
        for k, item in enumerate(items):
            for p, (a, b) in enumerate(item.pieces):
                where.setdefault(item.text[a:b], []).append((k, p))
        for piece, uses in where.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if items:
            self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, start, end, distance) of matches in normalised text; of overlapping ones of an item the best, then the first."""
        if not self.items or not text:
            return
        looked: set[tuple[int, int]] = set()
        found: dict[int, list[tuple[int, int, int]]] = {}
        for last, (size, uses) in self.automaton.iter(text):
            start = last + 1 - size
            for k, p in uses:
                item = self.items[k]
                first = start - item.pieces[p][0]
                if (k, first) in looked or not item.near(text, p, start):
                    continue
                looked.add((k, first))
                if (match := item.align(text, first)) and (item.budget or _whole(text, *match[:2])):
                    found.setdefault(k, []).append(match)
        for k, matches in found.items():
            # What is kept lies apart, in order of place: only its neighbours can overlap a match.
            kept: list[tuple[int, int, int]] = []
            for match in sorted(set(matches), key=lambda x: (x[2], x[0], x[1])):
                at = bisect_left(kept, match)
                if (not at or kept[at - 1][1] <= match[0]) and (at == len(kept) or match[1] <= kept[at][0]):
                    kept.insert(at, match)
            for a, b, distance in kept:
                yield self.items[k].item_id, a, b, distance


def blocks_of(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of about `block_chars` characters, one at a time."""
    items = items.select("item_id", "text").where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("c")).first()["c"]
    blocks = max(1, -(-int(chars) // block_chars))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield sorted((int(r["item_id"]), r["text"]) for r in rows)


def clean_of(docs: DataFrame, items: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs, with all their columns, that hold no test item."""

    def clean_of_block(block: list[tuple[int, str]]):
        def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            finder = Finder(items_of(block, rate))
            for batch in batches:
                yield pd.Series([next(finder.find(normal(text)), None) is None for text in batch], dtype=bool)

        return F.pandas_udf(clean, "boolean", F.PandasUDFType.SCALAR_ITER)

    for block in blocks_of(items, block_chars):
        docs = docs.where(clean_of_block(block)("text"))
    return docs


def leaks(docs: DataFrame, items: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs (doc_id, text), items (item_id, text) -> doc_id, item_id, start, end (in normalised text), distance."""
    docs = docs.select("doc_id", "text")

    def search(block: list[tuple[int, str]]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            finder = Finder(items_of(block, rate))
            for batch in batches:
                rows = [
                    (doc, *match) for doc, text in zip(batch["doc_id"].tolist(), batch["text"].tolist(), strict=True) for match in finder.find(normal(text))
                ]
                out = pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "end", "distance"])
                yield out.assign(doc_id=out["doc_id"].astype("Int64"))

        return docs.mapInPandas(run, MATCHES)

    found = None
    for block in blocks_of(items, block_chars):
        one = search(block)
        found = one if found is None else found.unionByName(one)
    return found


def op6_edit_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Each (document, benchmark item) pair: how often the item occurs and its least distance."""
    found = leaks(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_matches"), F.min("distance").cast("bigint").alias("distance"))
