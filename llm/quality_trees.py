"""Quality rules: gradient-boosted trees over document statistics.

Statistics are counted over the whole text in vectorised passes over bytes and word hashes. Trees of
fixed depth are grown on quantile bins with the logistic loss; chosen statistics may only lower (or
raise) the score: a split against the direction is not taken, and the values below a split are bounded
by its middle. The trees are flattened into node arrays, and all trees of all documents are walked
together, one array step for each level.

Labels come from a bounded sample (`SAMPLE` labelled rows by a hash of their id); statistics and
verdicts cover every document.

Defined results: a null text has no words and fails the base rules. Without labels of both kinds the
method keeps what the base rules keep. Rows with equal or null doc_id are judged each on its own text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.sampling import bounded_sample
from llm.words import EXACT, Words, chunks, mixed
from statbank.session import materialized

SAMPLE = 20_000
TREES, DEPTH, RATE, BINS, LEAST = 60, 3, 0.2, 32, 20
CUT = 0.5
MIN_WORDS, REPEAT_PERCENT, WINDOW = 50, 50, 3

#: Statistics of a document, and the direction in which each may move the score (0: either).
FEATURES = {
    "log_words": 0,
    "word_chars": 0,
    "symbols": -1,
    "dup_lines": -1,
    "repeat_words": -1,
    "capitals": -1,
    "digits": -1,
    "stops": 0,
    "commas": 0,
    "shouts": -1,
    "lines": 0,
    "distinct": 0,
    "wide": 0,
    "symbol_words": -1,
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL, _CAPITAL, _DIGIT = _table("#*$%&|<>"), _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("0123456789")
_STOP, _COMMA, _SHOUT = _table(".?"), _table(",;:"), _table("!")


def statistics(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(COUNTS, FEATURES) of each text, one row a text."""
    words = Words(raw, EXACT)
    buffer, n = words.buffer, len(raw)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return np.diff(sums[words.text_start])

    n_words = np.diff(words.bounds)
    lead = (buffer & 0xC0) != 0x80
    edges = np.zeros(len(buffer) + 1, np.int8)
    edges[words.starts], edges[words.ends] = 1, -1
    apart = np.cumsum(edges[:-1], dtype=np.int8) == 0
    in_words = per_text(lead & ~apart)
    symbols = _SYMBOL[buffer]
    n_symbols = per_text(symbols)

    # Windows that occur again in their text; every word of such a window counts once.
    hashes, bounds = words.windows(WINDOW)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    key = mixed(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    at = (np.arange(len(key)) + np.repeat(words.bounds[:-1] - bounds[:-1], np.diff(bounds)))[again]
    covered = np.zeros(len(words.hashes), bool)
    for i in range(WINDOW):
        covered[at + i] = True
    total = np.concatenate([[0], np.cumsum(covered)])
    repeat = np.diff(total[words.bounds])

    word_owner = np.repeat(np.arange(n), n_words)
    keyed = mixed(words.hashes + word_owner.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    _, first = np.unique(keyed, return_index=True)
    distinct = np.bincount(word_owner[first], minlength=n)
    sym = np.concatenate([[0], np.cumsum(symbols, dtype=np.int64)])
    marked = (sym[words.ends] - sym[words.starts]) > 0
    with_symbol = np.bincount(word_owner[marked], minlength=n)

    dup, lines = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, text in enumerate(raw):
        seen: set[bytes] = set()
        for line in text.split(b"\n"):
            if line.strip(b" \t\n\r\x0b\x0c"):
                lines[i] += 1
                if line in seen:
                    dup[i] += 1
                seen.add(line)

    w = np.maximum(1, n_words)
    c = np.maximum(1, per_text(lead) - 1)
    counts = np.column_stack([n_words, in_words, n_symbols, dup, repeat])
    features = np.column_stack(
        [
            np.log1p(n_words),
            in_words / w,
            n_symbols / w,
            dup / np.maximum(1, lines),
            repeat / w,
            per_text(_CAPITAL[buffer]) / c,
            per_text(_DIGIT[buffer]) / c,
            per_text(_STOP[buffer]) / w,
            per_text(_COMMA[buffer]) / w,
            per_text(_SHOUT[buffer]) / w,
            lines / w,
            distinct / w,
            1 - per_text(buffer < 0x80) / np.maximum(1, np.diff(words.text_start)),
            with_symbol / w,
        ]
    )
    return counts, features


@dataclass
class Forest:
    """Flattened trees: node arrays of shape (trees, nodes); leaves point at themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))
        node = np.zeros((len(x), len(trees)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            less = x[rows, self.feature[trees, node]] <= self.threshold[trees, node]
            node = np.where(less, self.left[trees, node], self.right[trees, node])
        return 1 / (1 + np.exp(-(self.base + self.value[trees, node].sum(axis=1))))


def grown(x: np.ndarray, y: np.ndarray, direction: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Forest:
    """Boosting with second-order steps on quantile bins, under the directions."""
    cuts = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
    bins = np.column_stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T, strict=True)])
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    nodes = 2 ** (depth + 1) - 1
    shape = (trees, nodes)
    forest = Forest(np.zeros(shape, np.int64), np.zeros(shape), np.tile(np.arange(nodes), (trees, 1)), np.tile(np.arange(nodes), (trees, 1)), np.zeros(shape), base, depth)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        todo = [(0, np.arange(len(y)), -np.inf, np.inf, 0)]
        while todo:
            node, rows, low, high, level = todo.pop()
            forest.value[t, node] = np.clip(rate * g[rows].sum() / (h[rows].sum() + 1), low, high)
            best = (1e-6, None)
            if level < depth and len(rows) >= 2 * LEAST:
                whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    size = len(c) + 1
                    gs, hs, ns = (np.cumsum(np.bincount(bins[rows, j], v, size))[:-1] for v in (g[rows], h[rows], None))
                    gr, hr = g[rows].sum() - gs, h[rows].sum() - hs
                    gain = gs**2 / (hs + 1) + gr**2 / (hr + 1) - whole
                    allowed = (ns >= LEAST) & (len(rows) - ns >= LEAST)
                    if direction[j]:
                        allowed &= direction[j] * (gr / (hr + 1) - gs / (hs + 1)) >= 0
                    gain = np.where(allowed, gain, -1)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], (j, k, rate * gs[k] / (hs[k] + 1), rate * gr[k] / (hr[k] + 1)))
            if best[1] is None:
                margin[rows] += forest.value[t, node]
                continue
            j, k, vl, vr = best[1]
            below = bins[rows, j] <= k
            forest.feature[t, node], forest.threshold[t, node] = j, cuts[j][k]
            forest.left[t, node], forest.right[t, node] = 2 * node + 1, 2 * node + 2
            bounds = [(low, high), (low, high)]
            if direction[j]:
                middle = float(np.clip((vl + vr) / 2, low, high))
                bounds = [(low, middle), (middle, high)] if direction[j] > 0 else [(middle, high), (low, middle)]
            todo += [(2 * node + 1 + s, rows[below if s == 0 else ~below], *bounds[s], level + 1) for s in (0, 1)]
    return forest


def measured(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, the COUNTS and the statistics `x` of each text."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["doc_id"].astype("Int64")
            for first, raw in chunks(batch["text"].tolist()):
                counts, features = statistics(raw)
                out = pd.DataFrame(counts, columns=list(COUNTS))
                out.insert(0, "doc_id", ids.iloc[first : first + len(raw)].reset_index(drop=True))
                yield out.assign(x=list(features))

    return docs.select("doc_id", "text").mapInPandas(measure, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", x array<double>")


def fitted(rows: DataFrame, sample: int = SAMPLE) -> Forest | None:
    """A forest from rows (doc_id, x, y 0 or 1), of which at most `sample` are used; None without both kinds."""
    rows = rows.where(F.col("y").isin(0, 1)).select("doc_id", "x", F.col("y").cast("int").alias("y"))
    got = bounded_sample(rows, ["doc_id", "y", "x"], sample).toPandas().sort_values(["doc_id", "y"], ignore_index=True)
    if got["y"].nunique() < 2:
        return None
    return grown(np.array(got["x"].tolist()), got["y"].to_numpy(float), np.array(list(FEATURES.values())))


def quality(stats: DataFrame, forest: Forest | None, cut: float = CUT) -> DataFrame:
    """measured() rows -> doc_id, COUNTS, base_failed, score, kept."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch.pop("x").tolist()).reshape(len(batch), len(FEATURES))
            score = np.ones(len(x)) if forest is None else np.concatenate([forest.score(x[i : i + 4096]) for i in range(0, len(x), 4096)] or [x[:, 0]])
            failed = (batch["n_words"] < MIN_WORDS) | (100 * batch["n_repeat_words"] > REPEAT_PERCENT * batch["n_words"])
            yield batch.assign(doc_id=batch["doc_id"].astype("Int64"), base_failed=failed, score=score, kept=~failed & (score >= cut))

    kinds = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, score double, kept boolean"
    return stats.select("doc_id", *COUNTS, "x").mapInPandas(judge, kinds)


def op2_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's counts, base rules and verdict."""
    stats = materialized(measured(spark.read.parquet(f"{folder}/documents.parquet")), "statistics")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("y"))
    return quality(stats, fitted(stats.join(labels, "doc_id")))
