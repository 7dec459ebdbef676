"""Language-model scoring by a weighted backoff automaton learned from the whole corpus.

States are the histories seen in training, from the empty one to `order - 1` tokens. A state h has an
arc for each token w seen after it, with weight log10((c(hw) + k P(w | h')) / (c(h) + k)), and a failure
arc to its shorter history h' with weight log10(k / (c(h) + k)); k = SCALE * c(h) ** POWER is the mass kept
for unseen tokens, as the number of different followers grows with c(h). The empty state has an arc for
every token: (c(w) + 0.1) / (N + 0.1 (V + 1)). A text is read from left to right from the state after an
end token; each token follows failure arcs until an arc exists, and the weights add up.

The automaton grows with the corpus and is nowhere whole. Documents are packed into blocks of at most
`BLOCK_TOKENS` tokens (a longer text is a block of its own). A block asks for the counts of its distinct
n-grams, one message to each part of the hash range, with its own training counts; a part adds up what
its blocks brought and answers in the same order. Every n-gram reaches its part at most once from each
block, so a word that makes up a third of all tokens weighs no more there than any other.

Defined results: a null or empty text is the end token alone. Without training documents N and V are 0
and every base term is log10(0.1 / 0.1) = 0. Repeated rows count as often as they occur. A row without
doc_id is learned from and not held out. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.words import Words, chunks, mixed
from statbank.session import materialized

ORDER = 2
ALPHA = 0.1
SCALE, POWER = 4.0, 0.8
BLOCK_TOKENS = 1_000_000
#: n-grams that one part of the hash range holds, about.
PART_GRAMS = 1_000_000
END = np.uint64(0x6A09E667F3BCC909)
#: Bits of a hash that identify n-grams of two or more tokens; words keep all 64.
GRAM_BITS = 46

BLOCK = "block bigint, docs array<bigint>, unnamed array<boolean>, held array<boolean>, lengths array<bigint>, words binary, stream binary"
REQUEST = "part int, block bigint, grams array<binary>, counts array<binary>"
REPLY = "block bigint, part int, counts array<binary>, distinct bigint"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(10)) == 0, F.lit(False))


def _deflated(x: np.ndarray) -> bytes:
    return zlib.compress(x.tobytes(), 1)


def _inflated(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), kind)


def _stream_to_bytes(x: np.ndarray) -> bytes:
    """Numbers of which small ones are common, byte plane by byte plane."""
    pack = zlib.compressobj(1, zlib.DEFLATED, 15, 9, zlib.Z_RLE)
    return pack.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()) + pack.flush()


def _stream_from_bytes(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def _sorted_to_bytes(x: np.ndarray) -> bytes:
    """Ascending 64-bit numbers by their gaps; four bytes each where every gap allows it."""
    gaps = np.diff(x, prepend=np.uint64(0))
    if len(gaps) and gaps[1:].max(initial=np.uint64(0)) < 1 << 32:
        return b"\1" + x[:1].tobytes() + gaps[1:].astype(np.uint32).tobytes()
    return b"\0" + x.tobytes()


def _sorted_from_bytes(raw: bytes) -> np.ndarray:
    if raw[0] == 0:
        return np.frombuffer(raw, np.uint64, offset=1)
    return np.cumsum(np.concatenate([np.frombuffer(raw, np.uint64, 1, 1), np.frombuffer(raw, np.uint32, offset=9).astype(np.uint64)]), dtype=np.uint64)


def blocks_of(docs: DataFrame, limit: int = BLOCK_TOKENS) -> DataFrame:
    """docs (doc_id, text, held) packed into blocks: ids, flags and token counts of the documents, the
    hashes of their distinct tokens from the commonest on, and the tokens as indices into these."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        docs, held, lengths, tokens = [], [], [], []

        def out() -> pd.DataFrame:
            nonlocal number
            stream = np.concatenate(tokens)
            words, index, counts = np.unique(stream, return_inverse=True, return_counts=True)
            common = np.argsort(-counts, kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[common] = np.arange(len(words))
            row = (number, [x or 0 for x in docs], [x is None for x in docs], list(held), list(lengths), words[common].tobytes(), _stream_to_bytes(rank[index]))
            number += 1
            for x in (docs, held, lengths, tokens):
                x.clear()
            return pd.DataFrame([row], columns=["block", "docs", "unnamed", "held", "lengths", "words", "stream"])

        size = 0
        for batch in batches:
            ids = [None if pd.isna(x) else int(x) for x in batch["doc_id"]]
            flags = batch["held"].tolist()
            for first, raw in chunks(batch["text"].tolist()):
                words = Words(raw)
                for i in range(len(raw)):
                    own = np.append(words.hashes[words.bounds[i] : words.bounds[i + 1]], END)
                    if docs and size + len(own) > limit:
                        yield out()
                        size = 0
                    docs.append(ids[first + i])
                    held.append(bool(flags[first + i]))
                    lengths.append(len(own))
                    tokens.append(own)
                    size += len(own)
        if docs:
            yield out()

    return docs.select("doc_id", "text", "held").mapInPandas(pack, BLOCK)


class Block:
    """The n-grams of a block: for each length the ascending distinct hashes and each position's index."""

    def __init__(self, words: bytes, stream: bytes, lengths: np.ndarray, held: np.ndarray, order: int):
        # Stored from the commonest word on; from here on words are in ascending order.
        common = np.frombuffer(words, np.uint64)
        ascending = np.argsort(common)
        place = np.empty(len(ascending), np.int64)
        place[ascending] = np.arange(len(ascending))
        lexicon, index = common[ascending], place[_stream_from_bytes(stream)]
        self.ends = np.cumsum(lengths)
        self.owner = np.repeat(np.arange(len(lengths)), lengths)
        self.at = np.arange(len(index)) - (self.ends - lengths)[self.owner]
        self.learned = (~held)[self.owner]
        self.grams, self.index, self.valid = [lexicon], [index], [np.ones(len(index), bool)]
        tokens = lexicon[index]
        last = tokens
        for n in range(2, order + 1):
            before = np.concatenate([[END], last[:-1]])
            last = mixed(before * np.uint64(3) + tokens)
            short = last >> np.uint64(64 - GRAM_BITS)
            valid = self.at >= n - 2
            grams, place = np.unique(short, return_inverse=True)
            self.grams.append(grams)
            self.index.append(place)
            self.valid.append(valid)

    def counts(self, n: int) -> np.ndarray:
        """How often each n-gram occurs in documents to learn from."""
        use = self.learned & self.valid[n]
        return np.bincount(self.index[n][use], minlength=len(self.grams[n])).astype(np.uint32)


def _bounds(grams: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """Where each part's share of ascending hashes begins: parts are equal ranges of the first 32 bits."""
    head = (grams >> np.uint64(bits - 32)).astype(np.int64)
    return np.searchsorted(head * parts >> 32, np.arange(parts + 1))


def _bits(n: int) -> int:
    return 64 if n == 0 else GRAM_BITS


def requests(blocks: DataFrame, parts: int, order: int) -> DataFrame:
    """One message from each block to each part: its distinct n-grams there, with its training counts."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                own = Block(row.words, row.stream, np.asarray(row.lengths), np.asarray(row.held, bool), order)
                counts = [own.counts(n) for n in range(order)]
                cuts = [_bounds(own.grams[n], _bits(n), parts) for n in range(order)]
                out = []
                for p in range(parts):
                    spans = [slice(c[p], c[p + 1]) for c in cuts]
                    out.append((p, row.block, [_sorted_to_bytes(g[s]) for g, s in zip(own.grams, spans, strict=True)], [_deflated(c[s]) for c, s in zip(counts, spans, strict=True)]))
                yield pd.DataFrame(out, columns=["part", "block", "grams", "counts"])

    return blocks.select("block", "held", "lengths", "words", "stream").mapInPandas(ask, REQUEST)


def replies(asked: DataFrame, order: int) -> DataFrame:
    """Each part's totals, in the order of each block's message; `distinct` is the part's number of learned words."""

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        totals = [[] for _ in range(len(part))]
        distinct = 0
        for n in range(order):
            grams = [_sorted_from_bytes(x[n]) for x in part["grams"]]
            counts = [_inflated(x[n], "<u4") for x in part["counts"]]
            _, place = np.unique(np.concatenate(grams), return_inverse=True)
            total = np.bincount(place, np.concatenate(counts)) if len(place) else np.zeros(0)
            if n == 0:
                distinct = int((total > 0).sum())
            at = 0
            for k, g in enumerate(grams):
                totals[k].append(_deflated(total[place[at : at + len(g)]].astype(np.uint64)))
                at += len(g)
        return pd.DataFrame({"block": part["block"], "part": part["part"], "counts": totals, "distinct": distinct})

    return asked.groupBy("part").applyInPandas(answer, REPLY)


def _walk(own: Block, counts: list[np.ndarray], tokens: int, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """log10 weights of the empty state's arc and of the path taken, for each position of the block."""
    found = counts[0][own.index[0]]
    p = (found + ALPHA) / (tokens + ALPHA * (distinct + 1))
    base = np.log10(p)
    for n in range(1, len(counts)):
        seen = counts[n - 1][own.index[n - 1]]
        # The state's count: that of the history, which ended one position before (after an end token at a start).
        start = int(np.searchsorted(own.grams[0], END)) if n == 1 else 0
        state = np.concatenate([[counts[0][start] if n == 1 else 0], seen[:-1]])
        kept = SCALE * np.maximum(state, 1.0) ** POWER
        arc = counts[n][own.index[n]]
        # An arc that is missing has count 0: then this is the failure arc's weight times the shorter state's.
        p = np.where(own.valid[n], (arc + kept * p) / (state + kept), p)
    return base, np.log10(p)


def scored(docs: DataFrame, order: int = ORDER, block_tokens: int = BLOCK_TOKENS, part_grams: int = PART_GRAMS) -> DataFrame:
    """docs (doc_id, text, held) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model is learned from the rows that are not held.
    """
    blocks = materialized(blocks_of(docs, block_tokens), "blocks")
    sizes = F.expr("aggregate(zip_with(lengths, held, (n, h) -> IF(h, 0L, n)), 0L, (a, x) -> a + x)")
    total = blocks.agg(F.sum(sizes).alias("learned"), F.sum(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)")).alias("all")).first()
    tokens, parts = int(total["learned"] or 0), max(4, int(total["all"] or 0) * order // 2 // part_grams)
    asked = requests(blocks, parts, order).repartition(parts, "part")
    answered = materialized(replies(asked, order), "replies")
    distinct = int(answered.groupBy("part").agg(F.max("distinct").alias("d")).agg(F.sum("d").alias("v")).first()["v"] or 0)

    def score(_, block: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        reply = reply.sort_values("part")
        out = []
        for row in block.itertuples():
            own = Block(row.words, row.stream, np.asarray(row.lengths), np.asarray(row.held, bool), order)
            counts = [np.concatenate([_inflated(x[n], "<u8") for x in reply["counts"]]).astype(float) for n in range(order)]
            base, path = _walk(own, counts, tokens, distinct)
            starts = own.ends - np.asarray(row.lengths)
            known = np.add.reduceat((counts[0][own.index[0]] > 0).astype(np.int64), starts)
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.Series(row.docs, dtype="Int64").mask(np.asarray(row.unnamed, bool)),
                        "held_out": np.asarray(row.held, bool),
                        "n_tokens": np.asarray(row.lengths, np.int64),
                        "n_known": known,
                        "train_tokens": tokens,
                        "base_score": np.add.reduceat(base, starts),
                        "score": np.add.reduceat(path, starts),
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kinds = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return blocks.groupBy("block").cogroup(answered.groupBy("block")).applyInPandas(score, kinds)


def op4_backoff_automaton(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's base score and its score by the automaton."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return scored(docs.withColumn("held", held_out(F.col("doc_id"))))
