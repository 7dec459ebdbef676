"""Packing of token sequences: a configuration linear program over the length histogram.

A configuration is a multiset of piece lengths that fits into one sequence. The program asks for the
fewest configurations that cover the histogram. Multiplicative weights solve it: every length has a
weight that falls as its coverage rises; an unbounded-knapsack dynamic program prices configurations
under these weights, one for each length that must be in it. The fractional solution is rounded down
and the rest of the histogram is placed by best fit, longest pieces first.

Only the histogram (at most `capacity` numbers) and the chosen configurations reach the driver. A
piece finds its place from its rank among the pieces of its length: ranks are counted in blocks by
hash, so that a length held by a third of all pieces is spread over many tasks.

Defined results: a null text is an empty one, that is the single id `END`. Rows that repeat a doc_id,
or have none, are packed like any other. An empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
import sys
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statbank.session import materialized

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k.json"
#: Rounds of multiplicative weights, and how strongly coverage lowers a weight.
ROUNDS, RATE = 40, 0.5
#: Times in a round that configurations are priced anew.
PRICED = 12
#: Programs solved at most, one on what its predecessor's rounding left.
PROGRAMS = 12
#: Pieces per counting block, on average.
BLOCK_ROWS = 50_000
#: Distinct words whose ids a Python worker remembers; beyond it the memory starts anew.
REMEMBERED = 400_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _class(*kinds: str) -> str:
    """Characters below U+0250 of some Unicode categories, as the inside of a character class."""
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] in kinds)


_SPACE = " \t\n\r\x0b\x0c\x85\xa0"
_L, _N = _class("L"), _class("N")
#: The vocabulary's word pattern, with its Unicode classes written out for characters below U+0250.
_PATTERN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{re.escape(_SPACE)}{_L}{_N}]+|[{re.escape(_SPACE)}]+(?![^{re.escape(_SPACE)}])|[{re.escape(_SPACE)}]+"
)
#: Texts outside the pattern's range, or with a special token, are tokenised whole.
_OTHER = re.compile("[^\x00-\x1b\x20-ɏ]|<\\|endoftext\\|>")


def _visible() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + k) for k, b in enumerate(sorted({*range(256)} - {*own}))}


_VISIBLE = _visible()


class Encoder:
    """Token ids as little-endian bytes; words are tokenised once and remembered."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.remembered = Tokenizer.from_file(path), {}, remembered
        self.model = self.tokenizer.model

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """One word, straight through the vocabulary's merges."""
        ids = [x.id for x in self.model.tokenize(word.encode().decode("latin-1").translate(_VISIBLE))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if _OTHER.search(text):
            return self._whole(text)
        words = _PATTERN.findall(text)
        known = self.known
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            if len(known) > self.remembered:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = self._word(w)
            return b"".join([known[w] for w in words])


def pieces_of(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only a first piece may be shorter than the capacity."""
    end = n % capacity or capacity
    start = 0
    while start < n:
        yield start, end - start
        start, end = end, end + capacity


def tokenised(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """docs (doc_id, text) -> one row per piece: doc_id, piece, start, length, ids_crc32."""
    last = int(end).to_bytes(4, "little")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"].tolist(), batch["text"].tolist(), strict=True):
                ids = (encoder.encode(text) if text is not None else b"") + last
                for k, (start, length) in enumerate(pieces_of(len(ids) // 4, capacity)):
                    rows.append((doc, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    return docs.select("doc_id", "text").mapInPandas(cut, PIECES)


def priced(weight: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: for each room, the most weight it holds and the length taken first (0: none).

    weight[l] is the worth of a piece of length l; lengths that are absent weigh 0.
    """
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        worth = weight[1 : room + 1] + best[room - 1 :: -1][:room]
        k = int(worth.argmax())
        if worth[k] > best[room - 1] and weight[k + 1] > 0:
            best[room], take[room] = worth[k], k + 1
        else:
            best[room] = best[room - 1]
    return best, take


def _filled(room: int, take: np.ndarray) -> list[int]:
    out = []
    while room > 0:
        if take[room]:
            out.append(int(take[room]))
            room -= int(take[room])
        else:
            room -= 1
    return out


def fractional(need: np.ndarray, capacity: int, rounds: int) -> dict[tuple[int, ...], float]:
    """The program by multiplicative weights: how often each configuration is used, in fractions.

    After round t every length is covered to the t-th part of its need at least. Lengths are visited from
    the longest on; one that lags behind takes the best priced configuration that holds it, which also covers
    others. Lengths that are covered beyond their part lose weight; prices follow `PRICED` times a round.
    """
    lengths = np.flatnonzero(need)
    size = np.arange(capacity + 1, dtype=float)
    # Of configurations that fill as much, the one of fewer and longer pieces: short ones fit anywhere later.
    worth = size + 1e-3 * size**2 / capacity
    covered, x = np.zeros(capacity + 1), Counter()
    for t in range(1, rounds + 1):
        used = 0
        for length in lengths[::-1].tolist():
            lag = need[length] * t / rounds - covered[length]
            if lag > 1e-9:
                if used % max(1, len(lengths) // PRICED) == 0:
                    ratio = np.divide(covered, need, out=np.zeros_like(covered), where=need > 0) * rounds - (t - 1)
                    _, take = priced(np.where(need > 0, worth * np.exp(-RATE * np.clip(ratio, -4, 4)), 0.0), capacity)
                used += 1
                pattern = tuple(sorted([length, *_filled(capacity - length, take)], reverse=True))
                counts = Counter(pattern)
                amount = lag / counts[length]
                x[pattern] += amount
                for y, c in counts.items():
                    covered[y] += amount * c
    return x


def best_fit(left: np.ndarray, capacity: int) -> Counter[tuple[int, ...]]:
    """Best fit decreasing on a histogram: equal pieces and equal sequences are placed together."""
    rooms: dict[int, Counter[tuple[int, ...]]] = {}
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            room = min((r for r, held in rooms.items() if r >= length and held), default=None)
            if room is None:
                # New sequences take as many equal pieces as fit.
                each = min(n, capacity // length)
                rooms.setdefault(capacity - each * length, Counter())[(length,) * each] += n // each
                n %= each
                continue
            pattern, times = next(iter(rooms[room].items()))
            each = min(n, room // length)
            some = min(times, n // each)
            rooms[room][pattern] -= some
            if not rooms[room][pattern]:
                del rooms[room][pattern]
            rooms.setdefault(room - each * length, Counter())[pattern + (length,) * each] += some
            n -= some * each
    return sum(rooms.values(), Counter())


def rounded(x: Mapping[tuple[int, ...], float], left: np.ndarray) -> Counter[tuple[int, ...]]:
    """Whole numbers of configurations near the fractions x; what they hold is taken from `left`.

    Fractions are carried on from configuration to configuration, fullest first, so that their sum is kept; a
    configuration is used only as often as all of its pieces are left.
    """
    out: Counter[tuple[int, ...]] = Counter()
    carried = 0.5
    for pattern, amount in sorted(x.items(), key=lambda p: (-sum(p[0]), -p[0][0], -p[1], p[0])):
        carried += amount
        if carried >= 1:
            counts = Counter(pattern)
            times = min(int(carried), *(int(left[y]) // c for y, c in counts.items()))
            carried -= int(carried)
            if times > 0:
                out[pattern] += times
                for y, c in counts.items():
                    left[y] -= times * c
    return out


def solved(need: np.ndarray, capacity: int, rounds: int = ROUNDS, programs: int = PROGRAMS) -> tuple[Counter[tuple[int, ...]], Counter[tuple[int, ...]]]:
    """Configurations that hold exactly the histogram `need`: those of the programs, and those of best fit."""
    left, out = need.copy(), Counter()
    for _ in range(programs):
        some = rounded(fractional(left, capacity, rounds), left)
        out += some
        if not some or not left.any():
            break
    return out, best_fit(left, capacity)


def configurations(histogram: Mapping[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a configuration, times used), which together hold exactly the histogram."""
    need = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        need[length] = n
    return sorted(sum(solved(need, capacity, rounds), Counter()).items())


class Places:
    """Where the pieces of each length go: rank among equal lengths -> (sequence, offset)."""

    def __init__(self, chosen: list[tuple[tuple[int, ...], int]]):
        runs: dict[int, list[tuple[int, int, int, int]]] = {}
        base = 0
        for pattern, times in chosen:
            offset = 0
            for length, copies in sorted(Counter(pattern).items(), reverse=True):
                runs.setdefault(length, []).append((times * copies, base, copies, offset))
                offset += length * copies
            base += times
        self.total = base
        self.runs = {k: np.array(v, np.int64) for k, v in runs.items()}
        self.upto = {k: np.cumsum(v[:, 0]) for k, v in self.runs.items()}

    def find(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.upto[length], rank, side="right")
        slots, base, copies, offset = self.runs[length][at].T
        within = rank - (self.upto[length][at] - slots)
        return base + within // copies, offset + within % copies * length


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (stored; a length each) with sequence_id and offset added."""
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    full = histogram.pop(capacity, 0)
    places = Places(configurations(histogram, capacity))
    blocks = max(1, -(-(sum(histogram.values()) + full) // BLOCK_ROWS))
    dealt = pieces.withColumn("_block", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(blocks)))
    before = (
        dealt.groupBy("length", "_block")
        .agg(F.count("*").alias("_n"))
        .select("length", "_block", (F.sum("_n").over(Window.partitionBy("length").orderBy("_block")) - F.col("_n")).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy("length", "_block").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = dealt.withColumn("_rank", within - 1).join(before, ["length", "_block"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before")).select(*pieces.columns, "_rank")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank = batch.pop("_rank").to_numpy(np.int64)
            length = batch["length"].to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for y in np.unique(length):
                of = np.flatnonzero(length == y)
                if y == capacity:
                    sequence[of] = places.total + rank[of]
                else:
                    sequence[of], offset[of] = places.find(int(y), rank[of])
            yield batch.assign(sequence_id=sequence, offset=offset)

    kinds = ", ".join(f"{n} {t}" for n, t in pieces.dtypes)
    return ranked.mapInPandas(place, f"{kinds}, sequence_id bigint, offset bigint")


def best_fit_packing(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """docs (doc_id, text) tokenised, cut and packed: one row per piece with its sequence and offset."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    return packed(materialized(tokenised(docs, path, capacity, end), "pieces"), capacity)


def op8_config_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, packed into sequences of at most 1024 ids."""
    return best_fit_packing(spark.read.parquet(f"{folder}/documents.parquet"))


def sequences(pieces: DataFrame, docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The real output: packed pieces with their token ids (an array), which the digest leaves out."""
    last = int(end).to_bytes(4, "little")

    def ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"].tolist(), batch["text"].tolist(), strict=True):
                x = np.frombuffer((encoder.encode(text) if text is not None else b"") + last, "<u4").astype(np.int32)
                rows += [(doc, k, x[s : s + n]) for k, (s, n) in enumerate(pieces_of(len(x), capacity))]
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "ids"])
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    held = docs.select("doc_id", "text").mapInPandas(ids, "doc_id bigint, piece int, ids array<int>")
    return pieces.join(held, ["doc_id", "piece"])


if sys.byteorder != "little":
    raise ImportError("token ids are hashed as little-endian bytes")
