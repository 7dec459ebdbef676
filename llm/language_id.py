"""Language identification: a bidirectional gated recurrent network over the bytes of a text.

A text is cut into segments of `STEPS` bytes. In each segment one gated recurrent layer reads forwards
and one backwards; every byte gets a probability for each language from both states, and a document's
probability is the mean over all of its bytes. Gates are piecewise linear and the candidate state is a
softsign, which keeps a pass over the corpus cheap. Training is backpropagation through time in numpy
over a bounded sample of labelled rows (`SAMPLE`), with the same segments; everything after it covers
every byte of every text.

Defined results: a null text, or one without a letter, is `und` with score 0. Without labelled rows
every text is `und`. A row without doc_id is predicted, never learned from and not held out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.sampling import bounded_sample
from llm.words import chunks
from statbank.session import materialized

UNKNOWN = "und"
HIDDEN, STEPS = 8, 96
#: Labelled rows to learn from, segments taken of each, passes over them.
SAMPLE, SEGMENTS, EPOCHS = 5_000, 3, 5
#: Share of a text's trigrams that texts of the learned languages hold, and the part of a sample that may have less.
FAMILIAR, REFUSED = 0.5, 0.001
_BATCH, _BLOCK = 256, 2048
_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def segments(raw: Sequence[bytes], steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of each segment, its length, the text it belongs to)."""
    sizes = np.array([len(x) for x in raw], np.int64)
    count = -(-sizes // steps)
    owner = np.repeat(np.arange(len(raw)), count)
    first = np.repeat(np.cumsum(count) - count, count)
    length = np.minimum(sizes[owner] - (np.arange(len(owner)) - first) * steps, steps)
    padded = b"".join(x + bytes(-len(x) % steps) for x in raw)
    return np.frombuffer(padded, np.uint8).reshape(-1, steps), length, owner


@dataclass
class Layer:
    """One direction: input weights by byte (gate, candidate), recurrent weights."""

    table: np.ndarray  # (3 H, 256)
    gates: np.ndarray  # (2 H, H)
    cand: np.ndarray  # (H, H)

    @staticmethod
    def random(rng: np.random.Generator, hidden: int) -> Layer:
        f = np.float32
        table = rng.normal(0, 0.5, (3 * hidden, 256)).astype(f)
        table[:hidden] -= 1  # states change slowly at first
        return Layer(table, rng.normal(0, 0.3, (2 * hidden, hidden)).astype(f), rng.normal(0, 0.5, (hidden, hidden)).astype(f))

    def run(self, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """x, mask (T, N) in reading order -> states (T, H, N); what learning needs goes to `keep`."""
        n_h = len(self.cand)
        h = np.zeros((n_h, x.shape[1]), np.float32)
        out = np.empty((len(x), n_h, x.shape[1]), np.float32)
        for t in range(len(x)):
            a = self.table[:, x[t]]
            g = self.gates @ h
            g += a[: 2 * n_h]
            g *= 0.25
            g += 0.5
            np.clip(g, 0, 1, out=g)
            z, r = g[:n_h], g[n_h:]
            rh = r * h
            c = self.cand @ rh
            c += a[2 * n_h :]
            n = np.abs(c)
            n += 1
            np.divide(c, n, out=n)
            if keep is not None:
                keep.append((g, rh, n, h))
            h = n - h if keep is not None else np.subtract(n, h, out=c)
            h *= z
            h += out[t - 1] if t else 0
            h *= mask[t]
            out[t] = h
            h = out[t]
        return out

    def back(self, x: np.ndarray, mask: np.ndarray, keep: list, d_out: np.ndarray) -> Layer:
        """Gradients of the weights, given those of the states."""
        n_h = len(self.cand)
        d_a = np.empty((len(x), 3 * n_h, x.shape[1]), np.float32)
        d_gates, d_cand = np.zeros_like(self.gates), np.zeros_like(self.cand)
        d_h = np.zeros_like(d_out[0])
        for t in range(len(x) - 1, -1, -1):
            g, rh, n, before = keep[t]
            d_h = (d_h + d_out[t]) * mask[t]
            z, r = g[:n_h], g[n_h:]
            d_c = d_h * z * (1 - np.abs(n)) ** 2
            d_rh = self.cand.T @ d_c
            d_g = np.concatenate([d_h * (n - before), d_rh * before]) * (0.25 * ((g > 0) & (g < 1)))
            d_cand += d_c @ rh.T
            d_gates += d_g @ before.T
            d_a[t, : 2 * n_h], d_a[t, 2 * n_h :] = d_g, d_c
            d_h = d_h * (1 - z) + d_rh * r + self.gates.T @ d_g
        flat, at = d_a.transpose(1, 0, 2).reshape(3 * n_h, -1), x.reshape(-1)
        table = np.stack([np.bincount(at, row, 256) for row in flat]).astype(np.float32)
        return Layer(table, d_gates, d_cand)


class Network:
    def __init__(self, langs: Sequence[str], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.langs, self.steps = list(langs), steps
        self.ahead, self.behind = Layer.random(rng, hidden), Layer.random(rng, hidden)
        self.out = rng.normal(0, 0.3, (len(self.langs), 2 * hidden)).astype(np.float32)
        self.bias = np.zeros((len(self.langs), 1), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [*vars(self.ahead).values(), *vars(self.behind).values(), self.out, self.bias]

    def probabilities(self, x: np.ndarray, mask: np.ndarray, keeps: tuple[list, list] | tuple[None, None] = (None, None)):
        """x, mask (T, N) -> language probabilities at each byte (T, L, N), and the states."""
        f = self.ahead.run(x, mask, keeps[0])
        b = self.behind.run(x[::-1], mask[::-1], keeps[1])[::-1]
        n_h = f.shape[1]
        p = np.matmul(self.out[:, :n_h], f)
        p += np.matmul(self.out[:, n_h:], b)
        p += self.bias
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p, f, b

    def learn(self, x: np.ndarray, length: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.02, seed: int = 5) -> None:
        """Adam on the mean cross-entropy over all bytes. x (segments, T), y the language of each segment."""
        rng = np.random.default_rng(seed)
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights()]
        n_h, step = len(self.ahead.cand), 0
        total = max(1, epochs * -(-len(x) // _BATCH))
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), _BATCH):
                own = order[at : at + _BATCH]
                xs = np.ascontiguousarray(x[own].T)
                mask = (np.arange(self.steps)[:, None] < length[own]).astype(np.float32)
                keeps: tuple[list, list] = ([], [])
                p, f, b = self.probabilities(xs, mask, keeps)
                p[:, y[own], np.arange(len(own))] -= 1
                p *= (mask / mask.sum())[:, None]
                d_out = np.concatenate([np.einsum("tln,thn->lh", p, f), np.einsum("tln,thn->lh", p, b)], axis=1)
                d_f = np.matmul(self.out[:, :n_h].T, p)
                d_b = np.matmul(self.out[:, n_h:].T, p)[::-1]
                ahead = self.ahead.back(xs, mask, keeps[0], d_f)
                behind = self.behind.back(xs[::-1], mask[::-1], keeps[1], d_b)
                grads = [*vars(ahead).values(), *vars(behind).values(), d_out, p.sum(axis=(0, 2))[:, None]]
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
                step += 1
                now = rate * min(1.0, 2 * (1 - (step - 1) / total))
                for w, g, (m, v) in zip(self.weights(), grads, moments, strict=True):
                    g = g * min(1.0, 1 / max(norm, 1e-9))
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)

    def pooled(self, raw: Sequence[bytes]) -> np.ndarray:
        """Mean language probabilities of each text over all of its bytes (0 without any)."""
        x, length, owner = segments(raw, self.steps)
        sums = np.zeros((len(x), len(self.langs)))
        for at in range(0, len(x), _BLOCK):
            own = np.ascontiguousarray(x[at : at + _BLOCK].T)
            mask = (np.arange(self.steps)[:, None] < length[at : at + _BLOCK]).astype(np.float32)
            p, _, _ = self.probabilities(own, mask)
            sums[at : at + _BLOCK] = np.einsum("tln,tn->nl", p, mask)
        pooled = np.stack([np.bincount(owner, s, len(raw)) for s in sums.T], axis=1)
        return pooled / np.maximum(1, [len(r) for r in raw])[:, None]


def trained(rows: DataFrame, sample: int = SAMPLE, hidden: int = HIDDEN, steps: int = STEPS, epochs: int = EPOCHS) -> Network:
    """A network from labelled rows (doc_id, text, lang), of which at most `sample` are used."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")).select("doc_id", "text", "lang")
    rows = bounded_sample(rows, ["doc_id", "lang", "text"], sample)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Segments from evenly spaced places, so that long texts bring no more than short ones."""
        for batch in batches:
            out = []
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                for k in range(min(SEGMENTS, -(-len(raw) // steps))):
                    at = k * max(0, len(raw) - steps) // max(1, SEGMENTS - 1)
                    out.append((raw[at : at + steps], lang))
            yield pd.DataFrame(out, columns=["raw", "lang"])

    got = rows.select("text", "lang").mapInPandas(cut, "raw binary, lang string").toPandas()  # at most sample * SEGMENTS * steps bytes
    got = got.sort_values(["lang", "raw"], ignore_index=True)
    langs = sorted(set(got["lang"]))
    network = Network(langs, hidden, steps)
    if langs:
        x, length, owner = segments(got["raw"].tolist(), steps)
        network.learn(x, length, got["lang"].map({k: i for i, k in enumerate(langs)}).to_numpy()[owner], epochs)
    return network


@dataclass
class Familiar:
    """Byte trigrams of a labelled sample, as 2^24 bits, and the share of a text's trigrams that must be among them."""

    bits: np.ndarray
    least: float

    def share(self, text: str) -> float:
        return float((self.bits[(at := trigrams(text)) >> 3] >> (at & 7) & 1).mean()) if len(text) > 2 else 1.0


def trigrams(text: str) -> np.ndarray:
    """The numbers of the lower-cased text's byte trigrams, one for each place."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
    return (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:] if len(raw) > 2 else raw[:0]


def labelled_sample(rows: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most `sample` labelled rows (doc_id, text, lang), written."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")).select("doc_id", "text", "lang")
    return materialized(bounded_sample(rows, ["doc_id", "lang", "text"], sample), "labelled")


def familiar(sample: DataFrame, most: float = FAMILIAR, refused: float = REFUSED) -> Familiar:
    """What texts of the learned languages look like, from a bounded sample (text): trigrams of two texts or more.
    The share asked for is `most`, or what all but the part `refused` of the sample have in the others' trigrams."""

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros(1 << 24, np.int32)
        for batch in batches:
            for text in batch["text"]:
                count[np.unique(trigrams(text))] += 1
        at = np.flatnonzero(count)
        yield pd.DataFrame({"gram": at.astype(np.int32), "n": count[at]})

    grams = sample.select("text").mapInPandas(seen, "gram int, n int").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").toPandas()  # 2^24 rows at most

    def bits(least: int) -> np.ndarray:
        known = np.zeros(1 << 24, bool)
        known[grams["gram"][grams["n"] >= least].to_numpy(np.int64)] = True
        return np.packbits(known, bitorder="little")

    others = Familiar(bits(3), 0.0)  # its own text is one of the three

    def shares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"share": [others.share(t) for t in batch["text"]]}, dtype=float)

    got = sample.select("text").mapInPandas(shares, "share double").toPandas()["share"]
    return Familiar(bits(2), min(most, float(got.quantile(refused, interpolation="lower"))) if len(got) else 0.0)


def predicted(network: Network, texts: Sequence[str | None]) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """(first row, languages, scores) of consecutive texts."""
    for first, raw in chunks(texts):
        known = np.array([bool(network.langs) and t is not None and bool(_LETTER.search(t)) for t in texts[first : first + len(raw)]])
        best, score = np.zeros(len(raw), np.int64), np.zeros(len(raw))
        if known.any():
            p = network.pooled(raw)
            best, score = p.argmax(axis=1), np.clip(p.max(axis=1), 0, 1)
        yield first, [network.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, score, 0.0)


def in_known_language(docs: DataFrame, network: Network, least: float, alike: Familiar | None = None) -> DataFrame:
    """The rows of docs, with all their columns, whose language is known with at least this score and, with
    `alike`, whose text looks like texts of the learned languages."""

    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch.tolist()
            kept = [k != UNKNOWN and s >= least for _, names, score in predicted(network, texts) for k, s in zip(names, score, strict=True)]
            yield pd.Series([k and (alike is None or alike.share(t) >= alike.least) for k, t in zip(kept, texts, strict=True)], dtype=bool)

    return docs.where(F.pandas_udf(known, "boolean", F.PandasUDFType.SCALAR_ITER)("text"))


def languages(docs: DataFrame, network: Network) -> DataFrame:
    """docs (doc_id, text) -> doc_id, lang_pred, score: the most probable language and its probability."""

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["doc_id"].astype("Int64")
            for first, names, score in predicted(network, batch["text"].tolist()):
                own = ids.iloc[first : first + len(names)].reset_index(drop=True)
                yield pd.DataFrame({"doc_id": own, "lang_pred": names, "score": score})

    return docs.select("doc_id", "text").mapInPandas(label, "doc_id bigint, lang_pred string, score double")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's language, learned from documents that are not held out."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    network = trained(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    return languages(docs, network).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
