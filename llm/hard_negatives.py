"""Hard negatives by exact inner products, scored with subset-sum tables (the method of the Four Russians).

Components become integers. Candidates are packed into chunks of `CHUNK` rows as bit planes: for each bit of
the two's complement and each group of eight dimensions one byte. For an anchor and a group, a table holds
the sums of the anchor's components over all 256 subsets of the group; a candidate's byte of a plane is an
index into it. Adding the groups' look-ups and shifting from plane to plane gives the whole inner product,
exactly. Tables are laid out by subset, so that one look-up serves all anchors of a block.

Anchors and chunks meet in a grid: each cell holds about `ANCHORS` anchors and `CHUNKS` chunks, anchors are sent
to every column and chunks to every row, so a task's memory does not depend on the number of either. A first
grid scores pairs of one label and keeps each anchor's best positives, a second one scores the other pairs and
keeps the best negatives of each positive's window; every pair is scored once.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part.
Shorter vectors are padded with zeros, an empty one scores 0. Rows with the same id are rows of their own: each
is an anchor if the id says so, and the others are its positives or negatives. Scores are exact within 64 bits
and taken modulo 2**64 beyond. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statbank.session import materialized

#: Rows of a chunk; anchors and chunks that a cell of the grid holds, about.
CHUNK, ANCHORS, CHUNKS = 2048, 512, 4
POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between this share of the positive's score and the whole of it.
PERCENT = 80
SCALE = 256
#: Scores that are summed up at once.
_STEP = 1 << 18
_CHUNK = "chunk bigint, ids binary, labels binary, planes binary, bits int, groups int"


def integers(vectors: list[np.ndarray]) -> np.ndarray:
    """floor(256 * x) of each component modulo 2**64, rows padded with zeros to a multiple of eight columns."""
    width = max((len(x) for x in vectors), default=0)
    out = np.zeros((len(vectors), -(-width // 8) * 8))
    for i, x in enumerate(vectors):
        out[i, : len(x)] = x
    huge = np.abs(out) >= 2.0**54  # these are whole numbers, and seldom any
    whole = np.floor(SCALE * np.where(huge, 0.0, out)).astype(np.int64)
    whole[huge] = np.array([SCALE * int(x) % (1 << 64) for x in out[huge]], np.uint64).view(np.int64)
    return whole


def bit_planes(x: np.ndarray) -> np.ndarray:
    """(planes, rows, groups) bytes of integers, from the lowest bit to the sign."""
    top = int(np.maximum(x, ~x).max(initial=0))
    bits = top.bit_length() + 1
    planes = [np.packbits((x >> b & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(bits)]
    return np.stack(planes)


def from_planes(planes: np.ndarray) -> np.ndarray:
    x = np.zeros((planes.shape[1], planes.shape[2] * 8), np.int64)
    for b, plane in enumerate(planes):
        bit = np.unpackbits(plane, axis=1, bitorder="little").astype(np.int64)
        x += (bit << b) if b < len(planes) - 1 else -(bit << b)
    return x


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): for each group of eight dimensions the sums over all subsets of it."""
    n, width = anchors.shape
    tables = np.zeros((width // 8, 256, n), kind)
    for g in range(width // 8):
        for k in range(8):
            tables[g, 1 << k : 2 << k] = tables[g, : 1 << k] + anchors[:, g * 8 + k].astype(kind)
    return tables


def looked_up(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products: look-ups summed over groups, shifted and added over planes."""
    groups, _, n = tables.shape
    total = np.zeros((planes.shape[1], n), tables.dtype)
    step = max(1, _STEP // max(1, n))
    for at in range(0, len(total), step):
        out = total[at : at + step]
        for b in range(len(planes) - 1, -1, -1):
            out += out
            for g in range(min(groups, planes.shape[2])):
                part = tables[g].take(planes[b, at : at + step, g], axis=0)
                if b == len(planes) - 1:  # the sign
                    out -= part
                else:
                    out += part
    return total


class Anchors:
    """Tables of some anchors; 32-bit ones where no sum can leave them."""

    def __init__(self, values: np.ndarray, bits: int):
        reach = int(np.abs(values.astype(float)).sum(axis=1).max(initial=0)) << bits
        self.tables = subset_sums(values, np.int32 if reach < 1 << 31 else np.int64)

    def scores(self, planes: np.ndarray) -> np.ndarray:
        return looked_up(self.tables, planes).astype(np.int64, copy=False)


def chunks_of(vectors: DataFrame, size: int = CHUNK) -> DataFrame:
    """vectors (vec_id, label, embedding) that take part, packed."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    good = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 30
        held: list[pd.DataFrame] = []

        def out(rows: pd.DataFrame) -> pd.DataFrame:
            nonlocal number
            planes = bit_planes(integers([np.asarray(x, float) for x in rows["embedding"]]))
            row = (number, rows["vec_id"].to_numpy(np.int64).tobytes(), rows["label"].to_numpy(np.int64).tobytes(), planes.tobytes(), planes.shape[0], planes.shape[2])
            number += 1
            return pd.DataFrame([row], columns=["chunk", "ids", "labels", "planes", "bits", "groups"])

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= size:
                rows = pd.concat(held)
                held = [rows.iloc[len(rows) // size * size :]]
                for at in range(0, len(rows) // size * size, size):
                    yield out(rows.iloc[at : at + size])
        rows = pd.concat(held) if held else pd.DataFrame()
        if len(rows):
            yield out(rows)

    named = good.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), F.col("embedding").cast("array<double>"))
    return named.mapInPandas(pack, _CHUNK)


class Chunk:
    """A chunk's rows in the order of their ids."""

    def __init__(self, chunk: int, ids: bytes, labels: bytes, planes: bytes, bits: int, groups: int):
        ids = np.frombuffer(ids, np.int64)
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], np.frombuffer(labels, np.int64)[order]
        self.rows = (int(chunk) << 12) + order
        self.planes = np.frombuffer(planes, np.uint8).reshape(bits, -1, groups)[:, order]


def anchors_of(chunks: DataFrame, every: int) -> DataFrame:
    """(row, anchor_id, label, vector) of the rows whose id is divisible by `every`."""

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                own = Chunk(*row)
                at = np.flatnonzero(own.ids % every == 0)
                vectors = from_planes(own.planes[:, at])
                yield pd.DataFrame({"row": own.rows[at], "anchor_id": own.ids[at], "label": own.labels[at], "vector": [x.tobytes() for x in vectors]})

    return chunks.mapInPandas(pick, "row bigint, anchor_id bigint, label bigint, vector binary")


def _grid(anchors: DataFrame, chunks: DataFrame, n_anchors: int, n_chunks: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the cells (_r, _c) that they go to."""
    rows, columns = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n_chunks // CHUNKS))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = anchors.withColumn("_r", F.pmod(F.xxhash64("row"), F.lit(rows)).cast("int")).withColumn("_c", every(columns))
    right = chunks.withColumn("_c", F.pmod(F.xxhash64("chunk"), F.lit(columns)).cast("int")).withColumn("_r", every(rows))
    return left, right


def _matrix(vectors: pd.Series) -> np.ndarray:
    vectors = [np.frombuffer(x, np.int64) for x in vectors]
    out = np.zeros((len(vectors), max(len(x) for x in vectors)), np.int64)
    for i, x in enumerate(vectors):
        out[i, : len(x)] = x
    return out


def _chunks(table: pd.DataFrame) -> list[Chunk]:
    return [Chunk(*row) for row in table[["chunk", "ids", "labels", "planes", "bits", "groups"]].itertuples(index=False)]


def _leading(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of each owner's first k, by score downwards and id upwards."""
    order = np.lexsort((ids, -score, owner))
    owner = owner[order]
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    place = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
    return order[place < k]


def positives_of(anchors: DataFrame, chunks: DataFrame, n_anchors: int, n_chunks: int, k: int) -> DataFrame:
    """(row, rank, positive_id, positive_score): each anchor's first k other rows of its label."""

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            vectors, label, row = _matrix(left["vector"]), left["label"].to_numpy(), left["row"].to_numpy()
            tables: dict[tuple[int, int], tuple[np.ndarray, Anchors]] = {}
            for own in _chunks(right):
                for value in np.unique(own.labels):
                    key = (int(value), len(own.planes))
                    if key not in tables:
                        mine = np.flatnonzero(label == value)
                        tables[key] = mine, Anchors(vectors[mine], len(own.planes))
                    mine, held = tables[key]
                    at = np.flatnonzero(own.labels == value)
                    if not len(mine):
                        continue
                    scores = held.scores(own.planes[:, at])
                    other = own.rows[at][:, None] != row[mine][None, :]
                    if len(at) > k + 1:  # what is below the k-th (and the anchor itself) cannot lead
                        least = np.partition(scores, len(at) - k - 1, axis=0)[len(at) - k - 1]
                        other &= scores >= least
                    i, j = np.nonzero(other)
                    kept = _leading(j, scores[i, j], own.ids[at][i], k)
                    found.append(pd.DataFrame({"row": row[mine][j[kept]], "positive_id": own.ids[at][i[kept]], "positive_score": scores[i, j][kept]}))
        return pd.concat(found) if found else pd.DataFrame({"row": [], "positive_id": [], "positive_score": []}, dtype="int64")

    left, right = _grid(anchors.select("row", "label", "vector"), chunks, n_anchors, n_chunks)
    found = left.groupBy("_r", "_c").cogroup(right.groupBy("_r", "_c")).applyInPandas(score, "row bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("row").orderBy(F.col("positive_score").desc(), "positive_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def negatives_of(anchors: DataFrame, chunks: DataFrame, n_anchors: int, n_chunks: int, k: int, percent: int) -> DataFrame:
    """anchors with `positives` (place, positive_id, positive_score) -> the first k negatives of each positive."""

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            vectors, label = _matrix(left["vector"]), left["label"].to_numpy()
            owner = np.repeat(np.arange(len(left)), [len(x) for x in left["positives"]])
            place = np.array([p["place"] for x in left["positives"] for p in x])
            high = np.array([p["positive_score"] for x in left["positives"] for p in x], np.int64)
            # 100 * negative >= percent * positive, in whole numbers
            low = np.array([-(-percent * int(p) // 100) for p in high], np.int64)
            least = np.full(len(left), np.iinfo(np.int64).max)
            np.minimum.at(least, owner, np.where(high >= 0, low, np.iinfo(np.int64).max))
            tables: dict[int, Anchors] = {}
            for own in _chunks(right):
                if len(own.planes) not in tables:
                    tables[len(own.planes)] = Anchors(vectors, len(own.planes))
                scores = tables[len(own.planes)].scores(own.planes)
                i, j = np.nonzero((scores >= least[None, :]) & (own.labels[:, None] != label[None, :]))
                order = np.lexsort((own.ids[i], -scores[i, j], j))
                i, j = i[order], j[order]
                value = scores[i, j]
                begins = np.searchsorted(j, np.arange(len(left) + 1))
                for q, a in enumerate(owner.tolist()):
                    own_values = value[begins[a] : begins[a + 1]]
                    first = int(np.searchsorted(-own_values, -high[q]))
                    last = min(first + k, int(np.searchsorted(-own_values, -low[q], side="right")))
                    for n in range(begins[a] + first, begins[a] + last):
                        found.append((a, place[q], own.ids[i[n]], value[n]))
        out = pd.DataFrame(found, columns=["at", "place", "negative_id", "negative_score"])
        row = left["row"].to_numpy()[out["at"].to_numpy(int)] if len(out) else np.zeros(0, np.int64)
        return out.assign(row=row)[["row", "place", "negative_id", "negative_score"]]

    left, right = _grid(anchors.select("row", "label", "vector", "positives"), chunks, n_anchors, n_chunks)
    found = left.groupBy("_r", "_c").cogroup(right.groupBy("_r", "_c")).applyInPandas(score, "row bigint, place int, negative_id bigint, negative_score bigint")
    order = Window.partitionBy("row", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = PERCENT) -> DataFrame:
    """vectors (vec_id, label, embedding) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by `every`.
    """
    chunks = materialized(chunks_of(vectors), "chunks")
    anchors = materialized(anchors_of(chunks, every), "anchors")
    n_anchors, n_chunks = anchors.count(), chunks.count()
    best = materialized(positives_of(anchors, chunks, n_anchors, n_chunks, positives), "positives")
    listed = best.groupBy("row").agg(F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("positives"))
    asked = anchors.join(listed, "row")
    found = negatives_of(asked, chunks, n_anchors, n_chunks, negatives, percent)
    named = found.join(best, ["row", "place"]).join(anchors.select("row", "anchor_id"), "row")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every anchor, some labels being moved on first."""
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"))


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r, a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
    CAST(list_dot_product(a.q, c.q) AS BIGINT) AS score
  FROM v a, v c WHERE a.vec_id % 100 = 0 AND a.r <> c.r
), p AS (
  SELECT r, anchor_id, other_id AS positive_id, score AS positive_score, place FROM (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, other_id) AS place FROM s WHERE same) WHERE place <= 5
), n AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.r, place ORDER BY s.score DESC, s.other_id) AS rank
  FROM p JOIN s ON s.r = p.r AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
