"""Near-duplicate documents by circulant MinHash, confirmed by exact Jaccard similarity.

Two permutations make every signature: the first scatters a shingle over `SLOTS` slots, the second
is one random order of the slots. Coordinate k of a signature is the least value of the second
permutation, circularly shifted by k, over the shingles' slots; so a shingle contributes one
contiguous window of the second permutation to all coordinates at once. Coordinates are cut into
`BANDS` bands of `ROWS`; documents with an equal band are candidates. At similarity 0.85 a pair
misses all bands with probability 1e-7.

Documents with equal shingle sets are one class from the start. Members of a bucket are joined with
the bucket's least member only, and the connected components of these joins are families: two linked
documents are always in one family. A family of at most `FAMILY` members is settled in one task on full
sets: from a member the search compares it with all members not yet reached, at once, so a group of
copies costs about one comparison a member and no list of pairs is made.

Larger families are settled by joins, bucket by bucket: the members outside a bucket's commonest
component are its pivots in turn, `PIVOTS` a round; a pivot is compared with all members of other
components and then leaves, so the search ends with every pair refuted or joined, and no bucket,
component or set of ids is collected in one task or on the driver.

Defined results: a null or wordless text has no shingles, is linked with nothing and is kept. With
fewer than `k` words the whole sequence is one shingle. A row without doc_id is linked with nothing:
component_id is null and it is kept. Rows that share a doc_id are one node. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.components import components, families
from llm.words import CHUNK_BYTES, Words, chunks, mixed
from statbank.session import discard, materialized

SHINGLE, PERCENT = 5, 85
BANDS, ROWS, SLOT_BITS = 50, 8, 16
#: Members of a family that one task settles; pivots of a bucket in each round over larger families.
FAMILY, PIVOTS = 6_000, 8
_STEP = 1024


class Circulant:
    """Signatures of shingle sets from two permutations."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, bits: int = SLOT_BITS, seed: int = 7):
        self.bands, self.rows, self.shift = bands, rows, np.uint64(64 - bits)
        order = np.random.default_rng(seed).permutation(1 << bits).astype(np.uint16 if bits <= 16 else np.uint32)
        k = bands * rows
        #: row s holds the second permutation at slots s, s + 1, ..., s + k - 1, going round at the end
        self.windows = sliding_window_view(np.concatenate([order, order[: k - 1]]), k)
        self.weights = mixed(np.arange(1, rows + 1, dtype=np.uint64))
        self.band_ids = mixed(np.arange(bands, dtype=np.uint64) + np.uint64(1 << 40))

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        slots = (mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)) >> self.shift).astype(np.int64)
        parts = [self.windows[slots[i : i + _STEP]].min(axis=0) for i in range(0, len(slots), _STEP)]
        return parts[0] if len(parts) == 1 else np.min(parts, axis=0)

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        rows = self.signature(shingles).reshape(self.bands, self.rows).astype(np.uint64) + np.uint64(1)
        return mixed(mixed(rows * self.weights).sum(axis=1, dtype=np.uint64) ^ self.band_ids).view(np.int64)


def shingle_sets(raw: list[bytes], k: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(raw)
    hashes, bounds = words.windows(k)
    for i in range(len(raw)):
        a, b = bounds[i], bounds[i + 1]
        if b > a:
            yield np.unique(hashes[a:b])
        else:
            own = words.hashes[words.bounds[i] : words.bounds[i + 1]]
            yield mixed(np.array([int(hashlib.blake2b(own.tobytes(), digest_size=8).hexdigest(), 16)], np.uint64)) if len(own) else own


def signatures(docs: DataFrame, k: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, digest of the set (null if empty), band keys (null if empty)."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Circulant(bands, rows)
        for batch in batches:
            ids = batch["doc_id"].astype("Int64")
            for first, raw in chunks(batch["text"].tolist()):
                counts, digests, keys = [], [], []
                for held in shingle_sets(raw, k):
                    counts.append(len(held))
                    digests.append(hashlib.blake2b(held.tobytes(), digest_size=16).digest() if len(held) else None)
                    keys.append(hasher.keys(held) if len(held) else None)
                own = ids.iloc[first : first + len(raw)].reset_index(drop=True)
                yield pd.DataFrame({"doc_id": own, "n_shingles": np.array(counts, np.int64), "digest": digests, "bands": keys})

    return docs.select("doc_id", "text").mapInPandas(sign, "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>")


def _sizes_allow(a: Column, b: Column, percent: int) -> Column:
    """Sets of these sizes can reach the similarity."""
    return F.least(a, b) * 100 >= percent * F.greatest(a, b)


def packed_texts(docs: DataFrame) -> DataFrame:
    """docs (id, family, size, text) with the text deflated: what goes through the joins."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(text=[zlib.compress(x.encode("utf-8", "surrogatepass"), 1) for x in batch["text"]])

    return docs.select("id", "family", "size", "text").mapInPandas(pack, "id bigint, family bigint, size bigint, text binary")


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """pairs (a, b) whose full shingle sets reach the similarity; texts (id, text deflated)."""
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    both = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                # Neighbours share a pivot's text; equal texts are hashed once.
                known = {x: None for x in [*part["ta"], *part["tb"]]}
                known = dict(zip(known, _sets_of([zlib.decompress(x) for x in known], k), strict=True))
                good = []
                for x, y in zip(part["ta"], part["tb"], strict=True):
                    x, y = known[x], known[y]
                    both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                    good.append(100 * both >= percent * (len(x) + len(y) - both))
                yield part.loc[good, ["a", "b"]]

    return both.mapInPandas(compare, "a bigint, b bigint").distinct()


def settled(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the first set that its links reach, itself included (as positions in the list)."""
    sizes = np.array([len(x) for x in sets])
    reached = np.full(len(sets), -1)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    marks = np.zeros(int(ids.max()) + 1, np.int32)
    left, flat, starts = np.arange(len(sets)), ids, bounds[:-1]
    for first in range(len(sets)):
        if reached[first] >= 0:
            continue
        reached[first] = first
        queue = [first]
        while queue:
            at = queue.pop()
            open_now = reached[left] < 0
            if not open_now.any():
                break
            if open_now.sum() * 2 < len(left):  # forget sets that were reached
                left = left[open_now]
                flat = np.concatenate([ids[bounds[i] : bounds[i + 1]] for i in left.tolist()])
                starts = np.concatenate([[0], np.cumsum(sizes[left])[:-1]])
                open_now = np.ones(len(left), bool)
            own = ids[bounds[at] : bounds[at + 1]]
            marks[own] = 1
            both = np.add.reduceat(marks[flat], starts)
            marks[own] = 0
            linked = left[open_now & (100 * both >= percent * (sizes[at] + sizes[left] - both))]
            reached[linked] = first
            queue += linked.tolist()
    return reached.tolist()


def _sets_of(raws: list[bytes], k: int) -> list[np.ndarray]:
    out, held, size = [], [], 0
    for raw in raws:
        held.append(raw)
        size += len(raw)
        if size > CHUNK_BYTES:
            out += shingle_sets(held, k)
            held, size = [], 0
    return out + list(shingle_sets(held, k)) if held else out


def _families_settled(members: DataFrame, k: int, percent: int) -> DataFrame:
    """members (family, id, text deflated), each family in one task and in a row -> (node, component)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, bytes]] = []
        family, out = None, []

        def settle() -> None:
            held.sort()
            found = settled(_sets_of([zlib.decompress(text) for _, text in held], k), percent)
            least = {f: held[f][0] for f in found}
            # Texts of one id are one node: what they reach is one component.
            while True:
                own: dict[int, int] = {}
                for (node, _), f in zip(held, found, strict=True):
                    own[node] = min(own.get(node, node), least[f])
                lower = dict(least)
                for (node, _), f in zip(held, found, strict=True):
                    lower[f] = min(lower[f], own[node])
                if lower == least:
                    break
                least = lower
            out.extend(own.items())
            held.clear()

        for batch in batches:
            for own, node, text in zip(batch["family"].tolist(), batch["id"].tolist(), batch["text"], strict=True):
                if own != family and held:
                    settle()
                family = own
                held.append((node, text))
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["node", "component"])
                out.clear()
        if held:
            settle()
        yield pd.DataFrame(out, columns=["node", "component"])

    return members.mapInPandas(run, "node bigint, component bigint")


def _by_rounds(live: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame | None:
    """live (key, rep, n) of large families -> (node, component) of the linked nodes; None if there are none."""
    labels, links = None, None
    while True:
        if labels is None:
            now = live.withColumn("comp", F.col("rep"))
        else:
            now = live.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
            now = now.select("key", "rep", "n", F.coalesce("component", "rep").alias("comp"))
        # In the first round every member is a component of its own, and the least one is the pivot.
        counts = now.groupBy("key", "comp").agg(F.count("*").alias("c")) if labels is not None else now.select("key", "comp", F.lit(1).alias("c"))
        main = counts.groupBy("key").agg(F.count("*").alias("comps"), F.max(F.struct("c", F.negative("comp").alias("x"))).alias("m"))
        main = main.where("comps > 1").select("key", F.negative("m.x").alias("main"))
        now = materialized(now.join(main, "key"), "open")
        if now.isEmpty():
            return labels
        first = labels is None and links is None
        outside = now.where("rep = comp AND comp = main") if first else now.where("comp <> main")
        pivots = outside.groupBy("key", F.pmod(F.xxhash64("rep"), F.lit(PIVOTS)).alias("salt")).agg(F.min(F.struct("rep", "n", "comp")).alias("p"))
        pivots = pivots.select("key", F.col("p.rep").alias("b"), F.col("p.n").alias("nb"), F.col("p.comp").alias("cb"))
        pairs = now.join(pivots, "key").where((F.col("comp") != F.col("cb")) & _sizes_allow(F.col("n"), F.col("nb"), percent))
        pairs = materialized(pairs.select(F.least("rep", "b").alias("b"), F.greatest("rep", "b").alias("a")).distinct(), "pairs")
        new = materialized(confirmed(pairs, texts, k, percent), "links")
        links = new if links is None else links.unionByName(new)
        if not new.isEmpty():
            labels = components(links)
        live = now.join(pivots.select("key", F.col("b").alias("rep")), ["key", "rep"], "left_anti").select("key", "rep", "n")


def linked_components(classes: DataFrame, docs: DataFrame, k: int, percent: int, family: int = FAMILY) -> DataFrame:
    """classes (rep, n, bands): (node, component) of every class that shares a bucket with another one."""
    bands = materialized(classes.select("rep", "n", F.explode("bands").alias("key")), "bands")
    # Written, so that the join below meets two plain exchanges and a hot bucket's partition can be split.
    shared = bands.groupBy("key").agg(F.count("*").alias("size"), F.min("rep").alias("least")).where("size > 1").select("key", "least")
    shared = materialized(shared, "shared")
    live = materialized(bands.join(shared, "key"), "buckets")
    discard(bands, shared)
    grouped = families(live.select("key", F.col("rep").alias("node"), "least")).select(F.col("node").alias("id"), "family")
    sizes = grouped.groupBy("family").agg(F.count("*").alias("size"))
    grouped = materialized(grouped.join(sizes, "family"), "families")
    needed = grouped.select(F.col("id").alias("doc_id"), "family", "size")
    found = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(needed, "doc_id")
    texts = materialized(packed_texts(found.select(F.col("doc_id").alias("id"), "family", "size", "text")), "texts")
    parts = max(4, int(grouped.count()) // 2_000)
    members = texts.where(F.col("size") <= family).repartition(parts, "family").sortWithinPartitions("family")
    out = _families_settled(members.select("family", "id", "text"), k, percent)
    large = grouped.where(F.col("size") > family).select(F.col("id").alias("rep"))
    if large.isEmpty():
        return materialized(out, "settled")
    slow = _by_rounds(live.select("key", "rep", "n").join(large, "rep"), texts.select("id", "text"), k, percent)
    return materialized(out if slow is None else out.unionByName(slow), "settled")


def near_duplicates(
    docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, family: int = FAMILY
) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, component_id, kept: one row per row of docs."""
    signed = materialized(signatures(docs, k, bands, rows), "signatures")
    sets = signed.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = sets.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("x"))
    classes = materialized(
        classes.select("digest", F.col("x.doc_id").alias("rep"), F.col("x.n_shingles").alias("n"), F.col("x.bands").alias("bands")), "classes"
    )
    labels = linked_components(classes.select("rep", "n", "bands"), docs, k, percent, family)
    named = signed.select("doc_id", "n_shingles", "digest").join(classes.select("digest", "rep"), "digest", "left")
    named = named.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
    least = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return named.select("doc_id", "n_shingles", least.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def op3_circulant_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the smallest doc_id that its links reach."""
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
