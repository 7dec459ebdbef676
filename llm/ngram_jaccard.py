"""Exact n-gram Jaccard join: a size-aware split into small (light) and large (heavy) sets.

Documents with equal shingle sets are one class. Of two sets of a and b shingles that link, at least
t(a, b) shingles are common, which depends on the sizes alone.

Small sets, of at most x shingles, list all their subsets of exactly t(a, b) shingles for every partner
size b: two small sets link exactly if one subset is in both lists, so members of a subset are joined
with its least one and nothing has to be compared.

Large sets, above x, go through inverted lists. Shingles are ordered from the rarest on; a set's prefix is
short, yet the prefixes of two sets that link meet. Shingle frequencies are counted exactly: blocks of texts
send their distinct hashes, by ranges and as gaps, and get counts back. Shingles of one document alone have no
list, so most documents have none at all. Sets that meet in a list are of one family; lists are contracted to
their least members before components are sought. A family's sets are cut into tiles of bounded size, and
each pair of its tiles (or its only tile) is settled in one task: from a set the search scans the inverted
lists of its shingles, counts overlaps with all sets not yet reached, and so finds the full Jaccard
similarity. What leaves the task is one link for each set that reaches an earlier one.

The boundary x is the size at which the cost of subsets exceeds that of lists and scans, by the histogram of
small sizes.

Defined results: a null or wordless text has no shingles and is linked with nothing. With fewer than `k`
words the whole sequence is one shingle. A row without doc_id is linked with nothing and has no component.
Rows that share a doc_id are one node. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.circulant_minhash import shingle_sets
from llm.components import components, families, stars
from llm.words import chunks
from statbank.session import discard, materialized

SHINGLE, PERCENT = 4, 85
#: No set above this size is small: from here on subsets cost more at any histogram.
SMALL_LIMIT = 32
#: Bytes of text in a block, shingles that a range counts, and shingles of a tile, about.
BLOCK_BYTES, RANGE_SHINGLES, TILE_SHINGLES = 4 << 20, 2_000_000, 500_000
#: Tasks that pairs of tiles are dealt to; each settles one pair after the other.
MOST_PARTS = 20_000
_COMMON = 255
_BLOCK = (
    "block bigint, docs array<bigint>, sizes array<bigint>, digests array<binary>, small array<array<bigint>>, "
    "lengths array<bigint>, text binary, hashes array<binary>, counts array<binary>"
)


def overlap(a: int, b: int, percent: int) -> int:
    """Common shingles that sets of these sizes need."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n + 1 + -percent * n // 100


def partner_sizes(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def boundary(counts: dict[int, int], percent: int) -> int:
    """The largest small size that costs least; counts: classes of each size up to SMALL_LIMIT."""

    def cost(x: int) -> int:
        subsets = sum(n * math.comb(a, overlap(a, b, percent)) for a, n in counts.items() if a <= x for b in partner_sizes(a, percent) if b <= x)
        lists = sum(n * (a + prefix_length(a, percent)) for a, n in counts.items() if 100 * a >= percent * (x + 1))
        return subsets + lists

    return min(range(SMALL_LIMIT + 1), key=cost)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane, so that high zero bytes cost nothing."""
    pack = zlib.compressobj(1, zlib.DEFLATED, 15, 9, zlib.Z_RLE)
    return pack.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)) + pack.flush()


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _in_gaps(x: np.ndarray) -> bytes:
    return _packed(np.diff(x, prepend=np.uint64(0)))


def _from_gaps(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw, np.uint64), dtype=np.uint64)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def blocks_of(docs: DataFrame, k: int, bits: int, ranges: int, limit: int = BLOCK_BYTES) -> DataFrame:
    """docs (doc_id, text) packed into blocks: ids, set sizes, digests, the shingles of small sets, the texts of
    different sets, and the block's distinct shingles (the first `bits` of their hashes) with counts, by range."""
    shift = np.uint64(64 - bits)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        ids, sizes, digests, small, texts, short, known, size = [], [], [], [], [], [], {}, 0

        def out() -> pd.DataFrame:
            nonlocal number, size
            found, counts = np.unique(np.concatenate(short) if short else np.zeros(0, np.uint64), return_counts=True)
            cuts = np.searchsorted(_range_of(found, bits, ranges), np.arange(ranges + 1))
            spans = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            row = (
                number, list(ids), list(sizes), list(digests), list(small), [len(x) for x in texts], zlib.compress(b"".join(texts), 1),
                [_in_gaps(found[s]) for s in spans], [_packed(np.minimum(counts[s], _COMMON).astype(np.uint8)) for s in spans],
            )
            number, size = number + 1, 0
            for x in (ids, sizes, digests, small, texts, short, known):
                x.clear()
            return pd.DataFrame([row], columns=["block", "docs", "sizes", "digests", "small", "lengths", "text", "hashes", "counts"])

        for batch in batches:
            own_ids = [None if pd.isna(x) else int(x) for x in batch["doc_id"]]
            for first, raw in chunks(batch["text"].tolist()):
                for i, shingles in enumerate(shingle_sets(raw, k)):
                    own = own_ids[first + i]
                    digest = _digest(shingles) if len(shingles) and own is not None else None
                    ids.append(own)
                    sizes.append(len(shingles))
                    digests.append(digest)
                    small.append(shingles.view(np.int64).tolist() if digest is not None and len(shingles) <= SMALL_LIMIT else None)
                    # Of equal sets in a block the text of the least id stands for all.
                    if digest is None or known.get(digest, (math.inf,))[0] <= own:
                        texts.append(b"")
                    else:
                        if digest in known:
                            texts[known[digest][1]] = b""
                        else:
                            short.append(shingles >> shift)
                        known[digest] = own, len(texts)
                        texts.append(raw[i])
                        size += len(raw[i])
                if size > limit or len(ids) > 100_000:
                    yield out()
        if ids:
            yield out()

    return docs.select("doc_id", "text").mapInPandas(pack, _BLOCK)


def _range_of(short: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Equal ranges of the first 32 bits, in the order of the hashes."""
    return (short >> np.uint64(bits - 32)).astype(np.int64) * ranges >> 32


def frequencies(blocks: DataFrame) -> DataFrame:
    """(block, range, counts): in how many different sets each shingle of a block's message occurs, 255 at most."""
    asked = blocks.select("block", F.posexplode(F.arrays_zip("hashes", "counts")).alias("range", "x")).select("range", "block", "x.hashes", "x.counts")

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        hashes = [_from_gaps(x) for x in part["hashes"]]
        counts = np.concatenate([_unpacked(x, np.uint8) for x in part["counts"]])
        _, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.minimum(np.bincount(place, counts), _COMMON).astype(np.uint8) if len(place) else counts
        ends = np.cumsum([len(x) for x in hashes])
        return pd.DataFrame({"block": part["block"], "range": part["range"], "counts": [_packed(total[place[a : a + len(h)]]) for a, h in zip(ends - [len(x) for x in hashes], hashes, strict=True)]})

    return asked.groupBy("range").applyInPandas(answer, "block bigint, range int, counts binary")


def prefixes(blocks: DataFrame, answers: DataFrame, k: int, bits: int, least: int, percent: int) -> DataFrame:
    """(doc_id, digest, n, tokens, shingles) of sets with at least `least` shingles of which one in the prefix is not alone."""
    shift = np.uint64(64 - bits)

    def take(_, block: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        answer = answer.sort_values("range")
        out = []
        for row in block.itertuples(index=False):
            common = np.concatenate([_unpacked(x, np.uint8) for x in answer["counts"]])
            body, ends = zlib.decompress(row.text), np.cumsum(row.lengths)
            use = [i for i, n in enumerate(row.lengths) if n]
            texts = [body[ends[i] - row.lengths[i] : ends[i]].decode("utf-8", "surrogatepass") for i in use]
            sets = [x for _, raw in chunks(texts) for x in shingle_sets(raw, k)]
            # The block's message again: counts are in its order.
            hashes = np.unique(np.concatenate(sets) >> shift) if sets else np.zeros(0, np.uint64)
            for i, shingles in zip(use, sets, strict=True):
                if len(shingles) < least:
                    continue
                often = common[np.searchsorted(hashes, shingles >> shift)].astype(np.uint64)
                prefix = np.sort(often << np.uint64(56) | shingles >> np.uint64(8))[: prefix_length(len(shingles), percent)]
                tokens = prefix[prefix >= np.uint64(2 << 56)]
                if len(tokens):
                    out.append((row.docs[i], row.digests[i], len(shingles), tokens.view(np.int64).tolist(), shingles.tobytes()))
        return pd.DataFrame(out, columns=["doc_id", "digest", "n", "tokens", "shingles"])

    left = blocks.select("block", "docs", "digests", "lengths", "text")
    return left.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(take, "doc_id bigint, digest binary, n bigint, tokens array<bigint>, shingles binary")


def subset_links(classes: DataFrame, largest: int, percent: int) -> DataFrame:
    """classes (rep, small) of at most `largest` shingles -> links (a, b) by equal subsets."""

    def enumerate_subsets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rep, small in zip(batch["rep"].tolist(), batch["small"], strict=True):
                raw = [int(x).to_bytes(8, "little", signed=True) for x in small]
                n, keys, others = len(raw), [], []
                for other in partner_sizes(n, percent):
                    if other <= largest:
                        tag = b"%d %d " % (min(n, other), max(n, other))
                        keys += [hashlib.blake2b(tag + b"".join(x), digest_size=16).digest() for x in combinations(raw, overlap(n, other, percent))]
                        others += [other] * (len(keys) - len(others))
                yield pd.DataFrame({"key": keys, "node": rep, "n": n, "other": others})

    members = classes.select("rep", "small").mapInPandas(enumerate_subsets, "key binary, node bigint, n int, other int")
    # A subset listed for two sizes links a set of one with a set of the other, so both have to be there.
    return stars(members, "min(n) = min(other) AND max(n) = max(other)")


def reached_first(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the first set that its links lead to, itself included, by scans of inverted lists."""
    sizes = np.array([len(x) for x in sets])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(ids, kind="stable")
    listed, owners = ids[order], np.repeat(np.arange(len(sets)), sizes)[order]
    owners = owners.astype(np.int32)
    reached, width = np.full(len(sets), -1), int(ids.max()) + 1
    count = np.bincount(listed, minlength=width)
    start, held = np.cumsum(count) - count, len(sets)
    for first in range(len(sets)):
        if reached[first] >= 0:
            continue
        reached[first] = first
        queue = [first]
        while queue:
            at = queue.pop()
            left = np.flatnonzero(reached < 0)
            if not len(left):
                return reached
            if len(left) * 2 < held:  # lists forget sets that were reached
                keep = reached[owners] < 0
                listed, owners, held = listed[keep], owners[keep], len(left)
                count = np.bincount(listed, minlength=width)
                start = np.cumsum(count) - count
            own = ids[bounds[at] : bounds[at + 1]]
            n = count[own]
            entries = np.repeat(start[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.bincount(owners[entries], minlength=len(sets))[left]
            linked = left[(both > 0) & (100 * both >= percent * (sizes[at] + sizes[left] - both))]
            reached[linked] = first
            queue += linked.tolist()
    return reached


def settled_links(members: DataFrame, percent: int, tile: int = TILE_SHINGLES) -> DataFrame:
    """members (family, node, n, shingles) -> links (a, b) that have the components of all links."""
    total = members.groupBy("family").agg(F.sum("n").alias("s")).withColumn("tiles", F.ceil(F.col("s") / tile).cast("int"))
    total = materialized(total, "families")
    work = total.agg(F.sum(F.col("s") * F.greatest(F.lit(1), F.col("tiles") - 1))).first()[0] or 0
    placed = members.join(total.select("family", "tiles"), "family").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles").cast("bigint")).cast("int"))
    # A tile meets each other tile of its family; an only tile stays alone.
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).where((F.col("tiles") == 1) | (F.col("tile") != F.col("other")))
    jobs = placed.select("family", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "node", "shingles")
    parts = min(max(4, work // tile + 1), MOST_PARTS)
    jobs = jobs.repartition(parts, "family", "low", "high").sortWithinPartitions("family", "low", "high", "node")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        job, nodes, sets = None, [], []

        def settle() -> pd.DataFrame:
            node, to = np.array(nodes), np.array(nodes)[reached_first(sets, percent)]
            nodes.clear()
            sets.clear()
            return pd.DataFrame({"a": node[node != to], "b": to[node != to]})

        for batch in batches:
            for family, low, high, node, shingles in batch.itertuples(index=False):
                if (family, low, high) != job and nodes:
                    yield settle()
                job = (family, low, high)
                nodes.append(node)
                sets.append(np.frombuffer(shingles, np.uint64))
        if nodes:
            yield settle()

    return jobs.mapInPandas(run, "a bigint, b bigint")


def jaccard_components(
    docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK_BYTES, shingles: int = RANGE_SHINGLES, tile: int = TILE_SHINGLES
) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, component_id: one row per row of docs."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A word takes two bytes at least. With eight bits to spare few shingles pass for repeated by chance.
    bits = min(64, max(40, (size // 2).bit_length() + 8))
    blocks = materialized(blocks_of(docs, k, bits, size // 6 // shingles + 1, block), "blocks")
    rows = blocks.select(F.inline(F.arrays_zip("docs", "sizes", "digests", "small"))).toDF("doc_id", "n", "digest", "small")
    rows = materialized(rows, "sets")
    sets = rows.where(F.col("digest").isNotNull())
    classes = sets.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.first("small").alias("small"))
    classes = materialized(classes, "classes")
    histogram = classes.where(F.col("n") <= SMALL_LIMIT).groupBy("n").agg(F.count("*").alias("classes")).collect()
    largest = boundary({r["n"]: r["classes"] for r in histogram}, percent)
    light = subset_links(classes.where(F.col("n") <= largest), largest, percent)
    least = -(-percent * (largest + 1) // 100)
    found = prefixes(blocks, frequencies(blocks), k, bits, least, percent)
    # The least id's row stands for its class.
    found = materialized(found.join(classes.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi"), "prefixes")
    discard(blocks)
    listed = materialized(found.select(F.explode("tokens").alias("key"), F.col("doc_id").alias("node")).distinct(), "listed")
    # Written, so that the join meets two plain exchanges and a hot list's partition can be split.
    shared = listed.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("least")).where("size > 1").select("key", "least")
    shared = materialized(shared, "shared")
    lists = materialized(listed.join(shared, "key"), "lists")
    discard(listed, shared)
    grouped = families(lists)
    members = found.select(F.col("doc_id").alias("node"), "n", "shingles").join(materialized(grouped, "grouped"), "node")
    heavy = settled_links(members, percent, tile)
    # A doc_id with several texts joins their classes.
    named = sets.select("doc_id", "digest").join(classes.select("digest", "rep"), "digest")
    several = named.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("high")).where("b <> high").select("doc_id", "b")
    same = named.join(several, "doc_id").where("rep <> b").select(F.col("rep").alias("a"), "b")
    labels = components(light.unionByName(heavy).unionByName(same))
    out = rows.join(classes.select("digest", "rep"), "digest", "left").join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"))


def op11_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the smallest doc_id that its links reach."""
    return jaccard_components(spark.read.parquet(f"{folder}/documents.parquet"))
