"""Exact substring dedup by a distributed, common-prefix-aware merge sort of sampled suffixes.

A string of `LENGTH` bytes that starts twice holds, at the same place in both, the same anchor: the
position whose `GRAM` bytes have the least hash in it. So only suffixes at anchors are sorted, each with
what precedes it. Anchors whose gram occurs once are left out beforehand.

Tasks sort the suffixes of their documents into runs, join equal entries into one with several owners,
and front-code the runs: of each suffix only what differs from its predecessor, with the length of the
common prefix. Runs are exchanged by ranges of the sort key (the gram's hash, then the suffix), and a
loser tree merges them. Its nodes keep how much a loser has in common with the winner that beat it, so a
known prefix is never compared again and the merged order comes with its common prefixes. In that order
the suffixes that share a gram are neighbours; which of the strings around them are equal follows from
common prefixes to the right and the same to the left of the anchor, without listing pairs.

A gram of more than `HOT` anchors would fill a range alone, so the strings around its anchors are not sorted:
each is named by 128 bits of BLAKE2b, names are counted where they are made and by hash, and a join brings the
repeated ones back to their texts. No task holds all anchors of a gram, nor a list of a string's owners.

Every byte of such a string is removed; overlaps count and strings are judged on the input.

Defined results: null and empty texts have no bytes and keep none. Repeated rows are documents of their
own, and so repeat each other; of equal texts one is sorted, and all are removed whole if long enough. A row without doc_id is treated like any other. Texts shorter than
`LENGTH` are left alone. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.words import EXACT, chunks, mixed, powers
from statbank.session import discard, materialized

LENGTH, GRAM = 400, 100
#: Suffixes that a run holds and, about, that a range of the exchange holds.
RUN_SUFFIXES, RANGE_SUFFIXES = 20_000, 20_000
#: Anchors of a gram that are sorted; strings around those of commoner grams are counted by name.
HOT = 20_000
#: Names that a task holds before it hands them on.
NAMES = 50_000
#: Bytes of text for which anchors are looked for at once; a longer text is one step.
STEP_BYTES = 1 << 20
_HEAD = 8


@dataclass
class Anchors:
    """Anchors of some texts: text, position, gram hash, and the first and last string start that they stand for."""

    text: np.ndarray
    at: np.ndarray
    gram: np.ndarray
    low: np.ndarray
    high: np.ndarray


def anchors_of(raw: Sequence[bytes], length: int = LENGTH, gram: int = GRAM) -> Anchors:
    sizes = np.array([len(x) for x in raw], np.int64)
    start = np.cumsum(sizes) - sizes
    buffer = np.frombuffer(b"".join(raw), np.uint8)
    none = np.zeros(0, np.int64)
    width = length - gram + 1
    if not len(sizes) or sizes.max() < length:
        return Anchors(none, none, none, none, none)
    up, down = powers(len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(EXACT[buffer] * up[: len(buffer)], out=sums[1:])
    hashes = mixed((sums[gram:] - sums[:-gram]) * down[: len(buffer) - gram + 1])
    # Least (hash, place) of each window of grams, by running minima forwards and backwards in blocks.
    n = len(hashes)
    key = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = key
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    places = (np.minimum(behind[: n - width + 1], ahead[width - 1 : n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    count = np.maximum(0, sizes - length + 1)
    owner = np.repeat(np.arange(len(raw)), count)
    begin = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + start[owner]
    place = places[begin]
    first = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
    last = np.append(first[1:], len(place)) - 1
    text = owner[first]
    return Anchors(text, place[first] - start[text], hashes[place[first]].view(np.int64), begin[first] - start[text], begin[last] - start[text])


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which `known` bytes are equal already."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    low, step = known, 16
    while a[low : low + step] == b[low : low + step]:
        low, step = low + step, step * 2
    high = min(low + step, end)
    while high - low > 1:  # a and b agree before low, and differ before high
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class LoserTree:
    """Merges runs of (string, common prefix with the run's string before, entry), in order of the strings.

    Yields (string, common prefix with the string yielded before, entry). Each head's common prefix with
    the last winner is known, so heads are compared by these numbers and only from there on by bytes.
    """

    def __init__(self, runs: Sequence[Iterator[tuple[bytes, int, object]]]):
        self.runs = [iter(r) for r in runs]
        self.size = 1
        while self.size < max(1, len(self.runs)):
            self.size *= 2
        self.heads: list[tuple[bytes, object] | None] = [None] * self.size
        self.lcp = [-1] * self.size
        for k, run in enumerate(self.runs):
            if (x := next(run, None)) is not None:
                self.heads[k], self.lcp[k] = (x[0], x[2]), 0
        self.losers = [0] * self.size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        won, self.losers[node] = self._play(a, b)
        return won

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser). The head with more in common with the last winner is the smaller one."""
        x, y = self.lcp[a], self.lcp[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        s, t = self.heads[a][0], self.heads[b][0]
        n = common(s, t, x)
        if s[n : n + 1] <= t[n : n + 1]:
            self.lcp[b] = n
            return a, b
        self.lcp[a] = n
        return b, a

    def __iter__(self) -> Iterator[tuple[bytes, int, object]]:
        while (head := self.heads[self.winner]) is not None:
            k = self.winner
            yield head[0], self.lcp[k], head[1]
            if (x := next(self.runs[k], None)) is None:
                self.heads[k], self.lcp[k] = None, -1
            else:
                self.heads[k], self.lcp[k] = (x[0], x[2]), x[1]
            node = (k + self.size) // 2
            while node:
                k, self.losers[node] = self._play(k, self.losers[node])
                node //= 2
            self.winner = k


@dataclass
class Entry:
    """What precedes a suffix (reversed, nearest byte first) and whose suffixes it stands for: (d, h, at)."""

    left: bytes
    owners: list[tuple[int, int, int]] = field(default_factory=list)


Run = list[tuple[bytes, int, Entry]]


def sorted_run(items: dict[tuple[bytes, bytes], list[tuple[int, int, int]]]) -> Run:
    out, before = [], b""
    for (key, left), owners in sorted(items.items()):
        out.append((key, common(before, key), Entry(left, owners)))
        before = key
    return out


def front_coded(run: Run) -> bytes:
    """A run, or a stretch of one, without what each string shares with the one before it."""
    lcp = np.array([x[1] for x in run], np.uint32)
    if len(lcp):
        lcp[0] = 0
    tails = [x[0][n:] for x, n in zip(run, lcp.tolist(), strict=True)]
    sizes = np.array([[len(t), len(x[2].left), len(x[2].owners)] for t, x in zip(tails, run, strict=True)], np.uint32).reshape(-1, 3)
    owners = np.array([o for x in run for o in x[2].owners], np.int64).reshape(-1, 3)
    parts = [np.array([len(run), len(owners)], np.int64).tobytes(), lcp.tobytes(), sizes.tobytes(), owners.T.tobytes(), b"".join(tails), b"".join(x[2].left for x in run)]
    return zlib.compress(b"".join(parts), 1)


def decoded(raw: bytes) -> Iterator[tuple[bytes, int, Entry]]:
    raw = zlib.decompress(raw)
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    at = 16
    lcp = np.frombuffer(raw, np.uint32, n, at).tolist()
    at += 4 * n
    sizes = np.frombuffer(raw, np.uint32, 3 * n, at).reshape(-1, 3).tolist()
    at += 12 * n
    owners = list(zip(*np.frombuffer(raw, np.int64, 3 * m, at).reshape(3, -1).tolist(), strict=True))
    at += 24 * m
    side = at + sum(s[0] for s in sizes)
    before, k = b"", 0
    for shared, (tail, left, owned) in zip(lcp, sizes, strict=True):
        before = before[:shared] + raw[at : at + tail]
        yield before, shared, Entry(raw[side : side + left], owners[k : k + owned])
        at, side, k = at + tail, side + left, k + owned


def repeated(rights: list[bytes], lcp: list[int], lefts: list[bytes], many: list[bool], length: int) -> list[list[tuple[int, int]]]:
    """For suffixes in order that share a gram: the offsets d, as closed intervals, at which the string of
    `length` bytes that starts d bytes before the suffix also starts d bytes before another one.

    rights: the suffixes; lcp[i]: bytes that i shares with i - 1; lefts: reversed; many: has several owners.
    """
    n = len(rights)
    whole = [(length - len(r), len(x)) for r, x in zip(rights, lefts, strict=True)]
    if n == 1:
        return [[whole[0]] if many[0] else []]
    if n == 2 and not (many[0] or many[1]):
        both = (length - lcp[1], common(lefts[0], lefts[1]))
        return [[both] if both[0] <= both[1] else []] * 2
    if all(lcp[i] == len(rights[i]) == len(rights[i - 1]) for i in range(1, n)) and len(set(lefts)) == 1:
        return [[w] for w in whole]
    # At offset d two suffixes belong together if neither order has a smaller common prefix between them.
    order = sorted(range(n), key=lefts.__getitem__)
    right = np.array([0, *lcp[1:]])
    left = np.array([0, *(common(lefts[a], lefts[b]) for a, b in zip(order, order[1:], strict=False))])
    edges = np.unique(np.concatenate([length - right[1:], left + 1, [a for a, _ in whole], [b + 1 for _, b in whole]]))
    edges = edges[(edges >= 0) & (edges <= length)]
    flags = np.zeros((len(edges), n), bool)
    step = max(1, 2_000_000 // n)
    for e in range(0, len(edges), step):
        d = edges[e : e + step, None]
        same_right = np.cumsum(right < length - d, axis=1)
        same_left = np.empty_like(same_right)
        same_left[:, order] = np.cumsum(left < d, axis=1)
        key = same_right * (n + 1) + same_left
        by = np.argsort(key, axis=1, kind="stable")
        at = np.take_along_axis(key, by, axis=1)
        equal = at[:, 1:] == at[:, :-1]
        paired = np.zeros(key.shape, bool)
        paired[:, 1:] |= equal
        paired[:, :-1] |= equal
        np.put_along_axis(flags[e : e + step], by, paired, axis=1)
    first = np.array([w[0] for w in whole])
    final = np.array([w[1] for w in whole])
    flags |= np.array(many)
    flags &= (edges[:, None] >= first) & (edges[:, None] <= final)
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    ends = np.append(edges[1:], length + 1) - 1
    for i in np.flatnonzero(flags.any(axis=0)).tolist():
        for j in np.flatnonzero(flags[:, i]).tolist():
            if out[i] and out[i][-1][1] == edges[j] - 1:
                out[i][-1] = (out[i][-1][0], int(ends[j]))
            else:
                out[i].append((int(edges[j]), int(ends[j])))
    return out


def _joined(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text is not None else b""


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with the text's SHA-256, 120 bits of which name the text from here on."""
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    part = [F.conv(F.substring("sha256", i, 15), 16, 10).cast("bigint") for i in (1, 16)]
    return docs.select("doc_id", "text", sha.alias("sha256")).select("*", part[0].alias("d"), part[1].alias("h"))


def _summaries(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """One row a document: its size and hash as it is, and its anchors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            for first, raw in chunks(batch.pop("text").tolist(), STEP_BYTES):
                found = anchors_of(raw, length, gram)
                cut = np.searchsorted(found.text, np.arange(len(raw) + 1))
                own = batch.iloc[first : first + len(raw)].reset_index(drop=True)
                yield own.assign(
                    n_bytes=[len(x) for x in raw],
                    grams=[found.gram[a:b] for a, b in zip(cut, cut[1:], strict=False)],
                    at=[found.at[a:b] for a, b in zip(cut, cut[1:], strict=False)],
                )

    kinds = "d bigint, h bigint, doc_id bigint, sha256 string, n_bytes bigint, grams array<bigint>, at array<bigint>"
    return docs.select("d", "h", "doc_id", "sha256", "text").mapInPandas(run, kinds)


def _runs(found: DataFrame, ranges: int, length: int, gram: int, limit: int) -> DataFrame:
    """found (d, h, text, at: anchors wanted) -> front-coded stretches of sorted runs, one for each range."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        items: dict[tuple[bytes, bytes], list[tuple[int, int, int]]] = {}

        def out() -> pd.DataFrame:
            nonlocal number
            whole, rows, at = sorted_run(items), [], 0
            items.clear()
            place = [int.from_bytes(x[0][:4], "big") * ranges >> 32 for x in whole]
            for k in range(1, len(whole) + 1):
                if k == len(whole) or place[k] != place[at]:
                    rows.append((place[at], number, front_coded(whole[at:k])))
                    at = k
            number += 1
            return pd.DataFrame(rows, columns=["range", "run", "coded"])

        for batch in batches:
            wanted, d, h = [set(x) for x in batch["at"]], batch["d"].tolist(), batch["h"].tolist()
            for first, raw in chunks(batch["text"].tolist(), STEP_BYTES):
                a = anchors_of(raw, length, gram)
                for text, at, key, low, high in zip(*(x.tolist() for x in (a.text, a.at, a.gram, a.low, a.high)), strict=True):
                    i = first + text
                    if at in wanted[i]:
                        body = raw[text]
                        head = (key & 0xFFFFFFFFFFFFFFFF).to_bytes(_HEAD, "big")
                        # Wanted are the strings that start from low to high; the last of them ends at high + length.
                        items.setdefault((head + body[at : high + length], body[low:at][::-1]), []).append((d[i], h[i], at))
                if len(items) >= limit:
                    yield out()
        if items:
            yield out()

    return found.select("d", "h", "text", "at").mapInPandas(run, "range int, run bigint, coded binary")


def _merged(runs: DataFrame, length: int, gram: int) -> DataFrame:
    """Merges each range's runs and finds the repeated strings: d, h and byte spans."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("run")
        out: list[tuple[int, int, int, int]] = []
        held: list[tuple[bytes, int, Entry]] = []

        def settle() -> None:
            found = repeated(
                [x[0][_HEAD:] for x in held], [x[1] - _HEAD for x in held], [x[2].left for x in held], [len(x[2].owners) > 1 for x in held], length
            )
            for (_, _, entry), offsets in zip(held, found, strict=True):
                for d, h, at in entry.owners:
                    out.extend((d, h, at - b, at - a + length) for a, b in offsets)

        for key, shared, entry in LoserTree([decoded(x) for x in group["coded"]]):
            if held and shared < _HEAD + gram:
                if len(held) > 1 or len(held[0][2].owners) > 1:
                    settle()
                held = []
            held.append((key, shared, entry))
        if held:
            settle()
        return pd.DataFrame(out, columns=["d", "h", "start", "end"])

    return runs.groupBy("range").applyInPandas(merge, "d bigint, h bigint, start bigint, end bigint")


def _named(found: DataFrame, length: int, gram: int) -> DataFrame:
    """found (d, h, text, hot: anchors wanted) -> a row for each string around these anchors: d, h, start, name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple[int, int, int, bytes]] = []
        for batch in batches:
            wanted, d, h = [set(x) for x in batch["hot"]], batch["d"].tolist(), batch["h"].tolist()
            for first, raw in chunks(batch["text"].tolist(), STEP_BYTES):
                a = anchors_of(raw, length, gram)
                for text, at, low, high in zip(*(x.tolist() for x in (a.text, a.at, a.low, a.high)), strict=True):
                    i, body = first + text, raw[text]
                    if at in wanted[i]:
                        rows += [(d[i], h[i], s, hashlib.blake2b(body[s : s + length], digest_size=16).digest()) for s in range(low, high + 1)]
                    if len(rows) >= NAMES:
                        yield pd.DataFrame(rows, columns=["d", "h", "start", "name"])
                        rows.clear()
        if rows:
            yield pd.DataFrame(rows, columns=["d", "h", "start", "name"])

    return found.select("d", "h", "text", "hot").mapInPandas(run, "d bigint, h bigint, start bigint, name binary")


def _counted(found: DataFrame, length: int, gram: int) -> DataFrame:
    """Repeated strings around the anchors `hot`: d, h and byte spans."""
    named = materialized(_named(found, length, gram), "named")
    # Written, so that the join meets two plain exchanges and a common string's partition can be split.
    twice = materialized(named.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "names")
    return named.join(twice, "name").select("d", "h", "start", (F.col("start") + length).alias("end"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs (doc_id, text) -> (a row for each document: d, h, doc_id, sha256 and n_bytes of the input, copies;
    a row for each different text with repeats: d, h, text and its spans to remove; a written table that the second
    one reads). d and h name a text.

    Equal texts are combined before anything is exchanged: one of them stands for all in the sort.
    """
    keyed = _keyed(docs)
    every = materialized(_summaries(keyed, length, gram), "summaries")
    texts = every.groupBy("d", "h").agg(F.count("*").alias("copies"), F.first(F.arrays_zip("grams", "at")).alias("x"))
    anchors = materialized(texts.select("d", "h", F.explode("x").alias("x")).select("d", "h", F.col("x.grams").alias("gram"), F.col("x.at").alias("at")), "anchors")
    # Written, so that the join below meets two plain exchanges and a hot gram's partition can be split.
    shared = materialized(anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "grams")
    common = F.col("n") > hot
    wanted = anchors.join(shared, "gram").groupBy("d", "h")
    wanted = wanted.agg(F.collect_set(F.when(~common, F.col("at"))).alias("at"), F.collect_set(F.when(common, F.col("at"))).alias("hot"))
    once = keyed.where(F.octet_length("text") >= length).groupBy("d", "h").agg(F.first("text").alias("text"))
    found = materialized(once.join(wanted, ["d", "h"]), "repeating")
    discard(anchors, shared)
    n = found.agg(F.sum(F.size("at")).alias("n")).first()["n"] or 0
    ranges = max(4, int(n) // RANGE_SUFFIXES)
    runs = _runs(found.where(F.size("at") > 0), ranges, length, gram, RUN_SUFFIXES)
    spans = _merged(runs, length, gram)
    if not (often := found.where(F.size("hot") > 0)).isEmpty():
        spans = spans.unionByName(_counted(often, length, gram))
    spans = spans.groupBy("d", "h").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    copies = every.groupBy("d", "h").agg(F.count("*").alias("copies"))
    return every.drop("grams", "at").join(copies, ["d", "h"]), found.select("d", "h", "text").join(spans, ["d", "h"]), found


def _kept(text: bytes, spans) -> tuple[bytes, list[tuple[int, int]]]:
    cut = _joined([(int(s["start"]), int(s["end"])) for s in spans])
    out, at = [], 0
    for a, b in cut:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]]), cut


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """docs (doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document; d, h and the
    remaining bytes `kept` of each different text that lost some, unless it is a copy of another text)."""
    every, cut, found = repeated_spans(docs, length, gram, hot)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for d, h, text, spans in zip(batch["d"], batch["h"], batch["text"], batch["spans"], strict=True):
                kept, gone = _kept(_encoded(text), spans)
                rows.append((d, h, sum(b - a for a, b in gone), len(gone), hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(rows, columns=["d", "h", "n_removed", "n_spans", "kept_sha256", "kept"])

    done = materialized(cut.mapInPandas(run, "d bigint, h bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"), "kept")
    discard(found)
    # A text of enough bytes that stands in two documents repeats as a whole.
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    figures = every.join(done.drop("kept"), ["d", "h"], "left").select(
        "d",
        "h",
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, hashlib.sha256(b"").hexdigest()).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )
    return figures, done.select("d", "h", "kept")


def rewritten(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """docs, whatever its columns, with the repeated bytes gone from text (decoded again; bytes of a
    character cut in two are dropped). n_chars, if there, follows the text."""
    figures, kept = without_repeats(docs, length, gram)
    gone = figures.where("n_removed > 0").select(F.col("d").alias("_d"), F.col("h").alias("_h"), (F.col("n_removed") == F.col("n_bytes")).alias("_all")).distinct()
    left = kept.select(F.col("d").alias("_d"), F.col("h").alias("_h"), F.col("kept").alias("_kept"))
    # The row is one column here, so that no name of it can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    sha = F.sha2(F.coalesce("_row.text", F.lit("")).cast("binary"), 256)
    part = [F.conv(F.substring(sha, i, 15), 16, 10).cast("bigint") for i in (1, 16)]
    found = rows.select("_row", part[0].alias("_d"), part[1].alias("_h")).join(gone, ["_d", "_h"], "left").join(left, ["_d", "_h"], "left")

    def decode(column: pd.Series) -> pd.Series:
        return column.map(lambda x: None if x is None else x.decode("utf-8", "ignore"))

    text = F.when(F.col("_all"), F.lit("")).otherwise(F.coalesce(F.pandas_udf(decode, "string")("_kept"), F.col("_row.text")))
    out = {"text": text}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("_all").isNull(), F.col("_row.n_chars")).otherwise(F.char_length(text).cast("bigint"))
    return found.select(*[out.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def op10_suffix_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with what exact substring dedup at 400 bytes removes from it."""
    figures, _ = without_repeats(spark.read.parquet(f"{folder}/documents.parquet"))
    return figures.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
