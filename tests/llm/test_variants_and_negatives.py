import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import hard_negatives as H
from llm import spelling_variants as V
from tests.conftest import FOLDER

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def counted(docs):
    out = Counter()
    for i, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(FOLD)):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def grouped(words):
    """Near words by their texts with one letter masked or missing."""
    masked, near = defaultdict(set), {w: set() for w in words}
    for w in words:
        for k in range(len(w)):
            masked[w[:k] + "*" + w[k + 1 :]].add(w)
            short = w[:k] + w[k + 1 :]
            if short in words:
                near[w].add(short)
                near[short].add(w)
    for group in masked.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, words[w], len(near[w]), words.get(form.get(w)))
    return out


def variant_rows(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_variants_of_the_whole_table_equal_brute_force(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    want = grouped(counted(zip(docs.doc_id, docs.text, strict=True)))
    assert variant_rows(V.op12_spelling_variants(spark, FOLDER)) == want
    assert sum(w[0] is not None for w in want.values()) > 100


def test_variants_in_small_tiles(spark):
    """Several tiles a cell, other numbers of classes, long words, ties and long chains of forms."""
    rng = np.random.default_rng(5)
    words = {"".join(rng.choice(list("abéÿ"), rng.integers(5, 9))): int(n) for n in rng.integers(3, 40, 400)}
    words |= {"chain" + "x" * k: 3 * 2**k for k in range(9)} | {"z" * 3000: 7, "z" * 2999 + "y": 90, "z" * 3001: 90}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    want = grouped(words)
    for classes, tile in ((5, 8), (1, 50), (3, 4096)):
        assert variant_rows(V.variant_groups(table, classes, tile)) == want
    assert want["chain"][1] == "chain" + "x" * 8 and want["z" * 3000][0] == "z" * 2999 + "y"


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=5, max_size=8), st.text("abc", min_size=5, max_size=8))
def test_one_pair(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return
    a, b = sorted((a, b), key=len)
    i, _ = V.near_pairs(V.Tile(a, np.array([1])), V.Tile(b, np.array([1])), V.REPLACED if len(a) == len(b) else V.INSERTED, False)
    if len(a) == len(b):
        near = sum(x != y for x, y in zip(a, b, strict=True)) == 1
    else:
        near = any(b[:k] + b[k + 1 :] == a for k in range(len(b)))
    assert (len(i) == 1) == near


def test_variants_awkward_rows(spark, awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert variant_rows(V.variant_groups(V.vocabulary(V.damaged_words(awkward)))) == grouped(counted(rows))
    assert V.variant_groups(V.vocabulary(V.damaged_words(empty))).collect() == []


def test_negatives_equal_sql(spark, duck):
    got = H.op13_hard_negatives(spark, FOLDER)
    want = duck.execute(H.ORACLE).df()
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.itertuples(index=False)))
    assert len(want)


def mined(rows, every, positives, negatives, percent):
    """The same in plain Python; rows (id, label, whole numbers)."""
    out = []
    for a, (i, label, v) in enumerate(rows):
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=False)), j, m == label) for b, (j, m, w) in enumerate(rows) if b != a]
        for p, j, _ in sorted(x for x in scored if x[2])[:positives]:
            fits = sorted(x for x in scored if not x[2] and percent * -p <= 100 * -x[0] <= 100 * -p)
            out += [(i, j, r, k, -p, -n) for r, (n, k, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


NEGATIVE_ROW = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def test_negatives_in_small_cells(spark, monkeypatch):
    """Many cells, ties, repeated ids, vectors of several lengths, large numbers, and rows that take no part."""
    monkeypatch.setattr(H, "ANCHORS", 3)
    monkeypatch.setattr(H, "CHUNKS", 2)
    rng = np.random.default_rng(2)
    good = [(int(i), int(m), [float(x) / 256 for x in rng.integers(-3, 9, rng.integers(0, 20))]) for i, m in zip(rng.integers(0, 60, 150), rng.integers(0, 3, 150), strict=True)]
    good += [(300, 1, [2.0**20, -1.0]), (310, 1, [2.0**20]), (320, 2, [2.0**20 - 2.0**16, 3.0])]
    bad = [(None, 1, [1.0]), (5, None, [1.0]), (5, 1, None), (5, 1, [1.0, None]), (5, 1, [float("nan")]), (5, 1, [float("-inf")])]
    table = spark.createDataFrame([(i, m, v, 1, 2, "x", 3) for i, m, v in good + bad], "vec_id bigint, label int, embedding array<double>, chunk int, row int, rank string, _r int")
    want = mined([(i, m, [int(np.floor(256 * x)) for x in v]) for i, m, v in good], 10, 4, 3, 60)
    assert H.chunks_of(table, 16).count() > 2
    monkeypatch.setattr(H.chunks_of, "__defaults__", (16,))
    got = H.hard_negatives(table, 10, 4, 3, 60)
    assert sorted(map(tuple, got.select(*NEGATIVE_ROW).collect())) == want and len(want) > 50
    assert H.hard_negatives(table.limit(0)).collect() == []


def test_looked_up_scores_are_inner_products():
    rng = np.random.default_rng(4)
    for low, high in ((-150, 150), (0, 2), (-(1 << 62), 1 << 62)):
        a, c = rng.integers(low, high, (7, 24)), rng.integers(low, high, (90, 24))
        planes = H.bit_planes(c)
        assert (H.from_planes(planes) == c).all()
        assert (H.Anchors(a, len(planes)).scores(planes) == c @ a.T).all()
    assert H.integers([np.array([-0.001, 1e30, 3.99])])[0, :3].tolist() == [-1, int(256 * 1e30) % (1 << 64) - (1 << 64) * (int(256 * 1e30) % (1 << 64) >= 1 << 63), 1021]


