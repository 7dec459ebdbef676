import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd

from tests.conftest import FOLDER
from llm import circulant_minhash as M
from llm.components import components

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sets_of(docs):
    out = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD))
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    return out


def brute(sets):
    inverse, parent = defaultdict(list), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        meets = Counter(j for x in sets[i] for j in inverse[x])
        for j, n in meets.items():
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for x in sets[i]:
            inverse[x].append(i)
    return {i: find(i) for i in sets}


def test_whole_table_equals_brute_force(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    sets = sets_of(zip(docs.doc_id, docs.text, strict=True))
    want = brute(sets)
    got = M.op3_circulant_minhash(spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_chains_and_large_buckets(spark, wide):
    """A chain that one pivot cannot settle, and a group with more members than SMALL."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    docs, base = [], list(rng.choice(words, 120))
    for i in range(30):  # each step replaces a few words: neighbours are linked, ends are not
        docs.append((i, " ".join(base)))
        at = int(rng.integers(0, 116))
        base[at : at + 2] = list(rng.choice(words, 2))
    other = list(rng.choice(words, 120))
    for i in range(30, 75):  # copies of one text that differ from it in two words, so many pairs miss the mark
        own = list(other)
        for at in rng.integers(0, 120, 2):
            own[at] = f"own{i}"
        docs.append((i, " ".join(own)))
    want = brute(sets_of(docs))
    for family in (6_000, 20, 1):  # settled in tasks, by both ways, by joins only
        assert {r.doc_id: r.component_id for r in M.near_duplicates(wide(docs), family=family).collect()} == want
    assert len(set(want.values())) < len(want)


def test_awkward_rows(awkward, empty):
    rows = M.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by[i].n_shingles for i in (1, 2, 3)] == [0, 0, 0] and all(by[i].kept and by[i].component_id == i for i in (1, 2, 3, 6, 8))
    assert by[7].n_shingles == 1 and by[5].component_id == 4 and not by[5].kept and by[4].kept
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert M.near_duplicates(empty).collect() == []


def test_texts_of_one_id_are_one_node(wide):
    texts = [" ".join(f"{c}{i}" for i in range(40)) for c in "pqr"]
    docs = [(1, texts[0]), (2, texts[0] + " x"), (2, texts[1] + " x"), (3, texts[1]), (4, texts[2])]
    for family in (6_000, 1):
        got = {(r.doc_id, r.component_id, r.kept) for r in M.near_duplicates(wide(docs), family=family).collect()}
        assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    hasher = M.Circulant(bits=20)
    whole = rng.integers(0, 1 << 63, 1200, dtype=np.uint64)
    a, b = whole[:1000], whole[200:]
    same = (hasher.signature(a) == hasher.signature(b)).mean()
    assert abs(same - 800 / 1200) < 0.15
    assert (hasher.signature(a) == hasher.signature(a[::-1])).all()


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 200).selectExpr("id AS a", "id - 1 AS b").union(spark.createDataFrame([(500, 501)], "a bigint, b bigint"))
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(200)} | {500: 500, 501: 500}
