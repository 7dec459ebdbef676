import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from llm import ngram_jaccard as J
from tests.conftest import FOLDER

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, k=4, percent=85):
    """(set size, least reachable id) of each id; rows with one id are one node."""
    rows, inverse, parent = [], defaultdict(list), {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = sorted((find(a), find(b)))
        parent[b] = a

    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD))
        rows.append((i, {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())))
        if i is not None:
            parent[i] = i
    for at, (i, own) in enumerate(rows):
        if i is None:
            continue
        for other, n in Counter(o for x in own for o in inverse[x]).items():
            if 100 * n >= percent * (len(own) + len(rows[other][1]) - n):
                join(i, rows[other][0])
        for x in own:
            inverse[x].append(at)
    return sorted((i is None, i, len(own), None if i is None else find(i)) for i, own in rows)


def found(df):
    return sorted((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_whole_table_equals_brute_force(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    assert found(J.op11_ngram_jaccard(spark, FOLDER)) == brute(zip(docs.doc_id, docs.text, strict=True))


@pytest.fixture(scope="module")
def families():
    """Chains, near copies around the limit, small sets, exact copies, and a passage that all have."""
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(300)]
    docs, base = [], list(rng.choice(words, 90))
    for _ in range(25):  # neighbours are linked, ends are not
        docs.append(" ".join(base))
        at = int(rng.integers(0, 88))
        base[at : at + 1] = list(rng.choice(words, 1))
    other = list(rng.choice(words, 120))
    for i in range(60):  # near copies, many pairs of which miss the mark
        own = list(other)
        for at in rng.integers(0, 120, int(rng.integers(0, 4))):
            own[at] = f"own{i}"
        docs.append(" ".join(own))
    for n in range(1, 34):  # small sets, one longer each, with a changed end
        docs += [" ".join(words[:n]), " ".join([*words[: n - 1], "end"]), " ".join(words[1 : n + 1])]
    docs += ["Exact COPY of five words", "exact copy\tof five  words", "exact copy of five"] * 3
    passage = " ".join(rng.choice(words, 40))
    docs += [f"{passage} {' '.join(f'p{i}q{j}' for j in range(30))}" for i in range(20)]
    order = rng.permutation(len(docs))
    return [(int(i), docs[p]) for i, p in enumerate(order)]


@pytest.mark.parametrize(("block", "shingles", "tile"), [(16 << 20, 4_000_000, 1_000_000), (8_000, 2_000, 2_000)])
def test_families_in_blocks_ranges_and_tiles(wide, families, block, shingles, tile):
    want = brute(families)
    assert found(J.jaccard_components(wide(families), block=block, shingles=shingles, tile=tile)) == want
    assert len({x[3] for x in want}) < len(want) - 80


@pytest.mark.parametrize("largest", [0, 6, 24])
def test_any_boundary_gives_the_same(wide, families, monkeypatch, largest):
    """Lists alone, or subsets for more sets than the costs ask for."""
    monkeypatch.setattr(J, "boundary", lambda counts, percent: largest)
    some = families[::3]
    assert found(J.jaccard_components(wide(some), percent=80, block=4_000, tile=2_000)) == brute(some, percent=80)


def test_boundary_follows_costs():
    assert J.boundary({}, 85) == 0
    # Sets of 12 cost 14 in lists and 15 as subsets; those of 5 cost one subset.
    assert [J.boundary(x, 85) for x in ({5: 10, 20: 1}, {n: 1 for n in range(1, 9)} | {12: 1000}, {n: 10 for n in range(1, 6)})] == [5, 9, 5]
    assert [J.overlap(13, 13, 85), J.overlap(12, 12, 85), J.prefix_length(100, 85), list(J.partner_sizes(20, 85))] == [12, 12, 16, list(range(17, 24))]


def test_awkward_rows(awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(J.jaccard_components(awkward)) == brute(rows)
    assert J.jaccard_components(empty).collect() == []


def test_texts_of_one_id_are_one_node(wide):
    texts = [" ".join(f"{c}{i}" for i in range(40)) for c in "pqr"]
    docs = [(1, texts[0]), (2, texts[0] + " x"), (2, texts[1] + " x"), (3, texts[1]), (4, texts[2]), (None, texts[2])]
    assert found(J.jaccard_components(wide(docs))) == brute(docs)


def test_scans_equal_plain_sets():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 60, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, 52, replace=False), rng.integers(0, 1 << 60, int(rng.integers(0, 5)), dtype=np.uint64)])) for _ in range(80)]
    got = J.reached_first(sets, 85)
    parent = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((parent[i], parent[j]))
                parent = [a if p == b else p for p in parent]
    assert got.tolist() == parent and 1 < len(set(parent)) < len(sets)
