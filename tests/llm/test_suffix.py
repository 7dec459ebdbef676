import hashlib
import random
from collections import Counter

import pandas as pd

from tests.conftest import FOLDER
from llm import suffix_merge as S


def brute(raw, length):
    seen = Counter(t[s : s + length] for t in raw for s in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(gone)))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


def test_whole_table_equals_brute_force(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    want = dict(zip(docs.doc_id, brute([(t or "").encode() for t in docs.text], 400), strict=True))
    got = {r.doc_id: tuple(r)[1:] for r in S.op10_suffix_merge(spark, FOLDER).collect()}
    assert got == want


def merged(raw, length, gram, run):
    """The operator's steps without Spark: anchors, runs, front coding, loser tree, repeats."""
    found, runs, items = S.anchors_of(raw, length, gram), [], {}
    for text, at, key, low, high in zip(*(x.tolist() for x in (found.text, found.at, found.gram, found.low, found.high)), strict=True):
        head = (key & (1 << 64) - 1).to_bytes(8, "big")
        items.setdefault((head + raw[text][at : high + length], raw[text][low:at][::-1]), []).append((text, 0, at))
        if len(items) >= run:
            runs.append(S.sorted_run(items))
            items = {}
    runs.append(S.sorted_run(items))
    gone, held, last = [bytearray(len(t)) for t in raw], [], b""

    def settle():
        offsets = S.repeated([x[0][8:] for x in held], [x[1] - 8 for x in held], [x[2].left for x in held], [len(x[2].owners) > 1 for x in held], length)
        for (_, _, entry), found in zip(held, offsets, strict=True):
            for text, _, at in entry.owners:
                for a, b in found:
                    gone[text][at - b : at - a + length] = b"\1" * (b - a + length)

    for key, shared, entry in S.LoserTree([S.decoded(S.front_coded(r)) for r in runs]):
        assert key >= last and shared == S.common(last, key)
        last = key
        if held and shared < 8 + gram:
            settle()
            held = []
        held.append((key, shared, entry))
    if held:
        settle()
    return gone


def test_random_texts_equal_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        length, gram = rng.choice([(12, 4), (20, 5), (16, 8)])
        base = [bytes(rng.choice(b"abc") for _ in range(rng.randint(5, 80))) for _ in range(5)]
        raw = []
        for _ in range(rng.randint(1, 14)):
            parts = [rng.choice(base)[rng.randint(0, 10) : rng.randint(20, 90)] if rng.random() < 0.7 else bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(0, 4))]
            raw.append(b"".join(parts))
        gone = merged(raw, length, gram, rng.choice([3, 7, 50]))
        assert [(len(g), sum(g)) for g in gone] == [x[:2] for x in brute(raw, length)]


def test_awkward_rows(awkward, empty):
    rows = S.without_repeats(awkward)[0].select("doc_id", "n_bytes", "n_removed", "n_spans").collect()
    assert len(rows) == awkward.count()
    texts = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in rows if r.doc_id is not None}
    assert texts[1] == texts[2] == (0, 0, 0) and texts[8] == (2, 0, 0)
    assert texts[4] == texts[5] == (216, 0, 0)  # equal, but shorter than 400 bytes
    assert S.without_repeats(empty)[0].collect() == []


def test_rewritten_keeps_columns_and_characters(wide):
    passage = "é" * 300
    docs = wide([(1, "a" + passage + "b"), (2, "c" + passage), (3, "alone"), (4, passage + passage), (5, "same " * 100), (5, "same " * 100)])
    out = S.rewritten(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == [(1, "ab", 2), (2, "c", 1), (3, "alone", 5), (4, "", 0), (5, "", 0), (5, "", 0)]


def test_common_grams_are_counted_not_sorted(wide, monkeypatch):
    """A passage in most documents, with different surroundings: equal to brute force, and in no range."""
    rng = random.Random(9)

    def words(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    passages = [words(130), words(450)]
    docs = [(i, words(rng.randint(0, 300)) + (passages[i % 2] + words(40)[: i % 7 and 40] if i % 3 else words(500)) + words(rng.randint(0, 300))) for i in range(60)]
    docs += [(100 + i, docs[i][1][:420] + words(90)) for i in range(0, 60, 4)]
    want = dict(zip([i for i, _ in docs], brute([t.encode() for _, t in docs], 400), strict=True))
    assert sum(x[1] > 0 for x in want.values()) > 20
    sorted_anchors, runs = [], S._runs
    monkeypatch.setattr(S, "_runs", lambda found, *a: sorted_anchors.append(found.selectExpr("sum(size(at)) AS n").first()["n"] or 0) or runs(found, *a))
    for hot in (1_000, 5, 1):
        figures, _ = S.without_repeats(wide(docs), hot=hot)
        assert {r.doc_id: tuple(r) for r in figures.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()} == {i: (i, *x) for i, x in want.items()}
    assert sorted_anchors[0] > sorted_anchors[1] > sorted_anchors[2] == 0
