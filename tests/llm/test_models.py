import math
import re
import time
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import FOLDER
from llm import backoff_automaton as B
from llm import folded_lexicon as T
from llm import language_id as L
from llm import quality_trees as Q

SF = "/root/testdata/sf0.01"
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_language_held_out_accuracy(spark, crc):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    got = L.op1_language_id(spark, SF).toPandas().merge(docs, on="doc_id")
    assert len(got) == len(docs) and (got.held_out == got.doc_id.map(lambda i: crc(i) % 5 == 0)).all()
    assert (got.lang_pred == got.lang)[got.held_out].mean() > 0.97 and got.score.between(0, 1).all()


def test_language_gradients():
    rng = np.random.default_rng(0)
    net = L.Network(["a", "b", "c"], hidden=3, steps=7)
    x = rng.integers(97, 102, (7, 5)).astype(np.uint8)
    length, y = np.array([7, 7, 3, 1, 5]), np.array([0, 1, 2, 1, 0])
    mask = (np.arange(7)[:, None] < length).astype(np.float32)

    def loss():
        p, _, _ = net.probabilities(x, mask)
        return -(np.log(p[:, y, np.arange(5)]) * mask).sum() / mask.sum()

    keeps = ([], [])
    p, f, b = net.probabilities(x, mask, keeps)
    p[:, y, np.arange(5)] -= 1
    p *= (mask / mask.sum())[:, None]
    ahead = net.ahead.back(x, mask, keeps[0], np.matmul(net.out[:, :3].T, p))
    behind = net.behind.back(x[::-1], mask[::-1], keeps[1], np.matmul(net.out[:, 3:].T, p)[::-1])
    for layer, grads in ((net.ahead, ahead), (net.behind, behind)):
        for name, weights in vars(layer).items():
            for _ in range(6):
                at = tuple(rng.integers(0, n) for n in weights.shape) if name != "table" else (int(rng.integers(0, 9)), int(x[0, 0]))
                old, eps = weights[at], 3e-2
                weights[at] = old + eps
                up = loss()
                weights[at] = old - eps
                down = loss()
                weights[at] = old
                assert abs((up - down) / (2 * eps) - getattr(grads, name)[at]) < 4e-3


def test_language_awkward_rows(spark, awkward, empty):
    net = L.trained(spark.read.parquet(f"{FOLDER}/documents.parquet"), sample=50, epochs=1)
    rows = L.languages(awkward, net).collect()
    assert len(rows) == awkward.count()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {None, 1, 2, 3, 7} and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert L.in_known_language(awkward, net, 0.0).count() == len([r for r in rows if r.lang_pred != "und"])
    none = L.trained(empty)
    assert {r.lang_pred for r in L.languages(awkward, none).collect()} == {"und"} and L.languages(empty, net).collect() == []


def statistics(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_quality_counts_equal_brute_force(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    got = {r.doc_id: r for r in Q.op2_quality_trees(spark, FOLDER).collect()}
    for i, t in zip(docs.doc_id, docs.text, strict=True):
        want = statistics(t)
        assert tuple(got[i][c] for c in Q.COUNTS) == want
        assert got[i].base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (got[i].kept and got[i].base_failed)


def test_quality_trees_follow_labels(spark):
    got = Q.op2_quality_trees(spark, SF).toPandas().merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    assert ((got.score >= 0.5) == (got.quality == 1)).mean() > 0.95


def test_quality_directions_hold():
    rng = np.random.default_rng(2)
    x = rng.random((600, 3))
    y = (x[:, 0] + 0.3 * rng.standard_normal(600) > 0.5).astype(float)
    forest = Q.grown(x, y, np.array([-1, 0, 1]), trees=20)
    for j, sign in ((0, -1), (2, 1)):
        line = np.tile(x[:20], (30, 1, 1))
        line[:, :, j] = np.linspace(0, 1, 30)[:, None]
        steps = np.diff(forest.score(line.reshape(-1, 3)).reshape(30, 20), axis=0)
        assert (sign * steps >= -1e-12).all()
    free = Q.grown(x, y, np.array([0, 0, 0]), trees=20)
    assert ((free.score(x) > 0.5) == (y > 0)).mean() > ((forest.score(x) > 0.5) == (y > 0)).mean()


def test_quality_awkward_rows(spark, awkward, empty):
    rows = Q.quality(Q.measured(awkward), None).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert r.kept == (not r.base_failed)
    assert {r.doc_id: r.n_words for r in rows if r.doc_id}[6] == 20_000 and Q.quality(Q.measured(empty), None).collect() == []


def test_automaton_equals_brute_force(spark, crc):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    tokens = {i: [*WORD.findall((t or "").translate(FOLD)), "</s>"] for i, t in zip(docs.doc_id, docs.text, strict=True)}
    held = {i: crc(i) % 10 == 0 for i in tokens}
    grams = Counter(), Counter(), Counter()
    for i, w in tokens.items():
        if not held[i]:
            grams[0].update(w)
            grams[1].update(zip(["</s>", *w], w, strict=False))
            grams[2].update(zip(["</s>", *w], w, w[1:], strict=False))
    n, v = sum(grams[0].values()), len(grams[0])
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("held", B.held_out(F.col("doc_id")))
    for order in (2, 3):
        got = {r.doc_id: r for r in B.scored(frame, order=order, block_tokens=9_000, part_grams=20_000).collect()}
        assert len(got) == len(tokens)
        for i, w in tokens.items():
            base = score = 0.0
            for k, x in enumerate(w):
                p = (grams[0][x] + 0.1) / (n + 0.1 * (v + 1))
                base += math.log10(p)
                past = (["</s>", *w])[: k + 1]
                for m in range(1, order):
                    if len(past) < m:
                        break
                    h = tuple(past[-m:])
                    c = grams[0][h[0]] if m == 1 else grams[1][h]
                    kept = B.SCALE * max(c, 1) ** B.POWER
                    p = (grams[m][(*h, x)] + kept * p) / (c + kept)
                score += math.log10(p)
            r = got[i]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(grams[0][x] > 0 for x in w), n)
            assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)


def test_automaton_awkward_rows(awkward, empty):
    rows = B.scored(awkward.withColumn("held", B.held_out(F.col("doc_id"))), block_tokens=100).collect()
    assert len(rows) == awkward.count() and sorted(r.n_tokens for r in rows if r.doc_id in (1, 2, 3)) == [1, 1, 1]
    assert sum(r.doc_id is None for r in rows) == 2 and not any(r.held_out for r in rows if r.doc_id is None)
    assert B.scored(empty.withColumn("held", F.lit(False))).collect() == []
    alone = B.scored(awkward.where("doc_id = 4").limit(1).withColumn("held", F.lit(True))).collect()
    assert [(r.train_tokens, r.n_known, r.base_score) for r in alone] == [(0, 0, 0.0)]


def test_toxicity_held_out(spark, crc):
    got = T.op9_folded_lexicon(spark, SF).toPandas().merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: crc(i) % 3 == 1)).all()
    held = got[got.held_out]
    assert (held.predicted[held.toxic == 0] == 0).all() and held.predicted[held.toxic == 1].mean() > 0.6


def test_folding_and_exceptions():
    assert T.folded("You IDI0T, 1d10t! іdіоt ($tupid) id\u200biot") == " you idiot idiot idiot stupid idiot "
    lexicon = T.Lexicon({"idiot": 3.0, "clown": 2.0}, ("clown fish",), (-3.0, 2.0, 1.0))
    found = lexicon.automaton()
    assert lexicon.measured(found, "a clown fish and idiots") == (3.0, 5)
    assert lexicon.measured(found, "a clown, fished; anidiot") == (2.0, 4)
    assert lexicon.measured(found, None) == lexicon.measured(found, "") == lexicon.measured(found, " .") == (0.0, 0)


def test_doubled_substitutes_are_letters():
    assert T.folded("l00ser, a55hole n00b a55. a$$ @$$hole 8itch shi+") == " looser asshole noob ass ass asshole bitch shit "
    assert T.folded("sale$$$ $$$idiot wow!!!you in 2024") == " sale idiot wow you in 2024 "


def test_toxicity_awkward_rows(awkward, empty, spark):
    none = T.fitted(empty.selectExpr("doc_id", "text", "1 AS y"))
    rows = T.toxicity(awkward, none, spans=True).collect()
    assert len(rows) == awkward.count() and all(r.predicted == 0 and r.hits == [] for r in rows)
    both = spark.createDataFrame([(i, "so idiot here" if i % 2 else "so kind here", i % 2) for i in range(60)] + [(99, None, 0), (98, "x", None)], "doc_id bigint, text string, y int")
    learned = T.fitted(both)
    got = {r.doc_id: r for r in T.toxicity(both, learned, spans=True).collect()}
    assert got[1].predicted == 1 and got[1].hits == ["idi"] and got[2].predicted == 0 and got[99].predicted == 0


def test_samples_are_bounded_and_repeatable(spark):
    from llm.sampling import bounded_sample

    rows = spark.range(5_000).selectExpr("id % 4000 AS doc_id", "'t' AS text")
    some = sorted(r.doc_id for r in bounded_sample(rows, ["doc_id", "text"], 300).collect())
    assert len(some) <= 300 and len(set(some)) == len(some) > 200
    assert some == sorted(r.doc_id for r in bounded_sample(rows.repartition(7), ["doc_id", "text"], 300).collect())
    assert bounded_sample(rows, ["doc_id", "text"], 10_000).count() == 4_000 and bounded_sample(rows.limit(0), ["doc_id"], 5).count() == 0


def test_hits_equal_a_plain_scan_and_are_linear():
    """Every hit against every phrase, for random texts; then 40,000 hits beside as many phrases."""
    rng = np.random.default_rng(12)
    words = ["bad", "badly", "worse", "not", "so", "fine"]
    lexicon = T.Lexicon({"bad": 2.0, "badl": 3.0, "worse": 1.0}, ("not bad", "bad so", "so worse"))
    automaton = lexicon.automaton()
    for _ in range(200):
        text = T.folded(" ".join(rng.choice(words, rng.integers(0, 30))))
        spared = [(m.start(), m.start() + len(p) + 2) for p in lexicon.exceptions for m in re.finditer(f"(?= {p} )", text)]
        want = {}
        for stem, weight in lexicon.entries.items():
            for m in re.finditer(f"(?= {stem})", text):
                want[m.start()] = max(want.get(m.start(), (0.0, 0)), (weight, m.start() + len(stem) + 1))
        plain = sorted((a + 1, end, w) for a, (w, end) in want.items() if not any(x <= a and end <= y for x, y in spared))
        assert sorted(lexicon.hits(automaton, text)) == plain
    started = time.perf_counter()
    assert len(list(lexicon.hits(automaton, T.folded("not bad bad " * 40_000)))) == 40_000
    assert time.perf_counter() - started < 5
