import re
import time
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import FOLDER
from llm import config_packing as P
from llm import edit_decontamination as D
from llm import host_reputation as H
from llm import mincut_extraction as X

PATH = public_tokenizers.path(P.TOKENIZER)


def test_ids_equal_the_tokenizer():
    texts = [t or "" for t in pd.read_parquet(f"{FOLDER}/documents.parquet").text]
    texts += ["", " ", "a  b\n\n c\t", "don't  we'll\r\n", "x\x1cy\x85z\xa0w", "Ünï 12³½ ٣ 漢字 🙂", "a<|endoftext|>b", "ⅷ ǅ _-_ $$$ \u2028 q", "\n \n"]
    encoder, tokenizer = P.Encoder(PATH, remembered=50), Tokenizer.from_file(PATH)
    for text in texts:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, text


def check_packing(pieces, capacity):
    by = pieces.sort_values(["sequence_id", "offset"])
    total = by.groupby("sequence_id").length.cumsum()
    assert (by.offset == total - by.length).all() and by.groupby("sequence_id").length.sum().max() <= capacity


def test_packing_whole_table(spark):
    got = P.op8_config_packing(spark, FOLDER).toPandas()
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for i, t in pd.read_parquet(f"{FOLDER}/documents.parquet")[["doc_id", "text"]].itertuples(index=False):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want += [(i, k, a, n, zlib.crc32(ids[a : a + n].tobytes())) for k, (a, n) in enumerate(P.pieces_of(len(ids), 1024))]
    assert sorted(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    check_packing(got, 1024)
    assert got.sequence_id.nunique() <= np.ceil(got.length.sum() / 1024) * 1.03 + 1


def best_fit_decreasing(lengths, capacity):
    rooms = Counter()
    for length in sorted(lengths.elements(), reverse=True):
        room = min((r for r in rooms if r >= length and rooms[r]), default=None)
        if room is not None:
            rooms[room] -= 1
        rooms[(capacity if room is None else room) - length] += 1
    return sum(rooms.values())


def test_pieces_and_configurations():
    assert list(P.pieces_of(5, 4)) == [(0, 1), (1, 4)] and list(P.pieces_of(8, 4)) == [(0, 4), (4, 4)] and list(P.pieces_of(0, 4)) == []
    rng = np.random.default_rng(0)
    for _ in range(5):
        lengths = Counter(rng.integers(1, 64, 3000).tolist())
        chosen = P.configurations(lengths, 64)
        assert sum((Counter({k: c * n for k, c in Counter(p).items()}) for p, n in chosen), Counter()) == lengths
        assert all(sum(p) <= 64 for p, _ in chosen)
        assert sum(n for _, n in chosen) <= best_fit_decreasing(lengths, 64) * 1.005 + 2
    assert P.configurations({}, 64) == [] and P.configurations({40: 3}, 64) == [((40,), 3)]


def test_every_round_runs_and_programs_place_nearly_all(monkeypatch):
    """Needs of one or a few pieces: weights are lowered in every round, and best fit gets only a remnant."""
    rng = np.random.default_rng(1)
    for rows in (400, 4000):
        need = np.bincount(rng.integers(1, 256, rows), minlength=257)
        prices, priced = [], P.priced
        monkeypatch.setattr(P, "priced", lambda weight, capacity: prices.append(1) or priced(weight, capacity))  # noqa: B023
        P.configurations({y: int(n) for y, n in enumerate(need) if n}, 256)
        assert len(prices) >= P.ROUNDS
        monkeypatch.undo()
        placed, rest = P.solved(need, 256)
        assert sum((Counter({k: c * n for k, c in Counter(p).items()}) for p, n in (placed + rest).items()), Counter()) == Counter({y: int(n) for y, n in enumerate(need) if n})
        assert rest.total() <= 0.05 * placed.total()
        assert (placed + rest).total() <= best_fit_decreasing(Counter({y: int(n) for y, n in enumerate(need) if n}), 256) * 1.01 + 1


def test_packing_awkward_rows(awkward, empty, spark):
    pieces = P.best_fit_packing(awkward).toPandas()
    check_packing(pieces, 1024)
    assert len(pieces[pieces.piece == 0]) == awkward.count() and (pieces[pieces.doc_id == 1].length == 1).all()
    assert P.best_fit_packing(empty).collect() == []
    whole = P.sequences(P.best_fit_packing(awkward.where("doc_id = 6")), awkward.where("doc_id = 6"), PATH).toPandas()
    assert all(zlib.crc32(np.array(x, "<u4").tobytes()) == c for x, c in zip(whole.ids, whole.ids_crc32, strict=True))


def distance(a, b):
    """Least edit distance of a to a substring of b, by the table."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return min(row)


def test_myers_equals_the_table():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = "".join(rng.choice(list("abc"), rng.integers(1, 90)))
        b = "".join(rng.choice(list("abc"), rng.integers(0, 40)))
        best, end = D.best_match(D.masks_of(a), len(a), b)
        assert best == distance(a, b)
        assert best == len(a) or distance(a, b[:end]) == best


def test_edited_items_are_found():
    rng = np.random.default_rng(8)
    letters = list("abcdefghij ")
    items = [(k, "".join(rng.choice(letters, 150))) for k in range(6)]
    finder = D.Finder(D.items_of(items))
    texts = ["".join(rng.choice(letters, 400)) for _ in range(30)]
    for n in range(24):
        item = list(items[n % 6][1])
        for _ in range(n // 2):
            at = int(rng.integers(0, len(item)))
            item[at : at + int(rng.integers(0, 2))] = rng.choice(letters, int(rng.integers(0, 2)))
        texts[n] = texts[n][:200] + "".join(item) + texts[n][200:]
    for text in texts:
        text = D.normal(text)
        want = {i.item_id: distance(i.text, text) for i in finder.items}
        assert {k: d for k, _, _, d in finder.find(text)} == {k: d for k, d in want.items() if d <= next(i.budget for i in finder.items if i.item_id == k)}


def test_leaks_whole_table_and_awkward_rows(spark, awkward, empty):
    docs, items = (pd.read_parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in D.op6_edit_decontamination(spark, FOLDER).collect()}
    exact = {(i, k) for i, t in zip(docs.doc_id, docs.text, strict=True) for k, x in zip(items.item_id, items.text, strict=True) if D.normal(x) in D.normal(t)}
    assert exact and exact <= got and len(got) <= len(exact) + 2
    tests = spark.createDataFrame([(1, "Brown FOX  jumps over the lazy dog"), (2, None), (None, "fox"), (3, " "), (4, "é"), (5, "Brown fox jumps over the lazy dog")], "item_id bigint, text string")
    rows = D.leaks(awkward, tests, block_chars=20).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(i, k) for i in (4, 5, None) for k in (1, 5)} | {(8, 4)}
    left = D.clean_of(awkward, tests)
    assert left.columns == awkward.columns and sorted(str(r.doc_id) for r in left.collect()) == ["1", "2", "3", "6", "7", "None"]
    assert D.leaks(empty, tests).collect() == [] and D.leaks(awkward, tests.limit(0)).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p><p>no";</script></head><body class="comments-open">
<header><h1>Site</h1></header><div class="cookie-notice">We use cookies.</div><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
<main><article><h1>Title</h1><p><b>First &amp; more &#233;&nbsp;x<br>line two.<p>Second   one.</p><div class="ad">Buy now! Great offers, today.</div><h2>Sub</h2><p>Ok.</p>
<ul><li>alpha</li><li>beta <a href=x>gamma</a></li></ul><form><label>Mail</label><button>Send</button></form><!-- <p>no</p> --></article>
<aside class="sidebar"><p>Some long text here. Another sentence, too.</p></aside><section id="comments"><p>I agree, really. Yes, very much so.</p></section></main>
<footer>&copy; 2020 Someone. All rights reserved.</footer></body></html>"""


def test_main_text():
    assert X.main_text(PAGE) == "Title\nFirst & more é x line two.\nSecond one.\nSub\nOk.\nalpha\nbeta gamma"
    assert X.main_text(None) == X.main_text("") == X.main_text("<html><body></body>") == ""
    assert X.main_text("<article><p>One.</p><p>Two &am") == "One.\nTwo &am" and X.main_text("<article><p>One.</p><p") == "One."
    assert X.main_text("<article><p>1 < 2 and <b>x</article>") == "1 < 2 and x"


def cut_cost(side, source, sink, edges):
    return sum(t if s else c for s, c, t in zip(side, source, sink, strict=True)) + sum(c for a, b, c in edges if side[a] != side[b])


def test_minimum_cut_equals_all_labellings():
    rng = np.random.default_rng(6)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        source, sink = rng.random(n).tolist(), rng.random(n).tolist()
        edges = [(a, b, float(rng.random() / 2)) for a in range(n) for b in range(a) if rng.random() < 0.6]
        best = min(cut_cost([bool(m >> i & 1) for i in range(n)], source, sink, edges) for m in range(1 << n))
        assert abs(cut_cost(X.minimum_cut(source, sink, edges), source, sink, edges) - best) < 1e-6


def test_pages_whole_table_and_awkward_rows(spark):
    pages = pd.read_parquet(f"{FOLDER}/pages.parquet")
    got = X.op5_mincut_extraction(spark, FOLDER).toPandas()
    assert len(got) == len(pages) and (got.n_chars == got.text.str.len()).all() and got.text.str.len().min() > 0
    odd = spark.createDataFrame([(1, None, None, 1), (None, "u", PAGE, 2), (2, "u", "<p>" * 3000, 3), (2, "u", "x" * 200_000, 3)], "page_id bigint, url string, html string, text int")
    assert sorted(r.n_chars for r in X.extracted(odd).collect()) == [0, 0, len(X.main_text(PAGE)), 200_000]
    assert X.extracted(odd.limit(0)).collect() == []


def test_text_that_only_looks_hidden_or_boilerplate_stays():
    assert X.main_text('<article><p>One.</p><div title="a hidden gem"><p>Kept text here.</p></div></article>') == "One.\nKept text here."
    assert X.main_text('<article><div class="body hidden md:block">Kept words here.</div></article>') == "Kept words here."
    assert X.main_text("<article><p>One <span hidden>gone</p><p>Two stays.</p></article>") == "One\nTwo stays."
    assert X.main_text('<article><p style="color:red; display : none">Gone.</p><p aria-hidden=true>Gone.</p><p>Stays.</p></article>') == "Stays."
    names = '<article><div class="story share-market"><p>Shares rose.</p></div><div id="search-results-study"><p>We study.</p></div>'
    assert X.main_text(names + '<div class="shareButtons">Tweet this, now.</div><div id="cookie-notice">We use cookies, as all do.</div></article>') == "Shares rose.\nWe study."
    assert X.main_text("<head><meta charset=utf-8><body><article><p>Text, though the head never ends.</p></article>") == "Text, though the head never ends."
    assert X.main_text("<article><svg><text>x</text></svg><p>A.</p><script>if (a</script><p>B.</p></article>") == "A.\nB."
    deep = "<article>" + "<div>" * 3000 + "<p>Deep text.</p>" + "</div>" * 3000 + "<p>After it.</p></article>"
    assert X.main_text(deep) == "Deep text.\nAfter it."


def test_weights_are_learned_and_blocks_are_right(spark):
    """Precision and recall of characters of block text, on all pages, with names and without them."""
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    weights = X.learned(pages)
    assert weights != X.PRIOR and len(weights) == len(X.PRIOR)
    assert X.learned(pages.limit(0)) == X.PRIOR and X.learned(pages.limit(1).selectExpr("CAST(NULL AS string) AS html")) == X.PRIOR
    for plain in (False, True):
        right = got = want = 0
        for page in pages.toPandas().html:
            article = {id(b): b.text for b in X.blocks_of(page) if b.hints >= X.SURE}
            true = Counter(article.values())
            if plain:  # the article has no name any more; menus and footers keep theirs
                page = re.sub("<(/?)article>", r"<\1div>", page)
            found = Counter(b.text for b, content in X.labelled(page, weights) if content)
            right += sum(len(t) * n for t, n in (found & true).items())
            got += sum(len(t) * n for t, n in found.items())
            want += sum(len(t) * n for t, n in true.items())
        assert right >= 0.99 * got and right >= 0.99 * want


def test_short_items_and_many_matches():
    finder = D.Finder(D.items_of([(1, "a"), (2, "fox")]))
    assert list(finder.find("banana and a fox")) == [(1, 11, 12, 0), (2, 13, 16, 0)] and not list(finder.find("bananas " * 3000))
    started = time.perf_counter()
    assert len(list(finder.find("a " * 40_000))) == 40_000
    assert time.perf_counter() - started < 10


def test_registries_addresses_and_ports(spark):
    """Bad pages of one domain say nothing about others below the same registry."""
    bad = [(k, f"https://www{k % 3}.bad.co.uk/{k}") for k in range(60)] + [(100 + k, f"http://10.0.0.7:80{k}/") for k in range(40)]
    rest = [(200, "http://gov.co.uk/"), (201, "http://bbc.co.uk:8080/x"), (202, "http://10.0.0.8/"), (203, "http://x@www9.bad.co.uk/"), (204, "http://good.test/"), (205, "http://7.7/")]
    good = [(300 + k, f"http://site{k}.good.uk/") for k in range(150)] + [(500 + k, f"http://fine{k}.co.uk/") for k in range(60)]
    pages = spark.createDataFrame(bad + rest + good, "page_id bigint, url string")
    outcomes = spark.createDataFrame([(k, 1) for k, _ in bad] + [(k, 0) for k, _ in good], "page_id bigint, bad int")
    got = {r.page_id: r.verdict for r in H.url_filter(pages, outcomes).collect()}
    assert {k for k, v in got.items() if v == "block"} == {k for k, _ in bad} | {203}
    names = spark.createDataFrame([(h,) for h in ("a.b.co.uk", "co.uk", "www.x.de", "1.2.3.4:80", "u@q.com.au:1", "", "de", "x.notco.uk")], "h string")
    domain, suffix = H.levels(names.h)
    assert [tuple(r) for r in names.select(domain, suffix).collect()] == [
        ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("x.de", "de"), ("1.2.3.4", "1.2.3.4"), ("q.com.au", "com.au"), ("", ""), ("de", "de"), ("notco.uk", "uk"),
    ]


def test_pipeline_refuses_unlearned_scripts_and_random_characters(spark, wide):
    """Hexadecimal digits, letters at random and other scripts go; the table's own documents stay."""
    rng = np.random.default_rng(3)
    odd = ["".join(rng.choice(list("0123456789abcdef"), 400)) for _ in range(10)]
    odd += ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 400)) for _ in range(10)]
    odd += ["Это обычный русский текст, который никто не учил. " * 5, "これは日本語の文章です。学習された言語ではありません。" * 8]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    mixed = docs.unionByName(wide([(10**6 + k, t) for k, t in enumerate(odd)]).selectExpr(*[f"CAST({c} AS {t}) AS {c}" if c in ("doc_id", "text") else f"CAST(NULL AS {t}) AS {c}" for c, t in docs.dtypes]))
    kept = {r.doc_id for r in corpus_pipeline.language(spark, mixed, FOLDER).collect()}
    assert kept == {r.doc_id for r in docs.collect()}


def test_rules_and_reputation(spark):
    odd = [(1, None), (2, "no scheme"), (3, "http://A.Net/x?y"), (4, "http://www.example.net/en/1#z"), (5, "http://net"), (6, "http://x.example.com/de/"), (7, "https://y.ORG/fr/"), (8, "http://bad.example.com/a"), (9, "http://xnet/"), (None, "http://bad.example.com?a://b/c")]
    pages = spark.createDataFrame([(i, u, 0) for i, u in odd] + [(100 + i, f"http://bad.example.com/{i}", 0) for i in range(60)], "page_id bigint, url string, mean int")
    outcomes = spark.createDataFrame([(100 + i, 1) for i in range(60)] + [(3, 0), (3, None), (None, 1), (7, 0)], "page_id bigint, bad int")
    got = {r.page_id: r for r in H.url_filter(pages, outcomes).collect() if r.page_id is None or r.page_id < 100}
    assert (got[1].host, got[1].path, got[2].host, got[5].path) == ("", "", "", "") and got[3].host == "a.net"
    assert {i: (r.rule, r.verdict) for i, r in got.items() if r.rule} == {3: ("net/", "block"), 4: ("example.net/en/", "allow"), 6: ("example.com/de/", "block"), 7: ("org/fr/", "allow")}
    assert got[8].verdict == "block" and (got[None].host, got[None].path, got[None].verdict) == ("bad.example.com", "", "block")
    assert H.url_filter(pages.limit(0), outcomes).collect() == []
    assert {r.verdict for r in H.url_filter(pages, outcomes.limit(0)).collect() if not r.rule} == {"allow"}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_passages", "decontaminated", "packing"]
    kept = corpus_pipeline.language(spark, docs, FOLDER)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    near = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert near.columns == docs.columns
    from llm.circulant_minhash import near_duplicates

    same = near_duplicates(docs, percent=corpus_pipeline.PERCENT, bands=corpus_pipeline.BANDS, rows=corpus_pipeline.BAND_ROWS)
    assert sorted(r.doc_id for r in near.collect()) == sorted(r.doc_id for r in same.where("kept").collect())
    clean = corpus_pipeline.decontaminated(spark, docs, FOLDER)
    dirty = {r.doc_id for r in D.op6_edit_decontamination(spark, FOLDER).collect()}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - dirty
    pieces = corpus_pipeline.run(spark, FOLDER).toPandas()
    check_packing(pieces, 1024)
    assert set(pieces.doc_id) <= {r.doc_id for r in near.collect()} - (dirty & set())


def test_pipeline_awkward_rows(spark, awkward, empty):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, awkward, FOLDER)
        assert out.columns == awkward.columns
        assert out.count() <= awkward.count() and stage(spark, empty, FOLDER).count() == 0


def test_pipeline_passages_of_fifty_words(spark, wide):
    """Passages of 50 to 70 words that repeat go, byte by byte as in brute force; other columns stay as they are."""
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 9))) for _ in range(4000)]

    def some(n):
        return " ".join(rng.choice(words, n))

    passages = [some(n) for n in range(50, 71)]
    assert min(map(len, passages)) >= corpus_pipeline.PASSAGE
    docs = [(10 * k + m, f"{some(90)} {p} {some(90)}") for k, p in enumerate(passages) for m in range(1 + k % 3 + (k % 3 == 0))]
    docs += [(1000 + k, some(200)) for k in range(20)] + [(2000, None), (2001, ""), (2002, passages[0][:200])]
    raw, n, starts = [(t or "").encode() for _, t in docs], corpus_pipeline.PASSAGE, {}
    for i, x in enumerate(raw):
        for at in range(len(x) - n + 1):
            starts.setdefault(x[at : at + n], []).append((i, at))
    gone = [np.zeros(len(x), bool) for x in raw]
    for places in starts.values():
        for i, at in places if len(places) > 1 else ():
            gone[i][at : at + n] = True
    want = {i: None if t is None else bytes(np.frombuffer(x, np.uint8)[~g]).decode() for (i, t), x, g in zip(docs, raw, gone, strict=True)}
    got = corpus_pipeline.repeated_passages(spark, wide(docs), FOLDER).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert {(r["_row"], r["_d"], r["_h"], r["_kept"], r["row"], r["doc"]) for r in got} == {(77, 78, "h", "k", 79, "d")}
    assert not [p for p in passages for t in want.values() if t and p in t] and all(want[1000 + k] for k in range(20))
    assert {r["_row"] for r in corpus_pipeline.near_duplicates(spark, wide(docs), FOLDER).collect()} == {77}


def test_pipeline_near_duplicates_at_four_fifths(spark, wide):
    """Near copies at 0.80 to 0.85 go, those below stay; texts that share only an id stay."""
    rng = np.random.default_rng(11)
    docs = []
    for g in range(40):
        base = [f"g{g}w{k}" for k in range(204)]  # 200 shingles
        own = list(base)
        for at in rng.choice(np.arange(5, 199, 6), g % 6, replace=False):  # each changed word costs five shingles or fewer
            own[at] = "other"
        docs += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(own))]
    docs += [(500, " ".join(f"x{k}" for k in range(50))), (500, " ".join(f"y{k}" for k in range(50))), (500, " ".join(f"y{k}" for k in range(51)))]

    def shingles(text):
        w = text.split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    want, between = {500}, 0
    for (a, x), (b, y) in zip(docs[:80:2], docs[1:80:2], strict=True):
        x, y = shingles(x), shingles(y)
        near = len(x & y) / len(x | y)
        between += 0.8 <= near < 0.85
        want |= {a} if near >= 0.8 else {a, b}
    assert between > 5
    got = corpus_pipeline.near_duplicates(spark, wide(docs), FOLDER).collect()
    assert {r.doc_id for r in got} == want
    assert sorted(r.text[0] for r in got if r.doc_id == 500) == ["x", "y"]


def test_pipeline_near_duplicates_equal_brute_force(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in zip(docs.doc_id, docs.text, strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    least = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    got = corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER)
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i in sets if least[i] == i)
