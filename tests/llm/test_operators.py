"""Corpus operators against brute force, and their edge cases: NULLs, empty
and long texts, ties, repeated rows, empty tables, clashing column names."""
import html
import itertools
import math
import operator
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, lines, nearcopy, pieces, sharding, suffixes, template, tokencount, topk, wordhash
from tidemark.llm.decontam import contaminated

DOCS = "doc_id long, text string"


def prose(seed, n, names=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(names)}x" for _ in range(n))


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_word_hashes_tell_words_apart():
    texts = ["Ab c\nab", None, "", "é1 É1 _x", " ".join(f"t{i}" for i in range(300_000))]
    got = [(flat, sizes) for _, _, flat, sizes in wordhash.word_hashes(texts)]
    sizes = np.concatenate([s for _, s in got])
    assert sizes.tolist() == [len(words(t)) for t in texts]
    flat = np.concatenate([f for f, _ in got])
    assert flat[0] == flat[2] != flat[1] and flat[3] == flat[4]
    assert len(np.unique(flat)) == len({w for t in texts for w in words(t)})


# --- op1 ------------------------------------------------------------------------

@pytest.mark.parametrize("clustered", [False, True])
def test_top_k_is_exact(spark, clustered):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 6)) * 0.3
    if clustered:
        x = rng.normal(size=(7, 6))[np.arange(700) % 7] + x * 0.02
    rows = [(i, [float(v) for v in x[i]]) for i in range(700)]
    rows += [(700, None), (701, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (702, [float("nan")] * 6),
             (703, [float("inf")] * 6), (None, [0.0] * 6), (704, [1.0, 2.0]), (5, rows[5][1]),
             *[(800 + i, [0.25] * 6) for i in range(30)]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id % 20 = 0"), 20, tile=128, query_tile=16, run=2, sample=300, pivots=12).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == top_brute(rows, 20, lambda i: i % 20 == 0)


def top_brute(rows, k, asked, scale=64):
    """Every row but the query's own, by row."""
    z = [(i, tuple(math.floor(c * scale) for c in v)) for i, v in rows
         if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    want = []
    for at, (i, q) in enumerate(z):
        if asked(i):
            best = sorted((-min(max(sum(map(operator.mul, q, c)), topk.LONG_MIN), topk.LONG_MAX), j)
                          for other, (j, c) in enumerate(z) if other != at and len(c) == len(q))[:k]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(want)


def test_top_k_keeps_every_row(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(round(v)) for v in rng.normal(size=3) * 3]) for i in rng.integers(0, 25, 90)]
    rows += rows[:30] + rows[:3] + [(0, [1.0, 2.0, 3.0])] * 7 + [(1, [0.5]), (1, [0.5]), (2, [0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("clash"))
    got = topk.top_k(df, df.where("vec_id % 3 = 0"), 8, tile=20, query_tile=7, run=2, sample=50, pivots=5).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == top_brute(rows, 8, lambda i: i % 3 == 0)


@pytest.mark.parametrize("base", [2.0**20, 2.0**25, 2.0**31, 1e15])
def test_top_k_ties_and_cancelling_beyond_the_doubles(spark, base):
    rng = random.Random(base)
    rows = [(0, [base + 1, -base, 1.0])]
    for i in range(1, 60):
        a = base * rng.choice([1, -1, 2]) + rng.randrange(-2, 3)
        rows.append((i, [a, a + rng.randrange(-1, 2), float(rng.randrange(3))]))
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, [c / 64 for c in v]) for i, v in rows], "vec_id long, embedding array<double>")
    got = topk.top_k(df, df, 5, tile=9, query_tile=5, run=1, sample=30, pivots=4).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == top_brute(rows, 5, lambda i: True, 1)


def test_top_k_prunes_clustered_vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 300
    x = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)))
    search = topk.Search(np.arange(200), np.ones(200, dtype=np.int64), x[:200], 20)
    for lo in range(0, 4000, 1000):
        search.see(np.arange(lo, lo + 1000), np.ones(1000, dtype=np.int64), x[lo:lo + 1000])
    assert search.scored < 0.1 * 200 * 4000
    z = x[:200] @ x.T
    z[np.arange(200), np.arange(200)] = -np.inf
    want = [sorted(zip(-z[i], range(4000), strict=True))[:20] for i in range(200)]
    got = {q: b for q, b in zip(search.ids.tolist(), search.best, strict=True)}
    assert all([(s, j) for s, j, _ in got[i]] == [(int(s), j) for s, j in want[i]] for i in range(200))
    assert len(topk.CoverTree(rng.normal(size=(2000, 64))).lo) > 30   # a tree also where nothing clusters


def test_top_k_large_components_and_empty(spark):
    rows = [(0, [1e15, 1.0]), (1, [1e15, 2.0]), (2, [-1e300, 0.0]), (3, [0.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df, df, 2).collect()}
    assert got[3, 1] == (1, 320 * 128) and got[0, 1] == (1, topk.LONG_MAX)
    assert topk.top_k(df.limit(0), df.limit(0), 2).count() == 0


# --- op4 ------------------------------------------------------------------------

def near_brute(rows):
    sets, wordless = {}, {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(t)
        if w:
            sets.setdefault(i, Counter(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))))
        else:
            wordless.setdefault(t or "", []).append(i)
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for ids in wordless.values():
        root.update(dict.fromkeys(ids, min(ids)))
    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x.keys() & y.keys():
            s = sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x | y) for d in x.keys() & y.keys())
            if s >= 0.8 - 1e-12:
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: find(i) for i in root}


def test_near_copies_of_a_large_group(spark):
    rng = random.Random(3)
    base = words(prose(1, 80, 5000))
    rows = [(None, "a b c d e f"), (9000, None), (9001, ""), (9002, "..."), (9003, "one two"), (9004, "one two"),
            (9005, "..."), (9006, " ... "), (9007, "\U0001F600!"), (9008, "\U0001F600!"), (9009, None)]
    for i in range(45):
        w = list(base)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = f"e{i}n{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    rows += [(500 + i, prose(50 + i, 60)) for i in range(30)] + [(7, rows[13][1])]
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.class_id for r in nearcopy.near_copies(df).collect()}
    assert got == near_brute(rows)
    assert nearcopy.near_copies(df.limit(0)).count() == 0


# --- op10 -----------------------------------------------------------------------

def passages_brute(rows, n):
    where, docs = {}, [(i, words(t)) for i, t in dict.fromkeys(rows) if i is not None]
    for i, w in docs:
        for s in range(len(w) - n + 1):
            where.setdefault(tuple(w[s:s + n]), set()).add(i)
    out = []
    for i, w in docs:
        at = [s for s in range(len(w) - n + 1) if len(where[tuple(w[s:s + n])]) > 1]
        for s in at:
            if s - 1 not in at:
                end = next(e for e in itertools.count(s) if e + 1 not in at)
                out.append((i, s, end - s + n, min(where[tuple(w[s:s + n])])))
    return sorted(out)


def passage_rows(seed, n=50):
    rng = random.Random(seed)
    shared = [prose(900 + i, 70, 5000) for i in range(3)]
    rows = [(None, shared[0]), (900, None), (901, ""), (902, "x " * 3000), (903, "x " * 60), (904, shared[0])]
    for i in range(40):
        parts = [prose(i * 7 + j, rng.randrange(5, 60), 5000) for j in range(3)]
        p = shared[i % 3].split()
        lo = rng.randrange(0, 25)
        parts.insert(1, " ".join(p[lo:lo + rng.randrange(44, 70)]))
        rows.append((i, ".\n".join(parts)))
    a, b = (" ".join(shared[i].split()[:50]) for i in (0, 1))
    rows += [(950, a + " and " + prose(1, 9) + " " + b), (951, a + " " + b), (951, b + " " + a)]   # touching
    rows += [(960 + i, shared[2] + " " + shared[0]) for i in range(12)] + rows[10:12]
    return rows


@pytest.mark.parametrize("n,k", [(50, 15), (20, 3), (9, 9), (5, 1)])
def test_repeated_passages_are_exact(spark, n, k):
    rows = passage_rows(n)
    df = spark.createDataFrame(rows, DOCS).repartition(6).withColumn("fp", F.lit("clash"))
    for batch in ("10000", "7"):    # chains cut at every batch
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            got = sorted((r.doc_id, r.start, r.n_words, r.first_id) for r in suffixes.passages(df, length=n, k=k).collect())
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == passages_brute(rows, n)
    assert any(r[0] == 951 and r[2] == n for r in got) or n < 50


def test_repeated_passages_repeated_and_empty_tables(spark):
    df = spark.createDataFrame(passage_rows(1), DOCS)
    assert suffixes.passages(df.limit(0)).count() == 0
    assert suffixes.passages(df.union(df)).count() == suffixes.passages(df).count()


# --- op9 ------------------------------------------------------------------------

def test_language_id_held_out_and_edges(spark):
    sound = {"aa": "ka lo mi ne pu".split(), "bb": "shr ght wor eld ing".split(), "cc": "ção ñez él ür öß".split()}
    rng = random.Random(2)
    rows = [(i, " ".join("".join(rng.choices(sound[g], k=2)) for _ in range(rng.randrange(1, 60))), g)
            for i, g in enumerate(rng.choices(list(sound), k=300))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learned(df)
    odd = spark.createDataFrame([(1000, None, 1), (1001, "", 2), (1002, "12 .. 3", 3), (None, "kalo mine", 4),
                                 (1003, "中文", 5), (1004, "kalo " * 900_000, 6)],
                                "doc_id long, text string, LANG_PRED int")
    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in langid.identify(odd, model).collect()}
    assert [got[i] for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[None][0] == got[1004][0] == "aa" and got[1003][0] in sound
    out = langid.identify(df, model).select("doc_id", "lang", "lang_pred", langid.held_out(F.col("doc_id")).alias("h"),
                                            "lang_score").collect()
    assert all(r.lang == r.lang_pred and 0 <= r.lang_score <= 1 for r in out if r.h)
    none = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}


def spectrum(text):
    t = re.sub(r"[^a-zà-ÿ]+", " ", f" {text.lower()} ")
    return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}


def test_language_id_against_explicit_kernel_ridge(spark):
    """All rows are landmarks here, so the fit is kernel ridge regression on
    the whole kernel matrix."""
    rng = random.Random(9)
    sound = {"aa": "ka lo mi ne pu", "bb": "ke lo mu ne ap", "cc": "ok al im en up"}
    rows = [(i, " ".join("".join(rng.choices(sound[g].split(), k=2)) for _ in range(rng.randrange(1, 9))), g)
            for i, g in enumerate(rng.choices(list(sound), k=36))]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    marks = list({frozenset(spectrum(t)) for _, t, _ in rows})
    known, langs = set().union(*marks), sorted(sound)

    def kernel(x):
        x = x & known
        return [len(x & m) / math.sqrt(len(x) * len(m)) for m in marks] + [1.0]
    k = np.array([kernel(spectrum(t)) for _, t, _ in rows])
    y = np.array([[1.0 if g == x else -1.0 for x in langs] for _, _, g in rows])
    gram = np.zeros((len(marks) + 1,) * 2)
    gram[:-1, :-1] = [kernel(set(m))[:-1] for m in marks]
    gram[-1, -1] = 1e-3
    alpha = np.linalg.lstsq(k.T @ k + langid.RIDGE * len(rows) * (gram + 1e-6 * np.eye(len(gram))), k.T @ y, rcond=None)[0]
    new = [" ".join("".join(rng.choices(sound[g].split(), k=2)) for _ in range(rng.randrange(1, 9))) for g in sound for _ in range(9)]
    got = langid.identify(spark.createDataFrame(list(enumerate(new)), "doc_id long, text string"), model).collect()
    for r in got:
        f = np.array(kernel(spectrum(r.text))) @ alpha
        assert r.lang_score == pytest.approx(min(1, max(0, (f.max() + 1) / 2)), abs=2e-3)
        if np.diff(np.sort(f))[-1] > 1e-2:
            assert r.lang_pred == langs[int(f.argmax())]


def test_language_id_chooses_the_least_hashes(spark, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_PER_LANG", 7)
    rows = [(i, f"text {'ab' if i % 3 else 'ba'}", "aa" if i % 3 else "bb") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(langid.Basis, "__init__", lambda self, known, sets, f=langid.Basis.__init__: (seen.append(len(sets)), f(self, known, sets))[1])
    assert langid.fit(df).languages == ["aa", "bb"] and seen == [2]


def test_language_id_learns_all_languages_and_letters(spark):
    rng = random.Random(8)
    sound = {f"l{g:02d}": [chr(rng.randrange(97, 123)) + chr(rng.randrange(97, 123)) for _ in range(4)] for g in range(66)}
    # three languages of many letters of their own, beyond the 120 most frequent
    sound |= {f"c{g}": [chr(0x4E00 + 300 * g + i) for i in range(150)] for g in range(2)}
    sound["c2"] = [chr(0x20000 + i) for i in range(150)]

    def text(g):
        return " ".join("".join(rng.choices(sound[g], k=3)) for _ in range(25))

    rows = [(i, text(g), g) for i, g in enumerate([g for g in sound for _ in range(6)])]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    held = {c for _, t, _ in rows for c in t if c != " "}
    assert model.languages == sorted(sound) and held == set(model.letters)
    new = spark.createDataFrame([(text(g), g) for g in sound for _ in range(2)], "text string, lang string")
    got = langid.identify(new, model).collect()
    assert [(r.lang, r.lang_pred) for r in got if r.lang != r.lang_pred] == []


# --- op6 ------------------------------------------------------------------------

PAGE = ('<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li>menu {i}</li></ul></nav>'
        '<div class="ad">buy {i}</div>{open}<h1>Head {i}</h1><p><b>Fish &amp; chips<br>now<p>a < b &lt;i&gt; {i}</p>'
        '<form><p>mail</p></form>{close}<div id="comments"><p>first!</p></div><aside>more</aside>'
        '<footer>&copy; {i}</footer></body></html>')


@pytest.mark.parametrize("around", [("<article>", "</article>"), ('<div class="post">', "</div>")])
def test_main_text(spark, around):
    rows = [(i, f"https://h.example/{i}", PAGE.format(i=i, open=around[0], close=around[1])) for i in range(5)]
    rows += [(10, None, rows[0][2]), (11, "https://one.example/", rows[1][2]), (12, "https://h.example/x", None),
             (13, "https://h.example/y", ""), (14, "https://h.example/z", "plain &amp; text <scr"), rows[3]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = template.main_text(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for i in range(5):
        assert by[i].text == f"Head {i}\n\nFish & chips now\n\na < b <i> {i}"
        assert by[i].n_chars == len(by[i].text) and by[i].n_template >= 3
    assert by[10].text == by[0].text and by[11].text == by[1].text
    assert by[12].text == by[13].text == "" and by[14].text == "plain & text"
    assert template.main_text(df.limit(0)).count() == 0


def main_texts(spark, pages):
    rows = [(i, f"https://{host}/{i}", page) for i, (host, page) in enumerate(pages)]
    got = template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


@pytest.mark.parametrize("around", ['<div class="content has-sidebar">', '<article class="post comments-open">',
                                    '<div class="overflow-hidden">', '<main class="page no-footer">',
                                    '<div class="sidebar">', '<div class="menu-left wrap">'])
def test_main_text_modifier_classes(spark, around):
    page = ('<html><body><div class="page">{a}<h1>Head {i}</h1><p>Text number {i} of a longer story</p>'
            '<div class="sidebar-left"><p>see {i}</p></div>{b}<div id="comments"><p>no {i}</p></div></div></body></html>')
    end = f"</{re.match('<([a-z]+)', around)[1]}>"
    got = main_texts(spark, [(h, page.format(a=around, b=end, i=i)) for h in ("h.example",) for i in range(4)]
                     + [("one.example", page.format(a=around, b=end, i=4))])
    assert got == [f"Head {i}\n\nText number {i} of a longer story" for i in range(5)]


def test_main_text_keeps_all_slots(spark):
    page = ('<html><body><nav><p>menu {i}</p></nav><div class="post"><h1>Head {i}</h1><div class="lead"><p>Lead {i}</p></div>'
            '<div class="body"><p>{long}</p></div></div><footer>end {i}</footer></body></html>')
    other = ('<html><body><nav><p>menu {i}</p></nav><div class="intro"><p>Intro {i}</p></div><div class="post"><h1>Head {i}</h1>'
             '<div class="body"><p>{long}</p></div></div><footer>end {i}</footer></body></html>')
    long = [prose(i, 60) for i in range(9)]
    got = main_texts(spark, [("h.example", page.format(i=i, long=long[i])) for i in range(4)]
                     + [("k.example", (other if i == 8 else page).format(i=i, long=long[i])) for i in range(4, 9)])
    assert got == [f"Head {i}\n\nLead {i}\n\n{long[i]}" for i in range(8)] + [f"Intro 8\n\nHead 8\n\n{long[8]}"]


def test_main_text_without_texts_alike(spark):
    page = ('<html><body><div class="m"><ul><li>Home</li><li>News</li></ul></div><div class="post"><h1>Head {i}</h1>'
            '<p>Short {i}</p><p>Alike</p><div class="x1"><p>Share this</p><p>Get our letters by mail</p></div></div>'
            '<div class="x2"><p>All rights held</p></div></body></html>')
    pages = [("h.example", page.format(i=i)) for i in range(5)] + [("copies.example", page.format(i=9))] * 4
    got = main_texts(spark, pages)
    assert got[:5] == [f"Head {i}\n\nShort {i}\n\nAlike" for i in range(5)]
    assert all("Head 9\n\nShort 9\n\nAlike" in t for t in got[5:])  # no template from copies


def on_host(spark, body):
    """Texts of six pages of one host, and of a page alone, with this body."""
    page = "<html><body><nav><p>menu {i}</p></nav>" + body + "<footer><p>end {i}</p></footer></body></html>"
    got = main_texts(spark, [("h.example", page.replace("{i}", str(i))) for i in range(6)]
                     + [("one.example", page.replace("{i}", "6"))])
    return got


STORY = "<h1>Head {i}</h1><p>Text number {i} of a longer story about nothing</p>"


@pytest.mark.parametrize("body", [
    '<form id="aspnetForm"><div class="content">' + STORY + '<form><p>mail {i}</p></form></div></form>',
    "<article>" + STORY + '<ol class="commentlist"><li>reader {i}</li></ol></article>',
    "<article>" + STORY + '<div class="user-comments"><p>reader {i}</p></div></article>',
    "<article>" + STORY + '<div class="article__comments"><p>reader {i}</p></div></article>',
    "<article>" + STORY + '<div class="post-related"><p>other {i}</p></div></article>',
    "<article>" + STORY + '<p style="color: red; display : none">secret {i}</p><p hidden>x</p></article>',
    '<article><header class="entry-header"><h1>Head {i}</h1></header><p>Text number {i} of a longer story about nothing</p>'
    "<footer><p>tags {i}</p></footer></article>",
    "<article>" + STORY + '</article><section class="more-stories"><article><h2>Other {i}</h2></article></section>',
    "<article>" + STORY + '<div class="social-share"><p>share {i}</p></div></article>',
    '<div class="page-comments-open"><div class="has-related">' + STORY + "</div></div>",
    '<article data-style="display:none" class="post">' + STORY + "</article>",
])
def test_main_text_blocks_set_apart(spark, body):
    assert on_host(spark, body) == [f"Head {i}\n\nText number {i} of a longer story about nothing" for i in range(7)]


def template_brute(pages):
    """Texts by explicit occurrence vectors, classes and slots: pages are
    (row, host, html)."""
    out = {}
    for host in {h for _, h, _ in pages}:
        rows = [(r, *template.parse(t or "")) for r, h, t in pages if h == host]
        distinct = {t: r for r, h, t in pages if h == host}
        vector, chars, holders, text_of = {}, Counter(), {}, Counter()
        for r, roles, blocks in rows:
            for role, n in Counter(roles).items():
                vector.setdefault(("tag", role), {})[r] = n
            live = [(p, t, template.standing(p)) for p, t in blocks if template.standing(p) is not None]
            for (p, t, names), n in Counter(live).items():
                vector.setdefault(("text", p, t), {})[r] = n
                chars["text", p, t] += n * len(t)
                holders.setdefault(("text", p, t), set()).add(next(x for y, h, x in pages if y == r))
            for p, t, names in live:
                for e in ("", *names):
                    text_of[e] += len(t)
        around = {e for e, n in text_of.items() if e and n >= 0.8 * text_of[""]}
        tokens = {k: v for k, v in vector.items() if k[0] == "tag" or len(holders[k]) >= 3}
        classes = Counter(frozenset(v.items()) for v in tokens.values())
        most = max((len(v) for k, v in vector.items() if k[0] == "tag"), default=0)
        good = {k for k, v in tokens.items() if classes[frozenset(v.items())] >= 3 and len(v) >= 3}
        valid = {k[1] for k in good if k[0] == "tag" and len(vector[k]) >= 0.5 * most}
        nested = {r for r in valid if "/" not in r.rstrip("/") or r.rstrip("/").rsplit("/", 1)[0] in valid}
        alike = {k for k in good if k[0] == "text" and k[1] in valid and len(vector[k]) >= 0.5 * most
                 and len(holders[k]) >= 0.5 * len({t for t in distinct if template.named_lengths(template.parse(t or "")[1])})}
        by_role = Counter()
        for k, n in chars.items():
            by_role[k[1]] += n
        held = Counter()
        for k in alike:
            held[k[1]] += chars[k]
        alike = {k for k in alike if held[k[1]] >= 0.8 * by_role[k[1]]}
        slots = Counter()
        for r, roles, blocks in rows:
            for p, t in blocks:
                names = template.standing(p)
                if names is not None and (not names or names[-1] in around):
                    for s in template.content_slots(p):
                        slots[s] += len(t) if ("text", p, t) not in alike else 0
        slots = {s: n for s, n in slots.items() if s in nested and n > 0}
        main = max((s for s in slots if slots[s] == max(slots.values())), key=lambda s: (s.count("/"), s), default=None)
        few = len(rows) < 3 or not nested
        for r, roles, blocks in rows:
            keys = frozenset(template.text_key(k[1], k[2]) for k in alike)
            out[r] = template.extract(blocks, None if few or main not in set(roles) else main, None if few else around,
                                      frozenset() if few else keys)
    return out


def test_main_text_against_explicit_vectors(spark):
    rng, pages = random.Random(8), []
    for h in range(7):
        boxes = [f'<div class="{rng.choice(["b", "wrap", "sidebar", "x-related", "m"])}{n}"><p>box {n}</p></div>' for n in range(3)]
        shell = rng.choice(["<div class='post'>{}</div>", "<article>{}</article>", "<form><div class='c'>{}</div></form>",
                            "<div class='comments'>{}</div>"])
        for _ in range(rng.randrange(1, 8)):
            body = "".join(f"<p>{prose(rng.randrange(999), rng.randrange(1, 9))}</p>" for _ in range(rng.randrange(0, 4)))
            parts = [shell.format("<h1>" + prose(rng.randrange(999), 2) + "</h1>" + body + rng.choice(["", "<p>Alike</p>"]))]
            parts += [b for b in boxes if rng.random() < 0.8]
            rng.shuffle(parts)
            text = "<html><body><ul><li>Home</li><li>News</li></ul>" + "".join(parts) + "</body></html>"
            pages += [(len(pages) + n, f"h{h}.example", text) for n in range(rng.choice([1, 1, 1, 2]))]
    got = main_texts(spark, [(h, t) for _, h, t in pages])
    want = template_brute(pages)
    assert got == [want[i] for i in range(len(pages))]


def test_main_text_clashing_columns_long_and_broken(spark):
    long = "".join(f"<p>line {i} of a very long page</p>" for i in range(30_000))
    rows = [(1, "http://h/1", f"<article>{long}</article>", "mine", 7), (2, "http://h/2", '<p class="a>x</p><div id=\'b>y', "t", 8),
            (3, "http://h/3", '<a href="x>y</a><p>z', None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host int")
    got = {r.page_id: r for r in template.main_text(df).collect()}
    assert len(got) == 4 and got[1].text.count("\n\n") == 29_999 and got[1].host == 7 and got[None].text == ""


# --- op2, op3, op5, op7, op8 ----------------------------------------------------

def test_contaminated_with_substitutions(spark):
    item = prose(77, 40, 5000).split()
    near = [w if i % 9 else "other" for i, w in enumerate(item)]
    rows = [(1, prose(1, 50) + " " + " ".join(item) + " end"), (2, prose(2, 90)), (3, " ".join(near)), (4, None),
            (5, ""), (None, " ".join(item)), (1, prose(1, 50) + " " + " ".join(item) + " end")]
    tests = spark.createDataFrame([(7, " ".join(item)), (8, "too short"), (9, None), (None, " ".join(item))],
                                  "item_id long, text string")
    got = contaminated(spark.createDataFrame(rows, DOCS), tests).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 7), (3, 7)]
    assert contaminated(spark.createDataFrame([], DOCS), tests).count() == 0


@pytest.mark.parametrize("share", [0.8, 0.6])
def test_masks_cover_all_accepted_substitutions(share):
    for n in range(1, decontam.WINDOW + 1):
        masks = next(m for least, m in decontam.covers(share) if n >= least)
        looks = [{o + i for i, c in enumerate(m) if c == "1"} for m in masks for o in range(n - len(m) + 1)]
        for gone in itertools.combinations(range(n), math.floor(n - math.ceil(share * n - 1e-9))):
            assert any(s.isdisjoint(gone) for s in looks), (n, gone)


def test_contaminated_is_the_rule(spark):
    """Against all alignments, whatever words are exchanged."""
    rng = random.Random(12)
    items = [(i, [f"i{i}w{j}" for j in range(n)]) for i, n in enumerate((1, 2, 4, 5, 7, 9, 10, 15, 16, 17, 20, 26))]
    gone = {6: [(0,), (0, 5)], 7: [(1, 7, 8)], 10: [(2, 8, 9, 10)]}
    rows = []
    for i, item in items:
        n = min(20, len(item))
        for g in gone.get(i, []) + [rng.sample(range(n), k) for k in (0, n // 5, n // 5, n // 5, n // 5 + 1)]:
            text = [w if j not in g else "other" for j, w in enumerate(item)]
            rows.append((len(rows), " ".join(["pad"] * rng.randrange(4) + text)))
    rows.append((len(rows), " ".join(items[6][1][2:])))
    want = set()
    for d, text in rows:
        for i, item in items:
            n, w = min(20, len(item)), text.split()
            best = max((sum(0 <= j + s < len(w) and item[j] == w[j + s] for j in range(o, o + n)), -o)
                       for s in range(-len(item), len(w)) for o in range(len(item) - n + 1))
            if best[0] >= math.ceil(0.8 * n - 1e-9):
                want.add((d, i, best[0], n, -best[1]))
    got = contaminated(spark.createDataFrame(rows, DOCS),
                       spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string"))
    assert {tuple(r) for r in got.collect()} == want


def greedy(word, initial, rest):
    n, at = 0, 0
    while at < len(word):
        vocab = rest if at else initial
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocab), None)
        if end is None:
            return 1
        n, at = n + 1, end
    return n


def test_token_counts_are_greedy(spark):
    rng = random.Random(4)
    initial = {"".join(rng.choices("abc", k=rng.randrange(1, 5))) for _ in range(25)}
    rest = {"".join(rng.choices("abc", k=rng.randrange(1, 5))) for _ in range(25)}
    texts = [" ".join("".join(rng.choices("abcd", k=rng.randrange(1, 15))) for _ in range(30)) for _ in range(40)]
    rows = list(enumerate([*texts, None, "", "  "]))
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in tokencount.token_counts(
        spark.createDataFrame(rows, DOCS), sorted(initial), sorted(rest)).collect()}
    for i, t in rows:
        assert got[i] == (len((t or "").split()), sum(greedy(w, initial, rest) for w in (t or "").split()))


def test_encoding_equals_the_library(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    texts = ["Hello world", "  two  blanks ", "naïve 中文 ́\U0001F600\n\ttab", "", None, prose(1, 3000), "a" * 5000, " "]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).selectExpr("*", "1 AS token_ids")
    out = pieces.encode(df)
    got = {r.doc_id: r for r in out.collect()}
    for i, t in enumerate(texts):
        assert got[i]["_token_ids"] == sp.encode(t or "")
        assert got[i].round_trip is (None if t is None else True)
    back = {r.doc_id: r.decoded for r in pieces.decode(out, ids_col="_token_ids").collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts))


def test_encoding_without_blanks_and_with_odd_blanks():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    codec, rng = pieces.Codec(pieces.vocabulary(pieces.DEFAULT_MODEL)), random.Random(6)
    cjk = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(20_000))
    odd = "".join(rng.choice(["a", "the", "ing", "é", "中", "\U0001F600", " ", "  ", "\n", "▁", "ﬁ", "Å", "1", "．"])
                  for _ in range(4000))
    texts = [cjk, odd, prose(3, 500).replace(" ", ""), " ", "  a", "a  ", "▁", "a▁b", "", None, "x" * 300, odd.replace(" ", "")]
    ids = codec.encode_texts(texts)
    assert [x.tolist() for x in ids] == [sp.encode(t or "") for t in texts]
    assert codec.round_trips(texts) == [None if t is None else codec.decode(x.tolist()) == t for t, x in zip(texts, ids, strict=True)]
    assert max(map(len, codec._cut(pieces.MARK + cjk))) < 20    # nothing is matched over the whole text
    again = codec.encode_texts(texts[::-1])
    assert [x.tolist() for x in again][::-1] == [x.tolist() for x in ids]


def test_encoding_refuses_other_models():
    import sentencepiece
    model = bytearray(sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL).serialized_model_proto())
    pieces._check(bytes(model))

    def field(number, value):
        return bytes([number << 3]) + bytes([value]) if isinstance(value, int) else bytes([number << 3 | 2, len(value)]) + value
    identity = field(3, 1) + field(4, 0) + field(5, 1)
    good = field(2, field(3, 2)) + field(3, identity)
    pieces._check(good)
    for bad in (field(2, field(3, 1)) + field(3, identity), field(3, identity), field(2, field(3, 2)),
                field(2, field(3, 2)) + field(3, field(2, b"map") + identity), field(2, field(3, 2)) + field(3, field(4, 1))):
        with pytest.raises(ValueError):
            pieces._check(bad)


def test_encoding_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b")], DOCS)
    assert len({tuple(r.token_ids) for r in pieces.encode(df).collect()}) == 1
    assert pieces.encode(df.limit(0)).count() == 0


def test_sharding_is_even_and_stable(spark):
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 1009)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    assert sum(a != b for a, b in zip(table, fewer)) < 1009 / 3
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 3)], "doc_id long, slot int")
    got = sharding.assign_shards(df, names).collect()
    assert len(got) == 3 and {r.slot for r in got} == {1, 2, 3}
    assert sharding.assign_shards(df.limit(0), names).count() == 0


def test_line_dedup_edges(spark):
    rows = [(3, "Shared line here\nown three\n"), (1, " shared LINE here \nshort\nshort"), (2, None), (4, ""),
            (5, "Shared line here"), (None, "shared line here"), (5, "Shared line here")]
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text)
                 for r in lines.line_dedup(spark.createDataFrame(rows, DOCS)).collect())
    assert got == sorted([("3", 3, 1, "own three\n"), ("1", 3, 0, " shared LINE here \nshort\nshort"), ("2", 1, 0, ""),
                          ("4", 1, 0, ""), ("5", 1, 1, ""), ("5", 1, 1, ""), ("None", 1, 0, "shared line here")])


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P
    text = {i: prose(i, 80, 5000) for i in range(30)}
    item = prose(999, 40, 5000)
    rows = [(i, t, "en", "s", len(t)) for i, t in text.items()]
    rows += [(40, None, "en", "s", 0), (41, "123 ...", None, "s", 7), (42, text[3].replace(" ", "  "), "en", "s", 9),
             (43, text[4] + " " + item, "en", "s", 9), (44, text[5] + "\n" + prose(7000, 80, 5000), "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in P.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(range(30)) | {44}
    assert got[44].text == prose(7000, 80, 5000) and all(r.round_trip for r in got.values())


def test_unescape_is_used_once():
    assert template.parse("<p>&amp;lt;</p>")[1] == [("p", html.unescape("&amp;lt;"))]
