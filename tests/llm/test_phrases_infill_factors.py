"""Collocations, infilling and substring dedup against brute force, and their
edge cases: NULLs, empty and long texts, ties, repeated rows, empty tables,
clashing column names, fingerprints that collide."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bitset, bytewords, collocations, factors, infill

DOCS = "doc_id long, text string, lang string"


# --- words as bytes --------------------------------------------------------------------

def test_byte_words_and_exact_groups():
    text = ("ab  cd\tab\n" + "x" * 70 + " " + "x" * 69 + "y é " * 3 + "x" * 70 + "\x00q ").encode()
    buf = np.frombuffer(text + b"\n" * 9, dtype=np.uint8)
    apart = bytewords.byte_set(b" \t\n")
    starts, ends, h = bytewords.words(buf, apart)
    found = [bytes(buf[s:e]) for s, e in zip(starts, ends, strict=True)]
    assert found == re.findall(rb"[^ \t\n]+", text)
    for hashes in (h, h & np.uint64(1), h & np.uint64(0)):   # also where hashes say nothing
        lead = bytewords.groups(hashes, lambda a, b: bytewords.same_bytes(buf, starts, ends, a, b))
        assert [found[i] for i in lead] == found
        assert len({(found[i], i) for i in lead}) == len(set(found))


def test_bloom_filter_finds_what_was_put_in(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-2**63, 2**63 - 1, 3000)
    table = bitset.bloom(spark.createDataFrame([(int(v),) for v in x], "h long"), "h", bits=18)
    assert len(table) == 2**15 and bitset.found(table, x.view(np.uint64)).all()
    other = rng.integers(-2**63, 2**63 - 1, 3000).view(np.uint64)
    assert bitset.found(table, other).mean() < 0.01
    assert not bitset.found(bitset.bloom(spark.range(0).withColumnRenamed("id", "h"), "h", bits=15), other).any()


# --- op11 ----------------------------------------------------------------------------

def phrases_brute(rows, least, max_words, cover, top):
    f = defaultdict(Counter)
    for _, text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^ \t]+", piece)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f["und" if lang is None else lang][tuple(w[i:i + k])] += 1
    total = {lang: sum(n for p, n in c.items() if len(p) == 1) for lang, c in f.items()}
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) >= 2 and a >= least}
        rows_ = []
        for p, a in cand.items():
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if any(100 * b >= cover * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in cand.items()):
                continue
            rows_.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, total[lang], -s)
                for i, (s, a, p, x, y) in enumerate(sorted(rows_)[:top])]
    return sorted(out)


def some_texts(seed, n=60):
    rng = random.Random(seed)
    vocab = ["a", "B", "the", "é", "Éa", "x" * 80, "z", "1", "<P>", "日本", " ", "q\x00r"]
    def text():
        out = ""
        for _ in range(rng.randrange(0, 80)):
            out += rng.choice(vocab) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", ";", " \r\n"])
        return out
    rows = [(i, text(), rng.choice(["en", "de", None, "und", ""])) for i in range(n)]
    return rows + [(1, None, "en"), (2, "", "en"), (None, "the z the z", "en"), (3, "...", "xx"), rows[5], rows[5],
                   (7, " ".join(["the a"] * 3000), "de")]


@pytest.mark.parametrize("mask", [(1 << 64) - 1, 0x3F])
def test_collocations_against_brute_force(spark, mask, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 700)    # several chunks a task
    rows = some_texts(1)
    df = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash")).withColumn("n", F.lit(1)).repartition(5)
    got = sorted(tuple(r) for r in collocations.collocations(df, least=4, top=25, mask=mask).collect())
    assert got == phrases_brute(rows, 4, 3, 50, 25) and len(got) > 50


def test_collocations_longer_phrases_full_filter_and_empty(spark, monkeypatch):
    rows = some_texts(2)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(df, max_words=5, least=3, cover=80, top=1000).collect())
    assert got == phrases_brute(rows, 3, 5, 80, 1000)
    # a filter that says yes to everything changes nothing
    monkeypatch.setattr(bitset, "bloom", lambda *a: np.full(2**12, 255, dtype=np.uint8))
    again = sorted(tuple(r) for r in collocations.collocations(df, max_words=4, least=3, top=1000).collect())
    assert again == phrases_brute(rows, 3, 4, 50, 1000)
    assert collocations.collocations(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        collocations.collocations(df, max_words=1)


def test_collocation_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_000_000_007
    counts = spark.createDataFrame([("en", 0, "", 9 * big), ("en", 1, "a", big + 2), ("en", 1, "b", big + 4),
                                    ("en", 2, "a b", big)], "lang string, words int, phrase string, f long")
    r = collocations.scored(counts).collect()[0]
    assert r["score"] == 1_000_000 * big * big // ((big + 2) * (big + 4)) and (r["l"], r["r"]) == (big + 2, big + 4)


# --- op12 ----------------------------------------------------------------------------

def infill_brute(doc_id, text, fim=50, spm=80, seed=42):
    text = text or ""
    u = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    assert "".join(u) == text
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(u)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return n, "plain", text, None, None
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h[3] % 100 < spm:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def infill_rows():
    rng = random.Random(4)
    parts = ["a", "word", "é😀", " ", "  ", "\n", "\t\r", "<", "<P", "S>", "$1", "\\", "\x00", " ", "(x){2}+"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 30)))) for i in range(300)]
    rows += [(500, None), (501, ""), (502, "   "), (503, "a<M>b"), (None, "x y z"), (None, "x y z"), (3, "again same id"),
             (504, "<P>"), (505, "w " * 60_000), (506, "v" * 200_000), (507, " " * 100_000)]
    return rows


def test_infill_against_brute_force(spark):
    rows = infill_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = infill.infill(df).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"]) == infill_brute(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_infill_all_shares_clashing_names_and_empty(spark):
    rows = infill_rows()[:120] + [(505, "w " * 30_000)]
    df = spark.createDataFrame([(i, t, "mine", 7) for i, t in rows], "doc_id long, text string, Form string, cut_a int")
    out = infill.infill(df, fim_share=100, spm_share=0)
    assert out.columns == ["doc_id", "text", "Form", "cut_a", "n", "_form", "output", "prefix_chars", "middle_chars"]
    for r in out.collect():
        want = infill_brute(r["doc_id"], r["text"], 100, 0)
        assert (r["n"], r["_form"], r["output"]) == want[:3] and (r["Form"], r["cut_a"]) == ("mine", 7)
    assert infill.infill(df.limit(0)).count() == 0
    plan = infill.infill(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# --- op13 ----------------------------------------------------------------------------

def dedup_brute(rows, window):
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in docs:
        if i is not None:
            for s in range(len(w) - window + 1):
                key = tuple(w[s:s + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in docs:
        gone = {s + k for s in range(len(w) - window + 1) for k in range(window)
                if i is not None and first[tuple(w[s:s + window])] < i}
        out.append((i, " ".join(x for k, x in enumerate(w) if k not in gone), len(w), len(gone)))
    return sorted(out, key=str)


def shared_texts(seed):
    """Copies, overlapping and touching passages, passages that the least
    holder of an anchor lacks, repeats within one document."""
    rng = random.Random(seed)
    def prose(n, names=30):
        return [f"w{rng.randrange(names)}" for _ in range(n)]
    base = [prose(60) for _ in range(6)]
    rows = []
    for i in range(70):
        w = []
        for _ in range(rng.randrange(1, 6)):
            b = rng.choice(base)
            s = rng.randrange(0, 40)
            w += b[s:s + rng.randrange(4, 30)] if rng.random() < 0.7 else prose(rng.randrange(1, 20), 400)
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = f"e{i}"
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
    rng.shuffle(rows)
    same = next(t for _, t in rows if len(t) > 300)
    rows += [(100 + i, same) for i in range(20)]
    rows += [(None, same), (None, same), (200, None), (200, ""), (201, "short text"), (5, same), rows[0], rows[0],
             (300, " ".join(base[0] * 200)), (301, "x" * 5000), (302, " ".join(["same"] * 400)), (303, "same " * 50),
             (304, "Same words, unlike same words " + same)]
    return rows


@pytest.mark.parametrize("window,k,part", [(13, 7, 1 << 14), (13, 7, 40), (5, 2, 100), (4, 4, 100), (3, 1, 30)])
def test_substring_dedup_against_all_windows(spark, window, k, part, monkeypatch):
    monkeypatch.setattr(factors, "CHUNK", 3000)
    rows = shared_texts(window)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")    # indexes are kept over batches
    try:
        got = factors.substring_dedup(df, window=window, k=k, part=part).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((tuple(r) for r in got), key=str) == dedup_brute(rows, window)


def test_duplicate_spans_point_at_equal_words(spark):
    rows = [(i, t) for i, t in shared_texts(9) if i is not None and not 90 < i < 250]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    words = defaultdict(list)
    for i, t in rows:
        words[i].append((t or "").split())
    spans = factors.duplicate_spans(df).collect()
    long_ = [s for s in spans if s["ref_start"] is not None]
    assert long_ and max(s["n"] for s in long_) > 20
    for s in spans:
        assert s["ref"] < s["id"] and s["n"] >= 13
        at = [w[s["start"]:s["start"] + s["n"]] for w in words[s["id"]]]
        if s["ref_start"] is not None:
            there = [w[s["ref_start"]:s["ref_start"] + s["n"]] for w in words[s["ref"]]]
            assert any(a == b and len(a) == s["n"] for a in at for b in there)


def test_substring_dedup_clashing_names_and_empty(spark):
    df = spark.createDataFrame([(1, " ".join(map(str, range(20))), 5, "r"), (2, " ".join(map(str, range(20))) + " z", 6, "s")],
                               "doc_id long, text string, n_words int, row string")
    out = factors.substring_dedup(df)
    assert out.columns == ["doc_id", "text", "n_words", "row", "_n_words", "n_removed"]
    assert {r["doc_id"]: (r["text"], r["n_words"], r["_n_words"], r["n_removed"]) for r in out.collect()} == {
        1: (" ".join(map(str, range(20))), 5, 20, 0), 2: ("z", 6, 21, 20)}
    assert factors.substring_dedup(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        factors.duplicate_spans(df, window=3, k=4)
