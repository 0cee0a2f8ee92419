"""Collocations against counts over all windows."""

import random
import re
from collections import Counter

import pyarrow as pa
from fabspark.llm import collocations as C
from fabspark.llm.text import texts
from llm_cases import LOWER, edge, none


def pieces(text):
    for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", p)


def plain(rows, least, top=2000):
    """rows: (lang, text)."""
    f = Counter()
    for lang, text in rows:
        for w in pieces(text):
            for m in range(1, 5):
                f.update(("und" if lang is None else lang, *w[i:i + m]) for i in range(len(w) - m + 1))
    total = Counter()
    for p, n in f.items():
        total[p[0]] += n * (len(p) == 2)
    many = {p: n for p, n in f.items() if n >= least and len(p) > 2}
    out = []
    for p, a in many.items():
        lang, w = p[0], p[1:]
        score, _, l, r = min((2_000_000 * a // (f[lang, *w[:k]] + f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]])
                             for k in range(1, len(w)))
        inside = lambda q: any(q[i:i + len(w)] == w for i in range(len(q) - len(w) + 1))  # noqa: E731, B023
        if not any(q[0] == lang and len(q) > len(p) and 100 * n >= 80 * a and inside(q[1:]) for q, n in many.items()):
            out.append((lang, " ".join(w), a, l, r, total[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    places = Counter()
    got = []
    for lang, *rest in out:
        places[lang] += 1
        if places[lang] <= top:
            got.append((lang, places[lang], *rest))
    return got


def corpus(seed, docs=400):
    random.seed(seed)
    words = ["a", "b", "The", "the", "of", "é", "日本", "x\x00", "\x01y", "q", "rare", "zz"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ; ", "\x85"]
    rows = []
    for _ in range(docs):
        n = random.choice([0, 1, 2, 40, 200])
        rows.append((random.choice(["en", "en", "de", None, "und", ""]),
                     "".join(random.choice(words) + random.choice(gaps) for _ in range(n)) if n else random.choice([None, "", " ", "..,"])))
    return rows


SCHEMA = "lang string, text string"


def test_words_and_followers_of_a_batch():
    random.seed(7)
    for _ in range(200):
        ts = ["".join(random.choice("ab \n\t.é,") for _ in range(random.randint(0, 15))) for _ in range(4)]
        for t in texts(pa.array(ts)):
            p = C._Pieces(t)
            want = [(w, len(q) - i - 1, d) for d, x in enumerate(ts) for q in pieces(x) for i, w in enumerate(q)]
            got = [(p.data[a:b].tobytes().decode(), n, d) for a, b, n, d in zip(p.starts, p.ends, p.ahead, p.doc)]
            assert got == [(w, min(n, 3), d) for w, n, d in want]


def test_phrases_equal_all_windows(spark):
    for seed, budget in ((1, C.BUDGET), (2, 40)):  # the small budget splits frequent words into three-word prefixes
        rows = corpus(seed)
        rows += rows[:20]
        df = spark.createDataFrame([(*r, 1, 2, "w") for r in rows], SCHEMA + ", n long, a long, word string").repartition(4)
        for least, top in ((30, 2000), (8, 15))[seed - 1:]:
            got = [tuple(r) for r in C.collocations(df, least=least, top=top, budget=budget).orderBy("lang", "rank").collect()]
            assert got == plain(rows, least, top)
        assert got


def test_one_phrase_everywhere(spark):
    rows = [("en", "same old story " * 400)] * 30 + [("en", "new york city")] * 35
    got = [tuple(r) for r in C.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5), budget=100).orderBy("rank").collect()]
    assert got == plain(rows, 30)


def test_exact_quotients_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    a, l, r = 9_000_000_000_000_001, 9_000_000_000_000_007, 9_100_000_000_000_000
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(F.expr(C.SCORE))
    assert df.first()[0] == 2_000_000 * a // (l + r)


def test_odd_rows(spark):
    df = edge(spark)
    rows = [(r.lang, r.text) for r in df.collect()]
    got = [tuple(r) for r in C.collocations(df).orderBy("lang", "rank").collect()]
    assert got == plain(rows, 30)
    out = C.collocations(none(spark))
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.collect() == []
