"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventide.llm import collocations


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def plain(rows, min_count, subsumed=100, max_words=5):
    """{(lang, phrase): (cut, a, l, r, n, score)} by counting every phrase."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower(text or "")):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                f.update((lang, tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    out = {}
    frequent = {k: v for k, v in f.items() if v >= min_count}
    inside = Counter()
    for (lang, g), v in frequent.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                inside[lang, g[i:i + k]] = max(inside[lang, g[i:i + k]], v)
    for (lang, g), a in frequent.items():
        if len(g) < 2 or 100 * inside[lang, g] >= subsumed * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out[lang, " ".join(g)] = (k, a, f[lang, g[:k]], f[lang, g[k:]], n[lang], score)
    return out


def mined(df, **options):
    return {(r["lang"], r["phrase"]): (r["cut"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in
            collocations.mine(df, **options).collect()}


def corpus(seed=1, n=120):
    rng, rows = random.Random(seed), []
    words = ["The", "the", "cat", "sat", "ONE", "é", "É", "x'y", "a", "a", "b", "new", "york", " z", "q\x00r"]
    seps = [" ", "  ", "\t", ", ", ". ", "\n", "\x0b", " ", " ", " "]
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randrange(60)))
        if rng.random() < 0.5:
            text += " new york city hall is big" * rng.randrange(4)
        rows.append((rng.choice(["en", "en", "de", "", None]), text))
    return rows + [("en", None), ("en", ""), ("fr", "one"), (None, "a a a a a a"), ("und", "a a a")]


@pytest.mark.parametrize("subsumed, bits", [(100, 25), (60, 25), (100, 15)])
def test_equals_plain_counting(spark, subsumed, bits):
    rows = corpus()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert mined(df, min_count=6, subsumed=subsumed, bits=bits) == plain(rows, 6, subsumed)


def test_split_stripes_and_many_rows_of_one_key(spark, monkeypatch):
    """Every prefix with a fifth of the words is hot; one key has rows from many tasks."""
    monkeypatch.setattr(collocations, "HOT", 30)
    rows = [("en", " ".join(["the"] + [random.Random(i).choice(["cat", "dog", "sun", "moon"])] * 2 + ["the"] * 3))
            for i in range(300)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(120)
    assert mined(df, min_count=10) == plain(rows, 10)


def test_hot_phrase_and_repeated_rows(spark):
    rows = [("en", "the same old line again and again")] * 400 + [("en", f"w{i} w{i + 1} the same") for i in range(200)]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert mined(df, min_count=100) == plain(rows, 100)


def test_scores_are_exact(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(500):
        l_, r = rng.randrange(100, 10 ** 12), rng.randrange(100, 10 ** 12)
        rows.append((rng.randrange(100, min(l_, r) + 1), rng.randrange(max(l_, r), 10 ** 14), l_, r))
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    got = df.select("*", collocations._score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(x["s"] == 1000 * x["a"] * x["n"] // (x["l"] * x["r"]) for x in got)


def test_edges(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert mined(empty) == {}
    assert collocations.top(collocations.mine(empty), 3).count() == 0
    odd = spark.createDataFrame([(1, "x", "a b " * 300, 5), (1, "x", None, 6)], "n long, prefix string, text string, lang int")
    assert mined(odd, min_count=50) == plain([("5", "a b " * 300), ("6", None)], 50)
    long_word = "w" * 100_000
    df = spark.createDataFrame([("en", f"{long_word} b " * 5)], "lang string, text string")
    assert mined(df, min_count=5) == plain([("en", f"{long_word} b " * 5)], 5)


def test_top_breaks_ties_by_phrase(spark):
    rows = [("en", "q r"), ("en", "o p"), ("en", "s t"), ("de", "o p")] * 10
    df = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.top(collocations.mine(df, min_count=10), 2).orderBy("lang", "rank").collect()
    assert [(r["lang"], r["rank"], r["phrase"]) for r in got] == [("de", 1, "o p"), ("en", 1, "o p"), ("en", 2, "q r")]
