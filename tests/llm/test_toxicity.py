"""Ordinal toxicity: held-out accuracy, ordered severity, edge cases."""

import math
import random

import pytest

from eventide.llm import toxicity


def corpus(n=900, seed=1):
    rnd = random.Random(seed)
    vocab = ["w" + "".join(rnd.choice("aeioulnrst") for _ in range(5)) for _ in range(300)]
    bad = ["dreadful", "horrid", "nasty", "foul"]
    rows = []
    for i in range(n):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(20, 120))]
        y = int(rnd.random() < 0.3)
        for _ in range(rnd.choice([2, 4, 8]) if y else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice([*bad, "vile" + rnd.choice("aeiou") + rnd.choice("bdg")]))
        rows.append((i, " ".join(words), y))
    return rows


def test_held_out(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, toxicity string")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows[:600]] + [(5, None, 1), (None, 1, 1), (rows[0][0], 0, 0)], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["s"] for r in toxicity.score(docs, model, out="s").collect()}
    right = sum(got[i]["rejected"] == bool(y) for i, _, y in rows[600:])
    assert right >= 0.97 * 300
    assert all(0 <= s["severity"] <= toxicity.GRADES and 0 <= s["p_toxic"] <= 1 for s in got.values())
    assert {f for f, w in model["weights"].items() if sum(w) > 0.3} & {"vile*"}
    assert toxicity.train(docs, labels) == model


def test_severity_is_the_sum_of_cumulative_links():
    model = toxicity.fit([(t, y) for _, t, y in corpus(400)])
    assert model["cuts"] == sorted(model["cuts"])
    text = "wplain dreadful dreadful vileab rest"
    f = toxicity.features(toxicity.words_of(text))
    s = sum(a * math.log1p(f[k]) + b * math.log1p(100 * f[k] / 20) for k, (a, b) in model["weights"].items() if f[k])
    p = [1 / (1 + math.exp(c - s)) for c in model["cuts"]]
    assert toxicity.severity(text, model) == (pytest.approx(sum(p)), pytest.approx(p[0]))
    more = toxicity.severity("dreadful horrid nasty foul " * 5, model)[0]
    assert more > toxicity.severity("dreadful " + "wplain " * 30, model)[0] > toxicity.severity("wplain " * 30, model)[0]


def test_near_copies_count_once():
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(base + (f" x{i}" if i else ""), 1) for i in range(20)] + [("other words here entirely", 0)]
    assert len(toxicity.distinct_texts(rows)) == 2


def test_odd_rows(spark):
    model = toxicity.fit([(t, y) for _, t, y in corpus(300)])
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "123 !"), (4, "dreadful " * 50000), (None, "dreadful"), (2, "")], "doc_id long, text string").coalesce(1)
    got = [r["toxicity"] for r in toxicity.score(docs, model).collect()]
    assert got[0] == got[1] == got[2] == got[5] and not got[0]["rejected"] and got[3]["rejected"]
    empty = docs.limit(0)
    nothing = toxicity.train(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert nothing["weights"] == {} and toxicity.score(empty, nothing).collect() == []
    assert not any(r["toxicity"]["rejected"] for r in toxicity.score(docs, nothing).collect())
