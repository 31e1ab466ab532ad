"""Language ID: forward-backward against enumeration, held-out accuracy, code-switched text."""

import itertools
import random

import numpy as np
import pytest

from eventide.llm import langid

STEMS = {"aa": ["the", "and", "with", "ing", "ther", "of"], "bb": ["der", "und", "mit", "ung", "sch", "von"], "cc": ["que", "los", "con", "ción", "ado", "de"]}


def text(rnd, la, n):
    return " ".join("".join(rnd.choice(STEMS[la]) for _ in range(rnd.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rnd = random.Random(1)
    return langid.fit({la: [text(rnd, la, 60) for _ in range(40)] for la in STEMS})


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    K, lengths = 3, np.array([4, 4, 2, 1])
    emit, trans, start = rng.normal(size=(4, 4, K)), rng.normal(size=(K, K)), rng.normal(size=K)
    post = langid.forward_backward(emit, lengths, trans, start)[0]
    for b, n in enumerate(lengths):
        total, mass = 0.0, np.zeros((n, K))
        for path in itertools.product(range(K), repeat=int(n)):
            s = start[path[0]] + sum(emit[t, b, k] for t, k in enumerate(path)) + sum(trans[i, j] for i, j in zip(path, path[1:]))
            total += np.exp(s)
            for t, k in enumerate(path):
                mass[t, k] += np.exp(s)
        assert np.allclose(post[:n, b], mass / total)
        assert not post[n:, b].any()


def test_held_out_and_code_switching(model):
    rnd = random.Random(9)
    for la in STEMS:
        for _ in range(20):
            got = langid.label_words([text(rnd, la, 30)], model)[0]
            assert sum(x[1] == la for x in got) >= 28
    a, b = text(rnd, "aa", 15), text(rnd, "cc", 15)
    labels = [x[1] for x in langid.label_words([a + ". " + b], model)[0]]
    assert labels[:13].count("aa") >= 12 and labels[-13:].count("cc") >= 12
    assert np.diag(model["trans"]).min() > model["trans"][~np.eye(3, dtype=bool)].max()


def test_letters_by_category():
    assert langid.words_of("² ½ Ⅷ ٣ 12 _ ① 😀") == []
    assert langid.words_of("Été हिन्दी x²y 一二 a_b") == ["été", "हिन्दी", "x", "y", "一二", "a", "b"]


def test_words_are_read_whole(model, monkeypatch):
    """Also in pieces: the score of a word is the sum over all of its n-grams."""
    monkeypatch.setattr(langid, "PIECE", 7)
    monkeypatch.setattr(langid, "FEATURES", 40)
    words = ["q" * 50 + "ther" * 20, "ung" * 33, "a", "undmit", "x" * 13, "y" * 6]
    scorer = langid._Scorer(model)
    scorer.add(words)
    for w in words:
        rows = [model["features"][f] for f in langid._all_features(w, model["lexicon"]) if f in model["features"]]
        assert np.allclose(scorer.rows[scorer.index[w]], model["weights"][rows].sum(0))


def test_a_language_of_copies_is_learned(spark):
    rnd = random.Random(8)
    copies = [text(rnd, "bb", 40) for _ in range(3)]
    rows = [(text(rnd, "aa", 20), "aa") for _ in range(600)] + [(copies[i % 3], "bb") for i in range(3000)] + [("² ½", None)]
    docs = spark.createDataFrame([(i, t, la) for i, (t, la) in enumerate(rows)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    got = langid.identify(docs.where("doc_id >= 600").select("doc_id", "text"), model).collect()
    assert all(r["lang_pred"] == ("bb" if r["doc_id"] < 3600 else "und") for r in got)


def test_word_scores_are_sums_of_feature_weights(model):
    rnd = random.Random(4)
    words = ["a", "the", "x" * 60, "undmit", "éß", *text(rnd, "bb", 50).split()]
    scorer = langid._Scorer(model)
    scorer.add(words)
    scorer.add(["und", "a"])
    for w in [*words, "und"]:
        rows = [model["features"][f] for f in langid._all_features(w, model["lexicon"]) if f in model["features"]]
        assert np.allclose(scorer.rows[scorer.index[w]], model["weights"][rows].sum(0))


def test_frames(spark, model):
    rnd = random.Random(3)
    rows = [(1, text(rnd, "aa", 40)), (2, None), (3, ""), (4, "123 ... 😀"), (5, text(rnd, "bb", 20000)), (None, text(rnd, "cc", 5)), (1, text(rnd, "bb", 3)),
            (6, "éé 漢字 ßß"), (7, "x" * 100000)]
    docs = spark.createDataFrame([(i, t, "zz", "x") for i, t in rows], "doc_id long, text string, lang string, score string").coalesce(1)
    got = langid.identify(docs, model).collect()
    assert [r["doc_id"] for r in got] == [r[0] for r in rows]
    assert [r["lang_pred"] for r in got][:7] == ["aa", "und", "und", "und", "bb", "cc", "bb"]
    assert all(0 <= r["score"] <= 1 for r in got) and got[1]["score"] == 0
    assert langid.identify(docs.limit(0), model).collect() == []


def test_training_from_tables(spark):
    rnd = random.Random(5)
    rows = [(i, text(rnd, la, 50), la) for i, la in enumerate(["aa", "bb"] * 30)] + [(100, None, "aa"), (101, "x y", None), (102, "", "cc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert model["langs"] == ["aa", "bb", "cc"]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, model).collect()}
    assert sum(got[i] == la for i, _, la in rows[:60]) >= 59
    nothing = langid.train(docs.limit(0))
    assert [r["lang_pred"] for r in langid.identify(docs.limit(1), nothing).collect()] == ["und"]
