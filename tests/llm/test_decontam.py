"""Decontamination: exact and re-parameterised items are found, other texts are not."""

import random

import pytest

from eventide.llm import decontam

ITEM = "A train leaves the old station at 40 km per hour and its driver Paris reaches the far town after 3 hours of travel"


def run(spark, docs, bench=((1, ITEM),)):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item string, n int")
    b = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id long, text string, doc string")
    return {(r["doc_id"], r["item_id"]): (round(r["cover"], 3), round(r["exact"], 3)) for r in decontam.find_leaks(d, b).collect()}


def words(spark, text):
    from pyspark.sql import functions as F
    return spark.createDataFrame([(text,)], "t string").select(decontam.canonical(F.col("t"))).first()[0]


def test_canonical_words(spark):
    assert words(spark, "It ran 12kg, then 3.5 Miles. With Anna Smith in Rome!") == [
        "it", "ran", "⟨n:12⟩", "⟨u:kg⟩", "then", "⟨n:3.5⟩", "⟨u:miles⟩", "with", "⟨p:anna⟩", "⟨p:smith⟩", "in", "⟨p:rome⟩"]
    assert words(spark, "LA MER, ÉTÉ ET Paris, Rome") == ["la", "mer", "été", "et", "paris", "⟨p:rome⟩"]
    assert words(spark, " ... -- | ") == [] and words(spark, "") == []
    assert words(spark, "see: a... b :c ⟨n:1⟩") == ["see", "a", "b", "c", "⟨n:1⟩"]


def test_exact_and_reparameterised(spark):
    filler = "some words before it that say nothing in particular. "
    other = ITEM.replace("40", "75").replace("3 hours", "9 hours").replace("Paris", "Bob")
    docs = [(1, filler + ITEM + ". " + filler), (2, filler + other), (3, filler * 5), (4, ITEM.upper().replace("PARIS", "Paris")), (5, None), (6, ""),
            (7, " ".join(ITEM.split()[:9])), (8, filler + ITEM.replace(" at ", " \n at\t")), (None, ITEM), (1, filler + ITEM + ". " + filler),
            (9, "x " * 40000 + ITEM + " y" * 1000)]
    got = run(spark, docs)
    assert set(got) >= {(1, 1), (2, 1), (8, 1), (9, 1)}
    low = ITEM.replace("Paris", "and")
    assert set(run(spark, [(1, "NO, " + low.upper() + "!! YES!!")], [(1, low)])) == {(1, 1)}
    assert not {d for d, _ in got} & {3, 5, 6, 7, None}
    assert got[1, 1] == (1.0, 1.0) and got[2, 1][0] == 1.0 and got[2, 1][1] < 0.5


def test_slots_must_be_consistent(spark):
    """A benchmark value that repeats must stand for one value in the document."""
    item = "take 5 red apples from the big box then put 5 red apples in the small box and count 5 red apples again"
    same = item.replace("5", "8")
    mixed = "take 5 red apples from the big box then put 7 red apples in the small box and count 9 red apples again"
    assert set(run(spark, [(1, same), (2, mixed), (3, item)], [(1, item)])) == {(1, 1), (3, 1)}


def test_items_of_all_kinds(spark):
    bench = [(1, ITEM), (1, ITEM), (2, ITEM), (3, None), (4, ""), (5, "two words"), (6, "1 2 3 4 5 6 7"), (None, ITEM)]
    got = run(spark, [(1, ITEM), (2, "here are two words only"), (3, "two words"), (4, "1 2 3 4 5 6 7")], bench)
    assert set(got) == {(1, 1), (1, 2), (2, 5), (3, 5), (4, 6)}


def test_numbers_and_short_items_word_for_word(spark):
    bench = [(1, "12 + 45 - 3 * 7 = 9 + 27"), (2, "hello world"), (3, "5 apples"), (4, "alone"), (5, "42")]
    docs = [(1, "so 12 + 45 - 3 * 7 = 9 + 27 it is"), (2, "they say Hello, world! again"), (3, "give me 5 apples, please"),
            (4, "alone"), (5, "42."), (11, "so 12 + 45 - 3 * 7 = 8 + 27 it is"), (12, "hello big world"), (13, "give me 6 apples please"),
            (14, "she was alone with 42 of them"), (15, "12 45 3 7 and 9 27")]
    assert set(run(spark, docs, bench)) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)}


def test_windows_that_most_items_and_documents_share(spark):
    """A common lead alone is no leak; items of nothing but common windows are still found."""
    lead = "choose the one best answer to the following question and write it down"
    tail = [" ".join(f"w{'abcdefghij'[(i * 7 + j) % 10]}{'klmnopqrst'[i % 10]}" for j in range(12)) for i in range(10)]
    bench = [(i, f"{lead} {t}") for i, t in enumerate(tail)] + [(50, lead), (51, "choose the one best answer")]
    docs = [(i, f"{lead} something else {i} that no item says") for i in range(100, 160)] + [(i, f"x {b} y") for i, b in bench[:10]]
    got = set(run(spark, docs, bench))
    assert got == {(d, j) for d, _ in docs for j in (50, 51)} | {(i, i) for i in range(10)}


def test_items_rich_in_slots_and_short_items(spark):
    """Few plain words: found word for word; with other values only beside a better window."""
    bench = [(1, "Compute 12 + 45 - 3 * 7 = 9 now"), (2, "What is 12 / 4?"), (3, "Name the capital"),
             (4, "Maria Lopez met John Smith in Paris, France on 3 May 1999 at 10 am")]
    docs = [(i, f"some words before. {t} And some behind.") for i, t in bench]
    docs += [(11, docs[0][1].replace("12", "13")), (12, docs[1][1].replace("12", "13")), (13, "the capital has a name"), (14, "what is 5 / 6 and 7 / 8 and 12 / 4")]
    docs += [(16, "Compute 1 + 4 - 33 * 77 = 99 now")]
    docs += [(15, docs[3][1].replace("1999", "2001").replace("Paris", "Rome"))]
    assert set(run(spark, docs, bench)) == {(1, 1), (2, 2), (3, 3), (4, 4), (11, 1), (15, 4)}


def test_one_changed_slot(spark):
    """A near copy with one inconsistent slot keeps all its other windows."""
    item = ("take 5 red apples from the big box on the left then put 5 red apples in the small box and go back to the kitchen "
            "where the old cook will count 5 red apples again before the long evening meal begins")
    parts = item.split("5")
    n = len(item.split()) - 4
    docs = [(1, "5".join(parts[:2]) + "7" + "5".join(parts[2:])), (2, "8".join(parts[:2]) + "9" + "8".join(parts[2:])), (3, item.replace("5", "8"))]
    got = run(spark, docs, [(1, item)])
    assert got[1, 1] == (round((n - 5) / n, 3), 1.0) and got[2, 1][0] == round((n - 5) / n, 3) and got[3, 1][0] == 1.0


def test_case_of_names(spark):
    """Copies in other cases, with quotes or line breaks before names, also with other numbers."""
    item = "In the year 1903 the physicist Marie Curie shared the Nobel Prize with Pierre Curie and then worked for 8 more years in Paris on the Große Straße"
    forms = [item, item.lower(), item.upper(), item.title(), item.replace(" Marie", "\nMarie").replace(" Nobel", ' "Nobel').replace(" Paris", "\nParis")]
    docs = list(enumerate(forms)) + [(10, item.upper().replace("1903", "1805").replace(" 8 ", " 9 ")), (11, item.lower().replace("the", "a"))]
    got = run(spark, docs, [(1, item)])
    assert {d for d, _ in got} == {0, 1, 2, 3, 4, 10}
    assert all(got[i, 1] == (1.0, 1.0) for i in range(5)) and got[10, 1][1] < 1


def test_against_plain_windows(spark):
    """Lower-case words without slots: cover is the share of an item's distinct five-word windows."""
    rnd = random.Random(1)
    vocab = [f"{a}{b}" for a in "abcdefgh" for b in "xyzuvw"]
    bench = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([6, 20, 40])))) for i in range(12)]
    docs = []
    for i in range(60):
        parts = [rnd.choice(vocab) for _ in range(rnd.randint(0, 60))]
        if i % 2:
            w = rnd.choice(bench)[1].split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                w[rnd.randrange(len(w))] = "changed"
            parts += w + parts[:5]
        docs.append((i, " ".join(parts)))

    def grams(t):
        w = t.split()
        return [tuple(w[j:j + 5]) for j in range(len(w) - 4)]

    want = {}
    for i, t in docs:
        have = set(grams(t))
        for j, b in bench:
            g = grams(b)
            c = sum(x in have for x in g)
            if c >= 0.8 * len(g):
                want[i, j] = pytest.approx(c / len(g), abs=1e-3)
    got = run(spark, docs, bench)
    assert {k: v[0] for k, v in got.items()} == want and want


def test_empty(spark):
    assert run(spark, []) == {} and run(spark, [(1, ITEM)], []) == {}
