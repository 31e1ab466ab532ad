"""SimHash near-duplicates against brute force on all pairs."""

import itertools
import random

import numpy as np
import pytest
import xxhash

from eventide.llm import simhash


def plain_fingerprint(text, size=4):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text).encode().split()]
    grams = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    bits = [sum(xxhash.xxh64(g, seed=42).intdigest() >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(grams))


def plain_components(rows, distance=4):
    fps = [plain_fingerprint(t or "") for _, t in rows]
    comp = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= distance and comp[i] != comp[j]:
            old, new = comp[j], comp[i]
            comp = [new if c == old else c for c in comp]
    low = {}
    for (doc, _), c in zip(rows, comp):
        if doc is not None:
            low[c] = min(doc, low.get(c, doc))
    return sorted(((doc, f"{f:016x}", low.get(c)) for (doc, _), f, c in zip(rows, fps, comp)), key=str)


def table(spark, rows):
    return spark.createDataFrame([(d, t, "x", 7) for d, t in rows], "doc_id long, text string, fp string, part int")


def test_fingerprint_matches_plain():
    rnd = random.Random(3)
    for n in (0, 1, 3, 4, 5, 40):
        t = " ".join(rnd.choice(["The", "Äpfel", "cat", "ſ", "K", "dog\t"]) for _ in range(n))
        assert simhash.fingerprint(t.encode()) == plain_fingerprint(t)
    assert simhash.fingerprint("a\x0bb\x1cc d e".encode()) == plain_fingerprint("a\x0bb\x1cc d e")


def test_against_all_pairs(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(60)]
    rows, texts = [], []
    for i in range(60):
        if i % 3 and texts:
            words = rnd.choice(texts).split()
            if i % 2:
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
            t = " ".join(words)
        else:
            t = " ".join(rnd.choice(vocab) for _ in range(rnd.choice([3, 60, 200])))
        texts.append(t)
        rows.append((i * 3 % 61 + 100, t))
    rows += [(1, None), (2, ""), (3, " \n"), (None, texts[0]), (None, "only this text stands alone"), (5, "y " * 30000), (100, texts[0])]
    got = sorted(map(tuple, simhash.near_duplicates(table(spark, rows)).collect()), key=str)
    assert got == plain_components(rows)


def test_dense_group_and_links(spark):
    """Fingerprints one bit apart, chains, and a dense bucket: components as by all pairs."""
    rnd = random.Random(7)
    base = rnd.getrandbits(64)
    fps = {base}
    for _ in range(150):
        f = base
        for b in rnd.sample(range(64), rnd.choice([1, 2, 3, 6])):
            f ^= 1 << b
        fps.add(f)
    fps |= {rnd.getrandbits(64) for _ in range(100)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    root = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, 4)).collect()}
    comp = {f: f for f in fps}
    for a, b in itertools.combinations(fps, 2):
        if bin((a ^ b) & (1 << 64) - 1).count("1") <= 4 and comp[a] != comp[b]:
            old, new = max(comp[a], comp[b]), min(comp[a], comp[b])
            comp = {k: new if v == old else v for k, v in comp.items()}
    assert {f: root.get(f, f) for f in fps} == comp


@pytest.mark.parametrize("m", [2, 3, 5])
def test_groups_and_allocation(m):
    rng = np.random.default_rng(1)
    bits = rng.random((500, 64)) < 0.5
    bits[:, 10] = bits[:, 50]
    both = bits.T.astype(float) @ bits
    groups = simhash.group_bits(500, both, m)
    assert sorted(itertools.chain(*groups)) == list(range(64))
    assert max(map(len, groups)) - min(map(len, groups)) <= 1
    assert any({10, 50} <= set(g) for g in groups)
    costs = [{t: rng.random() * 10 ** (t + 1) for t in range(-1, 4)} for _ in range(m)]
    cost, ts = simhash.allocate(costs, 4 - m + 1)
    best = min((sum(c[t] for c, t in zip(costs, pick)), list(pick)) for pick in itertools.product(range(-1, 4), repeat=m)
               if sum(pick) == 4 - m + 1)
    assert ts == best[1] and cost == pytest.approx(best[0])


def test_empty(spark):
    assert simhash.near_duplicates(table(spark, [])).collect() == []


def test_ball():
    assert len(simhash.ball(13, 2)) == simhash._ball_size(13, 2) == 1 + 13 + 78
