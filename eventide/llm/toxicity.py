"""Toxicity by cumulative-link ordinal regression.

Severity has the ordered grades 0 .. K.  One weight vector over sparse word
features serves all thresholds: P(grade > k) = sigmoid(w.x - c_k).  The
expected severity is the sum of these probabilities.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from eventide.llm.common import arrow_batches

#: Expected labelled rows of the training sample.
TRAIN_ROWS = 6000
GRADES, MIN_DOCS, L2, STEPS = 3, 5, 1.0, 200
#: Features that differ between toxic and clean texts by this z value take part, the strongest so many.
SELECT_Z, SELECT_MOST = 3.5, 4000
#: A document is rejected from this probability of any toxicity.
REJECT = 0.35
#: Lengths of the word beginnings that are features beside the words (inflected and joined words).
STEMS = range(4, 9)
#: Words whose features a worker keeps.
CACHE = 300_000
# Odd multipliers of the min-hash functions.
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
_WORD = re.compile(r"[^\W\d_]+")
_BUCKETS = 1 << 20
_cache: dict = {}


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORD.findall(text.lower())


def word_features(w: str) -> list[str]:
    return [w] + [w[:k] + "*" for k in STEMS if len(w) >= k]


def features(words: list[str]) -> Counter:
    """Occurrences of every word and word beginning of a text."""
    out: Counter = Counter()
    for w, n in Counter(words).items():
        for f in word_features(w):
            out[f] += n
    return out


def values(n: int, words: int) -> tuple[float, float]:
    """The two numbers of a feature: its count, and its rate among the text's words."""
    return math.log1p(n), math.log1p(100 * n / max(words, 20))


def _sketches(words: list[str]) -> list[tuple[int, int]]:
    """Min-hashes of the word triples of a text under four hash functions."""
    grams = np.array([xxhash.xxh64_intdigest(" ".join(words[i:i + 3])) for i in range(max(1, len(words) - 2))], np.uint64)
    return [(k, int((grams * np.uint64(m) ^ (grams >> np.uint64(29))).min())) for k, m in enumerate(_ODD)]


def distinct_texts(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Texts with words, without near copies: rare words of a copied text would look
    like evidence.  Texts that share a min-hash of word triples are copies."""
    seen, kept = set(), []
    for text, label in rows:
        words = words_of(text)
        if not words:
            continue
        marks = _sketches(words)
        if not seen.intersection(marks):
            kept.append((text, label))
        seen.update(marks)
    return kept


def evidence(rows: list[tuple[str, int]]) -> dict[str, float]:
    """z value of every frequent feature: its share of toxic texts against clean ones.

    Features are made anew in each pass and only counts are kept.  The first pass counts
    hash buckets; features of buckets that are too rare cannot be frequent."""
    buckets = np.zeros(_BUCKETS, np.int32)
    for text, _ in rows:
        buckets[list({hash(f) % _BUCKETS for f in features(words_of(text))})] += 1
    often = buckets >= MIN_DOCS
    texts, toxic = Counter(), Counter()
    for text, y in rows:
        found = [f for f in features(words_of(text)) if often[hash(f) % _BUCKETS]]
        texts.update(found)
        if y:
            toxic.update(found)
    bad = sum(y for _, y in rows)
    good, out = len(rows) - bad, {}
    for f, n in texts.items():
        if n >= MIN_DOCS and bad and good:
            p = n / len(rows)
            out[f] = (toxic[f] / bad - (n - toxic[f]) / good) / math.sqrt(p * (1 - p) * (1 / bad + 1 / good) + 1e-12)
    return out


def grade(rows: list[tuple[dict, int, int]], z: dict[str, float]) -> np.ndarray:
    """Ordered grades from binary labels: 0 for clean texts; toxic ones are split into
    equal thirds by the share of their words that are strong evidence.  ``rows`` are
    (occurrences of the chosen features, words, label)."""
    marked = {f for f, v in z.items() if v >= 2 * SELECT_Z and not f.endswith("*")}
    score = np.array([sum(n for f, n in x.items() if f in marked) / w if y else -1 for x, w, y in rows])
    if not (score >= 0).any():
        return np.zeros(len(rows), np.int64)
    cuts = np.quantile(score[score >= 0], [1 / 3, 2 / 3], method="nearest")
    return np.where(score < 0, 0, 1 + np.searchsorted(cuts, score, side="left")).astype(np.int64)


def fit(texts: list[tuple[str, int]]) -> dict:
    """{weights: feature -> (of its count, of its rate), cuts: c_0 .. c_K-1} by full-batch
    Adam on the regularised log-likelihood."""
    kept = distinct_texts(sorted(texts))
    z = evidence(kept)
    strong = sorted((f for f, v in z.items() if abs(v) >= SELECT_Z), key=lambda f: (-abs(z[f]), f))[:SELECT_MOST]
    z = {f: z[f] for f in strong}
    vocab = {f: 2 * i for i, f in enumerate(strong)}
    rows = []
    for text, y in kept:
        words = words_of(text)
        rows.append(({f: n for f, n in features(words).items() if f in vocab}, len(words), y))
    grades = grade(rows, z)
    if len(rows) < 2 or not grades.any():
        return {"weights": {}, "cuts": [20.0] * GRADES}
    r, c, v = [], [], []
    for i, (x, words, _) in enumerate(rows):
        for f in sorted(x):
            for j, value in enumerate(values(x[f], words)):
                r.append(i)
                c.append(vocab[f] + j)
                v.append(value)
    r, c, v = np.array(r, np.int64), np.array(c, np.int64), np.array(v, np.float64)
    n, d = len(rows), 2 * len(vocab)
    share = np.clip((grades > 0).mean(), 1e-3, 1 - 1e-3)
    at = np.arange(n)
    theta = np.concatenate([np.zeros(d), [-math.log(share / (1 - share))], np.zeros(GRADES - 1)])
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    one, zero = np.ones((n, 1)), np.zeros((n, 1))
    for step in range(1, STEPS + 1):
        w, gaps = theta[:d], np.exp(theta[d + 1:])
        s = np.bincount(r, weights=w[c] * v, minlength=n)
        cuts = theta[d] + np.concatenate([[0], np.cumsum(gaps)])
        p = 1 / (1 + np.exp(-np.clip(s[:, None] - cuts[None, :], -40, 40)))  # P(grade > k)
        above, slope = np.concatenate([one, p, zero], axis=1), np.concatenate([zero, p * (1 - p), zero], axis=1)
        like = np.maximum(above[at, grades] - above[at, grades + 1], 1e-12)
        low, high = slope[at, grades] / like, slope[at, grades + 1] / like
        of_cut = np.array([high[grades == k].sum() - low[grades == k + 1].sum() for k in range(GRADES)])
        later = np.cumsum(of_cut[::-1])[::-1]  # a cut moves with all gaps before it
        g = np.concatenate([np.bincount(c, weights=(low - high)[r] * v, minlength=d) - L2 * w, [later[0]], later[1:] * gaps])
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        theta = theta + 0.05 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    cuts = theta[d] + np.concatenate([[0], np.cumsum(np.exp(theta[d + 1:]))])
    return {"weights": {f: (float(theta[i]), float(theta[i + 1])) for f, i in vocab.items()}, "cuts": [float(x) for x in cuts]}


def severity(text: str, model: dict, known: dict | None = None) -> tuple[float, float]:
    """(expected severity, probability of any) of a whole text; ``known`` keeps the
    features of words that the model has."""
    weights, known = model["weights"], {} if known is None else known
    words, hits = words_of(text), Counter()
    for w, n in Counter(words).items():
        found = known.get(w)
        if found is None:
            found = known[w] = tuple(f for f in word_features(w) if f in weights)
        for f in found:
            hits[f] += n
    s = 0.0
    for f in sorted(hits):  # a fixed order of summation
        (a, b), (x, y) = weights[f], values(hits[f], len(words))
        s += a * x + b * y
    p = [1 / (1 + math.exp(-max(-40.0, min(40.0, s - c)))) for c in model["cuts"]]
    return sum(p), p[0]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", rows: int = TRAIN_ROWS) -> dict:
    """Model of about ``rows`` labelled documents, chosen by a hash of the id.  A document
    with several labels has the highest; null labels, ids and texts do not count."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("k")).agg(F.max(label_col).cast("int").alias("y")))
    n = max(1, known.count())
    part = known.where(F.pmod(F.xxhash64("k", F.lit(7)), F.lit(1 << 20)) < math.ceil(rows / n * (1 << 20)))
    sample = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).join(
        F.broadcast(part), "k").select("t", "y").collect()  # about ``rows`` rows
    return fit([(r["t"], int(r["y"] > 0)) for r in sample])


def score(docs: DataFrame, model: dict, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with ``out``: struct<severity, p_toxic, rejected>.

    Every whole text is judged alone (no shuffle; other columns stay).  A null or
    empty text, or one without known words, has the score of no evidence.  Severity is
    between 0 and the number of thresholds."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex  # bounded by the sample

    def judge(texts: pd.Series) -> pd.DataFrame:
        if key not in _cache or len(_cache[key]) > CACHE:
            _cache.clear()
            _cache[key] = {}
        got = [severity(t or "", shared.value, _cache[key]) for t in texts]
        return pd.DataFrame({"severity": [g[0] for g in got], "p_toxic": [g[1] for g in got],
                             "rejected": [g[1] >= REJECT for g in got]})

    arrow_batches(docs.sparkSession)
    udf = F.pandas_udf(judge, "severity double, p_toxic double, rejected boolean")
    return docs.withColumn(out, udf(F.col(text_col)))
