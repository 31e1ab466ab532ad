"""Language of words and texts by a linear-chain conditional random field.

Each word has affix, character n-gram and lexicon features; transitions between
the languages of neighbouring words are learned.  Forward-backward gives the
probability of each language for every word of a whole text, so that
code-switched texts are labelled word by word; a text's language is the one with
the largest expected share of its words.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventide.llm.common import arrow_batches, broadcast_if, cut

#: Bounds of the training sample: expected texts of a language, sequences and their length.
TRAIN_TEXTS, SEQUENCES, LENGTH = 250, 1500, 24
MIN_FEATURE, LEXICON, STEPS, L2 = 4, 150, 60, 0.05
UNKNOWN = "und"
#: Words whose scores a worker keeps, and padded words of one forward-backward run.
CACHE, RUN_WORDS = 300_000, 400_000
#: Features summed at once, and letters of a word looked at in one go (a word of any length is read whole).
FEATURES, PIECE = 1 << 20, 1 << 16


def _class(category: str) -> str:
    """All characters of a general category, as ranges of a character class."""
    points = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)).startswith(category)]
    starts = [c for i, c in enumerate(points) if not i or points[i - 1] != c - 1]
    ends = [c for i, c in enumerate(points) if i + 1 == len(points) or points[i + 1] != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


_LETTER = rf"[^\W_{_class('N')}]"  # numerals such as ², ½, Ⅷ are no letters
_WORD = re.compile(rf"{_LETTER}+(?:[{_class('M')}]+{_LETTER}*)*")
_cache: dict = {}
#: First letters of feature names: prefix, suffix, word, length, two and three letters.
KINDS = "pswl23"


def words_of(text: str) -> list[str]:
    """Runs of letters with their combining marks, in lower case."""
    return _WORD.findall(text.lower())


def word_features(w: str) -> list[str]:
    p = f"^{w}$"
    out = ["p" + w[:k] for k in (1, 2, 3)] + ["s" + w[-k:] for k in (1, 2, 3)] + ["w" + w, f"l{min(len(w), 12)}"]
    out += ["2" + p[i:i + 2] for i in range(len(p) - 1)]
    out += ["3" + p[i:i + 3] for i in range(len(p) - 2)]
    return out


def forward_backward(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors (T, B, K), forward and backward messages of B sequences sorted by
    falling length; ``emit`` (T, B, K) are log scores."""
    phi = np.exp(emit - emit.max(axis=2, keepdims=True))
    a = np.exp(trans)
    active = [int(n) for n in np.searchsorted(-lengths, -np.arange(1, len(emit) + 1), side="right")]
    alpha, beta = np.empty_like(phi), np.ones_like(phi)
    cur = phi[0] * np.exp(start)
    cur /= cur.sum(1, keepdims=True)
    alpha[0] = cur
    for t in range(1, len(phi)):
        n = active[t]
        cur = (cur[:n] @ a) * phi[t, :n]
        cur /= cur.sum(1, keepdims=True)
        alpha[t, :n] = cur
    at = a.T
    for t in range(len(phi) - 2, -1, -1):
        n = active[t + 1]
        b = (phi[t + 1, :n] * beta[t + 1, :n]) @ at
        beta[t, :n] = b / b.sum(1, keepdims=True)
    alpha *= (np.arange(len(phi))[:, None] < lengths[None, :])[:, :, None]
    post = alpha * beta
    post /= np.maximum(post.sum(2, keepdims=True), 1e-300)
    return post, alpha, beta


def sequences(texts: dict[str, list[str]], rng: np.random.Generator) -> tuple[list[list[str]], list[list[int]]]:
    """Training sequences: stretches of one language, and code-switched ones made of
    stretches of several, so that transitions can be learned from labelled texts."""
    langs = sorted(texts)
    pools = [[w for t in texts[la] if (w := words_of(t))] for la in langs]
    usable = [k for k, p in enumerate(pools) if p]
    xs, ys = [], []

    def stretch(k, n):
        words = pools[k][rng.integers(len(pools[k]))]
        at = rng.integers(max(1, len(words) - n + 1))
        return words[at:at + n]

    for i in range(SEQUENCES if usable else 0):
        x, y = [], []
        switched = i % 2 and len(usable) > 1
        while len(x) < LENGTH:
            k = usable[rng.integers(len(usable))] if switched or not x else y[-1]
            part = stretch(k, int(rng.integers(3, 10)) if switched else LENGTH)
            x += part
            y += [k] * len(part)
        xs.append(x[:LENGTH])
        ys.append(y[:LENGTH])
    return xs, ys


def fit(texts: dict[str, list[str]], seed: int = 1) -> dict:
    """{langs, features: name -> row, weights, trans, start}: maximum likelihood with
    Adam; features seen in fewer than MIN_FEATURE training words are left out."""
    langs = sorted(texts)
    xs, ys = sequences({k: sorted(v) for k, v in texts.items()}, np.random.default_rng(seed))
    K = len(langs)
    if not xs:
        return {"langs": langs, "features": {}, "weights": np.zeros((0, K)), "trans": np.zeros((K, K)), "start": np.zeros(K), "lexicon": {}}
    by_lang: list[dict] = [{} for _ in langs]
    for x, y in zip(xs, ys):
        for w, k in zip(x, y):
            by_lang[k][w] = by_lang[k].get(w, 0) + 1
    lexicon: dict[str, list[int]] = {}
    for k, counts in enumerate(by_lang):
        for w in sorted(counts, key=lambda w: (-counts[w], w))[:LEXICON]:
            lexicon.setdefault(w, []).append(k)
    vocab = {w: i for i, w in enumerate(sorted({w for x in xs for w in x}))}
    named = [_all_features(w, lexicon) for w in vocab]
    ids = np.array([[vocab[w] for w in x] for x in xs])
    word_n = np.bincount(ids.ravel(), minlength=len(vocab))
    total: dict[str, int] = {}
    for fs, n in zip(named, word_n):
        for f in fs:
            total[f] = total.get(f, 0) + int(n)
    features = {f: i for i, f in enumerate(sorted(f for f, n in total.items() if n >= MIN_FEATURE))}
    rows = np.array([i for i, fs in enumerate(named) for f in fs if f in features], np.int64)
    cols = np.array([features[f] for fs in named for f in fs if f in features], np.int64)
    y = np.array(ys).T
    gold = np.eye(K)[y]
    T, B = y.shape
    flat = ids.T.ravel()
    W, A, S = np.zeros((len(features), K)), np.zeros((K, K)), np.zeros(K)
    state = [np.zeros_like(p) for p in (W, A, S) for _ in (0, 1)]
    lengths = np.full(B, T)
    pair_gold = np.zeros((K, K))
    np.add.at(pair_gold, (y[:-1].ravel(), y[1:].ravel()), 1)
    for step in range(1, STEPS + 1):
        score = np.stack([np.bincount(rows, weights=W[cols, k], minlength=len(vocab)) for k in range(K)], axis=1)
        emit = score[flat].reshape(T, B, K)
        post, alpha, beta = forward_backward(emit, lengths, A, S)
        phi = np.exp(emit - emit.max(axis=2, keepdims=True))
        right = phi[1:] * beta[1:]
        pair = alpha[:-1, :, :, None] * np.exp(A)[None, None] * right[:, :, None, :]
        pair = (pair / pair.sum((2, 3), keepdims=True)).sum((0, 1))
        diff = (gold - post).reshape(-1, K)
        per_word = np.stack([np.bincount(flat, weights=diff[:, k], minlength=len(vocab)) for k in range(K)], axis=1)
        gw = np.stack([np.bincount(cols, weights=per_word[rows, k], minlength=len(features)) for k in range(K)], axis=1)
        grads = (gw - L2 * W, pair_gold - pair - L2 * A, (gold[0] - post[0]).sum(0) - L2 * S)
        for i, (p, g) in enumerate(zip((W, A, S), grads)):
            m, v = state[2 * i], state[2 * i + 1]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += 0.15 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return {"langs": langs, "features": features, "weights": W, "trans": A, "start": S, "lexicon": lexicon}


def _all_features(w: str, lexicon: dict) -> list[str]:
    return word_features(w) + [f"x{k}" for k in lexicon.get(w, ())]


class _Scorer:
    """Word scores of one model, kept between batches of a worker."""

    def __init__(self, model):
        self.model = model
        # row 0 of the weights is that of unknown features; a table for each kind of feature
        self.weights = np.vstack([np.zeros((1, len(model["langs"]))), model["weights"]])
        self.tables: list[dict[str, int]] = [{} for _ in KINDS]
        flags = {}
        for f, i in model["features"].items():
            if f[0] == "x":
                flags[int(f[1:])] = i + 1
            else:
                self.tables[KINDS.index(f[0])][f[1:]] = i + 1
        self.lexicon = {w: [flags[k] for k in ks if k in flags] for w, ks in model["lexicon"].items()}
        self.clear()

    def clear(self):
        self.index: dict[str, int] = {}
        self.rows = np.empty((1 << 12, len(self.model["langs"])))

    def add(self, words):
        """Scores of new words: the sum of the weights of their features (row 0: no feature)."""
        if len(self.index) > CACHE:
            self.clear()
        new = list(dict.fromkeys(w for w in words if w not in self.index))
        if not new:
            return
        first = len(self.index)
        if first + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty((max(len(self.rows), len(new)), self.rows.shape[1]))])
        self.rows[first:first + len(new)] = 0
        flat, sizes, owners = [], [], []

        def flush():
            if flat:
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                np.add.at(self.rows, owners, np.add.reduceat(self.weights[np.array(flat)], starts, axis=0))
            for x in (flat, sizes, owners):
                x.clear()

        prefix, suffix, word, length, two, three = (t.get for t in self.tables)
        for at, w in enumerate(new, first):
            p = f"^{w}$"
            n = len(p)
            row = [prefix(w[:1], 0), prefix(w[:2], 0), prefix(w[:3], 0), suffix(w[-1:], 0), suffix(w[-2:], 0), suffix(w[-3:], 0),
                   word(w, 0), length(str(min(len(w), 12)), 0), *self.lexicon.get(w, ())]
            for lo in range(0, n - 1, PIECE):
                row += [two(p[i:i + 2], 0) for i in range(lo, min(lo + PIECE, n - 1))]
                row += [three(p[i:i + 3], 0) for i in range(lo, min(lo + PIECE, n - 2))]
                flat += row
                sizes.append(len(row))
                owners.append(at)
                row = []
                if len(flat) >= FEATURES:
                    flush()
        flush()
        self.index.update(zip(new, range(first, first + len(new))))

    def posteriors(self, docs: list[list[str]]):
        """For each text (with words): (posteriors of its words (n, K))."""
        out: list = [None] * len(docs)
        order = sorted((i for i, d in enumerate(docs) if d), key=lambda i: -len(docs[i]))
        at = 0
        while at < len(order):
            size = max(1, RUN_WORDS // len(docs[order[at]]))
            part = order[at:at + size]
            at += size
            self.add(w for i in part for w in docs[i])
            lengths = np.array([len(docs[i]) for i in part])
            ids = np.zeros((len(part), lengths[0]), np.int64)
            get = self.index.__getitem__
            for r, i in enumerate(part):
                ids[r, :lengths[r]] = np.fromiter(map(get, docs[i]), np.int64, lengths[r])
            emit = self.rows[ids.T]
            post = forward_backward(emit, lengths, self.model["trans"], self.model["start"])[0]
            for r, i in enumerate(part):
                out[i] = post[:lengths[r], r]
        return out


def label_words(texts: list[str], model: dict) -> list[list[tuple[str, str, float]]]:
    """(word, language, probability) of every word of some texts."""
    docs = [words_of(t or "") for t in texts]
    found = _Scorer(model).posteriors(docs)
    return [[] if p is None else [(w, model["langs"][k], float(q[k])) for w, q, k in zip(d, p, p.argmax(1))]
            for d, p in zip(docs, found)]


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", texts: int = TRAIN_TEXTS) -> dict:
    """Model of about ``texts`` distinct labelled texts of each language, chosen by a hash of the
    text: copies neither count nor lower the rate.  Null texts and languages do not count.  All languages are learned."""
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    steps = F.lit(1 << 20)
    rates = cut(known.select("l", F.xxhash64("t").alias("h")).distinct().groupBy("l").agg(F.count("*").alias("n"))
                .select(F.col("l").alias("la"), F.ceil(F.lit(texts) / F.col("n") * steps).alias("rate")))
    langs = [r["la"] for r in rates.collect()]  # a row a language
    chosen = known.join(broadcast_if(rates, len(langs), 64), F.col("l") == F.col("la")).where(
        F.pmod(F.xxhash64("t"), steps) < F.col("rate"))
    sample: dict[str, list[str]] = {la: [] for la in langs}
    for r in chosen.select("t", "l").distinct().collect():  # about ``texts`` rows a language
        sample[r["l"]].append(r["t"])
    return fit(sample)


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, shares): one row per row of ``docs``.

    ``score`` is the expected share of words in the predicted language, ``shares`` those of
    all languages in sorted order.  A null text, one without a letter, or an empty model gives
    ``und`` and 0.  Ties go to the language that sorts first.  Texts are judged alone and whole, so
    repeated rows give repeated results; other columns are not read."""
    arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    kind, key = docs.schema[id_col].dataType.simpleString(), uuid.uuid4().hex

    def run(batches):
        if key not in _cache:
            _cache.clear()
            _cache[key] = _Scorer(shared.value)
        scorer = _cache[key]
        langs = scorer.model["langs"]
        for b in batches:
            found = scorer.posteriors([words_of(t) if langs else [] for t in b.column(1).to_pylist()])
            shares = [None if p is None else p.mean(0) for p in found]
            pick = [UNKNOWN if s is None else langs[int(s.argmax())] for s in shares]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(pick, pa.string()),
                 pa.array([0.0 if s is None else min(1.0, float(s.max())) for s in shares], pa.float64()),
                 pa.array([None if s is None else s.tolist() for s in shares], pa.list_(pa.float64()))],
                names=["id", "lang_pred", "score", "shares"])

    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).mapInArrow(
        run, f"id {kind}, lang_pred string, score double, shares array<double>").withColumnRenamed("id", id_col)
