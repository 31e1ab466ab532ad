"""Secret scans: fixed patterns, and character Markov models of random strings and
ordinary identifiers compared by their log-likelihood ratio.

Everything on the main path is DataFrame functions.  Spans are code point ranges.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm.common import let

# The patterns of the base kinds, in listed order (pattern, group, least length of it).
BASE = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # the runs of 24+ characters are the runs that stay
}
#: Strings that the models judge, their alphabet, and ordinary identifiers.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
IDENTIFIER = r"[A-Za-z][A-Za-z0-9_-]{4,}"
#: Expected rows of the training sample; log odds from which a string is a secret; pseudo-counts;
#: least different characters (rules and separators are not random strings).
TRAIN_ROWS, LOG_ODDS, BACKOFF, DISTINCT = 4096, 12.0, 5.0, 8
KINDS = (*BASE, "markov")
MASK = "[SECRET]"


def running_sum(a: Column, block: int = 64, depth: int = 2) -> Column:
    """Running sums of an array of longs: inside blocks from the sum of all blocks before, which is a running sum
    of block sums (work near n * block / 2; the last of ``depth`` levels sums its prefixes anew)."""
    def total(x):
        return F.aggregate(x, F.lit(0).cast("long"), lambda s, v: s + v)

    def inner(p):
        arr, base = p["a"], p["b"]
        return F.transform(arr, lambda _, i: F.get(base, (i / block).cast("int")) + total(
            F.slice(arr, (F.floor(i / block) * block + 1).cast("int"), (i % block + 1).cast("int"))))

    def outer(arr):
        blocks = F.sequence(F.lit(0), F.floor(F.size(arr) / block).cast("int"))
        if depth:
            own = F.transform(blocks, lambda b: total(F.slice(arr, b * block + 1, F.lit(block))))
            before = F.concat(F.array(F.lit(0).cast("long")), running_sum(own, block, depth - 1))
        else:
            before = F.transform(blocks, lambda b: total(F.slice(arr, F.lit(1), b * block)))
        return let(F.struct(arr.alias("a"), before.alias("b")), inner)

    return let(a, outer)


def matches(text: Column, pattern: str, group: int, kind: int) -> Column:
    """array<struct<start, kind, end, value>>: leftmost non-overlapping matches."""
    def build(p):
        steps = F.transform(p["m"], lambda m, i: F.length(p["gap"][i]).cast("long") + F.when(
            i > 0, F.length(F.get(p["m"], i - 1)).cast("long")).otherwise(F.lit(0).cast("long")))
        return F.zip_with(running_sum(steps), F.arrays_zip(p["m"].alias("m"), p["v"].alias("v")), lambda s, x: F.struct(
            s.alias("start"), F.lit(kind).alias("kind"), (s + F.length(x["m"])).alias("end"), x["v"].alias("value")))

    parts = F.struct(F.split(text, pattern, -1).alias("gap"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("v"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string>>")
    return F.when(text.rlike(pattern), let(parts, build)).otherwise(none)


def base_spans(text: Column) -> Column:
    def long_enough(least):
        return lambda m: F.length(m["value"]) >= least

    return F.concat(*[F.filter(matches(text, p, g, i), long_enough(least))
                      for i, (p, g, least) in enumerate(BASE.values())])


def pair_counts(strings: DataFrame, col: str) -> Counter:
    """Counts of neighbouring character pairs of the alphabet (bounded by its square)."""
    chars = F.split(F.col(col), "")
    pairs = F.transform(F.sequence(F.lit(1), F.length(F.col(col)) - 1),
                        lambda i: F.concat(F.get(chars, i - 1), F.get(chars, i)))
    rows = (strings.where(F.length(col) > 1).groupBy(col).agg(F.count("*").alias("n"))
            .select(F.explode(pairs).alias("p"), "n").groupBy("p").agg(F.sum("n").alias("n")).collect())
    return Counter({r["p"]: r["n"] for r in rows})


def transition(counts: Counter, uniform: float) -> dict[tuple[str, str], float]:
    """log P(next | previous): pair counts smoothed by ``BACKOFF`` pseudo-counts of the next
    character's own frequency, mixed with a share of the uniform distribution."""
    ends = {b: sum(counts[a + b] for a in ALPHABET) + 0.5 for b in ALPHABET}
    total = sum(ends.values())
    out = {}
    for a in ALPHABET:
        n = sum(counts[a + b] for b in ALPHABET)
        for b in ALPHABET:
            p = (counts[a + b] + BACKOFF * ends[b] / total) / (n + BACKOFF)
            out[a, b] = math.log(uniform / len(ALPHABET) + (1 - uniform) * p)
    return out


def train(docs: DataFrame, text_col: str = "text", rows: int = TRAIN_ROWS) -> list[float]:
    """Log-likelihood ratios (random string over identifier) of all character pairs.

    Labelled samples: the values that the base patterns find are random strings, the
    distinct identifier words beside them ordinary ones.  They come from a sample of
    about ``rows`` documents chosen by a hash of the text; half of the random model is
    the uniform distribution, so that alphabets without samples are covered."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = max(1, docs.count())
    part = docs.where(F.pmod(F.xxhash64(text), F.lit(1 << 20)) < F.lit(math.ceil(rows / n * (1 << 20)))).select(text.alias("x"))
    spans = part.select(F.explode(base_spans(F.col("x"))).alias("s"))
    clean = F.regexp_replace("x", "|".join(p for p, _, _ in BASE.values()), " ")
    words = part.select(F.explode(F.regexp_extract_all(clean, F.lit(IDENTIFIER), F.lit(0))).alias("w"))
    rand = transition(pair_counts(spans.select(F.regexp_replace("s.value", "[^A-Za-z0-9+/_=-]", "").alias("w")).distinct(), "w"), 0.5)
    plain = transition(pair_counts(words.distinct(), "w"), 0.01)
    return [rand[a, b] - plain[a, b] for a in ALPHABET for b in ALPHABET]


def ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a string: the sum over its character pairs."""
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")
    at = F.from_json(F.lit(json.dumps({c: i for i, c in enumerate(ALPHABET)})), "map<string,int>")
    return let(F.transform(F.split(token, ""), lambda c: F.coalesce(at[c], F.lit(0))), lambda ix: F.aggregate(
        F.sequence(F.lit(1), F.size(ix) - 1), F.lit(0.0),
        lambda s, i: s + F.get(table, F.get(ix, i - 1) * len(ALPHABET) + F.get(ix, i))))


def scan(docs: DataFrame, text_col: str = "text", out: str = "secrets", model: list[float] | None = None) -> DataFrame:
    """``docs`` with a column ``out``: array<struct<start, kind, end>> by start, then kind
    (0 assign, 1 access, 2 hex, 3 markov); spans of different kinds may overlap.

    A null text is empty and has no spans.  Rows are judged one by one: no shuffle, repeated
    rows give repeated results, other columns stay as they are.  ``model`` (see
    :func:`train`) is fitted on ``docs`` if not given."""
    model = train(docs, text_col) if model is None else model
    text = F.coalesce(F.col(text_col), F.lit(""))
    learned = F.filter(matches(text, TOKEN, 0, len(BASE)), lambda m: (
        F.size(F.array_distinct(F.split(m["value"], ""))) >= DISTINCT) & (ratio(m["value"], model) > LOG_ODDS))
    spans = F.array_sort(F.transform(F.concat(base_spans(text), learned), lambda m: F.struct(
        m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"))))
    return docs.withColumn(out, spans)


def render(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mask: str = MASK) -> Column:
    """The text with every maximal run of overlapping spans replaced by ``mask``."""
    def step(state, s):
        fresh = s["start"] >= state["at"]
        piece = F.when(fresh, F.concat(F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")),
                                       F.lit(mask))).otherwise(F.lit(""))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], F.array(piece)).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(spans, start, step, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
