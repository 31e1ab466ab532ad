"""Phrase collocations by the stripes pattern.

A *stripe* belongs to a prefix of words and counts the words that follow it.  Tasks build
the stripes of their rows (combined in the task), a shuffle by prefix brings equal ones
together, and they are added elementwise.  One pass is made per prefix length 0, 1, ...;
a merged stripe gives

* its entries: how often each one-word extension of the prefix occurs;
* its sum, in which one unnamed entry holds whatever else follows (the end of a piece,
  words that cannot belong to a frequent phrase): how often the prefix itself occurs;
* its largest entry: the most frequent phrase that goes on to the right.  The most frequent
  one that begins a word earlier is the largest entry over the stripes that end alike.

A phrase can only be frequent if its parts are.  Before each pass the frequent phrases of
the last one are marked in a bitmap of fixed size; a position takes part only if its prefix
is marked.  A phrase marked by chance costs work and changes no count, so a bitmap that is
too small for the data makes the passes slower, never wrong.  The stripes of frequent
prefixes (a bounded number) are split by the following word.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm.common import arrow_batches, broadcast_if
from eventide.session import scratch_path

#: Bits of the bitmap of frequent phrases: 2 ** this.
FILTER_BITS = 25
#: A prefix with more than 1 / HOT of all words has its stripe split by the next word (at most HOT prefixes
#: are, and the empty one).
HOT = 2000
#: Buckets of stripes per shuffle partition, and at least; a task sends one row a bucket.
BUCKETS, LEAST_BUCKETS = 16, 1024
#: Counter entries, and words, that a task holds before it hands stripes on.
HELD, HELD_WORDS = 2_000_000, 500_000
#: Characters that end a piece (a class of RE2 syntax).
PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: A task's stripes of one bucket: language, prefix, the unnamed rest and the number of entries of each; the
#: entries' words joined by blanks and their counts as packed 64-bit integers.
_STRIPES = ("bucket int, lang array<string>, prefix array<string>, rest array<bigint>, size array<int>, next string, n binary")
_MERGED = "lang string, prefix string, total bigint, next array<string>, n array<bigint>"


def _hashes(strings) -> np.ndarray:
    """64-bit hashes of a list of strings."""
    return pd.util.hash_array(np.array([*strings, ""], object), categorize=False)[:-1]


def _mixed(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = (state ^ word) * _MIX
    return x ^ (x >> np.uint64(29))


def _spaced(*columns):
    return pc.binary_join_element_wise(*columns, pa.scalar(" ", pa.large_string()))


class Words:
    """The words of a batch of texts: ``ids`` into ``names`` (-1: the end of a piece) and
    the language of each."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        t = pc.fill_null(texts.cast(pa.large_string()), "")
        t = pc.ascii_lower(pc.replace_substring_regex(t, PIECE_ENDS, " \n "))  # lower-casing wants an array without offset
        t = _spaced(pc.replace_substring(t, "\t", " "), pa.scalar("\n", pa.large_string()))
        split = pc.split_pattern(t, " ")
        coded = split.flatten().dictionary_encode()
        langs = pc.fill_null(langs.cast(pa.large_string()), "und").dictionary_encode()
        self.names, self.langs = coded.dictionary, langs.dictionary
        ids = coded.indices.to_numpy().astype(np.int64)
        lang = np.repeat(langs.indices.to_numpy().astype(np.int64), np.diff(split.offsets.to_numpy()))
        empty, end = (pc.index(self.names, w).as_py() for w in ("", "\n"))
        real = (ids != empty) if empty >= 0 else np.ones(len(ids), bool)
        self.ids, self.lang = np.where(ids == end, -1, ids)[real], lang[real]

    def stripes(self, length: int, marked, lexicon: Lexicon) -> pa.Table:
        """Entries of prefixes of ``length`` words, in numbers of ``lexicon``: lang, w0, w1, ..., next (-1:
        the phrase ends or goes on with what is not marked), n."""
        ids, names = self.ids, np.array(self.names.to_pylist(), object)
        n = max(len(ids) - length, 0)
        here, size = ids[:n], len(names)
        ok = np.ones(n, bool)
        for j in range(length):
            ok &= ids[j:n + j] >= 0
        if length == 0:
            ok = follows = here >= 0
        elif n:
            word = _hashes(names)[np.maximum(ids, 0)]
            state = _hashes(self.langs.to_pylist())[self.lang][:n + 1]
            for j in range(length):
                state = _mixed(state, word[j:n + 1 + j])
            mark = marked(state)
            ok, follows = ok & mark[:-1], mark[1:] & (ids[length:] >= 0)
        span = np.flatnonzero(ok)
        if not len(span):
            return None
        columns = [ids[span + j] for j in range(length)] + [np.where(follows[span], ids[span + length], -1)]
        key = self.lang[span]
        for c in columns[:-1]:
            key = np.unique(key * size + c, return_inverse=True)[1]
        _, first, count = np.unique(key * (size + 1) + columns[-1] + 1, return_index=True, return_counts=True)
        columns = [c[first] for c in columns]
        used = np.zeros(size + 1, bool)  # the last place stands for -1
        for c in columns:
            used[c] = True
        number = np.full(size + 1, -1)
        at = np.flatnonzero(used[:-1])
        number[at] = lexicon.numbers(names[at].tolist())
        lang = lexicon.numbers(self.langs.to_pylist())[self.lang[span][first]]
        return pa.table([lang, *(number[c] for c in columns), count], names=_columns(length))


class Lexicon:
    """Words of a task and their numbers."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def numbers(self, words: list[str]) -> np.ndarray:
        known = self.known
        return np.array([known.setdefault(w, len(known)) for w in words], np.int64)

    def words(self) -> pa.Array:
        return pa.array(list(self.known), pa.string())


def _columns(length: int) -> list[str]:
    return ["lang", *(f"w{j}" for j in range(length)), "next", "n"]


def _bits(langs: pa.Array, phrases: pa.Array, bits: int) -> pa.Array:
    """Places of phrases (of equally many words) in the bitmap, as the passes compute them."""
    state = _hashes(langs.to_pylist())
    for words in zip(*[p.split(" ") for p in phrases.to_pylist()]):
        state = _mixed(state, _hashes(words))
    return pa.array((state >> np.uint64(64 - bits)).astype(np.int64))


def _bitmap(phrases: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of the phrases (all of one length): bounded by its own size."""
    def place(langs: pa.Array, words: pa.Array) -> pa.Array:
        return _bits(langs, words, bits)

    at = phrases.select(F.arrow_udf(place, "bigint")("lang", "phrase").alias("at"))
    # bitmap_bit_position and bitmap_bucket_number number from 1
    blocks = at.groupBy(F.bitmap_bucket_number(F.col("at") + 1).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("bits")).collect()
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in blocks:
        part = np.frombuffer(row["bits"], np.uint8)[:len(out)]
        out[(row["block"] - 1) * 4096:][:len(part)] = part
    return out


def _summed(tables: list[pa.Table], names: list[str]) -> pa.Table:
    t = pa.concat_tables(tables).group_by(names[:-1], use_threads=False).aggregate([("n", "sum")])
    return t.select([*names[:-1], "n_sum"]).rename_columns(names)


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Places where the key of sorted rows changes."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _bundled(bucket, lang, prefix, rest, size, words, n) -> pa.RecordBatch:
    """Stripes, sorted by bucket, as one row a bucket.  ``size`` entries of ``words`` and ``n`` belong to each."""
    head = _heads(bucket)
    of_stripes = np.append(head, len(bucket)).astype(np.int32)
    of_entries = np.concatenate(([0], np.cumsum(size)))[of_stripes].astype(np.int32)
    packed = pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer((of_entries * 8).astype(np.int32).tobytes()),
                                                            pa.py_buffer(n.astype("<i8").tobytes())])
    lists = [pa.ListArray.from_arrays(pa.array(of_stripes), x) for x in (
        lang, prefix, pa.array(rest), pa.array(size.astype(np.int32)))]
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(of_entries), words), " ")
    return pa.RecordBatch.from_arrays([pa.array(bucket[head].astype(np.int32)), *lists, joined, packed],
                                      names=["bucket", "lang", "prefix", "rest", "size", "next", "n"])


def _rolled(t: pa.Table, lexicon: Lexicon, hot, buckets: int) -> pa.RecordBatch:
    """Entries as stripes, in buckets by the hash of language and prefix; those of hot prefixes (None:
    all) by that of the next word too."""
    columns = [c.to_numpy() for c in t.columns]
    lang, prefix, follow, n = columns[0], columns[1:-2], columns[-2], columns[-1]
    words = lexicon.words()
    hashed = _hashes(words.to_pylist())
    state = hashed[lang]
    for p in prefix:
        state = _mixed(state, hashed[p])
    split = np.full(len(n), hot is None)
    for h_lang, phrase in hot or ():
        parts = [lexicon.known.get(w, -2) for w in (h_lang, *phrase.split(" "))]
        if min(parts) >= 0:
            split |= np.logical_and.reduce([c == p for c, p in zip((lang, *prefix), parts)])
    at = np.flatnonzero(split & (follow >= 0))
    state[at] = _mixed(state[at], hashed[follow[at]])
    bucket = (state % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort([follow, *reversed(prefix), lang, bucket])
    lang, prefix, follow, n, bucket = lang[order], [p[order] for p in prefix], follow[order], n[order], bucket[order]
    head = _heads(bucket, lang, *prefix)
    stripe = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(n))))
    rest = np.zeros(len(head), np.int64)
    np.add.at(rest, stripe[follow < 0], n[follow < 0])
    named = follow >= 0
    parts = [words.take(pa.array(p[head])) for p in prefix]
    text = pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0] if parts else pa.array([""] * len(head))
    return _bundled(bucket[head], words.take(pa.array(lang[head])), text, rest, np.bincount(stripe[named], minlength=len(head)),
                    words.take(pa.array(follow[named])), n[named])


def _build(length: int, bitmap, bits: int, hot, buckets: int):
    """Task function: the stripes of some texts, combined while they fit."""
    def marked(state):
        at = state >> np.uint64(64 - bits)
        return (bitmap.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0

    def run(batches):
        names, lexicon, held, rows = _columns(length), Lexicon(), [], 0
        for b in batches:
            t = Words(b.column(0), b.column(1)).stripes(length, marked, lexicon) if b.num_rows else None
            if t is not None:
                held.append(t)
                rows += len(t)
            if rows > HELD or len(lexicon.known) > HELD_WORDS:
                held = [_summed(held, names)]
                rows = len(held[0])
                if rows > HELD // 2 or len(lexicon.known) > HELD_WORDS:
                    yield _rolled(held[0], lexicon, hot.value, buckets)
                    lexicon, held, rows = Lexicon(), [], 0
        if rows:
            yield _rolled(_summed(held, names), lexicon, hot.value, buckets)
    return run


def _added(t: pa.Table):
    """Rows of stripes added elementwise: (language, prefix, rest) of every stripe, and its entries
    (stripe, words, word, count) in order of stripe."""
    def flat(name, kind):
        return pa.chunked_array([pc.list_flatten(c) for c in t[name].chunks], kind).combine_chunks()

    lang, prefix = (flat(c, pa.string()).dictionary_encode() for c in ("lang", "prefix"))
    rest, size = flat("rest", pa.int64()).to_numpy(), flat("size", pa.int32()).to_numpy()
    n = np.frombuffer(b"".join(t["n"].to_pylist()), "<i8")
    some = pc.split_pattern(t["next"].filter(pc.greater(pc.binary_length(t["n"]), 0)), " ")
    words = pa.chunked_array([pc.list_flatten(c) for c in some.chunks], pa.string()).combine_chunks().dictionary_encode()
    n_prefix, n_words = max(len(prefix.dictionary), 1), max(len(words.dictionary), 1)
    key, stripe = np.unique(lang.indices.to_numpy().astype(np.int64) * n_prefix + prefix.indices.to_numpy(), return_inverse=True)
    rests = np.zeros(len(key), np.int64)
    np.add.at(rests, stripe, rest)
    entries = pa.table([np.repeat(stripe, size) * n_words + words.indices.to_numpy(), n], names=["key", "n"])
    entries = entries.group_by("key", use_threads=False).aggregate([("n", "sum")]).sort_by("key")
    at, n = entries["key"].to_numpy(), entries["n_sum"].to_numpy()
    return (lang.dictionary.take(pa.array(key // n_prefix)), prefix.dictionary.take(pa.array(key % n_prefix)), rests,
            at // n_words, words.dictionary, at % n_words, n)


def _merge(min_count: int):
    """Task function: rows sorted by bucket; equal stripes are added elementwise.  Only the
    entries of at least ``min_count`` are named in the result; the sum has all."""
    def merged(t: pa.Table) -> pa.RecordBatch:
        lang, prefix, total, at, words, word, n = _added(t)
        np.add.at(total, at, n)
        keep = n >= min_count
        offsets = pa.array(np.append(0, np.cumsum(np.bincount(at[keep], minlength=len(total)))).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [lang, prefix, pa.array(total), pa.ListArray.from_arrays(offsets, words.take(pa.array(word[keep]))),
             pa.ListArray.from_arrays(offsets, pa.array(n[keep]))], names=["lang", "prefix", "total", "next", "n"])

    def shrunk(t: pa.Table) -> pa.Table:
        """Rows of one bucket as one."""
        lang, prefix, rest, at, words, word, n = _added(t)
        bucket = np.repeat(t["bucket"][0].as_py(), len(rest))
        return pa.Table.from_batches([_bundled(bucket, lang, prefix, rest, np.bincount(at, minlength=len(rest)), words.take(pa.array(word)), n)])

    def run(batches):
        held, fresh = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t.cast(held.schema)]).combine_chunks()
            last = int(_heads(t["bucket"].to_numpy())[-1])  # its bucket may go on in the next batch
            if last:
                yield merged(t.slice(0, last))
            fresh = len(t) - last if last else fresh + b.num_rows
            held = t.slice(last)
            if fresh > 256:  # rows of very many tasks: add them up on the way
                held, fresh = shrunk(held), 0
        if held is not None:
            yield merged(held)
    return run


def stripes(texts: DataFrame, length: int, bitmap: np.ndarray, hot, min_count: int, bits: int = FILTER_BITS) -> DataFrame:
    """Merged stripes of all prefixes of ``length`` words of ``texts`` (text, lang): lang,
    prefix, total, next, n, written to the shared folder.  ``hot``: prefixes that are split
    (None: all); a split stripe may have several rows."""
    spark = texts.sparkSession
    sc = spark.sparkContext
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    local = texts.mapInArrow(_build(length, sc.broadcast(bitmap), bits, sc.broadcast(hot), max(LEAST_BUCKETS, BUCKETS * parts)), _STRIPES)
    dealt = local.repartition(parts, "bucket").sortWithinPartitions("bucket")
    path = scratch_path(spark, f"stripes-{length}")
    dealt.mapInArrow(_merge(min_count), _MERGED).write.parquet(path)
    return spark.read.parquet(path)


def _entries(merged: DataFrame) -> DataFrame:
    """The frequent phrases of merged stripes: lang, phrase, f."""
    e = merged.select("lang", "prefix", F.explode(F.arrays_zip("next", "n")).alias("e"))
    phrase = F.when(F.col("prefix") == "", F.col("e.next")).otherwise(F.concat_ws(" ", "prefix", "e.next"))
    return e.select("lang", phrase.alias("phrase"), F.col("e.n").alias("f"))


def _score(a: Column, n: Column, l_: Column, r: Column) -> Column:
    """floor(1000 a n / (l r)), exactly: the products have up to 38 digits."""
    wide = "decimal(19,0)"
    top = (a.cast(wide) * F.lit(1000).cast("decimal(4,0)")).cast("decimal(23,0)") * n.cast("decimal(15,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (l_.cast(wide) * r.cast(wide)).cast("decimal(38,0)"))


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 5, min_count: int = 100,
         subsumed: int = 100, bits: int = FILTER_BITS) -> DataFrame:
    """Phrases of 2 to ``max_words`` words with at least ``min_count`` occurrences, per language: lang,
    phrase, cut, a, l, r, n, score.  The cut of lowest floor(1000 a n / (l r)) counts (the first
    of equal ones).  Phrases inside a longer frequent one with at least ``subsumed`` percent of their
    occurrences are left out.

    A-Z are lower-cased; punctuation and line ends cut a text into pieces, blanks and tabs a
    piece into words.  A null language is ``und``, a null or empty text has no words; repeated rows all count;
    other columns are not read; an empty table gives no rows.  Words may have any length.  n has up to 15 digits."""
    spark = docs.sparkSession
    arrow_batches(spark)
    texts = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    levels = [stripes(texts, 0, np.zeros(1, np.uint8), None, min_count, bits)]
    size = levels[0].groupBy("lang").agg(F.sum("total").alias("n"))
    words = size.agg(F.sum("n")).first()[0] or 0
    found = [_entries(levels[0])]
    for length in range(1, max_words):
        frequent = found[-1]
        # an occurrence of a frequent phrase of this length belongs to no other: at most HOT rows
        hot = {(r["lang"], r["phrase"]) for r in frequent.where(F.col("f") > max(words // HOT, 1)).collect()}
        levels.append(stripes(texts, length, _bitmap(frequent, bits), hot, min_count, bits))
        found.append(_entries(levels[-1]))
    counts = found[0]
    for f in found[1:]:
        counts = counts.unionByName(f)

    longer = [x.select("lang", F.col("prefix").alias("phrase"), F.array_max("n").alias("m")) for x in levels[2:]]
    longer += [x.select("lang", F.expr("substring(phrase, locate(' ', phrase) + 1)").alias("phrase"), F.col("f").alias("m"))
               for x in found[2:]]
    candidates = found[1] if max_words > 1 else counts.limit(0)
    for f in found[2:]:
        candidates = candidates.unionByName(f)
    if longer:
        bound = longer[0]
        for x in longer[1:]:
            bound = bound.unionByName(x)
        bound = bound.where(F.col("m").isNotNull()).groupBy("lang", "phrase").agg(F.max("m").alias("m"))
        candidates = candidates.join(bound, ["lang", "phrase"], "left").where(
            F.col("m").isNull() | (F.col("m") * 100 < F.col("f") * subsumed)).drop("m")

    # the parts of a frequent phrase are frequent, so each has its count
    words_in = F.size(F.split("phrase", " ", -1))
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), words_in - 1)).alias("cut"))
    cuts = cuts.withColumn("_l", F.expr("substring_index(phrase, ' ', cut)"))
    cuts = cuts.withColumn("_r", F.expr("substring(phrase, length(_l) + 2)"))
    n_counts = counts.count()
    for side in ("l", "r"):
        part = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(side))
        cuts = cuts.join(broadcast_if(part, n_counts, 96), (F.col("lang") == F.col("_lang")) & (F.col(f"_{side}") == F.col("_part"))).drop(
            "_lang", "_part")
    cuts = cuts.join(broadcast_if(size, size.count(), 64), "lang")
    scored = cuts.select("lang", "phrase", "n", F.struct(
        _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "cut", "a", "l", "r").alias("s"))
    return scored.groupBy("lang", "phrase", "n").agg(F.min("s").alias("s")).select(
        "lang", "phrase", "s.cut", "s.a", "s.l", "s.r", "n", "s.score")


def top(mined: DataFrame, k: int) -> DataFrame:
    """The first ``k`` phrases of every language with their rank: by score, occurrences, then
    phrase.  Tasks cut to ``k`` before the shuffle."""
    w = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return mined.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("long"))
