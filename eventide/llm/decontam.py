"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so that a question with
other parameters has the same template.  Windows of ``WINDOW`` words of the
documents meet those of the benchmark in a hash join, as templates and word for word.
Templates with fewer than ``PLAIN`` plain words count only beside a better window of
the same alignment.  Where a document can
cover ``COVER`` or more of an item's windows, the aligned slots are compared: within
one alignment each benchmark value stands for one value in the document, and windows
with another value count only if they are equal word for word.
All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm.common import broadcast_if, cut, let

#: Words of a window, share of an item's windows that condemns, least plain words of a template that is evidence alone.
WINDOW, COVER, PLAIN = 5, 0.8, 3
# Unit words that follow a number.
UNITS = ("kg|g|mg|km|m|cm|mm|mi|miles?|feet|ft|inches|inch|in|l|ml|liters?|litres?|s|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|"
         "months?|years?|percent|dollars?|euros?|cents?|pounds?|usd|eur|degrees?|mph|kmh|meters?|metres?|grams?|kilograms?")

#: A number behind a blank (what stands before it in its word goes), and punctuation that goes.  Both begin with a
#: class that most characters fail at once.
NUMBER = r"([\t\n\x0B\f\r\x20])[^\t\n\x0B\f\r\x200123456789]*+(\d(?:[\d.,:/]*\d)?)(\S*)"
STRAY = (r"(?=[[^abcdefghijklmnopqrstuvwxyz0123456789\x20\n]&&[^\p{L}\p{M}⟨⟩\d\s]])"
         r"(?:[^\p{L}\p{M}⟨⟩:\d.\s]+|[.:](?<=\D[.:])[.:]*(?=\s|$)|:(?<!⟨[nup]:))")


def canonical(text: Column) -> Column:
    """Words of a text; slots stand as ``⟨kind:value⟩`` with kind n(umber), u(nit) or p(roper name).

    Words with a digit are numbers; unit words after a number are units; capitalised
    words that do not begin a sentence or line are names (words all in capitals are not).  Other words are in lower
    case (``ß`` as ``ss``, ``ς`` as ``σ``, for their upper case) without punctuation."""
    t = F.when(text.contains("⟨") | text.contains("⟩"), F.regexp_replace(text, "[⟨⟩]", " ")).otherwise(text)
    t = F.regexp_replace(F.concat(F.lit(" "), t), NUMBER, "$1⟨n:$2⟩ $3")
    t = F.regexp_replace(t, rf"(?i)(⟩\s{{1,4}})({UNITS})(?![\p{{L}}\d⟩])", "$1⟨u:$2⟩")
    t = F.regexp_replace(t, r"(?<=[\p{Ll}⟩,][\x20\t])(\p{Lu}\p{Ll}[\p{L}'’-]*+)(?=[\s\p{P}]|$)", "⟨p:$1⟩")
    t = F.replace(F.replace(F.lower(t), F.lit("ς"), F.lit("σ")), F.lit("ß"), F.lit("ss"))
    t = F.regexp_replace(t, STRAY, "")
    return F.filter(F.split(t, r"[\s.]*\s[\s.]*"), lambda w: w.rlike(r"[\p{L}\p{Nd}]"))


def _shown(w: Column, kinds: str) -> Column:
    """A word with its slot empty if it is of some kinds, else as its value."""
    value = F.regexp_replace(w, "⟨[nup]:|⟩", "")
    empty = F.when(F.substring(w, 2, 1).isin(*kinds), F.concat(F.substring(w, 1, 2), F.lit("⟩"))).otherwise(value) if kinds else value
    return F.when(w.startswith("⟨"), empty).otherwise(w)


def template(words: Column, kinds: str = "nup") -> Column:
    """The same words with empty slots of some kinds, the other slots as their values."""
    return F.transform(words, lambda w: _shown(w, kinds))


def literal(words: Column) -> Column:
    """The same words with slots as their values: the case of a name does not show."""
    return template(words, "")


def _windows(words: Column, size: int, kinds: str | None = None) -> Column:
    """Hashes of all windows (of the words as :func:`template` shows them, if kinds are given); a shorter
    text is one window; none has none."""
    def hashes(ws):
        joined = F.transform(F.sequence(F.lit(0), F.greatest(F.size(ws) - size, F.lit(0))), lambda i: F.xxhash64(
            *[F.get(ws, i + j) for j in range(size)]))
        return F.when(F.size(ws) > 0, joined).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w if kinds is None else _shown(w, kinds))), hashes)


def _views(words: Column, size: int) -> list[Column]:
    """Hashes of all windows as templates, as templates with the names as words, and word for
    word (empty where that is the same)."""
    none = F.array().cast("array<bigint>")
    names = F.exists(words, lambda w: w.startswith("⟨p"))
    numbers = F.exists(words, lambda w: w.startswith("⟨n") | w.startswith("⟨u"))
    return [_windows(words, size, "nup"),
            F.when(names & numbers, _windows(words, size, "nu")).otherwise(none),
            F.when(names | numbers, _windows(words, size, "")).otherwise(none)]


def _placed(hashes: Column, size: int) -> Column:
    return F.transform(hashes, lambda h, i: F.struct(i.alias("pos"), F.lit(size).alias("k"), h.alias("h")))


def _named(df: DataFrame, id_col: str, text_col: str, out: str) -> DataFrame:
    return df.select(F.col(id_col).alias(out), canonical(F.coalesce(F.col(text_col), F.lit(""))).alias("words"))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW,
                      plain: int = PLAIN) -> DataFrame:
    """(item, at, h, strong, firm, values, n, n_firm): every window of every item as template,
    with the names as words and word for word, with its words.  Templates with fewer than ``plain`` words outside slots
    are not ``strong``; ``firm`` windows have a strong template.  n and n_firm count an item's
    windows.  Items of numbers and units alone have only windows word for word."""
    b = _named(benchmark, id_col, text_col, "item").where(F.size("words") > 0)
    b = b.select("item", "words", F.forall("words", lambda w: w.rlike("^⟨[nu]:")).alias("bare"), F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))).alias("at"))
    b = b.select("item", "at", "bare", F.slice("words", F.col("at") + 1, F.lit(size)).alias("values"))
    def key(shown, slots):
        rest = F.size(F.filter("values", lambda w: ~w.rlike(slots)))
        strong = rest >= F.least(F.lit(plain), F.size("values")) if slots else F.lit(True)
        return F.struct(F.get(_windows(shown, size), F.lit(0)).alias("h"), strong.alias("strong"))

    values = F.col("values")
    word_for_word = key(literal(values), "")
    keys = F.when(F.col("bare"), F.array(word_for_word)).otherwise(
        F.array(key(template(values), "^⟨"), key(template(values, "nu"), "^⟨[nu]"), word_for_word))
    b = b.withColumn("firm", F.size(F.filter("values", lambda w: ~w.startswith("⟨"))) >= F.least(F.lit(plain), F.size("values")))
    b = b.select("item", "at", "firm", "values", F.explode(keys).alias("key")).groupBy("item", "at", "firm", "values", "key.h").agg(
        F.max("key.strong").alias("strong"))
    count = b.groupBy("item").agg(F.countDistinct("at").alias("n"), F.countDistinct(F.when(F.col("firm"), F.col("at"))).alias("n_firm"))
    return b.join(count, "item")


def _rare_windows(strong: DataFrame, hit: DataFrame, cover: float) -> DataFrame:
    """(h, item): windows of which a document that covers ``cover`` of the item's holds at least one.

    A document may miss ``n - cover * n`` firm windows, so of one more of them it has one; those that the fewest documents
    hold are taken, and a template that most items and documents share meets nobody by itself.  Items
    with fewer firm windows keep all."""
    met = hit.groupBy("h").agg(F.count("*").alias("docs"))
    at = strong.join(met, "h", "left").groupBy("item", "at", "firm").agg(
        F.sum(F.coalesce("docs", F.lit(0))).alias("docs"), F.max("n").alias("n"), F.max("n_firm").alias("n_firm"))
    least = F.floor(F.col("n") * (1 - cover) + 1e-6) + 1
    order = Window.partitionBy("item").orderBy(F.desc("firm"), "docs", "at")  # an item's windows
    at = at.withColumn("r", F.row_number().over(order)).where(
        (F.col("n_firm") < least) | (F.col("firm") & (F.col("r") <= least)))
    return strong.join(at.select("item", "at"), ["item", "at"]).select("h", "item").distinct()


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", size: int = WINDOW, cover: float = COVER) -> DataFrame:
    """(doc id, item id, cover, exact): documents that hold an item, word for word or with
    other numbers, names or units; ``exact`` is the share of covered windows whose slots
    are equal too.

    Coverage counts an item's distinct windows; of windows aligned at one offset only
    those that are equal word for word or have consistent slots count.  Names that the document writes in
    another case are compared as words.  Items shorter than a window are found by windows of
    their own length; those of one word only as whole texts (a word alone is no passage).  Items of numbers and units
    alone are found word for word.  Null and empty texts match nothing; a repeated
    document or item gives its pairs once; rows with a null id are left out (they
    cannot be named).  Other columns are not read."""
    bench = cut(benchmark_windows(benchmark.where(F.col(item_col).isNotNull()).select(item_col, item_text).distinct(),
                                  item_col, item_text, size))
    n_bench = bench.count()
    hashes = bench.groupBy("h").agg(F.max("strong").alias("strong"))
    # lengths of the items shorter than a window: fewer than ``size`` rows
    short = sorted(r["k"] for r in bench.select(F.size("values").alias("k")).distinct().collect() if 1 < r["k"] < size)
    sizes = [size, *short]
    docs = docs.where(F.col(id_col).isNotNull()).select(id_col, text_col)

    words = _named(docs, id_col, text_col, "doc")
    every = F.concat(*[v for k in sizes for v in _views(F.col("words"), k)])
    seen = words.select("doc", F.explode(F.array_distinct(every)).alias("h"))
    hit = cut(seen.join(broadcast_if(hashes.where("strong").select("h"), n_bench, 16), "h").distinct())
    strong = bench.where("strong").select("h", "item", "at", "firm", "n", "n_firm").distinct()
    near = hit.join(broadcast_if(_rare_windows(strong, hit, cover), n_bench, 40), "h").select("doc", "item").distinct()
    # Windows that are not firm may still count beside others.
    pairs = (hit.join(near, "doc").join(broadcast_if(strong, n_bench, 64), ["h", "item"]).groupBy("doc", "item")
             .agg(F.countDistinct(F.when(F.col("firm"), F.col("at"))).alias("c"), F.max("n").alias("n"), F.max("n_firm").alias("n_firm"))
             .where(F.col("c") + F.col("n") - F.col("n_firm") >= cover * F.col("n")))
    pairs = cut(pairs.select("doc", "item", "n"))
    # Only the candidates' texts are read again, for positions and slots.
    n_docs = pairs.select("doc").distinct().count()
    near = broadcast_if(pairs.select(F.col("doc").alias("d")).distinct(), n_docs, 24)
    again = _named(docs.join(near, docs[id_col] == F.col("d"), "left_semi"), id_col, text_col, "doc")
    placed = F.concat(*[_placed(v, k) for k in sizes for v in _views(F.col("words"), k)])
    again = again.select("doc", "words", F.explode(placed).alias("w")).select("doc", "words", "w.*")
    again = again.join(broadcast_if(hashes.select("h"), n_bench, 16), "h").select(
        "doc", "pos", "h", F.slice("words", F.col("pos") + 1, F.col("k")).alias("found"))
    aligned = (again.join(pairs.join(bench.select("item", "at", "h", "strong", "values"), "item"), ["doc", "h"])
               .groupBy("doc", "item", "n", "at", (F.col("pos") - F.col("at")).alias("shift"), "values", "found")
               .agg(F.max("strong").alias("strong")))
    # from here on the benchmark says what is a slot, and words are compared by their values
    aligned = aligned.withColumn("slots", F.filter(
        F.transform(F.arrays_zip(literal(F.col("values")).alias("b"), literal(F.col("found")).alias("d"), F.col("values").alias("slot")),
                    lambda z, j: z.withField("j", j)), lambda z: z["slot"].startswith("⟨"))).withColumn("same", literal(F.col("values")) == literal(F.col("found")))
    # Of the values that a benchmark value stands for in one alignment, the most frequent counts
    # (of equals its own); other windows go unless they are equal word for word.
    place = ["doc", "item", "shift"]
    pairings = aligned.select(*place, "at", "same", F.explode("slots").alias("s")).select(
        *place, "at", "same", (F.col("at") + F.col("s.j")).alias("j"), "s.b", "s.d")
    votes = pairings.groupBy(*place, "b", "d").agg(F.countDistinct("j").alias("v"))
    best = votes.groupBy(*place, "b").agg(F.max_by("d", F.struct("v", F.col("b") == F.col("d"), "d")).alias("best"))
    broken = pairings.where(~F.col("same")).join(best, [*place, "b"]).where(F.col("d") != F.col("best")).select(*place, "at").distinct()
    sound = aligned.join(broken, [*place, "at"], "left_anti")
    # A group is one item at one place, so it has at most the item's windows.
    sound = sound.withColumn("strong", F.max("strong").over(Window.partitionBy("doc", "item", "shift"))).where("strong")
    return (sound.groupBy("doc", "item", "at").agg(F.max("n").alias("n"), F.max(F.col("same").cast("int")).alias("same"))
            .groupBy("doc", "item").agg(F.max("n").alias("n"), F.count("*").alias("c"), F.sum("same").alias("same"))
            .where(F.col("c") >= cover * F.col("n"))
            .select(F.col("doc").alias(id_col), F.col("item").alias(item_col), (F.col("c") / F.col("n")).alias("cover"),
                    (F.col("same") / F.col("c")).alias("exact")))
