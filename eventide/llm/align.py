"""Alignment of two tokenizers over the same bytes, by sparse incidence matrices.

Both token sequences of a text tile its bytes.  ``A`` and ``B`` are the token-byte incidence
matrices in compressed sparse rows (:class:`Csr`).  Gustavson's row-by-row product of A
and the transpose of B has an entry for every pair of tokens that share bytes, and its
value is how many they share: the *overlap links*.  Overlapping tokens whose last byte is the
same are linked as *ending together*; such ends cut the tokens into groups, the smallest
stretches that are whole in both tokenizations.  With the token-group incidence matrices
the same product gives the *shared-group links*.

Products are taken for blocks of rows of A, with the rows of the transpose that the block
meets, so their memory does not depend on the text.  The byte-level tokenizer is
:mod:`eventide.llm.bpe`; the other one is read by the public library.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm import bpe
from eventide.llm.common import BROADCAST_BYTES, arrow_batches
from eventide.session import scratch_path

#: Characters of texts that a task aligns at once (a longer text is taken alone).
BLOCK_CHARS = 1 << 20
#: Rows of A in one product.
BLOCK_ROWS = 1 << 17
#: Bytes of one pair's count in a broadcast table, as an upper estimate.
PAIR_BYTES = 64


class Csr:
    """A matrix of ones and zeros: the columns of row i are indices[indptr[i]:indptr[i + 1]]."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, n_cols: int):
        self.indptr, self.indices, self.n_cols = indptr, indices, n_cols

    @staticmethod
    def spans(begin: np.ndarray, end: np.ndarray, n_cols: int) -> Csr:
        """Row i has ones from column begin[i] to end[i] (exclusive)."""
        size = end - begin
        indptr = np.concatenate(([0], np.cumsum(size)))
        return Csr(indptr, np.arange(indptr[-1]) + np.repeat(begin - indptr[:-1], size), n_cols)

    @property
    def n_rows(self) -> int:
        return len(self.indptr) - 1

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(self.n_rows), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        indptr = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.n_cols))))
        return Csr(indptr, self.rows()[order], self.n_rows)

    def product(self, other: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gustavson's product: row i of the result is the sum of the rows of ``other`` that
        the entries of row i name.  Returns the entries as (row, column, value), in that order."""
        size = np.diff(other.indptr)[self.indices]
        row = np.repeat(self.rows(), size)
        first = np.concatenate(([0], np.cumsum(size)))
        at = np.arange(first[-1]) + np.repeat(other.indptr[self.indices] - first[:-1], size)
        key = row * other.n_cols + other.indices[at]
        if len(key) and (key[1:] < key[:-1]).any():
            key = np.sort(key, kind="stable")
        head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        value = np.diff(np.concatenate((head, [len(key)])))
        return key[head] // max(other.n_cols, 1), key[head] % max(other.n_cols, 1), value


def _blocks(begin_a, end_a, begin_b, end_b):
    """Products of blocks of rows of A with the rows of B's transpose that they meet; the
    rows and columns of a block are numbered as in the whole matrices."""
    for i in range(0, len(end_a), BLOCK_ROWS):
        k = min(i + BLOCK_ROWS, len(end_a))
        lo, hi = begin_a[i], end_a[i:k].max()
        j = int(np.searchsorted(end_b, lo, side="right"))
        m = int(np.searchsorted(begin_b, hi, side="left"))
        a = Csr.spans(begin_a[i:k] - lo, end_a[i:k] - lo, hi - lo)
        b = Csr.spans(np.maximum(begin_b[j:m], lo) - lo, np.minimum(end_b[j:m], hi) - lo, hi - lo)
        row, col, value = a.product(b.transposed())
        yield row + i, col + j, value


class Alignment:
    """Two tilings of the same bytes, given by the token lengths."""

    def __init__(self, sizes_a: np.ndarray, sizes_b: np.ndarray):
        self.end_a, self.end_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        self.begin_a, self.begin_b = self.end_a - sizes_a, self.end_b - sizes_b
        cut = [(r[e], c[e]) for r, c, _ in self.overlaps() for e in [self.end_a[r] == self.end_b[c]]]
        #: tokens that end together, in order; the g-th pair closes group g
        self.last_a = np.concatenate([a for a, _ in cut]) if cut else np.zeros(0, np.int64)
        self.last_b = np.concatenate([b for _, b in cut]) if cut else np.zeros(0, np.int64)
        self.group_a = np.searchsorted(self.last_a, np.arange(len(sizes_a)), side="left")
        self.group_b = np.searchsorted(self.last_b, np.arange(len(sizes_b)), side="left")

    def overlaps(self):
        """Blocks of overlap links (token of A, token of B, shared bytes)."""
        return _blocks(self.begin_a, self.end_a, self.begin_b, self.end_b)

    def shared_groups(self):
        """Blocks of links (token of A, token of B) of one group.  A group of m and n tokens
        has m n of them, so they are made block by block and only when asked for."""
        for r, c, _ in _blocks(self.group_a, self.group_a + 1, self.group_b, self.group_b + 1):
            yield r, c


class Pair:
    """The two tokenizers of a task."""

    def __init__(self, models: tuple):
        import sentencepiece

        model_a, proto_b = models
        self.a = bpe.Encoder(model_a, specials=False)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=proto_b)
        self.bytes_a = [t or b"" for t in model_a["tokens"]]
        self.bytes_b = [self._bytes(i) for i in range(self.b.get_piece_size())]
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in x]) for x in (self.bytes_a, self.bytes_b))
        # ids as text with what follows them: a comma, or the end of a side
        self.text_a = [np.array([f"{i}{c}" for i in range(len(self.bytes_a))], object) for c in ",|"]
        self.text_b = [np.array([f"{i}{c}" for i in range(len(self.bytes_b))], object) for c in ",;"]

    def _bytes(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[1:-1], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def tokens(self, texts: list) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both tokenizers; none where a text is null or empty or one of them does
        not give its bytes back."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        out = [none] * len(texts)
        real = [i for i, t in enumerate(texts) if t]
        ids_a = self.a.encode_all([" " + texts[i] for i in real])
        ids_b = self.b.encode([texts[i] for i in real], num_threads=1)
        for i, a, b in zip(real, ids_a, ids_b):
            # tokens of A give the bytes back by their construction: every one is the join of its two parts
            if b"".join(map(self.bytes_b.__getitem__, b)) == (" " + texts[i]).encode():
                out[i] = np.frombuffer(a, "<u4").astype(np.int64), np.array(b, np.int64)
        return out

    def align(self, texts: list):
        """Per text: n_a, n_b, the groups as text, and its linked id pairs with their times.
        The texts of a block are aligned as one: no token crosses their borders."""
        tokens = self.tokens(texts)
        a, b = (np.concatenate([t[s] for t in tokens] or [np.zeros(0, np.int64)]) for s in (0, 1))
        n_a, n_b = (np.array([len(t[s]) for t in tokens], np.int64) for s in (0, 1))
        done = Alignment(self.sizes_a[a], self.sizes_b[b])
        last_a, last_b = (np.zeros(len(x), bool) for x in (a, b))
        last_a[done.last_a], last_b[done.last_b] = True, True
        words = np.empty(len(a) + len(b), object)
        # a group's tokens of A stand behind the tokens of B of the groups before it
        before_b = np.concatenate(([0], done.last_b + 1))
        words[np.arange(len(a)) + before_b[done.group_a]] = np.where(last_a, self.text_a[1][a], self.text_a[0][a])
        words[np.arange(len(b)) + (done.last_a + 1)[done.group_b]] = np.where(last_b, self.text_b[1][b], self.text_b[0][b])
        ends = np.concatenate(([0], np.cumsum(n_a + n_b)))
        groups = ["".join(words[x:y])[:-1] for x, y in zip(ends, ends[1:])]
        text_of = np.repeat(np.arange(len(texts)), n_a)[done.last_a]
        code = a[done.last_a] * len(self.sizes_b) + b[done.last_b]
        size = len(self.sizes_a) * len(self.sizes_b)
        key, times = np.unique(text_of * size + code, return_counts=True)
        return n_a, n_b, groups, key // size, key % size, times


def _rows(shared, key: str, text_at: int, names: list[str]):
    def run(batches):
        pair = bpe.worker(shared, key, Pair)
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            at = 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size + len(texts[stop] or "") <= BLOCK_CHARS):
                    size += len(texts[stop] or "")
                    stop += 1
                n_a, n_b, groups, text_of, code, times = pair.align(texts[at:stop])
                offsets = pa.array(np.searchsorted(text_of, np.arange(stop - at + 1)).astype(np.int32))
                b_size = len(pair.sizes_b)
                links = pa.StructArray.from_arrays([pa.array(code // b_size), pa.array(code % b_size), pa.array(times)], ["a", "b", "times"])
                kept = [c for i, c in enumerate(batch.slice(at, stop - at).columns) if i != text_at]
                yield pa.RecordBatch.from_arrays(
                    kept + [pa.array(n_a), pa.array(n_b), pa.array(groups, pa.string()), pa.ListArray.from_arrays(offsets, links)],
                    names=names + ["n_a", "n_b", "groups", "links"])
                at = stop
    return run


def align(docs: DataFrame, model_a: dict, proto_b: bytes, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, and: n_a, n_b (tokens of a blank and the text by
    the byte-level tokenizer, and of the text by the other one, which puts the blank there), groups
    (``a1,a2|b1;a3|b2,b3``: ids in order) and links (array of {a, b, times}: the id pairs that end
    together and how often).

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have no
    tokens.  Rows are aligned alone (no shuffle); repeated rows stay; an empty table gives an empty
    one.  Columns of ``docs`` named like a result are replaced."""
    arrow_batches(docs.sparkSession)
    own = {"n_a", "n_b", "groups", "links", text_col.lower()}
    keep = [c for c in docs.columns if c.lower() not in own]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], text_col)
    shared = docs.sparkSession.sparkContext.broadcast((model_a, proto_b))  # two vocabularies: fixed size
    key = bpe.model_key(model_a) + xxhash.xxh64_hexdigest(proto_b)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_rows(shared, key, len(keep), keep), f"{kinds + ', ' if kinds else ''}n_a bigint, n_b bigint, groups string, "
                           "links array<struct<a: bigint, b: bigint, times: bigint>>")


def count_links(aligned: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of :func:`align` (other columns allowed) without ``links``, and: n_links, n_best (links whose
    pair occurs, over all rows, as often as the most frequent pair of its B id) and count_sum (the pairs' numbers of
    links over all rows, added over the row's links).

    Every row counts, repeated ones too.  Counts are added in the tasks before they are shuffled.
    The table of counts is broadcast if it is small; else only its most frequent pairs are (at most
    ``broadcast_bytes``, because pairs above total / k number at most k), and the links of rarer
    pairs, none of which is hot, are shuffled."""
    spark = aligned.sparkSession
    path, table = scratch_path(spark, "aligned"), scratch_path(spark, "pair-counts")
    # numbered and written once: the numbers and the alignment are not computed again
    aligned.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    each = rows.select("_row", F.explode("links").alias("_x")).select("_row", "_x.*")
    each.groupBy("a", "b").agg(F.sum("times").alias("count")).write.parquet(table)
    counts = spark.read.parquet(table)
    best = counts.groupBy("b").agg(F.max("count").alias("most"))  # at most one row per id of the vocabulary
    counts = counts.join(F.broadcast(best), "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    n_pairs, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("count"), F.lit(0))).first()
    room = broadcast_bytes // PAIR_BYTES
    value = [F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
             F.sum(F.col("times") * F.col("count")).alias("count_sum")]
    if n_pairs <= room:
        sums = each.join(F.broadcast(counts), ["a", "b"]).groupBy("_row").agg(*value)
    else:
        floor = total // max(room, 1)
        found = each.join(F.broadcast(counts.where(F.col("count") > floor)), ["a", "b"], "left")
        rare = found.where(F.col("count").isNull()).select("_row", "a", "b", "times").join(
            counts.where(F.col("count") <= floor).hint("merge"), ["a", "b"])
        both = found.where(F.col("count").isNotNull()).select("_row", "times", "count", "best").unionByName(
            rare.select("_row", "times", "count", "best"))
        sums = both.groupBy("_row").agg(*value)
    out = rows.drop("links").join(sums, "_row", "left").drop("_row")
    return out.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_links", "n_best", "count_sum")})


def n_groups(groups: Column) -> Column:
    """How many groups a text of groups has."""
    return F.when(groups == "", 0).otherwise(F.regexp_count(groups, F.lit(";")) + 1).cast("long")
