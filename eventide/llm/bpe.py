"""Byte-level BPE encoding and decoding as a streaming transducer of bounded lookahead.

**Lookahead.**  Take two inputs that agree in their first n bytes and apply the merges
to both, rule by rule.  Left of a frontier f (at first n) both hold the same tokens.  A
rule (u, v) moves f only if u ends at f and v begins there in one input alone, and then
by the length of u; a later rule (u', v') moves it again only if v' begins with the
token u, that is, if u is on the left spine of v' (v', its left part, the left part of
that, ...).  So f falls by no more than the heaviest chain of rules of rising rank in
which each u is on the spine of the next v, weighed by the lengths of the u.
:func:`sufficient_lookahead` computes it over the merge list.  Tokens that end so many
bytes before the end of what has been read are stable: whatever follows, they stay.

**Transducer.**  It holds a window of some lookaheads of bytes, merges it, emits the
stable tokens and goes on behind them (a BPE segmentation is the segmentation of each of
its tails that begin at a token).  Its memory is constant for words of any length; the
splitter before it holds a block of characters and an open run's class.  Decoding is an
incremental state machine from bytes to text.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm.common import arrow_batches

#: Characters of a text that are split at once; longer texts are streamed in such blocks.
BLOCK = 1 << 16
#: Longer words go through the transducer.
LONG_WORD = 64
#: Characters of encoded words that a worker keeps.
CACHE_CHARS = 4_000_000
#: A window of the transducer, in lookaheads.
WINDOW = 4
#: Fixed value: the word pattern of the byte-level pre-tokenizer.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs that the pattern lets grow without bound, by class.
RUNS = {"letter": regex.compile(r"\p{L}*"), "number": regex.compile(r"\p{N}*"),
        "space": regex.compile(r"\s*"), "other": regex.compile(r"[^\s\p{L}\p{N}]*")}
_WORDS = regex.compile(WORDS)
#: The same for texts of ASCII characters, which the plain module finds faster.
_ASCII_WORDS = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
_cache: dict = {}


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1
    characters stand for themselves, the others follow from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def sufficient_lookahead(merges, tokens) -> int:
    """Bytes behind a token after which it is stable; ``merges`` are (left, right, merged)
    ids in order of rank, ``tokens`` the bytes of each id."""
    left = {new: a for a, _, new in merges}
    heaviest: dict[int, int] = {}  # left id -> weight of the heaviest chain that ends in a rule with it
    longest = 0
    for a, b, _ in merges:
        before, spine = 0, b
        while spine is not None:
            before = max(before, heaviest.get(spine, 0))
            spine = left.get(spine)
        chain = len(tokens[a]) + before
        heaviest[a] = max(heaviest.get(a, 0), chain)
        longest = max(longest, chain)
    return longest


def read_model(path: str) -> dict:
    """{tokens: id -> bytes, merges: [(left, right, merged)], specials: text -> id,
    lookahead} of a byte-level tokenizer file, read on the driver."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    body, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = body.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get(
        "add_prefix_space") and not spec.get("normalizer") and not spec.get("post_processor") and not any(
        body.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
    added = spec.get("added_tokens") or []
    if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError("only plain byte-level BPE models are read")
    byte_of = byte_letters()
    vocab = body["vocab"]
    tokens: list = [None] * (1 + max([*vocab.values(), *(t["id"] for t in added)]))
    for text, i in vocab.items():
        tokens[i] = bytes(byte_of[c] for c in text)
    specials = {t["content"]: t["id"] for t in added}
    for text, i in specials.items():
        tokens[i] = text.encode()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in body["merges"]]
    merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
    known = {vocab[c] for c in byte_of if c in vocab}
    for a, b, new in merges:  # the lookahead rests on one rule a token, after those of its parts
        if a not in known or b not in known or new in known:
            raise ValueError("the merge list must build every token once, from earlier ones")
        known.add(new)
    if sum(c in vocab for c in byte_of) != 256:
        raise ValueError("the vocabulary lacks single bytes")
    return {"tokens": tokens, "merges": merges, "specials": specials, "lookahead": sufficient_lookahead(merges, tokens),
            "bytes": [vocab[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])]}


class Encoder:
    """The merge list, and texts encoded by it.  ``specials``: whether the strings of
    special tokens inside a text stand for those tokens, or are plain text."""

    def __init__(self, model: dict, specials: bool = True):
        self.tokens, self.lookahead = model["tokens"], model["lookahead"]
        self.byte_ids = np.array(model["bytes"], np.int64)
        rules = np.array(model["merges"], np.int64).reshape(-1, 3)
        pairs = rules[:, 0] * len(self.tokens) + rules[:, 1]
        self.by_pair = np.argsort(pairs)
        self.pairs, self.merged, self.none = pairs[self.by_pair], rules[:, 2], len(rules)
        self.lengths = np.array([len(t or b"") for t in self.tokens])
        self.window = max(64, WINDOW * self.lookahead)
        self.specials = dict(model["specials"]) if specials else {}
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) \
            if self.specials else None
        self.words: dict[str, bytes] = {}
        self.kept, self.rank = 0, None

    def _ranks(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at some positions; ``none`` where no rule fits."""
        if not self.none:
            return np.full(len(at), self.none)
        pair = ids[at] * len(self.tokens) + ids[at + 1]
        i = np.minimum(np.searchsorted(self.pairs, pair), self.none - 1)
        return np.where(self.pairs[i] == pair, self.by_pair[i], self.none)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words that are no empty strings, all words at once: in each round the
        pair of lowest rank of every word merges at all its places, in a run of one token from
        the left.  Words that are done leave the arrays."""
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank = np.full(len(ids), self.none)
        rank[inside] = self._ranks(ids, inside)
        done = []
        while True:
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.concatenate((first, [len(ids)])))
            low = np.minimum.reduceat(rank, first)
            open_words = np.repeat(low < self.none, sizes)
            if np.count_nonzero(open_words) * 2 < len(ids):
                done.append((word[~open_words], ids[~open_words]))
                ids, word, rank = ids[open_words], word[open_words], rank[open_words]
                if not len(ids):
                    break
                continue
            take = open_words & (rank == np.repeat(low, sizes))
            at = np.flatnonzero(take)
            head = np.concatenate(([True], np.diff(at) != 1))  # places in a row hold one token repeated
            odd = (at - np.repeat(at[head], np.diff(np.concatenate((np.flatnonzero(head), [len(at)]))))) % 2 == 1
            at = at[~odd]
            ids[at] = self.merged[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at = np.cumsum(keep)[at] - 1
            ids, word, rank = ids[keep], word[keep], rank[keep]
            touched = np.concatenate((at, at[at > 0] - 1))
            rank[touched] = self.none
            touched = touched[touched < len(ids) - 1]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched] = self._ranks(ids, touched)
        word = np.concatenate([w for w, _ in done])
        ids = np.concatenate([i for _, i in done])[np.argsort(word, kind="stable")]
        packed, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def merge_window(self, data: bytes) -> list[int]:
        """The same for one long stretch, with a queue of pairs over a linked list."""
        if self.rank is None:
            self.rank = dict(zip(self.pairs.tolist(), self.by_pair.tolist()))
        size, n = len(self.tokens), len(data)
        rank = self.rank.get
        ids, after, before = self.byte_ids[list(data)].tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i) for i in range(n - 1) if (r := rank(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            r, i = heapq.heappop(queue)
            j = after[i]
            if ids[i] is None or j >= n or rank(ids[i] * size + ids[j]) != r:
                continue  # one of the two has been merged since
            ids[i], ids[j] = int(self.merged[r]), None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (q := rank(ids[k] * size + ids[after[k]])) is not None:
                    heapq.heappush(queue, (q, k))
        return [x for x in ids if x is not None]

    def learn(self, words) -> None:
        """Encode distinct words that are not known yet.  Short ones are kept between batches."""
        new = [w for w in words if w not in self.words]
        if self.kept > CACHE_CHARS:
            self.words, self.kept = {w: self.words[w] for w in words if w in self.words}, 0
        short = [w for w in new if len(w) <= LONG_WORD]
        if short:
            self.words.update(zip(short, self.merge([w.encode() for w in short])))
            self.kept += sum(map(len, short)) + 8 * len(short)
        for w in new:
            if len(w) > LONG_WORD:
                out = Transducer(self)
                self.words[w] = out.feed(w) + out.finish()
                self.kept += 2 * len(w)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids (little-endian unsigned 32-bit integers) of texts, a block of characters at a time."""
        out, at = [], 0
        while at < len(texts):
            block, size = [], 0
            while at < len(texts) and (not block or size < BLOCK * 16):
                block.append(texts[at])
                size += len(texts[at])
                at += 1
            split = [(_ASCII_WORDS if t.isascii() else _WORDS).findall(t) if len(t) <= BLOCK and not (
                self.special and self.special.search(t)) else None for t in block]
            self.learn(set().union(*(s for s in split if s)))
            get = self.words.__getitem__
            out += [b"".join(map(get, s)) if s is not None else self._stream(t) for s, t in zip(split, block)]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def _stream(self, text: str) -> bytes:
        stream = Stream(self)
        return b"".join([*(stream.feed(text[i:i + BLOCK]) for i in range(0, len(text), BLOCK)), stream.finish()])


class Transducer:
    """Ids of one word that arrives in pieces; holds less than a window of bytes."""

    def __init__(self, encoder: Encoder):
        self.enc, self.held = encoder, b""

    def feed(self, text: str) -> bytes:
        out, step = [], self.enc.window
        for i in range(0, len(text), step):
            self.held += text[i:i + step].encode()
            while len(self.held) >= self.enc.window:
                out.append(self._step(self.enc.window))
        return b"".join(out)

    def _step(self, size: int) -> bytes:
        """Emit the stable tokens of the first ``size`` bytes."""
        ids = np.array(self.enc.merge_window(self.held[:size]))
        ends = np.cumsum(self.enc.lengths[ids])
        n = int(np.searchsorted(ends, size - self.enc.lookahead, side="right"))
        self.held = self.held[int(ends[n - 1]) if n else 0:]
        return ids[:n].astype("<u4").tobytes()

    def finish(self) -> bytes:
        ids = self.enc.merge_window(self.held) if self.held else []
        self.held = b""
        return array("I", ids).tobytes()


class Stream:
    """Ids of one text that arrives in pieces.  Special tokens cut it first; a word is
    encoded once its end is certain, and a word longer than a block goes through a
    transducer while it grows."""

    def __init__(self, encoder: Encoder):
        self.enc, self.tail, self.text = encoder, "", ""
        self.run: str | None = None
        self.word: Transducer | None = None

    def feed(self, chunk: str) -> bytes:
        enc, out = self.enc, []
        if enc.special is None:
            return self._plain(chunk, False)
        chunk = self.tail + chunk
        while m := enc.special.search(chunk):
            if any(len(s) > len(m.group()) and s.startswith(chunk[m.start():]) for s in enc.specials):
                break  # a longer special token may still come here
            out += [self._plain(chunk[:m.start()], True), array("I", [enc.specials[m.group()]]).tobytes()]
            chunk = chunk[m.end():]
        longest = min(len(chunk), max(map(len, enc.specials)))
        hold = next((k for k in range(longest, 0, -1) if any(s.startswith(chunk[-k:]) for s in enc.specials)), 0)
        self.tail = chunk[len(chunk) - hold:]
        out.append(self._plain(chunk[:len(chunk) - hold], False))
        return b"".join(out)

    def finish(self) -> bytes:
        rest, self.tail, out = self.tail, "", []
        while self.enc.special and (m := self.enc.special.search(rest)):
            out += [self._plain(rest[:m.start()], True), array("I", [self.enc.specials[m.group()]]).tobytes()]
            rest = rest[m.end():]
        return b"".join([*out, self._plain(rest, True)])

    def _plain(self, more: str, last: bool) -> bytes:
        """Text without special tokens; ``last``: nothing of this stretch follows."""
        text, out, at = self.text + more, [], 0
        self.text = ""
        if self.run:
            at = self._grow(text, last, out)
            if self.run:
                return b"".join(out)
        words, grown = [], False
        for m in _WORDS.finditer(text, at):
            a, b = m.span()
            if not last and (b == len(text) or a + 3 > len(text)):  # more text may change this word
                self.text, grown = text[a:], b == len(text) and b - a > BLOCK
                break
            words.append(m.group())
        self.enc.learn(set(words))
        out += map(self.enc.words.__getitem__, words)
        if grown:
            self._open(out)
        return b"".join(out)

    def _open(self, out: list) -> None:
        """The held word has outgrown a block: start a transducer on it."""
        kinds = [k for k, p in RUNS.items() if p.fullmatch(self.text[-1])]
        self.run, self.word = kinds[0], Transducer(self.enc)
        keep = 1 if self.run == "space" else 0  # the last white space may begin the next word
        out.append(self.word.feed(self.text[:len(self.text) - keep]))
        self.text = self.text[len(self.text) - keep:]

    def _grow(self, text: str, last: bool, out: list) -> int:
        """Feed the open run; returns where the text behind it begins."""
        end = RUNS[self.run].match(text).end()
        ended = last or end < len(text)
        take = end
        if self.run == "space" and end and not (last and end == len(text)):
            take = end - 1
        out.append(self.word.feed(text[:take]))
        if ended:
            out.append(self.word.finish())
            self.run = self.word = None
            return take
        self.text = text[take:]
        return take


class Decoder:
    """Bytes of ids become text as they come: a state machine holds the bytes of an
    unfinished character.  Ids outside the vocabulary are skipped, bytes that are no
    UTF-8 become U+FFFD."""

    def __init__(self, model: dict):
        self.tokens = model["tokens"]
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        tokens, n = self.tokens, len(self.tokens)
        try:
            data = b"".join([tokens[i] for i in ids])
        except (IndexError, TypeError):
            data = b"".join(tokens[i] or b"" for i in ids if i < n)
        return self.state.decode(data)

    def finish(self) -> str:
        end = self.state.decode(b"", True)
        self.state.reset()
        return end

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        return "".join([*(self.feed(ids[i:i + BLOCK].tolist()) for i in range(0, len(ids), BLOCK)), self.finish()])


def worker(shared, key: str, build):
    """An object of this Python worker, built once from a broadcast model."""
    if key not in _cache:
        if len(_cache) > 4:
            _cache.clear()
        _cache[key] = build(shared.value)
    return _cache[key]


def model_key(model: dict) -> str:
    return xxhash.xxh64_hexdigest(repr((model["tokens"], model["merges"], model["specials"])))


def encode(docs: DataFrame, model: dict, text_col: str = "text", out: str = "ids", specials: bool = True) -> DataFrame:
    """``docs`` with ``out``: binary, the ids of every whole text, each a little-endian
    unsigned 32-bit integer (:func:`unpack` makes an array of them).

    A null text has null ids, an empty one none.  Rows are encoded alone (no shuffle), so
    repeated rows and other columns stay as they are; a column named ``out`` is replaced.  Long
    texts and long words are streamed."""
    arrow_batches(docs.sparkSession)
    shared, key = docs.sparkSession.sparkContext.broadcast(model), f"{model_key(model)}{specials}"  # the vocabulary: fixed size

    def run(texts: pa.Array) -> pa.Array:
        enc = worker(shared, key, lambda m: Encoder(m, specials))
        ids = enc.encode_all([t or "" for t in texts.to_pylist()])
        return pa.array(ids, pa.binary(), mask=texts.is_null().to_numpy(zero_copy_only=False))

    return docs.withColumn(out, F.arrow_udf(run, "binary")(F.col(text_col)))


def decode(docs: DataFrame, model: dict, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out``: the text of packed ids (null: null), special tokens included.
    It equals the encoded text."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), f"{model_key(model)}decoder"

    def run(ids: pa.Array) -> pa.Array:
        dec = worker(shared, key, Decoder)
        return pa.array([None if i is None else dec.decode(i) for i in ids.to_pylist()], pa.string())

    return docs.withColumn(out, F.arrow_udf(run, "string")(F.col(ids_col)))


def unpack(ids: Column) -> Column:
    """Packed ids as array<long>."""

    def run(packed: pa.Array) -> pa.Array:
        return pa.array([None if p is None else np.frombuffer(p, "<u4").astype("int64") for p in packed.to_pylist()],
                        pa.list_(pa.int64()))

    return F.arrow_udf(run, "array<bigint>")(ids)


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
