"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

A text becomes marked words (``▁`` stands for a blank; one is put in front).  The
distinct words of a batch are sorted, which is the depth-first order of their
trie; the forward state of every prefix is computed once and reused by all words
that share the prefix.  A second trie, of the pieces, names the pieces that end at a
character (Aho-Corasick: every state knows the longest suffix that can go on).

Two kinds of model are read.  Unigram: the forward score is the best sum of piece
scores.  BPE: a segmentation is what merging by rank gives exactly if every
neighbouring pair of its pieces is stable, that is, if merging the pair's text alone
gives the pair again.  As a Viterbi transition this is 0 for a stable pair and minus
infinity for others, and one last piece survives per prefix.
"""

from __future__ import annotations

import re
from array import array
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from eventide.llm.common import arrow_batches

MARK = "▁"
UNIGRAM, BPE = 1, 2
#: Words whose pieces a worker keeps.
CACHE = 800_000
#: Steps between suffixes and judged pairs of pieces that a worker keeps.
LEARNED = 1_000_000
_MARKED = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_cache: dict = {}


def read_model(path: str) -> dict:
    """{kind, pieces: piece -> (id, score), bytes: byte -> id, names: id -> piece, unk}
    of a model file, read on the driver."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    pieces, byte_ids, names = {}, {}, []
    for i, p in enumerate(m.pieces):
        names.append(p.piece)
        if p.type in (1, 4, 5):
            pieces[p.piece] = (i, p.score)
        elif p.type == 6:
            byte_ids[int(p.piece[1:-1], 16)] = i
    unk = next((i for i, p in enumerate(m.pieces) if p.type == 2), 0)
    if m.trainer_spec.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are read")
    return {"kind": int(m.trainer_spec.model_type), "pieces": pieces, "bytes": byte_ids, "names": names, "unk": unk}


def _borders(pieces: set[str]) -> re.Pattern:
    """Pattern of words that no piece crosses.  Beside the marks, borders are set between
    ASCII characters that are not letters and others; characters that some piece joins to
    the former are counted among them.  A model that joins many has no such borders."""
    side = {chr(i) for i in range(128) if not chr(i).isalpha()}
    pairs = {(a, b) for p in pieces for a, b in zip(p, p[1:]) if MARK not in (a, b)}
    for _ in range(4):
        joined = {c for a, b in pairs if (a in side) != (b in side) for c in (a, b)} - side
        if not joined:
            plain = "".join(map(re.escape, sorted(side)))
            return re.compile(f"{MARK}*(?:[{plain}]+|[^{plain}{MARK}]+)|{MARK}+")
        if len(joined) > 64:
            break
        side |= joined
    return _MARKED


class _Suffix(dict):
    """A suffix that some piece begins with: next character -> the longest such suffix then.
    ``ends`` holds what ends here, longest first: (length, piece, pieces that may precede it)."""

    __slots__ = ("encoder", "text", "ends")

    def __init__(self, encoder, text: str):
        self.encoder, self.text = encoder, text
        found = (text[i:] for i in range(len(text) - 1))
        self.ends = [(len(p), p, encoder.stable.setdefault(p, _Before(encoder, p))) for p in found if p in encoder.usable]

    def __missing__(self, char: str) -> _Suffix:
        text, known = self.text + char, self.encoder.prefixes
        if char not in known:
            return self.encoder.root
        while text not in known:
            text = text[1:]
        states = self.encoder.suffixes
        if text not in states:
            states[text] = _Suffix(self.encoder, text)
        self[char] = states[text]
        return states[text]


class _Before(dict):
    """Piece -> whether merging leaves it and the ``piece`` after it as they are."""

    __slots__ = ("encoder", "piece")

    def __init__(self, encoder, piece: str):
        self.encoder, self.piece = encoder, piece

    def __missing__(self, left: str) -> bool:
        self[left] = stays = self.encoder.stays(left, self.piece)
        return stays


class Decoder:
    def __init__(self, model: dict):
        self.text = np.array([p.replace(MARK, " ") for p in model["names"]], object)
        # an ASCII byte is a character wherever it stands; runs of the others are read as UTF-8
        self.byte = np.full(len(self.text), -1)
        for b, i in model["bytes"].items():
            if b < 128:
                self.text[i] = chr(b)
            else:
                self.byte[i] = b

    def decode(self, ids) -> str:
        """The text of some ids: runs of byte pieces are read as UTF-8, marks are blanks,
        and the blank put in front goes."""
        ids = np.asarray(ids, np.int64)
        found, byte = self.text[ids], self.byte[ids]
        if (byte >= 0).any():
            cuts = np.flatnonzero((byte[1:] >= 0) != (byte[:-1] >= 0)) + 1
            for at, run in zip([0, *cuts.tolist()], np.split(byte, cuts)):
                if run[0] >= 0:
                    found[at] = bytes(run.tolist()).decode(errors="replace").replace(MARK, " ")
                    found[at + 1:at + len(run)] = ""
        return "".join(found.tolist()).removeprefix(" ")


class Encoder(Decoder):
    def __init__(self, model: dict):
        super().__init__(model)
        self.pieces, self.bytes, self.unk, self.kind = model["pieces"], model["bytes"], model["unk"], model["kind"]
        self.lowest = min((s for _, s in self.pieces.values()), default=0.0) - 10.0
        # pieces that a segmentation can hold
        self.usable = {p for p in self.pieces if self.kind == UNIGRAM or self.merge(p) == [p]}
        self.prefixes = {p[:i] for p in self.usable for i in range(1, len(p) + 1)}
        self.borders = _borders(self.usable)
        self.ids: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.batch: tuple[list, list] = [], []
        self.forget()

    def forget(self) -> None:
        """Start with an empty automaton: its steps are found when they are first taken."""
        self.stable: dict[str, _Before] = {}
        self.suffixes: dict[str, _Suffix] = {}
        self.histories: dict[str, list[tuple]] = {}
        self.root = _Suffix(self, "")

    def learned(self) -> int:
        return sum(map(len, self.suffixes.values())) + sum(map(len, self.stable.values()))

    def merge(self, text: str, history: list | None = None) -> list[str]:
        """Pieces of a short text by merging its best-scored neighbours, leftmost first.
        ``history`` gets the score, first and last piece of every merge."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                p = self.pieces.get(parts[i] + parts[i + 1])
                if p is not None and (best is None or p[1] > best):
                    best, at = p[1], i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            if history is not None:
                history.append((best, parts[0], parts[-1]))

    def _history(self, piece: str) -> list[tuple]:
        known = self.histories.get(piece)
        if known is None:
            known = self.histories[piece] = []
            self.merge(piece, known)
            known.append((float("-inf"), "", ""))
        return known

    def stays(self, left: str, right: str) -> bool:
        """Whether merging the text of two pieces gives them again.  Until a merge crosses the
        border both sides take the merges that they take alone, the better one first, of
        equal ones the left one."""
        a, b = self._history(left), self._history(right)
        i, j, last, first, get = 0, 0, left[-1], right[0], self.pieces.get
        while True:
            across, mine, other = get(last + first), a[i][0], b[j][0]
            if across is not None and across[1] > mine and across[1] >= other:
                return False
            if i == len(a) - 1 and j == len(b) - 1:
                return True
            if mine >= other:
                last = a[i][2]
                i += 1
            else:
                first = b[j][1]
                j += 1

    def _last_stable(self, word: str, n: int, forward: list[tuple]) -> tuple[str, _Suffix]:
        """The last piece of the prefix of length ``n``: the one with a stable transition
        from the prefix before it.  One character always is if nothing longer is."""
        char = word[n - 1]
        state = forward[n - 1][1][char]
        for k, piece, before in state.ends:
            if k == n or before[forward[n - k][0]]:
                return piece, state
        return char, state

    def _best(self, word: str, n: int, forward: list[tuple]) -> tuple[str, _Suffix, float]:
        """The last piece of the best segmentation of a prefix, and its score; of equal
        ones the longest piece."""
        char = word[n - 1]
        state, last, best = forward[n - 1][1][char], char, None
        for k, piece, _ in state.ends:
            s = forward[n - k][2] + self.pieces[piece][1]
            if best is None or s > best:
                last, best = piece, s
        known = self.pieces.get(char)
        s = forward[n - 1][2] + (known[1] if known else self.lowest)
        return (char, state, s) if best is None or s > best else (last, state, best)

    def piece_ids(self, piece: str) -> bytes:
        """Ids of a piece as 32-bit integers; an unknown character is its bytes."""
        if piece in self.pieces:
            return self.ids.setdefault(piece, array("i", [self.pieces[piece][0]]).tobytes())
        return array("i", [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unk]).tobytes()

    def encode_words(self, words) -> dict[str, bytes]:
        """Ids of distinct words: a depth-first walk over their trie in sorted order.  The
        stack holds the last piece, the suffix and the score of every prefix on the path."""
        out, forward, last = {}, [("", self.root, 0.0)], ""
        step, known = self._last_stable if self.kind == BPE else self._best, self.ids.get
        for word in sorted(words):
            shared = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                shared += 1
            del forward[shared + 1:]
            for n in range(shared + 1, len(word) + 1):
                forward.append(step(word, n, forward))
            n, ids = len(word), []
            while n:
                piece = forward[n][0]
                ids.append(known(piece) or self.piece_ids(piece))
                n -= len(piece)
            ids.reverse()
            out[word] = b"".join(ids)
            last = word
        return out

    def split(self, text: str) -> list[str]:
        """Words of a text whose pieces never cross their borders: a blank belongs to the
        word after it, one is put in front, and if no piece of the model joins letters
        and other characters, borders are there too."""
        return self.borders.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.split(t) for t in texts]
        if len(self.words) > CACHE:
            self.words.clear()
        if self.learned() > LEARNED:
            self.forget()
        self.words.update(self.encode_words(set(chain.from_iterable(split)).difference(self.words)))
        get = self.words.__getitem__
        return [np.frombuffer(b"".join(map(get, ws)), np.int32) for ws in split]

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids of the texts of a batch, null for null.  Spark calls a function again for every
        column that is made of its result; the same batch is not encoded again then."""
        if texts != self.batch[0]:
            ids = self.encode([t or "" for t in texts])
            self.batch = texts, [None if t is None else i for t, i in zip(texts, ids)]
        return self.batch[1]


def _worker(key: str, shared) -> Encoder:
    """The encoder of this worker, kept between batches and tasks."""
    if key not in _cache:
        _cache.clear()
        _cache[key] = Encoder(shared.value)
    return _cache[key]


def _key(model: dict) -> str:
    return xxhash.xxh64_hexdigest(repr((model["kind"], model["names"])))


def encode(docs: DataFrame, model: dict, text_col: str = "text", out: str = "piece_ids") -> DataFrame:
    """``docs`` with ``out``: array<int>, the ids of every whole text.

    A null text has null ids, an empty one none.  Rows are encoded alone (no shuffle), so repeated
    rows and other columns stay as they are."""
    arrow_batches(docs.sparkSession)
    shared, key = docs.sparkSession.sparkContext.broadcast(model), _key(model)  # the vocabulary: fixed size

    def run(batch):
        return pd.Series(_worker(key, shared).encode_batch(batch.tolist()), dtype=object)

    return docs.withColumn(out, F.pandas_udf(run, "array<int>")(F.col(text_col)))


def decode(docs: DataFrame, model: dict, ids_col: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out``: the text of the ids (null: null).  It equals the encoded text
    but for the character ``▁``, which the model cannot tell from a blank."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), _key(model)

    def run(batch):
        enc = _worker(key, shared)
        return pd.Series([None if i is None else enc.decode(i) for i in batch], dtype=object)

    return docs.withColumn(out, F.pandas_udf(run, "string")(F.col(ids_col)))
