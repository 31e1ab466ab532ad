"""The BPE transducer against the public library, and its lookahead against plain merging."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventide.llm import bpe
from eventide.llm.queries import BYTE_BPE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return bpe.read_model(BYTE_BPE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def same(encoder, library, texts):
    got = [ids(x) for x in encoder.encode_all(texts)]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    bad = [t for t, g, w in zip(texts, got, want) if g != w]
    assert not bad, bad[:1]


def test_random_texts(model, library):
    rng = random.Random(1)
    tokens = [t.decode("utf-8", "ignore") for t in model["tokens"]]
    bits = ["a", "'re", "'", " ", "  ", "\n", "\t", "12", "!", "the", "<|endo", "<|endoftext|>", "é", "xx" * 6, "   " * 5, "\u0085", "🙂", "\x00"]
    texts = []
    for _ in range(1500):
        n = rng.choice([0, 1, 3, 20, 100])
        texts.append("".join(rng.choice(tokens) for _ in range(n)))
        texts.append("".join(rng.choice(bits) for _ in range(n)))
        texts.append("".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x3000), 0x20])) for _ in range(n)))
    same(bpe.Encoder(model), library, texts)


def test_every_character(model, library):
    same(bpe.Encoder(model), library, [f"a{chr(c)}1{chr(c)} !" for c in range(0x30000) if not 0xD800 <= c < 0xE000])


def test_blocks_and_long_words(model, library, monkeypatch):
    rng = random.Random(2)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(150_000))
    texts = [word, "a" * 200_000, " " * 140_001 + "x", "\n " * 70_000, "." * 140_000 + "  b", "é" * 70_000 + " 12" + "7" * 90_000,
             " " * 65_536, ("x" * 65_534 + "'re") * 2, "x" * 65_530 + "<|endoftext|>" + "  <|endoftext|> y"]
    same(bpe.Encoder(model), library, texts)
    monkeypatch.setattr(bpe, "BLOCK", 7)
    pieces = ["a", "'re", "'", " ", "  ", "\n", "12", "!", "the", "<|endo", "<|endoftext|>", "é", "xx" * 6, "   " * 5]
    same(bpe.Encoder(model), library, ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(1500)])


def test_special_strings_as_plain_text(model):
    plain = Tokenizer.from_file(BYTE_BPE)
    plain.encode_special_tokens = True
    same(bpe.Encoder(model, specials=False), plain, ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> "])


def test_lookahead_is_sufficient():
    """On random merge lists: what follows changes no token that ends the lookahead before the end."""
    rng, tight = random.Random(3), 0
    for _ in range(150):
        tokens, merges = [b"a", b"b", b"c"], []
        while len(merges) < 12:
            a, b = rng.randrange(len(tokens)), rng.randrange(len(tokens))
            if tokens[a] + tokens[b] not in tokens:
                merges.append((a, b, len(tokens)))
                tokens.append(tokens[a] + tokens[b])
        need = bpe.sufficient_lookahead(merges, tokens)

        def segments(word):
            out = [b"abc".index(c) for c in word]
            for a, b, new in merges:
                i = 0
                while i < len(out) - 1:
                    if out[i] == a and out[i + 1] == b:
                        out[i:i + 2] = [new]
                    i += 1
            return out

        for _ in range(20):
            word = bytes(rng.choice(b"abc") for _ in range(need + rng.randrange(1, 40)))
            head = segments(word)
            longer = segments(word + bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 20))))
            end, common = 0, 0
            for x, y in zip(head, longer):
                if x != y:
                    break
                common += len(tokens[x])
            for x in head:
                end += len(tokens[x])
                if end <= len(word) - need:
                    assert end <= common
            tight = max(tight, len(word) - common)
    assert tight > 0


def test_memory_of_the_transducer(model):
    enc = bpe.Encoder(model)
    word, most = bpe.Transducer(enc), 0
    for _ in range(200):
        word.feed("abcde" * 200)
        most = max(most, len(word.held))
    assert most < enc.window


def test_decoder_is_incremental(model, library):
    rng = random.Random(4)
    dec = bpe.Decoder(model)
    for _ in range(500):
        some = [rng.randrange(50257) for _ in range(rng.randrange(14))]
        want = library.decode(some, skip_special_tokens=False)
        assert dec.decode(np.array(some, "<u4").tobytes()) == want
        assert "".join([*(dec.feed([i]) for i in some), dec.finish()]) == want
    assert dec.decode(np.array([0, 70_000, 1], "<u4").tobytes()) == '!"'


def test_frames(spark, model, library):
    rows = [(1, "Hello world", "x"), (1, "Hello world", "x"), (2, None, "y"), (3, "", None), (None, "é" * 40_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    done = bpe.decode(bpe.encode(df, model, out="packed"), model, ids_col="packed")
    got = done.withColumn("list", bpe.unpack(F.col("packed"))).collect()
    for r in got:
        assert r["decoded"] == r["text"]
        assert r["list"] == (None if r["text"] is None else library.encode(r["text"], add_special_tokens=False).ids)
    assert len(got) == 5 and got[0]["ids"] == "x"
    assert bpe.encode(df, model).schema["ids"].dataType.simpleString() == "binary"  # a column of that name is replaced
    assert bpe.encode(df.limit(0), model).count() == 0


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "model.json"
    path.write_text('{"model": {"type": "WordPiece"}, "pre_tokenizer": null}')
    with pytest.raises(ValueError):
        bpe.read_model(str(path))


def test_query(spark, library):
    got = {r["doc_id"]: r for r in QUERIES["op11_bpe"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        d = got[r["doc_id"]]
        assert d["n_tokens"] == len(want)
        assert d["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert d["decoded_sha256"] == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
