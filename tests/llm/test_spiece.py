"""Pieces equal those of the public library, and decode to the text."""

import os
import random

import pytest

from eventide.llm import spiece
from eventide.llm.queries import PIECE_MODEL

pytestmark = pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="no vocabulary file")


@pytest.fixture(scope="module")
def model():
    return spiece.read_model(PIECE_MODEL)


def samples():
    rnd = random.Random(1)
    letters = "aeth  \n\t▁éñ漢x.,!'\"=0123😀ZT"
    out = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    return out + [" " * k + "x" * j for k in range(20) for j in range(3)] + ["", "\x00", "<s></s><0x0A>", "the " * 5000, "q" * 3000]


def test_bpe_equals_library(model):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = samples()
    enc = spiece.Encoder(model)
    ids = enc.encode(texts)
    assert [i.tolist() for i in ids] == lib.encode(texts)
    assert [enc.decode(i.tolist()) for i in ids] == [t.replace("▁", " ") for t in texts]


def test_unigram_equals_library(tmp_path):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(PIECE_MODEL, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        p.score = max(p.score, -40000.0)
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as f:
        f.write(m.SerializeToString())
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = samples()
    assert [i.tolist() for i in spiece.Encoder(spiece.read_model(path)).encode(texts)] == lib.encode(texts)


def test_prefix_states_are_shared(model, monkeypatch):
    enc, calls = spiece.Encoder(model), []
    real = enc._last_stable
    monkeypatch.setattr(enc, "_last_stable", lambda w, n, f: calls.append(w[:n]) or real(w, n, f))
    enc.encode_words(["▁these", "▁the", "▁there", "▁theses"])
    assert len(calls) == len(set(calls)) == len("▁theses") + len("re")


def test_frames(spark, model):
    rows = [(1, "a b", "x"), (2, None, "x"), (3, "", "x"), (1, "a b", "x"), (None, "z " * 9000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded_ string")
    got = spiece.decode(spiece.encode(df, model), model).collect()
    assert [r["decoded"] for r in got] == [r[1] for r in rows]
    assert got[1]["piece_ids"] is None and got[2]["piece_ids"] == []
    assert spiece.encode(df.limit(0), model).collect() == []


def test_a_batch_is_encoded_once(model, monkeypatch):
    """Spark calls the encoder again for every column that is made of its ids."""
    enc, calls = spiece.Encoder(model), []
    real = enc.split
    monkeypatch.setattr(enc, "split", lambda t: calls.append(t) or real(t))
    for batch in (["a b", None, "", "a b"], ["a b", "", None, "a b"]):
        first, again = enc.encode_batch(batch), enc.encode_batch(list(batch))
        assert [i is None for i in again] == [t is None for t in batch]
        assert all(a is b for a, b in zip(first, again))
    assert calls == ["a b", "", "", "a b", "a b", "", "", "a b"]


def test_pairs_stay_as_merging_says(model):
    enc, rnd = spiece.Encoder(model), random.Random(2)
    pieces = sorted(enc.usable)
    pairs = [(rnd.choice(pieces), rnd.choice(pieces)) for _ in range(5000)]
    pairs += [(p[:k], p[k:]) for p in pieces[::50] for k in range(1, len(p)) if {p[:k], p[k:]} <= enc.usable]
    assert all(enc.stays(a, b) == (enc.merge(a + b) == [a, b]) for a, b in pairs)


def test_forgetting_changes_no_ids(model, monkeypatch):
    texts = samples()[:300]
    want = [i.tolist() for i in spiece.Encoder(model).encode(texts)]
    monkeypatch.setattr(spiece, "LEARNED", 10)
    monkeypatch.setattr(spiece, "CACHE", 10)
    enc = spiece.Encoder(model)
    assert [enc.encode([t])[0].tolist() for t in texts] == want


def test_bytes_are_read_as_utf8(model):
    """Against one ``bytes.decode`` a run: broken, cut and ASCII bytes between pieces."""
    enc, rnd, names, of = spiece.Encoder(model), random.Random(3), model["names"], model["bytes"]
    of_id = {i: b for b, i in of.items()}
    some = [*of.values()] + [of[b] for b in "é漢😀▁\n".encode()] * 20 + rnd.sample(range(len(names)), 60)
    for _ in range(3000):
        ids, out, run = [rnd.choice(some) for _ in range(rnd.randint(0, 12))], "", b""
        for i in ids:
            if i in of_id:
                run += bytes([of_id[i]])
            else:
                out, run = out + run.decode(errors="replace") + names[i], b""
        out += run.decode(errors="replace")
        assert enc.decode(ids) == out.replace("▁", " ").removeprefix(" ")
