"""The alignment against plain loops over bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from eventide.llm import align, bpe
from eventide.llm.queries import BYTE_BPE, PIECE_MODEL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def models():
    with open(PIECE_MODEL, "rb") as f:
        return bpe.read_model(BYTE_BPE), f.read()


class Plain:
    """Both tokenizers by the public libraries, links by comparing ends."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTE_BPE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
        self.letters = bpe.byte_letters()

    def piece(self, i):
        return bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()

    def row(self, text):
        if not text:
            return [], [], "", []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        bytes_a = [bytes(self.letters[c] for c in self.a.id_to_token(i)) for i in a]
        bytes_b = [self.piece(i) for i in b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return [], [], "", []
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in (bytes_a, bytes_b)]
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            k, m = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            links.append((a[k - 1], b[m - 1]))
            i, j = k, m
        return a, b, ";".join(groups), links

    def table(self, texts):
        rows = [self.row(t) for t in texts]
        count = Counter(x for r in rows for x in r[3])
        most = Counter()
        for (_, b), n in count.items():
            most[b] = max(most[b], n)
        return [(len(a), len(b), len(links), g, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links))
                for a, b, g, links in rows]


TEXTS = ["Hello world", "Hello world", None, "", " ", "a ▁ b", "▁", "<|endoftext|> x", "<s> </s> <unk>", "日本語テキスト 🙂 é́", "\x00\x01", "a\nb\t\r\n c",
         "  x", "x" * 5000, "…" * 300, " " * 3000, "internationalisation of tokenizers " * 50]


def test_equals_plain_loops(spark, models):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    want = Plain().table(TEXTS)
    for room in (1 << 20, 64 * 5, 0):  # all counts broadcast; five pairs; none
        done = align.count_links(align.align(df, *models), broadcast_bytes=room)
        got = {r["doc_id"]: r for r in done.withColumn("g", align.n_groups(done["groups"])).collect()}
        assert len(got) == len(TEXTS)
        for i, w in enumerate(want):
            r = got[i]
            assert (r["n_a"], r["n_b"], r["g"], r["groups"], r["n_links"], r["n_best"], r["count_sum"]) == w, TEXTS[i]


def test_products_are_matrix_products():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = (rng.random((rng.integers(1, 9), 7)) < 0.4, rng.random((rng.integers(1, 9), 7)) < 0.4)
        csr = [align.Csr(np.concatenate(([0], np.cumsum(m.sum(1)))), np.nonzero(m)[1], 7) for m in (a, b)]
        row, col, value = csr[0].product(csr[1].transposed())
        got = np.zeros((len(a), len(b)), int)
        got[row, col] = value
        assert (got == a.astype(int) @ b.astype(int).T).all()


def test_links_of_two_tilings(monkeypatch):
    rng = random.Random(2)
    for block in (1 << 17, 3):
        monkeypatch.setattr(align, "BLOCK_ROWS", block)
        for _ in range(150):
            n = rng.randrange(1, 40)
            sizes = []
            for _ in range(2):
                cuts = sorted(rng.sample(range(1, n), rng.randrange(n))) if n > 1 else []
                sizes.append(np.diff([0, *cuts, n]))
            done = align.Alignment(*sizes)
            owner = [np.repeat(np.arange(len(s)), s) for s in sizes]
            want = Counter(zip(*(o.tolist() for o in owner)))
            got = {(r, c): v for rr, cc, vv in done.overlaps() for r, c, v in zip(rr.tolist(), cc.tolist(), vv.tolist())}
            assert got == dict(want)
            ends = [np.cumsum(s) for s in sizes]
            common = sorted(set(ends[0]) & set(ends[1]))
            assert [ends[0][i] for i in done.last_a] == common == [ends[1][j] for j in done.last_b]
            group = [[sum(c < e for c in common) for e in x] for x in ends]
            assert done.group_a.tolist() == group[0] and done.group_b.tolist() == group[1]
            shared = {(r, c) for rr, cc in done.shared_groups() for r, c in zip(rr.tolist(), cc.tolist())}
            assert shared == {(i, j) for i, g in enumerate(group[0]) for j, h in enumerate(group[1]) if g == h}


def test_edges(spark, models):
    odd = spark.createDataFrame([(None, "a b", 7, 8), (None, "a b", 7, 8)], "doc_id long, text string, n_a int, _row int").drop("_row")
    got = align.count_links(align.align(odd, *models)).collect()
    assert len(got) == 2 and all(r["n_a"] == 2 and r["count_sum"] == 4 and r["n_best"] == 2 for r in got)
    assert align.count_links(align.align(odd.limit(0), *models)).count() == 0
    alone = align.align(odd.select("text"), *models)
    assert alone.columns == ["n_a", "n_b", "groups", "links"] and alone.count() == 2


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = Plain().table([r["text"] for r in rows])
    got = {r["doc_id"]: r for r in QUERIES["op13_alignment"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r, w in zip(rows, want):
        g = got[r["doc_id"]]
        assert (g["n_a"], g["n_b"], g["n_groups"], g["n_links"], g["n_best"], g["count_sum"]) == (*w[:3], *w[4:])
        assert g["groups_sha256"] == (hashlib.sha256(w[3].encode()).hexdigest() if w[3] else "")
