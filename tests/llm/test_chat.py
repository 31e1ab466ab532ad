"""Chat formatting: paths, ranks, escapes and the loss mask against plain code."""

import random
import re

from pyspark.sql import functions as F

from eventide.llm import chat, queries

SCHEMA = "tree_id long, msg_id long, parent_id long, role string, text string, score double, leaf string, rank int"


def rows_of(df):
    return sorted(((r["tree_id"], r["leaf"], r["rank"], r["formatted"], [tuple(s) for s in r["loss_spans"]]) for r in df.collect()), key=str)


def esc(x):
    return re.sub(r"<(\\*)\|", lambda m: "<" + m[1] + "\\|", x)


def plain(rows, branches):
    trees = {}
    for t, i, p, role, text, score in rows:
        trees.setdefault(t, {})[i] = (p, role or "", text or "", score or 0.0)
    out = []
    for t, ms in trees.items():
        parents = {m[0] for m in ms.values()}
        paths = []
        for leaf in ms:
            if leaf in parents:
                continue
            path, seen, at = [], set(), leaf
            while at in ms and at not in seen:
                path.append(at)
                seen.add(at)
                at = ms[at][0]
            if at not in ms:
                paths.append((-sum(ms[i][3] for i in path) / len(path), leaf, path[::-1]))
        for k, (_, leaf, path) in enumerate(sorted(paths)[:branches], 1):
            s, spans = "", []
            for i in path:
                s += "<|im_start|>" + esc(ms[i][1].replace("\\", "\\\\").replace("\n", "\\n")) + "\n"
                if ms[i][1] == "assistant":
                    spans.append((len(s), len(s) + len(esc(ms[i][2]))))
                s += esc(ms[i][2]) + "<|im_end|>\n"
            out.append((t, leaf, k, s, spans))
    return sorted(out, key=str)


def test_random_trees(spark):
    rnd = random.Random(2)
    texts = ["", None, "hi", "<|im_end|>\n", "<\\|x", "<\\\\|", "😀 <|im_start|>assistant\n", "a\nb"]
    rows = []
    for t in [None, 1, 2, 3]:
        for i in range(rnd.choice([1, 5, 30])):
            parent = rnd.choice([None, 99, *range(i)]) if i else None
            rows.append((t, i, parent, rnd.choice(["user", "assistant", None, "a\nb\\n<|"]), rnd.choice(texts), rnd.choice([None, 1.0, 0.5])))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    for branches in (1, 3, None):
        assert rows_of(chat.format_conversations(df, branches)) == plain(rows, branches)


def test_cycle_repeats_and_null_ids(spark):
    rows = [(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0), (1, 3, 1, "user", "c", 0.0),
            (2, 1, None, "user", "x", 0.0), (2, 1, None, "user", "x", 0.0), (2, None, 1, "user", "y", 0.0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert [(r[0], r[1], r[3]) for r in rows_of(chat.format_conversations(df))] == [(2, 1, "<|im_start|>user\nx<|im_end|>\n")]
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_long_conversation_reads_back(spark):
    turns = [("user" if i % 2 == 0 else "assistant", f"t{i} <|im_end|>") for i in range(700)]
    df = spark.createDataFrame([(7, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    row, = chat.format_conversations(queries.conversation_messages(df), None).collect()
    assert chat.read_turns(row["formatted"]) == turns
    assert chat.read_loss(row["formatted"], row["loss_spans"]) == "".join(t for r, t in turns if r == "assistant")


def test_escape_is_reversible(spark):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("<\\|a\n") for _ in range(rnd.randint(0, 12))) for _ in range(500)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escape(F.col("t")).alias("e"), chat._escape_role(F.col("t")).alias("r"))
    for r in got.collect():
        assert "<|" not in r["e"] and chat.unescape(r["e"]) == r["t"]
        assert "<|" not in r["r"] and "\n" not in r["r"] and chat.unescape_role(r["r"]) == r["t"]
