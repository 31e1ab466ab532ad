"""Batch pattern rules against plain state machines of the reference's keyed
functions, on many random keyed sequences at once."""

import random

from pyspark.sql import functions as F

from eventide.operators import matching, patterns


def _pending_machine(seq, timeout):
    """One pending row per key: other side matches, same side supersedes,
    a gap over the timeout drops the pending row."""
    pend, pairs, dropped = None, [], []
    for i, (side, t) in enumerate(seq):
        if pend is not None and timeout is not None and t - seq[pend][1] > timeout:
            dropped.append((pend, "timeout"))
            pend = None
        if pend is None:
            pend = i
        elif seq[pend][0] != side:
            pairs.append((pend, i))
            pend = None
        else:
            dropped.append((pend, "superseded"))
            pend = i
    if pend is not None:
        dropped.append((pend, "timeout" if timeout is not None else "pending"))
    return pairs, dropped


def test_pairing_rule_matches_state_machine(spark):
    rnd = random.Random(7)
    rows, want_pairs, want_drop = [], set(), set()
    timeout = 10
    for key in range(300):
        n = rnd.randint(1, 12)
        t, seq = 0, []
        for _ in range(n):
            t += rnd.choice([1, 2, 5, 10, 11, 20])
            seq.append((rnd.choice("RF"), t))
        to = timeout if key % 2 else None
        pairs, dropped = _pending_machine(seq, to)
        want_pairs |= {(key, a, b) for a, b in pairs}
        want_drop |= {(key, a, r) for a, r in dropped}
        rows += [(key, i, s, tt, to is not None) for i, (s, tt) in enumerate(seq)]
    df = spark.createDataFrame(rows, "k long, event_id long, side string, t_ms long, timed boolean")
    got_pairs, got_drop = set(), set()
    for timed in (True, False):
        p = matching.pair_sequences(df.filter(F.col("timed") == timed), "k", "side",
                                    ["t_ms", "event_id"], timeout_ms=timeout if timed else None,
                                    carry=("event_id",)).collect()
        got_pairs |= {(r["k"], r["prev_event_id"], r["event_id"]) for r in p if r["matched"]}
        got_drop |= {(r["k"], r["event_id"], r["unmatched_reason"]) for r in p
                     if r["unmatched_reason"]}
    assert got_pairs == want_pairs
    assert got_drop == want_drop


def _flag_machine(seq, small, large, within):
    flag, alerts = None, []
    for i, (amount, t) in enumerate(seq):
        if flag is not None and t - flag > within:
            flag = None                       # the timer cleared it
        if flag is not None:
            if amount > large:
                alerts.append(i)
            flag = None
        if amount < small:
            flag = t
    return alerts


def test_fraud_rule_matches_state_machine(spark):
    rnd = random.Random(11)
    rows, want = [], set()
    for key in range(400):
        t, seq = 0, []
        for _ in range(rnd.randint(1, 10)):
            t += rnd.choice([1, 30, 60, 61, 120])
            seq.append((rnd.choice([0.5, 0.99, 1.0, 100.0, 500.0, 500.01, 900.0]), t * 1000))
        want |= {(key, i) for i in _flag_machine(seq, 1.0, 500.0, 60_000)}
        rows += [(key, i, a, tt) for i, (a, tt) in enumerate(seq)]
    df = spark.createDataFrame(rows, "k long, event_id long, amount double, t_ms long")
    got = {(r["k"], r["event_id"]) for r in patterns.small_then_large(df, "k", "amount").collect()}
    assert got == want


def test_sessions_and_silence_match_plain_models(spark):
    rnd = random.Random(5)
    gap = 60_000
    rows, want_sessions, want_silence = [], set(), set()
    for key in range(250):
        t, ts = 0, []
        for _ in range(rnd.randint(1, 15)):
            t += rnd.choice([1, 30, 59, 60, 61, 120, 600]) * 1000
            ts.append(t)
        start, count = ts[0], 0
        for i, x in enumerate(ts):
            count += 1
            nxt = ts[i + 1] if i + 1 < len(ts) else None
            if nxt is None or nxt - x > gap:           # silence emits, session closes
                want_silence.add((key, i + 1, x))
                want_sessions.add((key, start, x + gap, count))
                if nxt is not None:
                    start, count = nxt, 0
        rows += [(key, key * 100 + i, x) for i, x in enumerate(ts)]
    df = spark.createDataFrame(rows, "k long, event_id long, t_ms long")
    got_sessions = {tuple(r) for r in patterns.sessions(df, "k", gap).collect()}
    got_silence = {tuple(r) for r in patterns.silence_counts(df, "k", gap).collect()}
    assert got_sessions == want_sessions
    assert got_silence == want_silence


def test_pairing_rule_hot_key_across_chunks(spark):
    """One key holding most rows, cut into many chunks: the carry decides the
    island of every chunk's first rows."""
    rnd = random.Random(3)
    rows, want_pairs, want_drop = [], set(), set()
    for key, n in ((0, 3000), (1, 40), (2, 5)):
        t, seq = 0, []
        for _ in range(n):
            t += rnd.choice([1, 2, 5, 10, 11, 20])
            seq.append((rnd.choice("RF"), t))
        pairs, dropped = _pending_machine(seq, 10)
        want_pairs |= {(key, a, b) for a, b in pairs}
        want_drop |= {(key, a, r) for a, r in dropped}
        rows += [(key, i, s, tt) for i, (s, tt) in enumerate(seq)]
    df = spark.createDataFrame(rows, "k long, event_id long, side string, t_ms long")
    for chunks in (5, 16):
        p = matching.pair_sequences(df, "k", "side", ["t_ms", "event_id"], timeout_ms=10,
                                    carry=("event_id",), n_chunks=chunks).collect()
        got_pairs = {(r["k"], r["prev_event_id"], r["event_id"]) for r in p if r["matched"]}
        got_drop = {(r["k"], r["event_id"], r["unmatched_reason"]) for r in p
                    if r["unmatched_reason"]}
        assert got_pairs == want_pairs
        assert got_drop == want_drop
