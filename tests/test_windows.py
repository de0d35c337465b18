"""Ordered operators against slow loops on random sequences."""

import random

from pyspark.sql import functions as F

from motolake.operators import windows as win

K, O = ["k"], ["i"]


def sequences(seed, n=60, longest=25, alphabet="ab"):
    rng = random.Random(seed)
    return [[rng.choice(alphabet) for _ in range(rng.randint(1, longest))] for _ in range(n)]


def frame(spark, data, name="x", kind="string"):
    return spark.createDataFrame([(k, i, v) for k, seq in enumerate(data) for i, v in enumerate(seq)], f"k int, i int, {name} {kind}")


def collect(df, column):
    out = {}
    for r in df.select("k", "i", column).orderBy("k", "i").collect():
        out.setdefault(r[0], []).append(r[2])
    return [out[k] for k in sorted(out)]


def runs_of(seq):
    out = []
    for x in seq:
        if out and out[-1][0] == x:
            out[-1][1] += 1
        else:
            out.append([x, 1])
    return out


def expand(runs):
    return [x for x, n in runs for _ in range(n)]


def test_run_id_counts_nulls_as_a_value(spark):
    df = frame(spark, [["a", None, None, "a", "a", "b"]])
    assert collect(win.run_id(df, K, O, "x"), "run") == [[1, 2, 2, 3, 3, 4]]


def test_hysteresis(spark):
    rng = random.Random(1)
    data = [[rng.choice([None, *[rng.random() for _ in range(5)]]) for _ in range(30)] for _ in range(40)]

    def slow(seq):
        on, out = False, []
        for v in seq:
            if v is None:
                out.append(False)
                continue
            on = v >= 0.3 if on else v >= 0.6
            out.append(on)
        return out

    assert collect(win.hysteresis(frame(spark, data, "v", "double"), K, O, "v", 0.6, 0.3), "on") == [slow(s) for s in data]


def test_min_duration(spark):
    data = [[x == "a" for x in s] for s in sequences(2)]
    slow = [expand([[x and n >= 3, n] for x, n in runs_of(s)]) for s in data]
    assert collect(win.min_duration(frame(spark, data, "f", "boolean"), K, O, "f", 3, "kept"), "kept") == slow


def test_dwell_settles_like_repeated_merging(spark):
    data = sequences(3, alphabet="abc")

    def slow(seq):
        seq = list(seq)
        while True:
            runs = runs_of(seq)
            short = [j for j in range(1, len(runs) - 1) if runs[j][1] < 3]
            if not short:
                return seq
            runs[short[0]][0] = runs[short[0] - 1][0]
            seq = expand(runs)

    assert collect(win.dwell(frame(spark, data), K, O, "x", 3, "y"), "y") == [slow(s) for s in data]


def test_short_runs_take_the_label_on_their_left(spark):
    data = sequences(4, alphabet="abc")

    def slow(seq):
        runs = runs_of(seq)
        last, out = None, []
        for x, n in runs:
            last = x if n >= 3 else last
            out.append([last if last is not None else (runs[1][0] if len(runs) > 1 else "idle"), n])
        return expand(out)

    assert collect(win.fill_short_runs(frame(spark, data), K, O, "x", 3, "y"), "y") == [slow(s) for s in data]


def test_gap_fill_is_greedy_from_the_left(spark):
    data = sequences(5, alphabet="abc")

    def slow(seq):
        stack = []
        for x, n in runs_of(seq):
            if len(stack) >= 2 and stack[-1][2] and stack[-1][1] < 3 and stack[-2][0] == x:
                gap, left = stack.pop(), stack.pop()
                stack.append([x, left[1] + gap[1] + n, False])
            else:
                stack.append([x, n, True])
        return [(x, n) for x, n, _ in stack]

    got = win.fill_gaps(win.runs(frame(spark, data), K, O, "x"), K, "x", 3).orderBy("k", "run").collect()
    out = {}
    for r in got:
        out.setdefault(r["k"], []).append((r["x"], r["n"]))
    assert [out[k] for k in sorted(out)] == [slow(s) for s in data]


def test_edges_advance_only_on_known_rows(spark):
    df = frame(spark, [[None, True, None, True, False, None, True]], "s", "boolean")
    assert collect(win.edges(df, K, O, "s"), "onset") == [[False, True, False, False, False, False, True]]
    assert collect(win.edges(df, K, O, "s"), "release") == [[False, False, False, False, True, False, False]]


def test_sessions_leave_separators_out(spark):
    df = frame(spark, [["g", "a", "a", "g", "g", "b"]])
    rows = win.sessions(df, K, O, F.col("x") == "g", "n").orderBy("i").collect()
    assert [(r["x"], r["n"]) for r in rows] == [("a", 0), ("a", 0), ("b", 1)]


def test_empty_input(spark):
    df = frame(spark, [])
    assert win.dwell(df, K, O, "x", 3, "y").count() == 0
    assert win.runs(df, K, O, "x").count() == 0
