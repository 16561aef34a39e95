"""Edge cases of ordered computations, classification, vocabulary and run control."""

import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from lotweave.operators import classify, monitor, ordered, states, vocabulary

ROWS = "k string, i int, v int"


def sample(n=400, seed=3):
    r = random.Random(seed)
    return [(r.choice(["a", "a", "a", "b", None]), i, r.choice([None, 0, 1, 1, 5])) for i in range(n)]


def by_key(rows):
    out = {}
    for k, i, v in rows:
        out.setdefault(k, []).append((i, v))
    return out


def test_ordered_against_plain_loops(spark):
    rows = sample()
    df = spark.createDataFrame(rows, ROWS)
    want = {}
    for key in by_key(rows).values():
        total, last = 0, None
        for n, (i, v) in enumerate(key):
            total, last = total + (v or 0), v if v is not None else last
            want[i] = (total, n + 1, last, sum(x or 0 for _, x in key[max(0, n - 6) : n + 1]))
    for segment in (None, F.floor(F.col("i") / 37), F.floor(F.col("i") / 2)):
        run = ordered.running(df, ["k"], ["i"], {"s": F.col("v"), "n": F.lit(1)}, segment)
        last = ordered.last_known(run, ["k"], ["i"], F.col("v"), "last", segment)
        got = ordered.rolling_sum(last, ["k"], ["i"], F.col("v"), 7, "seven", segment)
        assert {r.i: (r.s, r.n, r.last, r.seven) for r in got.collect()} == want and got.count() == len(rows)


def test_ordered_handles_empty_and_global(spark):
    empty = spark.createDataFrame([], ROWS)
    assert ordered.running(empty, ["k"], ["i"], {"s": F.col("v")}, F.col("i")).isEmpty()
    assert ordered.medians(empty, ["k"], "v").isEmpty() and ordered.last_known(empty, [], ["i"], F.col("v"), "l", F.col("i")).isEmpty()
    g = ordered.ordinals(spark.range(50).toDF("i"), [], ["i"], segment=F.floor(F.col("i") / 8))
    assert all(r.ordinal == r.i + 1 for r in g.collect())


def test_medians(spark):
    rows = sample()
    got = {r.k: (r.n, r.mid) for r in ordered.medians(spark.createDataFrame(rows, ROWS), ["k"], "v", step=1).collect()}
    want = {k: [v for _, v in vs if v is not None] for k, vs in by_key(rows).items()}
    assert got == {k: (len(v), statistics.median(v)) for k, v in want.items()}


def test_streaks_and_latch_over_segments(spark):
    df = spark.createDataFrame(sample(), ROWS)
    for f in (lambda s: monitor.streaks(df, ["k"], ["i"], F.col("v") == 1, s), lambda s: monitor.latch(df, ["k"], ["i"], F.col("v"), 5, 0, s), lambda s: monitor.rolling_failures(df, ["k"], ["i"], F.col("v") == 1, 20, 8, s)):
        whole, cut = f(None), f(F.floor(F.col("i") / 11))
        assert sorted(map(str, whole.collect())) == sorted(map(str, cut.select(whole.columns).collect()))


def test_classify(spark):
    rows = [(i, "red card", "ann", "x") for i in range(5)] + [(10, "blue card", "ann", "x"), (11, "card", "bo", "topps"), (12, "poster", "ann", None), (13, None, None, None)]
    out = classify.classify(spark.createDataFrame(rows, "i int, t string, s string, b string"), "t", "s", [("art", "poster")], "card", [("r", "red")], "b", [("lean", "topps")])
    got = {r.i: (r.category, r.kind, r.method, r.confidence) for r in out.collect()}
    assert got[0] == ("card", "r", "explicit", "HIGH") and got[10] == ("card", "r", "subject", "LOW") and got[11] == ("card", "lean", "brand", "LOW")
    assert got[12] == ("art", None, "category", "HIGH") and got[13] == ("card", None, "none", "NONE") and len(got) == len(rows)


def test_reason_samples(spark):
    df = spark.range(500).select("id", F.array_compact(F.array(F.when(F.col("id") % 2 == 0, F.lit("even")), F.when(F.col("id") == 7, F.lit("seven")))).alias("why"))
    got = {r.reason: (r.n, r.samples) for r in classify.reason_samples(df, F.col("why"), "id", 3).collect()}
    assert got == {"even": (250, [0, 2, 4]), "seven": (1, [7])}


def test_vocabulary(spark):
    df = spark.createDataFrame([("topps ann", "g"), ("topps bo", "g"), ("bo topps", "h"), (None, "h")], "t string, g string")
    words = F.split(F.coalesce("t", F.lit("")), " ")
    got = {r.token: (r.n, r.n_first, r.role) for r in vocabulary.mine(df, words, 2).collect()}
    assert got == {"topps": (3, 2, "lead"), "bo": (2, 1, "lead")}
    d = {r.token: (r.g, r.n, r.n_group) for r in vocabulary.discriminators(df, words, "g", 0.6, 2).collect()}
    assert d == {"topps": ("g", 3, 2)}
    u = spark.createDataFrame([("a", 1), ("a", None), ("b", 1), ("b", 2), ("c", None)], "k string, v int")
    assert [tuple(r) for r in vocabulary.unanimous(u, "k", "v").collect()] == [("a", 1)]


def test_run_control(spark):
    planned = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "w string")
    log = spark.createDataFrame([("a", 1, "failed"), ("a", 2, "completed"), ("b", 1, "completed"), ("b", 2, "failed"), (None, 1, "empty")], "w string, n int, status string")
    assert {r.w: r.last_status for r in states.unfinished(planned, log, ["w"], ["n"]).collect()} == {"b": "failed", "c": None}
    day = lambda n: dt.datetime(2026, 1, n)
    items = spark.createDataFrame([("r", "x"), ("r", "y"), ("q", "z"), ("p", "m"), ("p", "n")], "ring string, item string")
    seen = spark.createDataFrame([("x", day(1)), ("y", day(2)), ("m", day(1)), ("stranger", day(1))], "item string, at timestamp")
    due = lambda now: {r.ring: (r.n_items, r.n_done, r.due) for r in states.due(items, seen, "ring", "item", "at", F.lit(now), 10).collect()}
    assert due(day(12)) == {"r": (2, 2, True), "q": (1, 0, True), "p": (2, 1, False)}
    assert due(day(17))["p"][2] and not due(day(5))["r"][2]
    s = spark.createDataFrame([("a", 1.0, 9.0), ("a", 5.0, None), ("b", None, None)], "g string, cpu double, mem double")
    assert {r.g: (r.level, r.causes) for r in states.levels(s, ["g"], [("cpu", 4, 6), ("mem", 7, 8)]).collect()} == {"a": (2, "mem"), "b": (0, "")}
