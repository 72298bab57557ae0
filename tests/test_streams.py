"""Streams over input that arrives in pieces: bucketed state, restarts, late rows, sessions, sketches."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from strata.streaming import stream as ST

T0 = dt.datetime(2024, 1, 1, 10, 0)
SCHEMA = "user_id long, ts timestamp, v double"


def _events(n=400, users=40, seed=4):
    rng = random.Random(seed)
    rows = [(rng.randrange(users), T0 + dt.timedelta(seconds=rng.randrange(40 * 3600)), float(rng.randrange(100))) for _ in range(n)]
    return sorted(rows, key=lambda r: r[1])


def _arrive(spark, folder, pieces, first=0):
    """One file a piece, in order of modification time."""
    for i, rows in enumerate(pieces, first):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/b{i:03d}")
        time.sleep(0.05)
        for f in os.listdir(f"{folder}/b{i:03d}"):
            os.utime(f"{folder}/b{i:03d}/{f}", (1.7e9 + i, 1.7e9 + i))


def _source(spark, folder):
    return ST.stream_scan(spark, f"{folder}/b*/*.parquet", spark.createDataFrame([], SCHEMA).schema, max_files=1)


def _totals(df):
    return df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.min("ts").alias("first"))


def test_batches_rewrite_only_the_buckets_they_touch(spark, tmp_path):
    t = ST.BucketTable(spark, f"{tmp_path}/t", ["k"], buckets=8)
    t.upsert(spark.range(100).selectExpr("id AS k", "0 AS v"), 0)
    assert set(t.states().values()) == {0} and len(t.states()) == 8
    t.upsert(spark.createDataFrame([(5, 1)], "k long, v int"), 1)
    assert sorted(t.states().values()) == [0] * 7 + [1]
    assert {r.k: r.v for r in t.latest().collect()} == {k: int(k == 5) for k in range(100)}
    # the state before a batch is still there, so running it again gives the same table
    assert {r.v for r in t.latest(before=1).collect()} == {0}
    t.upsert(spark.createDataFrame([(5, 1)], "k long, v int"), 1)
    assert t.latest().count() == 100
    # a batch that wrote its folders but died before its marker doesn't count
    t.upsert(spark.createDataFrame([(5, 9)], "k long, v int"), 2)
    os.rmdir(f"{tmp_path}/t/_committed/e2")
    assert t.latest().where("k = 5").first().v == 1
    t.upsert(spark.createDataFrame([(5, 2)], "k long, v int"), 2)
    assert {r.k: r.v for r in t.latest().collect()} == {k: 2 * (k == 5) for k in range(100)}
    # two states of a bucket are kept
    for e in range(3, 7):
        t.upsert(spark.createDataFrame([(5, e)], "k long, v int"), e)
    bucket = next(b for b, e in t.states().items() if e == 6)
    assert sorted(x for x in os.listdir(f"{tmp_path}/t/_bucket={bucket}") if x.startswith("_batch")) == ["_batch=5", "_batch=6"]


def test_upsert_replaces_null_keys(spark, tmp_path):
    t = ST.BucketTable(spark, f"{tmp_path}/t", ["k"])
    t.upsert(spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int"), 0)
    t.upsert(spark.createDataFrame([(None, 2)], "k string, v int"), 1)
    assert {(r.k, r.v) for r in t.latest().collect()} == {(None, 2), ("a", 1)}


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    t = ST.BucketTable(spark, f"{tmp_path}/t", ["k"])
    t.upsert(spark.createDataFrame([], "k string, v int"), 0)
    assert t.latest() is None
    t.upsert(spark.createDataFrame([("a", 1)], "k string, v int"), 1)
    t.upsert(spark.createDataFrame([], "k string, v int"), 2)
    assert [tuple(r) for r in t.latest().collect()] == [("a", 1)] and t.batches() == [0, 1, 2]


def test_many_batches_and_a_restart_equal_the_batch_result(spark, tmp_path):
    rows = _events()
    late = rows.pop(3)  # arrives last, long after its time
    pieces = [rows[i::6] for i in range(6)]
    src, base = f"{tmp_path}/in", f"{tmp_path}/run"
    _arrive(spark, src, pieces[:4])
    ST.run_upsert(_totals(_source(spark, src)), "totals", ["user_id"], base=base)
    _arrive(spark, src, [*pieces[4:], [late]], first=4)
    got = ST.run_upsert(_totals(_source(spark, src)), "totals", ["user_id"], base=base)
    want = _totals(spark.createDataFrame([*rows, late], SCHEMA))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    table = ST.BucketTable(spark, f"{base}/table", ["user_id"])
    assert len(table.batches()) == 7 and table.states()[min(table.states())] >= 0
    # the late row touched one bucket
    assert sum(e == max(table.batches()) for e in table.states().values()) == 1


def _sessions(rows, gap=dt.timedelta(minutes=30)):
    out, open_ = [], {}
    for u, t, _ in sorted(rows, key=lambda r: r[1]):
        if u in open_ and t - open_[u][1] < gap:
            open_[u] = [open_[u][0], t, open_[u][2] + 1]
        else:
            if u in open_:
                out.append((u, *open_[u]))
            open_[u] = [t, t, 1]
    out += [(u, *x) for u, x in open_.items()]
    return sorted((u, a, b + gap, n) for u, a, b, n in out)


def test_sessions_over_split_input_equal_the_batch_sessions(spark, tmp_path):
    rows = _events(600, 12) + [(99, T0 + dt.timedelta(seconds=7 * i), 1.0) for i in range(800)]  # one hot user
    rng = random.Random(2)
    # pieces overlap in time by less than the watermark, so late rows extend and join open sessions
    rows.sort(key=lambda r: r[1] + dt.timedelta(minutes=rng.randrange(90)))
    src, base, closing = f"{tmp_path}/in", f"{tmp_path}/run", f"{tmp_path}/closing"
    size = len(rows) // 5
    _arrive(spark, src, [rows[i * size:(i + 1) * size] if i < 4 else rows[4 * size:] for i in range(5)])

    def run():
        events = ST.with_closing(_source(spark, src).select("user_id", "ts"), "ts", closing)
        out = ST.run_append(ST.session_stream(events, "user_id", "ts", 30, "2 hours"), "sessions", base)
        return sorted(map(tuple, out.where("session_start < timestamp'9000-01-01'").collect()))

    early = run()
    want = _sessions(rows)
    assert early and len(early) < len(want) and set(early) <= set(want)  # what is written is final
    ST.close_stream(spark, "ts", closing)
    assert run() == want


def test_sketches_of_batches_unite(spark, tmp_path):
    rows = _events(3000, 700)
    src = f"{tmp_path}/in"
    _arrive(spark, src, [rows[i::3] for i in range(3)])
    s = _source(spark, src).withWatermark("ts", "3 days").groupBy(F.window("ts", "1 day")).agg(F.hll_sketch_agg("user_id", 12).alias("sketch"))
    t = ST.run_upsert(s.select(F.to_date("window.start").alias("day"), "sketch"), "sketches", ["day"], base=f"{tmp_path}/run")
    users = {d: len({u for u, t, _ in rows if t.date() == d}) for d in {t.date() for _, t, _ in rows}}
    got = {r.day: r.n for r in t.select("day", F.hll_sketch_estimate("sketch").alias("n")).collect()}
    assert got.keys() == users.keys() and all(abs(got[d] - n) <= max(1, 0.065 * n) for d, n in users.items())
    both = t.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n")).first().n
    assert both == pytest.approx(len({u for u, _, _ in rows}), rel=0.065) and both < sum(users.values())
