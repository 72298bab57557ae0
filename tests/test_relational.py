"""Range join, ranks, forecasts, new/repeat counts, ingest, type changes and refreshes against definitions."""

import datetime as dt
import math
import os
import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import aggs as A
from strata.operators import forecast as FC
from strata.operators import joins as J
from strata.operators import windows as W
from strata.plans.refresh import Derived, refresh
from strata.sources import io

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- range join


def _points(kind, rng):
    n = 1500
    if kind == "hot":
        return [5.0 if rng.random() < 0.5 else rng.uniform(0, 100) for _ in range(n)] + [None, None]
    return [rng.paretovariate(1) if kind == "skewed" else float(rng.randrange(60)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["hot", "skewed", "ties"])
def test_range_join_equals_all_pairs(spark, kind):
    rng = random.Random(kind)
    xs = list(enumerate(_points(kind, rng)))
    iv = [(i, *sorted((rng.uniform(0, 60), rng.uniform(0, 60)))) for i in range(60)]
    iv += [(100, -1e9, 1e9), (101, 5.0, 5.0), (102, 7.0, 3.0), (103, None, 4.0), (104, 5.0, math.nextafter(5.0, 9)), (105, 200.0, 300.0)]
    iv += [(200 + i, float(i), float(i + 1)) for i in range(20)] + [(100, -1e9, 1e9)]  # a repeated row
    a, b = spark.createDataFrame(xs, "pid long, x double"), spark.createDataFrame(iv, "iid long, lo double, hi double")
    got = Counter((r.pid, r.iid) for r in J.range_join(a, "x", b, "lo", "hi").collect())
    want = Counter((p, i) for p, x in xs if x is not None for i, lo, hi in iv if lo is not None and lo <= x < hi)
    assert got == want
    left = J.range_join(a, "x", b.where("iid = 104"), "lo", "hi", how="left", key="pid").collect()
    assert Counter(r.pid for r in left) == Counter(p for p, _ in xs)
    assert {r.pid for r in left if r.iid is not None} == {p for p, x in xs if x == 5.0}


@pytest.mark.parametrize("kind", ["hot", "skewed", "ties"])
def test_range_join_counts_are_those_of_all_pairs(spark, kind):
    rng = random.Random(kind)
    a = spark.createDataFrame([(i, x, i if i % 3 else None) for i, x in enumerate(_points(kind, rng))], "pid long, x double, v long")
    iv = [(i % 50, *sorted((rng.uniform(0, 60), rng.uniform(0, 60)))) for i in range(60)]
    iv += [(100, -1e9, 1e9), (101, 5.0, 5.0), (None, 5.0, math.nextafter(5.0, 9)), (105, 200.0, 300.0), (100, -1e9, 1e9)]
    b = spark.createDataFrame(iv, "iid long, lo double, hi double")
    want = J.range_join(a, "x", b, "lo", "hi").groupBy("iid").agg(F.count("v").alias("n"), F.count("pid").alias("m")).collect()
    x = J.range_join(a, "x", b, "lo", "hi", count={"n": "v", "m": "pid"})
    assert x.count() <= 3 * len(iv)  # never a row a pair
    got = x.groupBy("iid").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in want} and len(got) == len(want)


def test_range_join_of_dates_and_of_nothing(spark):
    days = spark.range(40).select(F.col("id").alias("pid"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    iv = spark.sql("SELECT 1L AS iid, date'2024-01-05' AS lo, date'2024-01-08' AS hi")
    assert {r.pid for r in J.range_join(days, "d", iv, "lo", "hi").collect()} == {4, 5, 6}
    assert J.range_join(days.where("pid < 0"), "d", iv, "lo", "hi").collect() == []
    assert J.range_join(days, "d", iv.where("iid > 1"), "lo", "hi").collect() == []


def test_a_long_interval_is_one_row_a_slot(spark):
    pts = spark.range(5000).select(F.col("id").alias("pid"), F.col("id").cast("double").alias("x"))
    iv = spark.createDataFrame([(1, -1e15, 1e15)], "iid long, lo double, hi double")
    cuts = W.quantile_cuts(pts.select("x"), "x", 8)
    assert len(cuts) == 7
    assert J.range_join(pts, "x", iv, "lo", "hi").count() == 5000


# --- ranks


@pytest.mark.parametrize("down", [True, False])
def test_rank_with_a_value_on_half_of_the_rows(spark, down):
    df = spark.range(0, 6000).select("id", F.when(F.col("id") % 2 == 0, F.lit(500)).when(F.col("id") % 31 == 0, F.lit(None)).otherwise((F.col("id") * 37) % 1999).alias("v"))
    order = F.col("v").desc_nulls_last() if down else F.col("v").asc_nulls_last()
    want = {r.id: r.w for r in df.withColumn("w", F.rank().over(Window.orderBy(order))).collect()}
    out = W.rank_distributed(df, "v", descending=down, with_total="n")
    got = out.collect()
    assert {r.id: r["rank"] for r in got} == want and {r.n for r in got} == {6000}
    # the half is in no sort and in no join on the value: only broadcast slot offsets are joined
    assert "SortMergeJoin" not in _plan(out)


def test_rank_runs_its_input_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(len(b))
            yield b

    df = spark.range(1000).withColumn("v", F.col("id") % 7).mapInPandas(count, "id long, v long")
    assert W.rank_pct(df, "v").count() == 1000 and runs.value == 1000


def test_slots_are_found_by_value(spark):
    cuts = [1.0, 2.5, 7.0]
    df = spark.createDataFrame([(x,) for x in (None, 0.0, 1.0, 2.0, 2.5, 3.0, 7.0, 8.0)], "v double")
    assert [r.s for r in df.select(W.slot_of(F.col("v"), cuts).alias("s")).collect()] == [None, 0, 1, 2, 3, 4, 5, 6]
    assert W.quantile_cuts(df.where("v > 99"), "v", 8) == []


# --- forecasts


def _series(spark, seed=1, days=40):
    rng = random.Random(seed)
    rows = [(k, dt.date(2024, 1, 3) + dt.timedelta(i), float(rng.randrange(1, 30) + i * (k == "a"))) for k in ("a", "b", "c") for i in range(days)
            if rng.random() < 0.6 or (k, i) in {("a", 0), ("b", days - 1)}]
    rows.append(("one", dt.date(2024, 1, 10), 7.0))
    return rows, spark.createDataFrame(rows, "k string, ts date, y double")


def _fit(ys):
    """Least squares by definition over a zero-filled list of (t, weekday, y)."""
    n, mt, my = len(ys), statistics.fmean(t for t, _, _ in ys), statistics.fmean(y for _, _, y in ys)
    var = sum((t - mt) ** 2 for t, _, _ in ys)
    b = sum((t - mt) * (y - my) for t, _, y in ys) / var if var else 0.0
    a = my - b * mt if var else 0.0
    res = defaultdict(list)
    for t, w, y in ys:
        res[w].append(y - a - b * t)
    eff = {w: statistics.fmean(r) for w, r in res.items()}
    left = [x - eff[w] for w, r in res.items() for x in r]
    return a, b, eff, math.sqrt(sum((x - statistics.fmean(left)) ** 2 for x in left) / (n - 1)) if n > 1 else 0.0


def _filled(rows, k, first, last):
    have = {d: y for key, d, y in rows if key == k}
    return [((d - first).days, d.isoweekday() % 7, have.get(d, 0.0)) for d in (first + dt.timedelta(i) for i in range((last - first).days + 1))]


@pytest.mark.parametrize("days", [1, 2, 9, 40])
def test_forecast_equals_least_squares(spark, days):
    rows, df = _series(spark, days=days)
    rows = [r for r in rows if days > 7 or r[0] != "one"]
    df = df if days > 7 else df.where("k != 'one'")
    first, last = min(r[1] for r in rows), max(r[1] for r in rows)
    got = {(r.k, r.ts): (r.forecast, r.lower_bound, r.upper_bound) for r in FC.forecast(df, ["k"], "ts", "y", h=10, floor_zero=False).collect()}
    assert len(got) == 10 * len({r[0] for r in rows})
    for (k, d), (f, lo, hi) in got.items():
        a, b, eff, sd = _fit(_filled(rows, k, first, last))
        y = a + b * (d - first).days + eff.get(d.isoweekday() % 7, 0.0)
        assert (f, lo, hi) == pytest.approx((y, y - 1.96 * sd, y + 1.96 * sd), abs=1e-6)


def test_backtest_equals_refitting_each_fold(spark):
    rows, df = _series(spark, 5)
    first, last = min(r[1] for r in rows), max(r[1] for r in rows)
    got = {r.k: r for r in FC.backtest(df, ["k"], "ts", "y", h=7, folds=9).collect()}  # the last folds have nothing to fit on
    for k in {r[0] for r in rows}:
        err, ape = [], []
        for f in range(1, 10):
            cut = last - dt.timedelta(7 * f)
            if cut < first:
                continue
            a, b, eff, _ = _fit(_filled(rows, k, first, cut))
            for t, w, y in _filled(rows, k, first, cut + dt.timedelta(7))[-7:]:
                e = max(a + b * t + eff.get(w, 0.0), 0.0) - y
                err.append(e)
                ape += [abs(e) / y] if y else []
        assert got[k].n_scored == len(err) == 35
        assert (got[k].mae, got[k].rmse) == pytest.approx((statistics.fmean(map(abs, err)), math.sqrt(statistics.fmean(e * e for e in err))), abs=1e-6)
        assert got[k].mape == (pytest.approx(statistics.fmean(ape)) if ape else None)


def test_seasonal_naive_averages_weekdays(spark):
    rows, df = _series(spark, 6)
    first, last = min(r[1] for r in rows), max(r[1] for r in rows)
    for r in FC.seasonal_naive(df, ["k"], "ts", "y", h=9, weeks=3).collect():
        own = [y for _, w, y in _filled(rows, r.k, first, last)[-21:] if w == r.ts.isoweekday() % 7]
        assert r.forecast == pytest.approx(statistics.fmean(own))


def test_weekday_calendar_counts_days():
    for first in (dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(7)):
        for span in (0, 1, 6, 7, 23):
            ts = [(t, (first + dt.timedelta(t)).isoweekday() % 7) for t in range(span + 1)]
            want = [tuple(sum(t ** p for t, w in ts if w == v) for p in range(3)) for v in range(7)]
            assert FC.weekday_calendar(first, first + dt.timedelta(span)) == want


def test_events_are_read_once_for_a_forecast(spark):
    from strata.plans import q_spa
    demand = q_spa.S.daily_demand(q_spa.Roles(spark, SF_SMALL).appointments())
    assert _plan(demand).count("FileScan") == 1  # what _daily writes
    daily = q_spa._daily(spark, SF_SMALL)
    for out in (FC.forecast(daily, q_spa.KEYS, "ts", "y"), FC.backtest(daily, q_spa.KEYS, "ts", "y"), FC.seasonal_naive(daily, q_spa.KEYS, "ts", "y")):
        plan = _plan(out)
        assert "events.parquet" not in plan and plan.count("FileScan") == 1


# --- new and repeat customers


def test_new_and_repeat_in_one_pass(spark):
    rng = random.Random(9)
    rows = [(None if rng.random() < 0.05 else rng.choice([1, 1, 1, *range(2, 40)]), rng.randrange(20), rng.choice("xyz"), rng.random()) for _ in range(900)]
    df = spark.createDataFrame(rows, "c long, d int, g string, v double")
    first = {}
    for c, d, *_ in rows:
        if c is not None:
            first[c] = min(first.get(c, d), d)
    got = {r.g: r for r in A.new_repeat(df, "c", "d", ["g"], F.sum("v").alias("v"), F.count(F.lit(1)).alias("n")).collect()}
    for g in "xyz":
        own = [r for r in rows if r[2] == g]
        new = {c for c, d, *_ in own if c is not None and d == first[c]}
        every = {c for c, *_ in own if c is not None}
        assert (got[g].new_customers, got[g].repeat_customers, got[g].n) == (len(new), len(every - new), len(own))
        assert got[g].v == pytest.approx(sum(r[3] for r in own))


def test_daily_kpi_joins_the_star_once(spark):
    from strata.marts import retail
    from strata.plans.roles import Roles
    r = Roles(spark, SF_SMALL)
    plan = _plan(retail.daily_kpi(r.sales(), r.customers()))
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 1


# --- ingest, type changes, refresh


def test_csv_with_quotes_empty_fields_comments_and_defaults(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,day\n1,"Smith, Jo",2024-01-02\n2,,2024-02-03\n3,"x ""y""",\n')
    sch = io.schema([("id", "bigint", False), ("name", "string"), ("day", "date")], {"name": "full name"})
    rows = io.conform(io.read_csv(spark, f"{tmp_path}/a.csv", sch), sch)
    assert rows.schema["name"].metadata == {"comment": "full name"} and rows.schema["day"].dataType.simpleString() == "date"
    got = io.stage(io.with_defaults(rows, {"source": "csv", "year": F.year("day")}))
    assert [tuple(r) for r in got.orderBy("id").collect()] == [
        (1, "Smith, Jo", dt.date(2024, 1, 2), "csv", 2024), (2, None, dt.date(2024, 2, 3), "csv", 2024), (3, 'x "y"', None, "csv", None)]
    io.view("strata_test_view", got)
    assert spark.sql("SELECT count(*) AS n FROM strata_test_view WHERE name IS NULL").first().n == 1
    io.register_views(spark, SF_SMALL, ["nation", "region"])
    assert spark.sql("SELECT count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey").first().n == 25
    for name in ("strata_test_view", "nation", "region"):
        spark.catalog.dropTempView(name)


def _typed_table(spark, tmp_path, name, values):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.createDataFrame(list(enumerate(values)), "id long, v string").write.option("path", f"{tmp_path}/{name}").saveAsTable(name)


def test_retype_swaps_tables(spark, tmp_path):
    _typed_table(spark, tmp_path, "strata_swap", ["1", None, "-7"])
    io.retype_table(spark, "strata_swap", "v", "bigint", f"{tmp_path}/new")
    assert dict(spark.table("strata_swap").dtypes)["v"] == "bigint"
    assert sorted((r.id, r.v) for r in spark.table("strata_swap").collect()) == [(0, 1), (1, None), (2, -7)]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("strata_swap__")]
    spark.sql("DROP TABLE strata_swap")


def test_retype_keeps_the_old_table_on_failure(spark, tmp_path, monkeypatch):
    _typed_table(spark, tmp_path, "strata_keep", ["1", "x"])
    with pytest.raises(ValueError):
        io.retype_table(spark, "strata_keep", "v", "bigint", f"{tmp_path}/new")
    _typed_table(spark, tmp_path, "strata_fall", ["1", "2"])
    sql, calls = type(spark).sql, []

    def failing(self, text, *a, **k):  # the catalog is lost between the two renames
        calls.append(text)
        if "__new_" in text and text.startswith("ALTER"):
            raise RuntimeError("catalog lost")
        return sql(self, text, *a, **k)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError):
        io.retype_table(spark, "strata_fall", "v", "bigint", f"{tmp_path}/new2")
    monkeypatch.undo()
    for name, values in (("strata_keep", ["1", "x"]), ("strata_fall", ["1", "2"])):
        assert [r.v for r in spark.table(name).orderBy("id").collect()] == values
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")]
        spark.sql(f"DROP TABLE {name}")


def test_refresh_builds_only_what_is_stale(spark, tmp_path):
    for name, n in (("a", 50), ("b", 30)):
        spark.range(n).withColumn("k", F.col("id") % 5).write.parquet(f"{tmp_path}/src/{name}")

    def sources():
        return {x: spark.read.parquet(f"{tmp_path}/src/{x}") for x in "ab"}

    def graph(version="1"):
        return {"per_k": Derived(("a",), lambda i: i["a"].groupBy("k").agg(F.count(F.lit(1)).alias("n")), ("k",), 4, version),
                "other": Derived(("b",), lambda i: i["b"].agg(F.count(F.lit(1)).alias("m"))),
                "both": Derived(("per_k", "other"), lambda i: i["per_k"].crossJoin(i["other"]).agg(F.sum("n").alias("n"), F.max("m").alias("m")))}

    root = f"{tmp_path}/derived"
    one = refresh(spark, graph(), sources(), root)
    assert sorted(one.built) == ["both", "other", "per_k"] and tuple(one.tables["both"].first()) == (50, 30)
    again = refresh(spark, graph(), sources(), root)
    assert again.built == [] and tuple(again.tables["both"].first()) == (50, 30)
    # a source grows: its table and what depends on it are rebuilt, the other one isn't
    spark.range(7).withColumn("k", F.lit(9).cast("long")).write.mode("append").parquet(f"{tmp_path}/src/b")
    assert sorted((grown := refresh(spark, graph(), sources(), root)).built) == ["both", "other"] and tuple(grown.tables["both"].first()) == (50, 37)
    assert sorted(refresh(spark, graph("2"), sources(), root).built) == ["both", "per_k"]
    # another session has no entry for the clustered table: it is entered again, not rebuilt
    spark.sql("DROP TABLE " + next(t.name for t in spark.catalog.listTables() if t.name.startswith("strata_per_k")))
    back = refresh(spark, graph("2"), sources(), root)
    assert back.built == [] and "Exchange" not in _plan(back.tables["per_k"].groupBy("k").agg(F.sum("n")))
    # a folder without its marker was never finished
    done = next(p for p in os.listdir(f"{root}/other") if os.path.exists(f"{root}/other/{p}/_SUCCESS"))
    for p in os.listdir(f"{root}/other"):
        if os.path.exists(f"{root}/other/{p}/_SUCCESS"):
            os.unlink(f"{root}/other/{p}/_SUCCESS")
    assert done and "other" in refresh(spark, graph("2"), sources(), root).built


def test_vectors_without_direction_take_no_part(spark):
    from strata.operators import search as SE
    docs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [2.0, 1.0])], "id long, v array<double>")
    queries = spark.createDataFrame([(7, [1.0, 0.0]), (8, None), (9, [0.0, 0.0])], "q long, v array<double>")
    got = [(r.q, r.id, r["rank"]) for r in SE.vector_search(docs, "id", "v", queries, "q", "v", k=5).orderBy("rank").collect()]
    assert got == [(7, 1, 1), (7, 5, 2)]
