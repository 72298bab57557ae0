"""Semantics traps of SURVEY §0 on tiny inline frames (FIXTURES §7)."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions import expr as X
from strata.marts import player as P
from strata.marts import spa as S
from strata.operators import sets as SE
from strata.operators import windows as W


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_t1_t2_t3_monthly_churn_compat_vs_corrected(spark):
    rows = [(1, ts("2023-12-10 10:00:00")), (1, ts("2024-01-05 10:00:00")), (2, ts("2024-01-06 10:00:00")),
            (3, ts("2023-11-03 10:00:00"))]
    sess = spark.createDataFrame(rows, "user_id long, log_in timestamp_ntz")
    compat = {(r.year, r.month): r.churned_users for r in P.churn_rate_monthly(sess, compat=True).collect()}
    fixed = {(r.year, r.month): r.churned_users for r in P.churn_rate_monthly(sess, compat=False).collect()}
    assert compat[(2024, 1)] == 2            # January never links to December (T2)
    assert fixed[(2024, 1)] == 1             # only user 2 is new in January
    # T3: the independent minima are (2023, 1), which does not exist, so no month is dropped
    assert (2023, 11) in compat and (2023, 11) not in fixed


def test_t4_arpdau_null_when_no_purchase(spark):
    sess = spark.createDataFrame([(u, ts("2024-01-02 08:00:00")) for u in (1, 2, 3)], "user_id long, log_in timestamp_ntz")
    purch = spark.createDataFrame([(1, 5.0, "in_app", ts("2024-01-03 08:00:00"))],
                                  "user_id long, purchase_amount double, purchase_type string, purchase_ts timestamp_ntz")
    a = P.arpdau(P.dau(sess), purch).collect()[0]
    assert a.total_revenue == 0.0 and a.arp_dau is None and a.active_user_count == 3
    d = P.darppu(P.dau(sess), purch).collect()[0]
    assert d.darppu == 0.0 and d.total_paying_users == 0


def test_t5_rank_percentile(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 5.0)], "user_id long, v double")
    got = {r.user_id: round(r.p, 2) for r in W.rank_pct(df, "v", "p").collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 66.67}


def test_t6_assert_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    r = SE.assert_unique(df, ["k"]).collect()
    assert len(r) == 1 and r[0].k == 1 and r[0].n_rows == 2


def test_t7_logged_in_after_vs_retained_on_day(spark):
    sess = spark.createDataFrame([(1, ts("2024-01-01 10:00:00")), (1, ts("2024-02-10 10:00:00"))],
                                 "user_id long, log_in timestamp_ntz")
    r = P.retention(sess, "2024-03-01").collect()[0]
    assert r.logged_in_after_1_day and r.logged_in_after_7_days and r.logged_in_after_30_days
    assert P.retained_on_day(sess, 1).collect()[0].retained_day_1 is False


def test_t8_spender_threshold(spark):
    rows = [(1, i, 1.0, "in_app") for i in range(2)] + [(2, 10 + i, 1.0, "in_app") for i in range(3)]
    p = spark.createDataFrame(rows, "user_id long, purchase_id long, purchase_amount double, purchase_type string")
    got = {r.user_id: r.is_spender for r in P.user_spending(p).collect()}
    assert got == {1: False, 2: True}


def test_t9_ticket_flag_does_not_fan_out(spark):
    from strata.operators.joins import exists_flag
    u = spark.createDataFrame([(1,), (2,)], "user_id long")
    t = spark.createDataFrame([(1,), (1,)], "user_id long")
    got = {r.user_id: r.has_ticket for r in exists_flag(u, t, "user_id", "has_ticket").collect()}
    assert got == {1: True, 2: False}


def test_t14_understaffed_city_without_providers(spark):
    fc = spark.createDataFrame([("2024-02-05", "Nowhere", "view", 5.0)], "ts string, location_city string, service_category string, forecast double") \
        .withColumn("ts", F.to_date("ts"))
    prov = spark.createDataFrame([(1, "p", "Austin", "view", 8, 50)],
                                 "provider_id long, provider_name string, location_city string, skill_categories string, max_daily_hours int, hourly_rate int")
    r = S.recommend_schedule(fc, prov, S.availability(prov), "2024-02-01", "2024-02-10").collect()[0]
    assert (r.available_providers, r.recommended_staff, r.staffing_status, r.gap) == (0, 2, "Understaffed", -2)


def test_t15_zero_fill(spark):
    from strata.operators.forecast import zero_fill
    s = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 1, 3), 2.0), ("b", dt.date(2024, 1, 2), 4.0)],
                              "k string, ts date, y double")
    z = zero_fill(s, ["k"], "ts", "y")
    assert z.count() == 6 and z.where("k = 'a' AND ts = '2024-01-02'").first().y == 0.0


def test_tier_lower_bound_inclusive(spark):
    df = spark.createDataFrame([(1, 25944.68425)], "user_id long, TOTAL_POINTS double")
    assert P.user_rankings(df, P.tiers_frame(spark)).first().rank_name == "Silver"


def test_day_and_year_boundaries(spark):
    df = spark.createDataFrame([(ts("2024-01-01 23:00:00"), ts("2024-01-02 01:00:00"), dt.date(2000, 12, 31), dt.date(2001, 1, 1))],
                               "a timestamp_ntz, b timestamp_ntz, c date, d date")
    r = df.select(X.days_between("a", "b").alias("dd"), X.years_between("c", "d").alias("yy")).first()
    assert (r.dd, r.yy) == (1, 1)


def test_array_pick_past_end_and_strict_greatest(spark):
    df = spark.createDataFrame([(5, 1, None)], "i int, a int, b int")
    r = df.select(X.pick_index(["x", "y"], "i").alias("p"), X.greatest_strict("a", "b").alias("g")).first()
    assert r.p is None and r.g is None


def test_div0_and_dow(spark):
    df = spark.createDataFrame([(1.0, 0.0, dt.date(2024, 1, 7))], "n double, d double, day date")  # a Sunday
    r = df.select(X.div0("n", "d").alias("z"), X.dow_sun0("day").alias("w"), X.dow_iso("day").alias("iso")).first()
    assert (r.z, r.w, r.iso) == (0.0, 0, 7)
