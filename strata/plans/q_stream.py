"""Streaming queries (STR-01..14): each runs its stream to completion over the arriving
parquet files and returns the maintained result table; where the result of the
closed stream equals a batch mart, the batch oracle SQL checks it."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..marts import player as P
from ..operators import text as TX
from ..sources.io import scan
from ..streaming import stream as ST
from .catalog import ORACLE, register
from .roles import AS_OF_EVENTS as EV, purchases_from_events, sessions_from_events

WM = ST.WATERMARK


def _events(spark, d):
    sch = scan(spark, d, "events").schema
    return ST.stream_scan(spark, f"{d}/events*.parquet", sch)


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@register("str_scan_counts", "SELECT event_type, count(*) AS events FROM events GROUP BY 1")
def str_scan_counts(spark, d):
    """STR-01 continuous file source: running event counts per type (update mode upsert)."""
    s = _events(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    return ST.run_upsert(s, "scan_counts", ["event_type"])


@register("str_ad_engagement", ORACLE["mart_ad_engagement"])
def str_ad_engagement(spark, d):
    """STR-02 running per-user ad metrics (update mode; ratios at read time) = AD_ENGAGEMENT."""
    s = ST.ad_engagement_stream(purchases_from_events(_events(spark, d)), EV)
    return ST.finish_ad_engagement(ST.run_upsert(s, "ad_engagement", ["user_id"]))


def _points_stream(spark, d):
    li_sch = scan(spark, d, "lineitem").schema
    li = ST.stream_scan(spark, f"{d}/lineitem*.parquet", li_sch, ts=None)
    o = scan(spark, d, "orders").select("o_orderkey", "o_custkey")
    ge = li.join(o, li.l_orderkey == o.o_orderkey).select(          # STR-11 stream-static join
        F.col("o_custkey").alias("user_id"), F.col("l_orderkey").cast("string").alias("session_id"),
        F.col("l_linenumber").alias("kills"), F.col("l_quantity").alias("assists"),
        (F.col("l_extendedprice") / 100).alias("damage_dealt"), (F.col("l_tax") * 100).alias("distance_traveled"),
        (F.col("l_discount") * 100).alias("headshots"), (F.col("l_quantity") % 10).alias("heals"),
        (F.col("l_linenumber") % 5).alias("boosts"), (F.col("l_linenumber") % 6).alias("weapons_acquired"))
    pts = {out: F.col(src) * F.lit(float(P.POINT_WEIGHTS[name])) for name, (src, out) in P.STAT_COLUMNS.items()}
    x = ge.select("user_id", "session_id", *[v.alias(k) for k, v in pts.items()])
    total = sum((F.col(k) for k in pts), F.lit(0.0))
    return x.groupBy("user_id", "session_id").agg(*[F.sum(k).alias(k.upper()) for k in pts], F.sum(total).alias("TOTAL_POINTS"))


@register("str_points_per_user", ORACLE["mart_points_per_user"])
def str_points_per_user(spark, d):
    """STR-03 points per (user, session) maintained by the stream, rolled up per user at read time."""
    t = ST.run_upsert(_points_stream(spark, d), "points", ["user_id", "session_id"])
    return P.points_per_user(t)


@register("str_rankings", ORACLE["mart_user_rankings"])
def str_rankings(spark, d):
    """STR-04 rank refresh after every micro-batch (foreachBatch), over the maintained totals."""
    base = ST.scratch(spark, "rankings")
    state = {}

    def refresh(tbl, epoch):
        r = P.user_rankings(P.points_per_user(tbl.latest()), P.tiers_frame(spark))
        path = os.path.join(base, f"r{epoch:06d}")
        r.write.mode("overwrite").parquet(path)
        state["latest"] = path

    ST.run_upsert(_points_stream(spark, d), "points_rank", ["user_id", "session_id"], after=refresh)
    return spark.read.parquet(state["latest"])


@register("str_dau", ORACLE["mart_dau"])
def str_dau(spark, d):
    """STR-05 exact DAU: the stream keeps distinct (day, user) state; the count per day is read
    from it (COUNT DISTINCT is not a streaming aggregate)."""
    # a day as a window keeps the event-time marker, so the watermark drops the state of past days
    s = _events(spark, d).withWatermark("ts", WM).groupBy(F.window("ts", "1 day"), "user_id").agg(F.count(F.lit(1)).alias("_n"))
    s = s.select(F.to_date("window.start").alias("active_date"), "user_id")
    t = ST.run_upsert(s, "dau_pairs", ["active_date", "user_id"])
    return t.groupBy("active_date").agg(F.count(F.lit(1)).alias("active_user_count"))


@register("str_dau_approx", "WITH e AS (SELECT CAST(ts AS DATE) AS active_date, count(DISTINCT user_id) AS exact_users FROM events GROUP BY 1), "
          "w AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS active_date, count(DISTINCT user_id) AS exact_users FROM events GROUP BY 1) "
          "SELECT 'day' AS grain, active_date, exact_users, true AS within_bound FROM e UNION ALL SELECT 'week', active_date, exact_users, true FROM w")
def str_dau_approx(spark, d):
    """STR-06 approximate distinct users with mergeable sketches: the stream keeps one HLL sketch a day, stored as
    bytes; days and weeks (united sketches, no second look at the events) are estimated at read time and held
    against the exact counts: off by at most four standard errors (1.04 / sqrt(2^lgK)) or by one user."""
    lg_k = 12
    s = _events(spark, d).withWatermark("ts", WM).groupBy(F.window("ts", "1 day")).agg(F.hll_sketch_agg("user_id", lg_k).alias("sketch"))
    t = ST.run_upsert(s.select(F.to_date("window.start").alias("day"), "sketch"), "dau_sketches", ["day"])
    bound, out = 4 * 1.04 / 2 ** (lg_k / 2), None
    for grain in ("day", "week"):
        to = F.date_trunc(grain, F.col("day")).cast("date").alias("active_date")
        near = t.groupBy(to).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
        exact = scan(spark, d, "events").groupBy(F.date_trunc(grain, F.col("ts")).cast("date").alias("active_date")).agg(
            F.countDistinct("user_id").alias("exact_users"))
        x = exact.join(near, "active_date", "left").select(
            F.lit(grain).alias("grain"), "active_date", "exact_users",
            F.coalesce(F.abs(F.col("estimate") - F.col("exact_users")) <= F.greatest(F.lit(1.0), bound * F.col("exact_users")), F.lit(False)).alias("within_bound"))
        out = x if out is None else out.unionByName(x)
    return out


@register("str_last_30d", "WITH p AS (SELECT CAST(ts AS DATE) AS d, CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS amt, "
          "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_p FROM events), "
          "w AS (SELECT CAST(d - CAST(k AS INTEGER) AS TIMESTAMP) AS window_start, amt, is_p FROM p, range(0, 30) r(k)) "
          "SELECT window_start, window_start + INTERVAL 30 DAY AS window_end, sum(amt) AS revenue_30d, "
          "sum(is_p) AS purchases_30d FROM w GROUP BY 1", dbl="revenue_30d", big="purchases_30d")
def str_last_30d(spark, d):
    """STR-07 trailing 30-day revenue and purchases, sliding 30-day windows every day."""
    p = purchases_from_events(_events(spark, d)).withWatermark("purchase_ts", WM)
    s = p.groupBy(F.window("purchase_ts", "30 days", "1 day")).agg(
        F.sum("purchase_amount").alias("revenue_30d"), F.count(F.when(F.col("purchase_type") != "none", 1)).alias("purchases_30d"))
    t = ST.run_upsert(s.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                               "revenue_30d", "purchases_30d"), "last_30d", ["window_start"])
    return _ntz(t, "window_start", "window_end")


@register("str_retention", ORACLE["mart_retention"])
def str_retention(spark, d):
    """STR-08 retention state per user (min / max / count) maintained by the stream; flags at read time."""
    s = sessions_from_events(_events(spark, d)).groupBy("user_id").agg(
        F.min("log_in").alias("first_login_date"), F.max("log_in").alias("last_login_date"),
        F.count(F.lit(1)).alias("total_logins"))
    t = _ntz(ST.run_upsert(s, "retention", ["user_id"]), "first_login_date", "last_login_date")
    return P.retention(t.select("user_id", F.explode(F.array("first_login_date", "last_login_date")).alias("log_in"),
                                "total_logins"), EV) \
        .drop("total_logins").join(t.select("user_id", "total_logins"), "user_id") \
        .select("user_id", "first_login_date", "last_login_date", "total_logins", "logged_in_after_1_day",
                "logged_in_after_7_days", "logged_in_after_30_days", "logged_in_in_last_30_days",
                "days_since_last_login", "churned")


@register("str_sessions", "WITH e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL "
          "OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new_s FROM events), "
          "s AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e) "
          "SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events FROM s GROUP BY user_id, sid")
def str_sessions(spark, d):
    """STR-09 login -> session reconstruction with a 30-minute gap: session windows in append mode.

    A session is final once the watermark has passed its end.  The input ends here, so after the last
    event a closing row goes in and a second run from the same checkpoint writes the sessions still open."""
    base = ST.scratch(spark, "sessions")
    closing = os.path.join(base, "closing")
    for last in (False, True):
        if last:
            ST.close_stream(spark, "ts", closing)
        events = ST.with_closing(_events(spark, d).select("user_id", "ts"), "ts", closing)
        out = ST.run_append(ST.session_stream(events, "user_id", "ts", 30, WM), "sessions", base)
    return _ntz(out.where("session_start < timestamp'9000-01-01'"), "session_start", "session_end")


@register("str_enrich_documents", ORACLE["txt_classify_documents"])
def str_enrich_documents(spark, d):
    """STR-10 stateless enrichment of arriving documents: redact, classify, sentiment (append)."""
    sch = scan(spark, d, "documents").schema
    s = ST.stream_scan(spark, f"{d}/documents*.parquet", sch, ts=None).select("doc_id", "text")
    s = TX.sentiment(TX.classify_rules(TX.redact(s, "text"), "text"), "text").drop("text")
    return ST.run_append(s, "enrich")


@register("str_lookup_nation", "SELECT n.n_name AS country, count(*) AS events FROM events e JOIN customer c ON e.user_id = c.c_custkey "
          "JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1")
def str_lookup_nation(spark, d):
    """STR-11 event stream joined to static dimensions (customer -> nation), counts per country."""
    c = scan(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = scan(spark, d, "nation").select("n_nationkey", "n_name")
    s = _events(spark, d).join(c, F.col("user_id") == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey) \
        .groupBy(F.col("n_name").alias("country")).agg(F.count(F.lit(1)).alias("events"))
    return ST.run_upsert(s, "lookup", ["country"])


@register("str_click_to_purchase", "SELECT c.event_id AS click_id, p.event_id AS purchase_id, c.user_id FROM events c JOIN events p "
          "ON c.user_id = p.user_id AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 1 HOUR "
          "WHERE c.event_type = 'click' AND p.event_type = 'purchase'")
def str_click_to_purchase(spark, d):
    """STR-12 stream-stream join: clicks followed by a purchase of the same user within one hour
    (both sides watermarked, time-bounded join state)."""
    e1, e2 = _events(spark, d), _events(spark, d)
    c = e1.where(F.col("event_type") == "click").select(F.col("event_id").alias("click_id"), F.col("user_id").alias("c_user"),
                                                        F.col("ts").alias("c_ts")).withWatermark("c_ts", WM)
    p = e2.where(F.col("event_type") == "purchase").select(F.col("event_id").alias("purchase_id"), F.col("user_id").alias("p_user"),
                                                           F.col("ts").alias("p_ts")).withWatermark("p_ts", WM)
    j = c.join(p, (F.col("c_user") == F.col("p_user")) & (F.col("p_ts") >= F.col("c_ts"))
               & (F.col("p_ts") <= F.col("c_ts") + F.expr("INTERVAL 1 HOUR")))
    out = ST.run_append(j.select("click_id", "purchase_id", F.col("c_user").alias("user_id")), "click_purchase")
    return out


@register("str_dedupe", "SELECT event_type, count(DISTINCT event_id) AS events FROM events GROUP BY 1")
def str_dedupe(spark, d):
    """STR-13 duplicate delivery removal: the same files arrive on two sources, rows are
    de-duplicated by event id within the watermark."""
    u = _events(spark, d).unionByName(_events(spark, d)).withWatermark("ts", WM).dropDuplicatesWithinWatermark(["event_id"])
    out = ST.run_append(u.select("event_id", "event_type"), "dedupe")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@register("str_monitor_daily", "WITH x AS (SELECT floor((1 - exp(-d.n_chars / 3000.0)) * 10000 + 0.5) / 10000 AS score, "
          f"DATE '{EV}' - 28 + CAST(('0x' || substr(md5(concat_ws('|', l.doc_id, 'mon')), 1, 8))::BIGINT % 28 AS INTEGER) AS pred_date "
          "FROM labels l JOIN documents d ON l.doc_id = d.doc_id) SELECT pred_date AS day, count(*) AS predictions, avg(score) AS mean_score, "
          "avg(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END) AS share_class1 FROM x GROUP BY 1", dbl="mean_score share_class1")
def str_monitor_daily(spark, d):
    """STR-14 daily monitor window over arriving predictions (1-day tumbling windows)."""
    from ..functions import keyed as K
    sch = scan(spark, d, "labels").schema
    lab = ST.stream_scan(spark, f"{d}/labels*.parquet", sch, ts=None)
    doc = scan(spark, d, "documents").select("doc_id", "n_chars")
    x = lab.join(doc, "doc_id").select(
        (F.floor((1 - F.exp(-F.col("n_chars") / 3000.0)) * 10000 + 0.5) / 10000).alias("score"),
        F.date_add(F.date_sub(F.lit(EV).cast("date"), 28), F.pmod(K.hash32("doc_id", "mon"), F.lit(28)).cast("int")).alias("day"))
    # the calendar day is the 1-day tumbling window (independent of the session time zone)
    s = x.groupBy("day").agg(
        F.count(F.lit(1)).alias("predictions"), F.avg("score").alias("mean_score"),
        F.avg(F.when(F.col("score") >= 0.5, 1.0).otherwise(0.0)).alias("share_class1"))
    t = ST.run_upsert(s, "monitor", ["day"])
    return t
