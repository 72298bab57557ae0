"""Player analytics marts.

Shape of every mart: pre-aggregate each fact at its own grain first, then
join the (much smaller) aggregates - the same fan-out-safe order the
reference uses, and the one that keeps shuffles proportional to distinct keys
rather than raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import lit_date, years_between
from ..operators import joins, windows
from ..operators.aggs import count_if, rate

# Points per unit of each game statistic.
POINT_WEIGHTS = {
    "Assists": 0.2, "Boosts": 0.1, "Damage Dealt": 0.1, "Distance Traveled": 0.2,
    "Head Shots": 0.3, "Heals": 0.2, "Kills": 1.0, "Weapons Acquired": 0.1,
}
# Rank tiers, half-open [lower, upper).
RANK_TIERS = [
    ("Bronze", 0.0, 25944.68425), ("Silver", 25944.68425, 53514.402),
    ("Gold", 53514.402, 95115.43875), ("Platinum", 95115.43875, 149274.7655),
    ("Diamond", 149274.7655, 204122.327625), ("Elite", 204122.327625, 257617.645),
    ("Champion", 257617.645, 309498.88175), ("Unreal", 309498.88175, 999999999.0),
]
TOP_TIERS = ["Diamond", "Elite", "Champion", "Unreal"]
STAT_COLUMNS = {  # weight name -> (game event column, output column)
    "Assists": ("assists", "assists_points"), "Boosts": ("boosts", "boosts_points"),
    "Damage Dealt": ("damage_dealt", "damage_points"), "Distance Traveled": ("distance_traveled", "distance_points"),
    "Kills": ("kills", "kills_points"), "Weapons Acquired": ("weapons_acquired", "weapons_points"),
    "Head Shots": ("headshots", "headshots_points"), "Heals": ("heals", "heals_points"),
}


def _not_none(c="purchase_type"):
    return F.col(c) != F.lit("none")


# ------------------------------------------------------------------ activity
def dau(sessions: DataFrame, ts: str = "log_in") -> DataFrame:
    """MART-01 distinct users per login date.

    A single COUNT(DISTINCT) plans as aggregate on (date, user) -> aggregate on
    date, so a hot day is spread over the (date, user) exchange first.
    """
    return sessions.groupBy(F.to_date(ts).alias("active_date")).agg(
        F.countDistinct("user_id").alias("active_user_count"))


def mau(sessions: DataFrame, ts: str = "log_in") -> DataFrame:
    """MART-02 distinct users per month (month start date)."""
    return sessions.groupBy(F.trunc(F.col(ts), "month").alias("active_month")).agg(
        F.countDistinct("user_id").alias("active_user_count"))


def arpdau(dau_df: DataFrame, purch: DataFrame) -> DataFrame:
    """MART-03 revenue per daily active user (T4: arp_dau NULL on purchase-less days).

    Purchases are summed per day before the join, so the calendar join touches
    one row per day instead of every purchase.
    """
    rev = purch.groupBy(F.to_date("purchase_ts").alias("active_date")).agg(
        F.sum("purchase_amount").alias("_rev"))
    j = dau_df.join(rev, "active_date", "left")
    return j.select("active_date", F.coalesce("_rev", F.lit(0.0)).alias("total_revenue"),
                    "active_user_count",
                    F.when(F.col("active_user_count") > 0, F.col("_rev") / F.col("active_user_count"))
                    .otherwise(F.lit(0.0)).alias("arp_dau"))


def darppu(dau_df: DataFrame, purch: DataFrame) -> DataFrame:
    """MART-04 revenue per paying user per day (predicate type != 'none' in the ON)."""
    p = purch.where(_not_none()).groupBy(F.to_date("purchase_ts").alias("active_date")).agg(
        F.sum("purchase_amount").alias("_rev"), F.countDistinct("user_id").alias("_payers"))
    j = dau_df.select("active_date").join(p, "active_date", "left")
    payers = F.coalesce("_payers", F.lit(0)).cast("bigint")
    return j.select("active_date", F.coalesce("_rev", F.lit(0.0)).alias("total_revenue_from_paying_users"),
                    payers.alias("total_paying_users"),
                    F.when(payers > 0, F.col("_rev") / payers).otherwise(F.lit(0.0)).alias("darppu"))


def ad_engagement(purch: DataFrame, as_of, days: int = 30) -> DataFrame:
    """MART-05 per-user ad metrics, lifetime and last ``days`` days, in one aggregate."""
    recent = F.col("purchase_ts") >= F.date_sub(lit_date(as_of), days).cast("timestamp_ntz")
    bought = _not_none()
    tot_ads = F.count("ad_interaction_id")
    tot_p = F.count(F.when(bought, F.col("purchase_id")))
    r_ads = F.count(F.when(recent, F.col("ad_interaction_id")))
    r_p = F.count(F.when(recent & bought, F.col("purchase_id")))

    def prop(n, d):
        return F.coalesce(F.try_divide(F.nullif(n, F.lit(0)).cast("double"), F.nullif(d, F.lit(0))), F.lit(0.0))

    return purch.groupBy("user_id").agg(
        tot_ads.alias("total_ads"), tot_p.alias("total_purchases"),
        F.sum("purchase_amount").alias("total_purchases_amount"),
        prop(tot_p, tot_ads).alias("proportion_purchased"),
        F.coalesce(F.avg(F.when(bought, F.col("purchase_amount"))), F.lit(0.0)).alias("average_purchase_amount"),
        F.avg("ad_engagement_time").alias("average_ad_engagement_time"),
        r_ads.alias("total_ads_last_30_days"), r_p.alias("total_purchases_last_30_days"),
        F.sum(F.when(recent, F.col("purchase_amount"))).alias("total_purchases_amount_last_30_days"),
        prop(r_p, r_ads).alias("proportion_purchased_last_30_days"),
        F.coalesce(F.avg(F.when(recent & bought, F.col("purchase_amount"))), F.lit(0.0))
        .alias("average_purchase_amount_last_30_days"),
        F.avg(F.when(recent, F.col("ad_engagement_time"))).alias("average_ad_engagement_time_last_30_days"))


def user_activity(sess: DataFrame) -> DataFrame:
    """MART-06 sessions, minutes, active weeks (Monday weeks), ratios."""
    g = sess.groupBy("user_id").agg(
        F.count("log_in").alias("total_sessions"), F.sum("minutes").alias("total_session_duration"),
        F.countDistinct(F.date_trunc("week", "log_in")).alias("active_weeks"))
    return g.withColumns({
        "average_sessions_per_active_week": F.try_divide(F.col("total_sessions").cast("double"), F.col("active_weeks")),
        "average_session_duration": F.try_divide(F.col("total_session_duration"), F.col("total_sessions"))})


def user_spending(purch: DataFrame, k: int = 2) -> DataFrame:
    """MART-07 spender = more than k real purchases (T8); mean amount per ad."""
    return purch.groupBy("user_id").agg(
        F.count("purchase_id").alias("total_ads"),
        (F.count(F.when(_not_none(), F.col("purchase_id"))) > k).alias("is_spender"),
        F.coalesce(F.avg("purchase_amount"), F.lit(0.0)).alias("avg_purchase_amount_per_ad"))


def player_type(act: DataFrame, cut: float = 15) -> DataFrame:
    """MART-08 Hardcore when sessions per active week > cut."""
    return act.select("user_id", "total_sessions", "active_weeks",
                      F.when(F.try_divide(F.col("total_sessions").cast("double"), F.col("active_weeks")) > cut,
                             F.lit("Hardcore")).otherwise(F.lit("Casual")).alias("player_type"))


def demographics(users: DataFrame, sess: DataFrame, purch: DataFrame, tickets: DataFrame, as_of,
                 k: int = 2, cut: float = 15) -> DataFrame:
    """MART-09 12-column profile; the ticket flag is an existence join (T9)."""
    act = user_activity(sess)
    eng = player_type(act, cut).select("user_id", "player_type")
    spend = user_spending(purch, k)
    u = users.select("user_id", "first_name", "last_name", "birthdate", "gender", "location")
    j = joins.enrich(u, "user_id", eng, spend,
                     act.select("user_id", "average_sessions_per_active_week", "average_session_duration"))
    j = joins.exists_flag(j, tickets, "user_id", "has_support_ticket")
    return j.select("user_id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
                    years_between(F.col("birthdate"), lit_date(as_of)).alias("age"), "gender", "location",
                    "player_type", "average_sessions_per_active_week", "average_session_duration",
                    "total_ads", "is_spender", "avg_purchase_amount_per_ad", "has_support_ticket")


def retention(sess: DataFrame, as_of, churn_days: int = 30) -> DataFrame:
    """MART-10 first/last login, return flags, recency, churn.

    "Logged in after n days" is max over logins of datediff(first, login) >= n;
    datediff is monotone in the login time, so the max is reached at the last
    login and the reference's self join collapses to one aggregate (T7).
    """
    g = sess.groupBy("user_id").agg(F.min("log_in").alias("first_login_date"),
                                    F.max("log_in").alias("last_login_date"),
                                    F.count(F.lit(1)).alias("total_logins"))
    span = F.datediff(F.to_date("last_login_date"), F.to_date("first_login_date"))
    since = F.datediff(lit_date(as_of), F.to_date("last_login_date"))
    return g.withColumns({
        "logged_in_after_1_day": span >= 1, "logged_in_after_7_days": span >= 7,
        "logged_in_after_30_days": span >= 30,
        "logged_in_in_last_30_days": F.col("last_login_date") >= F.date_sub(lit_date(as_of), 30).cast("timestamp_ntz"),
        "days_since_last_login": since,
    }).withColumn("churned", F.when(F.col("days_since_last_login") > churn_days, F.lit(1)).otherwise(F.lit(0)))


def retained_on_day(sess: DataFrame, n: int) -> DataFrame:
    """Variant of T7: seen exactly n calendar days after the first login."""
    first = sess.groupBy("user_id").agg(F.min("log_in").alias("_f"))
    x = sess.join(first, "user_id")
    return x.groupBy("user_id").agg(
        F.bool_or(F.datediff(F.to_date("log_in"), F.to_date("_f")) == n).alias(f"retained_day_{n}"))


# ------------------------------------------------------------------ points and ranks
def points_per_event(ge: DataFrame, sess: DataFrame, weights: Mapping[str, float] = POINT_WEIGHTS) -> DataFrame:
    """MART-11 weighted stats summed per (user, session), joined to session times.

    The weights are literals folded into the projection (the reference runs one
    scalar subquery per statistic).  Session ids are strings on the game-event
    side and numbers on the session side (JOIN-16).
    """
    pts = {out: F.col(src) * F.lit(float(weights[name])) for name, (src, out) in STAT_COLUMNS.items()}
    x = ge.select("user_id", "session_id", *[v.alias(k) for k, v in pts.items()])
    total = sum((F.col(k) for k in pts), F.lit(0.0))
    g = x.groupBy("user_id", "session_id").agg(
        *[F.sum(k).alias(k.upper()) for k in pts], F.sum(total).alias("TOTAL_POINTS"))
    s = sess.select(F.col("session_id").cast("string").alias("session_id"), "log_in", "log_out",
                    F.col("minutes").alias("session_duration_minutes"))
    out = g.join(s, "session_id", "left")
    return out.select("user_id", "session_id", "log_in", "log_out", "session_duration_minutes",
                      *[k.upper() for k in pts], "TOTAL_POINTS")


def points_per_user(ppe: DataFrame) -> DataFrame:
    """MART-12 NULL-as-0 sums per user."""
    cols = [s[1].upper() for s in STAT_COLUMNS.values()]
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in cols), F.lit(0.0))
    return ppe.groupBy("user_id").agg(*[F.sum(F.coalesce(F.col(c), F.lit(0.0))).alias(c) for c in cols],
                                      F.sum(total).alias("TOTAL_POINTS"))


def tiers_frame(spark: SparkSession, tiers: Sequence[tuple] = RANK_TIERS) -> DataFrame:
    return spark.createDataFrame(list(tiers), "rank_name string, lower_bound double, upper_bound double")


def user_rankings(ppu: DataFrame, tiers: DataFrame, n_tiers: int = len(RANK_TIERS)) -> DataFrame:
    """MART-13 tier by half-open bounds + rank percentile (rank-1)/N*100 (T5)."""
    t = joins.tier_join(ppu.select("user_id", F.col("TOTAL_POINTS").alias("total_points")),
                        "total_points", tiers, n_tiers=n_tiers)
    r = windows.rank_pct(t, "total_points", "percentile")
    return r.select("user_id", "total_points", "rank_name", "percentile")


def tier_share(ranks: DataFrame, names: Sequence[str] = TOP_TIERS) -> DataFrame:
    """MART-14 percentage of players in the named tiers."""
    return ranks.agg((rate(F.col("rank_name").isin(list(names))) * 100).alias("pct_top_tiers"))


# ------------------------------------------------------------------ conversion, cohorts, churn
def conversion_by_month(purch: DataFrame) -> DataFrame:
    """MART-15 month x ad type: ads, distinct purchased, conversion rate."""
    g = purch.groupBy(F.date_format("purchase_ts", "yyyy-MM").alias("month"), "ad_type").agg(
        F.count("ad_interaction_id").alias("total_ads"),
        F.countDistinct(F.when(_not_none(), F.col("purchase_id"))).alias("purchased_ads"))
    return g.withColumn("ad_conversion_rate", F.col("purchased_ads") * 1.0 / F.col("total_ads"))


def cohort_cltv(users: DataFrame, purch: DataFrame, as_of) -> DataFrame:
    """MART-16 signup-month cohorts of consenting users.

    Purchases are summed per user first (SUM and COUNT(DISTINCT user) are
    unchanged by that), so the user join is 1:1.
    """
    per_user = purch.groupBy("user_id").agg(F.sum("purchase_amount").alias("_amt"))
    u = users.where(F.col("consent")).select("user_id", "account_creation")
    j = u.join(per_user, "user_id", "left")
    g = j.groupBy(F.date_format("account_creation", "yyyy-MM").alias("cohort_month")).agg(
        F.sum("_amt").alias("total_revenue"), F.countDistinct("user_id").alias("total_players"),
        F.min("account_creation").alias("_start"))
    months = F.months_between(lit_date(as_of), F.col("_start"))
    return g.select("cohort_month", "total_revenue", "total_players",
                    (F.col("total_revenue") / F.col("total_players")).alias("ltv"),
                    months.alias("months_active"),
                    F.try_divide(F.col("total_revenue"), F.nullif(months, F.lit(0.0))).alias("normalized_ltv"))


def count_by(users: DataFrame, c: str = "location", name: str = "country") -> DataFrame:
    """MART-17 players per country."""
    return users.groupBy(F.col(c).alias(name)).agg(F.count("user_id").alias("total_players"))


def churn_rate_daily(sess: DataFrame) -> DataFrame:
    """MART-18 active users, users not active the previous day (T1), percentage;
    the first day is dropped."""
    active = sess.select(F.to_date("log_in").alias("log_in_date"), "user_id").distinct()
    flagged = joins.with_prev_period(active, "user_id", "log_in_date", "day")
    g = flagged.groupBy("log_in_date").agg(count_if(~F.col("active_prev")).alias("churned_users"),
                                           F.count(F.lit(1)).alias("active_users"))
    g = joins.drop_first_period(g, "log_in_date")
    return g.withColumn("churn_rate_percentage",
                        F.when(F.col("active_users") > 0,
                               F.col("churned_users").cast("double") / F.col("active_users") * 100))


def churn_rate_monthly(sess: DataFrame, compat: bool = False) -> DataFrame:
    """MART-19 monthly variant.

    compat=True reproduces the reference: the previous month is joined as
    year equal and month = month + 1 (January never matches, T2) and the
    dropped "first month" is (min year, min month) taken independently (T3).
    The default uses a gap-free month index and drops the true first month.
    """
    active = sess.select(F.trunc("log_in", "month").alias("m"), "user_id").distinct()
    flagged = joins.with_prev_period(active, "user_id", "m", "month", compat=compat)
    g = flagged.groupBy("m").agg(count_if(~F.col("active_prev")).alias("churned_users"),
                                 F.count(F.lit(1)).alias("active_users"))
    g = g.select(F.year("m").alias("year"), F.month("m").alias("month"), "churned_users", "active_users", "m")
    if compat:
        mins = g.select(F.struct(F.min("year").alias("y"), F.min("month").alias("mo"))).scalar()
        g = g.where(~((F.col("year") == mins.getField("y")) & (F.col("month") == mins.getField("mo"))))
    else:
        g = joins.drop_first_period(g, "m")
    return g.drop("m").withColumn(
        "churn_rate_percentage",
        F.when(F.col("active_users") > 0, F.col("churned_users").cast("double") / F.col("active_users") * 100))


def lost_next(sess: DataFrame) -> DataFrame:
    """Users active on a day but not on the next day ("lost", the T1 counterpart)."""
    active = sess.select(F.to_date("log_in").alias("d"), "user_id").distinct()
    nxt = active.select("user_id", F.date_sub("d", 1).alias("d"), F.lit(True).alias("_next"))
    j = active.join(nxt, ["user_id", "d"], "left")
    j = j.where(F.col("d") != active.agg(F.max("d")).scalar())
    return j.groupBy(F.col("d").alias("log_in_date")).agg(count_if(F.col("_next").isNull()).alias("lost_users"),
                                                          F.count(F.lit(1)).alias("active_users"))


def flag_rates(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """MART-20 share of users holding each achievement (any row of the user)."""
    per_user = df.groupBy(key).agg(*[F.bool_or(c).alias(c) for c in cols])
    return per_user.agg(*[rate(F.col(c)).alias(f"{c}_share") for c in cols])


def ticket_stats(t: DataFrame) -> DataFrame:
    """MART-21 tickets and mean sentiment per category."""
    return t.groupBy("category").agg(F.count("case_id").alias("tickets"),
                                     F.avg("sentiment").alias("avg_sentiment"))
