"""Player analytics queries (MART-01..21, Q-01..05) with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..marts import player as P
from .catalog import register
from .roles import AS_OF_EVENTS as EV, AS_OF_ORDERS as ORD, R, Roles

_STATS = ("assists_points", "boosts_points", "damage_points", "distance_points", "kills_points",
          "weapons_points", "headshots_points", "heals_points")
_POINT_SQL = ("assists * 0.2 AS assists_points, boosts * 0.1 AS boosts_points, damage_dealt * 0.1 AS damage_points, "
              "distance_traveled * 0.2 AS distance_points, kills * 1.0 AS kills_points, "
              "weapons_acquired * 0.1 AS weapons_points, headshots * 0.3 AS headshots_points, heals * 0.2 AS heals_points")
_PPE_SQL = (
    f"ppe AS (SELECT g.user_id, g.session_id, s.log_in, s.log_out, s.minutes AS session_duration_minutes, "
    + ", ".join(f"g.{c.upper()}" for c in _STATS) + ", g.TOTAL_POINTS FROM (SELECT user_id, session_id, "
    + ", ".join(f"sum({c}) AS {c.upper()}" for c in _STATS)
    + ", sum(" + " + ".join(_STATS) + ") AS TOTAL_POINTS FROM (SELECT user_id, session_id, "
    + _POINT_SQL + " FROM game_events) x GROUP BY user_id, session_id) g "
    "LEFT JOIN (SELECT CAST(session_id AS VARCHAR) AS session_id, log_in, log_out, minutes FROM ord_sessions) s "
    "ON g.session_id = s.session_id)")
_PPU_SQL = ("ppu AS (SELECT user_id, " + ", ".join(f"sum(coalesce({c.upper()}, 0)) AS {c.upper()}" for c in _STATS)
            + ", sum(" + " + ".join(f"coalesce({c.upper()}, 0)" for c in _STATS) + ") AS TOTAL_POINTS "
            "FROM ppe GROUP BY user_id)")
_TIERS_SQL = ("tiers AS (SELECT * FROM (VALUES ('Bronze', 0.0, 25944.68425), ('Silver', 25944.68425, 53514.402), "
              "('Gold', 53514.402, 95115.43875), ('Platinum', 95115.43875, 149274.7655), "
              "('Diamond', 149274.7655, 204122.327625), ('Elite', 204122.327625, 257617.645), "
              "('Champion', 257617.645, 309498.88175), ('Unreal', 309498.88175, 999999999.0)) "
              "t(rank_name, lower_bound, upper_bound))")
_RANK_SQL = ("ranks AS (SELECT p.user_id, p.TOTAL_POINTS AS total_points, t.rank_name, "
             "(rank() OVER (ORDER BY p.TOTAL_POINTS DESC) - 1) / CAST(count(*) OVER () AS DOUBLE) * 100 AS percentile "
             "FROM ppu p LEFT JOIN tiers t ON p.TOTAL_POINTS >= t.lower_bound AND p.TOTAL_POINTS < t.upper_bound)")
_DAU_SQL = "dau AS (SELECT CAST(log_in AS DATE) AS active_date, count(DISTINCT user_id) AS active_user_count FROM ev_sessions GROUP BY 1)"


@register("mart_dau", f"WITH {R('ev_sessions')}, {_DAU_SQL} SELECT * FROM dau")
def mart_dau(spark, d):
    """MART-01 daily active users."""
    return P.dau(Roles(spark, d).ev_sessions())


@register("mart_mau", f"WITH {R('ord_sessions')} SELECT CAST(date_trunc('month', log_in) AS DATE) AS active_month, "
          "count(DISTINCT user_id) AS active_user_count FROM ord_sessions GROUP BY 1")
def mart_mau(spark, d):
    """MART-02 monthly active users (orders as logins: 80 months)."""
    return P.mau(Roles(spark, d).ord_sessions())


@register("mart_arpdau", f"WITH {R('ev_sessions', 'ev_purchases')}, {_DAU_SQL} "
          "SELECT dau.active_date, coalesce(sum(p.purchase_amount), 0) AS total_revenue, dau.active_user_count, "
          "CASE WHEN dau.active_user_count > 0 THEN sum(p.purchase_amount) / dau.active_user_count ELSE 0 END AS arp_dau "
          "FROM dau LEFT JOIN ev_purchases p ON CAST(p.purchase_ts AS DATE) = dau.active_date "
          "GROUP BY dau.active_date, dau.active_user_count", dbl="total_revenue arp_dau")
def mart_arpdau(spark, d):
    """MART-03 ARPDAU (flagship): DAU -> revenue per daily active user."""
    r = Roles(spark, d)
    return P.arpdau(P.dau(r.ev_sessions()), r.ev_purchases())


@register("mart_darppu", f"WITH {R('ev_sessions', 'ev_purchases')}, {_DAU_SQL} "
          "SELECT dau.active_date, coalesce(sum(p.purchase_amount), 0) AS total_revenue_from_paying_users, "
          "count(DISTINCT p.user_id) AS total_paying_users, "
          "CASE WHEN count(DISTINCT p.user_id) > 0 THEN sum(p.purchase_amount) / count(DISTINCT p.user_id) ELSE 0 END AS darppu "
          "FROM dau LEFT JOIN ev_purchases p ON CAST(p.purchase_ts AS DATE) = dau.active_date AND p.purchase_type != 'none' "
          "GROUP BY dau.active_date", dbl="total_revenue_from_paying_users darppu")
def mart_darppu(spark, d):
    """MART-04 DARPPU."""
    r = Roles(spark, d)
    return P.darppu(P.dau(r.ev_sessions()), r.ev_purchases())


_R30 = f"purchase_ts >= CAST(DATE '{EV}' - INTERVAL 30 DAY AS TIMESTAMP)"


@register("mart_ad_engagement", f"WITH {R('ev_purchases')} SELECT user_id, count(ad_interaction_id) AS total_ads, "
          "count(CASE WHEN purchase_type != 'none' THEN purchase_id END) AS total_purchases, "
          "sum(purchase_amount) AS total_purchases_amount, "
          "coalesce(nullif(count(CASE WHEN purchase_type != 'none' THEN purchase_id END), 0) / nullif(count(ad_interaction_id), 0), 0) AS proportion_purchased, "
          "coalesce(avg(CASE WHEN purchase_type != 'none' THEN purchase_amount END), 0) AS average_purchase_amount, "
          "avg(ad_engagement_time) AS average_ad_engagement_time, "
          f"count(CASE WHEN {_R30} THEN ad_interaction_id END) AS total_ads_last_30_days, "
          f"count(CASE WHEN {_R30} AND purchase_type != 'none' THEN purchase_id END) AS total_purchases_last_30_days, "
          f"sum(CASE WHEN {_R30} THEN purchase_amount END) AS total_purchases_amount_last_30_days, "
          f"coalesce(nullif(count(CASE WHEN {_R30} AND purchase_type != 'none' THEN purchase_id END), 0) / "
          f"nullif(count(CASE WHEN {_R30} THEN ad_interaction_id END), 0), 0) AS proportion_purchased_last_30_days, "
          f"coalesce(avg(CASE WHEN {_R30} AND purchase_type != 'none' THEN purchase_amount END), 0) AS average_purchase_amount_last_30_days, "
          f"avg(CASE WHEN {_R30} THEN ad_engagement_time END) AS average_ad_engagement_time_last_30_days "
          "FROM ev_purchases GROUP BY user_id",
          dbl="total_purchases_amount proportion_purchased average_purchase_amount average_ad_engagement_time "
              "total_purchases_amount_last_30_days proportion_purchased_last_30_days "
              "average_purchase_amount_last_30_days average_ad_engagement_time_last_30_days")
def mart_ad_engagement(spark, d):
    """MART-05 AD_ENGAGEMENT, as_of 2024-01-31."""
    return P.ad_engagement(Roles(spark, d).ev_purchases(), EV)


_ACT_SQL = ("act AS (SELECT user_id, count(log_in) AS total_sessions, sum(minutes) AS total_session_duration, "
            "count(DISTINCT date_trunc('week', log_in)) AS active_weeks FROM ord_sessions GROUP BY user_id)")


@register("mart_user_activity", f"WITH {R('ord_sessions')}, {_ACT_SQL} SELECT *, "
          "total_sessions / active_weeks AS average_sessions_per_active_week, "
          "total_session_duration / total_sessions AS average_session_duration FROM act",
          dbl="total_session_duration average_sessions_per_active_week average_session_duration")
def mart_user_activity(spark, d):
    """MART-06 sessions / minutes / active weeks per user."""
    return P.user_activity(Roles(spark, d).ord_sessions())


@register("mart_user_spending", f"WITH {R('ord_purchases')} SELECT user_id, count(purchase_id) AS total_ads, "
          "count(CASE WHEN purchase_type != 'none' THEN purchase_id END) > 2 AS is_spender, "
          "coalesce(avg(purchase_amount), 0) AS avg_purchase_amount_per_ad FROM ord_purchases GROUP BY user_id",
          dbl="avg_purchase_amount_per_ad")
def mart_user_spending(spark, d):
    """MART-07 spender flag (> 2 purchases) and mean amount."""
    return P.user_spending(Roles(spark, d).ord_purchases())


@register("mart_player_type", f"WITH {R('ord_sessions')}, {_ACT_SQL} SELECT user_id, total_sessions, active_weeks, "
          "CASE WHEN total_sessions / active_weeks > 15 THEN 'Hardcore' ELSE 'Casual' END AS player_type FROM act")
def mart_player_type(spark, d):
    """MART-08 Hardcore / Casual (cut 15 sessions per active week)."""
    return P.player_type(P.user_activity(Roles(spark, d).ord_sessions()))


@register("mart_demographics", f"WITH {R('users', 'ord_sessions', 'ord_purchases', 'tickets')}, {_ACT_SQL}, "
          "sp AS (SELECT user_id, count(purchase_id) AS total_ads, "
          "count(CASE WHEN purchase_type != 'none' THEN purchase_id END) > 2 AS is_spender, "
          "coalesce(avg(purchase_amount), 0) AS avg_purchase_amount_per_ad FROM ord_purchases GROUP BY user_id) "
          "SELECT u.user_id, concat(u.first_name, ' ', u.last_name) AS full_name, "
          f"year(DATE '{ORD}') - year(u.birthdate) AS age, u.gender, u.location, "
          "CASE WHEN a.user_id IS NULL THEN NULL WHEN a.total_sessions / a.active_weeks > 15 THEN 'Hardcore' ELSE 'Casual' END AS player_type, "
          "a.total_sessions / a.active_weeks AS average_sessions_per_active_week, "
          "a.total_session_duration / a.total_sessions AS average_session_duration, "
          "sp.total_ads, sp.is_spender, sp.avg_purchase_amount_per_ad, "
          "u.user_id IN (SELECT user_id FROM tickets) AS has_support_ticket "
          "FROM users u LEFT JOIN act a ON u.user_id = a.user_id LEFT JOIN sp ON u.user_id = sp.user_id",
          dbl="average_sessions_per_active_week average_session_duration avg_purchase_amount_per_ad")
def mart_demographics(spark, d):
    """MART-09 DEMOGRAPHICS profile (as_of 2001-08-02)."""
    r = Roles(spark, d)
    return P.demographics(r.users(), r.ord_sessions(), r.ord_purchases(), r.tickets(), ORD)


@register("mart_retention", f"WITH {R('ev_sessions')}, f AS (SELECT user_id, min(log_in) AS first_login_date, "
          "max(log_in) AS last_login_date, count(*) AS total_logins FROM ev_sessions GROUP BY user_id), "
          "la AS (SELECT f.user_id, f.first_login_date, f.last_login_date, f.total_logins, "
          "max(date_diff('day', CAST(f.first_login_date AS DATE), CAST(e.log_in AS DATE)) >= 1) AS logged_in_after_1_day, "
          "max(date_diff('day', CAST(f.first_login_date AS DATE), CAST(e.log_in AS DATE)) >= 7) AS logged_in_after_7_days, "
          "max(date_diff('day', CAST(f.first_login_date AS DATE), CAST(e.log_in AS DATE)) >= 30) AS logged_in_after_30_days, "
          f"max(e.log_in >= CAST(DATE '{EV}' - INTERVAL 30 DAY AS TIMESTAMP)) AS logged_in_in_last_30_days, "
          f"date_diff('day', CAST(f.last_login_date AS DATE), DATE '{EV}') AS days_since_last_login "
          "FROM f LEFT JOIN ev_sessions e ON e.user_id = f.user_id "
          "GROUP BY f.user_id, f.first_login_date, f.last_login_date, f.total_logins) "
          "SELECT *, CASE WHEN days_since_last_login > 30 THEN 1 ELSE 0 END AS churned FROM la",
          big="churned")
def mart_retention(spark, d):
    """MART-10 RETENTION (as_of 2024-01-31)."""
    return P.retention(Roles(spark, d).ev_sessions(), EV)


_PT = " ".join(c.upper() for c in _STATS) + " TOTAL_POINTS"


@register("mart_points_per_event", f"WITH {R('game_events', 'ord_sessions')}, {_PPE_SQL} SELECT * FROM ppe",
          dbl=f"session_duration_minutes {_PT}")
def mart_points_per_event(spark, d):
    """MART-11 POINTS_PER_EVENT (game events = lineitems, sessions = orders)."""
    r = Roles(spark, d)
    return P.points_per_event(r.game_events(), r.ord_sessions())


@register("mart_points_per_user", f"WITH {R('game_events', 'ord_sessions')}, {_PPE_SQL}, {_PPU_SQL} SELECT * FROM ppu",
          dbl=_PT)
def mart_points_per_user(spark, d):
    """MART-12 POINTS_PER_USER."""
    r = Roles(spark, d)
    return P.points_per_user(P.points_per_event(r.game_events(), r.ord_sessions()))


@register("mart_user_rankings", f"WITH {R('game_events', 'ord_sessions')}, {_PPE_SQL}, {_PPU_SQL}, {_TIERS_SQL}, "
          f"{_RANK_SQL} SELECT * FROM ranks", dbl="total_points percentile")
def mart_user_rankings(spark, d):
    """MART-13 USER_RANKINGS: tier + distributed rank percentile."""
    r = Roles(spark, d)
    ppu = P.points_per_user(P.points_per_event(r.game_events(), r.ord_sessions()))
    return P.user_rankings(ppu, P.tiers_frame(spark))


@register("q05_tier_share", f"WITH {R('game_events', 'ord_sessions')}, {_PPE_SQL}, {_PPU_SQL}, {_TIERS_SQL}, "
          f"{_RANK_SQL} SELECT avg(CASE WHEN rank_name IN ('Diamond','Elite','Champion','Unreal') THEN 1.0 ELSE 0.0 END) * 100 "
          "AS pct_top_tiers FROM ranks", dbl="pct_top_tiers")
def q05_tier_share(spark, d):
    """MART-14 / Q-05 % of players Diamond or above."""
    r = Roles(spark, d)
    ppu = P.points_per_user(P.points_per_event(r.game_events(), r.ord_sessions()))
    return P.tier_share(P.user_rankings(ppu, P.tiers_frame(spark)))


@register("mart_conversion_by_month", f"WITH {R('ev_purchases')} SELECT strftime(purchase_ts, '%Y-%m') AS month, ad_type, "
          "count(ad_interaction_id) AS total_ads, "
          "count(DISTINCT CASE WHEN purchase_type != 'none' THEN purchase_id END) AS purchased_ads, "
          "count(DISTINCT CASE WHEN purchase_type != 'none' THEN purchase_id END) * 1.0 / count(ad_interaction_id) AS ad_conversion_rate "
          "FROM ev_purchases GROUP BY 1, 2", dbl="ad_conversion_rate")
def mart_conversion_by_month(spark, d):
    """MART-15 AD_CONVERSION_OVER_TIME."""
    return P.conversion_by_month(Roles(spark, d).ev_purchases())


# months_between(as_of, start) with the 31-day-month fraction rule
_MB = (f"round((year(DATE '{ORD}') - year(s)) * 12 + month(DATE '{ORD}') - month(s) + "
       f"CASE WHEN day(DATE '{ORD}') = day(s) OR (DATE '{ORD}' = last_day(DATE '{ORD}') AND s = last_day(s)) THEN 0 "
       f"ELSE (day(DATE '{ORD}') - day(s)) / 31.0 END, 8)")


@register("mart_cohort_cltv", f"WITH {R('users', 'ord_purchases')}, cd AS (SELECT u.user_id, "
          "strftime(u.account_creation, '%Y-%m') AS cohort_month, p.purchase_amount, u.account_creation "
          "FROM users u LEFT JOIN ord_purchases p ON u.user_id = p.user_id WHERE u.consent), "
          "cr AS (SELECT cohort_month, sum(purchase_amount) AS total_revenue, count(DISTINCT user_id) AS total_players, "
          "min(account_creation) AS s FROM cd GROUP BY cohort_month) "
          f"SELECT cohort_month, total_revenue, total_players, total_revenue / total_players AS ltv, {_MB} AS months_active, "
          f"total_revenue / nullif({_MB}, 0) AS normalized_ltv FROM cr",
          dbl="total_revenue ltv months_active normalized_ltv")
def mart_cohort_cltv(spark, d):
    """MART-16 COHORT_CLTV (signup = first order month, consent = balance >= 0)."""
    r = Roles(spark, d)
    return P.cohort_cltv(r.users(), r.ord_purchases(), ORD)


@register("mart_country_count", f"WITH {R('users')} SELECT location AS country, count(user_id) AS total_players "
          "FROM users GROUP BY location")
def mart_country_count(spark, d):
    """MART-17 COUNTRY_COUNT."""
    return P.count_by(Roles(spark, d).users())


@register("q04_top_countries", f"WITH {R('users')} SELECT location AS country, count(user_id) AS total_players "
          "FROM users GROUP BY location ORDER BY total_players DESC, country LIMIT 5")
def q04_top_countries(spark, d):
    """Q-04 countries with most players (top 5, ties by name)."""
    from ..operators.windows import top_k
    return top_k(P.count_by(Roles(spark, d).users()), [F.desc("total_players"), F.asc("country")], 5)


_DAILY_CHURN = (f"WITH {R('ev_sessions')}, a AS (SELECT DISTINCT CAST(log_in AS DATE) AS d, user_id FROM ev_sessions), "
                "c AS (SELECT a.user_id, a.d FROM a LEFT JOIN a b ON a.user_id = b.user_id AND b.d = a.d - INTERVAL 1 DAY "
                "WHERE b.user_id IS NULL), "
                "ds AS (SELECT a.d AS log_in_date, count(DISTINCT a.user_id) AS active_users, count(DISTINCT c.user_id) AS churned_users "
                "FROM a LEFT JOIN c ON a.user_id = c.user_id AND a.d = c.d GROUP BY a.d) "
                "SELECT log_in_date, churned_users, active_users, "
                "CASE WHEN active_users > 0 THEN churned_users / active_users * 100 END AS churn_rate_percentage "
                "FROM ds WHERE log_in_date != (SELECT min(CAST(log_in AS DATE)) FROM ev_sessions)")


@register("mart_churn_daily", _DAILY_CHURN, dbl="churn_rate_percentage")
def mart_churn_daily(spark, d):
    """MART-18 DAILY_CHURN_RATE (churned = not active the previous day, T1)."""
    return P.churn_rate_daily(Roles(spark, d).ev_sessions())


_MONTHLY = (f"WITH {R('ord_sessions')}, a AS (SELECT DISTINCT year(log_in) AS year, month(log_in) AS month, user_id FROM ord_sessions), "
            "c AS (SELECT a.year, a.month, a.user_id FROM a LEFT JOIN a b ON a.user_id = b.user_id AND {JOIN} "
            "WHERE b.user_id IS NULL), "
            "ms AS (SELECT a.year, a.month, count(DISTINCT a.user_id) AS active_users, count(DISTINCT c.user_id) AS churned_users "
            "FROM a LEFT JOIN c ON a.user_id = c.user_id AND a.year = c.year AND a.month = c.month GROUP BY a.year, a.month) "
            "SELECT year, month, churned_users, active_users, "
            "CASE WHEN active_users > 0 THEN churned_users / active_users * 100 END AS churn_rate_percentage FROM ms "
            "WHERE {FIRST}")


@register("mart_churn_monthly_compat",
          _MONTHLY.replace("{JOIN}", "a.year = b.year AND a.month = b.month + 1").replace(
              "{FIRST}", "NOT (year = (SELECT min(year) FROM a) AND month = (SELECT min(month) FROM a))"),
          dbl="churn_rate_percentage", big="year month")
def mart_churn_monthly_compat(spark, d):
    """MART-19 MONTHLY_CHURN_RATE as written (January trap T2, independent minima T3)."""
    return P.churn_rate_monthly(Roles(spark, d).ord_sessions(), compat=True)


@register("mart_churn_monthly",
          _MONTHLY.replace("{JOIN}", "a.year * 12 + a.month = b.year * 12 + b.month + 1").replace(
              "{FIRST}", "year * 12 + month != (SELECT min(year * 12 + month) FROM a)"),
          dbl="churn_rate_percentage", big="year month")
def mart_churn_monthly(spark, d):
    """MART-19 corrected: gap-free month index, true first month dropped."""
    return P.churn_rate_monthly(Roles(spark, d).ord_sessions(), compat=False)


@register("mart_lost_next_day", f"WITH {R('ev_sessions')}, a AS (SELECT DISTINCT CAST(log_in AS DATE) AS d, user_id FROM ev_sessions) "
          "SELECT a.d AS log_in_date, count(*) FILTER (WHERE b.user_id IS NULL) AS lost_users, count(*) AS active_users "
          "FROM a LEFT JOIN a b ON a.user_id = b.user_id AND b.d = a.d + INTERVAL 1 DAY "
          "WHERE a.d != (SELECT max(d) FROM a) GROUP BY a.d")
def mart_lost_next_day(spark, d):
    """T1 counterpart: users active on a day and absent the next day."""
    return P.lost_next(Roles(spark, d).ev_sessions())


@register("mart_flag_rates", f"WITH {R('game_events')}, u AS (SELECT user_id, bool_or(victory_royale) AS v, "
          "bool_or(elimination_milestones) AS e, bool_or(survival_achievements) AS s, bool_or(building_resources) AS b "
          "FROM game_events GROUP BY user_id) SELECT avg(CASE WHEN v THEN 1.0 ELSE 0.0 END) AS victory_royale_share, "
          "avg(CASE WHEN e THEN 1.0 ELSE 0.0 END) AS elimination_milestones_share, "
          "avg(CASE WHEN s THEN 1.0 ELSE 0.0 END) AS survival_achievements_share, "
          "avg(CASE WHEN b THEN 1.0 ELSE 0.0 END) AS building_resources_share FROM u",
          dbl="victory_royale_share elimination_milestones_share survival_achievements_share building_resources_share")
def mart_flag_rates(spark, d):
    """MART-20 share of users per achievement flag."""
    return P.flag_rates(Roles(spark, d).game_events(), "user_id",
                        ["victory_royale", "elimination_milestones", "survival_achievements", "building_resources"])


@register("mart_ticket_stats", f"WITH {R('tickets')} SELECT category, count(case_id) AS tickets, "
          "avg(sentiment) AS avg_sentiment FROM tickets GROUP BY category", dbl="avg_sentiment")
def mart_ticket_stats(spark, d):
    """MART-21 support tickets per category."""
    return P.ticket_stats(Roles(spark, d).tickets())


@register("q01_dau_last_month", f"WITH {R('ev_sessions')}, {_DAU_SQL} SELECT * FROM dau "
          f"WHERE active_date >= DATE '{EV}' - INTERVAL 1 MONTH AND active_date < DATE '{EV}'")
def q01_dau_last_month(spark, d):
    """Q-01 DAU over the month before as_of."""
    from ..functions.expr import lit_date
    x = P.dau(Roles(spark, d).ev_sessions())
    return x.where((F.col("active_date") >= F.add_months(lit_date(EV), -1)) & (F.col("active_date") < lit_date(EV)))


@register("q02_arppu", f"WITH {R('ev_purchases')} SELECT sum(purchase_amount) / count(DISTINCT user_id) AS arppu "
          "FROM ev_purchases WHERE purchase_type != 'none'", dbl="arppu")
def q02_arppu(spark, d):
    """Q-02 average revenue per paying user."""
    p = Roles(spark, d).ev_purchases().where(F.col("purchase_type") != "none")
    return p.agg((F.sum("purchase_amount") / F.countDistinct("user_id")).alias("arppu"))


@register("q03_retention_rates", f"WITH {R('ev_sessions')}, f AS (SELECT user_id, min(log_in) AS a, max(log_in) AS b "
          "FROM ev_sessions GROUP BY 1) SELECT "
          "avg(CASE WHEN date_diff('day', CAST(a AS DATE), CAST(b AS DATE)) >= 1 THEN 1.0 ELSE 0.0 END) * 100 AS day1_retention_pct, "
          "avg(CASE WHEN date_diff('day', CAST(a AS DATE), CAST(b AS DATE)) >= 7 THEN 1.0 ELSE 0.0 END) * 100 AS day7_retention_pct FROM f",
          dbl="day1_retention_pct day7_retention_pct")
def q03_retention_rates(spark, d):
    """Q-03 day-1 / day-7 retention (%), metrics 13-14 over RETENTION."""
    from ..operators.aggs import rate
    r = P.retention(Roles(spark, d).ev_sessions(), EV)
    return r.agg((rate(F.col("logged_in_after_1_day")) * 100).alias("day1_retention_pct"),
                 (rate(F.col("logged_in_after_7_days")) * 100).alias("day7_retention_pct"))


@register("src_refresh_rankings_dag", f"WITH {R('game_events', 'ord_sessions')}, {_PPE_SQL}, {_PPU_SQL}, {_TIERS_SQL}, "
          f"{_RANK_SQL} SELECT * FROM ranks", dbl="total_points percentile")
def src_refresh_rankings_dag(spark, d):
    """SRC-05/06/13 refresh of a chain of derived tables: points per event -> points per user -> rankings.
    Stale tables are rebuilt (overwrite) after their inputs, fresh ones opened; points per event is bucketed
    by user, so points per user aggregates it without a shuffle."""
    import hashlib

    from .refresh import Derived, refresh, refresh_root
    r = Roles(spark, d)
    graph = {
        "points_per_event": Derived(("lineitem", "orders"), lambda i: P.points_per_event(r.game_events(), r.ord_sessions()), ("user_id",)),
        "points_per_user": Derived(("points_per_event",), lambda i: P.points_per_user(i["points_per_event"])),
        "user_rankings": Derived(("points_per_user",), lambda i: P.user_rankings(i["points_per_user"], P.tiers_frame(spark))),
    }
    root = refresh_root(spark, hashlib.sha256(d.encode()).hexdigest()[:12])
    return refresh(spark, graph, {t: r.t(t) for t in ("lineitem", "orders")}, root).tables["user_rankings"]
