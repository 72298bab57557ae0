"""Salon bookings queries (MART-50..54, FC-*, STAFF-*, Q-14..16, 22, 23, 25) with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keyed as K
from ..functions.expr import sql_round_half as RH
from ..marts import spa as S
from ..operators import forecast as FC
from ..operators import windows as W
from ..sources.io import scan
from .catalog import register
from .roles import AS_OF_EVENTS as EV, R, Roles

KEYS = ["location_city", "service_category"]
NEXT_WEEK = ("2024-01-31", "2024-02-06")

_SERIES_SQL = (
    f"{R('appointments')}, dd AS (SELECT location_city, service_category, appointment_date AS ts, CAST(count(*) AS DOUBLE) AS y "
    "FROM appointments WHERE appointment_status = 'completed' GROUP BY 1, 2, 3), "
    "bnd AS (SELECT min(ts) AS s, max(ts) AS e FROM dd), "
    "sk AS (SELECT DISTINCT location_city, service_category FROM dd), "
    "grid AS (SELECT sk.location_city, sk.service_category, CAST(g.d AS DATE) AS ts FROM sk, bnd, "
    "generate_series(bnd.s, bnd.e, INTERVAL 1 DAY) g(d)), "
    "zf AS (SELECT grid.*, coalesce(dd.y, 0.0) AS y FROM grid LEFT JOIN dd USING (location_city, service_category, ts))")
_FC_SQL = (
    "x AS (SELECT zf.*, CAST(date_diff('day', bnd.s, zf.ts) AS DOUBLE) AS t FROM zf, bnd), "
    "tr AS (SELECT location_city, service_category, coalesce(regr_slope(y, t), 0) AS b, coalesce(regr_intercept(y, t), 0) AS a, "
    "max(ts) AS last FROM x GROUP BY 1, 2), "
    "r AS (SELECT x.*, tr.a, tr.b, x.y - (tr.a + tr.b * x.t) AS res, dayofweek(x.ts) AS dow FROM x JOIN tr USING (location_city, service_category)), "
    "eff AS (SELECT location_city, service_category, dow, avg(res) AS eff FROM r GROUP BY 1, 2, 3), "
    "sd AS (SELECT r.location_city, r.service_category, coalesce(stddev_samp(r.res - eff.eff), 0) AS sd FROM r "
    "JOIN eff USING (location_city, service_category, dow) GROUP BY 1, 2), "
    "fut AS (SELECT tr.*, sd.sd, CAST(unnest(generate_series(tr.last + 1, tr.last + 14, INTERVAL 1 DAY)) AS DATE) AS ts "
    "FROM tr JOIN sd USING (location_city, service_category)), "
    "fp AS (SELECT f.location_city, f.service_category, f.ts, f.a + f.b * date_diff('day', (SELECT s FROM bnd), f.ts) + coalesce(e.eff, 0) AS yhat, f.sd "
    "FROM fut f LEFT JOIN eff e ON e.location_city = f.location_city AND e.service_category = f.service_category AND e.dow = dayofweek(f.ts)), "
    "fc AS (SELECT location_city, service_category, ts, greatest(yhat, 0.0) AS forecast, greatest(yhat - 1.96 * sd, 0.0) AS lower_bound, "
    "greatest(yhat + 1.96 * sd, 0.0) AS upper_bound FROM fp)")
_PROV_SQL = (
    "sp AS (SELECT *, ['click','error','purchase','signup','view'][CAST(" + K.sql_hash32("s_suppkey", "skill1") + " % 5 AS INTEGER) + 1] AS s1, "
    "['click','error','purchase','signup','view'][CAST(" + K.sql_hash32("s_suppkey", "skill2") + " % 5 AS INTEGER) + 1] AS s2 FROM supplier), "
    "prov AS (SELECT s_suppkey AS provider_id, s_name AS provider_name, "
    "['Austin','Boston','Chicago','Denver','Seattle','Miami','Portland','Phoenix','Dallas','Atlanta'][CAST(s_nationkey % 10 AS INTEGER) + 1] AS location_city, "
    "CASE WHEN s1 = s2 THEN s1 ELSE s1 || ',' || s2 END AS skill_categories, "
    "6 + " + K.sql_hash32("s_suppkey", "hours") + " % 4 AS max_daily_hours, 40 + " + K.sql_hash32("s_suppkey", "rate") + " % 40 AS hourly_rate FROM sp), "
    "avail AS (SELECT provider_id, d AS day_of_week, NOT (d = provider_id % 7 OR d = (provider_id + 3) % 7) AS is_available FROM prov, range(0, 7) r(d)), "
    "sbc AS (SELECT location_city, day_of_week, service_category, sum(provider_count) AS available_providers FROM "
    "(SELECT location_city, day_of_week, unnest(string_split(skill_categories, ',')) AS service_category, provider_count FROM "
    "(SELECT p.location_city, p.skill_categories, a.day_of_week, count(*) AS provider_count FROM prov p JOIN avail a ON p.provider_id = a.provider_id "
    "WHERE a.is_available GROUP BY 1, 2, 3)) GROUP BY 1, 2, 3)")


def _daily(spark, d):
    """The demand series (days with a completed appointment), written once: events are read by that write alone."""
    dd = S.daily_demand(Roles(spark, d).appointments())
    return FC.daily_table(dd.select(*KEYS, "ts", F.col("appointment_count").alias("y")), KEYS, "ts", "y")


def _forecast(spark, d):
    return FC.forecast(_daily(spark, d), KEYS, "ts", "y", h=14)


def _recommend(spark, d, start, end):
    prov = S.providers(scan(spark, d, "supplier"))
    return S.recommend_schedule(_forecast(spark, d), prov, S.availability(prov), start, end)


@register("mart_daily_volume", f"WITH {R('appointments')} SELECT appointment_date, location_city, service_category, count(*) AS appointment_count, "
          "dayofweek(appointment_date) AS day_of_week, CASE WHEN dayofweek(appointment_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, "
          "month(appointment_date) AS month_num FROM appointments WHERE appointment_status = 'completed' GROUP BY 1, 2, 3", big="is_weekend")
def mart_daily_volume(spark, d):
    """MART-50 DAILY_APPOINTMENT_VOLUME."""
    return S.daily_volume(Roles(spark, d).appointments())


@register("mart_daily_demand", f"WITH {R('appointments')} SELECT [location_city, service_category][1] AS series_city, location_city, service_category, "
          "appointment_date AS ts, CAST(count(*) AS DOUBLE) AS appointment_count FROM appointments WHERE appointment_status = 'completed' GROUP BY 2, 3, 4",
          dbl="appointment_count")
def mart_daily_demand(spark, d):
    """MART-51 demand series keyed by an array [city, category]; element read of the key (EXPR-25)."""
    x = S.daily_demand(Roles(spark, d).appointments())
    return x.select(F.get("series", 0).alias("series_city"), *KEYS, "ts", "appointment_count")


@register("fc_zero_fill", f"WITH {_SERIES_SQL} SELECT location_city, service_category, ts, y FROM zf", dbl="y")
def fc_zero_fill(spark, d):
    """FC-01 zero-filled daily series per key (T15: the raw view has no zero rows)."""
    return FC.zero_fill(_daily(spark, d), KEYS, "ts", "y")


@register("fc_forecast", f"WITH {_SERIES_SQL}, {_FC_SQL} SELECT * FROM fc", dbl="forecast lower_bound upper_bound")
def fc_forecast(spark, d):
    """FC-03 trend x weekday regression per series, 14-day horizon, +-1.96 sd bounds, floor 0."""
    return _forecast(spark, d)


@register("q14_forecast_next_week", f"WITH {_SERIES_SQL}, {_FC_SQL} SELECT location_city, ts, sum(forecast) AS forecast FROM fc "
          f"WHERE ts BETWEEN DATE '{NEXT_WEEK[0]}' AND DATE '{NEXT_WEEK[1]}' GROUP BY 1, 2", dbl="forecast")
def q14_forecast_next_week(spark, d):
    """Q-14 demand forecast for next week per city (FC-03 + filter)."""
    f = _forecast(spark, d).where(F.col("ts").between(F.lit(NEXT_WEEK[0]).cast("date"), F.lit(NEXT_WEEK[1]).cast("date")))
    return f.groupBy("location_city", "ts").agg(F.sum("forecast").alias("forecast"))


@register("fc_seasonal_naive", f"WITH {_SERIES_SQL}, l AS (SELECT location_city, service_category, max(ts) AS last FROM zf GROUP BY 1, 2), "
          "p AS (SELECT z.location_city, z.service_category, dayofweek(z.ts) AS dow, avg(z.y) AS forecast FROM zf z JOIN l USING (location_city, service_category) "
          "WHERE z.ts > l.last - 28 GROUP BY 1, 2, 3), f AS (SELECT location_city, service_category, "
          "CAST(unnest(generate_series(last + 1, last + 14, INTERVAL 1 DAY)) AS DATE) AS ts FROM l) "
          "SELECT f.location_city, f.service_category, f.ts, coalesce(p.forecast, 0.0) AS forecast FROM f LEFT JOIN p "
          "ON p.location_city = f.location_city AND p.service_category = f.service_category AND p.dow = dayofweek(f.ts)", dbl="forecast")
def fc_seasonal_naive(spark, d):
    """FC-02 seasonal-naive forecast: mean of the same weekday over the last 4 weeks."""
    return FC.seasonal_naive(_daily(spark, d), KEYS, "ts", "y", h=14)


_BT_SQL = (
    f"WITH {_SERIES_SQL}, x AS (SELECT zf.*, bnd.s, bnd.e, f.fold, bnd.e - CAST(7 * f.fold AS INTEGER) AS cut FROM zf, bnd, range(1, 4) f(fold)), "
    "tr AS (SELECT location_city, service_category, fold, coalesce(regr_slope(y, CAST(date_diff('day', s, ts) AS DOUBLE)), 0) AS b, "
    "coalesce(regr_intercept(y, CAST(date_diff('day', s, ts) AS DOUBLE)), 0) AS a FROM x WHERE ts <= cut GROUP BY 1, 2, 3), "
    "r AS (SELECT x.*, x.y - (tr.a + tr.b * date_diff('day', x.s, x.ts)) AS res, dayofweek(x.ts) AS dow FROM x JOIN tr USING (location_city, service_category, fold) "
    "WHERE x.ts <= x.cut), eff AS (SELECT location_city, service_category, fold, dow, avg(res) AS eff FROM r GROUP BY 1, 2, 3, 4), "
    "te AS (SELECT x.*, greatest(tr.a + tr.b * date_diff('day', x.s, x.ts) + coalesce(eff.eff, 0), 0.0) - x.y AS err FROM x "
    "JOIN tr USING (location_city, service_category, fold) LEFT JOIN eff ON eff.location_city = x.location_city AND eff.service_category = x.service_category "
    "AND eff.fold = x.fold AND eff.dow = dayofweek(x.ts) WHERE x.ts > x.cut AND x.ts <= x.cut + 7), "
    "bt AS (SELECT location_city, service_category, avg(abs(err)) AS mae, sqrt(avg(err * err)) AS rmse, avg(abs(err) / nullif(y, 0)) AS mape, "
    "count(*) AS n_scored FROM te GROUP BY 1, 2) ")


@register("fc_backtest", _BT_SQL + "SELECT * FROM bt", dbl="mae rmse mape")
def fc_backtest(spark, d):
    """FC-05 rolling-origin backtest (3 folds x 7 days): MAE, RMSE, MAPE per series."""
    return FC.backtest(_daily(spark, d), KEYS, "ts", "y", h=7, folds=3)


@register("q25_largest_errors", _BT_SQL + "SELECT location_city, service_category, mae FROM bt ORDER BY mae DESC, location_city, service_category LIMIT 10",
          dbl="mae")
def q25_largest_errors(spark, d):
    """Q-25 series with the largest backtest errors."""
    b = FC.backtest(_daily(spark, d), KEYS, "ts", "y", h=7, folds=3)
    return W.top_k(b.select(*KEYS, "mae"), [F.desc("mae"), F.asc("location_city"), F.asc("service_category")], 10)


@register("q22_history_and_forecast", f"WITH {_SERIES_SQL}, {_FC_SQL} SELECT ts, y AS value, 'history' AS kind FROM zf "
          "WHERE location_city = 'Austin' AND service_category = 'purchase' UNION ALL SELECT ts, round(forecast, 2), 'forecast' FROM fc "
          "WHERE location_city = 'Austin' AND service_category = 'purchase'", dbl="value")
def q22_history_and_forecast(spark, d):
    """Q-22 / FC-06 plot data of one series: history and rounded forecast side by side."""
    daily, one = _daily(spark, d), (F.col("location_city") == "Austin") & (F.col("service_category") == "purchase")
    s = FC.zero_fill(daily, KEYS, "ts", "y").where(one)
    f = FC.forecast(daily, KEYS, "ts", "y", h=14).where(one)
    return s.select("ts", F.col("y").alias("value"), F.lit("history").alias("kind")).unionByName(
        f.select("ts", F.round("forecast", 2).alias("value"), F.lit("forecast").alias("kind")))


@register("staff_by_category", f"WITH {_PROV_SQL} SELECT * FROM sbc", big="available_providers")
def staff_by_category(spark, d):
    """STAFF-02 available providers per city x weekday x skill."""
    prov = S.providers(scan(spark, d, "supplier"))
    return S.staff_by_category(prov, S.availability(prov))


_REC_SQL = (f"WITH {_SERIES_SQL}, {_FC_SQL}, {_PROV_SQL}, "
            "fpp AS (SELECT ts AS forecast_date, location_city, service_category, CAST(ceil(forecast) AS DOUBLE) AS forecasted_demand, "
            "dayofweek(ts) AS day_of_week FROM fc WHERE ts BETWEEN DATE '{S}' AND DATE '{E}'), "
            "rec AS (SELECT f.forecast_date, f.location_city, f.service_category, f.forecasted_demand, "
            "CAST(coalesce(s.available_providers, 0) AS BIGINT) AS available_providers, "
            "CAST(greatest(ceil(f.forecasted_demand / 4.0), 1) AS BIGINT) AS recommended_staff FROM fpp f LEFT JOIN sbc s "
            "ON f.location_city = s.location_city AND f.service_category = s.service_category AND f.day_of_week = s.day_of_week), "
            "res AS (SELECT *, CASE WHEN available_providers < recommended_staff THEN 'Understaffed' "
            "WHEN available_providers > recommended_staff * 2 THEN 'Overstaffed' ELSE 'Adequate' END AS staffing_status, "
            "available_providers - recommended_staff AS gap FROM rec) ")


@register("staff_recommend_schedule", _REC_SQL.replace("{S}", "2024-01-31").replace("{E}", "2024-02-13") + "SELECT * FROM res",
          dbl="forecasted_demand")
def staff_recommend_schedule(spark, d):
    """STAFF-01 / UDF-01 recommend_schedule(start, end) over the 14-day forecast."""
    return _recommend(spark, d, "2024-01-31", "2024-02-13")


@register("q15_understaffed_next_week", _REC_SQL.replace("{S}", NEXT_WEEK[0]).replace("{E}", NEXT_WEEK[1])
          + "SELECT * FROM res WHERE staffing_status = 'Understaffed'", dbl="forecasted_demand")
def q15_understaffed_next_week(spark, d):
    """Q-15 / STAFF-03 understaffed city x category x day next week."""
    r = _recommend(spark, d, *NEXT_WEEK)
    return r.where(F.col("staffing_status") == "Understaffed")


@register("q16_available_saturday", f"WITH {_PROV_SQL} SELECT p.provider_id, p.provider_name, p.location_city, p.skill_categories FROM prov p "
          "JOIN avail a ON p.provider_id = a.provider_id WHERE a.day_of_week = 6 AND a.is_available")
def q16_available_saturday(spark, d):
    """Q-16 / STAFF-03/04 roster of providers free on Saturdays."""
    prov = S.providers(scan(spark, d, "supplier"))
    a = S.availability(prov).where((F.col("day_of_week") == 6) & F.col("is_available"))
    return prov.join(a.select("provider_id"), "provider_id").select("provider_id", "provider_name", "location_city",
                                                                   "skill_categories")


@register("staff_with_two_skills", f"WITH {_PROV_SQL} SELECT provider_id, location_city FROM prov "
          "WHERE list_contains(string_split(skill_categories, ','), 'click') AND list_contains(string_split(skill_categories, ','), 'view')")
def staff_with_two_skills(spark, d):
    """STAFF-03 providers holding both of two skills (array_contains on the split list)."""
    prov = S.providers(scan(spark, d, "supplier"))
    sk = F.split("skill_categories", ",")
    return prov.where(F.array_contains(sk, "click") & F.array_contains(sk, "view")).select("provider_id", "location_city")


@register("q23_top_volumes", f"WITH {R('appointments')} SELECT location_city, service_category, count(*) AS appointment_count FROM appointments "
          "WHERE appointment_status = 'completed' GROUP BY 1, 2 ORDER BY appointment_count DESC, location_city, service_category LIMIT 15")
def q23_top_volumes(spark, d):
    """Q-23 top 15 city x category volumes."""
    v = S.daily_volume(Roles(spark, d).appointments()).groupBy(*KEYS).agg(F.sum("appointment_count").alias("appointment_count"))
    return W.top_k(v, [F.desc("appointment_count"), F.asc("location_city"), F.asc("service_category")], 15)


_RB_SQL = (
    f"WITH {R('appointments')}, c AS (SELECT * FROM appointments WHERE appointment_status = 'completed'), "
    "a AS (SELECT client_id, count(*) AS total_appointments, count(*) FILTER (WHERE appointment_status = 'no_show') AS noshow, "
    "count(*) FILTER (WHERE appointment_status = 'cancelled') AS cancel, count(*) FILTER (WHERE appointment_status = 'late_cancel') AS late_cancel_count, "
    "avg(days_booked_in_advance) AS adv, count(*) FILTER (WHERE booking_source = 'app') AS app, count(DISTINCT service_category) AS service_categories "
    "FROM appointments GROUP BY 1), "
    "cg AS (SELECT client_id, max(appointment_date) AS last, min(appointment_date) AS first, count(*) AS completed_count, "
    "avg(service_duration_mins) AS dur, sum(line_total) AS spend, avg(line_total) AS aov, avg(tip_amount) AS tip, sum(tip_amount) AS tips FROM c GROUP BY 1), "
    "hx AS (SELECT client_id, line_total, row_number() OVER (PARTITION BY client_id ORDER BY appointment_date, appointment_id) AS rn, "
    "count(*) OVER (PARTITION BY client_id) AS n FROM c), "
    "ht AS (SELECT client_id, CASE WHEN max(n) < 4 OR avg(CASE WHEN rn <= n // 2 THEN line_total END) <= 0 THEN 0.0 "
    "ELSE (avg(CASE WHEN rn > n // 2 THEN line_total END) - avg(CASE WHEN rn <= n // 2 THEN line_total END)) / avg(CASE WHEN rn <= n // 2 THEN line_total END) END AS trend "
    "FROM hx GROUP BY 1), "
    f"rb AS (SELECT cg.client_id, date_diff('day', cg.last, DATE '{EV}') AS days_since_last_visit, date_diff('day', cg.first, DATE '{EV}') AS tenure_days, "
    f"a.total_appointments, cg.completed_count, {RH('a.noshow / a.total_appointments', 4)} AS no_show_rate, "
    f"{RH('a.cancel / a.total_appointments', 4)} AS cancellation_rate, a.late_cancel_count, "
    f"{RH('CASE WHEN cg.completed_count >= 2 THEN date_diff(' + repr('day') + ', cg.first, cg.last) / (cg.completed_count - 1) ELSE 0.0 END')} AS avg_days_between_visits, "
    f"{RH('cg.dur')} AS avg_duration_mins, {RH('a.adv')} AS avg_days_booked_advance, {RH('a.app / a.total_appointments', 4)} AS app_booking_pct, "
    f"a.service_categories, {RH('cg.spend')} AS total_spend, {RH('cg.aov')} AS avg_order_value, {RH('cg.tip')} AS avg_tip, "
    f"{RH('CASE WHEN cg.spend > 0 THEN cg.tips / cg.spend ELSE 0.0 END', 4)} AS tip_rate, {RH('coalesce(ht.trend, 0.0)', 4)} AS spend_trend, "
    f"CASE WHEN date_diff('day', cg.last, DATE '{EV}') > 1 THEN 1 ELSE 0 END AS at_risk "
    "FROM cg JOIN a USING (client_id) LEFT JOIN ht USING (client_id)) ")
_RB_DBL = ("no_show_rate cancellation_rate avg_days_between_visits avg_duration_mins avg_days_booked_advance app_booking_pct "
           "total_spend avg_order_value avg_tip tip_rate spend_trend")


@register("mart_rebooking_features", _RB_SQL + "SELECT * FROM rb", dbl=_RB_DBL, big="at_risk")
def mart_rebooking_features(spark, d):
    """MART-53/54 client rebooking features and at-risk label (ref date 2024-01-31; clients come twice a day here, so the window is a day)."""
    return S.rebooking_features(Roles(spark, d).appointments(), EV, 1)


@register("staff_providers", f"WITH {_PROV_SQL} SELECT * FROM prov", big="max_daily_hours hourly_rate")
def staff_providers(spark, d):
    """STAFF-04 provider roster: city, comma-separated skills, hours, rate (one provider per supplier)."""
    return S.providers(scan(spark, d, "supplier"))


@register("staff_availability", f"WITH {_PROV_SQL} SELECT * FROM avail")
def staff_availability(spark, d):
    """MART-52 weekly availability grid (7 days per provider, two days off)."""
    prov = S.providers(scan(spark, d, "supplier"))
    return S.availability(prov).select("provider_id", "day_of_week", "is_available")


@register("src_requery_cached", _REC_SQL.replace("{S}", "2024-01-31").replace("{E}", "2024-02-13")
          + "SELECT staffing_status, count(*) AS cells, sum(gap) AS total_gap FROM res GROUP BY 1", big="total_gap")
def src_requery_cached(spark, d):
    """SRC-18 re-query of the previous result: the schedule is persisted once and the caller's
    follow-up questions (understaffed / overstaffed cells) are answered from it."""
    r = _recommend(spark, d, "2024-01-31", "2024-02-13").persist()
    under = r.where(F.col("staffing_status") == "Understaffed")
    rest = r.where(F.col("staffing_status") != "Understaffed")
    return under.unionByName(rest).groupBy("staffing_status").agg(F.count(F.lit(1)).alias("cells"),
                                                                  F.sum("gap").alias("total_gap"))
