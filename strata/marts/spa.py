"""Salon bookings marts, staffing and rebooking features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keyed as K
from ..functions.expr import dow_sun0, lit_date, round_half
from ..operators.windows import half_trend

# Service categories a provider may hold (the event types of the driver data).
CATEGORIES = ["click", "error", "purchase", "signup", "view"]
PROVIDER_CITIES = ["Austin", "Boston", "Chicago", "Denver", "Seattle", "Miami", "Portland", "Phoenix", "Dallas", "Atlanta"]
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def completed(appt: DataFrame) -> DataFrame:
    return appt.where(F.col("appointment_status") == "completed")


def daily_volume(appt: DataFrame) -> DataFrame:
    """MART-50 completed appointments per date x city x category, with weekday, weekend, month."""
    g = completed(appt).groupBy("appointment_date", "location_city", "service_category").agg(
        F.count(F.lit(1)).alias("appointment_count"))
    dow = dow_sun0("appointment_date")
    return g.withColumns({"day_of_week": dow, "is_weekend": F.when(dow.isin(0, 6), F.lit(1)).otherwise(F.lit(0)),
                          "month_num": F.month("appointment_date")})


def daily_demand(appt: DataFrame) -> DataFrame:
    """MART-51 demand series keyed by [city, category] (array key), float counts; no zero rows (T15)."""
    g = completed(appt).groupBy("location_city", "service_category", "appointment_date").agg(
        F.count(F.lit(1)).cast("double").alias("appointment_count"))
    return g.select(F.array("location_city", "service_category").alias("series"), "location_city",
                    "service_category", F.col("appointment_date").alias("ts"), "appointment_count")


def providers(suppliers: DataFrame) -> DataFrame:
    """Provider skills derived per supplier: city, two skill categories (comma list), hours, rate."""
    k = "s_suppkey"
    s1 = K.pick(k, "skill1", CATEGORIES)
    s2 = K.pick(k, "skill2", CATEGORIES)
    skills = F.when(s1 == s2, s1).otherwise(F.concat_ws(",", s1, s2))
    return suppliers.select(F.col("s_suppkey").alias("provider_id"), F.col("s_name").alias("provider_name"),
                            F.get(F.array(*[F.lit(c) for c in PROVIDER_CITIES]), F.col("s_nationkey") % 10)
                            .alias("location_city"), skills.alias("skill_categories"),
                            (F.lit(6) + F.pmod(K.hash32(k, "hours"), F.lit(4))).alias("max_daily_hours"),
                            (F.lit(40) + F.pmod(K.hash32(k, "rate"), F.lit(40))).alias("hourly_rate"))


def availability(prov: DataFrame) -> DataFrame:
    """MART-52 weekly availability: 7 rows per provider, two days off (k mod 7 and k+3 mod 7)."""
    x = prov.select("provider_id", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("day_of_week"))
    off1 = F.pmod(F.col("provider_id"), F.lit(7))
    off2 = F.pmod(F.col("provider_id") + 3, F.lit(7))
    return x.select("provider_id", "day_of_week",
                    F.get(F.array(*[F.lit(n) for n in DAY_NAMES]), F.col("day_of_week")).alias("day_name"),
                    F.lit("09:00:00").alias("available_start"), F.lit("18:00:00").alias("available_end"),
                    (~((F.col("day_of_week") == off1) | (F.col("day_of_week") == off2))).alias("is_available"))


def staff_by_category(prov: DataFrame, avail: DataFrame) -> DataFrame:
    """STAFF-02 available providers per city x weekday x skill (split skills to rows, then sum)."""
    a = prov.join(avail.where("is_available"), "provider_id").groupBy(
        "location_city", "skill_categories", "day_of_week").agg(F.count(F.lit(1)).alias("provider_count"))
    x = a.withColumn("service_category", F.explode(F.split("skill_categories", ",")))
    return x.groupBy("location_city", "day_of_week", "service_category").agg(
        F.sum("provider_count").alias("available_providers"))


def recommend_schedule(fc: DataFrame, prov: DataFrame, avail: DataFrame, start, end, per_day: int = 4) -> DataFrame:
    """STAFF-01 / UDF-01 staffing gap per forecast day x city x category in [start, end]."""
    f = fc.where(F.col("ts").between(lit_date(start), lit_date(end))).select(
        F.col("ts").alias("forecast_date"), "location_city", "service_category",
        F.ceil("forecast").cast("double").alias("forecasted_demand"), dow_sun0("ts").alias("day_of_week"))
    s = staff_by_category(prov, avail)
    j = f.join(s, ["location_city", "service_category", "day_of_week"], "left")
    avail_n = F.coalesce(F.col("available_providers"), F.lit(0)).cast("bigint")
    rec = F.greatest(F.ceil(F.col("forecasted_demand") / float(per_day)), F.lit(1)).cast("bigint")
    return j.select("forecast_date", "location_city", "service_category", "forecasted_demand",
                    avail_n.alias("available_providers"), rec.alias("recommended_staff"),
                    F.when(avail_n < rec, F.lit("Understaffed")).when(avail_n > rec * 2, F.lit("Overstaffed"))
                    .otherwise(F.lit("Adequate")).alias("staffing_status"), (avail_n - rec).alias("gap"))


def rebooking_features(appt: DataFrame, ref_date, window_days: int = 30) -> DataFrame:
    """MART-53/54 client rebooking features (16) for clients with >= 1 completed visit, plus the
    at-risk label (days since last visit > window; it leaks a feature, T11).

    One grouped aggregate over all appointments, one over completed visits and
    one over order lines (the completed visits' line totals), joined by client.
    """
    ref = lit_date(ref_date)
    c = completed(appt)
    st = F.col("appointment_status")
    allg = appt.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("total_appointments"),
        F.count(F.when(st == "no_show", 1)).alias("_noshow"), F.count(F.when(st == "cancelled", 1)).alias("_cancel"),
        F.count(F.when(st == "late_cancel", 1)).alias("late_cancel_count"),
        F.avg("days_booked_in_advance").alias("_adv"), F.count(F.when(F.col("booking_source") == "app", 1)).alias("_app"),
        F.countDistinct("service_category").alias("service_categories"))
    cg = c.groupBy("client_id").agg(
        F.max("appointment_date").alias("_last"), F.min("appointment_date").alias("_first"),
        F.count(F.lit(1)).alias("completed_count"), F.avg("service_duration_mins").alias("_dur"),
        F.sum("line_total").alias("_spend"), F.avg("line_total").alias("_aov"), F.avg("tip_amount").alias("_tip"),
        F.sum("tip_amount").alias("_tips"))
    trend = half_trend(c, "client_id", ["appointment_date", "appointment_id"], "line_total")
    j = cg.join(allg, "client_id").join(trend, "client_id", "left")
    n = F.col("total_appointments")
    gap = F.when(F.col("completed_count") >= 2,
                 F.datediff("_last", "_first") / (F.col("completed_count") - 1)).otherwise(F.lit(0.0))
    days_since = F.datediff(ref, F.col("_last"))
    return j.select(
        "client_id", days_since.alias("days_since_last_visit"), F.datediff(ref, F.col("_first")).alias("tenure_days"),
        "total_appointments", "completed_count", round_half(F.col("_noshow") / n, 4).alias("no_show_rate"),
        round_half(F.col("_cancel") / n, 4).alias("cancellation_rate"), "late_cancel_count",
        round_half(gap, 2).alias("avg_days_between_visits"), round_half("_dur", 2).alias("avg_duration_mins"),
        round_half("_adv", 2).alias("avg_days_booked_advance"), round_half(F.col("_app") / n, 4).alias("app_booking_pct"),
        "service_categories", round_half("_spend", 2).alias("total_spend"), round_half("_aov", 2).alias("avg_order_value"),
        round_half("_tip", 2).alias("avg_tip"),
        round_half(F.when(F.col("_spend") > 0, F.col("_tips") / F.col("_spend")).otherwise(F.lit(0.0)), 4).alias("tip_rate"),
        round_half(F.coalesce("spend_trend", F.lit(0.0)), 4).alias("spend_trend"),
        F.when(days_since > window_days, F.lit(1)).otherwise(F.lit(0)).alias("at_risk"))
