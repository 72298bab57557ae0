"""Retail queries (MART-30..45, Q-06..13) with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keyed as K
from ..functions.expr import sql_round_half as RH
from ..marts import retail as M
from ..operators import windows as W
from ..sources.io import scan
from .catalog import register
from .roles import AS_OF_ORDERS as ORD, R, Roles


def N(k, s):
    return K.sql_normal(k, s)


def U(k, s, lo, hi):
    return K.sql_uniform(k, s, lo, hi)


_KEY = "CAST(kpi_date AS VARCHAR), channel, region"
_KPI_SQL = (
    f"WITH {R('sales', 'customers')}, s AS (SELECT sa.*, c.region FROM sales sa LEFT JOIN customers c ON sa.customer_id = c.customer_id), "
    "f AS (SELECT customer_id, min(sale_date) AS first_sale FROM s GROUP BY 1), "
    f"g AS (SELECT s.sale_date AS kpi_date, s.channel, s.region, {RH('sum(gross_revenue)', 6)} AS gross, {RH('sum(net_revenue)', 6)} AS net, count(*) AS orders, "
    f"sum(quantity) AS units, avg(CASE WHEN return_flag THEN 1.0 ELSE 0.0 END) AS return_rate, {RH('sum(cost_of_goods)', 6)} AS cogs, "
    "count(DISTINCT CASE WHEN s.sale_date = f.first_sale THEN s.customer_id END) AS new_c, count(DISTINCT s.customer_id) AS all_c "
    "FROM s JOIN f ON s.customer_id = f.customer_id GROUP BY 1, 2, 3), "
    f"m AS (SELECT g.*, {RH('net * ' + U(_KEY, 'mkt', 0.08, 0.14), 2)} AS mkt FROM g) "
    f"SELECT kpi_date, channel, region, {RH('gross')} AS gross_revenue, {RH('net')} AS net_revenue, orders, units AS units_sold, "
    f"{RH('CASE WHEN orders = 0 THEN 0 ELSE net / orders END')} AS avg_order_value, {RH('return_rate', 4)} AS return_rate, "
    f"{RH(f'CASE WHEN channel IN (' + repr('1-URGENT') + ', ' + repr('2-HIGH') + ') THEN 0.032 ELSE 0.22 END * ' + U(_KEY, 'conv', 0.8, 1.2), 4)} AS conversion_rate, "
    f"new_c AS new_customers, all_c - new_c AS repeat_customers, {RH(U(_KEY, 'turns', 4.0, 9.0))} AS inventory_turns, "
    f"{RH('CASE WHEN net = 0 THEN 0 ELSE (net - cogs) / net END', 4)} AS gross_margin_pct, {RH('cogs')} AS cogs, mkt AS marketing_spend, "
    f"{RH('mkt / greatest(new_c, 1)')} AS cac, "
    f"{RH('least(99, CASE WHEN mkt / greatest(new_c, 1) = 0 THEN 0 ELSE (net / orders * 3.5) / (mkt / greatest(new_c, 1)) END)')} AS ltv_to_cac_ratio "
    "FROM m")
_KPI_DBL = ("gross_revenue net_revenue units_sold avg_order_value return_rate conversion_rate inventory_turns "
            "gross_margin_pct cogs marketing_spend cac ltv_to_cac_ratio")


@register("mart_daily_kpi", _KPI_SQL, dbl=_KPI_DBL)
def mart_daily_kpi(spark, d):
    """MART-31/32/33 FACT_DAILY_KPI (date x channel x region), CAC and LTV:CAC."""
    r = Roles(spark, d)
    return M.daily_kpi(r.sales(), r.customers())


@register("mart_price_lines", f"WITH {R('sales')} SELECT order_id, line_no, product_id, store_id, channel, "
          "CASE WHEN channel = '5-LOW' THEN unit_price * 0.5 ELSE unit_price END AS price, "
          "CASE WHEN channel = '5-LOW' THEN 0 WHEN " + U("order_id, line_no, product_id", "disc", 0, 1) + " < 0.70 THEN 0 "
          "WHEN " + U("order_id, line_no, product_id", "disc", 0, 1) + " < 0.85 THEN 0.10 WHEN "
          + U("order_id, line_no, product_id", "disc", 0, 1) + " < 0.95 THEN 0.15 ELSE 0.20 END AS disc, quantity, "
          f"{RH('quantity * CASE WHEN channel = ' + repr('5-LOW') + ' THEN unit_price * 0.5 ELSE unit_price END')} AS gross, "
          f"{RH('quantity * CASE WHEN channel = ' + repr('5-LOW') + ' THEN unit_price * 0.5 ELSE unit_price END * (1 - CASE WHEN channel = ' + repr('5-LOW') + ' THEN 0 WHEN ' + U('order_id, line_no, product_id', 'disc', 0, 1) + ' < 0.70 THEN 0 WHEN ' + U('order_id, line_no, product_id', 'disc', 0, 1) + ' < 0.85 THEN 0.10 WHEN ' + U('order_id, line_no, product_id', 'disc', 0, 1) + ' < 0.95 THEN 0.15 ELSE 0.20 END)')} AS net, "
          f"{RH('quantity * unit_price * 0.4')} AS cogs FROM sales",
          dbl="price disc quantity gross net cogs", big="line_no")
def mart_price_lines(spark, d):
    """MART-30 sales line pricing: channel price choice (wholesale half price), discount ladder, gross/net/COGS."""
    from ..functions.expr import bucket, round_half
    s = Roles(spark, d).sales()
    wholesale = F.col("channel") == "5-LOW"
    price = F.when(wholesale, F.col("unit_price") * 0.5).otherwise(F.col("unit_price"))
    u = K.uniform(["order_id", "line_no", "product_id"], "disc", 0, 1)
    disc = F.when(wholesale, F.lit(0.0)).otherwise(bucket(u, [(0.70, 0.0), (0.85, 0.10), (0.95, 0.15)], 0.20))
    return s.select("order_id", "line_no", "product_id", "store_id", "channel", price.alias("price"), disc.alias("disc"),
                    "quantity", round_half(F.col("quantity") * price, 2).alias("gross"),
                    round_half(F.col("quantity") * price * (1 - disc), 2).alias("net"),
                    round_half(F.col("quantity") * F.col("unit_price") * 0.4, 2).alias("cogs"))


_CV_SQL = (
    f"WITH {R('sales')}, cf AS (SELECT customer_id, max(sale_date) AS last_date, min(sale_date) AS first_date, "
    f"count(DISTINCT order_id) AS total_orders, {RH('sum(net_revenue)', 6)} AS net, avg(CASE WHEN return_flag THEN 1.0 ELSE 0.0 END) AS return_rate, "
    "avg(CASE WHEN discount_pct > 0.05 THEN 1.0 ELSE 0.0 END) AS promo_share, "
    f"count(CASE WHEN date_diff('day', sale_date, DATE '{ORD}') <= 90 THEN 1 END) AS recent_lines "
    "FROM sales GROUP BY 1), "
    f"f1 AS (SELECT *, date_diff('day', last_date, DATE '{ORD}') AS days_since, "
    f"greatest(date_diff('day', first_date, DATE '{ORD}'), date_diff('day', last_date, DATE '{ORD}') + 30) AS tenure_days, "
    "net / total_orders AS aov FROM cf), "
    "f2 AS (SELECT *, least(greatest(total_orders / greatest(tenure_days / 91.25, 1.0), 0.1), 5.0) AS freq, "
    "greatest(date_diff('day', first_date, last_date) / greatest(total_orders - 1, 1), 30.0) AS gap, "
    "floor(10 * (1 - return_rate) + 0.5) AS satisfaction FROM f1), "
    "f3 AS (SELECT *, (days_since / gap) / (days_since / gap + 1) AS churn_risk FROM f2), "
    f"f4 AS (SELECT *, {RH('aov * freq * 4 * greatest(0.1, 1 - days_since / 365)')} AS total_spend_12m FROM f3) "
    f"SELECT customer_id, days_since, tenure_days, total_orders, {RH('freq', 4)} AS purchase_frequency, {RH('aov')} AS avg_order_value, "
    f"total_spend_12m, {RH('promo_share', 4)} AS promo_share, recent_lines, "
    f"CAST(satisfaction AS BIGINT) AS satisfaction, {RH('return_rate', 4)} AS return_rate, {RH('churn_risk', 4)} AS churn_probability, "
    f"{RH('least(greatest(days_since / 365, 0.01), 0.99)', 4)} AS legacy_churn_score, "
    f"{RH('aov * total_orders')} AS lifetime_value, "
    "CASE WHEN total_orders <= 2 AND tenure_days < 150 THEN 'New Customer' WHEN days_since > 270 THEN 'Lapsed' "
    "WHEN days_since > 180 THEN 'Win-Back Target' WHEN aov * total_orders >= 2500 AND churn_risk >= 0.5 THEN 'High-Value At-Risk' "
    "WHEN total_orders >= 12 AND churn_risk < 0.35 THEN 'Loyal VIP' WHEN recent_lines >= 3 AND total_orders <= 3 THEN 'Browser' "
    "ELSE 'Active Regular' END AS segment, "
    f"DATE '{ORD}' + CAST(least(365, floor(90 / freq * (1 + churn_risk) + 0.5)) AS INTEGER) AS predicted_next_purchase, "
    f"{RH('total_spend_12m * (1 - churn_risk) * 1.15')} AS clv_predicted_12m FROM f4")
_CV_DBL = ("purchase_frequency avg_order_value total_spend_12m promo_share return_rate churn_probability "
           "legacy_churn_score lifetime_value clv_predicted_12m")


@register("mart_customer_value", _CV_SQL, dbl=_CV_DBL)
def mart_customer_value(spark, d):
    """MART-36/37/38 + ML-15: customer features, churn risk, lifecycle segment (7 classes), next purchase, CLV."""
    return M.customer_value(Roles(spark, d).sales(), ORD)


@register("q08_segment_churn_risk", "SELECT segment, avg(churn_probability) AS avg_churn_probability, count(*) AS customers "
          f"FROM ({_CV_SQL}) AS cv GROUP BY segment", dbl="avg_churn_probability")
def q08_segment_churn_risk(spark, d):
    """Q-08 segments with the highest churn risk (metric 26 by segment)."""
    cv = M.customer_value(Roles(spark, d).sales(), ORD)
    return cv.groupBy("segment").agg(F.avg("churn_probability").alias("avg_churn_probability"),
                                     F.count(F.lit(1)).alias("customers"))


_CAMP_SQL = (
    "camp AS (SELECT s_suppkey AS campaign_id, ['Social','Search','Email','Display','Influencer'][CAST("
    + K.sql_hash32("s_suppkey", "ctype") + " % 5 AS INTEGER) + 1] AS campaign_type, "
    "DATE '2001-01-01' + CAST(" + K.sql_hash32("s_suppkey", "start") + " % 180 AS INTEGER) AS start_date, "
    "CAST(10 + " + K.sql_hash32("s_suppkey", "dur") + " % 30 AS INTEGER) AS duration, "
    "CAST(1000 + " + K.sql_hash32("s_suppkey", "budget") + " % 9000 AS DOUBLE) AS budget FROM supplier), "
    "camp2 AS (SELECT *, start_date + duration AS end_date FROM camp)")
_FK = "campaign_id, CAST(d AS VARCHAR)"
_FUNNEL_SQL = (
    f"WITH {_CAMP_SQL}, x AS (SELECT camp2.*, CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS d FROM camp2), "
    f"c AS (SELECT *, {RH('budget / (duration + 1) * ' + U(_FK, 'cost', 0.8, 1.2))} AS cost, {U(_FK, 'cpm', 4.0, 12.0)} AS cpm, "
    f"{U(_FK, 'ctr', 0.005, 0.03)} AS ctr, {U(_FK, 'cvr', 0.01, 0.05)} AS cvr, {U(_FK, 'aov', 60.0, 220.0)} AS aov FROM x), "
    "i AS (SELECT *, CAST(floor(cost / cpm * 1000 + 0.5) AS BIGINT) AS impressions FROM c), "
    "k AS (SELECT *, CAST(floor(impressions * ctr + 0.5) AS BIGINT) AS clicks FROM i), "
    "v AS (SELECT *, CAST(floor(clicks * cvr + 0.5) AS BIGINT) AS conversions FROM k), "
    f"fun AS (SELECT campaign_id, campaign_type, d AS perf_date, cost, impressions, clicks, conversions, {RH('conversions * aov')} AS revenue_attributed, "
    f"{RH('CASE WHEN cost = 0 THEN 0 ELSE conversions * aov / cost END')} AS roas FROM v) ")


@register("mart_campaign_funnel", _FUNNEL_SQL + "SELECT * FROM fun",
          dbl="cost revenue_attributed roas")
def mart_campaign_funnel(spark, d):
    """MART-34 daily campaign funnel (one campaign per supplier, one row per active day)."""
    return M.funnel(M.campaigns(scan(spark, d, "supplier"), ORD))


@register("q09_roas_by_type", _FUNNEL_SQL + "SELECT campaign_type, sum(revenue_attributed) AS total_campaign_revenue, "
          "sum(cost) AS total_campaign_cost, CASE WHEN sum(cost) = 0 THEN 0 ELSE sum(revenue_attributed) / sum(cost) END AS campaign_roas "
          "FROM fun GROUP BY 1", dbl="total_campaign_revenue total_campaign_cost campaign_roas")
def q09_roas_by_type(spark, d):
    """Q-09 ROAS by campaign type (metrics 28-30, DIV0 of sums)."""
    from ..functions.expr import div0
    f = M.funnel(M.campaigns(scan(spark, d, "supplier"), ORD))
    g = f.groupBy("campaign_type").agg(F.sum("revenue_attributed").alias("total_campaign_revenue"),
                                       F.sum("cost").alias("total_campaign_cost"))
    return g.withColumn("campaign_roas", div0("total_campaign_revenue", "total_campaign_cost"))


@register("mart_campaigns", f"WITH {_CAMP_SQL} SELECT campaign_id, campaign_type, start_date, duration, budget, end_date, "
          f"least(end_date, DATE '{ORD}') AS end_date_capped, CASE WHEN end_date < DATE '{ORD}' THEN 'Completed' "
          f"WHEN start_date > DATE '{ORD}' THEN 'Planned' ELSE 'Active' END AS status "
          "FROM camp2",
          dbl="budget", big="duration")
def mart_campaigns(spark, d):
    """MART-35 campaign attributes: capped end date, status."""
    return M.campaigns(scan(spark, d, "supplier"), ORD)


_INV_SQL = ("inv AS (SELECT l_partkey AS product_id, l_suppkey AS store_id, sum(l_quantity) AS units, sum(l_quantity) / 52.0 AS weekly_rate "
            "FROM lineitem GROUP BY 1, 2), inv2 AS (SELECT *, floor(" + U("product_id, store_id", "onhand", 0.0, 3.0)
            + " * weekly_rate + 0.5) AS on_hand_qty FROM inv)")


@register("mart_inventory", f"WITH {_INV_SQL} SELECT product_id, store_id, units, on_hand_qty, "
          f"{RH('CASE WHEN weekly_rate = 0 THEN 0 ELSE on_hand_qty / weekly_rate END', 1)} AS weeks_of_supply, "
          "ceil(weekly_rate * 2) AS reorder_point, on_hand_qty = 0 AS stockout_flag FROM inv2",
          dbl="units on_hand_qty weeks_of_supply reorder_point")
def mart_inventory(spark, d):
    """MART-39 inventory snapshot per (product, store)."""
    x = M.inventory(scan(spark, d, "lineitem"))
    return x.withColumns({"on_hand_qty": F.col("on_hand_qty").cast("double"), "reorder_point": F.col("reorder_point").cast("double")})


@register("mart_stockout_rate", "WITH p AS (SELECT l_partkey, l_suppkey, sum(l_quantity) / 52.0 * 2 AS rop FROM lineitem GROUP BY 1, 2), "
          "m AS (SELECT l_partkey, l_suppkey, month(l_shipdate) AS month, sum(l_quantity) AS u FROM lineitem GROUP BY 1, 2, 3) "
          "SELECT m.month, avg(CASE WHEN m.u > p.rop THEN 1.0 ELSE 0.0 END) AS stockout_rate FROM m JOIN p USING (l_partkey, l_suppkey) GROUP BY 1",
          dbl="stockout_rate")
def mart_stockout_rate(spark, d):
    """MART-40 stockout rate by calendar month (seasonal check)."""
    return M.stockout_rate(scan(spark, d, "lineitem"))


_FA_SQL = ("fa AS (SELECT g.*, p.p_retailprice, floor(g.actual_qty * " + U("product_id, CAST(forecast_date AS VARCHAR)", "fc", 0.7, 1.3)
           + " + 0.5) AS forecast_qty FROM (SELECT l_partkey AS product_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS forecast_date, "
           "sum(l_quantity) AS actual_qty FROM lineitem GROUP BY 1, 2) g LEFT JOIN part p ON g.product_id = p.p_partkey), "
           "fa2 AS (SELECT *, ['v1.0','v1.1','v2.0'][CAST(" + K.sql_hash32("product_id", "mv") + " % 3 AS INTEGER) + 1] AS model_version, "
           "abs(forecast_qty - actual_qty) / nullif(actual_qty, 0) AS ape FROM fa)")


@register("mart_forecast_accuracy", f"WITH {_FA_SQL} SELECT model_version, avg(ape) AS mape, count(*) AS n, "
          f"sum({RH('forecast_qty * p_retailprice * 0.82')}) AS forecast_revenue, sum({RH('actual_qty * p_retailprice * 0.82')}) AS actual_revenue "
          "FROM fa2 GROUP BY 1", dbl="mape forecast_revenue actual_revenue")
def mart_forecast_accuracy(spark, d):
    """MART-41 demand forecast accuracy: APE per (product, month), mean by model version."""
    f = M.forecast_accuracy(scan(spark, d, "lineitem"), scan(spark, d, "part"))
    return f.groupBy("model_version").agg(F.avg("ape").alias("mape"), F.count(F.lit(1)).alias("n"),
                                          F.sum("forecast_revenue").alias("forecast_revenue"),
                                          F.sum("actual_revenue").alias("actual_revenue"))


_SEASON = ("CASE WHEN month(x) BETWEEN 3 AND 5 THEN 'Spring' WHEN month(x) BETWEEN 6 AND 8 THEN 'Summer' "
           "WHEN month(x) BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END || ' ' || CAST(year(x) AS VARCHAR)")


@register("mart_assortment", "WITH j AS (SELECT p.p_type AS category, " + _SEASON.replace("x", "(CAST(date_trunc('month', l.l_shipdate) AS DATE) + INTERVAL 1 MONTH)")
          + " AS season, l.l_quantity, l.l_shipdate FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey), "
          "g AS (SELECT category, season, sum(l_quantity) AS actual_units, min(l_shipdate) AS s FROM j GROUP BY 1, 2), "
          "h AS (SELECT *, CAST(floor(actual_units * " + U("category, season", "plan", 0.8, 1.3) + " + 0.5) AS BIGINT) AS planned_units, "
          f"CAST(s AS DATE) > DATE '{ORD}' AS future FROM g), "
          "k AS (SELECT *, CASE WHEN planned_units = 0 THEN 0 ELSE actual_units / planned_units END AS st FROM h) "
          "SELECT category, season, planned_units, CASE WHEN future THEN NULL ELSE actual_units END AS actual_units, "
          f"CASE WHEN future THEN NULL ELSE {RH('st', 4)} END AS sell_through_pct, "
          f"CASE WHEN future THEN NULL ELSE {RH('least(greatest(1 - st, 0.0), 0.6)', 4)} END AS markdown_pct, "
          "CASE WHEN future THEN 'Planned' WHEN st >= 0.9 THEN 'On Track' WHEN st >= 0.7 THEN 'At Risk' ELSE 'Behind' END AS plan_status FROM k",
          dbl="actual_units sell_through_pct markdown_pct")
def mart_assortment(spark, d):
    """MART-42 assortment plan vs actual; NULL actuals for seasons after as_of."""
    return M.assortment(scan(spark, d, "lineitem"), scan(spark, d, "part"), ORD)


@register("mart_product_development", "WITH l AS (SELECT l_partkey, CAST(min(l_shipdate) AS DATE) AS launch_date, CAST(max(l_shipdate) AS DATE) AS last_sale, "
          "sum(l_quantity) AS units FROM lineitem GROUP BY 1) SELECT p_partkey AS product_id, p_brand AS product_line, launch_date, last_sale, units, "
          f"CASE WHEN launch_date IS NULL THEN 'Not launched' WHEN date_diff('day', launch_date, DATE '{ORD}') <= 365 THEN 'Ramping' "
          f"WHEN date_diff('day', last_sale, DATE '{ORD}') > 180 THEN 'Fading' ELSE 'Established' END AS current_stage "
          "FROM part LEFT JOIN l ON p_partkey = l_partkey", dbl="units")
def mart_product_development(spark, d):
    """MART-43 life stage of every product, measured on its sales."""
    return M.product_stage(scan(spark, d, "part"), scan(spark, d, "lineitem"), ORD)


@register("mart_product_attrs", "WITH l AS (SELECT l_partkey, min(l_shipdate) AS launch FROM lineitem GROUP BY 1) "
          "SELECT p.p_partkey AS product_id, " + _SEASON.replace("x", "l.launch") + " AS season, CAST(l.launch AS DATE) AS launch_date, "
          f"floor(p.p_retailprice / 10) + 0.99 AS msrp, {RH('(floor(p.p_retailprice / 10) + 0.99) * 0.5')} AS wholesale_price, "
          f"{RH('p.p_retailprice * 0.4')} AS unit_cost FROM part p LEFT JOIN l ON p.p_partkey = l.l_partkey",
          dbl="msrp wholesale_price unit_cost")
def mart_product_attrs(spark, d):
    """MART-44 product attributes: launch season label, .99 pricing, wholesale 50 %."""
    return M.product_attrs(scan(spark, d, "part"), scan(spark, d, "lineitem"))


_INTER_SQL = ("inter AS (SELECT l_partkey, CAST(CASE WHEN l_returnflag = 'N' THEN NULL ELSE least(5, l_linenumber) END AS DOUBLE) AS rating, "
              "l_discount > 0.03 AS added_to_cart, l_linestatus = 'F' AS purchased, l_returnflag = 'R' AS returned FROM lineitem), "
              f"inter2 AS (SELECT *, CASE WHEN rating IS NULL THEN NULL ELSE {RH('least(greatest((rating - 3) / 2, -1.0), 1.0)', 4)} END AS sentiment_score FROM inter), "
              "st AS (SELECT p.p_brand AS product_line, count(*) AS total_interactions, avg(rating) AS avg_rating, avg(sentiment_score) AS avg_sentiment, "
              "count(*) FILTER (WHERE added_to_cart) AS cart_add_count, count(*) FILTER (WHERE purchased) AS purchase_count, "
              "count(*) FILTER (WHERE returned) AS return_count FROM inter2 i JOIN part p ON i.l_partkey = p.p_partkey GROUP BY 1)")


@register("mart_interaction_stats", f"WITH {_INTER_SQL} SELECT * FROM st", dbl="avg_rating avg_sentiment")
def mart_interaction_stats(spark, d):
    """MART-45 / TXT-06 interaction metrics per product line (rating from reviews only, sentiment clamp((r-3)/2))."""
    return M.interaction_stats(M.interactions(scan(spark, d, "lineitem")), scan(spark, d, "part"))


@register("q10_lowest_rated_lines", f"WITH {_INTER_SQL} SELECT product_line, avg_rating, total_interactions FROM st "
          "ORDER BY avg_rating ASC NULLS LAST, product_line LIMIT 5", dbl="avg_rating")
def q10_lowest_rated_lines(spark, d):
    """Q-10 product lines by average rating, worst first."""
    st = M.interaction_stats(M.interactions(scan(spark, d, "lineitem")), scan(spark, d, "part"))
    return W.top_k(st.select("product_line", "avg_rating", "total_interactions"),
                   [F.col("avg_rating").asc_nulls_last(), F.asc("product_line")], 5)


@register("q11_top_lines_by_net", f"WITH {R('sales')} SELECT p.p_brand AS product_line, sum(s.net_revenue) AS total_net_revenue "
          "FROM sales s JOIN part p ON s.product_id = p.p_partkey GROUP BY 1 ORDER BY total_net_revenue DESC, product_line LIMIT 10",
          dbl="total_net_revenue")
def q11_top_lines_by_net(spark, d):
    """Q-11 top product lines by net revenue."""
    s = Roles(spark, d).sales()
    p = scan(spark, d, "part").select("p_partkey", "p_brand")
    g = s.join(p, s.product_id == p.p_partkey).groupBy(F.col("p_brand").alias("product_line")) \
        .agg(F.sum("net_revenue").alias("total_net_revenue"))
    return W.top_k(g, [F.desc("total_net_revenue"), F.asc("product_line")], 10)


@register("q12_dtc_vs_store", f"WITH {R('sales')} SELECT CASE WHEN channel IN ('1-URGENT', '2-HIGH') THEN 'DTC' ELSE 'Store' END AS channel_group, "
          "sum(net_revenue) AS total_net_revenue, CASE WHEN sum(net_revenue) = 0 THEN 0 ELSE (sum(net_revenue) - sum(cost_of_goods)) / sum(net_revenue) END AS gross_margin "
          "FROM sales GROUP BY 1", dbl="total_net_revenue gross_margin")
def q12_dtc_vs_store(spark, d):
    """Q-12 DTC vs store revenue and margin (metrics 32, 37)."""
    from ..functions.expr import div0
    s = Roles(spark, d).sales()
    g = s.groupBy(M.channel_group().alias("channel_group")).agg(F.sum("net_revenue").alias("total_net_revenue"),
                                                                F.sum("cost_of_goods").alias("_cogs"))
    return g.select("channel_group", "total_net_revenue",
                    div0(F.col("total_net_revenue") - F.col("_cogs"), F.col("total_net_revenue")).alias("gross_margin"))


@register("q13_referral_purchases", "SELECT ['search','social','email','direct','affiliate'][CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS INTEGER) + 1] "
          "AS referral_source, count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count, count(*) AS interactions FROM events GROUP BY 1")
def q13_referral_purchases(spark, d):
    """Q-13 referral sources driving purchases (source from the event payload)."""
    from ..functions.expr import pick_index
    from ..operators.aggs import count_if
    e = scan(spark, d, "events")
    src = pick_index(["search", "social", "email", "direct", "affiliate"],
                     F.get_json_object("props", "$.k").cast("bigint") % 5)
    return e.groupBy(src.alias("referral_source")).agg(count_if(F.col("event_type") == "purchase").alias("purchase_count"),
                                                       F.count(F.lit(1)).alias("interactions"))
