"""The four semantic models (player, retail, spa, screening) over the driver-table roles.

Tables that are marts reuse the registered mart queries (Spark) and their SQL
twins (oracle), so a metric over a mart is checked end to end.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from . import catalog
from .roles import ROLE_SQL, Roles
from .semantic import DerivedMetric, Dimension, Fact, Metric, Relationship, SemanticModel, Table

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _role(name):
    return lambda spark, d: getattr(Roles(spark, d), name)()


def _mart(name):
    return lambda spark, d: catalog.QUERIES[name](spark, d)


def _rsql(name):
    return f"({ROLE_SQL[name]})"


def _msql(name):
    return f"({catalog.ORACLE[name]})"


def _game(spark, d):
    return Roles(spark, d).game_events().withColumn("match_id", F.concat_ws("-", "session_id", F.col("kills").cast("string")))


def _interactions(spark, d):
    r = Roles(spark, d)
    li = r.t("lineitem")
    o = r.t("orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    rating = F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.least(F.lit(5), F.col("l_linenumber"))).cast("double")
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("interaction_id"), F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("page_views"),
        (F.col("l_linenumber") * 60.0).alias("session_duration_sec"), rating.alias("rating"),
        F.when(rating.isNull(), F.lit(None)).otherwise(F.least(F.greatest((rating - 3) / 2, F.lit(-1.0)), F.lit(1.0))).alias("sentiment_score"),
        (F.col("l_discount") > 0.03).alias("added_to_cart"), (F.col("l_linestatus") == "F").alias("purchased"),
        (F.col("l_returnflag") == "R").alias("returned"))


_INTER_SQL = ("(SELECT l.l_orderkey * 10 + l.l_linenumber AS interaction_id, o.o_custkey AS customer_id, l.l_partkey AS product_id, "
              "l.l_quantity AS page_views, l.l_linenumber * 60.0 AS session_duration_sec, "
              "CAST(CASE WHEN l.l_returnflag = 'N' THEN NULL ELSE least(5, l.l_linenumber) END AS DOUBLE) AS rating, "
              "CASE WHEN l.l_returnflag = 'N' THEN NULL ELSE least(greatest((least(5, l.l_linenumber) - 3) / 2, -1.0), 1.0) END AS sentiment_score, "
              "l.l_discount > 0.03 AS added_to_cart, l.l_linestatus = 'F' AS purchased, l.l_returnflag = 'R' AS returned "
              "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)")


def _products(spark, d):
    p = Roles(spark, d).t("part")
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                    F.col("p_brand").alias("product_line"), F.col("p_type").alias("category"))


def _stores(spark, d):
    r = Roles(spark, d)
    s, n, g = r.t("supplier"), r.t("nation"), r.t("region")
    j = s.join(n, s.s_nationkey == n.n_nationkey, "left").join(g, F.col("n_regionkey") == g.r_regionkey, "left")
    return j.select(F.col("s_suppkey").alias("store_id"), F.col("n_name").alias("store_country"), F.col("r_name").alias("store_region"))


def _calls(spark, d):
    r = Roles(spark, d)
    return r.calls().join(r.scr_orders().select("order_id", "candidate_id"), "order_id", "left")


@lru_cache(maxsize=None)
def player() -> SemanticModel:
    catalog.load_all()
    return SemanticModel(
        "player",
        tables=[Table("users", _role("users"), _rsql("users"), ["user_id"], "Players"),
                Table("sessions", _role("ev_sessions"), _rsql("ev_sessions"), ["session_id"], "Logins"),
                Table("purchases", _role("ev_purchases"), _rsql("ev_purchases"), ["purchase_id"], "Ad views and purchases"),
                Table("game", _game, "(SELECT *, session_id || '-' || CAST(kills AS VARCHAR) AS match_id FROM ("
                      + ROLE_SQL["game_events"] + "))", (), "Game events"),
                Table("retention", _mart("mart_retention"), _msql("mart_retention"), ["user_id"], "Retention mart")],
        relationships=[Relationship("sessions_user", "sessions", ["user_id"], "users", ["user_id"]),
                       Relationship("purchases_user", "purchases", ["user_id"], "users", ["user_id"]),
                       Relationship("game_user", "game", ["user_id"], "users", ["user_id"]),
                       Relationship("retention_user", "retention", ["user_id"], "users", ["user_id"])],
        dimensions=[Dimension("country", "users", "users.location", ["location", "nation"]),
                    Dimension("gender", "users", "users.gender"),
                    Dimension("segment", "users", "users.segment", ["market segment"], SEGMENTS),
                    Dimension("full_name", "users", "concat(users.first_name, ' ', users.last_name)", ["player name"]),
                    Dimension("device_type", "sessions", "sessions.device_type", ["device"]),
                    Dimension("login_date", "sessions", "CAST(sessions.log_in AS DATE)"),
                    Dimension("ad_type", "purchases", "purchases.ad_type"),
                    Dimension("purchase_date", "purchases", "CAST(purchases.purchase_ts AS DATE)")],
        facts=[Fact("purchase_value", "purchases", "purchases.purchase_amount"),
               Fact("session_minutes", "sessions", "sessions.minutes"),
               Fact("bought", "purchases", "CASE WHEN purchases.purchase_type != 'none' THEN 1 ELSE 0 END")],
        metrics=[Metric("total_players", "users", "count(users.user_id)", ["players", "player count"]),
                 Metric("total_sessions", "sessions", "count(sessions.session_id)", ["sessions"]),
                 Metric("avg_session_duration", "sessions", "avg({session_minutes})"),
                 Metric("total_revenue", "purchases", "sum({purchase_value})", ["revenue"]),
                 Metric("avg_purchase_amount", "purchases", "avg({purchase_value})"),
                 Metric("total_purchases", "purchases", "count(purchases.purchase_id)"),
                 Metric("ad_conversion_rate", "purchases", "avg(CASE WHEN purchases.ad_conversion THEN 1.0 ELSE 0.0 END)"),
                 Metric("bought_count", "purchases", "sum({bought})"),
                 Metric("total_matches", "game", "count(game.match_id)"),
                 Metric("avg_kills", "game", "avg(game.kills)"),
                 Metric("avg_damage", "game", "avg(game.damage_dealt)"),
                 Metric("total_kills", "game", "sum(game.kills)"),
                 Metric("churn_count", "retention", "sum(CASE WHEN retention.churned = 1 THEN 1 ELSE 0 END)"),
                 Metric("day1_retention_rate", "retention", "avg(CASE WHEN retention.logged_in_after_1_day THEN 1.0 ELSE 0.0 END)"),
                 Metric("day7_retention_rate", "retention", "avg(CASE WHEN retention.logged_in_after_7_days THEN 1.0 ELSE 0.0 END)")],
        derived=[DerivedMetric("revenue_per_player", "total_revenue / total_players", ["total_revenue", "total_players"])],
        default_filters={"purchases": "purchases.purchase_type != 'none'"},
        comment="Player analytics")


@lru_cache(maxsize=None)
def retail() -> SemanticModel:
    catalog.load_all()
    return SemanticModel(
        "retail",
        tables=[Table("sales", _role("sales"), _rsql("sales"), (), "Sales lines"),
                Table("customers", _role("customers"), _rsql("customers"), ["customer_id"]),
                Table("products", _products, "(SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS product_line, "
                      "p_type AS category FROM part)", ["product_id"]),
                Table("stores", _stores, "(SELECT s.s_suppkey AS store_id, n.n_name AS store_country, r.r_name AS store_region FROM supplier s "
                      "LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)", ["store_id"]),
                Table("interactions", _interactions, _INTER_SQL, ()),
                Table("ml_features", _mart("mart_customer_value"), _msql("mart_customer_value"), ["customer_id"]),
                Table("campaign_perf", _mart("mart_campaign_funnel"), _msql("mart_campaign_funnel"), ()),
                Table("kpi", _mart("mart_daily_kpi"), _msql("mart_daily_kpi"), (), "No key, no relationship (T16)")],
        relationships=[Relationship("sales_customer", "sales", ["customer_id"], "customers", ["customer_id"]),
                       Relationship("sales_product", "sales", ["product_id"], "products", ["product_id"]),
                       Relationship("sales_store", "sales", ["store_id"], "stores", ["store_id"]),
                       Relationship("inter_customer", "interactions", ["customer_id"], "customers", ["customer_id"]),
                       Relationship("inter_product", "interactions", ["product_id"], "products", ["product_id"]),
                       Relationship("features_customer", "ml_features", ["customer_id"], "customers", ["customer_id"])],
        dimensions=[Dimension("region", "customers", "customers.region", ["customer region"]),
                    Dimension("segment", "customers", "customers.segment", ["market segment"], SEGMENTS),
                    Dimension("customer_label", "customers", "concat(customers.customer_name, ' (', customers.country, ')')"),
                    Dimension("product_line", "products", "products.product_line", ["brand", "line"]),
                    Dimension("category", "products", "products.category"),
                    Dimension("store_region", "stores", "stores.store_region"),
                    Dimension("channel", "sales", "sales.channel", ["sales channel"]),
                    Dimension("sale_date", "sales", "sales.sale_date", ["date"]),
                    Dimension("sale_year", "sales", "year(sales.sale_date)"),
                    Dimension("predicted_segment", "ml_features", "ml_features.segment", ["lifecycle segment"]),
                    Dimension("campaign_type", "campaign_perf", "campaign_perf.campaign_type"),
                    Dimension("kpi_channel", "kpi", "kpi.channel"),
                    Dimension("kpi_region", "kpi", "kpi.region")],
        facts=[Fact("net", "sales", "sales.net_revenue"), Fact("cost", "sales", "sales.cost_of_goods"),
               Fact("margin_value", "sales", "sales.net_revenue - sales.cost_of_goods")],
        metrics=[Metric("total_interactions", "interactions", "count(interactions.interaction_id)"),
                 Metric("interaction_customers", "interactions", "count(DISTINCT interactions.customer_id)", ["unique interacting customers"]),
                 Metric("avg_page_views", "interactions", "avg(interactions.page_views)"),
                 Metric("avg_session_duration_sec", "interactions", "avg(interactions.session_duration_sec)"),
                 Metric("avg_sentiment", "interactions", "avg(interactions.sentiment_score)"),
                 Metric("avg_rating", "interactions", "avg(interactions.rating)"),
                 Metric("purchase_count", "interactions", "count(CASE WHEN interactions.purchased THEN 1 END)"),
                 Metric("return_count", "interactions", "count(CASE WHEN interactions.returned THEN 1 END)"),
                 Metric("cart_add_count", "interactions", "count(CASE WHEN interactions.added_to_cart THEN 1 END)"),
                 Metric("avg_lifetime_value", "ml_features", "avg(ml_features.lifetime_value)"),
                 Metric("avg_satisfaction", "ml_features", "avg(ml_features.satisfaction)"),
                 Metric("avg_churn_probability", "ml_features", "avg(ml_features.churn_probability)", ["churn risk"]),
                 Metric("avg_predicted_clv", "ml_features", "avg(ml_features.clv_predicted_12m)"),
                 Metric("total_campaign_revenue", "campaign_perf", "sum(campaign_perf.revenue_attributed)"),
                 Metric("total_campaign_cost", "campaign_perf", "sum(campaign_perf.cost)"),
                 Metric("campaign_roas", "campaign_perf", "CASE WHEN sum(campaign_perf.cost) = 0 THEN 0 ELSE sum(campaign_perf.revenue_attributed) / sum(campaign_perf.cost) END", ["roas"]),
                 Metric("total_gross_revenue", "sales", "sum(sales.gross_revenue)"),
                 Metric("total_net_revenue", "sales", "sum({net})", ["net revenue", "revenue"]),
                 Metric("total_orders", "sales", "count(sales.order_id)"),
                 Metric("total_units_sold", "sales", "sum(sales.quantity)"),
                 Metric("avg_order_value", "sales", "CASE WHEN count(sales.order_id) = 0 THEN 0 ELSE sum(sales.net_revenue) / count(sales.order_id) END", ["aov"]),
                 Metric("total_cogs", "sales", "sum({cost})"),
                 Metric("gross_margin", "sales", "CASE WHEN sum({net}) = 0 THEN 0 ELSE sum({margin_value}) / sum({net}) END", ["margin"]),
                 Metric("total_margin", "sales", "sum({margin_value})"),
                 Metric("avg_discount", "sales", "avg(sales.discount_pct)"),
                 Metric("return_rate", "sales", "CASE WHEN count(sales.order_id) = 0 THEN 0 ELSE count(CASE WHEN sales.return_flag THEN 1 END) / count(sales.order_id) END"),
                 Metric("sales_customers", "sales", "count(DISTINCT sales.customer_id)", ["unique customers"]),
                 Metric("total_kpi_gross_revenue", "kpi", "sum(kpi.gross_revenue)"),
                 Metric("total_kpi_net_revenue", "kpi", "sum(kpi.net_revenue)"),
                 Metric("total_kpi_orders", "kpi", "sum(kpi.orders)"),
                 Metric("total_new_customers", "kpi", "sum(kpi.new_customers)"),
                 Metric("total_repeat_customers", "kpi", "sum(kpi.repeat_customers)"),
                 Metric("avg_gross_margin", "kpi", "avg(kpi.gross_margin_pct)"),
                 Metric("avg_conversion_rate", "kpi", "avg(kpi.conversion_rate)"),
                 Metric("total_marketing_spend", "kpi", "sum(kpi.marketing_spend)"),
                 Metric("avg_cac", "kpi", "avg(kpi.cac)"),
                 Metric("avg_ltv_cac_ratio", "kpi", "avg(kpi.ltv_to_cac_ratio)")],
        derived=[DerivedMetric("revenue_per_interaction", "CASE WHEN total_interactions = 0 THEN 0 ELSE total_net_revenue / total_interactions END",
                               ["total_net_revenue", "total_interactions"])],
        comment="Retail sales")


@lru_cache(maxsize=None)
def spa() -> SemanticModel:
    catalog.load_all()
    return SemanticModel(
        "spa",
        tables=[Table("appointments", _role("appointments"), _rsql("appointments"), ["appointment_id"]),
                Table("daily_volume", _mart("mart_daily_volume"), _msql("mart_daily_volume"), ()),
                Table("providers", _mart("staff_providers"), _msql("staff_providers"), ["provider_id"])],
        relationships=[],
        dimensions=[Dimension("city", "appointments", "appointments.location_city", ["location"]),
                    Dimension("service_category", "appointments", "appointments.service_category", ["category"]),
                    Dimension("volume_city", "daily_volume", "daily_volume.location_city"),
                    Dimension("provider_city", "providers", "providers.location_city")],
        facts=[Fact("service_minutes", "appointments", "appointments.service_duration_mins")],
        metrics=[Metric("total_appointments", "appointments", "count(appointments.appointment_id)"),
                 Metric("avg_duration", "appointments", "avg({service_minutes})"),
                 Metric("total_volume", "daily_volume", "sum(daily_volume.appointment_count)"),
                 Metric("provider_count", "providers", "count(providers.provider_id)")],
        comment="Salon bookings")


@lru_cache(maxsize=None)
def screening() -> SemanticModel:
    catalog.load_all()
    return SemanticModel(
        "screening",
        tables=[Table("orders", _mart("mart_order_status"), _msql("mart_order_status"), ["order_id"]),
                Table("calls", _calls, f"(SELECT c.*, o.candidate_id FROM ({ROLE_SQL['calls']}) c LEFT JOIN ({ROLE_SQL['scr_orders']}) o "
                      "ON c.order_id = o.order_id)", ["contact_id"]),
                Table("clients", _role("clients"), _rsql("clients"), ["client_id"])],
        relationships=[Relationship("calls_order", "calls", ["order_id"], "orders", ["order_id"]),
                       Relationship("orders_client", "orders", ["client_id"], "clients", ["client_id"])],
        dimensions=[Dimension("client_name", "clients", "clients.client_name", ["client"]),
                    Dimension("current_status", "orders", "orders.current_status", ["status"],
                              ["In Progress", "On Hold", "Complete"]),
                    Dimension("current_component", "orders", "orders.current_component", ["component"])],
        facts=[Fact("call_minutes", "calls", "calls.duration_sec / 60")],
        metrics=[Metric("order_count", "orders", "count(DISTINCT orders.order_id)"),
                 Metric("avg_days_in_status", "orders", "avg(orders.days_in_status)"),
                 Metric("call_count", "calls", "count(calls.contact_id)"),
                 Metric("callers", "calls", "count(DISTINCT calls.candidate_id)"),
                 Metric("avg_duration_min", "calls", "avg({call_minutes})")],
        comment="Screening")


MODELS = {"player": player, "retail": retail, "spa": spa, "screening": screening}
