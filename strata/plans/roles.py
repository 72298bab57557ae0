"""Role frames: the reference's business tables expressed over the driver tables.

FIXTURES.md §6 maps each reference concept to driver columns.  Each role has a
Spark builder (lazy, column-pruned scans) and a DuckDB twin used by the SQL
oracle, so both sides derive from the same parquet files and scale with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import round_half
from ..sources.io import scan

# Fixed values (as-of dates chosen one day after the last event / order).
AS_OF_EVENTS = "2024-01-31"
AS_OF_ORDERS = "2001-08-02"
SPA_CITIES = ["Austin", "Boston", "Chicago", "Denver", "Seattle"]


def sessions_from_events(e: DataFrame) -> DataFrame:
    """Login sessions from events (batch or streaming frame)."""
    return e.select("user_id", F.col("event_id").alias("session_id"), F.col("ts").alias("log_in"),
                    F.least(F.col("value"), F.lit(99.9)).alias("minutes"), F.col("event_type").alias("device_type"))


def purchases_from_events(e: DataFrame) -> DataFrame:
    """Ad views / purchases from events (batch or streaming frame)."""
    buy = F.col("event_type") == "purchase"
    return e.select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("event_id").alias("ad_interaction_id"),
        F.when(buy, F.col("value")).otherwise(F.lit(0.0)).alias("purchase_amount"),
        F.when(buy, F.lit("in_app")).otherwise(F.lit("none")).alias("purchase_type"),
        F.col("event_type").alias("ad_type"), (F.floor("value").cast("bigint") % 28 + 1).alias("ad_engagement_time"),
        buy.alias("ad_conversion"), F.col("ts").alias("purchase_ts"))


class Roles:
    """Lazily built role frames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def t(self, name: str) -> DataFrame:
        return scan(self.spark, self.sf_dir, name)

    # ------------------------------------------------------------ player
    def ev_sessions(self) -> DataFrame:
        return sessions_from_events(self.t("events"))

    def ev_purchases(self) -> DataFrame:
        return purchases_from_events(self.t("events"))

    def users(self) -> DataFrame:
        c = self.t("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
        n = self.t("nation").select("n_nationkey", "n_name")
        first = self.t("orders").groupBy(F.col("o_custkey").alias("c_custkey")) \
            .agg(F.to_date(F.min("o_orderdate")).alias("account_creation"))
        u = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(first, "c_custkey", "left")
        return u.select(
            F.col("c_custkey").alias("user_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.when(F.col("c_custkey") % 2 == 0, F.lit("Female")).otherwise(F.lit("Male")).alias("gender"),
            F.col("n_name").alias("location"), (F.col("c_acctbal") >= 0).alias("consent"),
            F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int")).alias("birthdate"),
            "account_creation", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("acctbal"))

    def ord_purchases(self) -> DataFrame:
        o = self.t("orders")
        return o.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("purchase_id"),
                        F.col("o_totalprice").alias("purchase_amount"),
                        F.when(F.col("o_orderstatus") == "P", F.lit("none")).otherwise(F.lit("order"))
                        .alias("purchase_type"), F.col("o_orderdate").alias("purchase_ts"))

    def ord_sessions(self) -> DataFrame:
        o = self.t("orders")
        return o.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("session_id"),
                        F.col("o_orderdate").alias("log_in"),
                        F.timestamp_add("HOUR", F.lit(1), F.col("o_orderdate")).alias("log_out"),
                        round_half(F.col("o_totalprice") / 10000, 1).alias("minutes"))

    def tickets(self) -> DataFrame:
        o = self.t("orders").where(F.col("o_orderpriority") == "1-URGENT")
        return o.select(F.col("o_orderkey").alias("case_id"), F.col("o_custkey").alias("user_id"),
                        F.col("o_orderstatus").alias("category"),
                        (((F.col("o_totalprice") % 200) - 100) / 100).alias("sentiment"),
                        F.col("o_orderdate").alias("date_created"))

    def game_events(self) -> DataFrame:
        li = self.t("lineitem")
        o = self.t("orders").select("o_orderkey", "o_custkey")
        j = li.join(o, li.l_orderkey == o.o_orderkey)
        return j.select(
            F.col("o_custkey").alias("user_id"), F.col("l_orderkey").cast("string").alias("session_id"),
            F.col("l_linenumber").alias("kills"), F.col("l_quantity").alias("assists"),
            (F.col("l_extendedprice") / 100).alias("damage_dealt"), (F.col("l_tax") * 100).alias("distance_traveled"),
            (F.col("l_discount") * 100).alias("headshots"), (F.col("l_quantity") % 10).alias("heals"),
            (F.col("l_linenumber") % 5).alias("boosts"), (F.col("l_linenumber") % 6).alias("weapons_acquired"),
            (F.col("l_returnflag") == "R").alias("victory_royale"), (F.col("l_discount") > 0.05).alias("elimination_milestones"),
            (F.col("l_tax") == 0).alias("survival_achievements"), (F.col("l_linestatus") == "F").alias("building_resources"))

    # ------------------------------------------------------------ retail
    def customers(self) -> DataFrame:
        c = self.t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
        n = self.t("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.t("region")
        j = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, F.col("n_regionkey") == r.r_regionkey, "left")
        return j.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                        F.col("r_name").alias("region"), F.col("n_name").alias("country"),
                        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("acctbal"))

    def sales(self) -> DataFrame:
        li = self.t("lineitem")
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        p = self.t("part").select("p_partkey", "p_retailprice")
        j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey, "left")
        return j.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
            F.to_date("o_orderdate").alias("sale_date"), F.col("o_orderpriority").alias("channel"),
            F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("store_id"), F.col("l_quantity").alias("quantity"),
            F.col("p_retailprice").alias("unit_price"), F.col("l_discount").alias("discount_pct"),
            F.col("l_extendedprice").alias("gross_revenue"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_revenue"),
            (F.col("l_quantity") * F.col("p_retailprice") * 0.4).alias("cost_of_goods"),
            (F.col("l_returnflag") == "R").alias("return_flag"))

    # ------------------------------------------------------------ spa
    def appointments(self) -> DataFrame:
        e = self.t("events")
        city = F.get(F.array(*[F.lit(c) for c in SPA_CITIES]), (F.col("user_id") % 5).cast("int"))
        return e.select(
            F.col("event_id").alias("appointment_id"), F.col("user_id").alias("client_id"),
            city.alias("location_city"), F.col("event_type").alias("service_category"),
            F.to_date("ts").alias("appointment_date"),
            F.when(F.col("event_type") == "error", F.lit("cancelled")).otherwise(F.lit("completed"))
            .alias("appointment_status"),
            (30 + (F.col("event_id") % 4) * 15).alias("service_duration_mins"),
            F.when(F.col("event_id") % 3 == 0, F.lit("app")).otherwise(F.lit("phone")).alias("booking_source"),
            (F.col("event_id") % 14).alias("days_booked_in_advance"),
            F.col("value").alias("line_total"), round_half(F.col("value") * 0.15, 2).alias("tip_amount"))

    # ------------------------------------------------------------ screening
    def scr_orders(self) -> DataFrame:
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        c = self.t("customer").select("c_custkey", "c_nationkey")
        j = o.join(c, o.o_custkey == c.c_custkey, "left")
        return j.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("candidate_id"),
                        F.col("c_nationkey").alias("client_id"), F.to_date("o_orderdate").alias("order_date"),
                        F.col("o_orderstatus").alias("raw_status"))

    def clients(self) -> DataFrame:
        n = self.t("nation")
        return n.select(F.col("n_nationkey").alias("client_id"), F.col("n_name").alias("client_name"))

    def calls(self) -> DataFrame:
        """One call per conversation: turns joined in order as 'role: text' lines."""
        cv = self.t("conversations")
        g = cv.groupBy("conv_id").agg(
            F.array_sort(F.collect_list(F.struct("turn", F.concat_ws(": ", "role", "text").alias("line"))))
            .alias("_lines"), F.sum(F.length("text")).alias("_len"))
        return g.select(
            F.col("conv_id").cast("string").alias("contact_id"), F.col("conv_id").alias("order_id"),
            F.timestamp_add("HOUR", (F.col("conv_id") % 9 + 8).cast("int"),
                            F.date_add(F.lit("2001-06-01").cast("date"), (F.col("conv_id") % 60).cast("int"))
                            .cast("timestamp_ntz")).alias("started_at"),
            (F.col("_len") % 900 + 60).cast("bigint").alias("duration_sec"),
            F.concat_ws("\n", F.transform("_lines", lambda x: x["line"])).alias("transcript"))


# ---------------------------------------------------------------- DuckDB twins
ROLE_SQL = {
    "ev_sessions": "SELECT user_id, event_id AS session_id, ts AS log_in, least(value, 99.9) AS minutes, "
                   "event_type AS device_type FROM events",
    "ev_purchases": "SELECT user_id, event_id AS purchase_id, event_id AS ad_interaction_id, "
                    "CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS purchase_amount, "
                    "CASE WHEN event_type = 'purchase' THEN 'in_app' ELSE 'none' END AS purchase_type, "
                    "event_type AS ad_type, CAST(floor(value) AS BIGINT) % 28 + 1 AS ad_engagement_time, "
                    "event_type = 'purchase' AS ad_conversion, ts AS purchase_ts FROM events",
    "users": "SELECT c.c_custkey AS user_id, split_part(c.c_name, '#', 1) AS first_name, "
             "split_part(c.c_name, '#', 2) AS last_name, "
             "CASE WHEN c.c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender, n.n_name AS location, "
             "c.c_acctbal >= 0 AS consent, CAST(DATE '1960-01-01' + CAST(c.c_custkey % 15000 AS INTEGER) AS DATE) AS birthdate, "
             "f.account_creation, c.c_mktsegment AS segment, c.c_acctbal AS acctbal "
             "FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey "
             "LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS account_creation FROM orders GROUP BY 1) f "
             "ON f.o_custkey = c.c_custkey",
    "ord_purchases": "SELECT o_custkey AS user_id, o_orderkey AS purchase_id, o_totalprice AS purchase_amount, "
                     "CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE 'order' END AS purchase_type, "
                     "o_orderdate AS purchase_ts FROM orders",
    "ord_sessions": "SELECT o_custkey AS user_id, o_orderkey AS session_id, o_orderdate AS log_in, "
                    "o_orderdate + INTERVAL 1 HOUR AS log_out, floor(o_totalprice / 10000 * 10.0 + 0.5) / 10.0 AS minutes FROM orders",
    "tickets": "SELECT o_orderkey AS case_id, o_custkey AS user_id, o_orderstatus AS category, "
               "((o_totalprice % 200) - 100) / 100 AS sentiment, o_orderdate AS date_created "
               "FROM orders WHERE o_orderpriority = '1-URGENT'",
    "game_events": "SELECT o.o_custkey AS user_id, CAST(l.l_orderkey AS VARCHAR) AS session_id, "
                   "l.l_linenumber AS kills, l.l_quantity AS assists, l.l_extendedprice / 100 AS damage_dealt, "
                   "l.l_tax * 100 AS distance_traveled, l.l_discount * 100 AS headshots, l.l_quantity % 10 AS heals, "
                   "l.l_linenumber % 5 AS boosts, l.l_linenumber % 6 AS weapons_acquired, "
                   "l.l_returnflag = 'R' AS victory_royale, l.l_discount > 0.05 AS elimination_milestones, "
                   "l.l_tax = 0 AS survival_achievements, l.l_linestatus = 'F' AS building_resources "
                   "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey",
    "customers": "SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, r.r_name AS region, "
                 "n.n_name AS country, c.c_mktsegment AS segment, c.c_acctbal AS acctbal FROM customer c "
                 "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey",
    "sales": "SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, CAST(o.o_orderdate AS DATE) AS sale_date, "
             "o.o_orderpriority AS channel, o.o_custkey AS customer_id, l.l_partkey AS product_id, "
             "l.l_suppkey AS store_id, l.l_quantity AS quantity, p.p_retailprice AS unit_price, "
             "l.l_discount AS discount_pct, l.l_extendedprice AS gross_revenue, "
             "l.l_extendedprice * (1 - l.l_discount) AS net_revenue, "
             "l.l_quantity * p.p_retailprice * 0.4 AS cost_of_goods, l.l_returnflag = 'R' AS return_flag "
             "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
             "LEFT JOIN part p ON l.l_partkey = p.p_partkey",
    "appointments": "SELECT event_id AS appointment_id, user_id AS client_id, "
                    "['Austin','Boston','Chicago','Denver','Seattle'][CAST(user_id % 5 AS INTEGER) + 1] AS location_city, "
                    "event_type AS service_category, CAST(ts AS DATE) AS appointment_date, "
                    "CASE WHEN event_type = 'error' THEN 'cancelled' ELSE 'completed' END AS appointment_status, "
                    "30 + (event_id % 4) * 15 AS service_duration_mins, "
                    "CASE WHEN event_id % 3 = 0 THEN 'app' ELSE 'phone' END AS booking_source, "
                    "event_id % 14 AS days_booked_in_advance, value AS line_total, "
                    "floor(value * 0.15 * 100.0 + 0.5) / 100.0 AS tip_amount FROM events",
    "scr_orders": "SELECT o.o_orderkey AS order_id, o.o_custkey AS candidate_id, CAST(c.c_nationkey AS BIGINT) AS client_id, "
                  "CAST(o.o_orderdate AS DATE) AS order_date, o.o_orderstatus AS raw_status "
                  "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey",
    "clients": "SELECT CAST(n_nationkey AS BIGINT) AS client_id, n_name AS client_name FROM nation",
    "calls": "SELECT CAST(conv_id AS VARCHAR) AS contact_id, conv_id AS order_id, "
             "CAST(DATE '2001-06-01' + CAST(conv_id % 60 AS INTEGER) AS TIMESTAMP) "
             "+ to_hours(CAST(conv_id % 9 + 8 AS BIGINT)) AS started_at, "
             "CAST(sum(length(text)) % 900 + 60 AS BIGINT) AS duration_sec, "
             "string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript "
             "FROM conversations GROUP BY conv_id",
}


def R(*names: str) -> str:
    """CTE list for the given role names, for use after WITH in oracle SQL."""
    return ", ".join(f"{n} AS ({ROLE_SQL[n]})" for n in names)
