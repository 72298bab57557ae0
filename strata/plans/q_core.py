"""Primitive operators on the driver tables with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import keyed as K
from ..operators import aggs as A
from ..operators import joins as J
from ..operators import sets as S
from ..operators import windows as W
from ..session import shared_table_path
from ..sources import io
from .catalog import register
from .roles import AS_OF_EVENTS as EV, AS_OF_ORDERS as ORD, R, Roles


def T(spark, d, name):
    return io.scan(spark, d, name)


# ================================================================== sources
@register("src_scan_region", "SELECT r_regionkey, r_name FROM region", big="r_regionkey")
def src_scan_region(spark, d):
    """SRC-01 table scan by name."""
    return T(spark, d, "region")


@register("src_catalog_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in io.TABLES))
def src_catalog_counts(spark, d):
    """SRC-17 / SET-03 / QA-01 labelled row counts of every table."""
    return S.reconcile_counts(io.tables(spark, d))


@register("src_values_lookup", "SELECT v.label, count(*) AS orders FROM orders o JOIN (VALUES ('1-URGENT', 'urgent'), "
          "('2-HIGH', 'high'), ('3-MEDIUM', 'medium'), ('4-NOT SPECIFIED', 'unspecified'), ('5-LOW', 'low')) "
          "v(priority, label) ON o.o_orderpriority = v.priority GROUP BY v.label")
def src_values_lookup(spark, d):
    """SRC-07 inline VALUES relation (positional columns renamed) joined to orders."""
    v = io.values(spark, [("1-URGENT", "urgent"), ("2-HIGH", "high"), ("3-MEDIUM", "medium"),
                          ("4-NOT SPECIFIED", "unspecified"), ("5-LOW", "low")],
                  [("priority", "string"), ("label", "string")])
    o = T(spark, d, "orders")
    return o.join(J.broadcast_literal(v, 5), o.o_orderpriority == v.priority) \
        .groupBy("label").agg(F.count(F.lit(1)).alias("orders"))


@register("src_rows", "SELECT i % 7 AS bucket, count(*) AS n, sum(i) AS total FROM range(1, "
          "(SELECT count(*) FROM customer) + 1) t(i) GROUP BY 1", big="total")
def src_rows(spark, d):
    """SRC-08 row generator: 1..N with N = number of customers, distributed (spark.range)."""
    n = T(spark, d, "customer").count()
    return io.rows(spark, n).groupBy((F.col("i") % 7).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("i").alias("total"))


@register("src_spine_zero_fill", "WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e "
          "FROM orders), cal AS (SELECT CAST(generate_series AS DATE) AS d FROM b, generate_series(b.s, b.e, INTERVAL 1 DAY)), "
          "c AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) "
          "SELECT cal.d, coalesce(c.n, 0) AS orders FROM cal LEFT JOIN c ON cal.d = c.d")
def src_spine_zero_fill(spark, d):
    """SRC-09 day spine over the order-date range, zero-filled counts."""
    o = T(spark, d, "orders").select(F.to_date("o_orderdate").alias("d"))
    b = o.agg(F.min("d").alias("s"), F.max("d").alias("e"))
    cal = b.select(F.explode(F.sequence("s", "e", F.expr("INTERVAL 1 DAY"))).alias("d"))
    c = o.groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    return cal.join(c, "d", "left").select("d", F.coalesce("n", F.lit(0)).alias("orders"))


@register("src_month_spine", "SELECT CAST(generate_series AS DATE) AS m FROM generate_series("
          "(SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) FROM orders), "
          "(SELECT CAST(date_trunc('month', max(o_orderdate)) AS DATE) FROM orders), INTERVAL 1 MONTH)")
def src_month_spine(spark, d):
    """SRC-09 month spine across the orders' months."""
    o = T(spark, d, "orders")
    b = o.agg(F.trunc(F.min("o_orderdate"), "month").alias("s"), F.trunc(F.max("o_orderdate"), "month").alias("e"))
    return b.select(F.explode(F.sequence("s", "e", F.expr("INTERVAL 1 MONTH"))).alias("m"))


# ================================================================== projections / predicates
@register("src_csv_ingest", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal, CAST(c_acctbal AS BIGINT) < 0 AS in_debt, 'csv' AS load_source, "
          "DATE '2024-01-31' AS load_date FROM customer", dbl="c_acctbal")
def src_csv_ingest(spark, d):
    """SRC-02/03/10/11/14 CSV load: header skipped, quoted fields, empty fields null, a declared schema with
    comments, default columns, staged once and read through a view."""
    path = shared_table_path(spark, "csv")
    T(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").cast("string")) \
        .write.option("header", "true").option("quoteAll", "true").csv(path)
    sch = io.schema([("c_custkey", "bigint"), ("c_name", "string"), ("c_mktsegment", "string"), ("c_acctbal", "double")],
                    {"c_acctbal": "balance in dollars"})
    rows = io.conform(io.read_csv(spark, path, sch), sch)
    rows = io.stage(io.with_defaults(rows, {"load_source": "csv", "load_date": F.lit("2024-01-31").cast("date")}))
    io.view("strata_loaded_customers", rows)
    return spark.sql("SELECT c_custkey, c_name, c_mktsegment, c_acctbal, CAST(round(c_acctbal) AS BIGINT) < 0 AS in_debt, load_source, load_date "
                     "FROM strata_loaded_customers")


@register("src_retype_swap", "SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus FROM orders")
def src_retype_swap(spark, d):
    """SRC-15 type change of a catalog table's column with validation and a swap of names."""
    import uuid
    name, path = f"strata_retype_{uuid.uuid4().hex[:8]}", shared_table_path(spark, "retype")
    T(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus") \
        .write.option("path", path).saveAsTable(name)
    typed = shared_table_path(spark, "retyped")
    io.retype_table(spark, name, "o_custkey", "bigint", typed)
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry: the files stay where they are
    return spark.read.parquet(typed)


@register("prj_bucket_ladder", "SELECT CASE WHEN l_quantity < 10 THEN 'S' WHEN l_quantity < 25 THEN 'M' "
          "WHEN l_quantity < 40 THEN 'L' ELSE 'XL' END AS qty_band, count(*) AS n, sum(l_extendedprice) AS revenue "
          "FROM lineitem GROUP BY 1", dbl="revenue")
def prj_bucket_ladder(spark, d):
    """PRJ-01 ordered CASE ladder (first match wins)."""
    li = T(spark, d, "lineitem")
    return li.groupBy(X.bucket("l_quantity", [(10, "S"), (25, "M"), (40, "L")], "XL").alias("qty_band")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("revenue"))


@register("prj_map_value", "SELECT CASE o_orderstatus WHEN 'O' THEN 'In Progress' WHEN 'P' THEN 'On Hold' "
          "WHEN 'F' THEN 'Complete' ELSE 'Unknown' END AS status, count(*) AS n FROM orders GROUP BY 1")
def prj_map_value(spark, d):
    """PRJ-02 simple CASE value map with default."""
    o = T(spark, d, "orders")
    return o.groupBy(X.map_value("o_orderstatus", {"O": "In Progress", "P": "On Hold", "F": "Complete"},
                                 "Unknown").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@register("prj_iff_flags", "SELECT o_orderstatus, sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) AS big_orders, "
          "sum(CAST(o_orderpriority = '1-URGENT' AS INTEGER)) AS urgent FROM orders GROUP BY 1", big="big_orders urgent")
def prj_iff_flags(spark, d):
    """PRJ-04 IFF and boolean-to-flag."""
    o = T(spark, d, "orders")
    return o.groupBy("o_orderstatus").agg(F.sum(X.iff(F.col("o_totalprice") > 200000, 1, 0)).alias("big_orders"),
                                          F.sum((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("urgent"))


@register("prj_predicates", "SELECT event_type, count(*) FILTER (WHERE event_type != 'view') AS not_view, "
          "count(*) FILTER (WHERE event_type IN ('click', 'purchase')) AS engaged, "
          "count(*) FILTER (WHERE value = 0) AS zero_value, count(*) FILTER (WHERE props IS NOT NULL) AS with_props "
          "FROM events GROUP BY 1")
def prj_predicates(spark, d):
    """PRJ-05 boolean predicates as columns (!=, IN, = 0, IS NOT NULL)."""
    e = T(spark, d, "events")
    return e.groupBy("event_type").agg(
        A.count_if(F.col("event_type") != "view").alias("not_view"),
        A.count_if(F.col("event_type").isin("click", "purchase")).alias("engaged"),
        A.count_if(F.col("value") == 0).alias("zero_value"), A.count_if(F.col("props").isNotNull()).alias("with_props"))


@register("prj_filter_and_or", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE (o_orderstatus = 'O' AND "
          "o_totalprice > 100000) OR o_orderpriority = '1-URGENT' GROUP BY 1")
def prj_filter_and_or(spark, d):
    """PRJ-06 AND / OR filter with precedence (pushed into the parquet scan)."""
    o = T(spark, d, "orders")
    return o.where(((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000))
                   | (F.col("o_orderpriority") == "1-URGENT")).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@register("prj_isin", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def prj_isin(spark, d):
    """PRJ-07 IN list."""
    o = T(spark, d, "orders")
    return o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).groupBy("o_orderpriority") \
        .agg(F.count(F.lit(1)).alias("n"))


@register("prj_between_dates", "SELECT count(*) AS n, sum(o_totalprice) AS total FROM orders "
          "WHERE CAST(o_orderdate AS DATE) BETWEEN CAST('1998-01-01' AS DATE) AND CAST('1998-12-31' AS DATE)", dbl="total")
def prj_between_dates(spark, d):
    """PRJ-08 inclusive BETWEEN on dates with string parameters."""
    o = T(spark, d, "orders").where(X.between_dates("o_orderdate", "1998-01-01", "1998-12-31"))
    return o.agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))


@register("prj_last_n_days", f"SELECT event_type, count(*) AS n FROM events WHERE ts >= CAST(DATE '{EV}' - INTERVAL 7 DAY AS TIMESTAMP) GROUP BY 1")
def prj_last_n_days(spark, d):
    """PRJ-09 recency filter against an explicit as_of."""
    e = T(spark, d, "events").where(X.last_n_days("ts", 7, EV))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("prj_star_computed", "SELECT *, l_extendedprice * (1 - l_discount) AS net, "
          "l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem",
          dbl="l_quantity l_extendedprice l_discount l_tax net charge", big="l_linenumber")
def prj_star_computed(spark, d):
    """PRJ-10 SELECT x.*, computed columns."""
    li = T(spark, d, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.withColumns({"net": net, "charge": net * (1 + F.col("l_tax"))})


@register("prj_alias_reuse", "SELECT event_type, count(*) AS n, sum(value) AS total, sum(value) / count(*) AS mean_value "
          "FROM events GROUP BY 1", dbl="total mean_value")
def prj_alias_reuse(spark, d):
    """PRJ-11 aggregate aliases reused in the same SELECT (two steps)."""
    g = T(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.withColumn("mean_value", F.col("total") / F.col("n"))


@register("prj_sample_mod", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderkey % 10 = 0 GROUP BY 1")
def prj_sample_mod(spark, d):
    """PRJ-12 modulo sampling operator (the sampling is the feature)."""
    o = T(spark, d, "orders")
    return o.where(F.pmod("o_orderkey", F.lit(10)) == 0).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@register("prj_keyed_thin", "SELECT l_returnflag, count(*) AS kept FROM lineitem WHERE "
          + K.sql_u01("l_orderkey, l_linenumber, l_partkey", "thin")
          + " < CASE WHEN l_returnflag = 'R' THEN 0.5 ELSE 0.2 END GROUP BY 1")
def prj_keyed_thin(spark, d):
    """PRJ-13 keyed probabilistic thinning: keep a row when U(key) < rate(row)."""
    li = T(spark, d, "lineitem")
    keep = K.u01(["l_orderkey", "l_linenumber", "l_partkey"], "thin") < X.iff(F.col("l_returnflag") == "R", 0.5, 0.2)
    return li.where(keep).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("kept"))


@register("prj_casts", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, CAST(floor(o_totalprice) AS BIGINT) AS price_int, "
          "CAST(o_orderkey AS VARCHAR) AS key_str, CAST(o_custkey AS DOUBLE) AS cust_dbl FROM orders", dbl="cust_dbl")
def prj_casts(spark, d):
    """PRJ-14 casts (timestamp -> date, double -> bigint, number -> string)."""
    o = T(spark, d, "orders")
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"),
                    F.floor("o_totalprice").alias("price_int"),
                    F.col("o_orderkey").cast("string").alias("key_str"), F.col("o_custkey").cast("double").alias("cust_dbl"))


@register("prj_rename", "SELECT n_nationkey AS nation_id, n_name AS country FROM nation", big="nation_id")
def prj_rename(spark, d):
    """PRJ-15 rename / subset."""
    return T(spark, d, "nation").select(F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("country"))


@register("prj_null_when", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderdate AS DATE) + "
          "CAST(o_orderkey % 7 + 1 AS INTEGER) END AS eta FROM orders")
def prj_null_when(spark, d):
    """PRJ-16 conditional NULL-out for closed records."""
    o = T(spark, d, "orders")
    eta = F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 7 + 1).cast("int"))
    return o.select("o_orderkey", X.null_when(F.col("o_orderstatus") == "F", eta).alias("eta"))


# ================================================================== joins
@register("join_inner", "SELECT c.c_mktsegment, count(*) AS orders, sum(o.o_totalprice) AS revenue FROM orders o "
          "JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1", dbl="revenue")
def join_inner(spark, d):
    """JOIN-01 inner equi join (AQE chooses broadcast from the measured customer size)."""
    o, c = T(spark, d, "orders"), T(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).groupBy("c_mktsegment") \
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("revenue"))


@register("join_lookup_star", "SELECT r.r_name, p.p_type, sum(l.l_extendedprice * (1 - l.l_discount)) AS revenue, count(*) AS n "
          "FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey "
          "LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey "
          "GROUP BY 1, 2", dbl="revenue")
def join_lookup_star(spark, d):
    """JOIN-02 multi-lookup star join (part, supplier, nation, region)."""
    li = T(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice", "l_discount")
    p, s = T(spark, d, "part").select("p_partkey", "p_type"), T(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    n, r = T(spark, d, "nation"), T(spark, d, "region")
    x = J.lookup_star(li, [(p, li.l_partkey == p.p_partkey), (s, F.col("l_suppkey") == s.s_suppkey),
                           (n, F.col("s_nationkey") == n.n_nationkey), (r, F.col("n_regionkey") == r.r_regionkey)])
    return x.groupBy("r_name", "p_type").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
                                             F.count(F.lit(1)).alias("n"))


@register("join_enrich", "SELECT c.c_custkey, c.c_name, o.n_orders, o.spend, l.n_lines FROM customer c "
          "LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS spend FROM orders GROUP BY 1) o ON c.c_custkey = o.o_custkey "
          "LEFT JOIN (SELECT o.o_custkey, count(*) AS n_lines FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1) l "
          "ON c.c_custkey = l.o_custkey", dbl="spend")
def join_enrich(spark, d):
    """JOIN-03 several per-key aggregates left-joined onto the entity."""
    c = T(spark, d, "customer").select("c_custkey", "c_name")
    o = T(spark, d, "orders")
    oa = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"),
                                                               F.sum("o_totalprice").alias("spend"))
    li = T(spark, d, "lineitem").select("l_orderkey")
    la = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey) \
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_lines"))
    return J.enrich(c, "c_custkey", oa, la)


@register("join_left_default", "SELECT n.n_nationkey, n.n_name, coalesce(s.n_suppliers, 0) AS n_suppliers, "
          "coalesce(s.balance, 0.0) AS balance FROM nation n LEFT JOIN (SELECT s_nationkey, count(*) AS n_suppliers, "
          "sum(s_acctbal) AS balance FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) s ON n.n_nationkey = s.s_nationkey",
          dbl="balance", big="n_nationkey")
def join_left_default(spark, d):
    """JOIN-04 left outer with default 0 for missing keys."""
    n = T(spark, d, "nation").select("n_nationkey", "n_name")
    s = T(spark, d, "supplier").where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("n_nationkey")) \
        .agg(F.count(F.lit(1)).alias("n_suppliers"), F.sum("s_acctbal").alias("balance"))
    return J.left_default(n, s, ["n_nationkey"], {"n_suppliers": 0, "balance": 0.0})


@register("join_grid", "SELECT r.r_name, p.o_orderpriority, coalesce(c.n, 0) AS orders FROM region r "
          "CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p LEFT JOIN (SELECT r.r_name, o.o_orderpriority, count(*) AS n "
          "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey "
          "JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2) c ON c.r_name = r.r_name AND c.o_orderpriority = p.o_orderpriority")
def join_grid(spark, d):
    """JOIN-05 grid of two small dimensions, left-joined to fact counts."""
    o, c, n, r = (T(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    pr = o.select("o_orderpriority").distinct()
    g = J.grid(r.select("r_name"), pr)
    f = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey) \
        .join(r, F.col("n_regionkey") == r.r_regionkey).groupBy("r_name", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return g.join(f, ["r_name", "o_orderpriority"], "left").select("r_name", "o_orderpriority",
                                                                     F.coalesce("n", F.lit(0)).alias("orders"))


@register("join_with_scalar", "SELECT o_orderpriority, count(*) AS n, count(*) / (SELECT count(*) FROM orders) AS share "
          "FROM orders GROUP BY 1", dbl="share")
def join_with_scalar(spark, d):
    """JOIN-06 cross join with a 1-row scalar (total)."""
    o = T(spark, d, "orders")
    g = o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    x = J.with_scalar(g, o.agg(F.count(F.lit(1)).alias("_total")))
    return x.select("o_orderpriority", "n", (F.col("n") / F.col("_total")).alias("share"))


_BAL_TIERS = [("negative", -1.0e9, 0.0), ("low", 0.0, 2500.0), ("mid", 2500.0, 7500.0), ("high", 7500.0, 1.0e9)]


@register("join_tier_range", "SELECT t.tier, count(*) AS customers FROM customer c LEFT JOIN (VALUES ('negative', -1.0e9, 0.0), "
          "('low', 0.0, 2500.0), ('mid', 2500.0, 7500.0), ('high', 7500.0, 1.0e9)) t(tier, lower_bound, upper_bound) "
          "ON c.c_acctbal >= t.lower_bound AND c.c_acctbal < t.upper_bound GROUP BY 1")
def join_tier_range(spark, d):
    """JOIN-07 half-open range join to a small literal tier table."""
    tiers = spark.createDataFrame(_BAL_TIERS, "tier string, lower_bound double, upper_bound double")
    c = T(spark, d, "customer")
    return J.tier_join(c, "c_acctbal", tiers, n_tiers=4).groupBy("tier").agg(F.count(F.lit(1)).alias("customers"))


@register("join_range_binned", "SELECT s.s_suppkey, count(o.o_orderkey) AS orders_in_band FROM supplier s "
          "JOIN orders o ON o.o_totalprice >= s.s_acctbal * 50 AND o.o_totalprice < s.s_acctbal * 50 + 5000 GROUP BY 1")
def join_range_binned(spark, d):
    """JOIN-08 range join to a large interval table: slots between quantile cut points, sorted sweep;
    matches are counted where they are found."""
    s = T(spark, d, "supplier").select("s_suppkey", (F.col("s_acctbal") * 50).alias("lo"),
                                       (F.col("s_acctbal") * 50 + 5000).alias("hi"))
    o = T(spark, d, "orders").select("o_orderkey", "o_totalprice")
    x = J.range_join(o, "o_totalprice", s, "lo", "hi", count={"orders_in_band": "o_orderkey"})
    return x.groupBy("s_suppkey").agg(F.sum("orders_in_band").alias("orders_in_band"))


@register("join_validity", "WITH w AS (SELECT o_custkey, min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders GROUP BY 1) "
          "SELECT o.o_custkey, count(*) AS lines_in_window FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
          "JOIN w ON w.o_custkey = o.o_custkey WHERE l.l_shipdate BETWEEN w.s AND w.e GROUP BY 1")
def join_validity(spark, d):
    """JOIN-09 event date BETWEEN the entity's first and last date."""
    o = T(spark, d, "orders")
    w = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
    li = T(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    ev = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
    return J.valid_join(ev, w, "o_custkey", "l_shipdate", "s", "e").groupBy("o_custkey") \
        .agg(F.count(F.lit(1)).alias("lines_in_window"))


@register("join_expand_days", "SELECT dayofweek(d) AS dow, count(*) AS order_days FROM (SELECT unnest(generate_series("
          "CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER), INTERVAL 1 DAY)) AS d "
          "FROM orders) GROUP BY 1")
def join_expand_days(spark, d):
    """JOIN-10 one row per day of [start, end]."""
    o = T(spark, d, "orders").select(F.to_date("o_orderdate").alias("s"),
                                     F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 5).cast("int")).alias("e"))
    x = J.expand_days(o, "s", "e")
    return x.groupBy(X.dow_sun0("d").alias("dow")).agg(F.count(F.lit(1)).alias("order_days"))


@register("join_anti", "SELECT c.c_mktsegment, count(*) AS customers_without_orders FROM customer c "
          "LEFT JOIN orders o ON c.c_custkey = o.o_custkey WHERE o.o_custkey IS NULL GROUP BY 1")
def join_anti(spark, d):
    """JOIN-13 LEFT JOIN ... IS NULL as a left anti join."""
    c, o = T(spark, d, "customer"), T(spark, d, "orders")
    return J.anti(c, o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey") \
        .groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers_without_orders"))


@register("join_semi_exists", "SELECT c.c_mktsegment, count(*) AS customers, "
          "count(*) FILTER (WHERE c.c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')) AS with_urgent "
          "FROM customer c WHERE c.c_custkey IN (SELECT o_custkey FROM orders) GROUP BY 1")
def join_semi_exists(spark, d):
    """JOIN-14 semi join and existence flag (no fan-out with several matches)."""
    c, o = T(spark, d, "customer"), T(spark, d, "orders")
    buyers = J.semi(c, o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")
    urgent = o.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    x = J.exists_flag(buyers, urgent, "c_custkey", "has_urgent")
    return x.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"), A.count_if(F.col("has_urgent")).alias("with_urgent"))


@register("join_pick_positional", "WITH p AS (SELECT p_partkey, p_type, row_number() OVER (ORDER BY p_partkey) AS rn FROM part), "
          "n AS (SELECT count(*) AS n FROM part), o AS (SELECT o_orderkey, 1 + "
          + K.sql_hash32("o_orderkey", "pick") + " % (SELECT n FROM n) AS idx FROM orders) "
          "SELECT p.p_type, count(*) AS orders FROM o JOIN p ON o.idx = p.rn GROUP BY 1")
def join_pick_positional(spark, d):
    """JOIN-17 positional pick: random 1..N index joined to the target's row number."""
    p = T(spark, d, "part").select("p_partkey", "p_type")
    pr = W.row_number_distributed(p, ["p_partkey"], "rn")
    n = p.agg(F.count(F.lit(1)).alias("_n"))
    o = J.with_scalar(T(spark, d, "orders").select("o_orderkey"), n)
    o = o.select("o_orderkey", (F.lit(1) + F.pmod(K.hash32("o_orderkey", "pick"), F.col("_n"))).alias("idx"))
    return J.pick_join(o, "idx", pr, "rn").groupBy("p_type").agg(F.count(F.lit(1)).alias("orders"))


# ================================================================== aggregates
@register("agg_count", "SELECT o_orderstatus, count(*) AS n_rows, count(o_orderpriority) AS n_priority FROM orders GROUP BY 1")
def agg_count(spark, d):
    """AGG-01 COUNT(*) and COUNT(col)."""
    return T(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"),
                                                              F.count("o_orderpriority").alias("n_priority"))


@register("agg_count_distinct", "SELECT event_type, count(DISTINCT user_id) AS users, "
          "count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY 1")
def agg_count_distinct(spark, d):
    """AGG-02 several COUNT(DISTINCT) per group."""
    return T(spark, d, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"),
                                                           F.countDistinct(F.to_date("ts")).alias("days"))


@register("agg_conditional", "SELECT l_returnflag, count(*) FILTER (WHERE l_discount > 0.05) AS deep_discount, "
          "count(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_orderkey END) AS open_orders, "
          "sum(CASE WHEN l_tax = 0 THEN l_extendedprice END) AS untaxed_revenue, "
          "avg(CASE WHEN l_quantity > 25 THEN l_discount END) AS bulk_discount FROM lineitem GROUP BY 1",
          dbl="untaxed_revenue bulk_discount")
def agg_conditional(spark, d):
    """AGG-03/04/05 COUNT_IF, COUNT(DISTINCT CASE), SUM/AVG over CASE."""
    li = T(spark, d, "lineitem")
    return li.groupBy("l_returnflag").agg(
        A.count_if(F.col("l_discount") > 0.05).alias("deep_discount"),
        A.count_distinct_if(F.col("l_linestatus") == "O", "l_orderkey").alias("open_orders"),
        A.sum_if(F.col("l_tax") == 0, "l_extendedprice").alias("untaxed_revenue"),
        A.avg_if(F.col("l_quantity") > 25, "l_discount").alias("bulk_discount"))


@register("agg_pricing_summary", "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, "
          "sum(l_extendedprice) AS sum_base_price, sum(l_extendedprice * (1 - l_discount)) AS sum_disc_price, "
          "sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS sum_charge, avg(l_quantity) AS avg_qty, "
          "avg(l_extendedprice) AS avg_price, avg(l_discount) AS avg_disc, min(l_shipdate) AS first_ship, "
          "max(l_shipdate) AS last_ship, count(*) AS count_order FROM lineitem GROUP BY 1, 2",
          dbl="sum_qty sum_base_price sum_disc_price sum_charge avg_qty avg_price avg_disc")
def agg_pricing_summary(spark, d):
    """AGG-06 SUM / AVG / MIN / MAX per group."""
    li = T(spark, d, "lineitem")
    disc = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.sum("l_extendedprice").alias("sum_base_price"),
        F.sum(disc).alias("sum_disc_price"), F.sum(disc * (1 + F.col("l_tax"))).alias("sum_charge"),
        F.avg("l_quantity").alias("avg_qty"), F.avg("l_extendedprice").alias("avg_price"),
        F.avg("l_discount").alias("avg_disc"), F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"), F.count(F.lit(1)).alias("count_order"))


@register("agg_any_rate", "SELECT count(*) FILTER (WHERE bought) AS buyers, avg(CASE WHEN bought THEN 1.0 ELSE 0.0 END) AS buyer_rate "
          "FROM (SELECT user_id, bool_or(event_type = 'purchase' AND value > 300) AS bought FROM events GROUP BY 1)",
          dbl="buyer_rate")
def agg_any_rate(spark, d):
    """AGG-07 MAX of boolean (= any) and AGG-08 rate."""
    u = T(spark, d, "events").groupBy("user_id").agg(
        A.any_((F.col("event_type") == "purchase") & (F.col("value") > 300)).alias("bought"))
    return u.agg(A.count_if(F.col("bought")).alias("buyers"), A.rate(F.col("bought")).alias("buyer_rate"))


@register("agg_return_rate_by_year", "SELECT year(l_shipdate) AS ship_year, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) "
          "AS return_rate FROM lineitem GROUP BY 1", dbl="return_rate")
def agg_return_rate_by_year(spark, d):
    """AGG-08 rate = AVG(1.0 / 0.0) per group."""
    li = T(spark, d, "lineitem")
    return li.groupBy(F.year("l_shipdate").alias("ship_year")).agg(A.rate(F.col("l_returnflag") == "R").alias("return_rate"))


@register("agg_new_repeat", f"WITH {R('sales')}, f AS (SELECT customer_id, min(sale_date) AS first_sale FROM sales GROUP BY 1) "
          "SELECT year(s.sale_date) AS sale_year, s.channel, "
          "count(DISTINCT CASE WHEN s.sale_date = f.first_sale THEN s.customer_id END) AS new_customers, "
          "count(DISTINCT s.customer_id) - count(DISTINCT CASE WHEN s.sale_date = f.first_sale THEN s.customer_id END) AS repeat_customers "
          "FROM sales s JOIN f ON s.customer_id = f.customer_id GROUP BY 1, 2")
def agg_new_repeat(spark, d):
    """AGG-09 new vs repeat distinct customers (first date over the whole fact)."""
    s = Roles(spark, d).sales().withColumn("sale_year", F.year("sale_date"))
    return A.new_repeat(s, "customer_id", "sale_date", ["sale_year", "channel"])


@register("agg_rollup2", "SELECT o.o_orderpriority, avg(x.order_value) AS avg_order_value, max(x.lines) AS max_lines FROM "
          "(SELECT l_orderkey, sum(l_extendedprice) AS order_value, count(*) AS lines FROM lineitem GROUP BY 1) x "
          "JOIN orders o ON x.l_orderkey = o.o_orderkey GROUP BY 1", dbl="avg_order_value")
def agg_rollup2(spark, d):
    """AGG-10 pre-aggregate per order, then roll up per priority."""
    li, o = T(spark, d, "lineitem"), T(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    per = li.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("order_value"), F.count(F.lit(1)).alias("lines"))
    return per.join(o, per.l_orderkey == o.o_orderkey).groupBy("o_orderpriority").agg(
        F.avg("order_value").alias("avg_order_value"), F.max("lines").alias("max_lines"))


@register("agg_group_by_expr", "SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, "
          "count(*) AS n FROM orders GROUP BY 1, 2")
def agg_group_by_expr(spark, d):
    """AGG-11 group by expressions (month string, truncated month)."""
    o = T(spark, d, "orders")
    return o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"),
                     F.trunc("o_orderdate", "month").alias("month_start")).agg(F.count(F.lit(1)).alias("n"))


@register("agg_distinct_pairs", "SELECT DISTINCT user_id, event_type FROM events")
def agg_distinct_pairs(spark, d):
    """AGG-12 DISTINCT via GROUP BY without aggregate."""
    return T(spark, d, "events").select("user_id", "event_type").distinct()


@register("agg_safe_ratios", "SELECT o_orderpriority, CASE WHEN sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) = 0 THEN 0 "
          "ELSE count(*) / sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) END AS div0_ratio, "
          "coalesce(sum(o_totalprice) / nullif(sum(CASE WHEN o_orderstatus = 'X' THEN 1 ELSE 0 END), 0), 0) AS nullif_ratio, "
          "CASE WHEN count(*) > 0 THEN sum(o_totalprice) / count(*) ELSE 0 END AS case_ratio FROM orders GROUP BY 1",
          dbl="div0_ratio nullif_ratio case_ratio")
def agg_safe_ratios(spark, d):
    """AGG-13 ratio of aggregates with zero guards (DIV0, NULLIF+COALESCE, CASE > 0)."""
    o = T(spark, d, "orders")
    g = o.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum(X.flag(F.col("o_orderstatus") == "P")).alias("p"),
        F.sum(X.flag(F.col("o_orderstatus") == "X")).alias("x"), F.sum("o_totalprice").alias("t"))
    return g.select("o_orderpriority", X.div0("n", "p").alias("div0_ratio"),
                    F.coalesce(X.safe_div("t", "x"), F.lit(0.0)).alias("nullif_ratio"),
                    X.safe_ratio("t", "n", 0.0).alias("case_ratio"))


@register("agg_summary", "SELECT count(*) AS events, count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types, "
          "sum(value) AS total_value, avg(value) AS mean_value, min(ts) AS first_ts, max(ts) AS last_ts FROM events",
          dbl="total_value mean_value")
def agg_summary(spark, d):
    """AGG-14 global one-row summary with 7 measures."""
    return A.summary(T(spark, d, "events"), {
        "events": F.count(F.lit(1)), "users": F.countDistinct("user_id"), "types": F.countDistinct("event_type"),
        "total_value": F.sum("value"), "mean_value": F.avg("value"), "first_ts": F.min("ts"), "last_ts": F.max("ts")})


@register("agg_mode_share", "WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), "
          "t AS (SELECT user_id, event_type AS top_event_type, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r FROM c) "
          "SELECT t.user_id, t.top_event_type, s.share_purchase, s.n_types FROM t JOIN (SELECT user_id, "
          "avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END) AS share_purchase, count(DISTINCT event_type) AS n_types "
          "FROM events GROUP BY 1) s ON s.user_id = t.user_id WHERE t.r = 1", dbl="share_purchase")
def agg_mode_share(spark, d):
    """AGG-15 argmax category and share; AGG-16 nunique per entity."""
    e = T(spark, d, "events")
    top = A.mode_and_share(e, "user_id", "event_type", "purchase")
    nu = e.groupBy("user_id").agg(F.countDistinct("event_type").alias("n_types"))
    return top.join(nu, "user_id")


@register("agg_avg_gap", "SELECT o_custkey, CASE WHEN count(*) >= 2 THEN date_diff('day', min(CAST(o_orderdate AS DATE)), "
          "max(CAST(o_orderdate AS DATE))) / (count(*) - 1) ELSE 0.0 END AS avg_gap_days FROM orders GROUP BY 1", dbl="avg_gap_days")
def agg_avg_gap(spark, d):
    """AGG-17 mean inter-event gap per entity (0 with fewer than 2 events)."""
    return A.avg_gap(T(spark, d, "orders"), "o_custkey", "o_orderdate")


@register("agg_value_counts", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def agg_value_counts(spark, d):
    """AGG-18 value counts."""
    return A.value_counts(T(spark, d, "lineitem"), "l_returnflag")


# ================================================================== windows / sort
@register("win_rank_percentile", "SELECT c_custkey, c_acctbal, rank() OVER (ORDER BY c_acctbal DESC) AS rank, "
          "count(*) OVER () AS total, (rank() OVER (ORDER BY c_acctbal DESC) - 1) / CAST(count(*) OVER () AS DOUBLE) * 100 AS percentile "
          "FROM customer", dbl="c_acctbal percentile")
def win_rank_percentile(spark, d):
    """WIN-01/02/03 global RANK, COUNT(*) OVER (), rank percentile - distributed."""
    c = T(spark, d, "customer").select("c_custkey", "c_acctbal")
    r = W.rank_distributed(c, "c_acctbal", "rank", with_total="total")
    return r.withColumn("percentile", (F.col("rank") - 1) / F.col("total").cast("double") * 100)


@register("win_rank_orders", "SELECT o_orderkey, rank() OVER (ORDER BY o_totalprice DESC) AS price_rank FROM orders")
def win_rank_orders(spark, d):
    """WIN-09 RANK over 15k+ values (ties share a rank), distributed."""
    return W.rank_desc(T(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "price_rank") \
        .drop("o_totalprice")


@register("win_first_date", "SELECT o_orderkey, o_custkey, CAST(min(o_orderdate) OVER (PARTITION BY o_custkey) AS DATE) AS first_order "
          "FROM orders")
def win_first_date(spark, d):
    """WIN-04 MIN over the entity partition."""
    o = T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return W.first_date(o, "o_custkey", "o_orderdate", "first_order").select(
        "o_orderkey", "o_custkey", F.to_date("first_order").alias("first_order"))


@register("win_row_number", "SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice, p_partkey) AS rn FROM part")
def win_row_number(spark, d):
    """WIN-05/08 ROW_NUMBER by a total order, distributed (no single-task window)."""
    p = T(spark, d, "part").select("p_partkey", "p_retailprice")
    return W.row_number_distributed(p, ["p_retailprice", "p_partkey"], "rn").drop("p_retailprice")


@register("win_surrogate_id", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'L' || lpad(CAST(row_number() OVER "
          "(ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) AS VARCHAR), 9, '0') "
          "AS line_id FROM lineitem", big="l_linenumber")
def win_surrogate_id(spark, d):
    """WIN-06 formatted surrogate id over a composite order (full tiebreak)."""
    li = T(spark, d, "lineitem")
    x = W.surrogate(li, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                         "l_quantity", "l_discount", "l_tax"], "L", 9, "line_id")
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "line_id")


@register("win_slot_index", "SELECT n.n_nationkey, s.slot, row_number() OVER (ORDER BY n.n_nationkey, s.slot) AS slot_index "
          "FROM nation n CROSS JOIN range(9, 18) s(slot)", big="n_nationkey slot")
def win_slot_index(spark, d):
    """WIN-07 ROW_NUMBER over a (day x slot)-style grid of two columns."""
    g = J.grid(T(spark, d, "nation").select("n_nationkey"), spark.range(9, 18).withColumnRenamed("id", "slot"))
    return W.row_number_distributed(g, ["n_nationkey", "slot"], "slot_index")


@register("win_gap_days", "SELECT o_orderkey, date_diff('day', CAST(lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE), "
          "CAST(o_orderdate AS DATE)) AS gap_days FROM orders")
def win_gap_days(spark, d):
    """WIN-10 previous-event gap per entity (distributed per-key sequence, no per-key window)."""
    o = T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return W.gap_days(o, "o_custkey", "o_orderdate", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "gap_days")


@register("win_half_trend", "WITH x AS (SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn, "
          "count(*) OVER (PARTITION BY o_custkey) AS n FROM orders), g AS (SELECT o_custkey, max(n) AS n, "
          "avg(CASE WHEN rn <= n // 2 THEN o_totalprice END) AS a, avg(CASE WHEN rn > n // 2 THEN o_totalprice END) AS b FROM x GROUP BY 1) "
          "SELECT o_custkey, CASE WHEN n < 4 OR a <= 0 THEN 0.0 ELSE (b - a) / a END AS spend_trend FROM g", dbl="spend_trend")
def win_half_trend(spark, d):
    """WIN-11 second-half vs first-half mean per entity (n >= 4, split at n // 2)."""
    return W.half_trend(T(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice")


@register("sort_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10", dbl="o_totalprice")
def sort_top_k(spark, d):
    """SORT-01/02 ORDER BY mixed directions + LIMIT (TakeOrderedAndProject)."""
    return W.top_k(T(spark, d, "orders").select("o_orderkey", "o_totalprice"),
                   [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


@register("sort_first_n_subpop", "WITH p AS (SELECT p_partkey FROM part ORDER BY p_partkey LIMIT 100) "
          "SELECT l.l_partkey, count(*) AS lines FROM lineitem l JOIN p ON l.l_partkey = p.p_partkey GROUP BY 1")
def sort_first_n_subpop(spark, d):
    """SORT-03 first N entities by id used as a sub-population."""
    p = W.first_n(T(spark, d, "part").select("p_partkey"), ["p_partkey"], 100)
    li = T(spark, d, "lineitem")
    return li.join(F.broadcast(p), li.l_partkey == p.p_partkey).groupBy("l_partkey").agg(F.count(F.lit(1)).alias("lines"))


@register("sort_top_k_per_group", "SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (SELECT o_custkey, o_orderkey, o_totalprice, "
          "row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3",
          dbl="o_totalprice", big="rn")
def sort_top_k_per_group(spark, d):
    """SORT-04 top-k per group."""
    o = T(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return W.top_k_per_salted(o, "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, ["o_orderkey"], name="rn")


# ================================================================== expressions
@register("expr_dates", f"SELECT o_orderkey, CAST(o_orderdate AS DATE) + 7 AS plus_week, CAST(o_orderdate + INTERVAL 1 MONTH AS DATE) AS plus_month, "
          "o_orderdate + INTERVAL 90 MINUTE AS plus_minutes, CAST(o_orderdate AS DATE) - 3 AS minus_days, "
          f"date_diff('day', CAST(o_orderdate AS DATE), DATE '{ORD}') AS days_to_asof, "
          f"year(DATE '{ORD}') - year(o_orderdate) AS years_to_asof, "
          "CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start, year(o_orderdate) AS yr, month(o_orderdate) AS mon, "
          "dayofweek(o_orderdate) AS dow0, isodow(o_orderdate) AS dow_iso, isodow(o_orderdate) >= 6 AS weekend, "
          "strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate, '%b %Y') AS mon_yyyy, "
          "strftime(o_orderdate, '%B %d, %Y') AS long_date, "
          "CASE WHEN month(o_orderdate) BETWEEN 3 AND 5 THEN 'Spring' WHEN month(o_orderdate) BETWEEN 6 AND 8 THEN 'Summer' "
          "WHEN month(o_orderdate) BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS season "
          "FROM orders", big="yr mon dow0 dow_iso")
def expr_dates(spark, d):
    """EXPR-01/02/03/05/06/07/08/09/10 date arithmetic, differences, truncation, parts, formats, season."""
    o = T(spark, d, "orders")
    od = F.col("o_orderdate")
    return o.select("o_orderkey", F.date_add(F.to_date(od), 7).alias("plus_week"),
                    F.add_months(F.to_date(od), 1).alias("plus_month"),
                    F.timestamp_add("MINUTE", F.lit(90), od).alias("plus_minutes"),
                    F.date_sub(F.to_date(od), 3).alias("minus_days"),
                    X.days_between(od, X.lit_date(ORD)).alias("days_to_asof"),
                    X.years_between(od, X.lit_date(ORD)).alias("years_to_asof"),
                    F.to_date(F.date_trunc("week", od)).alias("week_start"), F.year(od).alias("yr"),
                    F.month(od).alias("mon"), X.dow_sun0(od).alias("dow0"), X.dow_iso(od).alias("dow_iso"),
                    X.is_weekend(od).alias("weekend"), F.date_format(od, "yyyy-MM").alias("ym"),
                    F.date_format(od, "MMM yyyy").alias("mon_yyyy"), F.date_format(od, "MMMM dd, yyyy").alias("long_date"),
                    X.season_label(od).alias("season"))


@register("expr_months_between", f"SELECT o_orderkey, round((year(DATE '{ORD}') - year(o_orderdate)) * 12 + month(DATE '{ORD}') - month(o_orderdate) + "
          f"CASE WHEN day(DATE '{ORD}') = day(o_orderdate) OR (day(DATE '{ORD}') = day(last_day(DATE '{ORD}')) AND day(o_orderdate) = day(last_day(o_orderdate))) "
          f"THEN 0 ELSE (day(DATE '{ORD}') - day(o_orderdate)) / 31.0 END, 8) AS months FROM orders", dbl="months")
def expr_months_between(spark, d):
    """EXPR-04 fractional months_between (31-day month rule, 8 digits)."""
    o = T(spark, d, "orders")
    return o.select("o_orderkey", F.months_between(X.lit_date(ORD), F.to_date("o_orderdate")).alias("months"))


@register("expr_strings", "SELECT c_custkey, lower(c_mktsegment) || '-' || CAST(c_nationkey AS VARCHAR) AS seg_key, "
          "concat('C', lpad(CAST(c_custkey AS VARCHAR), 8, '0')) AS padded_id, left(c_name, 8) AS name_head, "
          "right(c_name, 4) AS name_tail, substr(c_name, 10, 3) AS name_mid, split_part(c_name, '#', 2) AS name_part, "
          "substr(md5(c_name), 1, 12) AS md5_key, left(c_name, 1) || '***' AS masked FROM customer")
def expr_strings(spark, d):
    """EXPR-11..16 concat, lpad ids, lower, left/right/substr, split_part, md5 prefix."""
    c = T(spark, d, "customer")
    return c.select("c_custkey", F.concat(F.lower("c_mktsegment"), F.lit("-"), F.col("c_nationkey").cast("string")).alias("seg_key"),
                    X.lpad_id("C", "c_custkey", 8).alias("padded_id"), F.left("c_name", F.lit(8)).alias("name_head"),
                    F.right("c_name", F.lit(4)).alias("name_tail"), F.substring("c_name", 10, 3).alias("name_mid"),
                    F.split_part("c_name", F.lit("#"), F.lit(2)).alias("name_part"),
                    F.substring(F.md5("c_name"), 1, 12).alias("md5_key"),
                    F.concat(F.left("c_name", F.lit(1)), F.lit("***")).alias("masked"))


@register("expr_math", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, abs(l_tax - l_discount) AS abs_diff, l_orderkey % 7 AS mod7, "
          "floor(l_quantity / 4) AS floor_q, ceil(l_quantity / 4) AS ceil_q, power(l_discount + 1, 2) AS pow2, exp(-l_discount) AS expd, "
          "1 / (1 + exp(-(l_quantity - 25) / 5)) AS logistic, floor(l_extendedprice / 100) + 0.99 AS price99, "
          "CASE WHEN l_tax IS NULL OR l_discount IS NULL THEN NULL ELSE greatest(l_tax, l_discount) END AS gmax, "
          "least(greatest(l_quantity / 50, 0.1), 0.9) AS clamped, coalesce(nullif(l_tax, 0), -1) AS tax_or_neg, "
          "CASE WHEN l_tax = 0 THEN 0 ELSE l_discount / l_tax END AS div0_dt, "
          "abs(l_quantity * 10 - l_extendedprice / 100) / nullif(l_extendedprice / 100, 0) AS ape FROM lineitem",
          dbl="abs_diff floor_q ceil_q pow2 expd logistic price99 gmax clamped tax_or_neg div0_dt ape", big="l_linenumber")
def expr_math(spark, d):
    """EXPR-17..23 abs, mod, floor/ceil, pow/exp/logistic, .99 endings, null-propagating greatest, clamp,
    coalesce/nullif/div0, APE."""
    li = T(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.abs(F.col("l_tax") - F.col("l_discount")).alias("abs_diff"), (F.col("l_orderkey") % 7).alias("mod7"),
                     F.floor(F.col("l_quantity") / 4).cast("double").alias("floor_q"),
                     F.ceil(F.col("l_quantity") / 4).cast("double").alias("ceil_q"),
                     F.pow(F.col("l_discount") + 1, 2).alias("pow2"), F.exp(-F.col("l_discount")).alias("expd"),
                     X.logistic((F.col("l_quantity") - 25) / 5).alias("logistic"),
                     X.price_99(F.col("l_extendedprice") / 100).alias("price99"),
                     X.greatest_strict("l_tax", "l_discount").alias("gmax"),
                     X.clamp(F.col("l_quantity") / 50, 0.1, 0.9).alias("clamped"),
                     F.coalesce(F.nullif("l_tax", F.lit(0.0)), F.lit(-1.0)).alias("tax_or_neg"),
                     X.div0("l_discount", "l_tax").alias("div0_dt"),
                     X.ape(F.col("l_quantity") * 10, F.col("l_extendedprice") / 100).alias("ape"))


@register("expr_arrays", "SELECT o_orderkey, ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'][CAST(o_orderkey % 7 AS INTEGER) + 1] AS segment, "
          "[o_orderstatus, o_orderpriority][1] AS first_elem FROM orders")
def expr_arrays(spark, d):
    """EXPR-24/25 array literal pick by 0-based index (NULL past end), array as composite key."""
    o = T(spark, d, "orders")
    key = F.array("o_orderstatus", "o_orderpriority")
    return o.select("o_orderkey", X.pick_index(["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
                                               F.col("o_orderkey") % 7).alias("segment"),
                    F.get(key, 0).alias("first_elem"))


@register("expr_split_lateral", "SELECT w AS word, count(*) AS parts FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY 1")
def expr_split_lateral(spark, d):
    """EXPR-26 split string -> rows (lateral explode)."""
    p = T(spark, d, "part")
    return p.select(F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("parts"))


@register("expr_json_field", "SELECT event_type, sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k_total, "
          "avg(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k_mean FROM events GROUP BY 1", dbl="k_mean", big="k_total")
def expr_json_field(spark, d):
    """EXPR-29 JSON field of a string column (path access)."""
    e = T(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    return e.groupBy("event_type").agg(F.sum("k").alias("k_total"), F.avg("k").alias("k_mean"))


# ================================================================== keyed generation
@register("gen_keyed_columns", "SELECT c_custkey, " + K.sql_hash32("c_custkey", "g") + " % 10 AS bucket10, "
          "100 + " + K.sql_hash32("c_custkey", "age") + " % 21 AS uniform_int, "
          "round(10 + " + K.sql_u01("c_custkey", "aov") + " * 90, 4) AS uniform_float, "
          "round(50 + 10 * sqrt(-2 * ln(" + K.sql_u01("c_custkey", "n:1") + ")) * cos(2 * pi() * " + K.sql_u01("c_custkey", "n:2")
          + "), 4) AS normal_val, ['Bronze', 'Silver', 'Gold'][CAST(" + K.sql_hash32("c_custkey", "tier") + " % 3 AS INTEGER) + 1] AS picked, "
          "CAST(floor(power(" + K.sql_u01("c_custkey", "sk") + ", 1.6) * 100) + 1 AS BIGINT) AS skew_idx, "
          "TIMESTAMP '2024-01-01 00:00:00' + to_seconds(" + K.sql_hash32("c_custkey", "ts") + " % (30 * 86400)) AS ts "
          "FROM customer", dbl="uniform_float normal_val")
def gen_keyed_columns(spark, d):
    """GEN-01..06, 08 salted-hash bucket, uniform int/float, normal, pick, skewed index, timestamp."""
    c = T(spark, d, "customer").select("c_custkey")
    return c.select("c_custkey", K.bucket("c_custkey", "g", 10).alias("bucket10"),
                    K.uniform("c_custkey", "age", 100, 120, integer=True).alias("uniform_int"),
                    F.round(K.uniform("c_custkey", "aov", 10, 100), 4).alias("uniform_float"),
                    F.round(K.normal("c_custkey", "n", 50, 10), 4).alias("normal_val"),
                    K.pick("c_custkey", "tier", ["Bronze", "Silver", "Gold"]).alias("picked"),
                    K.skew_index("c_custkey", "sk", 100).alias("skew_idx"),
                    K.ts_between("c_custkey", "ts", "2024-01-01 00:00:00", 30).alias("ts"))


@register("gen_composite_key", "SELECT o_orderkey, " + K.sql_hash32("o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR)", "mkt")
          + " % 1000 AS h FROM orders")
def gen_composite_key(spark, d):
    """GEN-03 hash over a composite (id, date) key."""
    o = T(spark, d, "orders")
    return o.select("o_orderkey", F.pmod(K.hash32(["o_orderkey", F.to_date("o_orderdate").cast("string")], "mkt"),
                                         F.lit(1000)).alias("h"))


@register("gen_fan_out", "SELECT n.n_regionkey, count(*) AS rows_out FROM nation n, "
          "range(1, 1 + 2 + " + K.sql_hash32("n_nationkey", "fan") + " % 5) s(seq) GROUP BY 1", big="n_regionkey")
def gen_fan_out(spark, d):
    """GEN-07 variable fan-out per entity via explode(sequence(1, n))."""
    n = T(spark, d, "nation")
    return K.fan_out(n, "n_nationkey", 2, 5).groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("rows_out"))


# ================================================================== quality
@register("qa_checks", "SELECT 'net_le_gross' AS check_name, count(*) FILTER (WHERE NOT coalesce(l_extendedprice * (1 - l_discount) <= l_extendedprice, false)) "
          "AS violations, count(*) AS checked FROM lineitem UNION ALL SELECT 'price_positive', "
          "count(*) FILTER (WHERE NOT coalesce(p_retailprice > p_retailprice * 0.4, false)), count(*) FROM part")
def qa_checks(spark, d):
    """QA-02 net <= gross per row; QA-04 price above cost."""
    li, p = T(spark, d, "lineitem"), T(spark, d, "part")
    a = S.check(li, F.col("l_extendedprice") * (1 - F.col("l_discount")) <= F.col("l_extendedprice"), "net_le_gross")
    b = S.check(p, F.col("p_retailprice") > F.col("p_retailprice") * 0.4, "price_positive")
    return S.union_all(a, b)


@register("qa_reconcile", "WITH d AS (SELECT l_orderkey, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1) "
          "SELECT o.o_orderkey, d.v - o.o_totalprice AS diff FROM d FULL JOIN orders o ON d.l_orderkey = o.o_orderkey "
          "WHERE abs(coalesce(d.v, 0) - coalesce(o.o_totalprice, 0)) > 0.01 AND o.o_orderkey IS NOT NULL AND d.l_orderkey IS NOT NULL",
          dbl="diff")
def qa_reconcile(spark, d):
    """QA-03 rollup vs detail reconciliation (orders total vs sum of line prices)."""
    li = T(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    o = T(spark, d, "orders")
    r = S.reconcile(li, o, ["o_orderkey"], "o_totalprice", F.col("l_extendedprice"))
    return r.where(F.col("_detail").isNotNull() & F.col("_rollup").isNotNull()).select("o_orderkey", "diff")


@register("qa_assert_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
          big="l_linenumber")
def qa_assert_unique(spark, d):
    """QA-05 declared key uniqueness (lineitem (orderkey, linenumber) repeats)."""
    return S.assert_unique(T(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("qa_orphans", "SELECT count(*) AS orphan_lines FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey) "
          "UNION ALL SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)")
def qa_orphans(spark, d):
    """QA-06 referential check along declared relationships."""
    a = S.orphans(T(spark, d, "lineitem"), T(spark, d, "part"), "l_partkey", "p_partkey").agg(F.count(F.lit(1)).alias("orphan_lines"))
    b = S.orphans(T(spark, d, "orders"), T(spark, d, "customer"), "o_custkey", "c_custkey").agg(F.count(F.lit(1)).alias("orphan_lines"))
    return S.union_all(a, b)


# ================================================================== refresh, synthesis, hooks
_GEN_SQL = ("WITH s AS (SELECT c.c_custkey AS user_id, g.seq, TIMESTAMP '2024-01-01 00:00:00' + to_seconds("
            + K.sql_hash32("c.c_custkey, g.seq", "login") + " % (30 * 86400)) AS log_in FROM customer c, "
            "range(1, 1 + 20 + " + K.sql_hash32("c.c_custkey", "nsess") + " % 40) g(seq)) "
            "SELECT user_id, count(*) AS sessions, min(log_in) AS first_login, max(log_in) AS last_login FROM s GROUP BY 1")


@register("gen_sessions", _GEN_SQL)
def gen_sessions(spark, d):
    """GEN-09 keyed session synthesis: 20..59 sessions per customer (fan-out by explode), login
    time in a 30-day range by (user, seq) hash; summarised per user."""
    s = gen_session_rows(spark, d)
    return s.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.min("log_in").alias("first_login"),
                                    F.max("log_in").alias("last_login"))


# customers whose sessions one task draws: at most 59 each
GEN_CUSTOMERS = 10_000


def _gen_tasks(c) -> int:
    return max(1, -(-c.count() // GEN_CUSTOMERS))


def gen_session_rows(spark, d, lo: int = 20, span: int = 40):
    c = T(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    # dealt before the fan-out: a small file of keys is one task, whatever it grows to
    c = c.repartition(_gen_tasks(c))
    s = K.fan_out(c, "user_id", lo, span, salt="nsess")
    return s.select("user_id", "seq", K.ts_between(["user_id", "seq"], "login", "2024-01-01 00:00:00", 30).alias("log_in"))


@register("gen_game_events", "WITH s AS (SELECT c.c_custkey AS user_id, g.seq FROM customer c, range(1, 1 + 20 + "
          + K.sql_hash32("c.c_custkey", "nsess") + " % 40) g(seq)), e AS (SELECT user_id, "
          + K.sql_hash32("user_id, seq", "kills") + " % 10 AS kills, " + K.sql_hash32("user_id, seq", "assists") + " % 6 AS assists, "
          "substr(md5(CAST(user_id AS VARCHAR) || '-' || CAST(seq AS VARCHAR)), 1, 12) AS match_id FROM s) "
          "SELECT kills, count(*) AS events, sum(assists) AS assists, count(DISTINCT match_id) AS matches FROM e GROUP BY 1", big="assists")
def gen_game_events(spark, d):
    """GEN-10 game events from synthesised sessions: stats by salted hash buckets, md5-prefix match ids.

    Events are dealt by match id to as many tasks as drew them, so matches are told apart task by task:
    a table of all ids that a task has seen is no larger than its share, whatever the number of customers.
    """
    s = gen_session_rows(spark, d)
    e = s.select("user_id", K.bucket(["user_id", "seq"], "kills", 10).alias("kills"),
                 K.bucket(["user_id", "seq"], "assists", 6).alias("assists"),
                 F.substring(F.md5(F.concat_ws("-", F.col("user_id").cast("string"), F.col("seq").cast("string"))), 1, 12).alias("match_id"))
    e = e.select("kills", "assists", "match_id").repartition(_gen_tasks(T(spark, d, "customer")), "match_id")
    one = e.groupBy("kills", "match_id").agg(F.count(F.lit(1)).alias("events"), F.sum("assists").alias("assists"))
    return one.groupBy("kills").agg(F.sum("events").alias("events"), F.sum("assists").alias("assists"),
                                    F.count("match_id").alias("matches"))


@register("expr_variant_path", "SELECT event_type, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS k_total FROM events GROUP BY 1",
          big="k_total")
def expr_variant_path(spark, d):
    """EXPR-27 path access into a semi-structured payload: parse_json -> variant_get(v, '$.k', 'bigint')."""
    e = T(spark, d, "events").withColumn("v", F.parse_json("props"))
    return e.groupBy("event_type").agg(F.sum(F.variant_get("v", "$.k", "bigint")).alias("k_total"))


# The characters Python's str.split() treats as whitespace, as an RE2 class.
_PY_WS = r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@register("udf_text_model_batches",
          "WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents), "
          f"w AS (SELECT doc_id, x, list_filter(regexp_split_to_array(x, '{_PY_WS}'), lambda v: v <> '') AS ws FROM t), "
          "m AS (SELECT doc_id, greatest(length(x) - length(regexp_replace(x, '[.!?]', '', 'g')), 1) AS sentences, "
          "coalesce(list_sum(list_transform(ws, lambda v: length(v))), 0) / greatest(len(ws), 1) AS mean_word_len, "
          "greatest(len(ws), 1) AS n_words FROM w) "
          "SELECT doc_id, sentences, mean_word_len, n_words / sentences AS words_per_sentence FROM m",
          big="sentences", dbl="mean_word_len words_per_sentence")
def udf_text_model_batches(spark, d):
    """UDF-03/04 a user's Python text model on Arrow batches (mapInPandas), over every document."""
    from ..operators.udf import apply_text_model, text_stats
    docs = T(spark, d, "documents").select("doc_id", "text")
    return apply_text_model(docs, text_stats, "doc_id long, sentences long, mean_word_len double, words_per_sentence double")


def _user_model_sql() -> str:
    from .q_spa import _SERIES_SQL
    return (f"WITH {_SERIES_SQL}, p AS (SELECT location_city, service_category, min(ts) AS t0, max(ts) AS last, "
            "count(*) AS n, avg(y) AS ybar FROM zf GROUP BY 1, 2), "
            "f AS (SELECT z.location_city, z.service_category, regr_slope(z.y, date_diff('day', p.t0, z.ts)) AS b, "
            "regr_intercept(z.y, date_diff('day', p.t0, z.ts)) AS a FROM zf z JOIN p USING (location_city, service_category) GROUP BY 1, 2) "
            "SELECT CAST(p.last + CAST(k AS INTEGER) AS DATE) AS ts, greatest(CASE WHEN p.n > 1 THEN f.a + f.b * "
            "(date_diff('day', p.t0, p.last) + k) ELSE p.ybar END, 0.0) AS forecast, p.location_city, p.service_category "
            "FROM p JOIN f USING (location_city, service_category), range(1, 15) r(k)")


@register("fc_forecast_with_user_model", _user_model_sql(), dbl="forecast")
def fc_forecast_with_user_model(spark, d):
    """FC-04 / UDF-05 user-supplied per-series model (applyInPandas over the zero-filled series)."""
    from ..operators.forecast import zero_fill
    from ..operators.udf import apply_per_group, linear_trend_forecast
    from .q_spa import KEYS as keys, _daily
    s = zero_fill(_daily(spark, d), keys, "ts", "y")
    return apply_per_group(s, keys, linear_trend_forecast(14),
                           "ts date, forecast double, location_city string, service_category string")


@register("src_pandas_handover", "SELECT r_name, count(*) AS nations, count(*) / sum(count(*)) OVER () AS share "
          "FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY 1", big="nations", dbl="share")
def src_pandas_handover(spark, d):
    """SRC-16 pandas hand-over for a small, bounded result (one row per region) and back."""
    agg = T(spark, d, "region").join(T(spark, d, "nation"), F.col("r_regionkey") == F.col("n_regionkey")) \
        .groupBy("r_name").agg(F.count(F.lit(1)).alias("nations"))
    pdf = agg.toPandas()                      # 1 row per region: bounded by the region dimension
    pdf["share"] = pdf["nations"] / pdf["nations"].sum()
    return spark.createDataFrame(pdf)
