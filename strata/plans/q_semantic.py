"""Semantic-layer queries: every metric of the four models (SEM metrics 1-59) plus the
SEM-02..12 behaviours and the questions answered through the layer (Q-06, Q-07)."""

from __future__ import annotations

from . import models as MD
from .catalog import register
from .roles import ROLE_SQL

# (model, metric, dimensions) for every declared metric
_BY = {
    "player": {"users": ["country"], "sessions": ["device_type"], "purchases": ["ad_type"], "game": ["country"],
               "retention": ["segment"]},
    "retail": {"interactions": ["product_line"], "ml_features": ["segment"], "campaign_perf": ["campaign_type"],
               "sales": ["channel"], "kpi": ["kpi_channel"]},
    "spa": {"appointments": ["city"], "daily_volume": ["volume_city"], "providers": ["provider_city"]},
    "screening": {"orders": ["current_status"], "calls": ["client_name"]},
}


def _metric_query(model_fn, metric, dims, **kw):
    def q(spark, d):
        return model_fn().query(spark, d, [metric] if isinstance(metric, str) else metric, dims, **kw)
    q.__doc__ = f"Semantic metric {metric} by {', '.join(dims) or 'all'}."
    return q


# metrics whose value is an integer (sums of integer columns or of 1/0 flags); counts are detected by form
_INTEGER_SUMS = {"bought_count", "total_kills", "churn_count", "total_kpi_orders", "total_new_customers", "total_repeat_customers",
                 "total_volume"}


def _is_integer(m) -> bool:
    return m.expr.lower().startswith("count(") or m.name in _INTEGER_SUMS


def _register_metrics():
    for mname, fn in MD.MODELS.items():
        model = fn()
        for m in model.metrics:
            dims = _BY[mname][m.table]
            kind = {"big": m.name} if _is_integer(m) else {"dbl": m.name}
            register(f"sem_{mname}_{m.name}", model.to_sql([m.name], dims), **kind)(_metric_query(fn, m.name, dims))


_register_metrics()


def _reg(name, model_fn, metrics, dims, dbl, note="", **kw):
    m = model_fn()
    register(name, m.to_sql(metrics, dims, **kw), dbl=dbl, note=note)(_metric_query(model_fn, metrics, dims, **kw))


_reg("sem_multi_fact", MD.retail, ["total_net_revenue", "purchase_count"], ["product_line"], "total_net_revenue",
     "SEM-03 metrics of two facts aggregated separately, full-outer joined on the shared dimension")
_reg("sem_multi_hop", MD.screening, ["call_count", "order_count", "avg_days_in_status"], ["client_name"],
     "avg_days_in_status", "SEM-04 call -> order -> client path")
_reg("sem_expression_dimension", MD.retail, ["total_orders"], ["customer_label"], "",
     "SEM-05 expression dimension (name + country)")
_reg("sem_derived_cross_fact", MD.player, ["revenue_per_player", "total_revenue", "total_players"], ["country"],
     "revenue_per_player total_revenue", "SEM-07 derived metric computed from two facts' components")
_reg("sem_filtered_enum", MD.retail, ["total_net_revenue", "avg_discount"], ["region"], "total_net_revenue avg_discount",
     "SEM-08 enum-checked filter", filters={"segment": ["BUILDING", "MACHINERY"]})
_reg("sem_default_filter", MD.player, ["total_revenue", "total_purchases"], ["country"], "total_revenue",
     "SEM-12 business default: exclude 'none' purchases", apply_defaults=True)
_reg("sem_synonyms", MD.retail, ["net revenue", "aov"], ["sales channel"], "total_net_revenue avg_order_value",
     "SEM-09 names resolved through synonyms")
_reg("q06_net_revenue_by_channel", MD.retail, ["total_net_revenue"], ["channel"], "total_net_revenue", "Q-06")
_reg("q11_sem_top_lines", MD.retail, ["total_net_revenue"], ["product_line"], "total_net_revenue",
     "Q-11 through the layer: order + limit", order=["total_net_revenue DESC", "product_line"], limit=10)


# hand-written SQL, independent of the layer's own planner
@register("sem_filter_unrequested", f"""
SELECT s.channel, sum(s.net_revenue) AS total_net_revenue FROM ({ROLE_SQL['sales']}) s
JOIN customer c ON s.customer_id = c.c_custkey WHERE c.c_mktsegment = 'BUILDING' GROUP BY 1""", dbl="total_net_revenue")
def sem_filter_unrequested(spark, d):
    """SEM-02/08 a filter on a dimension that isn't requested: its table joins along the path."""
    return MD.retail().query(spark, d, ["total_net_revenue"], ["channel"], filters={"segment": ["BUILDING"]})


@register("sem_filter_multi_fact", f"""
WITH a AS (SELECT p.p_brand AS product_line, sum(s.net_revenue) AS total_net_revenue FROM ({ROLE_SQL['sales']}) s
           JOIN customer c ON s.customer_id = c.c_custkey LEFT JOIN part p ON s.product_id = p.p_partkey WHERE c.c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1),
b AS (SELECT p.p_brand AS product_line, count(CASE WHEN l.l_linestatus = 'F' THEN 1 END) AS purchase_count
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
      LEFT JOIN part p ON l.l_partkey = p.p_partkey WHERE c.c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1)
SELECT coalesce(a.product_line, b.product_line) AS product_line, total_net_revenue, purchase_count
FROM a FULL JOIN b ON a.product_line IS NOT DISTINCT FROM b.product_line""", dbl="total_net_revenue", big="purchase_count")
def sem_filter_multi_fact(spark, d):
    """SEM-03/08 two facts under one filter: each reaches the filter's table by its own path."""
    return MD.retail().query(spark, d, ["total_net_revenue", "purchase_count"], ["product_line"], filters={"segment": ["BUILDING", "MACHINERY"]})


@register("sem_fact_metric", f"""
SELECT s.channel, sum(s.net_revenue - s.cost_of_goods) AS total_margin,
       CASE WHEN sum(s.net_revenue) = 0 THEN 0 ELSE (sum(s.net_revenue) - sum(s.cost_of_goods)) / sum(s.net_revenue) END AS gross_margin
FROM ({ROLE_SQL['sales']}) s GROUP BY 1""", dbl="total_margin gross_margin")
def sem_fact_metric(spark, d):
    """SEM-06 metrics defined on declared facts."""
    return MD.retail().query(spark, d, ["total_margin", "gross_margin"], ["channel"])


def _trend_q(spark, d):
    """Q-07 / SEM-11 monthly net revenue trend by region (month grain, money rounded to 2)."""
    return MD.retail().trend(spark, d, "total_net_revenue", "sale_date", "month", ["region"])


_r = MD.retail()
_g = _r.grain_dim("sale_date", "month")
register("q07_monthly_revenue_by_region",
         _r.to_sql(["total_net_revenue"], [_g, "region"]).replace(
             "SELECT sale_date_month, region, total_net_revenue FROM _c",
             "SELECT sale_date_month, region, floor(floor(total_net_revenue * 1e6 + 0.5) / 1e6 * 100.0 + 0.5) / 100.0 AS total_net_revenue FROM _c"),
         dbl="total_net_revenue", note="Q-07 / SEM-11 monthly trend, money rounded to 2")(_trend_q)
