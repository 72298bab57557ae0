"""Screening queries (MART-60..67, GOV-01..04, Q-17, 19, 21, 26) with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keyed as K
from ..marts import cases as C
from ..operators import govern as G
from ..operators import windows as W
from ..sources.io import scan
from .catalog import register
from .roles import AS_OF_ORDERS as ORD, R, Roles

_CMP = "['" + "','".join(C.COMPONENTS) + "']"
_ST_SQL = (
    f"{R('scr_orders', 'clients', 'calls')}, st0 AS (SELECT o.*, CASE raw_status WHEN 'O' THEN 'In Progress' WHEN 'P' THEN 'On Hold' "
    "WHEN 'F' THEN 'Complete' ELSE 'Unknown' END AS current_status FROM scr_orders o), "
    f"st1 AS (SELECT *, CASE WHEN current_status = 'Complete' THEN NULL ELSE {_CMP}[CAST(" + K.sql_hash32("order_id", "cmp") + " % 8 AS INTEGER) + 1] END AS current_component, "
    f"least(DATE '{ORD}', order_date + CAST(order_id % 10 AS INTEGER)) AS since0, "
    f"CASE WHEN current_status = 'Complete' THEN least(DATE '{ORD}', order_date + CAST(2 + " + K.sql_hash32("order_id", "cd") + " % 10 AS INTEGER)) END AS completed_date FROM st0), "
    "st AS (SELECT order_id, candidate_id, client_id, order_date, current_status, current_component, "
    "CASE WHEN current_status = 'Complete' THEN completed_date ELSE since0 END AS status_since, "
    f"date_diff('day', CASE WHEN current_status = 'Complete' THEN completed_date ELSE since0 END, DATE '{ORD}') AS days_in_status, "
    f"CASE WHEN current_status = 'Complete' THEN NULL ELSE DATE '{ORD}' + CAST(1 + " + K.sql_hash32("order_id", "eta") + " % 7 AS INTEGER) END AS eta_date, "
    "completed_date FROM st1)")


def _st(spark, d):
    return C.order_status(Roles(spark, d).scr_orders(), ORD)


@register("mart_order_status", f"WITH {_ST_SQL} SELECT * FROM st")
def mart_order_status(spark, d):
    """MART-60 / SRC-12 order lifecycle derivation (UPDATE passes as projections)."""
    return _st(spark, d)


_HIST_SQL = ("hist AS (SELECT order_id, 'Ordered' AS status, CAST(NULL AS VARCHAR) AS component, CAST(order_date AS TIMESTAMP) + INTERVAL 9 HOUR AS changed_at FROM st "
             "UNION ALL SELECT order_id, 'In Progress', 'SSN Trace', CAST(order_date AS TIMESTAMP) + INTERVAL 1 DAY FROM st "
             "UNION ALL SELECT order_id, current_status, current_component, CAST(status_since AS TIMESTAMP) + INTERVAL 14 HOUR FROM st "
             "WHERE status_since > order_date)")


@register("mart_status_history", f"WITH {_ST_SQL}, {_HIST_SQL} SELECT * FROM hist")
def mart_status_history(spark, d):
    """MART-61 / SET-01 status history: three UNION ALL branches."""
    return C.status_history(_st(spark, d))


@register("mart_latest_status", f"WITH {_ST_SQL}, {_HIST_SQL} SELECT order_id, status, component, changed_at FROM "
          "(SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY changed_at DESC, status) AS rn FROM hist) WHERE rn = 1")
def mart_latest_status(spark, d):
    """MART-67 latest status per order (top-1 per group)."""
    h = C.status_history(_st(spark, d))
    return C.latest_for(h, "order_id", [F.desc("changed_at"), F.asc("status")], 1)


@register("mart_stuck_orders", f"WITH {_ST_SQL} SELECT client_id, current_component, count(*) AS stuck_orders FROM st "
          "WHERE current_status != 'Complete' AND days_in_status > 5 GROUP BY 1, 2")
def mart_stuck_orders(spark, d):
    """MART-62 stuck orders (> 5 days, not complete) by client and component."""
    return C.stuck_by(_st(spark, d), 5)


@register("q19_clients_most_stuck", f"WITH {_ST_SQL} SELECT s.client_id, c.client_name, count(*) AS stuck_orders FROM st s "
          "LEFT JOIN clients c ON s.client_id = c.client_id WHERE s.current_status != 'Complete' AND s.days_in_status > 7 "
          "GROUP BY 1, 2 ORDER BY stuck_orders DESC, s.client_id LIMIT 10")
def q19_clients_most_stuck(spark, d):
    """Q-19 clients with the most orders stuck more than 7 days."""
    r = Roles(spark, d)
    g = C.stuck_by(_st(spark, d), 7, ("client_id",)).join(r.clients(), "client_id", "left")
    return W.top_k(g.select("client_id", "client_name", "stuck_orders"), [F.desc("stuck_orders"), F.asc("client_id")], 10)


_CALLERS_SQL = ("cc AS (SELECT st.candidate_id, count(*) AS candidate_calls FROM calls JOIN st ON calls.order_id = st.order_id GROUP BY 1), "
                "sc AS (SELECT s.order_id, s.candidate_id, s.client_id, s.current_component, s.days_in_status, coalesce(cc.candidate_calls, 0) AS candidate_calls "
                "FROM st s LEFT JOIN cc ON s.candidate_id = cc.candidate_id WHERE s.current_status != 'Complete' AND s.days_in_status > 5)")


@register("mart_stuck_callers", f"WITH {_ST_SQL}, {_CALLERS_SQL} SELECT * FROM sc")
def mart_stuck_callers(spark, d):
    """MART-64 repeat-caller count per stuck order."""
    return C.stuck_callers(_st(spark, d), Roles(spark, d).calls())


@register("q21_stuck_county_callers", f"WITH {_ST_SQL}, {_CALLERS_SQL} SELECT count(*) AS stuck_orders, "
          "count(*) FILTER (WHERE candidate_calls > 0) AS with_calls, avg(CASE WHEN candidate_calls > 0 THEN 1.0 ELSE 0.0 END) AS share_called "
          "FROM sc WHERE current_component = 'County Criminal Search'", dbl="share_called")
def q21_stuck_county_callers(spark, d):
    """Q-21 stuck in County Criminal Search > 5 days and the share whose candidate called."""
    from ..operators.aggs import count_if, rate
    s = C.stuck_callers(_st(spark, d), Roles(spark, d).calls()).where(F.col("current_component") == "County Criminal Search")
    return s.agg(F.count(F.lit(1)).alias("stuck_orders"), count_if(F.col("candidate_calls") > 0).alias("with_calls"),
                 rate(F.col("candidate_calls") > 0).alias("share_called"))


@register("q17_most_delayed_order", f"WITH {_ST_SQL}, {_CALLERS_SQL} SELECT order_id, current_component, days_in_status, candidate_calls "
          "FROM sc ORDER BY days_in_status DESC, order_id LIMIT 1")
def q17_most_delayed_order(spark, d):
    """Q-17 why the most delayed order is stuck and how often its candidate called."""
    s = C.stuck_callers(_st(spark, d), Roles(spark, d).calls())
    return W.top_k(s.select("order_id", "current_component", "days_in_status", "candidate_calls"),
                   [F.desc("days_in_status"), F.asc("order_id")], 1)


@register("q26_waiting_components", f"WITH {_ST_SQL} SELECT current_component, count(*) AS waiting_orders, min(eta_date) AS next_eta, "
          "max(eta_date) AS last_eta FROM st WHERE current_status != 'Complete' GROUP BY 1")
def q26_waiting_components(spark, d):
    """Q-26 message basis per waiting component: orders and ETA range."""
    s = _st(spark, d).where(F.col("current_status") != "Complete")
    return s.groupBy("current_component").agg(F.count(F.lit(1)).alias("waiting_orders"), F.min("eta_date").alias("next_eta"),
                                               F.max("eta_date").alias("last_eta"))


@register("mart_call_context", f"WITH {_ST_SQL} SELECT c.contact_id, c.order_id, c.started_at, c.duration_sec, s.candidate_id, s.client_id, "
          "s.current_status, s.current_component, cu.c_name AS candidate_name, cl.client_name FROM calls c LEFT JOIN st s ON c.order_id = s.order_id "
          "LEFT JOIN customer cu ON s.candidate_id = cu.c_custkey LEFT JOIN clients cl ON s.client_id = cl.client_id")
def mart_call_context(spark, d):
    """MART-63 calls joined to order, candidate and client context."""
    r = Roles(spark, d)
    cand = scan(spark, d, "customer").select(F.col("c_custkey").alias("candidate_id"), F.col("c_name").alias("candidate_name"))
    j = C.call_context(r.calls().select("contact_id", "order_id", "started_at", "duration_sec"), _st(spark, d), cand, r.clients())
    return j.select("contact_id", "order_id", "started_at", "duration_sec", "candidate_id", "client_id", "current_status",
                    "current_component", "candidate_name", "client_name")


@register("mart_cases", f"WITH {R('calls')}, s AS (SELECT contact_id, order_id, started_at FROM calls WHERE "
          + K.sql_hash32("contact_id", "case") + " % 3 = 0) SELECT 'CS' || lpad(CAST(row_number() OVER (ORDER BY started_at, contact_id) AS VARCHAR), 7, '0') AS case_id, "
          "contact_id, order_id, ['" + "','".join(C.CASE_SUBJECTS) + "'][CAST(" + K.sql_hash32("contact_id", "subj") + " % 6 AS INTEGER) + 1] AS subject, "
          "['Open','Pending','Closed'][CAST(" + K.sql_hash32("contact_id", "cst") + " % 3 AS INTEGER) + 1] AS status, "
          "['Low','Medium','High'][CAST(" + K.sql_hash32("contact_id", "pri") + " % 3 AS INTEGER) + 1] AS priority, "
          "started_at + INTERVAL 30 MINUTE AS created_at FROM s")
def mart_cases(spark, d):
    """MART-65 cases from sampled contacts (sampling is the feature): surrogate id, subject, status, priority."""
    return C.cases(Roles(spark, d).calls())


@register("mart_ops_notes", f"WITH {_ST_SQL}, r AS (SELECT st.*, k FROM st, range(1, 3) t(k) WHERE current_status != 'Complete' "
          "UNION ALL SELECT st.*, 1 FROM st WHERE current_status = 'Complete' AND order_id % 10 = 0) "
          "SELECT order_id, k, CASE WHEN k = 1 THEN 'ops_analyst' ELSE 'vendor_desk' END AS author, "
          "CAST(status_since AS TIMESTAMP) + to_hours(CAST(k * 3 + 8 AS BIGINT)) AS created_at, "
          "CASE WHEN current_status = 'Complete' THEN 'Report delivered on ' || strftime(completed_date, '%B %d, %Y') || '.' "
          "WHEN k = 1 THEN 'Checked ' || current_component || ' - status ' || current_status || ' since ' || strftime(status_since, '%Y-%m-%d') || '.' "
          "ELSE 'Follow-up with vendor on ' || current_component || '; ETA ' || strftime(eta_date, '%Y-%m-%d') || '.' END AS note_text, "
          "row_number() OVER (ORDER BY order_id, k) AS note_id FROM r", big="k")
def mart_ops_notes(spark, d):
    """MART-66 ops notes (2 per open order, 1 per sampled complete order), distributed note ids."""
    return C.ops_notes(_st(spark, d))


_CAND_SQL = ("cand AS (SELECT c_custkey AS candidate_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name, "
             "c_name AS full_name, lower(split_part(c_name, '#', 1)) || '.' || split_part(c_name, '#', 2) || '@example.com' AS email, "
             "'+1 (555) ' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone, "
             "lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS ssn, "
             "CAST(DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS DATE) AS dob, CAST(c_nationkey AS VARCHAR) AS state FROM customer)")


def candidates(spark, d):
    c = scan(spark, d, "customer")
    first, last = F.split_part("c_name", F.lit("#"), F.lit(1)), F.split_part("c_name", F.lit("#"), F.lit(2))
    k = F.col("c_custkey")
    return c.select(k.alias("candidate_id"), first.alias("first_name"), last.alias("last_name"), F.col("c_name").alias("full_name"),
                    F.concat(F.lower(first), F.lit("."), last, F.lit("@example.com")).alias("email"),
                    F.concat(F.lit("+1 (555) "), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("-"),
                             F.lpad((k % 10000).cast("string"), 4, "0")).alias("phone"),
                    F.concat(F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("-"), F.lpad((k % 100).cast("string"), 2, "0"),
                             F.lit("-"), F.lpad((k % 10000).cast("string"), 4, "0")).alias("ssn"),
                    F.date_add(F.lit("1960-01-01").cast("date"), (k % 15000).cast("int")).alias("dob"),
                    F.col("c_nationkey").cast("string").alias("state"))


POLICY = {"ssn": "string", "email": "string", "phone": "string", "dob": "date", "last_name": "name", "full_name": "name"}


@register("gov_masks_support_agent", f"WITH {_CAND_SQL} SELECT candidate_id, first_name, left(last_name, 1) || '***' AS last_name, "
          "left(full_name, 1) || '***' AS full_name, '***MASKED***' AS email, '***MASKED***' AS phone, '***MASKED***' AS ssn, "
          "CAST(NULL AS DATE) AS dob, state FROM cand")
def gov_masks_support_agent(spark, d):
    """GOV-01..04 masking policies applied for SUPPORT_AGENT (string, date, name masks)."""
    return G.apply_policies(candidates(spark, d), POLICY, "SUPPORT_AGENT")


@register("gov_masks_lab_admin", f"WITH {_CAND_SQL} SELECT * FROM cand")
def gov_masks_lab_admin(spark, d):
    """GOV-04 the same policies for LAB_ADMIN: all columns unchanged."""
    return G.apply_policies(candidates(spark, d), POLICY, "LAB_ADMIN")
