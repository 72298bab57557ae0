"""Customer-service screening marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keyed as K
from ..functions.expr import lit_date, map_value, update_cols
from ..operators.sets import union_all
from ..operators.windows import row_number_distributed, top_k_per_salted

# Screening statuses by source status, components, awaiting-candidate items.
STATUS_MAP = {"O": "In Progress", "P": "On Hold", "F": "Complete"}
COMPONENTS = ["County Criminal Search", "County Criminal Search", "Education Verification",
              "Employment Verification", "Motor Vehicle Record", "Drug Screen",
              "Federal Criminal Search", "Professional License Verification"]
CASE_SUBJECTS = ["Status update request", "Delay escalation", "Report dispute", "Consent form issue",
                 "Drug test rescheduling", "Adverse action notice"]
CASE_STATUSES = ["Open", "Pending", "Closed"]
CASE_PRIORITIES = ["Low", "Medium", "High"]


def order_status(orders: DataFrame, as_of) -> DataFrame:
    """MART-60 order lifecycle: status, component, since, completed date, days in status, ETA.

    The reference runs four UPDATE passes; each pass is one ``update_cols``
    projection, so the whole derivation is a single narrow stage.
    """
    a = lit_date(as_of)
    k = "order_id"
    o = orders.withColumn("current_status", map_value("raw_status", STATUS_MAP, "Unknown"))
    done = F.col("current_status") == "Complete"
    o = o.withColumn("current_component", F.when(done, F.lit(None)).otherwise(K.pick(k, "cmp", COMPONENTS)))
    o = o.withColumns({
        "status_since": F.least(a, F.date_add("order_date", F.pmod(F.col(k), F.lit(10)).cast("int"))),
        "completed_date": F.when(done, F.least(a, F.date_add("order_date", (F.lit(2) + F.pmod(K.hash32(k, "cd"), F.lit(10))).cast("int"))))})
    o = update_cols(o, {"status_since": F.col("completed_date")}, where=done)
    o = o.withColumns({
        "days_in_status": F.datediff(a, F.col("status_since")),
        "eta_date": F.when(done, F.lit(None)).otherwise(F.date_add(a, (F.lit(1) + F.pmod(K.hash32(k, "eta"), F.lit(7))).cast("int")))})
    return o.select("order_id", "candidate_id", "client_id", "order_date", "current_status", "current_component",
                    "status_since", "days_in_status", "eta_date", "completed_date")


def status_history(st: DataFrame) -> DataFrame:
    """MART-61 three appended events per order; the third only if the status changed later."""
    base = F.col("order_date").cast("timestamp_ntz")
    a = st.select("order_id", F.lit("Ordered").alias("status"), F.lit(None).cast("string").alias("component"),
                  F.timestamp_add("HOUR", F.lit(9), base).alias("changed_at"))
    b = st.select("order_id", F.lit("In Progress").alias("status"), F.lit("SSN Trace").alias("component"),
                  F.timestamp_add("DAY", F.lit(1), base).alias("changed_at"))
    c = st.where(F.col("status_since") > F.col("order_date")).select(
        "order_id", F.col("current_status").alias("status"), F.col("current_component").alias("component"),
        F.timestamp_add("HOUR", F.lit(14), F.col("status_since").cast("timestamp_ntz")).alias("changed_at"))
    return union_all(a, b, c)


def stuck(st: DataFrame, k: int = 5) -> DataFrame:
    """MART-62 orders not complete and more than k days in the current status (T10: k is a parameter)."""
    return st.where((F.col("current_status") != "Complete") & (F.col("days_in_status") > k))


def stuck_by(st: DataFrame, k: int = 5, by=("client_id", "current_component")) -> DataFrame:
    return stuck(st, k).groupBy(*by).agg(F.count(F.lit(1)).alias("stuck_orders"))


def call_context(calls: DataFrame, st: DataFrame, candidates: DataFrame, clients: DataFrame) -> DataFrame:
    """MART-63 calls joined to their order, candidate and client."""
    j = calls.join(st.select("order_id", "candidate_id", "client_id", "current_status", "current_component"), "order_id", "left")
    j = j.join(candidates, "candidate_id", "left").join(clients, "client_id", "left")
    return j


def stuck_callers(st: DataFrame, calls: DataFrame, k: int = 5) -> DataFrame:
    """MART-64 per stuck order: how often its candidate called (calls pre-counted per candidate)."""
    cand_calls = calls.join(st.select("order_id", "candidate_id"), "order_id") \
        .groupBy("candidate_id").agg(F.count(F.lit(1)).alias("candidate_calls"))
    s = stuck(st, k).select("order_id", "candidate_id", "client_id", "current_component", "days_in_status")
    return s.join(cand_calls, "candidate_id", "left").withColumn(
        "candidate_calls", F.coalesce("candidate_calls", F.lit(0)))


def cases(calls: DataFrame) -> DataFrame:
    """MART-65 cases from sampled contacts (hash mod 3 = 0): surrogate id, subject, status, priority."""
    s = calls.where(F.pmod(K.hash32("contact_id", "case"), F.lit(3)) == 0)
    s = row_number_distributed(s.select("contact_id", "order_id", "started_at"), ["started_at", "contact_id"], "_rn")
    return s.select(F.concat(F.lit("CS"), F.lpad(F.col("_rn").cast("string"), 7, "0")).alias("case_id"), "contact_id", "order_id",
                    K.pick("contact_id", "subj", CASE_SUBJECTS).alias("subject"),
                    K.pick("contact_id", "cst", CASE_STATUSES).alias("status"),
                    K.pick("contact_id", "pri", CASE_PRIORITIES).alias("priority"),
                    F.timestamp_add("MINUTE", F.lit(30), F.col("started_at")).alias("created_at"))


def ops_notes(st: DataFrame) -> DataFrame:
    """MART-66 ops notes: two per open order, one per sampled (key mod 10 = 0) complete order;
    note text is a nested string template with CASE branches (EXPR-28) by component and status;
    ids from a distributed row number."""
    open_ = st.where(F.col("current_status") != "Complete")
    closed = st.where((F.col("current_status") == "Complete") & (F.pmod(F.col("order_id"), F.lit(10)) == 0))
    rows = union_all(open_.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))), closed.withColumn("k", F.lit(1)))
    text = F.when(F.col("current_status") == "Complete",
                  F.concat(F.lit("Report delivered on "), F.date_format("completed_date", "MMMM dd, yyyy"), F.lit(".")))\
        .when(F.col("k") == 1, F.concat(F.lit("Checked "), F.col("current_component"), F.lit(" - status "),
                                        F.col("current_status"), F.lit(" since "), F.date_format("status_since", "yyyy-MM-dd"), F.lit(".")))\
        .otherwise(F.concat(F.lit("Follow-up with vendor on "), F.col("current_component"), F.lit("; ETA "),
                            F.date_format("eta_date", "yyyy-MM-dd"), F.lit(".")))
    author = F.when(F.col("k") == 1, F.lit("ops_analyst")).otherwise(F.lit("vendor_desk"))
    created = F.timestamp_add("HOUR", F.col("k") * 3 + 8, F.col("status_since").cast("timestamp_ntz"))
    n = row_number_distributed(rows.select("order_id", "k", author.alias("author"), created.alias("created_at"),
                                           text.alias("note_text")), ["order_id", "k"], "note_id")
    return n


def latest_for(df: DataFrame, key: str, order: list, k: int = 1) -> DataFrame:
    """MART-67 latest k rows per key (e.g. status of one order, last 3 calls of a person);
    ``order`` must be a total order, newest first.  Two-stage salted top-k, so a key holding
    a large share of the rows is ranked by many tasks first."""
    return top_k_per_salted(df, key, order, k, [c for c in df.columns if c != key]).drop("rank")
