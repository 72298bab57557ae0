"""Masks, ingestion, semantic-layer rules, text, determinism, distributed windows."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from strata.operators import govern as G
from strata.operators import text as TX
from strata.operators import windows as W
from strata.sources import io

from conftest import SF_SMALL


def test_masks_per_role(spark):
    df = spark.createDataFrame([("Maria Lopez", "1990-05-01", "123-45-6789")], "full_name string, dob string, ssn string") \
        .withColumn("dob", F.to_date("dob"))
    pol = {"full_name": "name", "dob": "date", "ssn": "string"}
    a = G.apply_policies(df, pol, "SUPPORT_AGENT").first()
    assert (a.full_name, a.dob, a.ssn) == ("M***", None, "***MASKED***")
    b = G.apply_policies(df, pol, "LAB_ADMIN").first()
    assert b.full_name == "Maria Lopez" and b.ssn == "123-45-6789"


def test_csv_tolerant_quarantine(spark):
    d = tempfile.mkdtemp(prefix="strata-csv-")
    p = os.path.join(d, "a.csv")
    with open(p, "w") as f:
        f.write("n,d\n1,2024-01-01\nx,2024-01-02\n4,2024-01-05,9\n")
    sch = io.schema([("n", "int"), ("d", "date")])
    good, bad = io.read_csv_tolerant(spark, p, sch)
    assert good.count() == 1 and bad.count() == 2


def test_redaction_and_commitment(spark):
    df = spark.createDataFrame([(1, "Mail me at a.b@x.example.com or +1 (555) 555-1234, SSN 123-45-6789.")], "id long, t string")
    r = TX.redact(df, "t").first().t
    assert "[EMAIL]" in r and "[PHONE]" in r and "[SSN]" in r and "@" not in r
    conv = spark.createDataFrame([(1, 0, "assistant", "Agent here. I will call you back tomorrow."),
                                  (2, 0, "assistant", "Nothing to add.")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.commitment for r in TX.commitments(conv, "conv_id", "turn", "role", "text").collect()}
    assert got[1] == "Commitment: I will call you back tomorrow." and got[2] == "Commitment: None"


def test_semantic_rules(spark):
    from strata.plans import models as MD
    m = MD.retail()
    assert m.resolve("net revenue") == "total_net_revenue"
    with pytest.raises(ValueError):
        m.check_filter("segment", ["NOT_A_SEGMENT"])
    with pytest.raises(ValueError):            # T16: kpi has no relationship to products
        m.query(spark, SF_SMALL, ["total_kpi_net_revenue"], ["product_line"])
    out = m.query(spark, SF_SMALL, ["total_net_revenue", "purchase_count"], ["product_line"])
    assert set(out.columns) == {"product_line", "total_net_revenue", "purchase_count"}


def test_semantic_fan_out_safe(spark):
    """Multi-fact query equals the two single-fact queries joined (no double counting)."""
    from strata.plans import models as MD
    m = MD.retail()
    both = {r.product_line: (r.total_net_revenue, r.purchase_count)
            for r in m.query(spark, SF_SMALL, ["total_net_revenue", "purchase_count"], ["product_line"]).collect()}
    a = {r.product_line: r.total_net_revenue for r in m.query(spark, SF_SMALL, ["total_net_revenue"], ["product_line"]).collect()}
    b = {r.product_line: r.purchase_count for r in m.query(spark, SF_SMALL, ["purchase_count"], ["product_line"]).collect()}
    for k, (x, y) in both.items():
        assert abs((x or 0) - (a.get(k) or 0)) < 1e-6 and y == b.get(k)


def test_distributed_row_number_and_rank_match_windows(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("v"), F.col("id"))
    rn = W.row_number_distributed(df, ["v", "id"], "rn")
    ref = df.withColumn("rn2", F.row_number().over(Window.orderBy("v", "id")))
    assert rn.join(ref, "id").where("rn != rn2").count() == 0
    rk = W.rank_distributed(df, "v", "rk")
    ref2 = df.withColumn("rk2", F.rank().over(Window.orderBy(F.desc("v"))))
    assert rk.join(ref2.select("id", "rk2"), "id").where("rk != rk2").count() == 0


def test_salted_top_k_is_exact(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("g"), F.col("id"), ((F.col("id") * 7919) % 1000).alias("s"))
    a = W.top_k_per_salted(df, "g", [F.desc("s"), F.asc("id")], 5, ["id"]).select("g", "id", "rank")
    b = W.top_k_per(df, "g", [F.desc("s"), F.asc("id")], 5, "rank").select("g", "id", "rank")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_deterministic_rerun(spark):
    import __spark_entry__ as E
    q = E.queries()
    for name in ("mart_customer_value", "mart_ops_notes"):
        a = q[name](spark, SF_SMALL)
        b = q[name](spark, SF_SMALL)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "arp_dau" in df.columns


def test_overwrite_idempotent(spark):
    d = tempfile.mkdtemp(prefix="strata-ow-")
    df = spark.range(10)
    io.overwrite(df, d)
    io.overwrite(df, d)
    assert spark.read.parquet(d).count() == 10


def test_seq_within_matches_window_with_hot_key(spark):
    from pyspark.sql import Window
    # key 0 holds a third of the rows (hot key)
    df = spark.range(0, 6000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
                                     ((F.col("id") * 31) % 997).alias("v"), F.col("id"))
    a = W.seq_within(df, "k", ["v", "id"], "seq")
    b = df.withColumn("seq2", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")))
    assert a.join(b.select("id", "seq2"), "id").where("seq != seq2").count() == 0
    g = W.gap_days(df.withColumn("d", F.expr("date_add(DATE'2024-01-01', CAST(v AS INT))")), "k", "d", ["d", "id"])
    ref = df.withColumn("d", F.expr("date_add(DATE'2024-01-01', CAST(v AS INT))")).withColumn(
        "g2", F.datediff("d", F.lag("d").over(Window.partitionBy("k").orderBy("d", "id"))))
    j = g.join(ref.select("id", "g2"), "id")
    assert j.where("NOT (gap_days <=> g2)").count() == 0


def test_vector_search_blocks_match_brute_force(spark, monkeypatch):
    import numpy as np
    from strata.operators import search as SE
    rng = np.random.default_rng(7)
    docs = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(40)]
    qs = [(100 + j, [float(x) for x in rng.normal(size=6)]) for j in range(10)]
    monkeypatch.setattr(SE, "QUERY_BLOCK", 3)        # 10 queries -> 4 blocks
    d = spark.createDataFrame(docs, "doc_id long, v array<double>")
    q = spark.createDataFrame(qs, "qid long, qv array<double>")
    got = {(r.qid, r.doc_id) for r in SE.vector_search(d, "doc_id", "v", q, "qid", "qv", k=3).collect()}
    D = np.array([v for _, v in docs])
    want = set()
    for qid, qv in qs:
        s = D @ np.array(qv) / (np.linalg.norm(D, axis=1) * np.linalg.norm(qv))
        want |= {(qid, docs[i][0]) for i in np.argsort(-s)[:3]}
    assert got == want


def test_with_scalar_is_a_subquery_not_a_join(spark):
    from strata.operators import joins as J
    df = spark.range(0, 100).withColumnRenamed("id", "x")
    out = J.with_scalar(df, df.agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "Cartesian" not in plan
    assert {(r.n, r.s) for r in out.collect()} == {(100, 4950)}
    with pytest.raises(Exception):
        J.with_scalar(df, df.select("x")).collect()                # more than one row: error, no fan-out


def test_classification_report_counts(spark):
    from strata.ml import metrics as MT
    rows = [(1, 1)] * 5 + [(1, 0)] * 2 + [(0, 0)] * 4 + [(0, 1)] * 1 + [(2, 1)] * 3
    df = spark.createDataFrame(rows, "label int, prediction int")
    rep = {r["class"]: r for r in MT.classification_report(df, "prediction", "label").collect()}
    assert set(rep) == {0, 1, 2}
    assert rep[1].precision == 5 / 9 and rep[1].recall == 5 / 7 and rep[1].support == 7
    assert rep[0].precision == 4 / 6 and rep[0].recall == 4 / 5 and rep[2].precision is None
    assert rep[2].recall == 0.0 and rep[2].support == 3
    assert all(r.accuracy == 9 / 15 for r in rep.values())


def test_bm25_blocks_equal_the_definition(spark, monkeypatch):
    from strata.operators import search as SE
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    qs = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    import math
    import re
    from collections import Counter
    tok = lambda t: [w for w in re.split("[^a-z0-9]+", t.lower()) if w]
    tf = {r.doc_id: Counter(tok(r.text)) for r in docs.collect()}
    tf = {k: v for k, v in tf.items() if v}
    df = Counter(t for c in tf.values() for t in c)
    mean = sum(sum(c.values()) for c in tf.values()) / len(tf)
    want = {}
    for r in qs.collect():
        score = {}
        for d, c in tf.items():
            own = [t for t in set(tok(r.text)) if t in c]
            if own:
                s = sum(math.log(1 + (len(tf) - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for t in own)
                score[d] = math.floor(s * 1e9 + 0.5) / 1e9
        want[r.item_id] = [d for d, _ in sorted(score.items(), key=lambda x: (-x[1], x[0]))[:8]]
    for part, blocks in ((2048, 1), (16, 2)):
        monkeypatch.setattr(SE, "PART", part)
        monkeypatch.setattr(SE, "BLOCKS", blocks)
        got = {}
        for r in SE.bm25_search(docs, "doc_id", "text", qs, "item_id", "text", k=8).orderBy("item_id", "rank").collect():
            got.setdefault(r.item_id, []).append(r.doc_id)
        assert got == {k: v for k, v in want.items() if v}


def test_bucketed_table_aggregates_without_shuffle(spark):
    d = tempfile.mkdtemp(prefix="strata-bucket-")
    df = spark.range(0, 2000).select((F.col("id") % 37).alias("user_id"), F.col("id").cast("double").alias("x"))
    t = io.materialize_bucketed(df, os.path.join(d, "ppe"), ["user_id"])
    g = t.groupBy("user_id").agg(F.sum("x").alias("s"))
    assert "Exchange" not in g._jdf.queryExecution().executedPlan().toString()
    assert g.count() == 37 and abs(g.agg(F.sum("s")).first()[0] - 1999 * 2000 / 2) < 1e-6


def test_scale_conf_sizes_partitions():
    from strata.session import scale_conf
    c = scale_conf(20 * 10**12, 8000)
    assert c["spark.sql.shuffle.partitions"] == "95368"                        # ~200 MB per partition
    assert scale_conf(10**9, 8000)["spark.sql.shuffle.partitions"] == "24000"  # at least 3 tasks per core


def test_semantic_filters_reach_or_raise():
    from strata.plans import models as MD
    m = MD.retail()
    _, _, plans = m._plan(["total_net_revenue"], ["channel"], ["segment"])
    assert any(r.right == "customers" for r in plans[0][2])
    with pytest.raises(ValueError):
        m._plan(["total_kpi_orders"], ["kpi_channel"], ["segment"])        # a fact without a path to the filter's table


def test_rank_of_nulls_equals_the_window(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7), (4, None), (5, 5)], "id int, v int")
    for down in (True, False):
        order = F.col("v").desc_nulls_last() if down else F.col("v").asc_nulls_last()
        want = {r.id: r.w for r in df.withColumn("w", F.rank().over(Window.orderBy(order))).collect()}
        assert {r.id: r["rank"] for r in W.rank_distributed(df, "v", descending=down).collect()} == want


def test_promises_come_from_redacted_text(spark):
    from strata.operators import text as TX
    text = ("I will email you at jane.doe@corp.com or (212) 555-0143 or +1 (212) 555-0143, card 1234 5678 9012 3456, "
            "ssn 123-45-6789, host 10.0.0.1, born 01/02/1990 today.")
    turns = spark.createDataFrame([(1, 1, "assistant", text)], "conv_id int, turn int, role string, text string")
    got = TX.commitments(TX.redact(turns, "text"), "conv_id", "turn", "role", "text").first()["commitment"]
    assert got == ("Commitment: I will email you at [EMAIL] or [PHONE] or [PHONE], card [CARD], ssn [SSN], host [IP], born [DOB] today.")


def test_a_text_model_sees_bounded_slices(spark, monkeypatch):
    from strata.operators import udf
    texts = ["a bb. " * 300, None, "", "one two! three", "x" * 5000, "y z?"] * 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    schema = "doc_id long, sentences long, mean_word_len double, words_per_sentence double"
    want = udf.text_stats(df.toPandas())
    monkeypatch.setattr(udf, "SLICE_CHARS", 4000)
    slices = list(udf._slices(df.toPandas()))
    assert sum(map(len, slices)) == len(texts) and len(slices) > 20
    assert all(len(s) == 1 or s["text"].fillna("").str.len()[:-1].sum() < 4000 for s in slices)

    def seen(pdf):
        return udf.text_stats(pdf).assign(words_per_sentence=float(len(pdf)))

    rows = udf.apply_text_model(df, seen, schema).collect()
    assert [tuple(r)[:3] for r in rows] == [tuple(r)[:3] for r in want.itertuples(index=False)]


def test_game_events_are_dealt_before_they_are_drawn(spark, tmp_path, monkeypatch):
    from strata.plans import q_core
    spark.range(100).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    want = sorted(map(tuple, q_core.gen_game_events(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(q_core, "GEN_CUSTOMERS", 10)
    assert q_core.gen_session_rows(spark, str(tmp_path)).rdd.getNumPartitions() == 10
    assert sorted(map(tuple, q_core.gen_game_events(spark, str(tmp_path)).collect())) == want
    assert len(want) == 10 and 2000 <= sum(r[1] for r in want) < 6000


def test_summaries_in_parts_are_those_of_one_part(spark, monkeypatch):
    rows = [(i % 40, f"alpha w{i % 7} beta. gamma w{i % 5} delta? w{i} alone here!  . w{i % 3} w{i % 3} w{i} tail") for i in range(60)]
    rows += [(100, None), (101, ""), (102, " .  ... "), (103, "one"), (None, "alpha gamma. w1 w2")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {r.doc_id: r.summary for r in TX.summarize(df, "doc_id", "text").collect()}
    monkeypatch.setattr(TX, "SUMMARY_PART_BYTES", 200)
    cut = TX.summarize(df, "doc_id", "text")
    assert {r.doc_id: r.summary for r in cut.collect()} == want and set(want) == {*range(40), 103}
    # the two rows of document 0 are one: its sentences at the same place come together
    assert want[39] == "w39 alone here. w0 w0 w39 tail"
    # no row a word is shuffled: texts, keys and the parts' terms are
    assert "Join" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_an_index_has_a_task_a_part(spark, monkeypatch):
    from strata.operators import search
    docs = spark.createDataFrame([(i, f"w{i} w{i % 3} " * (1 + i % 9)) for i in range(90)], "doc_id long, text string")
    monkeypatch.setattr(search, "PART", 4)
    plans = []
    monkeypatch.setattr(search, "materialize", lambda df, path: plans.append(df) or df)
    search.build_index(docs, "doc_id", "text")
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and ", 23)" in plan


def test_index_counts_tokens_without_a_row_a_token(spark, monkeypatch):
    from strata.operators import search
    monkeypatch.setattr(search, "BLOCKS", 1)
    docs = spark.createDataFrame([(1, "b a B"), (2, "c a a"), (2, "c a a"), (None, "a c d"), (4, ""), (5, None), (6, "a " * 9)], "doc_id long, text string")
    plans, real = [], search.materialize
    monkeypatch.setattr(search, "materialize", lambda df, path: plans.append(df) or real(df, path))
    index = search.build_index(docs, "doc_id", "text")
    got = {(r.block, r.term): (sorted(zip(r["keys"], r.tfs, r.dls), key=str), r.tf_max, r.dl_min, r.tokens, r.heads) for r in index.collect()}
    assert {r.part for r in index.collect()} == {0}
    assert got == {(3, "a"): ([(1, 1, 3), (2, 4, 3), (None, 1, 3)], 4, 3, 6, 1), (3, "b"): ([(1, 2, 3)], 2, 3, 2, 1),
                   (3, "c"): ([(2, 2, 3), (None, 1, 3)], 2, 3, 3, 1), (3, "d"): ([(None, 1, 3)], 1, 3, 1, 0), (6, "a"): ([(6, 9, 9)], 9, 9, 9, 1)}
    assert "Generate" not in plans[0]._jdf.queryExecution().optimizedPlan().toString()
    # long documents make more parts
    monkeypatch.setattr(search, "PART_CHARS", 10)
    search.build_index(docs, "doc_id", "text")
    assert ", 4)" in plans[1]._jdf.queryExecution().executedPlan().toString()


def test_search_leaves_postings_of_other_terms_where_they_are(spark):
    from strata.operators import search
    docs = spark.createDataFrame([(i, f"w{i} w{i % 3}") for i in range(90)], "doc_id long, text string")
    asked = spark.createDataFrame([(7, "w1 w80"), (8, "none")], "item_id long, text string")
    hits = search.bm25_search(docs, "doc_id", "text", asked, "item_id", "text", k=1)
    assert [(r.item_id, r.doc_id, r["rank"]) for r in hits.collect()] == [(7, 80, 1)]
    plan = hits._jdf.queryExecution().toString()
    assert "BroadcastHashJoin [term" in plan and "SortMergeJoin" not in plan


def test_churn_features_read_the_sales_once(spark, monkeypatch):
    import datetime as dt

    from strata.ml import churn
    day = lambda n: dt.date(2001, 1, 1) + dt.timedelta(n)
    row = lambda c, n, o, p="p": (c, day(n) if n is not None else None, o, p, f"c{o % 2}", 10.0, False, 0.1)
    sales = spark.createDataFrame([row(1, 0, 1), row(1, 9, 2, "q"), row(1, 12, 3), row(2, 5, 4), row(2, 40, 5), row(3, 10, 6), row(None, 1, 7), row(4, None, 8)],
                                  ", ".join(f"{c} {t}" for c, t in zip(["customer_id", "sale_date", "order_id", "product_id", "channel", "net_revenue", "return_flag", "discount_pct"],
                                                                       "long date long string string double boolean double".split())))
    customers = spark.createDataFrame([(1, "UNITED STATES"), (2, "PERU")], "customer_id long, country string")
    written, real = [], churn.materialize
    monkeypatch.setattr(churn, "materialize", lambda df, path: written.append(df) or real(df, path))
    x = churn.churn_features(sales, customers, "2001-01-11", 20)
    got = {r.customer_id: (r.total_orders, r.product_diversity, r.channel_diversity, r.is_international, r.label) for r in x.collect()}
    assert got == {1: (2, 2, 2, 0, 0), 2: (1, 1, 1, 1, 1)}
    # no join nor aggregate goes back to the sales that were handed in
    assert len(written) == 1 and x._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
