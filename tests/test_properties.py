"""Property tests: the distributed operators equal their single-machine definitions on random
inputs in which one key or value holds a large share of the rows (hot groups)."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.ml import metrics as MT
from strata.operators import windows as W

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def hot_rows(draw_n, hot_share):
    """(id, g, v) rows; about ``hot_share`` of them fall in group 0 / value 0."""
    rng = np.random.default_rng(draw_n)
    n = 50 + draw_n % 400
    g = np.where(rng.random(n) < hot_share, 0, rng.integers(1, 6, n))
    v = np.where(rng.random(n) < hot_share, 0, rng.integers(-20, 20, n))
    return pd.DataFrame({"id": np.arange(n, dtype="int64"), "g": g.astype("int64"), "v": v.astype("int64")})


@SETTINGS
@given(seed=st.integers(0, 10_000), hot=st.sampled_from([0.0, 0.34, 0.9]))
def test_row_number_and_rank(spark, seed, hot):
    pdf = hot_rows(seed, hot)
    df = spark.createDataFrame(pdf)
    rn = {r.id: r.rn for r in W.row_number_distributed(df, ["v", "id"], "rn", partitions=4).collect()}
    want = pdf.sort_values(["v", "id"]).reset_index(drop=True)
    assert rn == {int(i): k + 1 for k, i in enumerate(want["id"])}
    rk = {r.id: r.rk for r in W.rank_distributed(df, "v", "rk").collect()}
    assert rk == dict(zip(pdf["id"], pdf["v"].rank(method="min", ascending=False).astype(int)))


@SETTINGS
@given(seed=st.integers(0, 10_000), hot=st.sampled_from([0.34, 0.9]))
def test_seq_within_hot_key(spark, seed, hot):
    pdf = hot_rows(seed, hot)
    got = {r.id: r.seq for r in W.seq_within(spark.createDataFrame(pdf), "g", ["v", "id"], "seq", partitions=4).collect()}
    s = pdf.sort_values(["g", "v", "id"])
    assert got == dict(zip(s["id"], s.groupby("g").cumcount() + 1))


@SETTINGS
@given(seed=st.integers(0, 10_000), k=st.integers(1, 7), hot=st.sampled_from([0.34, 0.9]))
def test_salted_top_k(spark, seed, k, hot):
    pdf = hot_rows(seed, hot)
    got = {(r.g, r.id, r.rank) for r in W.top_k_per_salted(
        spark.createDataFrame(pdf), "g", [F.desc("v"), F.asc("id")], k, ["id"], salts=4).collect()}
    s = pdf.sort_values(["g", "v", "id"], ascending=[True, False, True])
    s = s.assign(rank=s.groupby("g").cumcount() + 1)
    assert got == {(int(a), int(b), int(c)) for a, b, c in s[s["rank"] <= k][["g", "id", "rank"]].to_numpy()}


@SETTINGS
@given(seed=st.integers(0, 10_000))
def test_roc_auc_with_ties(spark, seed):
    rng = np.random.default_rng(seed)
    n = 80 + seed % 200
    pdf = pd.DataFrame({"score": rng.integers(0, 6, n).astype("float64"), "label": rng.integers(0, 2, n).astype("int64")})
    pos, neg = pdf[pdf.label == 1].score.to_numpy(), pdf[pdf.label == 0].score.to_numpy()
    if len(pos) == 0 or len(neg) == 0:
        return
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    got = MT.roc_auc(spark.createDataFrame(pdf), "score", "label").first()["roc_auc"]
    assert abs(got - want) < 1e-12
