"""Machine learning and monitoring queries (ML-01..15, MON-01..04, TXT-04)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import keyed as K
from ..marts import retail as M
from ..ml import churn as CH
from ..ml import metrics as MT
from ..operators import joins as J
from ..operators import windows as W
from ..sources.io import scan
from .catalog import ORACLE, register
from .q_retail import _CV_SQL
from .roles import AS_OF_EVENTS as EV, AS_OF_ORDERS as ORD, R, Roles

_CV = f"({ORACLE['mart_customer_value']})"
# Features before the cut, label from the days after it.
CUT, DAYS = "2001-02-03", 180
SPA_CUT, SPA_DAYS = "2024-01-30", 2
_CV_CUT = _CV_SQL.replace(ORD, CUT).replace("FROM sales GROUP BY 1)", f"FROM sales WHERE sale_date < DATE '{CUT}' GROUP BY 1)", 1)
_FEAT_SQL = (f"{R('sales', 'customers')}, wide AS (SELECT customer_id, count(DISTINCT product_id) AS product_diversity, count(DISTINCT channel) AS channel_diversity "
             f"FROM sales WHERE sale_date < DATE '{CUT}' GROUP BY 1), "
             f"later AS (SELECT DISTINCT customer_id FROM sales WHERE sale_date >= DATE '{CUT}' AND sale_date < DATE '{CUT}' + {DAYS}), "
             "f AS (SELECT v.*, wide.product_diversity, wide.channel_diversity, customers.country <> 'UNITED STATES' AS is_international, "
             f"CAST(later.customer_id IS NULL AS INTEGER) AS label FROM ({_CV_CUT}) AS v JOIN wide USING (customer_id) LEFT JOIN customers USING (customer_id) "
             "LEFT JOIN later ON later.customer_id = v.customer_id), "
             "cf AS (SELECT customer_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in CH.CHURN_FEATURES)
             + ", label, legacy_churn_score AS legacy_score FROM f)")


def _features(spark, d):
    r = Roles(spark, d)
    return CH.churn_features(r.sales(), r.customers(), CUT, DAYS)


@register("ml_churn_features", f"WITH {_FEAT_SQL} SELECT * FROM cf", dbl=" ".join(CH.CHURN_FEATURES) + " legacy_score", big="label")
def ml_churn_features(spark, d):
    """ML-01 churn feature view: 14 features before the cut, label (no sale in the 180 days after it), legacy score."""
    return _features(spark, d)


# documents scored by a length-based expression, labelled by labels.quality (FIXTURES §6)
_DOC_SCORE = "floor((1 - exp(-d.n_chars / 3000.0)) * 10000 + 0.5) / 10000"
_LAB_SQL = f"x AS (SELECT l.doc_id, l.quality AS label, {_DOC_SCORE} AS score, d.n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"


def _scored_labels(spark, d):
    lab, doc = scan(spark, d, "labels"), scan(spark, d, "documents").select("doc_id", "n_chars")
    sc = F.floor((1 - F.exp(-F.col("n_chars") / 3000.0)) * 10000 + 0.5) / 10000
    return lab.join(doc, "doc_id").select("doc_id", F.col("quality").alias("label"), sc.alias("score"), "n_chars")


_AUC_SQL = ("r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS ar FROM {T}), "
            "pn AS (SELECT sum(label) AS p, count(*) - sum(label) AS n FROM {T}) "
            "SELECT (sum(ar) FILTER (WHERE label = 1) - max(pn.p) * (max(pn.p) + 1) / 2.0) / (max(pn.p) * max(pn.n)) AS roc_auc FROM r, pn")


@register("ml_roc_auc_documents", f"WITH {_LAB_SQL}, " + _AUC_SQL.replace("{T}", "x"), dbl="roc_auc")
def ml_roc_auc_documents(spark, d):
    """ML-07 ROC AUC with tied scores (distributed prefix counts over distinct scores)."""
    return MT.roc_auc(_scored_labels(spark, d), "score", "label")


@register("ml_roc_auc_legacy", f"WITH {_FEAT_SQL}, y AS (SELECT label, legacy_score AS score FROM cf), " + _AUC_SQL.replace("{T}", "y"), dbl="roc_auc")
def ml_roc_auc_legacy(spark, d):
    """ML-07/11 AUC of the legacy rule score against the churn label (baseline to beat)."""
    return MT.roc_auc(_features(spark, d), "legacy_score", "label")


@register("ml_average_precision", f"WITH {_LAB_SQL}, c AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM x GROUP BY 1), "
          "p AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cp, sum(neg) OVER (ORDER BY score DESC) AS cn FROM c) "
          "SELECT sum(pos / (SELECT sum(pos) FROM c) * cp / (cp + cn)) AS average_precision FROM p", dbl="average_precision")
def ml_average_precision(spark, d):
    """ML-08 average precision (PR AUC) over distinct thresholds."""
    return MT.average_precision(_scored_labels(spark, d), "score", "label")


@register("ml_classification_report", f"WITH {_FEAT_SQL}, y AS (SELECT label AS yl, CAST(legacy_score >= 0.5 AS INTEGER) AS pl FROM cf), "
          "cls AS (SELECT DISTINCT yl AS class FROM y UNION SELECT DISTINCT pl FROM y), "
          "g AS (SELECT class, count(*) FILTER (WHERE yl = class AND pl = class) AS tp, count(*) FILTER (WHERE yl != class AND pl = class) AS fp, "
          "count(*) FILTER (WHERE yl = class AND pl != class) AS fn FROM cls, y GROUP BY class) "
          "SELECT class, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, tp + fn AS support, "
          "2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0)) / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0) AS f1, "
          "(SELECT avg(CASE WHEN yl = pl THEN 1.0 ELSE 0.0 END) FROM y) AS accuracy FROM g",
          dbl="precision recall f1 accuracy", big="class support")
def ml_classification_report(spark, d):
    """ML-06 accuracy, precision, recall, F1, support per class (legacy score at 0.5)."""
    f = _features(spark, d).withColumn("pred", (F.col("legacy_score") >= 0.5).cast("int"))
    return MT.classification_report(f, "pred", "label")


@register("ml_stratified_split", "WITH h AS (SELECT doc_id, quality, " + K.sql_hash32("doc_id", "split") + " AS h FROM labels), "
          "r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) AS rn, count(*) OVER (PARTITION BY quality) AS nl FROM h) "
          "SELECT doc_id, quality, CASE WHEN rn <= floor(nl * 0.8 + 0.5) THEN 'train' ELSE 'test' END AS split FROM r", big="quality")
def ml_stratified_split(spark, d):
    """ML-02 deterministic stratified 80/20 split (salted hash rank within each label)."""
    return MT.stratified_split(scan(spark, d, "labels").select("doc_id", "quality"), "doc_id", "quality")


@register("ml_prediction_summary", f"WITH {_FEAT_SQL} SELECT CAST(legacy_score >= 0.5 AS INTEGER) AS predicted_class, count(*) AS customers, "
          "avg(legacy_score) AS mean_score, count(*) FILTER (WHERE legacy_score >= 0.7) AS high_risk FROM cf GROUP BY 1",
          dbl="mean_score", big="predicted_class")
def ml_prediction_summary(spark, d):
    """ML-13 prediction distribution: count and mean score per class, high-risk count."""
    f = _features(spark, d)
    return f.groupBy((F.col("legacy_score") >= 0.5).cast("int").alias("predicted_class")).agg(
        F.count(F.lit(1)).alias("customers"), F.avg("legacy_score").alias("mean_score"),
        F.count(F.when(F.col("legacy_score") >= 0.7, 1)).alias("high_risk"))


@register("ml_retention_list", f"SELECT cv.customer_id, cv.lifetime_value, cv.churn_probability, c.c_mktsegment AS segment FROM {_CV} AS cv "
          "JOIN customer c ON cv.customer_id = c.c_custkey WHERE cv.churn_probability >= 0.5 "
          "ORDER BY cv.lifetime_value DESC, cv.customer_id LIMIT 15", dbl="lifetime_value churn_probability")
def ml_retention_list(spark, d):
    """ML-14 retention list: predicted churners by lifetime value, top 15."""
    cv = M.customer_value(Roles(spark, d).sales(), ORD).where(F.col("churn_probability") >= 0.5) \
        .select("customer_id", "lifetime_value", "churn_probability")
    c = scan(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    x = cv.join(c, "customer_id").select("customer_id", "lifetime_value", "churn_probability", "segment")
    return W.top_k(x, [F.desc("lifetime_value"), F.asc("customer_id")], 15)


# ---------------------------------------------------------------- monitoring
_MON_SQL = ("hs AS (SELECT doc_id, quality, " + K.sql_hash32("doc_id", "split") + " AS h FROM labels), "
            "sp AS (SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) <= "
            "floor(count(*) OVER (PARTITION BY quality) * 0.8 + 0.5) THEN 'train' ELSE 'test' END AS split FROM hs), "
            f"src AS (SELECT x.*, sp.split, CAST(DATE '{EV}' - 28 + CAST(" + K.sql_hash32("x.doc_id", "mon") + " % 28 AS INTEGER) AS DATE) AS pred_date "
            "FROM x JOIN sp ON x.doc_id = sp.doc_id)")


def _monitor_frames(spark, d):
    """MON-01 baseline (train ids) and source (test ids) frames; prediction dates spread over 28 days by hash."""
    x = _scored_labels(spark, d)
    sp = MT.stratified_split(scan(spark, d, "labels").select("doc_id", "quality"), "doc_id", "quality").select("doc_id", "split")
    src = x.join(sp, "doc_id").withColumn(
        "pred_date", F.date_add(F.date_sub(F.lit(EV).cast("date"), 28), F.pmod(K.hash32("doc_id", "mon"), F.lit(28)).cast("int")))
    return src


@register("mon_frames", f"WITH {_LAB_SQL}, {_MON_SQL} SELECT doc_id, label, score, split, pred_date FROM src", dbl="score", big="label")
def mon_frames(spark, d):
    """MON-01 monitor frames (split membership is a semi join on the split ids)."""
    return _monitor_frames(spark, d).select("doc_id", "label", "score", "split", "pred_date")


@register("mon_daily_auc", f"WITH {_LAB_SQL}, {_MON_SQL}, r AS (SELECT pred_date, label, rank() OVER (PARTITION BY pred_date ORDER BY score) + "
          "(count(*) OVER (PARTITION BY pred_date, score) - 1) / 2.0 AS ar FROM src WHERE split = 'test'), "
          "pn AS (SELECT pred_date, sum(label) AS p, count(*) - sum(label) AS n FROM src WHERE split = 'test' GROUP BY 1) "
          "SELECT r.pred_date, (sum(ar) FILTER (WHERE label = 1) - max(pn.p) * (max(pn.p) + 1) / 2.0) / nullif(max(pn.p) * max(pn.n), 0) AS roc_auc "
          "FROM r JOIN pn ON r.pred_date = pn.pred_date GROUP BY 1", dbl="roc_auc")
def mon_daily_auc(spark, d):
    """MON-02 daily performance metric: ROC AUC per prediction day over the source frame."""
    src = _monitor_frames(spark, d).where(F.col("split") == "test")
    return MT.roc_auc(src, "score", "label", group="pred_date")


@register("mon_daily_prediction_stats", f"WITH {_LAB_SQL}, {_MON_SQL} SELECT pred_date, count(*) AS predictions, avg(score) AS mean_score, "
          "avg(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END) AS share_class1 FROM src WHERE split = 'test' GROUP BY 1",
          dbl="mean_score share_class1")
def mon_daily_prediction_stats(spark, d):
    """MON-04 daily prediction distribution (1-day tumbling groups)."""
    from ..operators.aggs import rate
    src = _monitor_frames(spark, d).where(F.col("split") == "test")
    return src.groupBy("pred_date").agg(F.count(F.lit(1)).alias("predictions"), F.avg("score").alias("mean_score"),
                                        rate(F.col("score") >= 0.5).alias("share_class1"))


def _psi_sql(col):
    return (f"e AS (SELECT k, {col} AS edge FROM (SELECT {col}, row_number() OVER (ORDER BY {col}, doc_id) AS rn, count(*) OVER () AS n "
            "FROM src WHERE split = 'train'), range(1, 10) t(k) WHERE rn = ceil(k * n / 10.0)), "
            f"b AS (SELECT (SELECT count(*) FROM e WHERE e.edge < s.{col}) AS bin, split FROM src s), "
            "sh AS (SELECT bin, split, count(*) / sum(count(*)) OVER (PARTITION BY split) AS share FROM b GROUP BY 1, 2), "
            "bins AS (SELECT range AS bin FROM range(0, 10)), "
            "j AS (SELECT greatest(coalesce(tr.share, 0), 1e-6) AS bs, greatest(coalesce(te.share, 0), 1e-6) AS cs FROM bins "
            "LEFT JOIN sh tr ON tr.bin = bins.bin AND tr.split = 'train' LEFT JOIN sh te ON te.bin = bins.bin AND te.split = 'test') "
            f"SELECT '{col}' AS feature, sum((cs - bs) * ln(cs / bs)) AS psi FROM j")


@register("mon_psi_score", f"WITH {_LAB_SQL}, {_MON_SQL}, " + _psi_sql("score"), dbl="psi")
def mon_psi_score(spark, d):
    """MON-03 PSI of the score: baseline (train) decile edges vs current (test) shares."""
    src = _monitor_frames(spark, d)
    return MT.psi(src.where(F.col("split") == "train"), src.where(F.col("split") == "test"), "score", "doc_id")


@register("mon_psi_length", f"WITH {_LAB_SQL}, {_MON_SQL}, " + _psi_sql("n_chars"), dbl="psi")
def mon_psi_length(spark, d):
    """MON-03 PSI of a feature (document length)."""
    src = _monitor_frames(spark, d)
    return MT.psi(src.where(F.col("split") == "train"), src.where(F.col("split") == "test"), "n_chars", "doc_id")


# ---------------------------------------------------------------- trained models (rows-only checks)
def _kept_model(spark, d, name, tables, settings, fit):
    """The model of these settings and of the tables' files as they are: fitted if none is kept, else loaded."""
    import hashlib

    from .refresh import refresh_root, source_state
    made_of = [str(settings), *(x for t in tables for x in source_state(spark, scan(spark, d, t)))]
    return CH.trained(spark, refresh_root(spark, f"models/{name}"), hashlib.sha256("\n".join(made_of).encode()).hexdigest()[:16], fit)


def _churn_model(spark, d):
    """(model, test rows); the split is a function of the rows, so every query has the same one."""
    from ..session import cut_lineage
    # cut before the split too, which goes through its input twice (range bounds, then rows)
    sp = cut_lineage(MT.stratified_split(cut_lineage(_features(spark, d)), "customer_id", "label"))
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    model = _kept_model(spark, d, "churn", ("lineitem", "orders", "part", "customer", "nation", "region"), (CUT, DAYS, CH.CHURN_FEATURES, CH.RETAIL_GBT),
                        lambda: CH.fit_gbt(train, CH.CHURN_FEATURES, **CH.RETAIL_GBT))
    return model, test


@register("ml_gbt_churn_predictions")
def ml_gbt_churn_predictions(spark, d):
    """ML-03/05/12 boosted trees (300 x depth 4, lr .05, subsample .8, colsample .8) trained on the
    stratified train split; test rows scored with probability, class at 0.5 and a scored_at stamp."""
    model, test = _churn_model(spark, d)
    return CH.score(model, test, scored_at=f"{ORD} 00:00:00").select("customer_id", "label", "score", "prediction", "scored_at")


@register("ml_gbt_vs_legacy")
def ml_gbt_vs_legacy(spark, d):
    """ML-11 new model AUC vs legacy score AUC on the same test rows, plus AP and importances count."""
    model, test = _churn_model(spark, d)
    p = CH.score(model, test)
    a = MT.roc_auc(p, "score", "label").withColumnRenamed("roc_auc", "model_auc")
    b = MT.roc_auc(p, "legacy_score", "label").withColumnRenamed("roc_auc", "legacy_auc")
    c = MT.average_precision(p, "score", "label")
    return J.with_scalars(a, b, c)


@register("ml_feature_importances")
def ml_feature_importances(spark, d):
    """ML-09 top-10 feature importances of the churn model."""
    model, _ = _churn_model(spark, d)
    return CH.importances(model, CH.CHURN_FEATURES, top=10, spark=spark)


@register("ml_model_versioning")
def ml_model_versioning(spark, d):
    """ML-10 versioned save (overwrite on rerun) to the shared folder, reload, score; metrics row."""
    from .refresh import refresh_root
    model, test = _churn_model(spark, d)
    auc = MT.roc_auc(CH.score(model, test), "score", "label").first()["roc_auc"]
    path, row = CH.save_model(model, "churn_gbt", "v1", spark, {"roc_auc": auc or 0.0}, refresh_root(spark, "models/versions"))
    again = CH.score(CH.load_model(path), test)
    return J.with_scalars(row, again.agg(F.count(F.lit(1)).alias("rows_scored_after_reload")))


@register("ml_rebooking_model")
def ml_rebooking_model(spark, d):
    """ML-04 rebooking-risk boosted trees (200 x depth 5, lr .1, subsample .8) on leak-free features;
    classification report on the held-out split (T11)."""
    sp = MT.stratified_split(CH.rebooking_rows(Roles(spark, d).appointments(), SPA_CUT, SPA_DAYS), "client_id", "label")
    model = _kept_model(spark, d, "rebooking", ("events",), (SPA_CUT, SPA_DAYS, CH.REBOOK_FEATURES, CH.SPA_GBT),
                        lambda: CH.fit_gbt(sp.where(F.col("split") == "train"), CH.REBOOK_FEATURES, **CH.SPA_GBT))
    p = CH.score(model, sp.where(F.col("split") == "test"))
    return MT.classification_report(p, "prediction", "label")


@register("txt_trained_classifier")
def txt_trained_classifier(spark, d):
    """TXT-04 trained text classifier (TF-IDF + logistic regression) on labelled documents;
    held-out predictions with ROC AUC per split."""
    lab = scan(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = scan(spark, d, "documents").select("doc_id", "text")
    # ids and labels alone are numbered and checkpointed; the texts are joined to their split afterwards
    sp = docs.join(MT.stratified_split(lab.join(docs.select("doc_id"), "doc_id", "left_semi"), "doc_id", "label"), "doc_id")
    model = CH.text_classifier(sp.where(F.col("split") == "train"))
    p = model.transform(sp.where(F.col("split") == "test"))
    p = p.select("doc_id", "label", F.round(vector_to_array("probability")[1], 4).alias("score"))
    return J.with_scalars(MT.roc_auc(p, "score", "label"), p.agg(F.count(F.lit(1)).alias("test_rows")))
