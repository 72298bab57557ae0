"""Churn / rebooking-risk models on Spark ML.

Training is distributed (``GBTClassifier``); scoring is ``transform``; nothing
is collected but metrics and importances (one row per feature).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir, shared_table_path
from ..sources.io import materialize

# Booster settings of the two applications.
RETAIL_GBT = dict(maxIter=300, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42)
SPA_GBT = dict(maxIter=200, maxDepth=5, stepSize=0.1, subsamplingRate=0.8, seed=42)

ROWS_PER_TASK = 100_000

CHURN_FEATURES = ["days_since", "tenure_days", "total_orders", "purchase_frequency", "avg_order_value", "total_spend_12m",
                  "promo_share", "recent_lines", "satisfaction", "return_rate", "lifetime_value",
                  "product_diversity", "channel_diversity", "is_international"]
# what the features and the label are measured on
SALE_COLUMNS = ["customer_id", "sale_date", "order_id", "product_id", "channel", "net_revenue", "return_flag", "discount_pct"]
# Leak-free rebooking features (T11: days_since_last_visit defines the label, so it is left out).
REBOOK_FEATURES = ["tenure_days", "total_appointments", "completed_count", "no_show_rate", "cancellation_rate",
                   "avg_days_between_visits", "avg_duration_mins", "avg_days_booked_advance", "app_booking_pct",
                   "service_categories", "total_spend", "avg_order_value", "avg_tip", "tip_rate", "spend_trend"]


def churn_features(sales: DataFrame, customers: DataFrame, cut: str, days: int, home: str = "UNITED STATES") -> DataFrame:
    """ML-01 numeric features, label and legacy score of every customer with a sale before ``cut``.

    Features and legacy score are measured on the sales before the cut; the label is whether no sale
    follows in the ``days`` from the cut on, so no feature knows it.  The reference's features of e-mail,
    web, survey and support data have no column here.  The sales are read once and written, with the
    columns needed: features and label are aggregates of what was written.
    """
    from ..marts.retail import customer_value
    at = F.lit(cut).cast("date")
    sales = materialize(sales.where(F.col("sale_date") < F.date_add(at, days)).select(*SALE_COLUMNS), shared_table_path(sales.sparkSession, "churn_sales"))
    before = sales.where(F.col("sale_date") < at)
    wide = before.groupBy("customer_id").agg(F.countDistinct("product_id").alias("product_diversity"), F.countDistinct("channel").alias("channel_diversity"))
    abroad = customers.select("customer_id", (F.col("country") != home).alias("is_international"))
    later = sales.where(F.col("sale_date") >= at).select("customer_id").distinct().withColumn("_back", F.lit(1))
    x = customer_value(before, cut).join(wide, "customer_id").join(abroad, "customer_id", "left").join(later, "customer_id", "left")
    return x.select("customer_id", *[F.col(c).cast("double").alias(c) for c in CHURN_FEATURES],
                    F.col("_back").isNull().cast("int").alias("label"), F.col("legacy_churn_score").alias("legacy_score"))


def rebooking_rows(appointments: DataFrame, cut: str, days: int) -> DataFrame:
    """ML-04 features of the appointments before ``cut`` and the label: no completed one in the ``days`` from it on."""
    from ..marts.spa import completed, rebooking_features
    at = F.lit(cut).cast("date")
    f = rebooking_features(appointments.where(F.col("appointment_date") < at), cut).drop("at_risk")
    later = completed(appointments).where((F.col("appointment_date") >= at) & (F.col("appointment_date") < F.date_add(at, days))) \
        .select("client_id").distinct().withColumn("_back", F.lit(1))
    return f.join(later, "client_id", "left").select(
        "client_id", F.col("_back").isNull().cast("int").alias("label"), *[F.col(c).cast("double").alias(c) for c in REBOOK_FEATURES])


def trained(spark: SparkSession, folder: str, mark: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
    """The model kept under ``folder/mark``, fitted and saved first if there is none: ``mark`` stands for all it was made from."""
    path = os.path.join(folder, mark)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "metadata", "_SUCCESS"))
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        fit().write().overwrite().save(path)
    return PipelineModel.load(path)


def fit_gbt(train: DataFrame, features: Sequence[str], label: str = "label", **params) -> PipelineModel:
    """ML-03/04 gradient-boosted trees in a pipeline with the feature assembler.

    A tree takes a job per level, so the rows are dealt to tasks of ``ROWS_PER_TASK``, not to more.
    """
    train = cut_lineage(train.repartition(max(1, -(-train.count() // ROWS_PER_TASK))))
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(featuresCol="features", labelCol=label, **params)
    return Pipeline(stages=[asm, gbt]).fit(train)


def score(model: PipelineModel, df: DataFrame, threshold: float = 0.5, digits: int = 4,
          scored_at: str | None = None) -> DataFrame:
    """ML-05/12 probability of class 1, class at the threshold, rounded score, scoring timestamp."""
    out = model.transform(df)
    p1 = vector_to_array("probability")[1]
    out = out.withColumns({"score": F.round(p1, digits), "prediction": (p1 >= threshold).cast("int")})
    if scored_at is not None:
        out = out.withColumn("scored_at", F.lit(scored_at).cast("timestamp_ntz"))
    return out.drop("features", "rawPrediction", "probability")


def importances(model: PipelineModel, features: Sequence[str], top: int | None = None, spark=None) -> DataFrame:
    """ML-09 feature importances (one row per feature)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    spark = spark or SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(features, [float(v) for v in imp])), "feature string, importance double")
    df = df.orderBy(F.desc("importance"), F.asc("feature"))
    return df.limit(top) if top else df


def save_model(model: PipelineModel, name: str, version: str, spark, metrics: dict | None = None,
               root: str | None = None) -> tuple[str, DataFrame]:
    """ML-10 versioned save (replaced on rerun) into the shared folder + a metrics row."""
    root = root or os.path.join(ensure_checkpoint_dir(spark), "models")
    path = os.path.join(root, name, version)
    model.write().overwrite().save(path)
    row = {"model_name": name, "version": version, "path": path, **{k: float(v) for k, v in (metrics or {}).items()}}
    return path, spark.createDataFrame([row])


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def text_classifier(train: DataFrame, text: str = "text", label: str = "label", num_features: int = 1 << 18) -> PipelineModel:
    """TXT-04 trained classifier: tokenizer -> hashing TF -> IDF -> logistic regression."""
    stages = [RegexTokenizer(inputCol=text, outputCol="_tok", pattern="[^a-z0-9]+", toLowercase=True),
              HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
              IDF(inputCol="_tf", outputCol="features"),
              LogisticRegression(featuresCol="features", labelCol=label, maxIter=50, regParam=0.01)]
    return Pipeline(stages=stages).fit(train)
