"""Structured Streaming variants of the refreshed marts.

Sources are file streams over arriving parquet files.  Sinks never collect to
the driver: append streams write parquet; aggregate streams run in ``update``
mode and ``foreachBatch`` upserts the changed keys into a table kept by key
bucket in the shared checkpoint folder, of which a micro-batch rewrites the
buckets it touches.  A restarted query resumes from its checkpoint, and
re-running a batch rewrites what it wrote.  ``run`` drives a query to completion
with ``trigger(availableNow=True)`` - the batch refresh of a dynamic table - and
the same query runs continuously with ``processingTime``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

WATERMARK = "2 days"


def stream_scan(spark: SparkSession, path: str, schema: T.StructType, ts: str | None = "ts",
                max_files: int | None = None) -> DataFrame:
    """STR-01 continuous source over arriving parquet files; the event-time column is cast
    from TIMESTAMP_NTZ to TIMESTAMP (watermarks need it)."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    df = r.parquet(path)
    if ts and ts in df.columns:
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


class BucketTable:
    """Upsert target kept by key bucket: ``_bucket=<b>/_batch=<e>`` is bucket b after micro-batch e.

    A micro-batch reads the newest earlier state of the buckets that its keys fall in and writes these
    buckets alone, by Spark's dynamic partition overwrite; all others stay as they are.  Rows of batch e
    only ever replace rows of batch e, so running a batch again after a failure reads the same state and
    rewrites the same folders, and a job that dies while it commits loses nothing.  A batch counts once
    its marker is there.  Of every bucket the newest two states are kept: the current one and the one a
    repeated batch starts from.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], bucket_by: Sequence[str] | None = None, buckets: int = 32):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.bucket_by, self.buckets = list(bucket_by or keys), buckets
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        p = self._path(folder)
        if not self._fs.exists(p):
            return []
        names = [st.getPath().getName() for st in self._fs.listStatus(p)]
        return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())

    def batches(self) -> list[int]:
        """Numbers of the committed micro-batches."""
        return self._numbers(os.path.join(self.path, "_committed"), "e")

    def states(self, before: int | None = None) -> dict[int, int]:
        """The micro-batch that wrote each bucket's newest committed state (of those ``before`` one)."""
        done = {e for e in self.batches() if before is None or e < before}
        out = {}
        for b in self._numbers(self.path, "_bucket="):
            own = [e for e in self._numbers(os.path.join(self.path, f"_bucket={b}"), "_batch=") if e in done]
            if own:
                out[b] = own[-1]
        return out

    def latest(self, before: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The table's rows as of the last committed micro-batch (or the last one ``before``)."""
        dirs = [os.path.join(self.path, f"_bucket={b}", f"_batch={e}") for b, e in self.states(before).items()
                if buckets is None or b in set(buckets)]
        return self.spark.read.parquet(*dirs) if dirs else None

    def upsert(self, batch: DataFrame, epoch: int, combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None):
        """Replace rows of changed keys (or ``combine(old, batch)`` them) in the buckets that ``batch`` touches."""
        bucket = F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")
        batch = batch.persist()  # two jobs read it; the stream's own state must not be run twice
        try:
            touched = [r[0] for r in batch.select(bucket.alias("b")).distinct().collect()]  # at most as many as buckets
            old = self.latest(before=epoch, buckets=touched)
            if old is None:
                merged = batch
            elif combine is not None:
                merged = combine(old, batch)
            else:
                new = batch.select(*(F.col(k).alias(f"_new_{k}") for k in self.keys))
                same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in self.keys]  # a null key is a key
                merged = old.join(new, same, "left_anti").unionByName(batch)
            (merged.withColumns({"_bucket": bucket, "_batch": F.lit(epoch)}).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("_bucket", "_batch").parquet(self.path))
        finally:
            batch.unpersist()
        self._fs.mkdirs(self._path(os.path.join(self.path, "_committed", f"e{epoch}")))
        for b in touched:
            folder = os.path.join(self.path, f"_bucket={b}")
            for e in self._numbers(folder, "_batch=")[:-2]:
                self._fs.delete(self._path(os.path.join(folder, f"_batch={e}")), True)


def run_upsert(df: DataFrame, name: str, keys: Sequence[str], mode: str = "update",
               after: Callable[[BucketTable, int], None] | None = None,
               combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
               bucket_by: Sequence[str] | None = None, base: str | None = None) -> DataFrame:
    """Run an aggregate stream to completion; each micro-batch is upserted into a table kept by key bucket.

    ``base`` names the folder of table and checkpoint, so that a later run goes on from there.
    """
    spark = df.sparkSession
    base = base or scratch(spark, name)
    tbl = BucketTable(spark, os.path.join(base, "table"), keys, bucket_by)

    def sink(batch: DataFrame, epoch: int):
        tbl.upsert(batch, epoch, combine)
        if after is not None:
            after(tbl, epoch)

    q = (df.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    out = tbl.latest()
    return out if out is not None else spark.createDataFrame([], df.schema)


def run_append(df: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """Run an append stream to completion into a parquet sink and read it back; ``base`` as in ``run_upsert``."""
    spark = df.sparkSession
    base = base or scratch(spark, name)
    q = (df.writeStream.outputMode("append").format("parquet").option("path", os.path.join(base, "out"))
         .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(os.path.join(base, "out"))


# ---------------------------------------------------------------- stream definitions
def session_stream(events: DataFrame, key: str, ts: str, gap_minutes: int = 30,
                   watermark: str = WATERMARK) -> DataFrame:
    """STR-09 gap sessions per key by Spark's session windows (append mode): a session is written once,
    when the watermark has passed its end, and its state is dropped.  With
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` (set by ``build_session``) Spark
    merges each input partition's sessions before the shuffle: a hot key leaves it as one row per session.
    """
    w = events.withWatermark(ts, watermark).groupBy(F.session_window(ts, f"{gap_minutes} minutes").alias("w"), key)
    return w.agg(F.count(F.lit(1)).alias("events")).select(
        key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events")


def with_closing(events: DataFrame, ts: str, folder: str) -> DataFrame:
    """``events`` and the rows of a second file source, which holds nothing until ``close_stream`` writes to it."""
    spark = events.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    end = spark.readStream.schema(f"{ts} timestamp").parquet(folder)
    return events.unionByName(end, allowMissingColumns=True)


def close_stream(spark: SparkSession, ts: str, folder: str) -> None:
    """End of input: one row without key far in the future takes the watermark past every open window."""
    spark.sql(f"SELECT timestamp'9000-01-01' AS {ts}").write.mode("append").parquet(folder)


def ad_engagement_stream(purch: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """STR-02 running per-user ad metrics (update mode; ratios derived from running counts)."""
    recent = F.col("purchase_ts") >= F.lit(as_of).cast("date") - F.expr(f"INTERVAL {days} DAYS")
    bought = F.col("purchase_type") != "none"
    return purch.groupBy("user_id").agg(
        F.count("ad_interaction_id").alias("total_ads"), F.count(F.when(bought, F.col("purchase_id"))).alias("total_purchases"),
        F.sum("purchase_amount").alias("total_purchases_amount"),
        F.sum(F.when(bought, F.col("purchase_amount"))).alias("_bought_amount"),
        F.sum("ad_engagement_time").alias("_eng_sum"),
        F.count(F.when(recent, F.col("ad_interaction_id"))).alias("total_ads_last_30_days"),
        F.count(F.when(recent & bought, F.col("purchase_id"))).alias("total_purchases_last_30_days"),
        F.sum(F.when(recent, F.col("purchase_amount"))).alias("total_purchases_amount_last_30_days"),
        F.sum(F.when(recent & bought, F.col("purchase_amount"))).alias("_rb_amount"),
        F.sum(F.when(recent, F.col("ad_engagement_time"))).alias("_r_eng_sum"))


def finish_ad_engagement(t: DataFrame) -> DataFrame:
    """Read-time ratios over the maintained running sums (identical to the batch mart)."""
    def prop(n, d):
        return F.coalesce(F.try_divide(F.nullif(F.col(n), F.lit(0)).cast("double"), F.nullif(F.col(d), F.lit(0))), F.lit(0.0))
    return t.select(
        "user_id", "total_ads", "total_purchases", "total_purchases_amount",
        prop("total_purchases", "total_ads").alias("proportion_purchased"),
        F.coalesce(F.try_divide(F.col("_bought_amount"), F.col("total_purchases")), F.lit(0.0)).alias("average_purchase_amount"),
        F.try_divide(F.col("_eng_sum"), F.col("total_ads")).alias("average_ad_engagement_time"),
        "total_ads_last_30_days", "total_purchases_last_30_days", "total_purchases_amount_last_30_days",
        prop("total_purchases_last_30_days", "total_ads_last_30_days").alias("proportion_purchased_last_30_days"),
        F.coalesce(F.try_divide(F.col("_rb_amount"), F.col("total_purchases_last_30_days")), F.lit(0.0))
        .alias("average_purchase_amount_last_30_days"),
        F.try_divide(F.col("_r_eng_sum"), F.col("total_ads_last_30_days")).alias("average_ad_engagement_time_last_30_days"))
