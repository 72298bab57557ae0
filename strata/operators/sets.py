"""Set operations and data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """SET-01/02 UNION ALL by column name (NULL-padded when allow_missing)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=allow_missing)
    return out


def reconcile_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """SET-03 / QA-01 labelled row counts, one union of 1-row aggregates."""
    parts = [d.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(n).alias("table_name"), "row_count") for n, d in frames.items()]
    return union_all(*parts)


def check(df: DataFrame, cond: Column, name: str) -> DataFrame:
    """QA-02/04 rows violating an invariant (count_if NOT cond)."""
    return df.agg(F.count(F.when(~F.coalesce(cond, F.lit(False)), F.lit(1))).cast("bigint").alias("violations"),
                  F.count(F.lit(1)).cast("bigint").alias("checked")) \
        .select(F.lit(name).alias("check_name"), "violations", "checked")


def reconcile(detail: DataFrame, rollup: DataFrame, keys: Sequence[str], measure: str,
              detail_expr: Column, tol: float = 0.01) -> DataFrame:
    """QA-03 rollup reconciles with detail: full join of re-aggregated detail and
    the rollup on keys; rows whose difference exceeds ``tol``."""
    d = detail.groupBy(*keys).agg(F.sum(detail_expr).alias("_detail"))
    j = d.join(rollup.select(*keys, F.col(measure).alias("_rollup")), list(keys), "full")
    return j.withColumn("diff", F.coalesce(F.col("_detail"), F.lit(0.0)) - F.coalesce(F.col("_rollup"), F.lit(0.0))) \
        .where(F.abs(F.col("diff")) > tol)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """QA-05 keys that occur more than once (declared keys are unenforced, T6)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).where("n_rows > 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """QA-06 child rows whose key has no parent along a declared relationship."""
    p = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.join(p, child_key, "left_anti")
