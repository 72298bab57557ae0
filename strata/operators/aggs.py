"""Aggregation operators.

All are ``groupBy().agg()`` compositions, so Spark plans a partial
(map-side) aggregate before the shuffle: a hot key contributes one partial row
per input partition, not all of its rows, to the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.expr import col


def count_if(cond: Column) -> Column:
    """AGG-03 COUNT_IF."""
    return F.count(F.when(cond, F.lit(1)))


def count_distinct_if(cond: Column, c) -> Column:
    """AGG-04 COUNT(DISTINCT CASE WHEN cond THEN c END)."""
    return F.countDistinct(F.when(cond, col(c)))


def sum_if(cond: Column, c) -> Column:
    """AGG-05 SUM(CASE WHEN cond THEN c END): NULL when no row matches."""
    return F.sum(F.when(cond, col(c)))


def avg_if(cond: Column, c) -> Column:
    return F.avg(F.when(cond, col(c)))


def any_(cond: Column) -> Column:
    """AGG-07 MAX over a boolean = any."""
    return F.bool_or(cond)


def rate(cond: Column) -> Column:
    """AGG-08 AVG of 1.0/0.0 (NULL condition counts as 0)."""
    return F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)))


def new_repeat(df: DataFrame, key: str, date: str, by: Sequence[str], *measures: Column) -> DataFrame:
    """AGG-09 new vs repeat distinct customers per group, in one pass over the rows.

    Rows are summed up to one per (group, customer) with its first date there and the ``measures`` (sums
    or counts, aliased); the customer's first date over the whole fact is a window over these rows, of
    which a customer has at most one a group.  A customer is new in the groups that hold its first date;
    repeat = all - new.  The measures are then summed per group.  Rows without a customer count in them alone.
    """
    per = df.groupBy(*by, key).agg(F.min(date).alias("_d"), *measures)
    names = [c for c in per.columns if c not in {*by, key, "_d"}]
    per = per.withColumn("_first", F.min("_d").over(Window.partitionBy(key)))
    own = F.col(key).isNotNull()
    return per.groupBy(*by).agg(
        F.count(F.when(own & (F.col("_d") == F.col("_first")), 1)).alias("new_customers"),
        F.count(F.when(own & (F.col("_d") > F.col("_first")), 1)).alias("repeat_customers"),
        *(F.sum(c).alias(c) for c in names))


def summary(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """AGG-14 global one-row summary."""
    return df.agg(*[c.alias(n) for n, c in measures.items()])


def mode_and_share(df: DataFrame, key: str, cat: str, val=None) -> DataFrame:
    """AGG-15 most frequent category per key (ties -> smallest category) and,
    optionally, the share of rows equal to ``val``.

    Counting (key, cat) pairs first keeps the window small: one row per pair.
    """
    pairs = df.groupBy(key, cat).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(key).orderBy(F.desc("_n"), F.asc(cat))
    top = (pairs.withColumn("_r", F.row_number().over(w)).where("_r = 1")
           .select(key, F.col(cat).alias(f"top_{cat}")))
    if val is None:
        return top
    share = df.groupBy(key).agg(rate(F.col(cat) == F.lit(val)).alias(f"share_{val}"))
    return top.join(share, key)


def avg_gap(df: DataFrame, key: str, date: str) -> DataFrame:
    """AGG-17 mean gap in days between consecutive events; 0 if < 2 events.

    Equal to (max - min) / (n - 1), so it needs no sort: one aggregate.
    """
    g = df.groupBy(key).agg(F.min(F.to_date(date)).alias("_mn"), F.max(F.to_date(date)).alias("_mx"),
                            F.count(F.lit(1)).alias("_n"))
    return g.select(key, F.when(F.col("_n") >= 2,
                                F.datediff("_mx", "_mn") / (F.col("_n") - 1)).otherwise(F.lit(0.0))
                    .alias("avg_gap_days"))


def value_counts(df: DataFrame, c: str, name: str = "n") -> DataFrame:
    """AGG-18 label distribution."""
    return df.groupBy(c).agg(F.count(F.lit(1)).alias(name))


def rollup2(df: DataFrame, inner_keys: Sequence[str], inner: dict[str, Column],
            outer_keys: Sequence[str], outer: dict[str, Column]) -> DataFrame:
    """AGG-10 two-level aggregate: pre-aggregate then roll up."""
    g = df.groupBy(*inner_keys).agg(*[c.alias(n) for n, c in inner.items()])
    return g.groupBy(*outer_keys).agg(*[c.alias(n) for n, c in outer.items()])
