"""Join operators.

Broadcast policy: only relations with a *proven* size bound are hinted
(literal tier/weight tables, a 1-row scalar, per-partition offset tables whose
size is the partition count).  Every data-dependent side is left to AQE, which
converts a join to broadcast at run time only after measuring the side's real
size against ``spark.sql.autoBroadcastJoinThreshold``; otherwise it stays a
shuffle join and AQE splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Literal relations hold this many rows at most: they are written out in code.
LITERAL_MAX_ROWS = 10_000


def broadcast_literal(df: DataFrame, n_rows: int) -> DataFrame:
    """Broadcast a relation whose row count is known up front (inline VALUES, 1-row aggs)."""
    if n_rows > LITERAL_MAX_ROWS:
        raise ValueError(f"{n_rows} rows aren't a literal relation: join them on a key or with range_join")
    return F.broadcast(df)


def enrich(entity: DataFrame, key: str | Sequence[str], *aggs: DataFrame) -> DataFrame:
    """JOIN-03 left-join several per-key aggregates (each 1 row per key) onto an entity."""
    out = entity
    for a in aggs:
        out = out.join(a, on=key, how="left")
    return out


def left_default(a: DataFrame, b: DataFrame, keys: Sequence[str],
                 defaults: Mapping[str, object]) -> DataFrame:
    """JOIN-04 left outer on several keys; missing right values take defaults."""
    out = a.join(b, on=list(keys), how="left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def grid(*dfs: DataFrame) -> DataFrame:
    """JOIN-05 cross product of small literal dimensions (never of fact tables)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.crossJoin(d)
    return out


def scalar_struct(scalar: DataFrame) -> Column:
    """The single row of a global aggregate as one scalar-subquery column (a struct of its
    columns).  Spark runs the subquery once, as its own job, and inlines the value."""
    return scalar.select(F.struct(*scalar.columns).alias("_s")).scalar()


def with_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """JOIN-06 attach the columns of a 1-row aggregate to every row.

    Planned as a scalar subquery (one struct, fields projected), not as a join:
    no nested-loop join and nothing collected by the caller.  A relation with more
    than one row fails at run time instead of multiplying rows.
    """
    s = scalar_struct(scalar)
    return df.withColumns({c: s.getField(c) for c in scalar.columns})


def with_scalars(df: DataFrame, *scalars: DataFrame) -> DataFrame:
    """Side-by-side combination of several 1-row results (metric rows) as scalar subqueries."""
    for s in scalars:
        df = with_scalar(df, s)
    return df


def tier_join(df: DataFrame, x: str, tiers: DataFrame, lo: str = "lower_bound",
              hi: str = "upper_bound", n_tiers: int = 8) -> DataFrame:
    """JOIN-07 left join to a small literal tier table on lo <= x < hi."""
    t = broadcast_literal(tiers, n_tiers)
    return df.join(t, (F.col(x) >= t[lo]) & (F.col(x) < t[hi]), "left")


def range_join(df: DataFrame, x: str, intervals: DataFrame, lo: str, hi: str, how: str = "inner",
               key: str | None = None, count: Mapping[str, str] | None = None) -> DataFrame:
    """JOIN-08 half-open range join lo <= x < hi for two large relations: all pairs, by a sorted sweep.

    Quantile cut points of the points and interval ends together deal everything into slots: a cut point,
    or what lies between two of them, with about as many points and ends in each slot whatever their
    distribution or the intervals' lengths.  An interval is split at the cut points:

    * slots that it covers whole match all their points without a look at the values: an equi join
      on the slot, which AQE splits where a slot (a value that many points share) is hot.  An interval
      has a row per covered slot, so a long one has at most 2 * SLOTS rows;
    * in the slots of its two ends (if these aren't cut points) points and intervals are sorted and
      swept: each interval's points are one run of the sorted points.  What a slot's sweep holds are the
      ends in it, never the intervals that run through it.

    Null or empty intervals and null points match nothing.  ``how='left'`` re-attaches unmatched points
    by the unique ``key``.  x, lo and hi are numbers, dates or timestamps.

    ``count`` ({output: point column}) counts each interval's matches with a value in that column where
    they are found, in place of the pairs, whose number grows with points times intervals: a run of the
    sweep is its length, and whole slots are a difference of two running counts over the slots (at most
    2 * SLOTS rows).  An interval with a match has one to three rows (whole slots, either end), to be
    added up by whoever groups them.
    """
    from .windows import _slots, quantile_cuts, slot_of
    if count is not None and how != "inner":
        raise ValueError("counts are of an inner range_join")
    iv = intervals.where(F.col(lo) < F.col(hi))
    ends = df.select(F.col(x).alias("v")).union(iv.select(lo)).union(iv.select(hi))
    cuts = quantile_cuts(ends, "v", _slots(df.sparkSession))
    pts = df.where(F.col(x).isNotNull()).withColumn("_slot", slot_of(F.col(x), cuts))
    iv = iv.withColumns({"_a": slot_of(F.col(lo), cuts), "_b": slot_of(F.col(hi), cuts)})
    # whole slots: a cut point at lo belongs to the interval, one at hi doesn't
    first = F.col("_a") + (F.col("_a") % 2 == 0).cast("int")
    whole = iv.where(first < F.col("_b"))
    part = iv.withColumn("_slot", F.explode(F.array_distinct(F.filter(F.array("_a", "_b"), lambda s: s % 2 == 0)))).drop("_a", "_b")
    if count is not None:
        return _counts(pts, x, whole.withColumn("_a", first), part, intervals, lo, hi, len(cuts), count)
    whole = whole.withColumn("_slot", F.explode(F.sequence(first, F.col("_b") - 1))).drop("_a", "_b")
    hit = pts.join(whole, "_slot").drop("_slot")
    names = [*df.columns, *intervals.columns]
    schema = T.StructType([*df.schema.fields, *intervals.schema.fields])
    swept = pts.groupBy("_slot").cogroup(part.groupBy("_slot")).applyInArrow(
        _sweep(df.columns, x, intervals.columns, lo, hi), schema)
    hit = hit.select(*names).unionByName(swept)
    if how == "inner":
        return hit
    if key is None:
        raise ValueError("left range_join needs a unique point key")
    miss = df.join(hit.select(key), key, "left_anti")
    return hit.unionByName(miss, allowMissingColumns=True)


def _counts(pts: DataFrame, x: str, whole: DataFrame, part: DataFrame, intervals: DataFrame, lo: str, hi: str,
            n_cuts: int, count: Mapping[str, str]) -> DataFrame:
    """``range_join``'s counts: of whole slots ``_a`` to ``_b`` - 1 by running counts, of the ends' slots by the sweep."""
    counted = {"_pairs": F.lit(1), **{n: F.col(c) for n, c in count.items()}}
    # one row per slot, empty ones too: how many points lie in the slots before it
    slots = pts.sparkSession.range(2 * n_cuts + 2).select(F.col("id").cast("int").alias("_slot"))
    slots = slots.join(pts.groupBy("_slot").agg(*(F.count(c).alias(n) for n, c in counted.items())), "_slot", "left")
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select("_slot", F.struct(*(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in counted)).alias("_n"))
    a, b = (F.broadcast(slots.select(F.col("_slot").alias(s), F.col("_n").alias(f"_n{s}"))) for s in ("_a", "_b"))
    whole = whole.join(a, "_a").join(b, "_b").select(
        *intervals.columns, *((F.col(f"_n_b.{n}") - F.col(f"_n_a.{n}")).alias(n) for n in counted))
    schema = T.StructType([*intervals.schema.fields, *(T.StructField(n, T.LongType()) for n in counted)])
    pts = pts.select("_slot", x, *(c.isNotNull().alias(n) for n, c in counted.items()))
    swept = pts.groupBy("_slot").cogroup(part.groupBy("_slot")).applyInArrow(
        _sweep_counts(x, intervals.columns, lo, hi, list(counted)), schema)
    return whole.unionByName(swept).where(F.col("_pairs") > 0).drop("_pairs")


def _runs(points, intervals, x: str, lo: str, hi: str):
    """The points in order, and of each interval where the run of its matches begins and ends."""
    import numpy as np

    points = points.sort_by(x)
    at = points.column(x).to_numpy()
    a, b = (np.searchsorted(at, intervals.column(c).cast(points.column(x).type).to_numpy()) for c in (lo, hi))
    return points, a, np.maximum(a, b)


def _sweep_counts(x: str, interval_cols: Sequence[str], lo: str, hi: str, counted: Sequence[str]):
    """The intervals of one slot, each with the number of its matches that hold a value."""
    import numpy as np
    import pyarrow as pa

    def run(points: pa.Table, intervals: pa.Table) -> pa.Table:
        points, a, b = _runs(points, intervals, x, lo, hi)
        upto = (np.concatenate([[0], np.cumsum(points.column(c).to_numpy(), dtype="int64")]) for c in counted)
        return pa.Table.from_arrays([*(intervals.column(c) for c in interval_cols), *(pa.array(n[b] - n[a]) for n in upto)],
                                    [*interval_cols, *counted])

    return run


def _sweep(point_cols: Sequence[str], x: str, interval_cols: Sequence[str], lo: str, hi: str):
    """All pairs lo <= x < hi of one slot: points in order, each interval's matches one run of them."""
    import numpy as np
    import pyarrow as pa

    def run(points: pa.Table, intervals: pa.Table) -> pa.Table:
        points, a, b = _runs(points.select(list(point_cols)), intervals, x, lo, hi)
        n = b - a
        # positions a, a + 1, ..., b - 1 of every interval, one after the other
        take = np.arange(n.sum()) + np.repeat(a - (np.cumsum(n) - n), n)
        left, right = points.take(pa.array(take)), intervals.take(pa.array(np.repeat(np.arange(len(n)), n)))
        return pa.Table.from_arrays([*left.columns, *(right.column(c) for c in interval_cols)], [*point_cols, *interval_cols])

    return run


def valid_join(ev: DataFrame, ent: DataFrame, key: str, date: str,
               start: str, end: str) -> DataFrame:
    """JOIN-09 equi join + event date BETWEEN entity validity dates."""
    return ev.join(ent, key).where(F.col(date).between(F.col(start), F.col(end)))


def expand_days(df: DataFrame, start: str, end: str, name: str = "d") -> DataFrame:
    """JOIN-10 one row per day of [start, end] (replaces a calendar non-equi join)."""
    return df.withColumn(name, F.explode(F.sequence(F.to_date(start), F.to_date(end))))


def with_prev_period(active: DataFrame, key: str, period: str, unit: str = "day",
                     compat: bool = False) -> DataFrame:
    """JOIN-11/12 flag whether the key was also active in the previous period.

    ``active`` holds distinct (key, period) rows.  Day: previous = period - 1
    day.  Month: ``period`` is a month-start date; corrected form uses a gap-free
    month index; ``compat=True`` reproduces the reference's year-equal and
    month = month + 1 join, which never matches in January.
    """
    a = active.select(key, period)
    if unit == "day":
        prev = a.select(F.col(key), F.date_add(F.col(period), 1).alias(period), F.lit(True).alias("_prev"))
    elif compat:
        # year equal and month = month + 1: December never links to January
        prev = a.where(F.month(period) < 12).select(
            F.col(key), F.make_date(F.year(period), F.month(period) + 1, F.lit(1)).alias(period),
            F.lit(True).alias("_prev"))
    else:
        prev = a.select(F.col(key), F.add_months(F.col(period), 1).alias(period), F.lit(True).alias("_prev"))
    out = active.join(prev, [key, period], "left")
    return out.withColumn("active_prev", F.coalesce(F.col("_prev"), F.lit(False))).drop("_prev")


def anti(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """JOIN-13 rows of a without a match in b."""
    return a.join(b.select(*([keys] if isinstance(keys, str) else keys)).distinct(), keys, "left_anti")


def semi(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """JOIN-14 rows of a with a match in b (no fan-out)."""
    return a.join(b, keys, "left_semi")


def exists_flag(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    """JOIN-14 ``right.key IS NOT NULL`` flag without multiplying rows (T9)."""
    k = b.select(F.col(key)).distinct().withColumn(name, F.lit(True))
    return a.join(k, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def drop_first_period(df: DataFrame, period: str) -> DataFrame:
    """JOIN-15 drop rows of the earliest period (the global min is a scalar subquery)."""
    first = df.agg(F.min(period)).scalar()
    return df.where(F.col(period) != first)


def join_cast(a: DataFrame, b: DataFrame, ka: str, kb: str, how: str = "left") -> DataFrame:
    """JOIN-16 VARCHAR key = NUMBER::VARCHAR."""
    return a.join(b, a[ka] == b[kb].cast("string"), how)


def pick_join(df: DataFrame, idx: str, target: DataFrame, target_idx: str) -> DataFrame:
    """JOIN-17 positional pick: a 1..N index joined to the target's row number."""
    return df.join(target, df[idx] == target[target_idx], "inner")


def weights_row(weights: Mapping[str, float], spark) -> DataFrame:
    """JOIN-18 the 8-row weights table pivoted once to a single row of literals."""
    return spark.range(1).select(*[F.lit(float(v)).alias(k) for k, v in weights.items()])


def daily_left(cal: DataFrame, cal_date: str, fact: DataFrame, fact_ts: str,
               extra: Column | None = None) -> DataFrame:
    """JOIN-19 calendar LEFT JOIN fact ON to_date(fact.ts) = cal.date [AND extra]."""
    f = fact.withColumn("_fd", F.to_date(fact_ts))
    cond = f["_fd"] == cal[cal_date]
    if extra is not None:
        cond = cond & extra
    return cal.join(f, cond, "left").drop("_fd")


def lookup_star(fact: DataFrame, dims: Sequence[tuple[DataFrame, Column | str]]) -> DataFrame:
    """JOIN-02 star join of small dimensions keyed on expressions; AQE picks broadcast
    per dimension from its measured size."""
    out = fact
    for d, cond in dims:
        out = out.join(d, cond, "left")
    return out
