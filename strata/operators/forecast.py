"""Multi-series forecasting as set operations.

The daily series is written once (``daily_table``), so its source is read once whatever is fitted,
scored or plotted afterwards.  Trend, weekday effects and residual spread of every series come from
one grouped aggregate: sums of y, t*y and y*y by weekday are all that least squares needs, and days
without a row add nothing to them, so the zero-filled series is never built for a fit.  What depends
on the calendar alone (days, sum of t and of t*t by weekday) has a closed form.  All folds of a
backtest are columns of the same aggregate.  A user-supplied per-series model goes through
``forecast_with`` (``groupBy().applyInPandas``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import dow_sun0
from ..session import shared_table_path
from ..sources.io import materialize


def daily_table(series: DataFrame, keys: Sequence[str], ts: str, y: str) -> DataFrame:
    """The series (one row per key and day with a value) written to the shared folder and read back."""
    return materialize(series.select(*keys, ts, y), shared_table_path(series.sparkSession, "daily_series"))


def _bounds(series: DataFrame, ts: str) -> tuple[dt.date, dt.date]:
    """First and last day of a written series (one row to the driver)."""
    first, last = series.agg(F.to_date(F.min(ts)), F.to_date(F.max(ts))).first()
    return (first, last) if first else (dt.date(1970, 1, 1), dt.date(1970, 1, 1))


def zero_fill(series: DataFrame, keys: Sequence[str], ts: str, y: str) -> DataFrame:
    """FC-01 one row per (series, day) between the global first and last day; missing = 0.

    Each series key row is expanded with ``explode(sequence(first, last))``; the
    global bounds are one scalar subquery, so no calendar table is cross joined.  The series
    is read for the bounds, the keys and the values: pass a written one (``daily_table``).
    """
    keys = list(keys)
    b = series.select(F.struct(F.min(ts).alias("s"), F.max(ts).alias("e"))).scalar()
    grid = series.select(*keys).distinct() \
        .select(*keys, F.explode(F.sequence(b.getField("s"), b.getField("e"))).alias(ts))
    return grid.join(series.select(*keys, ts, y), keys + [ts], "left") \
        .withColumn(y, F.coalesce(F.col(y), F.lit(0.0)))


def weekday_calendar(first: dt.date, last: dt.date) -> list[tuple[int, int, int]]:
    """(days, sum of t, sum of t*t) of each weekday, Sunday first, from ``first`` to ``last``; t is 0 on ``first``.

    A weekday's days are t0, t0 + 7, ..., so the sums are those of an arithmetic series and of its squares.
    """
    span, out = (last - first).days, []
    for w in range(7):
        t0 = (w - first.isoweekday()) % 7
        n = (span - t0) // 7 + 1 if span >= t0 else 0
        i, ii = n * (n - 1) // 2, (n - 1) * n * (2 * n - 1) // 6
        out.append((n, n * t0 + 7 * i, n * t0 * t0 + 14 * t0 * i + 49 * ii))
    return out


def weekday_sums(series: DataFrame, keys: Sequence[str], ts: str, y: str, first: dt.date, cuts: Sequence[dt.date],
                 *more: Column) -> DataFrame:
    """One row per series: for each cut k and weekday w the sums ``_y``, ``_ty`` and ``_yy`` (suffix ``k_w``) up to the cut."""
    t, v = F.datediff(ts, F.lit(first)).cast("double"), F.col(y).cast("double")
    sums = []
    for k, cut in enumerate(cuts):
        for w in range(7):
            own = (F.col(ts) <= F.lit(cut)) & (dow_sun0(ts) == w)
            sums += [F.coalesce(F.sum(F.when(own, x)), F.lit(0.0)).alias(f"{name}{k}_{w}")
                     for name, x in (("_y", v), ("_ty", t * v), ("_yy", v * v))]
    return series.groupBy(*keys).agg(*sums, *more)


def _fitted(k: int, first: dt.date, cut: dt.date) -> Column:
    """struct(a, b, effect by weekday, sd) of the fit up to cut ``k`` from the columns of ``weekday_sums``.

    y(t) = a + b t + effect(weekday): least squares in t, then the mean residual of each weekday;
    sd is the sample standard deviation of what is left.  A one-day series has a = b = 0.
    """
    cal = weekday_calendar(first, cut)
    n, st, stt = (sum(c[i] for c in cal) for i in range(3))
    sy, sty = (sum((F.col(f"{name}{k}_{w}") for w in range(1, 7)), F.col(f"{name}{k}_0")) for name in ("_y", "_ty"))
    var = n * stt - st * st
    b = (n * sty - st * sy) / float(var) if var else F.lit(0.0)
    fit = F.struct(((sy - b * st) / float(n) if var else F.lit(0.0)).alias("a"), b.alias("b"))

    def rest(f: Column) -> Column:
        a, b = f.getField("a"), f.getField("b")
        effects, squares = [], F.lit(0.0)
        for w, (m, mt, mtt) in enumerate(cal):
            own = F.col(f"_y{k}_{w}"), F.col(f"_ty{k}_{w}"), F.col(f"_yy{k}_{w}")
            e = (own[0] - a * m - b * mt) / float(m) if m else F.lit(0.0)
            effects.append(e)
            squares = squares + own[2] - 2 * a * own[0] - 2 * b * own[1] + a * a * m + 2 * a * b * mt + b * b * mtt - e * e * m
        sd = F.sqrt(F.greatest(squares, F.lit(0.0)) / float(n - 1)) if n > 1 else F.lit(0.0)
        return F.struct(a.alias("a"), b.alias("b"), F.array(*effects).alias("effect"), sd.alias("sd"))

    return F.transform(F.array(fit), rest)[0]


def _yhat(fit: str, ts: str, first: dt.date) -> Column:
    return F.col(f"{fit}.a") + F.col(f"{fit}.b") * F.datediff(ts, F.lit(first)) + F.get(F.col(f"{fit}.effect"), dow_sun0(ts))


def forecast(series: DataFrame, keys: Sequence[str], ts: str, y: str, h: int = 14, z: float = 1.96,
             floor_zero: bool = True) -> DataFrame:
    """FC-03 trend x weekday regression per series with +-z*sd bounds, for the h days after the last one.

    Missing days between the first and the last day of all series count as 0.  ``series`` is read
    twice (bounds, sums): pass a written one (``daily_table``).
    """
    keys = list(keys)
    first, last = _bounds(series, ts)
    fit = weekday_sums(series, keys, ts, y, first, [last]).select(*keys, _fitted(0, first, last).alias("_fit"))
    days = F.sequence(F.lit(last + dt.timedelta(1)), F.lit(last + dt.timedelta(h)))
    fut = fit.withColumn(ts, F.explode(days)).withColumn("_yhat", _yhat("_fit", ts, first))
    out = [F.col("_yhat"), F.col("_yhat") - z * F.col("_fit.sd"), F.col("_yhat") + z * F.col("_fit.sd")]
    if floor_zero:
        out = [F.greatest(c, F.lit(0.0)) for c in out]
    return fut.select(*keys, ts, *(c.alias(n) for c, n in zip(out, ("forecast", "lower_bound", "upper_bound"))))


def backtest(series: DataFrame, keys: Sequence[str], ts: str, y: str, h: int = 7, folds: int = 3) -> DataFrame:
    """FC-05 rolling-origin evaluation: for fold f the cut is last_day - f*h; fit on days
    up to the cut, score the next h days; MAE / RMSE / MAPE per series over all folds.

    Every fold's sums and the scored days' values (at most folds*h a series) come from one grouped
    aggregate.  Folds that leave no day to fit on aren't scored.  ``series`` is read twice, as in ``forecast``.
    """
    keys = list(keys)
    first, last = _bounds(series, ts)
    cuts = [c for c in (last - dt.timedelta(h * f) for f in range(1, folds + 1)) if c >= first]
    actual = F.collect_list(F.when(F.col(ts) > F.lit(last - dt.timedelta(h * folds)), F.struct(F.to_date(ts).alias("d"), F.col(y).cast("double").alias("v"))))
    fit = weekday_sums(series, keys, ts, y, first, cuts, actual.alias("_actual"))
    fits = F.array(*(F.struct(F.lit(c).alias("cut"), _fitted(k, first, c).alias("fit")) for k, c in enumerate(cuts)))
    x = fit.select(*keys, F.map_from_entries("_actual").alias("_actual"), F.explode(fits).alias("_f"))
    x = x.select(*keys, "_actual", F.col("_f.fit").alias("_fit"), F.explode(F.sequence(F.date_add("_f.cut", 1), F.date_add("_f.cut", h))).alias(ts))
    x = x.withColumn("_y", F.coalesce(F.try_element_at("_actual", F.col(ts)), F.lit(0.0)))
    x = x.withColumn("_err", F.greatest(_yhat("_fit", ts, first), F.lit(0.0)) - F.col("_y"))
    return x.groupBy(*keys).agg(
        F.avg(F.abs("_err")).alias("mae"), F.sqrt(F.avg(F.col("_err") * F.col("_err"))).alias("rmse"),
        F.avg(F.try_divide(F.abs("_err"), F.nullif(F.col("_y"), F.lit(0.0)))).alias("mape"),
        F.count(F.lit(1)).alias("n_scored"))


def forecast_with(series: DataFrame, keys: Sequence[str], fn: Callable, schema: str) -> DataFrame:
    """FC-04 / UDF-05 user-supplied model per series via ``applyInPandas``.

    Each series is one pandas group, so this is for bounded series lengths
    (a daily series is a few thousand rows); the fit itself is the user's.
    """
    return series.groupBy(*keys).applyInPandas(fn, schema)


def seasonal_naive(series: DataFrame, keys: Sequence[str], ts: str, y: str, h: int = 14,
                   weeks: int = 4) -> DataFrame:
    """FC-02 same weekday of the last ``weeks`` weeks, averaged, for the next h days; one aggregate."""
    keys = list(keys)
    first, last = _bounds(series, ts)
    since = max(first, last - dt.timedelta(7 * weeks - 1))
    recent = F.col(ts) >= F.lit(since)
    means = [F.coalesce(F.sum(F.when(recent & (dow_sun0(ts) == w), F.col(y).cast("double"))), F.lit(0.0)) / float(max(n, 1))
             for w, (n, _, _) in enumerate(weekday_calendar(since, last))]
    prof = series.groupBy(*keys).agg(F.array(*means).alias("_mean"))
    fut = prof.withColumn(ts, F.explode(F.sequence(F.lit(last + dt.timedelta(1)), F.lit(last + dt.timedelta(h)))))
    return fut.select(*keys, ts, F.get("_mean", dow_sun0(ts)).alias("forecast"))
