"""Dialect-safe scalar expressions.

All builders return ``Column`` objects made of built-in functions, so they stay
inside whole-stage codegen.  None of them call ``current_date()``: operators
take an explicit ``as_of`` date instead.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.isoformat()[:10]
    return F.lit(d).cast("date")


# ---------------------------------------------------------------- null/zero rules
def div0(n, d) -> Column:
    """DIV0: 0 when the divisor is 0, NULL stays NULL."""
    n, d = col(n), col(d)
    return F.when(d.isNull() | n.isNull(), F.lit(None).cast("double")) \
        .when(d == 0, F.lit(0.0)).otherwise(n / d)


def safe_div(n, d) -> Column:
    """a / NULLIF(b, 0): NULL on a zero divisor (Spark 4 ANSI raises on bare /)."""
    return F.try_divide(col(n).cast("double"), col(d))


def safe_ratio(n, d, on_zero=None) -> Column:
    """Ratio guarded by CASE WHEN d > 0; ``on_zero`` is the value otherwise."""
    n, d = col(n), col(d)
    alt = F.lit(on_zero) if not isinstance(on_zero, Column) else on_zero
    return F.when(d > 0, n.cast("double") / d).otherwise(alt.cast("double"))


def greatest_strict(*cols) -> Column:
    """GREATEST that returns NULL when any argument is NULL (Spark skips NULLs)."""
    cs = [col(c) for c in cols]
    anynull = cs[0].isNull()
    for c in cs[1:]:
        anynull = anynull | c.isNull()
    return F.when(anynull, F.lit(None)).otherwise(F.greatest(*cs))


def least_strict(*cols) -> Column:
    cs = [col(c) for c in cols]
    anynull = cs[0].isNull()
    for c in cs[1:]:
        anynull = anynull | c.isNull()
    return F.when(anynull, F.lit(None)).otherwise(F.least(*cs))


def clamp(c, lo, hi) -> Column:
    return least_strict(greatest_strict(col(c), F.lit(lo)), F.lit(hi))


def iff(cond: Column, a, b) -> Column:
    a = a if isinstance(a, Column) else F.lit(a)
    b = b if isinstance(b, Column) else F.lit(b)
    return F.when(cond, a).otherwise(b)


def flag(cond: Column) -> Column:
    """Boolean predicate to 1/0 integer."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def ape(forecast, actual) -> Column:
    """Absolute percentage error abs(f - a) / NULLIF(a, 0)."""
    return F.try_divide(F.abs(col(forecast) - col(actual)).cast("double"), col(actual))


# ---------------------------------------------------------------- dates
def days_between(a, b) -> Column:
    """Calendar-day boundaries crossed from a to b (DATEDIFF(day, a, b))."""
    return F.datediff(F.to_date(col(b)), F.to_date(col(a)))


def years_between(a, b) -> Column:
    """Year boundaries crossed from a to b (DATEDIFF(year, a, b)) = age in the reference."""
    return F.year(col(b)) - F.year(col(a))


def dow_sun0(c) -> Column:
    """DAYOFWEEK with 0 = Sunday."""
    return F.dayofweek(col(c)) - 1


def dow_iso(c) -> Column:
    """ISO day of week, 1 = Monday .. 7 = Sunday."""
    return F.weekday(col(c)) + 1


def is_weekend(c) -> Column:
    return dow_iso(c) >= 6


def last_n_days(c, n: int, as_of) -> Column:
    """``c >= as_of - n days`` with an explicit as_of date."""
    return col(c) >= F.date_sub(lit_date(as_of), n).cast("timestamp_ntz")


def between_dates(c, a, b) -> Column:
    return F.to_date(col(c)).between(lit_date(a), lit_date(b))


def month_index(c) -> Column:
    """year*12 + month: a gap-free month number (fixes the January self-join trap)."""
    return F.year(col(c)) * 12 + F.month(col(c))


def season_label(c) -> Column:
    """Season from month plus year: Spring (3-5), Summer (6-8), Fall (9-11), Winter."""
    m = F.month(col(c))
    name = (F.when(m.between(3, 5), F.lit("Spring"))
            .when(m.between(6, 8), F.lit("Summer"))
            .when(m.between(9, 11), F.lit("Fall"))
            .otherwise(F.lit("Winter")))
    return F.concat(name, F.lit(" "), F.year(col(c)).cast("string"))


# ---------------------------------------------------------------- ladders and maps
def bucket(c, ladder: Sequence[tuple], else_=None) -> Column:
    """Ordered CASE ladder: first ``c < bound`` wins. ladder = [(bound, label), ...]."""
    c = col(c)
    out = None
    for bound, label in ladder:
        out = (F.when(c < bound, F.lit(label)) if out is None
               else out.when(c < bound, F.lit(label)))
    return out.otherwise(F.lit(else_))


def map_value(c, mapping: Mapping, default=None) -> Column:
    """Simple CASE value -> value with a default."""
    c = col(c)
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def segment(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Priority segmentation: first matching (condition, label) wins."""
    out = None
    for cond, label in rules:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def null_when(cond: Column, c) -> Column:
    """NULL-out a column for open/future records."""
    return F.when(cond, F.lit(None)).otherwise(col(c))


def pick_index(values: Iterable, idx) -> Column:
    """0-based pick from an array literal; NULL past the end (ANSI-safe ``get``)."""
    return F.get(F.array(*[F.lit(v) for v in values]), col(idx).cast("int"))


def lpad_id(prefix: str, c, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(col(c).cast("string"), width, "0"))


def logistic(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(x)))


def price_99(c) -> Column:
    """Round up to a .99 price ending (e.g. 41.2 -> 41.99)."""
    return F.floor(col(c)) + F.lit(0.99)


def update_cols(df, updates: Mapping[str, Column], where: Column | None = None):
    """UPDATE t SET col = expr [WHERE cond] as one projection."""
    if where is None:
        return df.withColumns(dict(updates))
    return df.withColumns({k: F.when(where, v).otherwise(F.col(k)) for k, v in updates.items()})


def round_half(c, digits: int = 2) -> Column:
    """ROUND half away from zero for non-negative money, as floor(x * 10^d + 0.5) / 10^d
    (bit-identical to the SQL oracle; built-in ``round`` differs between engines on ties)."""
    s = float(10 ** digits)
    return F.floor(col(c) * F.lit(s) + F.lit(0.5)) / F.lit(s)


def sql_round_half(e: str, digits: int = 2) -> str:
    s = float(10 ** digits)
    return f"(floor(({e}) * {s!r} + 0.5) / {s!r})"
