"""Registry of named queries: each Spark query paired with an independent SQL oracle.

Output normalisation (applied identically on both sides so that values hash
equal): floating columns rounded to 4 decimals, integer columns widened to
BIGINT.  The Spark side applies it by type; the oracle side lists the columns
(``dbl`` / ``big``) because the SQL text is produced without a session.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
NOTES: dict[str, str] = {}
ROUND_DIGITS = 4


_SCALE = 10.0 ** ROUND_DIGITS


def round_fixed(c):
    """Two-stage fixed rounding computed with the same IEEE operations as the SQL
    twin: snap to 8 (or 5) decimals to absorb summation-order noise, then
    floor(x * 1e4 + 0.5) / 1e4 (``round`` itself differs between engines on
    .5 ties)."""
    def step(x, scale):
        return F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    a = F.abs(c)
    return (F.when(a < F.lit(1.0e7), step(step(c, 1.0e8), _SCALE))
            .when(a < F.lit(1.0e10), step(step(c, 1.0e5), _SCALE))
            .when(a < F.lit(9.0e14), step(c, _SCALE))
            .otherwise(F.round(c, ROUND_DIGITS)))


def round_fixed_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"

    def step(e, scale):
        return f"floor(({e}) * {scale!r} + 0.5) / {scale!r}"
    return (f"CASE WHEN abs({x}) < 1.0e7 THEN {step(step(x, 1.0e8), _SCALE)} "
            f"WHEN abs({x}) < 1.0e10 THEN {step(step(x, 1.0e5), _SCALE)} "
            f"WHEN abs({x}) < 9.0e14 THEN {step(x, _SCALE)} ELSE round({x}, {ROUND_DIGITS}) END")


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = round_fixed(c.cast("double"))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(cols)


def wrap_sql(sql: str, dbl: str = "", big: str = "") -> str:
    reps = [f"{round_fixed_sql(c)} AS {c}" for c in dbl.split()]
    reps += [f"CAST({c} AS BIGINT) AS {c}" for c in big.split()]
    if not reps:
        return sql
    return f"SELECT * REPLACE ({', '.join(reps)}) FROM ({sql}) AS _q"


def register(name: str, sql: str | None = None, dbl: str = "", big: str = "", note: str = ""):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str, _fn=fn) -> DataFrame:
            return normalize(_fn(spark, sf_dir))

        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = wrap_sql(sql, dbl, big)
        if note:
            NOTES[name] = note
        return fn

    return deco


def load_all() -> None:
    """Import every query module (each registers on import)."""
    from . import (q_core, q_player, q_retail, q_spa, q_cases, q_text, q_semantic,  # noqa: F401
                   q_ml, q_stream)
