"""Deterministic keyed column generators.

A value is a pure function of (key, salt): the same row gets the same draw on
every run and on every executor, with no shared RNG state, so generation
parallelises freely and re-executed tasks reproduce identical rows.

hash32(k, salt) = first 8 hex digits of md5(k|salt) as an integer in
[0, 2^32).  DuckDB computes the same value with
``('0x' || substr(md5(concat_ws('|', k, salt)), 1, 8))::BIGINT`` which is what
the oracle SQL uses.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expr import col

TWO_32 = 4294967296.0


def _key(key) -> Column:
    if isinstance(key, (list, tuple)):
        return F.concat_ws("|", *[col(k).cast("string") for k in key])
    return col(key).cast("string")


def hash32(key, salt: str) -> Column:
    """Salted 32-bit hash in [0, 2^32) as BIGINT."""
    s = F.concat_ws("|", _key(key), F.lit(salt))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def bucket(key, salt: str, m: int) -> Column:
    """Salted hash bucket 0..m-1."""
    return F.pmod(hash32(key, salt), F.lit(m))


def u01(key, salt: str) -> Column:
    """Uniform in (0, 1)."""
    return (hash32(key, salt) + F.lit(0.5)) / F.lit(TWO_32)


def uniform(key, salt: str, lo, hi, integer: bool = False) -> Column:
    """Seeded uniform in [lo, hi]; integers are inclusive of both ends."""
    if integer:
        return F.lit(lo) + F.pmod(hash32(key, salt), F.lit(int(hi) - int(lo) + 1))
    return F.lit(float(lo)) + u01(key, salt) * F.lit(float(hi) - float(lo))


def normal(key, salt: str, mu: float = 0.0, sd: float = 1.0) -> Column:
    """Seeded normal via Box-Muller over two independent hashes."""
    u1 = u01(key, salt + ":1")
    u2 = u01(key, salt + ":2")
    z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)
    return F.lit(mu) + F.lit(sd) * z


def pick(key, salt: str, values: Sequence) -> Column:
    """Pick one of ``values`` by key."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.get(arr, bucket(key, salt, len(values)).cast("int"))


def skew_index(key, salt: str, n: int, p: float = 1.6) -> Column:
    """Power-law index floor(U^p * n) + 1 (popular items first)."""
    return (F.floor(F.pow(u01(key, salt), F.lit(p)) * F.lit(n)) + F.lit(1)).cast("bigint")


def ts_between(key, salt: str, start: str, days: int) -> Column:
    """Timestamp within [start, start + days) by key (second resolution)."""
    secs = F.pmod(hash32(key, salt), F.lit(days * 86400))
    return F.timestamp_add("SECOND", secs, F.lit(start).cast("timestamp_ntz"))


def fan_out(df: DataFrame, key, lo: int, span: int, cap: int | None = None,
            salt: str = "fan", name: str = "seq") -> DataFrame:
    """Variable fan-out: each row repeated N = lo + hash mod span times (optionally capped).

    ``explode(sequence(1, n))`` replaces the reference's cross join with a
    generator + filter; the output grows with the input and needs no shuffle.
    """
    n = F.lit(lo) + F.pmod(hash32(key, salt), F.lit(span))
    if cap is not None:
        n = F.least(n, F.lit(cap))
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), n.cast("int"))))


# ---------------------------------------------------------------- DuckDB twins (oracle SQL)
def sql_hash32(key_sql: str, salt: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {key_sql}, '{salt}')), 1, 8))::BIGINT"


def sql_u01(key_sql: str, salt: str) -> str:
    return f"(({sql_hash32(key_sql, salt)} + 0.5) / 4294967296.0)"


def sql_normal(key_sql: str, salt: str, mu: float = 0.0, sd: float = 1.0) -> str:
    z = (f"sqrt(-2 * ln({sql_u01(key_sql, salt + ':1')})) * cos(2 * pi() * {sql_u01(key_sql, salt + ':2')})")
    return f"({mu!r} + {sd!r} * {z})"


def sql_uniform(key_sql: str, salt: str, lo: float, hi: float) -> str:
    return f"({float(lo)!r} + {sql_u01(key_sql, salt)} * {float(hi) - float(lo)!r})"
