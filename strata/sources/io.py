"""Scans, ingestion, sinks.

Reads are lazy and columnar: callers select/filter after ``scan`` and Catalyst
pushes both into the parquet reader (``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC-01 table scan by name."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES) -> dict[str, DataFrame]:
    return {n: scan(spark, sf_dir, n) for n in names}


def register_views(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES) -> None:
    """SRC-11: expose every table as a temp view for SQL users."""
    for n in names:
        scan(spark, sf_dir, n).createOrReplaceTempView(n)


# ---------------------------------------------------------------- schemas
def schema(fields: Sequence[tuple], comments: Mapping[str, str] | None = None) -> T.StructType:
    """SRC-02 declared typed schema; comments go to StructField metadata."""
    comments = comments or {}
    out = []
    for f in fields:
        name, typ = f[0], f[1]
        nullable = f[2] if len(f) > 2 else True
        if isinstance(typ, str):
            typ = T._parse_datatype_string(typ)
        md = {"comment": comments[name]} if name in comments else {}
        out.append(T.StructField(name, typ, nullable, md))
    return T.StructType(out)


def conform(df: DataFrame, sch: T.StructType) -> DataFrame:
    """Project and cast a frame to a declared schema (column order, types)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata)
                      for f in sch.fields])


# ---------------------------------------------------------------- CSV ingest
def read_csv(spark: SparkSession, path: str, sch: T.StructType, quote: str = '"') -> DataFrame:
    """SRC-03: header skipped, optional quote enclosure (a doubled quote stands for one), '' -> NULL, declared order."""
    return (spark.read.schema(sch)
            .option("header", "true").option("quote", quote).option("escape", quote)
            .option("nullValue", "").option("emptyValue", None)
            .option("mode", "PERMISSIVE").csv(path))


def read_csv_tolerant(spark: SparkSession, path: str, sch: T.StructType,
                      corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """SRC-04: error-tolerant load -> (good rows, quarantined raw lines).

    PERMISSIVE keeps a malformed line's raw text in ``corrupt_col``; rows with a
    type error or a wrong field count go to quarantine instead of being silently
    dropped (which DROPMALFORMED would do).
    """
    sch2 = T.StructType(sch.fields + [T.StructField(corrupt_col, T.StringType(), True)])
    raw = (spark.read.schema(sch2)
           .option("header", "true").option("nullValue", "").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", corrupt_col).csv(path))
    # Spark forbids queries that reference only the corrupt column of a raw CSV scan;
    # materialise the parse once (shared checkpoint folder) and split.
    from ..session import cut_lineage
    parsed = cut_lineage(raw)
    good = parsed.where(F.col(corrupt_col).isNull()).drop(corrupt_col)
    bad = parsed.where(F.col(corrupt_col).isNotNull()).select(corrupt_col)
    return good, bad


# ---------------------------------------------------------------- sinks
def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
              fmt: str = "parquet") -> None:
    """SRC-05 truncate-and-insert: idempotent reload (rerun gives the same table)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def materialize(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """SRC-06 CTAS: write then re-read (cuts lineage; reader gets fresh statistics)."""
    overwrite(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


def materialize_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int | None = None,
                         name: str | None = None) -> DataFrame:
    """SRC-06 CTAS clustered for co-located reads: written bucketed and sorted by ``keys`` as an
    external catalog table whose files live at ``path``, then read back.  A later aggregation or join on
    ``keys`` with the same bucket count needs no shuffle.  ``name`` is the table's (else a new one)."""
    import uuid
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = name or f"strata_{os.path.basename(path.rstrip('/'))}_{uuid.uuid4().hex[:8]}"
    df.write.mode("overwrite").bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str, keys: Sequence[str], buckets: int, name: str) -> DataFrame:
    """The table that ``materialize_bucketed`` wrote, entered into the catalog again if this session's has no such name."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def stage(df: DataFrame) -> DataFrame:
    """SRC-10 staging table: reliable checkpoint in the shared checkpoint folder."""
    from ..session import cut_lineage
    return cut_lineage(df)


def view(name: str, df: DataFrame) -> DataFrame:
    """SRC-11 logical view."""
    df.createOrReplaceTempView(name)
    return df


# ---------------------------------------------------------------- generators
def values(spark: SparkSession, rows: Sequence[Sequence], sch) -> DataFrame:
    """SRC-07 inline VALUES relation (fixed-size literal data only)."""
    if isinstance(sch, (list, tuple)) and sch and isinstance(sch[0], tuple):
        sch = schema(sch)
    return spark.createDataFrame([tuple(r) for r in rows], sch)


def rows(spark: SparkSession, n: int, name: str = "i") -> DataFrame:
    """SRC-08 n rows with a 1-based index; distributed, no global window."""
    return spark.range(1, n + 1).withColumnRenamed("id", name)


def spine(spark: SparkSession, start, n: int, unit: str = "day", name: str = "d") -> DataFrame:
    """SRC-09 calendar spine of n periods from start (day / week / month)."""
    if isinstance(start, (_dt.date, _dt.datetime)):
        start = start.isoformat()[:10]
    s = F.lit(start).cast("date")
    step = {"day": "1 day", "week": "7 days", "month": "1 month"}[unit]
    if unit == "month":
        end = F.add_months(s, n - 1)
    else:
        end = F.date_add(s, (n - 1) * (7 if unit == "week" else 1))
    return spark.range(1).select(
        F.explode(F.sequence(s, end, F.expr(f"INTERVAL {step}"))).alias(name))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """SRC-14 load-time default columns (literal or Column)."""
    return df.withColumns({k: (v if hasattr(v, "_jc") else F.lit(v)) for k, v in defaults.items()})


def retype(df: DataFrame, column: str, dtype: str) -> DataFrame:
    """SRC-15 column type change (add typed column, replace); values that don't fit become null."""
    return df.withColumn(column, F.col(column).try_cast(dtype))


def retype_table(spark: SparkSession, table: str, column: str, dtype: str, path: str | None = None) -> None:
    """SRC-15 change a catalog table's column type by swapping tables.

    The new table is written beside the old one (at ``path``, or managed) and held against it: as many
    rows, and as many values in the column.  Only then are the names swapped, and the old table is dropped
    when the new one stands in its place.  Whatever fails before leaves the old table under its name.
    """
    import uuid
    mark = uuid.uuid4().hex[:8]
    new, old = f"{table}__new_{mark}", f"{table}__old_{mark}"

    def facts(name: str):
        return tuple(spark.table(name).agg(F.count(F.lit(1)), F.count(column)).first())

    try:
        w = retype(spark.table(table), column, dtype).write
        (w.option("path", path) if path else w).saveAsTable(new)
        if facts(new) != facts(table):
            raise ValueError(f"{table}.{column} holds values that are no {dtype}")
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
        except Exception:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
            raise
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    spark.sql(f"DROP TABLE {old}")


def catalog_counts(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """SRC-17 / QA-01 row count per named table as one union of 1-row aggregates."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
