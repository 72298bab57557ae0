"""Window, sort and top-k operators.

Global (un-partitioned) windows run in one task, so every global rank / row
number here is computed distributed:

* ``row_number_distributed``: range-partition by the order keys, sort within
  partitions, checkpoint (so every branch reads identical partitions), take the in-partition position from
  ``monotonically_increasing_id`` (its low 33 bits are the row index inside
  the partition), and add the number of rows in all earlier partitions.  The
  offsets table has one row per partition - a size bound known before the
  job runs - and is the only broadcast.
* ``rank_distributed``: quantile cut points of the ranked column deal the rows into slots (a value
  that is a cut point, or lies between two of them); a slot's rank offset is the rows of all better
  slots, a row at a cut point has that rank, and only rows between cut points are sorted, slot by slot.
  A value that many rows share is a cut point, so it is never sorted or joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_table_path
from ..sources.io import materialize

_LOW33 = (1 << 33) - 1


# slots that cut points make at most: beyond SLOTS shuffle partitions a slot gets longer (its sort spills)
SLOTS = 512


def _slots(spark) -> int:
    return min(SLOTS, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def quantile_cuts(df: DataFrame, c: str, n: int) -> list:
    """Distinct values, in order, that cut the non-null values of ``c`` into about ``n`` runs of equal length.
    At most n - 1 values come to the driver, whatever the number of rows."""
    got = df.agg(F.percentile_approx(c, [i / n for i in range(1, n)], 100 * n)).first()[0] if n > 1 else None
    return sorted(set(got or []))


def slot_of(v: Column, cuts: list) -> Column:
    """2 * i between cut points i - 1 and i, 2 * i + 1 at cut point i, null for null: a binary search as nested CASEs."""
    if not cuts:
        return F.when(v.isNotNull(), F.lit(0))

    def find(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(2 * lo)
        mid = (lo + hi) // 2
        return F.when(v < cuts[mid], find(lo, mid)).when(v == cuts[mid], F.lit(2 * mid + 1)).otherwise(find(mid + 1, hi))

    return F.when(v.isNotNull(), find(0, len(cuts)))


def _sort_cols(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def row_number_distributed(df: DataFrame, order: Sequence, name: str = "rn",
                           partitions: int | None = None) -> DataFrame:
    """WIN-08 dense 1..N row number by a total order, without a 1-task window.

    ``order`` must be a total order (add tiebreak columns) for a deterministic
    result.
    """
    cols = _sort_cols(order)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Materialise the range-partitioned, sorted rows once (reliable checkpoint in the
    # shared checkpoint folder): the per-partition counts and the in-partition
    # positions must see exactly the same partitions.
    ranged = cut_lineage(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols))
    ided = ranged.withColumn("_mid", F.monotonically_increasing_id())
    ided = ided.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    counts = ided.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: cumulative offset over <= n rows
    offsets = counts.select(
        "_pid", (F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    out = ided.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos") + 1).cast("bigint")) \
        .drop("_mid", "_pid", "_pos", "_off")


def rank_distributed(df: DataFrame, c: str, name: str = "rank", descending: bool = True,
                     with_total: str | None = None) -> DataFrame:
    """WIN-09 RANK() OVER (ORDER BY c [DESC] NULLS LAST) computed distributed; ``c`` is a number, date or timestamp.

    rank(v) = 1 + number of rows with a strictly better value; nulls rank after all values.
    The input runs once: its rows are written to the shared folder.  Cut points and slot counts read
    column ``c`` of the written rows, the result reads them once more.  Ties carry over slots by
    construction, as equal values are in one slot, and one that is larger than a slot is a cut point.
    """
    spark = df.sparkSession
    rows = materialize(df, shared_table_path(spark, "rank_rows"))
    cuts = quantile_cuts(rows.select(F.col(c).alias("v")), "v", _slots(spark))
    slot = slot_of(F.col(c), cuts)
    counts = rows.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per slot: at most 2 * SLOTS + 2, whatever the number of rows
    order = F.col("_slot").desc_nulls_last() if descending else F.col("_slot").asc_nulls_last()
    before = F.sum("_n").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.coalesce("_slot", F.lit(-1)).alias("_slot"), F.coalesce(before, F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy()).alias("_rows"))
    x = rows.withColumn("_slot", F.coalesce(slot, F.lit(-1))).join(F.broadcast(offsets), "_slot")
    by = F.col(c).desc() if descending else F.col(c).asc()
    between = x.where((F.col("_slot") >= 0) & (F.col("_slot") % 2 == 0)).withColumn(
        "_r", F.rank().over(Window.partitionBy("_slot").orderBy(by)))
    at = x.where((F.col("_slot") < 0) | (F.col("_slot") % 2 == 1)).withColumn("_r", F.lit(1))
    out = between.unionByName(at).withColumn(name, (F.col("_off") + F.col("_r")).cast("bigint"))
    if with_total:
        out = out.withColumn(with_total, F.col("_rows").cast("bigint"))
    return out.drop("_slot", "_off", "_rows", "_r")


def rank_desc(df: DataFrame, c: str, name: str = "rank") -> DataFrame:
    """WIN-01 RANK() over a global metric DESC (ties share), distributed."""
    return rank_distributed(df, c, name, descending=True)


def with_total(df: DataFrame, name: str = "total") -> DataFrame:
    """WIN-02 COUNT(*) OVER () as a scalar subquery (no single-partition window)."""
    return df.withColumn(name, df.agg(F.count(F.lit(1)).cast("bigint")).scalar())


def rank_pct(df: DataFrame, c: str, name: str = "percentile") -> DataFrame:
    """WIN-03 (rank - 1) / N * 100, best = 0 (not percent_rank, T5)."""
    r = rank_distributed(df, c, "_rank", descending=True, with_total="_total")
    return r.withColumn(name, (F.col("_rank") - 1) / F.col("_total").cast("double") * 100) \
        .drop("_rank", "_total")


def first_date(df: DataFrame, key: str, date: str, name: str = "first_date") -> DataFrame:
    """WIN-04 MIN(date) over the entity, as aggregate + join (no per-key sort)."""
    m = df.groupBy(key).agg(F.min(date).alias(name))
    return df.join(m, key)


def index_rows(df: DataFrame, order: Sequence, name: str = "rn") -> DataFrame:
    """WIN-05 ROW_NUMBER ordered by keys (distributed)."""
    return row_number_distributed(df, order, name)


def surrogate(df: DataFrame, order: Sequence, prefix: str, width: int, name: str = "id") -> DataFrame:
    """WIN-06 formatted surrogate id from a distributed row number."""
    r = row_number_distributed(df, order, "_rn")
    return r.withColumn(name, F.concat(F.lit(prefix), F.lpad(F.col("_rn").cast("string"), width, "0"))).drop("_rn")


def seq_within(df: DataFrame, key, order: Sequence, name: str = "seq", partitions: int | None = None) -> DataFrame:
    """1-based position of each row inside its key by a total ``order``, without a per-key window.

    Range partitioning on (key, order) lets a hot key span several partitions;
    after a checkpoint (identical partitions for every branch) each row's
    position is its in-partition index minus the key's first index in that
    partition, plus the key's row count in earlier partitions.  The offsets
    table has one row per (partition, key) and is joined, not broadcast.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = [F.col(k) for k in keys] + _sort_cols(order)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols))
    ided = ranged.withColumn("_mid", F.monotonically_increasing_id())
    ided = ided.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    pk = ided.groupBy("_pid", *keys).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = pk.select("_pid", *keys, "_first", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    out = ided.join(off, ["_pid", *keys])
    return out.withColumn(name, (F.col("_off") + F.col("_pos") - F.col("_first") + 1).cast("bigint")) \
        .drop("_mid", "_pid", "_pos", "_first", "_off")


def gap_days(df: DataFrame, key: str, date: str, order: Sequence | None = None, name: str = "gap_days") -> DataFrame:
    """WIN-10 days since the previous event of the same key (``order`` = total order, default date).

    The previous row is found by joining each row's (key, seq) to (key, seq + 1)
    of the sequence from ``seq_within``, so a hot key is spread over the join.
    """
    order = list(order) if order else [date]
    s = seq_within(df, key, order, "_seq")
    prev = s.select(F.col(key), (F.col("_seq") + 1).alias("_seq"), F.col(date).alias("_prev"))
    return s.join(prev, [key, "_seq"], "left") \
        .withColumn(name, F.datediff(F.to_date(date), F.to_date("_prev"))).drop("_seq", "_prev")


def half_trend(df: DataFrame, key: str, order: Sequence[str], val: str) -> DataFrame:
    """WIN-11 second-half mean minus first-half mean, relative to the first half.

    Rows are numbered per key (ties broken by all ``order`` columns, distributed
    ``seq_within``), split at n // 2; 0 when n < 4 or the first-half mean <= 0.
    """
    x = seq_within(df.select(key, *order, val), key, order, "_rn")
    n = x.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    x = x.join(n, key)
    g = x.groupBy(key).agg(
        F.max("_n").alias("_n"),
        F.avg(F.when(F.col("_rn") <= F.floor(F.col("_n") / 2), F.col(val))).alias("_first"),
        F.avg(F.when(F.col("_rn") > F.floor(F.col("_n") / 2), F.col(val))).alias("_second"))
    trend = F.when((F.col("_n") < 4) | (F.col("_first") <= 0), F.lit(0.0)) \
        .otherwise((F.col("_second") - F.col("_first")) / F.col("_first"))
    return g.select(key, trend.alias("spend_trend"))


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """SORT-02 top-k by metric: TakeOrderedAndProject (k rows per task, then k)."""
    return df.orderBy(*_sort_cols(order)).limit(k)


def top_k_per(df: DataFrame, key, order: Sequence, k: int, name: str = "rn") -> DataFrame:
    """SORT-04 top-k per group: row_number over the group <= k."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*_sort_cols(order))
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def first_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """SORT-03 first N entities by id."""
    return top_k(df, order, n)


def top_k_per_salted(df: DataFrame, key, order: Sequence, k: int, salt_cols: Sequence[str],
                     salts: int = 64, name: str = "rank") -> DataFrame:
    """Exact top-k per group when one group can be very large (a query matching most
    documents): top-k within (group, salt) sub-groups first, then top-k over at most
    salts*k survivors per group.  ``order`` must be total for an exact, stable result."""
    keys = [key] if isinstance(key, str) else list(key)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.lit(salts)))
    first = top_k_per(salted, keys + ["_salt"], order, k, "_r1").drop("_r1", "_salt")
    return top_k_per(first, keys, order, k, name)
