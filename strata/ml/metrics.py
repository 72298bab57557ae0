"""Model evaluation and monitoring metrics as distributed aggregates.

Score-ordered statistics (ROC AUC with tied ranks, average precision, rank-based
quantile edges) need cumulative counts over the sorted scores.  They are
computed on the *distinct* scores (partial aggregation first), with a
distributed prefix sum: range-partition by score, checkpoint, per-partition
totals (one row per partition) as offsets, in-partition running sums.  No
global single-task window and nothing collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.windows import row_number_distributed
from ..session import cut_lineage


def prefix_sums(vals: DataFrame, order_col: str, weights: Sequence[str], descending: bool = False,
                inclusive: bool = False, group: str | None = None) -> DataFrame:
    """For each row of ``vals`` (one row per distinct order value [per group]) add ``cum_<w>``:
    the sum of ``w`` over rows strictly before it (or up to and including it) in the order."""
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    keys = ([group] if group else [])
    n = int(vals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(group).asc()] + [o] if group else [o]
    ranged = cut_lineage(vals.repartitionByRange(n, *order).sortWithinPartitions(*order))
    x = ranged.withColumn("_pid", F.spark_partition_id())
    tot = x.groupBy(*keys, "_pid").agg(*[F.sum(w).alias(f"_t_{w}") for w in weights])
    wp = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*keys, "_pid", *[F.coalesce(F.sum(f"_t_{w}").over(wp), F.lit(0)).alias(f"_o_{w}") for w in weights])
    frame = (Window.unboundedPreceding, 0) if inclusive else (Window.unboundedPreceding, -1)
    wi = Window.partitionBy(*keys, "_pid").orderBy(o).rowsBetween(*frame)
    x = x.select("*", *[F.coalesce(F.sum(w).over(wi), F.lit(0)).alias(f"_i_{w}") for w in weights])
    # one offset row per partition is bounded and broadcast; per (group, partition) it grows
    # with the groups, so AQE decides after measuring it
    x = x.join(off if group else F.broadcast(off), keys + ["_pid"])
    return x.select(*vals.columns, *[(F.col(f"_o_{w}") + F.col(f"_i_{w}")).alias(f"cum_{w}") for w in weights])


def _score_counts(df: DataFrame, score: str, label: str, group: str | None = None) -> DataFrame:
    keys = ([group] if group else []) + [score]
    return df.groupBy(*keys).agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
                                 F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg"))


def roc_auc(df: DataFrame, score: str, label: str, group: str | None = None) -> DataFrame:
    """ML-07 ROC AUC = P(score+ > score-) + 0.5 P(tie): equal to the rank-sum formula with
    average ranks.  Optional ``group`` gives one AUC per group (MON-02 daily metric)."""
    c = _score_counts(df, score, label, group)
    p = prefix_sums(c, score, ["neg"], group=group)
    keys = [group] if group else []
    agg = p.groupBy(*keys).agg(F.sum(F.col("pos") * (F.col("cum_neg") + 0.5 * F.col("neg"))).alias("_u"),
                               F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return agg.select(*keys, F.try_divide(F.col("_u"), F.col("_p") * F.col("_n")).alias("roc_auc"))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """ML-08 AP = sum over distinct thresholds (descending) of Δrecall × precision."""
    c = _score_counts(df, score, label)
    p = prefix_sums(c, score, ["pos", "neg"], descending=True, inclusive=True)
    tot = c.agg(F.sum("pos")).scalar()
    s = p.agg(F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("_s"))
    return s.select((F.col("_s") / tot)
                  .alias("average_precision"))


def classification_report(df: DataFrame, pred: str, label: str) -> DataFrame:
    """ML-06 accuracy and per-class precision / recall / F1 / support from confusion counts."""
    cm = df.groupBy(F.col(label).alias("y"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    # each confusion cell (y, p, n) counts for class y (tp if p == y, else fn) and for
    # class p (fp if p != y): two rows per cell, then one grouped sum per class
    hit = F.col("y") == F.col("p")
    zero = F.lit(0).cast("bigint")
    cell = F.explode(F.array(
        F.struct(F.col("y").alias("cls"), F.when(hit, F.col("n")).otherwise(zero).alias("tp"), zero.alias("fp"),
                 F.when(hit, zero).otherwise(F.col("n")).alias("fn")),
        F.struct(F.col("p").alias("cls"), zero.alias("tp"), F.when(hit, zero).otherwise(F.col("n")).alias("fp"),
                 zero.alias("fn")))).alias("c")
    g = cm.select(cell).select("c.*").groupBy("cls").agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    prec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn"))
    acc = cm.agg(F.try_divide(F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)).cast("double"),
                              F.sum("n")).alias("accuracy"))
    out = g.select(F.col("cls").alias("class"), prec.alias("precision"), rec.alias("recall"),
                   (F.col("tp") + F.col("fn")).alias("support"))
    out = out.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    return out.withColumn("accuracy", acc.scalar())


def stratified_split(df: DataFrame, key: str, label: str, frac: float = 0.8, salt: str = "split") -> DataFrame:
    """ML-02 deterministic stratified split: within each label, rows ranked by a salted hash of
    the key (key as tiebreak); the first round(frac * n_label) go to train.  The rank is a
    distributed row number over (label, hash, key) minus the label's starting offset."""
    from ..functions.keyed import hash32
    x = df.withColumn("_h", hash32(key, salt))
    r = row_number_distributed(x, [label, "_h", key], "_rn")
    per = r.groupBy(label).agg(F.min("_rn").alias("_start"), F.count(F.lit(1)).alias("_nl"))
    r = r.join(per, label)  # one row per label value: AQE broadcasts it after measuring
    rank = F.col("_rn") - F.col("_start") + 1
    return r.withColumn("split", F.when(rank <= F.floor(F.col("_nl") * frac + 0.5), F.lit("train")).otherwise(F.lit("test"))) \
        .drop("_h", "_rn", "_start", "_nl")


def quantile_edges(df: DataFrame, col: str, key: str, bins: int = 10) -> DataFrame:
    """Exact decile edges: value at row number ceil(k n / bins), k = 1..bins-1 (distributed)."""
    n = df.agg(F.count(F.lit(1))).scalar()
    r = row_number_distributed(df.select(col, key), [col, key], "_rn")
    ks = df.sparkSession.range(1, bins).withColumnRenamed("id", "k")
    targets = ks.select("k", F.ceil(F.col("k") * n / bins).alias("_rn"))  # bins - 1 rows
    return r.join(F.broadcast(targets), "_rn").select("k", F.col(col).alias("edge"))


def psi(base: DataFrame, cur: DataFrame, col: str, key: str, bins: int = 10, floor: float = 1e-6) -> DataFrame:
    """MON-03 population stability index of ``col``: baseline decile edges, bin shares with a
    floor, sum (cur - base) * ln(cur / base)."""
    edges = quantile_edges(base, col, key, bins).agg(F.array_sort(F.collect_list("edge"))).scalar()  # bins-1 values

    def shares(df, name):
        b = df.select(col, edges.alias("_edges")) \
            .select(F.size(F.filter("_edges", lambda e: e < F.col(col))).alias("bin"))
        g = b.groupBy("bin").agg(F.count(F.lit(1)).alias("_c"))
        return g.select("bin", (F.col("_c") / g.agg(F.sum("_c")).scalar()).alias(name))

    allbins = base.sparkSession.range(0, bins).withColumnRenamed("id", "bin")
    s = allbins.join(shares(base, "b"), "bin", "left").join(shares(cur, "c"), "bin", "left")
    s = s.select(F.greatest(F.coalesce("b", F.lit(0.0)), F.lit(floor)).alias("b"),
                 F.greatest(F.coalesce("c", F.lit(0.0)), F.lit(floor)).alias("c"))
    return s.agg(F.sum((F.col("c") - F.col("b")) * F.log(F.col("c") / F.col("b"))).alias("psi")) \
        .select(F.lit(col).alias("feature"), "psi")
