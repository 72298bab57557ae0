"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` places on a ring of ``RING`` positions, taken from MD5 of its number; a row
stands at the position of its id's MD5 and belongs to the first node clockwise.  A shard holds its share
of the rows and not one more: of the rows that stand at its nodes it takes those it has room for, in
clockwise order, the others go on to the next node of a shard with room.  A round settles all shards at
once and fills one of them at least, or is the last, so there are at most as many rounds as shards.
Shares add up to the number of rows and differ by one at most, so the shards' sizes do; rows far from
full shards stay where the ring alone puts them, and a further shard moves few others.

Only counts take part in the rounds: the rows are counted by ring position, an arc of the ring (what
belongs to one node) is a range of places, and what a shard takes of it is a part of that range.  There
are at most ``shards * vnodes`` arcs, each cut once a round, whatever the number of rows.  A row finds
its place in its arc by a sort within its own cell (position and a part of the text's checksum).

Rows that are equal in all kept columns are counted together before any shuffle, and dealt out again in
pieces, so a row that repeats is not one task's work.  Null texts have size 1; a null id stands where
the empty string does.  No rows give no rows.  Columns of map type can't be kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import cut_lineage, shared_table_path

RING = 1 << 16  # positions: four hexadecimal digits
VNODES = 128
SUB = 16  # cells a position
PIECE = 1 << 13  # rows that a repeated row is dealt out in


def _position(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, 4), 16, 10).cast("int")


def ring_nodes(spark: SparkSession, shards: int, vnodes: int = VNODES) -> DataFrame:
    """(node, shard, lo, hi) clockwise: the ring positions lo to hi lead to the node; lo > hi where none does.

    Positions beyond the last node lead to the first one; they count from ``-RING``.
    """
    key = F.concat(F.lit("shard-"), F.floor(F.col("id") / vnodes), F.lit("-"), F.col("id") % vnodes)
    n = spark.range(0, shards * vnodes, 1, 1).select("id", F.floor(F.col("id") / vnodes).cast("int").alias("shard"), _position(key.cast("string")).alias("hi"))
    clockwise = Window.orderBy("hi", "id")
    n = n.select((F.row_number().over(clockwise) - 1).alias("node"), "shard", "hi", F.lag("hi").over(clockwise).alias("last"),
                 F.max("hi").over(Window.partitionBy()).alias("end"))
    return n.select("node", "shard", F.coalesce(F.col("last"), F.col("end") - RING).alias("last"), "hi").select(
        "node", "shard", (F.col("last") + 1).alias("lo"), "hi")


def _positions(nodes: DataFrame) -> DataFrame:
    """(position, arc, turn): the node that each ring position leads to; ``turn`` orders an arc's positions."""
    p = nodes.where("lo <= hi").select(F.col("node").alias("arc"), F.explode(F.sequence("lo", "hi")).alias("turn"))
    return p.select(F.pmod("turn", F.lit(RING)).alias("position"), "arc", "turn")


def place_arcs(arcs: DataFrame, nodes: DataFrame, capacity: DataFrame) -> DataFrame:
    """(arc, lo, hi, shard, slot): the places lo to hi - 1 of an arc go to a shard, where the first has that slot.

    ``arcs`` (arc, n) are the rows that stand at each node, ``capacity`` (shard, room) adds up to them or more.
    """
    node = nodes.select("node", "shard").coalesce(1)
    waiting = arcs.coalesce(1).select("arc", F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"), F.col("arc").alias("node")).join(F.broadcast(node), "node")
    placed = None
    while True:
        if placed is None:
            left = capacity.select("shard", "room", F.col("room").alias("left"))
        else:
            used = placed.groupBy("shard").agg(F.sum(F.col("hi") - F.col("lo")).alias("used"))
            left = capacity.join(F.broadcast(used), "shard", "left").select("shard", "room", (F.col("room") - F.coalesce("used", F.lit(0))).alias("left"))
            # the next node clockwise whose shard has room
            open_node = F.when(F.col("left") > 0, F.col("node"))
            after = Window.orderBy("node").rowsBetween(1, Window.unboundedFollowing)
            to = node.join(F.broadcast(left), "shard").select(
                "node", F.coalesce(F.min(open_node).over(after), F.min(open_node).over(Window.partitionBy())).alias("next"))
            waiting = rest.join(F.broadcast(to), "node").select("arc", "lo", "hi", F.col("next").alias("node")).join(F.broadcast(node), "node")
        size = F.col("hi") - F.col("lo")
        before = F.sum(size).over(Window.partitionBy("shard").orderBy("arc", "lo").rowsBetween(Window.unboundedPreceding, 0)) - size
        step = waiting.join(F.broadcast(left), "shard").withColumn("before", before)
        step = cut_lineage(step.withColumn("take", F.greatest(F.lit(0), F.least(size, F.col("left") - F.col("before")))))
        taken = step.where("take > 0").select("arc", "lo", (F.col("lo") + F.col("take")).alias("hi"), "shard", (F.col("room") - F.col("left") + F.col("before")).alias("slot"))
        placed = taken if placed is None else placed.union(taken)
        rest = step.where("lo + take < hi").select("arc", (F.col("lo") + F.col("take")).alias("lo"), "hi", "node")
        if rest.isEmpty():
            return placed


def shard_documents(docs: DataFrame, shards: int = 8, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
                    vnodes: int = VNODES) -> DataFrame:
    """(rest, size, text_crc32, shard, slot) of every row; ``rest`` holds the kept columns (all unless ``keep`` names some)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in (docs.columns if keep is None else keep))).alias("rest"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("mark"),
        (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.groupBy("rest", "mark", "size", "text_crc32").agg(F.count("*").alias("n")).select(
        "*", F.conv(F.substring("mark", 1, 4), 16, 10).cast("int").alias("position"), (F.col("text_crc32") % SUB).cast("int").alias("sub"))
    path = shared_table_path(spark, "ring_rows")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)

    nodes = cut_lineage(ring_nodes(spark, shards, vnodes))
    cells = rows.groupBy("position", "sub").agg(F.sum("n").alias("n")).join(F.broadcast(_positions(nodes)), "position")
    cells = cut_lineage(cells.withColumn("first", F.sum("n").over(
        Window.partitionBy("arc").orderBy("turn", "sub").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")))
    total = cells.agg(F.sum("n")).first()[0] or 0
    capacity = spark.range(0, shards, 1, 1).select(F.col("id").cast("int").alias("shard"), (F.lit(total // shards) + (F.col("id") < total % shards).cast("long")).alias("room"))
    placed = place_arcs(cells.groupBy("arc").agg(F.sum("n").alias("n")), nodes, capacity)

    own = Window.partitionBy("position", "sub").orderBy("mark", "size", "text_crc32", "rest").rowsBetween(Window.unboundedPreceding, 0)
    at = rows.withColumn("upto", F.sum("n").over(own)).join(cells.select("position", "sub", "arc", "first"), ["position", "sub"])
    at = at.select("rest", "size", "text_crc32", "arc", (F.col("first") + F.col("upto") - F.col("n")).alias("a"), (F.col("first") + F.col("upto")).alias("b"))
    at = at.join(F.broadcast(placed), "arc").where("a < hi and lo < b").select(
        "rest", "size", "text_crc32", "shard", (F.col("slot") + F.greatest("a", "lo") - F.col("lo")).alias("a"), (F.col("slot") + F.least("b", "hi") - F.col("lo")).alias("b"))
    at = at.withColumn("a", F.explode(F.sequence(F.col("a"), F.col("b") - 1, F.lit(PIECE)))).repartition("shard", "a")
    return at.select("rest", "size", "text_crc32", "shard", F.explode(F.sequence(F.col("a"), F.least(F.col("b") - 1, F.col("a") + PIECE - 1))).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", vnodes: int = VNODES) -> None:
    """Parquet of all columns of ``docs`` and ``slot`` in a folder per shard, files ordered by slot."""
    out = shard_documents(docs, shards, None, id_col, text_col, vnodes)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
