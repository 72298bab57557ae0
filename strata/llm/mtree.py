"""Exact top-k inner products by best-first search in an M-tree of paged metric nodes.

Inner products become distances by one more component: with M the largest norm, x' = (x, sqrt(M² -
|x|²)) and q' = (q, 0), d²(q', x') = |q|² + M² - 2 q·x, so the largest products are the nearest x'.

The tree is built once and written as pages.  Its directory has the subtrees: rows are dealt to the
nearest of some sampled pivots, pivots with many rows (copies of a third of the table) to several
subtrees, so that each has about ``SUBTREE`` rows.  A subtree is split into leaf pages of ``PAGE`` entries; a page
has its routing object, covering radius and distance to the subtree's object (its parent), an
entry its distance to the page's object.

Each query searches its own subtree first, which gives a bound (its k-th best score).  The directory
is then compared with the queries in blocks; subtrees whose covering ball lies beyond the bound are
pruned, the others are searched best-first.  Within a subtree, |d(q, parent) - d(parent, x)| from
stored distances leaves out pages and entries whose own distance is then never computed.

Scores are computed in integers; ties go to the smaller id.  Pruning is strict with a small slack
for rounding, so results are exact.  Vectors that are null or hold null or non-finite components take no part,
nor do rows with a null id; vectors of another length than the query's score nothing.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.session import cut_lineage, shared_table_path

from .vectors import usable

SUBTREE = 8192
PAGE = 128
PIVOTS = 4096
BLOCK = 1024
SLACK = 1e-9

_PAGES = "tree long, dims int, page int, routing binary, radius double, parent_distance double, root binary, ids binary, entries binary, distances binary"


def _ints(blobs, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.int64).reshape(-1, dims)


def _products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of x with q."""
    top = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
    return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64) if top < 2**53 else x @ q


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the component that makes all norms equal to sqrt(top)."""
    x = x.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(0, top - np.einsum("ij,ij->i", x, x)))[:, None]])


def _nearest(pivots: dict[int, np.ndarray]):
    def run(iterator):
        for pdf in iterator:
            out = np.zeros(len(pdf), np.int64)
            dims = pdf["dims"].to_numpy()
            for d in np.unique(dims):
                p = pivots.get(int(d))
                at = np.flatnonzero(dims == d)
                if p is not None:
                    x = _ints(pdf["vec"].iloc[at], int(d)).astype(np.float64)
                    out[at] = (np.einsum("ij,ij->i", p, p)[None, :] - 2 * x @ p.T).argmin(axis=1)
            yield pdf.assign(pivot=out)[["vec_id", "dims", "pivot", "vec"]]

    return run


def _split(x: np.ndarray, rows: np.ndarray):
    """Leaf pages: rows halved around two far objects until a page holds them."""
    todo, leaves = [rows], []
    while todo:
        own = todo.pop()
        if len(own) <= PAGE:
            leaves.append(own)
            continue
        a = x[own[0]]
        far = np.einsum("ij,ij->i", x[own] - a, x[own] - a)
        b = x[own[far.argmax()]]
        near = np.einsum("ij,ij->i", x[own] - b, x[own] - b) < far
        if not near.any() or near.all():  # copies of one vector
            near = np.arange(len(own)) < len(own) // 2
        todo += [own[near], own[~near]]
    return leaves


def _build(top: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        dims, ids = int(pdf["dims"].iloc[0]), pdf["vec_id"].to_numpy()
        ints = _ints(pdf["vec"], dims)
        x = _lift(ints, top)
        root = x[((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin()]
        out = []
        for k, own in enumerate(_split(x, np.arange(len(x)))):
            own = np.sort(own)
            routing = x[own[((x[own] - x[own].mean(axis=0)) ** 2).sum(axis=1).argmin()]]
            away = np.sqrt(((x[own] - routing) ** 2).sum(axis=1))
            out.append((pdf["tree"].iloc[0], dims, k, routing.tobytes(), away.max(), np.sqrt(((routing - root) ** 2).sum()), root.tobytes(),
                        ids[own].tobytes(), ints[own].tobytes(), away.tobytes()))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _PAGES.split(", ")])

    return run


class _Tree:
    """The pages of one subtree, ready for searches."""

    def __init__(self, pages: pd.DataFrame):
        self.dims = int(pages["dims"].iloc[0])
        f = lambda c: np.vstack([np.frombuffer(b) for b in pages[c]])
        self.routing, self.root = f("routing"), np.frombuffer(pages["root"].iloc[0])
        self.radius, self.parent = pages["radius"].to_numpy(), pages["parent_distance"].to_numpy()
        self.ids = [np.frombuffer(b, np.int64) for b in pages["ids"]]
        self.entries = [np.frombuffer(b, np.int64).reshape(-1, self.dims) for b in pages["entries"]]
        self.distances = [np.frombuffer(b) for b in pages["distances"]]

    def search(self, q: np.ndarray, own_id: int, k: int, bound: float, top: float) -> list[tuple[int, int]]:
        """(score, -id) of the k best entries whose score reaches ``bound`` (-inf: no bound yet)."""
        lifted = np.append(q.astype(np.float64), 0.0)
        full = float(lifted @ lifted) + top
        slack = SLACK * (full + 1)
        reach = lambda score: np.sqrt(max(0.0, full - 2 * score + slack))  # noqa: E731  the distance that a score lies at
        best: list[tuple[int, int]] = []
        limit = np.inf if bound == -np.inf else reach(bound)
        at_root = np.sqrt(((self.root - lifted) ** 2).sum())
        # pages that the stored distance to their parent can't exclude
        pages = np.flatnonzero(np.abs(at_root - self.parent) - self.radius <= limit + slack)
        away = np.sqrt(((self.routing[pages] - lifted) ** 2).sum(axis=1))
        lower = np.maximum(0, away - self.radius[pages])
        for i in np.argsort(lower, kind="stable"):
            if lower[i] > limit + slack:
                break
            p = pages[i]
            entries = np.flatnonzero(np.abs(away[i] - self.distances[p]) <= limit + slack)
            if not len(entries):
                continue
            ids, score = self.ids[p][entries], _products(self.entries[p][entries], q)
            fine = (ids != own_id) & (score >= bound)
            for item in zip(score[fine].tolist(), (-ids[fine]).tolist()):
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k and best[0][0] > bound:
                bound = best[0][0]
                limit = reach(bound)
        return best


_FOUND = "query_id long, vec_id long, score long"


def _search(k: int, top: float):
    def run(queries: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(pages):
            tree = _Tree(pages)
            for i, v, bound in zip(queries["query_id"], queries["vec"], queries["bound"]):
                q = np.frombuffer(v, np.int64)
                out += [(i, -o, s) for s, o in tree.search(q, i, k, -np.inf if pd.isna(bound) else bound, top)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")

    return run


def _candidates(top: float):
    """Subtrees that the bound of a query can't exclude, for a block of queries and one of the directory."""

    def run(queries: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(trees):
            q = np.vstack([np.frombuffer(v, np.int64) for v in queries["vec"]]).astype(np.float64)
            q = np.hstack([q, np.zeros((len(q), 1))])
            c = np.vstack([np.frombuffer(b) for b in trees["root"]])
            qq = np.einsum("ij,ij->i", q, q)
            away = np.sqrt(np.maximum(0, qq[:, None] + np.einsum("ij,ij->i", c, c)[None, :] - 2 * q @ c.T))
            slack = 1e-7 * (np.sqrt(qq + top) + 1)
            bound = queries["bound"].to_numpy(np.float64, na_value=-np.inf)
            limit = np.sqrt(np.maximum(0, qq + top - 2 * bound))
            near = away - trees["radius"].to_numpy()[None, :] <= (limit + slack)[:, None]
            near &= queries["tree"].to_numpy()[:, None] != trees["tree"].to_numpy()[None, :]
            a, b = np.nonzero(near)
            out = {"tree": trees["tree"].to_numpy()[b], "query_id": queries["query_id"].to_numpy()[a],
                   "vec": queries["vec"].to_numpy()[a], "bound": queries["bound"].to_numpy()[a]}
        return pd.DataFrame(out, columns=["tree", "query_id", "vec", "bound"])

    return run


def build(table: DataFrame, id_col: str, vec_col: str, scale: int = 1024) -> tuple[DataFrame, DataFrame, float]:
    """(pages, rows with their subtree, largest squared norm) of the usable rows of ``table``."""
    spark = table.sparkSession
    v = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec")).where(usable("vec") & F.col("vec_id").isNotNull())
    v = v.select("vec_id", F.size("vec").alias("dims"), F.transform("vec", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("ints"))
    norm = F.aggregate("ints", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    stats = v.agg(F.max(norm).alias("top"), F.count("*").alias("n")).first()
    top, n = float(stats["top"] or 0.0) + 1.0, stats["n"]

    def blob(rows):
        for pdf in rows:
            yield pdf.assign(vec=[np.asarray(x, np.int64).tobytes() for x in pdf["ints"]])[["vec_id", "dims", "vec"]]

    packed = v.mapInPandas(blob, "vec_id long, dims int, vec binary")
    wanted = min(PIVOTS, max(1, n // (SUBTREE // 4)))  # pivots: a bounded sample
    sample = packed.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()
    pivots = {}
    for d in {r["dims"] for r in sample}:
        pivots[d] = _ints([r["vec"] for r in sample if r["dims"] == d], d).astype(np.float64)
    dealt = packed.mapInPandas(_nearest(pivots), "vec_id long, dims int, pivot long, vec binary")
    path = shared_table_path(spark, "mtree_rows")
    dealt.write.parquet(path)
    dealt = spark.read.parquet(path)
    parts = dealt.groupBy("dims", "pivot").agg(F.ceil(F.count("*") / SUBTREE).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("vec_id", F.lit(1)), "parts")
    rows = dealt.join(parts, ["dims", "pivot"]).select("vec_id", "dims", F.xxhash64("dims", "pivot", part).alias("tree"), "vec")
    path = shared_table_path(spark, "mtree_pages")
    rows.groupBy("tree").applyInPandas(_build(top), _PAGES).write.parquet(path)
    return spark.read.parquet(path), rows, top


def top_products(table: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest products of every query with the rows of ``table`` but itself.

    ``queries`` has an id column of the same name; its rows are rows of ``table``.
    """
    pages, rows, top = build(table, id_col, vec_col, scale)
    asked = queries.select(F.col(id_col).cast("long").alias("vec_id")).distinct()
    q = rows.join(asked, "vec_id", "left_semi").select("tree", "dims", F.col("vec_id").alias("query_id"), "vec").dropDuplicates(["query_id"])
    q = cut_lineage(q.withColumn("bound", F.lit(None).cast("double")))
    home = cut_lineage(q.groupBy("tree").cogroup(pages.groupBy("tree")).applyInPandas(_search(k, top), _FOUND))
    bounds = home.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("bound"))
    q = q.drop("bound").join(bounds, "query_id", "left")
    # the subtree's covering ball: over its pages, distance of the page's object plus the page's radius
    directory = pages.groupBy("tree", "dims").agg(F.first("root").alias("root"), F.max(F.col("parent_distance") + F.col("radius")).alias("radius"))
    n_blocks = max(1, -(-directory.count() // BLOCK))
    q_blocks = max(1, -(-q.count() // BLOCK))
    q = q.withColumn("q_block", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    directory = directory.withColumn("block", F.pmod(F.xxhash64("tree"), F.lit(n_blocks)).cast("int")).withColumn(
        "q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    key = ["block", "q_block", "dims"]
    more = q.groupBy(*key).cogroup(directory.groupBy(*key)).applyInPandas(_candidates(top), "tree long, query_id long, vec binary, bound double")
    found = more.groupBy("tree").cogroup(pages.groupBy("tree")).applyInPandas(_search(k, top), _FOUND).unionByName(home)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
