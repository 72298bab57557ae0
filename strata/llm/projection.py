"""Near-duplicate vectors by sorted projection passes.

Equal vectors are one class from the start.  Every pass gives each class a key, the concatenated
signs of ``BITS`` random projections, and sorts by it; vectors at a small angle share a long prefix
in some pass and stand close together.  Each is compared in double precision with the ``WINDOW``
next ones; windows run on across partitions.  A task hands on only links that join two of its sets, so
a crowd of near copies makes as many rows as it has members, and the links of all passes are
united into components.

Vectors that crowd a part of the space stand further apart than a window.  So runs of keys with a common
beginning that outgrow the window are compared whole: cut into blocks, each pair of blocks one matrix
product.  Besides, the ``HUBS`` vectors with most links are compared with all others, which finds the
members of a crowd that only its centre holds together.

All links of a vector lie within its component, so these are then counted exactly there: components
are cut into blocks and every pair of blocks is one matrix product.  No pairs are written.

The number of passes follows from the number of vectors: a pair right at the threshold is missed by
all passes in ``MISS`` of cases at most, however the vectors spread, closer pairs much more rarely.

Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do vectors
of different lengths.  A null id has a null component and is kept; rows that repeat an id share one.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage, shared_table_path

from .graph import components
from .vectors import matrix, unit, usable

BITS = 60
WINDOW = 64
MISS = 0.005
ROWS = 20_000  # of a pass's rows a task sorts
BLOCK = 512
RUN_BLOCK = 2048
HUBS = 256


def passes(n: int, threshold: float, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold stood in one window with probability 1 - miss."""
    agree = 1 - math.acos(threshold) / math.pi
    found = agree ** max(0.0, math.log2(max(1, n) / window))
    return max(4, math.ceil(math.log(miss) / math.log(max(1e-9, 1 - min(found, 0.999)))))


def prefix_bits(n: int, window: int = WINDOW) -> int:
    """Bits after which a run of keys fits the window if the vectors spread evenly; what ``passes`` counts on."""
    return min(BITS, max(0, math.floor(math.log2(max(1, n) / window))))


def _class_rows(single: bool):
    """(vec_id, dims, h1, h2, vec): raw bytes of each usable vector and a hash of its direction."""
    kind = np.float32 if single else np.float64

    def run(batches):
        for batch in batches:
            out = []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("vec")):
                x = v.values.to_numpy(zero_copy_only=False).astype(kind)
                u = unit(x.astype(np.float64)[None, :])[0]
                if u.any():
                    h = hashlib.blake2b((u + 0.0).tobytes(), digest_size=16).digest()
                    out.append((i, len(x), int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True), x.tobytes()))
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()])],
                                             ["vec_id", "dims", "h1", "h2", "vec"])

    return run


def _key_rows(n_passes: int, kind):
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                if d not in planes:
                    planes[d] = np.random.default_rng([7, int(d)]).standard_normal((n_passes, d, BITS))
                x = unit(matrix(part.column("vec"), int(d), kind))
                for p in range(n_passes):
                    key = ((x @ planes[d][p] > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), p, np.int32)), part.column("dims"), pa.array(key), part.column("rep"), part.column("vec")],
                                                     ["pass", "dims", "key", "rep", "vec"])

    return run


class _Sets:
    """Union-find over the ids that a task has seen in links."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x):
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _window_links(rep, pas, dims, vecs, kind, new: int, threshold: float, sets: _Sets):
    """Links that join sets, between rows at most WINDOW apart of which the later has index >= new."""
    out = []
    for d in np.unique(dims):
        own = np.flatnonzero(dims == d)
        x = unit(matrix([vecs[i] for i in own], int(d), kind))
        r, p = rep[own], pas[own]
        for off in range(1, min(WINDOW, len(own) - 1) + 1):
            cos = np.einsum("ij,ij->i", x[:-off], x[off:])
            for i in np.flatnonzero((cos >= threshold) & (p[:-off] == p[off:]) & (own[off:] >= new)):
                a, b = int(r[i]), int(r[i + off])
                if sets.join(a, b):
                    out.append((a, b))
    return out


_OUT = "a long, b long, edge int, side int, pass int, dims int, key long, rep long, vec binary"
_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
_NAMES = [x.split()[0] for x in _OUT.split(", ")]


def _batch(rows):
    columns = list(zip(*rows)) if rows else [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], _NAMES)


def _window_rows(kind, threshold: float):
    """Links of a sorted partition, and its first and last rows for the windows that run on."""

    def run(batches):
        at, sets, held, first = TaskContext.get().partitionId(), _Sets(), [], 0
        for batch in batches:
            rows = held + list(zip(*(batch.column(c).to_pylist() for c in ("pass", "dims", "key", "rep", "vec"))))
            if first < WINDOW:
                head = rows[len(held):][:WINDOW - first]
                first += len(head)
                yield _batch([(None, None, at - 1, 1, *r) for r in head])
            links = _window_links(np.array([r[3] for r in rows]), np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), [r[4] for r in rows],
                                  kind, len(held), threshold, sets) if rows else []
            yield _batch([(a, b, *[None] * 7) for a, b in links])
            held = rows[-WINDOW:]
        yield _batch([(None, None, at, 0, *r) for r in held])

    return run


def _edge_links(kind, threshold: float):
    def run(pdf):
        pdf = pdf.sort_values(["side", "pass", "dims", "key", "rep"])
        new = int((pdf["side"] == 0).sum())
        links = _window_links(pdf["rep"].to_numpy(), pdf["pass"].to_numpy(), pdf["dims"].to_numpy(), pdf["vec"].tolist(), kind, new, threshold, _Sets())
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def _forest(near: np.ndarray):
    """Links of a symmetric boolean matrix that join its components."""
    unseen = np.ones(len(near), bool)
    for root in range(len(near)):
        todo = [root] if unseen[root] else []
        unseen[root] = False
        while todo:
            v = todo.pop()
            new = np.flatnonzero(near[v] & unseen)
            unseen[new] = False
            todo += new.tolist()
            yield from ((v, w) for w in new.tolist())


def _run_links(kind, threshold: float):
    """Links that join sets, of runs of (pass, dims, prefix, i, j): the rows of block i with those of block j."""

    def links(run):
        x = unit(matrix([r[2] for r in run], run[0][0][1], kind))
        second = np.array([r[1] for r in run], bool)
        if run[0][0][3] == run[0][0][4]:
            near = x @ x.T >= threshold
        else:
            near = np.zeros((len(x), len(x)), bool)
            near[np.ix_(~second, second)] = x[~second] @ x[second].T >= threshold
            near |= near.T
        return [(run[v][3], run[w][3]) for v, w in _forest(near)]

    def run(batches):
        held, sets = [], _Sets()

        def done(rows):
            got = [l for l in links(rows) if sets.join(*l)] if rows else []
            return pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())], ["a", "b"])

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("pass", "dims", "prefix", "i", "j")))
            for key, second, vec, rep in zip(keys, *(batch.column(c).to_pylist() for c in ("second", "vec", "rep"))):
                if held and held[0][0] != key:
                    yield done(held)
                    held = []
                held.append((key, second, vec, rep))
        yield done(held)

    return run


def _hub_links(hubs: dict[int, tuple[np.ndarray, np.ndarray]], kind, threshold: float):
    """Links of the vectors with the hubs (ids, unit vectors) of their length, one a vector; hubs that share a vector are joined as well."""

    def run(batches):
        sets = _Sets()
        for batch in batches:
            dims, reps = batch.column("dims").to_numpy(), batch.column("rep").to_numpy()
            out = []
            for d, (ids, h) in hubs.items():
                own = np.flatnonzero(dims == d)
                if not len(own):
                    continue
                near = unit(matrix(batch.column("vec").take(pa.array(own)), d, kind)) @ h.T >= threshold
                near |= reps[own][:, None] == ids[None, :]
                hit = np.flatnonzero(near.any(axis=1))
                first = near[hit].argmax(axis=1)
                both = np.zeros((len(ids), len(ids)), bool)
                np.logical_or.at(both, first, near[hit])
                out += [*zip(ids[first].tolist(), reps[own][hit].tolist()), *((int(ids[a]), int(ids[b])) for a, b in np.argwhere(both))]
            out = [l for l in out if l[0] != l[1] and sets.join(*l)]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in out], pa.int64()), pa.array([g[1] for g in out], pa.int64())], ["a", "b"])

    return run


def _count_rows(kind, threshold: float):
    """Runs of (component, i, j): links of the rows of block i with those of block j."""

    def count(run):
        dims, first, x = run[0][2], np.array([r[3] for r in run]), unit(matrix([r[6] for r in run], run[0][2], kind))
        rep, n = np.array([r[4] for r in run]), np.array([r[5] for r in run])
        if run[0][1][0] == run[0][1][1]:
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            return zip(rep.tolist(), (near @ n).tolist())
        a, b = first == 0, first == 1
        near = x[a] @ x[b].T >= threshold
        return [*zip(rep[a].tolist(), (near @ n[b]).tolist()), *zip(rep[b].tolist(), (n[a] @ near).tolist())]

    def run(batches):
        held: list = []

        def done(rows):
            got = [x for x in count(rows) if x[1]] if rows else []
            return pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())], ["rep", "links"])

        for batch in batches:
            for c, i, j, d, s, r, n, v in zip(*(batch.column(x).to_pylist() for x in ("component", "i", "j", "dims", "second", "rep", "n", "vec"))):
                if held and (held[0][0], held[0][1], held[0][2]) != (c, (i, j), d):
                    yield done(held)
                    held = []
                held.append((c, (i, j), d, s, r, n, v))
        yield done(held)

    return run


def near_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """One row per row of ``table``: (vec_id, n_links, component_id, kept)."""
    spark = table.sparkSession
    single = "array<float" in dict(table.dtypes)[vec_col]
    kind = np.float32 if single else np.float64
    v = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    path = shared_table_path(spark, "vectors")
    v.where(usable("vec") & F.col("vec_id").isNotNull()).mapInArrow(
        _class_rows(single), "vec_id long, dims int, h1 long, h2 long, vec binary").write.parquet(path)
    real = spark.read.parquet(path)
    key = ["dims", "h1", "h2"]
    classes = cut_lineage(real.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    heads = real.join(classes, key).where("vec_id = rep").dropDuplicates(["rep", *key]).select("rep", "n", "dims", "vec")
    n = classes.count()
    n_passes = passes(n, threshold)
    keyed = heads.select("dims", "rep", "vec").mapInArrow(_key_rows(n_passes, kind), "pass int, dims int, key long, rep long, vec binary")
    order = ["pass", "dims", "key", "rep"]
    found = cut_lineage(keyed.repartitionByRange(max(1, n * n_passes // ROWS), *order).sortWithinPartitions(*order).mapInArrow(
        _window_rows(kind, threshold), _OUT))
    across = found.where("edge is not null").groupBy("edge").applyInPandas(_edge_links(kind, threshold), "a long, b long")
    # runs of a common prefix that outgrow the window
    place = ["pass", "dims", "prefix"]
    keyed = keyed.withColumn("prefix", F.shiftright("key", BITS - prefix_bits(n))).drop("key")
    long = keyed.groupBy(*place).count().where(F.col("count") > WINDOW + 1).select(*place, F.ceil(F.col("count") / RUN_BLOCK).cast("int").alias("blocks"))
    part = keyed.join(cut_lineage(long), place).withColumn("own", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    part = part.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *place, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("second"), "rep", "vec")
    block = [*place, "i", "j"]
    whole = part.repartition(*block).sortWithinPartitions(*block).mapInArrow(_run_links(kind, threshold), "a long, b long")
    links = cut_lineage(found.where("a is not null").select("a", "b").union(across).union(whole))
    # vectors that hold a crowd together
    most = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").count().where("count > 2").orderBy(F.desc("count"), "rep").limit(HUBS)
    hubs: dict = {}
    for r in heads.join(F.broadcast(most), "rep").select("rep", "dims", "vec").collect():  # HUBS rows at most
        hubs.setdefault(r["dims"], []).append((r["rep"], bytes(r["vec"])))
    hubs = {d: (np.array([i for i, _ in x]), unit(matrix([v for _, v in x], d, kind))) for d, x in hubs.items()}
    centred = heads.select("dims", "rep", "vec").mapInArrow(_hub_links(hubs, kind, threshold), "a long, b long")
    comp = components(links.union(centred))
    # exact number of links within the components
    member = heads.join(comp, F.col("rep") == F.col("node")).drop("node")
    sizes = member.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    member = member.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "dims", (F.col("own") > F.col("other")).cast("int").alias("second"), "rep", "n", "vec")
    run = ["component", "i", "j", "dims"]
    counts = member.repartition(*run).sortWithinPartitions(*run).mapInArrow(_count_rows(kind, threshold), "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))
    per_class = classes.join(counts, "rep", "left").join(comp, F.col("rep") == F.col("node"), "left").select(
        *key, (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = real.select("vec_id", *key).join(per_class, key).select("vec_id", "n_links", "component_id")
    rest = v.where(~usable("vec") | F.col("vec_id").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    zero = v.where(usable("vec") & F.col("vec_id").isNotNull() & ~F.exists("vec", lambda x: x != 0)).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(rest).unionByName(zero).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
