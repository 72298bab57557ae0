"""Near-duplicate documents by fast similarity sketching of word shingles.

A document's set of shingle hashes is sketched into ``bands * rows`` bins: in round i every element
is thrown into one random bin and the smallest hash in a bin that is still empty stays there; rounds
go on until no bin is empty, and from round ``bins`` on round i fills bin ``i - bins`` alone, so
that every bin fills after twice as many rounds at most, whatever the size of the set.  Equal bins of
two sketches estimate the Jaccard similarity with concentration.  Bins are cut into bands; documents
with an equal band share a bucket.

Equal sets are one class from the start (128-bit set hash and size).  Within buckets, candidate pairs
are verified on the full sets.  First by stars: the member that meets the most others (an original rather
than one of its copies) is compared with all members, one row each.  Where not all members of a
bucket are linked to it, the members of such buckets of that centre are compared exactly: they are cut into
blocks, and a pair of blocks is a product of 0/1 matrices over their shared shingles.  So no bucket is
cut or sampled, and no pairs are written but those that join components.

Documents without words have the empty set and link with nothing, as do rows with a null id; these
come back with a null component and are kept.  Rows that repeat an id share its component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage, shared_table_path

from . import bytewords as bw
from .graph import components

BLOCK = 256  # sets, and
ELEMENTS = 200_000  # shingles, of a block about
WIDTH = 4096
_U = np.uint64


def shingle_sets(w: bw.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements, first): distinct hashes of the k-word shingles of each text, sorted; the whole sequence if it has fewer words."""
    runs = bw.run_hashes(w.hashes, k)
    sets, first = [], np.zeros(len(w.first), np.int64)
    bounds = w.first.tolist()
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if b - a >= k:
            x = np.sort(runs[a:b - k + 1])
            x = x[np.concatenate([[True], x[1:] != x[:-1]])]
        elif b > a:
            x = bw.run_hashes(w.hashes[a:b], int(b - a))
        else:
            x = runs[:0]
        sets.append(x)
        first[i + 1] = first[i] + len(x)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), first


def sketches(elements: np.ndarray, first: np.ndarray, bins: int) -> np.ndarray:
    """One row of ``bins`` hashes per set; rows of empty sets are all ones."""
    n = len(first) - 1
    empty = _U(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * bins, empty, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(first))
    x = elements
    for i in range(2 * bins):
        if not len(x):
            break
        h = bw.mix(x + _U((i + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
        place = owner * bins + ((h % _U(bins)).astype(np.int64) if i < bins else i - bins)
        free = np.flatnonzero(out[place] == empty)
        np.minimum.at(out, place[free], np.minimum(h[free], empty - _U(1)))
        full = (out.reshape(n, bins) != empty).all(axis=1)
        rest = ~full[owner]
        x, owner = x[rest], owner[rest]
    return out.reshape(n, bins)


def _signature_rows(k: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            for part in bw.slices(batch, "text"):
                w = bw.split(*bw.string_buffers(part.column("text")), lower=True)
                elements, first = shingle_sets(w, k)
                size = np.diff(first)
                sums = np.concatenate([[0], np.cumsum(bw.mix(elements), dtype=np.uint64)]).astype(np.uint64)
                more = np.concatenate([[0], np.cumsum(bw.mix(elements ^ _U(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)]).astype(np.uint64)
                s = sketches(elements, first, bands * rows).reshape(-1, bands, rows)
                band = np.zeros(s.shape[:2], np.uint64)
                for j in range(rows):
                    band = bw.mix(band + s[:, :, j] + _U(j + 1))
                band = bw.mix(band + np.arange(bands, dtype=np.uint64)[None, :])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size), pa.array((sums[first[1:]] - sums[first[:-1]]).view(np.int64)),
                     pa.array((more[first[1:]] - more[first[:-1]]).view(np.int64)),
                     pa.ListArray.from_arrays(np.arange(0, len(size) * bands + 1, bands, dtype=np.int32), band.view(np.int64).ravel())],
                    ["doc_id", "n_shingles", "h1", "h2", "bands"])

    return run


def _set_rows(k: int):
    def run(batches):
        for batch in batches:
            for part in bw.slices(batch, "text"):
                w = bw.split(*bw.string_buffers(part.column("text")), lower=True)
                elements, first = shingle_sets(w, k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(first.astype(np.int32), elements.view(np.int64))], ["doc_id", "elements"])

    return run


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, bands) per row."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(_signature_rows(k, bands, rows), "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) with den * |A ∩ B| >= num * |A ∪ B|."""
    x = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("ea")), "a")
    x = x.join(sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("eb")), "b")
    both = F.size(F.array_intersect("ea", "eb"))
    return x.select("a", "b", both.alias("i"), (F.size("ea") + F.size("eb")).alias("n")).where(
        F.expr(f"{den} * i >= {num} * (n - i)")).select("a", "b")


def _block_links(rows: list, num: int, den: int):
    """Links between sets of different components, of block i with block j; only those that join more of them."""
    ids, comps, second = ([r[k] for r in rows] for k in (0, 1, 2))
    sets = [np.frombuffer(r[3], np.int64) if isinstance(r[3], bytes) else np.asarray(r[3], np.int64) for r in rows]
    size = np.array([len(x) for x in sets])
    value, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = np.cumsum(count > 1) - 1  # elements of one set alone can't be shared
    owner = np.repeat(np.arange(len(sets)), size)
    use = count[column] > 1
    owner, column = owner[use], often[column[use]]
    side = np.array(second)
    a, b = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if side.any() else (np.arange(len(sets)),) * 2
    both = np.zeros((len(a), len(b)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, WIDTH):
        lo, hi = np.searchsorted(column, [at, at + WIDTH])
        x = np.zeros((len(sets), WIDTH), np.float32)
        x[owner[lo:hi], column[lo:hi] - at] = 1
        both += x[a] @ x[b].T
    linked = den * both >= num * (size[a][:, None] + size[b][None, :] - both)
    up: dict = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(linked)):
        i, j = int(a[i]), int(b[j])
        u, v = find(comps[i]), find(comps[j])
        if u != v:
            up[max(u, v)] = min(u, v)
            out.append((ids[i], ids[j]))
    return out


def _run_links(num: int, den: int):
    def run(batches):
        held: list = []
        key = None

        def done():
            links = _block_links(held, num, den) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            lists = batch.column("elements")
            columns = [batch.column(c).to_pylist() for c in ("centre", "i", "j", "doc_id", "component", "second")]
            for k, (c, i, j, d, o, s) in enumerate(zip(*columns)):
                if key != (c, i, j):
                    if held:
                        yield done()
                    held, key = [], (c, i, j)
                held.append((d, o, s, lists[k].values.to_numpy().tobytes()))
        yield done()

    return run


def _crowd_links(crowd: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links within crowds (centre, doc_id, n_shingles, component), compared exactly block by block."""
    size = crowd.groupBy("centre").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / ELEMENTS)).cast("int").alias("blocks"))
    x = crowd.join(size, "centre").withColumn("own", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "centre", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("second"), "doc_id", "component")
    run = ["centre", "i", "j"]
    return x.join(sets, "doc_id").repartition(*run).sortWithinPartitions(*run).mapInArrow(_run_links(num, den), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100,
                    bands: int = 24, rows: int = 4) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id, kept).

    Linked are documents with den * intersection >= num * union; ``component_id`` is the smallest id
    reachable by links.  With the defaults a pair at 0.8 shares no band in 3 cases of a million.
    """
    sig = _written(signatures(docs, id_col, text_col, k, bands, rows), "sketches")
    real = sig.where("doc_id is not null and n_shingles > 0")
    reps = real.groupBy("n_shingles", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    heads = real.join(reps.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi").dropDuplicates(["doc_id"])
    spread = heads.select("doc_id", "n_shingles", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    open_ = _written(spread.join(shared, "bucket"), "buckets")
    # members that meet many others make the first centres: an original is closer to its copies than they to each other
    weight = open_.groupBy("doc_id").agg(F.sum("c").alias("weight"))
    open_ = cut_lineage(open_.join(weight, "doc_id").select("doc_id", "n_shingles", "weight", "bucket"))
    wanted = open_.select("doc_id").distinct()
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = _written(d.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]).mapInArrow(_set_rows(k), "doc_id long, elements array<long>"), "shingles")
    # stars
    centre = open_.groupBy("bucket").agg(F.max(F.struct("weight", F.col("doc_id").alias("a"), F.col("n_shingles").alias("n_a"))).alias("s")).select(
        "bucket", "s.a", "s.n_a")
    star = cut_lineage(open_.join(centre, "bucket").where("doc_id <> a").select("bucket", "a", "n_a", "doc_id", "n_shingles"))
    close = F.expr(f"{den} * least(n_a, n_shingles) >= {num} * greatest(n_a, n_shingles)")
    pairs = star.where(close).select("a", F.col("doc_id").alias("b")).distinct()
    links = cut_lineage(verified(pairs, sets, num, den))
    # buckets whose members aren't all linked to the centre: their members are compared with one another
    seen = star.join(links.select("a", F.col("b").alias("doc_id"), F.lit(1).alias("linked")), ["a", "doc_id"], "left")
    open_ends = seen.groupBy("bucket").agg(F.count("*").alias("n"), F.count("linked").alias("m")).where("n > 1 and m < n").select("bucket")
    crowd = seen.join(open_ends, "bucket").select(
        F.col("a").alias("centre"), "doc_id", "n_shingles", F.when(F.col("linked") == 1, F.col("a")).otherwise(F.col("doc_id")).alias("component"))
    comp = components(links.union(_crowd_links(cut_lineage(crowd.distinct()), sets, num, den)))
    rep_of = reps.join(comp, F.col("rep") == F.col("node"), "left").select(
        F.col("n_shingles").alias("n_"), F.col("h1").alias("h1_"), F.col("h2").alias("h2_"), F.coalesce("component", "rep").alias("c"))
    out = sig.drop("bands").join(rep_of, (F.col("n_shingles") == F.col("n_")) & (F.col("h1") == F.col("h1_")) & (F.col("h2") == F.col("h2_")), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
