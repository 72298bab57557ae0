"""Batch keyword (BM25) and vector search.

The reference runs a hosted search service; here a batch of queries is answered from an inverted index
whose postings are kept in blocks of documents of about the same length, each with what bounds the
weights in it.  A search reads the blocks of its terms once; a block whose bound can't reach the k-th
best score of any query is skipped as a whole.  Vector search is exact cosine, block of queries by part
of the corpus.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import shared_table_path
from ..sources.io import materialize
from .text import tokens
from .windows import top_k_per_salted

K1, B = 1.2, 0.75

# documents of a part of the index (what one task scores) and, of each length class of a part, blocks
PART = 2048
BLOCKS = 1
# characters of a part: more parts if the documents are long
PART_CHARS = 1 << 24
# length classes an octave: documents of a block differ in length by a factor of 2 ** (1 / CLASSES) at most
CLASSES = 2
# scores are snapped to 1e-9; blocks are skipped only if their bound lies this far below the threshold
_MARGIN = 1e-6


def build_index(corpus: DataFrame, key: str, col: str) -> DataFrame:
    """Block postings of a corpus, written to the shared folder: one row per (part, block, term).

    ``keys``, ``tfs`` and ``dls`` are the block's documents that hold the term, how often, and their
    lengths; ``tf_max`` and ``dl_min`` bound the weight of any of them whatever the corpus' mean length
    is.  ``tokens`` and ``heads`` (documents that begin with the term) add up to the corpus' tokens and
    documents.  Texts are tokenised once and dealt by block to as many tasks as there are parts (so a
    task's share doesn't grow with the corpus), and counting and writing take no further shuffle: a
    block's tokens are counted as arrays of numbers, with no row a token.  ``key`` is unique; documents
    without a token hold no postings.
    """
    n, chars = corpus.agg(F.count(F.lit(1)), F.sum(F.length(col))).first()
    parts = max(1, -(-n // PART), -(-(chars or 0) // PART_CHARS))
    toks = corpus.select(key, F.filter(tokens(col), lambda t: F.length(t) > 0).alias("_t")).where(F.size("_t") > 0)
    dl = F.size("_t")
    toks = toks.select(
        F.pmod(F.xxhash64(key), F.lit(parts)).alias("part"),
        (F.floor(F.log2(dl) * CLASSES) * BLOCKS + F.pmod(F.xxhash64(F.lit("block"), key), F.lit(BLOCKS))).cast("int").alias("block"),
        F.col(key).alias("_k"), "_t").repartition(parts, "part", "block")
    rows = toks.groupBy("part", "block").applyInArrow(
        _postings, "part bigint, block int, term string, tf_max bigint, dl_min int, tokens bigint, heads bigint, "
        f"keys array<{corpus.schema[key].dataType.simpleString()}>, tfs array<bigint>, dls array<int>")
    return materialize(rows, shared_table_path(corpus.sparkSession, "block_index"))


def _postings(rows: pa.Table) -> pa.Table:
    """One row per term of a block's documents; rows of one key and length count as one document."""
    texts = rows.column("_t").combine_chunks()
    size = pc.list_value_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = texts.flatten().dictionary_encode()
    term, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    keys = rows.column("_k").combine_chunks()
    own = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, at, doc = np.unique(own * (size.max() + 1) + size, return_index=True, return_inverse=True)
    n = len(at)
    pair, tf = np.unique(term * n + np.repeat(doc, size), return_counts=True)
    of, held = pair // n, at[pair % n]
    first = np.searchsorted(of, np.arange(len(words) + 1))
    dls, starts = size[held].astype(np.int32), np.cumsum(size) - size
    heads = np.bincount(np.unique(term[starts] * n + doc) // n, minlength=len(words))
    lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), v) for v in (keys.take(pa.array(held)), pa.array(tf, pa.int64()), pa.array(dls))]
    lo = first[:-1]
    return pa.Table.from_arrays(
        [pa.array(np.full(len(words), rows.column(c)[0].as_py()), t) for c, t in (("part", pa.int64()), ("block", pa.int32()))]
        + [words, pa.array(np.maximum.reduceat(tf, lo), pa.int64()), pa.array(np.minimum.reduceat(dls, lo)), pa.array(np.add.reduceat(tf, lo), pa.int64()),
           pa.array(heads, pa.int64()), *lists],
        ["part", "block", "term", "tf_max", "dl_min", "tokens", "heads", "keys", "tfs", "dls"])


def _weight(tf, dl, avgdl):
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avgdl))


def _score_part(qkey: str, key: str, query_type, key_type, avgdl: float, k: int):
    """Top k documents of one part for one block of queries, best blocks first."""

    def flat(column) -> tuple[np.ndarray, np.ndarray]:
        """The rows' lists one after the other, and each element's row."""
        column = column.combine_chunks()
        n = pc.list_value_length(column).to_numpy()
        return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(n)), n)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        blocks, block = np.unique(rows.column("block").to_numpy(), return_inverse=True)
        first = np.searchsorted(block, np.arange(len(blocks) + 1))  # rows of each block
        idf = rows.column("idf").to_numpy()
        asked, ask_row = flat(rows.column("queries"))
        queries, asked = np.unique(asked, return_inverse=True)
        keys, key_row = flat(rows.column("keys"))
        weight = _weight(flat(rows.column("tfs"))[0], flat(rows.column("dls"))[0], avgdl)
        bound = idf * _weight(rows.column("tf_max").to_numpy(), rows.column("dl_min").to_numpy(), avgdl)
        most = np.zeros((len(blocks), len(queries)))  # what a document of the block scores at most
        np.add.at(most, (block[ask_row], asked), bound[ask_row])
        theta = np.zeros(len(queries))
        best: list[list[tuple]] = [[] for _ in queries]
        for i in np.argsort(-most.max(axis=1), kind="stable"):
            live = (most[i] > 0) & (most[i] >= theta - _MARGIN)
            if not live.any():
                continue
            lo, hi = first[i], first[i + 1]
            p = slice(*np.searchsorted(key_row, (lo, hi)))
            docs, doc = np.unique(keys[p], return_inverse=True)
            held = np.zeros((hi - lo, len(docs)))
            held[key_row[p] - lo, doc] = weight[p]
            q = slice(*np.searchsorted(ask_row, (lo, hi)))
            wanted = np.zeros((len(queries), hi - lo))
            wanted[asked[q], ask_row[q] - lo] = idf[ask_row[q]]
            score = np.floor(wanted[live] @ held * 1e9 + 0.5) / 1e9
            for n, line in zip(np.flatnonzero(live), score):
                hits = np.flatnonzero((line > 0) & (line >= theta[n]))
                if len(hits):
                    best[n] = sorted(best[n] + [(-line[j], docs[j]) for j in hits])[:k]
                    if len(best[n]) == k:
                        theta[n] = -best[n][-1][0]
        found = [(queries[n], d, -s) for n, own in enumerate(best) for s, d in own]
        return pa.Table.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((query_type, key_type, pa.float64()))], [qkey, key, "score"])

    return run


def bm25_search(corpus: DataFrame, key: str, col: str, queries: DataFrame, qkey: str, qcol: str,
                k: int = 8, where=None, index: DataFrame | None = None) -> DataFrame:
    """TXT-11 exact BM25 top-k documents per query (k1=1.2, b=0.75; distinct query terms;
    ties by document key).  ``where`` filters the corpus first (attribute filters); ``index`` is
    what ``build_index`` made of the filtered corpus, if it is kept from an earlier search.

    Queries are dealt to blocks of ``QUERY_BLOCK``.  Their terms are written before they meet the index, so
    that their size is known: few are broadcast and the rows of other terms stay where they are read, many
    are joined by a shuffle.  The index rows of a block's terms are read once,
    with the queries that hold the term and its idf beside them, and grouped by part: a task sums the
    terms' weights for all documents of a part and all queries of a block.  It takes the part's blocks
    in order of their bounds (the sum over a query's terms of idf times the largest weight in the
    block) and keeps each query's k best so far, so a block whose bound lies below a query's k-th score
    isn't scored for it, and a block that no query needs isn't touched.  What is left out scores less
    than k documents of the same part, so the result is exact.  (Query, document) pairs are never
    shuffled but for the k best of a part.
    """
    if where is not None:
        corpus = corpus.where(where)
    if index is None:
        index = build_index(corpus, key, col)
    n_tokens, n_docs = index.agg(F.sum("tokens"), F.sum("heads")).first()
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    q = queries.select(F.col(qkey).alias("_q"), F.explode(F.array_distinct(tokens(qcol))).alias("term")).where(F.length("term") > 0)
    q = q.groupBy(F.pmod(F.xxhash64("_q"), F.lit(blocks)).alias("_block"), "term").agg(F.sort_array(F.collect_set("_q")).alias("queries"))
    q = materialize(q, shared_table_path(corpus.sparkSession, "asked"))
    df = index.join(q.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum(F.size("keys")).alias("df"))
    q = q.join(df, "term").select("_block", "term", "queries", F.log(1 + (F.lit(n_docs or 0) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    q = materialize(q, shared_table_path(corpus.sparkSession, "asked_idf"))
    kq, kk = queries.schema[qkey].dataType, corpus.schema[key].dataType
    score = _score_part(qkey, key, to_arrow_type(kq), to_arrow_type(kk), (n_tokens or 0) / max(n_docs or 0, 1), k)
    found = index.drop("tokens", "heads").join(q, "term").groupBy("part", "_block").applyInArrow(
        score, f"{qkey} {kq.simpleString()}, {key} {kk.simpleString()}, score double")
    return top_k_per_salted(found, qkey, [F.desc("score"), F.asc(key)], k, [key])


# rows of a block of queries: what one task holds beside its Arrow batch of documents
QUERY_BLOCK = 1024
VECTOR_PART = 1 << 15


def _has_direction(vec: str) -> Column:
    """A finite square sum above 0: false for null and zero vectors and null or non-finite components."""
    squares = F.aggregate(vec, F.lit(0.0), lambda a, x: a + x * x)
    return (squares > 0) & (squares < float("inf")) & ~F.isnan(squares)


def vector_search(corpus: DataFrame, key: str, vec: str, queries: DataFrame, qkey: str, qvec: str,
                  k: int = 5) -> DataFrame:
    """TXT-12 exact cosine top-k per query.

    Documents are dealt to parts and queries to blocks by a hash; every part meets every block
    once, as one product of two matrices of unit vectors, and hands on its k best documents per
    query.  No (query, document) rows are written: what is shuffled are the vectors, once per
    block of queries or part of documents, and k rows per query and part.  A part holds about
    ``VECTOR_PART`` documents.  Vectors that are null or zero or hold null or non-finite
    components have no cosine: as documents they are never found, as queries they find nothing.
    """
    parts = max(1, -(-corpus.count() // VECTOR_PART))
    q = queries.select(F.col(qkey).alias("_q"), F.col(qvec).cast("array<double>").alias("_v")).where(_has_direction("_v"))
    blocks = q.agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("b")).select(F.greatest("b", F.lit(1)).alias("b"))
    q = q.join(F.broadcast(blocks)).withColumn("_block", F.pmod(F.xxhash64("_q"), "b")).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select("_part", "_block", "_q", "_v")
    d = corpus.select(F.col(key).alias("_k"), F.col(vec).cast("array<double>").alias("_v")).where(_has_direction("_v")).withColumn(
        "_part", F.pmod(F.xxhash64("_k"), F.lit(parts)).cast("int"))
    d = d.join(F.broadcast(blocks)).withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("b") - 1))).select("_part", "_block", "_k", "_v")
    kq, kk = queries.schema[qkey].dataType.simpleString(), corpus.schema[key].dataType.simpleString()

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values("_k")
            a, b = (np.vstack(x["_v"]) / np.sqrt((np.vstack(x["_v"]) ** 2).sum(axis=1))[:, None] for x in (left, right))
            score = np.floor((a @ b.T) * 1e12 + 0.5) / 1e12  # snapped, so that ties go by key
            for i, one in zip(left["_q"], score):
                top = np.argsort(-one, kind="stable")[:k]
                out += [(i, right["_k"].iloc[j], one[j]) for j in top]
        return pd.DataFrame(out, columns=[qkey, key, "score"])

    found = q.groupBy("_part", "_block").cogroup(d.groupBy("_part", "_block")).applyInPandas(best, f"{qkey} {kq}, {key} {kk}, score double")
    return top_k_per_salted(found, qkey, [F.desc("score"), F.asc(key)], k, [key])


def centroids(df: DataFrame, group: str, vec: str, dim: int) -> DataFrame:
    """Mean vector per group (element-wise), as a grouped aggregate over exploded positions."""
    x = df.select(group, F.posexplode(vec).alias("i", "v"))
    g = x.groupBy(group, "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    return g.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("_s")) \
        .select(group, F.transform("_s", lambda s: s["m"]).alias("centroid"))
