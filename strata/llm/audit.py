"""Interaction audit of a set of filters: what every order of applying them removes, and at which step.

One pass over the texts gives each document its failure mask.  Masks are counted by part before
anything else happens, so the audit itself works on at most 2^filters rows a part, however many
documents there are.  On these, removal steps of all orders are one min-plus product: the mask matrix
(0 where a mask fails a filter, else infinity) times the positions of the filters in every order (the
inverse permutations), combined by minimum.  The product drives weighted scatter counts of removed
documents, and redundancies where a filter fails what an earlier step has removed.

Null texts are empty, null parts the empty string.  A null id is smaller than no other id and no other
id is smaller than it, so such rows never fail the copy filter, and they have no labels; rows that repeat an id and its text
don't fail it by one another.  A document with several label rows has a label if one of them says so.
No documents give no rows.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytewords as bw

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT = 80  # per cent of the words
MAX_CAPITALS = 10  # per cent of the code points
SIGNS = b"#$%&*|"

_SPACE = re.compile(rb"[\x20\x09-\x0D]")  # what bytes.split() splits at
_CAPITALS = bytes(range(65, 91))
_FOLLOWING = bytes(range(0x80, 0xC0))
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)


def _word_counts(raw: bytes) -> tuple[int, int]:
    """Words and distinct words of a text; slices cut between words bound the memory by its vocabulary."""
    n, seen, at = 0, set(), 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + bw.SLICE)
        end = cut.start() if cut else len(raw)
        words = raw[at:end].split()
        n += len(words)
        seen.update(words)
        at = end
    return n, len(seen)


def text_mask(raw: bytes) -> int:
    """Bits of the filters A to D that a UTF-8 text fails."""
    n, distinct = _word_counts(raw)
    points = len(raw.translate(None, _FOLLOWING))
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return ((n < MIN_WORDS) | (100 * distinct < MIN_DISTINCT * n) << 1 | (100 * capitals > MAX_CAPITALS * points) << 2
            | (len(raw.translate(None, SIGNS)) < len(raw)) << 3)


def _mask_rows(batches):
    for batch in batches:
        for part in bw.slices(batch, "text"):
            data, off = bw.string_buffers(part.column("text"))
            texts = [data[a:b].tobytes() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("part"), pa.array([text_mask(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest()[:16] for t in texts], pa.binary())],
                ["doc_id", "part", "mask", "body"])


def failure_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                  good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and failure mask, and how many of them carry each label."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                    F.col(text_col).alias("text"))
    rows = d.mapInArrow(_mask_rows, f"doc_id {dict(d.dtypes)['doc_id']}, part string, mask int, body binary")
    # rows of one id and text count together, which leaves one row an id for the labels and for the smallest id
    rows = rows.groupBy("doc_id", "part", "mask", "body").agg(F.count("*").alias("n"))
    flags = labels.groupBy(F.col(id_col).alias("doc_id")).agg(
        F.max((F.col(good) == 1).cast("int")).alias("good"), F.max((F.col(toxic) == 1).cast("int")).alias("toxic"))
    rows = rows.join(flags, "doc_id", "left").fillna(0, ["good", "toxic"])
    # of equal texts all but the rows of the smallest id fail E; a body has as many cells as parts and labels at most
    cell = rows.groupBy("body", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"),
        F.sum(F.when(F.isnull("doc_id"), F.col("n")).otherwise(0)).alias("n_null"))
    cell = cell.withColumn("least", F.min("first").over(Window.partitionBy("body")))
    own = F.col("n_null") + F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    split = F.explode(F.array(F.struct(F.col("mask"), own.alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - own).alias("n"))))
    cell = cell.select("part", "good", "toxic", split.alias("s")).select("part", "s.mask", "s.n", "good", "toxic").where("n > 0")
    return cell.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                                            F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Min-plus product (masks x orders): the step, from 0, that removes a mask's documents, infinity if none does."""
    fails = (masks[:, None] >> np.arange(positions.shape[1])) & 1
    return (np.where(fails, 0.0, np.inf)[:, None, :] + positions[None]).min(axis=2)


def order_counts(masks, weights, filters: str = FILTERS) -> list[tuple]:
    """(order, step, *counts) of every order of the filters; ``weights``: (masks x 3) documents, good and toxic ones."""
    k = len(filters)
    orders = np.array(list(permutations(range(k))))
    positions = np.argsort(orders, axis=1)
    steps = removal_steps(masks, positions)
    total = np.zeros((len(orders), k, weights.shape[1]), np.int64)  # removed by order and step
    at, order = np.nonzero(np.isfinite(steps))
    np.add.at(total, (order, steps[at, order].astype(int)), weights[at])
    late = steps[:, :, None] < positions[None]  # removed before the filter's turn
    fails = ((masks[:, None] >> np.arange(k)) & 1).astype(bool)
    redundant = (weights[:, 0, None, None] * (late & fails[:, None, :])).sum(axis=0)  # by order and filter
    unique = (weights[:, 0, None] * (masks[:, None] == 1 << np.arange(k))).sum(axis=0)
    removed = total[:, :, 0]
    by_filter = np.take_along_axis(removed, positions, axis=1).sum(axis=0)
    kept = weights[:, 0].sum() - np.cumsum(removed, axis=1)
    return [("".join(filters[f] for f in o), s + 1, kept[i, s], removed[i, s], redundant[i, f], unique[f], total[i, s, 1], total[i, s, 2], by_filter[f])
            for i, o in enumerate(orders.tolist()) for s, f in enumerate(o)]


def _scatter(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = order_counts(pdf["mask"].to_numpy(), pdf[["n", "good", "toxic"]].to_numpy(np.int64))
    out = pd.DataFrame(rows, columns=["filter_order", "step", *_COUNTS])
    out.insert(0, "part", pdf["part"].iloc[0])
    return out


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                 good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """One row per part, order of the five filters and step: documents kept, removed, redundant and lost so far."""
    cells = failure_cells(docs, labels, id_col, text_col, part_col, good, toxic)
    return cells.groupBy("part").applyInPandas(_scatter, _SCHEMA)
