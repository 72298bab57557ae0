"""Substring dedup with prefix-partitioned suffix trees over words.

Suffixes start at words; two of them meet in an internal node of depth ``window`` or more exactly
when their first ``window`` words are equal.  Three steps:

1. *Anchors.*  Of every window the smallest hash of its runs of ``ANCHOR`` words is its anchor, so
   equal windows have equal anchors.  Suffixes whose anchor occurs once in the corpus lie below no
   deep node and are left out; this is exact and leaves about the repeated part of the corpus.
2. *Prefix groups.*  The other suffixes are dealt by ranges of their path (hash of the first four
   words, then of the first ``window`` words).  The bounds are sampled from the paths, so a frequent
   beginning is split at a longer prefix, a rare one shares its group with others and every group is
   of about one partition's size.  Equal windows of one slice of documents are combined before
   the shuffle, so a passage that a third of the corpus holds arrives as one row a slice.
3. *Subtrees.*  Sorted by path, the leaves below a node are neighbours.  The leaves of each node of
   depth ``window`` but the first (smallest id, then start) are repeats; chained over consecutive
   starts they are the maximal repeats.

Paths are 96-bit hashes (32 bits of the prefix, 64 of the window).

Rows with a null id take no part and are returned unchanged; null texts have no words; rows that
repeat an id stand for the same document, whose windows don't repeat themselves.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import cut_lineage

from . import bytewords as bw
from .carry import rest

ANCHOR = 6
PREFIX = 4


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over every ``width`` consecutive values."""
    have, size = x, 1
    while size * 2 <= width:
        have, size = op(have[:len(have) - size], have[size:]), size * 2
    rest = width - size
    return op(have[:len(have) - rest], have[rest:]) if rest else have


def _windows(w: bw.Words, window: int):
    """(valid, anchor hash of each window, hashes of the runs) over the words of all texts."""
    runs = bw.run_hashes(w.hashes, ANCHOR)
    width = window - ANCHOR + 1
    if len(runs) < width:
        return None
    anchor = _slide(runs, width, np.minimum)
    text = np.repeat(np.arange(len(w.first) - 1), w.counts())
    valid = text[:len(anchor)] == text[window - 1:]
    return valid, anchor, runs, text


def _anchor_rows(window: int):
    def run(batches):
        for batch in batches:
            for part in bw.slices(batch, "text"):
                w = bw.split(*bw.string_buffers(part.column("text")))
                got = _windows(w, window)
                if got is None:
                    continue
                valid, anchor, runs, text = got
                width = window - ANCHOR + 1
                # a run is an anchor if it is the smallest of some valid window that covers it
                low = np.where(valid, anchor, np.uint64(0))
                padded = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
                at = np.flatnonzero(_slide(padded, width, np.maximum) == runs)
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(runs[at].view(np.int64)), pa.array(ids[text[at]].astype(np.int64))], ["anchor", "doc_id"])

    return run


def _suffix_rows(window: int):
    """Suffixes with a repeated anchor: (path, tail, doc_id, leaf).

    A leaf's 96-bit path (prefix, then window) is ``path`` and the upper half of ``tail``, its start the
    lower half.  Other rows are runs of windows already known to be repeats: number and start in ``tail``.
    """
    low = np.uint64(0xFFFFFFFF)
    half = np.uint64(32)

    def run(batches):
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("anchors")))
            for part in bw.slices(batch, "text"):
                w = bw.split(*bw.string_buffers(part.column("text")))
                got = _windows(w, window)
                if got is None:
                    continue
                valid, anchor, _, text = got
                ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
                lists = part.column("anchors")
                known = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                owner = np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(lists)))
                # anchor and text together are looked up among the texts' repeated anchors
                key = np.sort(known ^ bw.mix(owner.astype(np.uint64) + np.uint64(1)))
                mine = anchor ^ bw.mix(text[:len(anchor)].astype(np.uint64) + np.uint64(1))
                place = np.minimum(np.searchsorted(key, mine), len(key) - 1)
                s = np.flatnonzero(valid & (key[place] == mine))
                if not len(s):
                    continue
                path = bw.run_hashes(w.hashes, window)[s]
                tag = bw.run_hashes(w.hashes, PREFIX)[s] >> half
                doc, start = ids[text[s]], s - w.first[text[s]]
                order = np.lexsort((start, doc, tag, path))
                path, tag, doc, start = path[order], tag[order], doc[order], start[order]
                same = np.zeros(len(s), bool)
                same[1:] = (path[1:] == path[:-1]) & (tag[1:] == tag[:-1])
                lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(s))))
                again = same & ((doc != doc[lead]) | (start != start[lead]))
                leaf = ~same
                d, a, n = _chains(doc[again], start[again])
                path, tag = path[leaf], tag[leaf]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([(tag << half | path >> half).view(np.int64), bw.mix(d.view(np.uint64) + a.view(np.uint64)).view(np.int64)])),
                     pa.array(np.concatenate([((path & low) << half | start[leaf].view(np.uint64)).view(np.int64), n << 32 | a])),
                     pa.array(np.concatenate([doc[leaf], d])), pa.array(np.arange(len(path) + len(d)) < len(path))],
                    ["path", "tail", "doc_id", "leaf"])

    return run


def _chains(doc: np.ndarray, start: np.ndarray):
    """Runs of consecutive starts: (doc, first start, number of starts)."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(doc)]]).astype(int) - 1
    return doc[at], start[at], (start[last] - start[at] + 1) if len(at) else start[:0]


def _subtree_rows(batches):
    """Leaves in path order: those of each deep node after its first are repeats."""
    held = None  # path and first leaf of the node that the last batch ended in
    for batch in batches:
        path, tail, doc, is_leaf = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("path", "tail", "doc_id", "leaf"))
        leaf, run = np.flatnonzero(is_leaf), ~is_leaf
        d, a, m = doc[run], tail[run] & 0xFFFFFFFF, tail[run] >> 32
        if len(leaf):
            t, p, ld, ls = path[leaf], tail[leaf] >> 32, doc[leaf], tail[leaf] & 0xFFFFFFFF
            same = np.zeros(len(leaf), bool)
            same[1:] = (t[1:] == t[:-1]) & (p[1:] == p[:-1])
            lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(leaf))))
            first_doc, first_start = ld[lead], ls[lead]
            if held is not None and held[:2] == (t[0], p[0]):
                run = lead == 0
                first_doc, first_start = np.where(run, held[2], first_doc), np.where(run, held[3], first_start)
            again = (ld != first_doc) | (ls != first_start)
            held = (t[-1], p[-1], first_doc[-1], first_start[-1])
            d2, a2, m2 = _chains(ld[again], ls[again])
            d, a, m = np.concatenate([d, d2]), np.concatenate([a, a2]), np.concatenate([m, m2])
        yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(a), pa.array(m)], ["doc_id", "start", "n"])


def _repeats(d: DataFrame, window: int) -> DataFrame:
    anchors = d.where("doc_id is not null and text is not null").mapInArrow(_anchor_rows(window), "anchor long, doc_id long")
    # written out, so that both sides of the join are exchanges of their own and AQE can split a hot anchor
    repeated = cut_lineage(anchors.groupBy("anchor").count().where("count > 1").select("anchor"))
    per_doc = anchors.join(repeated, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    # a left join, so that remove_repeats' own join reuses the exchange of the texts
    leaves = d.join(per_doc, "doc_id", "left").select("doc_id", "text", "anchors", "rest").mapInArrow(
        _suffix_rows(window), "path long, tail long, doc_id long, leaf boolean")
    tail = F.shiftright("tail", 32)
    groups = leaves.repartitionByRange("path", tail).sortWithinPartitions("path", tail, "doc_id", "tail")
    return groups.select("path", "tail", "doc_id", "leaf").mapInArrow(_subtree_rows, "doc_id long, start long, n long")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), rest(docs, text_col))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """(doc_id, start, n): ``n`` windows from word ``start`` on whose words also start earlier in the corpus."""
    return _repeats(_texts(docs.select(id_col, text_col), id_col, text_col), window)


def _cover(n_words: int, runs, window: int) -> np.ndarray:
    """Which words lie in a repeated window."""
    step = np.zeros(n_words + 1, np.int64)
    if runs is not None and len(runs):
        starts = np.minimum([r["start"] for r in runs], n_words)
        ends = np.minimum([r["start"] + r["n"] + window - 1 for r in runs], n_words)
        np.add.at(step, starts, 1)
        np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def _cut_rows(window: int, keep_text: bool):
    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for part in bw.slices(batch, "text"):
                data, offsets = bw.string_buffers(part.column("text"))
                w = bw.split(data, offsets)
                raw = data.tobytes()
                runs = part.column("runs").to_pylist()
                for i in range(part.num_rows):
                    a, b = w.first[i], w.first[i + 1]
                    gone = _cover(b - a, runs[i], window)
                    s, e = w.starts[a:b], w.ends[a:b]
                    words = [raw[x:y] for x, y in zip(s[~gone].tolist(), e[~gone].tolist())]
                    if not gone.any():
                        text = raw[offsets[i]:offsets[i + 1]]
                    else:
                        text = _without(raw, int(offsets[i]), int(offsets[i + 1]), s, gone) if keep_text else b""
                    out[0].append(int(b - a))
                    out[1].append(int(gone.sum()))
                    out[2].append(hashlib.sha256(b" ".join(words)).hexdigest())
                    out[3].append(text if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c not in ("text", "runs")), pa.array(out[0], pa.int64()),
                 pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.binary()).cast(pa.string())],
                [*(c for c in batch.schema.names if c not in ("text", "runs")), "n_words", "n_removed", "kept_sha256", "kept_text"])

    return run


def _without(raw: bytes, begin: int, end: int, starts: np.ndarray, gone: np.ndarray) -> bytes:
    """The text without its removed words and the white space after each."""
    bounds = [*starts.tolist(), end]
    pieces = [raw[begin:bounds[0]]] + [raw[bounds[i]:bounds[i + 1]] for i in np.flatnonzero(~gone)]
    return b"".join(pieces)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, keep_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: (rest, doc_id, n_words, n_removed, kept_sha256, kept_text).

    ``rest`` has the other columns; ``kept_sha256`` is of the kept words joined by one space;
    ``kept_text`` (null unless ``keep_text``) keeps the white space between kept words and is empty for a null text.
    """
    d = _texts(docs, id_col, text_col)
    runs = _repeats(d, window).groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    schema = T.StructType([d.schema["rest"], d.schema["doc_id"]]).add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string").add("kept_text", "string")
    return d.join(runs, "doc_id", "left").select("rest", "doc_id", "text", "runs").mapInArrow(_cut_rows(window, keep_text), schema)
