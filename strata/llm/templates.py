"""Line dedup by a fixed-depth tree of log templates.

A line is its words; words with a digit are variable fields, unless most words of the line are (then all of
them count as they stand).  The tree has two levels under its root: the number of words, then the first
``DEPTH`` words.  In a leaf

* lines that are equal up to variable fields share a template;
* the other lines of ``LONG`` words or more fall into groups by their frequent words, level by level: at
  level j a word is constant at its place if ``min_docs * 4**j`` of the leaf's lines have it there, all
  other places are variable fields, and lines with the same constant words in ``CONSTANT`` of their places
  share a template.  A line takes the lowest level at which ``min_docs`` lines agree with it, so a
  leaf holds any number of templates, and ordinary lines that crowd it only raise the level.

A template that ``min_docs`` rows hold is common.  Copies of a document share all its lines, which doesn't
make them templates (copies are other operators' work), so only texts that stand for themselves count: texts
with at least half of their words in lines that aren't common, each told by what these lines say, and texts
of few common words (``FEW``), each told by all it says.  A template recurs if ``min_docs`` different ones of
them hold it.  What copies share counts once that way, and the lines of a header or footer don't depend on
one another.  Lines of recurring templates are dropped, wherever they stand.

Only lines in leaves of ``min_docs`` lines or more are looked at word by word.  Which leaves those are is
broadcast as a bitmap of fixed size; more leaves than it can tell apart cost time, not results.

Null texts stay null, empty ones empty; rows whose lines all go stay with an empty text.  Rows are told apart
by id and text, so repeated rows are treated alike and a null id is an id like others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import cut_lineage, shared_table_path

from . import bytewords as bw
from .carry import rest

DEPTH = 3
CONSTANT = 0.6
LEVELS = 16
LONG = 6  # words of a line that is looked at word by word
FEW = 40  # common words of a text that may consist of common lines alone
BITS = 1 << 23
_U = np.uint64
_FIELD = _U(0x5BD1E9955BD1E995)
_DIGIT = np.array([48 <= c <= 57 for c in range(256)])


class _Lines:
    """Lines with words of a slice of texts: text, number in the text, words, template and leaf hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        w = bw.split(data, offsets)
        text = np.repeat(np.arange(len(w.first) - 1), w.counts())
        feeds = np.concatenate([[0], np.cumsum(data == 10)])
        number = feeds[w.starts] - feeds[offsets[text]]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (number[1:] != number[:-1])
        self.at = np.flatnonzero(new)  # first word of each line
        self.text, self.number = text[self.at], number[self.at]
        self.words = np.diff(np.append(self.at, len(text)))
        end = self.at + self.words
        digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
        variable = digits[w.ends] > digits[w.starts]
        fields = np.concatenate([[0], np.cumsum(variable)])
        variable &= np.repeat(2 * (fields[end] - fields[self.at]) <= self.words, self.words)
        self.tokens = np.where(variable, _FIELD, w.hashes)
        place = (np.arange(len(text)) - np.repeat(self.at, self.words)).astype(np.uint64) * _U(0x9E3779B97F4A7C15)

        def spans(tokens, to):
            total = np.concatenate([[_U(0)], np.cumsum(bw.mix(tokens + place), dtype=np.uint64)])
            return total[to] - total[self.at]

        size = self.words.astype(np.uint64)
        self.template = bw.mix(spans(self.tokens, end) + size)
        self.exact = bw.mix(spans(w.hashes, end) + size)
        self.leaf = bw.mix(spans(self.tokens, np.minimum(end, self.at + DEPTH)) + size * _U(0xC2B2AE3D27D4EB4F))
        order = np.lexsort((self.number, self.template, self.text))  # the first line of each template in a text
        self.first = np.zeros(len(self.at), bool)
        if len(order):
            t, x = self.template[order], self.text[order]
            self.first[order[np.concatenate([[True], (t[1:] != t[:-1]) | (x[1:] != x[:-1])])]] = True
        self.head = np.ones(len(self.at), bool)
        self.head[1:] = self.text[1:] != self.text[:-1]


_LINE = "key long, line int, words int, template long, leaf long, exact long, first boolean, head boolean"


def _line_rows(batches):
    for batch in batches:
        for part in bw.slices(batch, "text"):
            x = _Lines(*bw.string_buffers(part.column("text")))
            key = part.column("key").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[x.text]), pa.array(x.number.astype(np.int32)), pa.array(x.words.astype(np.int32)),
                 *(pa.array(h.view(np.int64)) for h in (x.template, x.leaf, x.exact)), pa.array(x.first), pa.array(x.head)],
                [c.split()[0] for c in _LINE.split(", ")])


def _open_rows(bitmap: np.ndarray):
    """Word by word, the lines whose leaf is marked in the bitmap."""

    def run(batches):
        for batch in batches:
            for part in bw.slices(batch, "text"):
                x = _Lines(*bw.string_buffers(part.column("text")))
                slot = (x.leaf % _U(BITS)).astype(np.int64)
                own = np.flatnonzero((x.words >= LONG) & (bitmap[slot >> 3] >> (slot & 7) & 1).astype(bool))
                key = part.column("key").to_numpy()
                n = x.words[own]
                first = np.concatenate([[0], np.cumsum(n)])
                index = np.arange(first[-1]) - np.repeat(first[:-1], n) + np.repeat(x.at[own], n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[x.text[own]]), pa.array(x.number[own].astype(np.int32)),
                     *(pa.array(h[own].view(np.int64)) for h in (x.template, x.leaf)),
                     pa.ListArray.from_arrays(first.astype(np.int32), x.tokens[index].view(np.int64))],
                    ["key", "line", "template", "leaf", "tokens"])

    return run


def _bitmap(leaves: DataFrame) -> np.ndarray:
    """BITS bits, set where a leaf's hash falls: BITS / 8 bytes whatever the number of leaves."""
    rows = leaves.groupBy(F.expr(f"bitmap_bucket_number(pmod(leaf, {BITS}) + 1)").alias("b")).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position(pmod(leaf, {BITS}) + 1))").alias("m"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in rows.collect():
        at = (r["b"] - 1) * len(r["m"])
        out[at:at + len(r["m"])] = np.frombuffer(bytes(r["m"]), np.uint8)
    return out


def _groups(own: DataFrame, min_docs: int) -> DataFrame:
    """(key, line, template): the group of each line of ``own`` (key, line, leaf, tokens) that has one."""
    pairs = own.select("key", "line", "leaf", F.size("tokens").alias("words"), F.posexplode("tokens").alias("place", "word"))
    often = pairs.groupBy("leaf", "place", "word").agg(F.count("*").alias("c")).where(F.col("c") >= min_docs)
    line = pairs.join(often, ["leaf", "place", "word"]).groupBy("key", "line", "leaf", "words").agg(
        F.array_sort(F.collect_set(F.struct("place", "word", "c"))).alias("at"))

    def constant(j):
        return F.filter("at", lambda x: x["c"] >= F.lit(min_docs) * F.pow(F.lit(4.0), j))

    levels = F.filter(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda j: F.size(constant(j)) >= CONSTANT * F.col("words"))
    level = line.withColumn("level", F.explode(levels)).select(
        "key", "line", "level", F.xxhash64("leaf", "words", F.transform(constant(F.col("level")), lambda x: F.struct(x["place"], x["word"]))).alias("template"))
    level = cut_lineage(level)
    enough = level.groupBy("template", "level").count().where(F.col("count") >= min_docs).select("template", "level")
    return level.join(enough, ["template", "level"]).groupBy("key", "line").agg(F.min_by("template", "level").alias("template"))


def template_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10) -> DataFrame:
    """(key, line): lines of recurring templates; key = xxhash64(id, text), lines counted from 0."""
    spark = docs.sparkSession
    d = docs.where(F.col(text_col).isNotNull()).select(F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    path = shared_table_path(spark, "lines")
    d.mapInArrow(_line_rows, _LINE).write.parquet(path)
    lines = spark.read.parquet(path)
    known = cut_lineage(lines.where("first").groupBy("template").count().where(F.col("count") >= min_docs).select("template"))
    # the other lines, leaf by leaf
    other = lines.where(F.col("words") >= LONG).select("leaf", "template").join(known, "template", "left_anti")
    crowded = cut_lineage(other.groupBy("leaf").count().where(F.col("count") >= min_docs).select("leaf"))
    bitmap = spark.sparkContext.broadcast(_bitmap(crowded))
    path = shared_table_path(spark, "leaf_lines")
    d.mapInArrow(lambda b: _open_rows(bitmap.value)(b), "key long, line int, template long, leaf long, tokens array<long>").write.parquet(path)
    own = spark.read.parquet(path).join(known, "template", "left_anti").join(crowded, "leaf")
    common = lines.join(known, "template").select("key", "line", "template").unionByName(_groups(own, min_docs))
    common = cut_lineage(common.distinct())  # of repeated rows once
    # what each text says beside its common lines; a key's rows are alike, so their sums are a multiple of one row's
    said = lines.join(common.select("key", "line", F.lit(1).alias("c")), ["key", "line"], "left")
    alone, word, line = F.isnull("c"), F.col("words").cast("long"), F.col("exact").cast("decimal(20,0)")
    text = said.groupBy("key").agg(
        F.sum(F.col("head").cast("long")).alias("rows"), F.sum(F.when(alone, word).otherwise(0)).alias("own"),
        F.sum(F.when(alone, 0).otherwise(word)).alias("shared"), F.sum(F.when(alone, line)).alias("rest"), F.sum(line).alias("all"))
    mark = F.when(F.col("own") >= F.col("shared"), F.xxhash64(F.lit(0), F.col("rest") / F.col("rows"))).when(
        F.col("shared") <= FEW * F.col("rows"), F.xxhash64(F.lit(1), F.col("all") / F.col("rows")))
    votes = text.select("key", mark.alias("vote")).where("vote is not null")
    recurring = common.join(votes, "key").select("template", "vote").distinct().groupBy("template").count().where(F.col("count") >= min_docs)
    return common.join(recurring.select("template"), "template").select("key", "line")


def _drop_rows(batches):
    for batch in batches:
        lists = batch.column("gone")
        hit = np.flatnonzero(np.asarray(pc.is_valid(lists)))
        text, n = batch.column("text"), np.zeros(batch.num_rows, np.int64)
        if len(hit):
            texts = text.take(pa.array(hit)).to_pylist()
            kept = []
            for i, t, gone in zip(hit.tolist(), texts, lists.take(pa.array(hit)).to_pylist()):
                gone = set(gone)
                kept.append("\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone))
                n[i] = len(gone)
            mask = np.zeros(batch.num_rows, bool)
            mask[hit] = True
            text = pc.replace_with_mask(text, pa.array(mask), pa.array(kept, text.type))
        yield pa.RecordBatch.from_arrays([*(text if c == "text" else batch.column(c) for c in batch.schema.names if c != "gone"), pa.array(n)],
                                         [*(c for c in batch.schema.names if c != "gone"), "n_dropped"])


def drop_template_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10) -> DataFrame:
    """(rest, text, n_dropped) of every row of ``docs``: its other columns, and the text without lines of recurring templates."""
    gone = template_lines(docs, id_col, text_col, min_docs).groupBy("key").agg(F.collect_set("line").alias("gone"))
    d = docs.select(rest(docs, text_col), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("key"))
    out = d.join(gone, "key", "left").select("rest", "text", "gone")
    return out.mapInArrow(_drop_rows, T.StructType([d.schema["rest"], d.schema["text"], T.StructField("n_dropped", T.LongType())]))
