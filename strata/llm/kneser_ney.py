"""Quality by perplexity under an interpolated modified Kneser-Ney model of character n-grams.

Symbols are code points of any script, without case; digits count as 0, white space and control
characters as a space.  An n-gram is a string of ``ORDER`` symbols, so its context and its suffix are
substrings and counts are joined as they are.

Texts are dealt by id into slices of about ``SLICE_BYTES``.  Where a slice's texts meet the trusted
ids, its distinct n-grams are written with their counts in trusted texts.  The model comes from these
counts: continuation counts of the lower orders, three discounts per order from counts of counts, and
joins with the counts of contexts and suffixes.  The distinct n-grams of all slices are joined with the
model, dealt by n-gram, the log probabilities go back to the slices that hold them, and there each
text adds up its own.  A row is shuffled per distinct n-gram of a slice, never one per character, and
neither model nor ids pass through the driver.

A document is kept if its perplexity lies between two quantiles of those of held-out trusted texts in
its language (of all languages where it has none): gibberish lies above, endless repetition below.

Null and empty texts have a null perplexity and are not kept.  Rows are told apart by id and text; texts
that share an id meet in one slice, those without an id are spread and never trusted.  Without trusted
texts every perplexity is 1 and all texts are kept.
"""

from __future__ import annotations

import math
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_table_path

from . import bytewords as bw

ORDER = 5
SLICE_BYTES = 48 << 20
PART = 1 << 19  # symbols worked on at once; ORDER - 1 at least
QUANTILES = (0.002, 0.995)
BEGIN = 0x10FFFF  # stands before a text; no character
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_deleted(spark: SparkSession):
    """Shuffle files of the jobs inside are deleted when each job ends."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as compressed Parquet and read back: cuts the lineage in less space than checkpoints."""
    path = shared_table_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@lru_cache(1)
def _symbols() -> np.ndarray:
    """Symbol of each code point."""
    out = np.arange(0x110000, dtype=np.uint32)
    for cp in range(0x20000):
        ch = chr(cp)
        low = ch.lower()
        if ch.isspace() or cp < 32:
            out[cp] = 32
        elif ch.isdecimal():
            out[cp] = 48
        elif len(low) == 1:
            out[cp] = ord(low)
    out[BEGIN] = 0xFFFD
    return out


def _parts(texts: pa.ChunkedArray):
    """(row, symbols, predicted) of about PART symbols each: a symbol's row, and whether it is a text's own.

    Every piece of a text starts with the ORDER - 1 symbols before it, which are predicted elsewhere.
    """
    rows, pieces, firsts, room = [], [], [], 0
    back = ORDER - 1
    for i, raw in enumerate(texts):
        text = raw.as_buffer().to_pybytes().decode("utf-8", "replace")
        for at in range(0, len(text), PART):
            rows.append(i)
            firsts.append(at == 0)
            pieces.append((text[at - back:at] if at else " " * back) + text[at:at + PART])
            room += len(pieces[-1])
            if room >= PART:
                yield _arrays(rows, pieces, firsts)
                rows, pieces, firsts, room = [], [], [], 0
    if pieces:
        yield _arrays(rows, pieces, firsts)


def _arrays(rows, pieces, firsts):
    size = np.array([len(p) for p in pieces])
    sym = _symbols()[np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)]
    lead = (np.cumsum(size) - size)[:, None] + np.arange(ORDER - 1)
    sym[lead[np.array(firsts)]] = BEGIN
    predicted = np.ones(len(sym), bool)
    predicted[lead] = False
    return np.repeat(rows, size), sym, predicted


def _hashes(columns) -> np.ndarray:
    """64-bit hash of ORDER columns of symbols; tells n-grams apart within a slice."""
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = bw.mix(h * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64) + np.uint64(1))
    return h


def _gram_hashes(sym: np.ndarray) -> np.ndarray:
    """Hash of the n-gram that ends at each symbol from place ORDER - 1 on."""
    last = len(sym) - ORDER + 1
    return _hashes([sym[k:k + last] for k in range(ORDER)])


def _binary(column: pa.ChunkedArray) -> pa.ChunkedArray:
    return column.cast(pa.binary())


def _slice_grams(key, texts: pa.Table, ids: pa.Table) -> pa.Table:
    """Distinct n-grams of a slice with their counts in trusted texts."""
    have, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = np.zeros((0, ORDER), np.uint32)
    learn = pc.is_in(texts["id"], value_set=ids["id"].combine_chunks()).to_numpy() if texts.num_rows else None
    for row, sym, predicted in _parts(_binary(texts["text"])):
        at = np.flatnonzero(predicted)  # the first ORDER - 1 symbols of a piece never are
        got, first, back = np.unique(_gram_hashes(sym)[at - ORDER + 1], return_index=True, return_inverse=True)
        c = np.bincount(back, weights=learn[row[at]], minlength=len(got)).astype(np.int64)
        new = sym[at[first][:, None] + np.arange(1 - ORDER, 1)]
        have, first, back = np.unique(np.concatenate([have, got]), return_index=True, return_inverse=True)
        grams = np.concatenate([grams, new])[first]
        count = np.bincount(back, weights=np.concatenate([count, c]), minlength=len(have)).astype(np.int64)
    joined = grams.astype("<u4").tobytes().decode("utf-32-le")
    out = pa.table({"slice": pa.array(np.full(len(have), key[0].as_py(), np.int64)),
                    "gram": pa.array([joined[i:i + ORDER] for i in range(0, len(joined), ORDER)], pa.string()), "c": pa.array(count)})
    return out.sort_by("gram")


def _slice_sums(key, texts: pa.Table, values: pa.Table) -> pa.Table:
    """Sum of log probabilities and number of symbols of each text of a slice."""
    flat = np.frombuffer("".join(values["gram"].to_pylist()).encode("utf-32-le"), np.uint32).reshape(-1, ORDER)
    known, log_p = pa.array(_hashes(flat.T)), values["log_p"].to_numpy()
    sums, n = np.zeros(texts.num_rows), np.zeros(texts.num_rows, np.int64)
    for row, sym, predicted in _parts(_binary(texts["text"])):
        at = np.flatnonzero(predicted)
        place = pc.index_in(pa.array(_gram_hashes(sym)[at - ORDER + 1]), value_set=known)
        if place.null_count:
            raise ValueError("texts changed between two reads")
        sums += np.bincount(row[at], weights=log_p[place.to_numpy()], minlength=len(sums))
        n += np.bincount(row[at], minlength=len(n))
    return pa.table({"key": texts["key"], "log_p": pa.array(sums), "n": pa.array(n)})


def _dealt(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(slice, key, id, text) of texts that aren't empty; key = xxhash64(id, text)."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text <> ''").withColumn("key", F.xxhash64("id", "text"))
    by = F.when(F.col("id").isNull(), F.col("key")).otherwise(F.xxhash64("id"))
    return d.select(F.pmod(by, F.lit(n)).alias("slice"), "key", "id", "text")


def slices(docs: DataFrame, text_col: str = "text") -> int:
    """Number of slices of about SLICE_BYTES."""
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("b")).first()["b"] or 0
    return max(1, -(-size // SLICE_BYTES))


def grams(docs: DataFrame, trusted: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(slice, gram, c): distinct n-grams of each of ``n`` slices, c times in texts whose id is in ``trusted`` (first column); written."""
    texts = _dealt(docs, n, id_col, text_col)
    ids = trusted.select(F.col(trusted.columns[0]).cast(texts.schema["id"].dataType).alias("id")).where("id is not null").distinct()
    ids = ids.select(F.pmod(F.xxhash64("id"), F.lit(n)).alias("slice"), "id")
    out = texts.groupBy("slice").cogroup(ids.groupBy("slice")).applyInArrow(_slice_grams, "slice long, gram string, c long")
    return _written(out, "grams")


def _discounts(level: DataFrame) -> list[float]:
    r = level.agg(*(F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in range(1, 5))).first()
    n = [float(r[f"n{i}"] or 0) for i in range(1, 5)]
    if not n[0] or not n[1]:
        return [0.5, 0.5, 0.5]
    y = n[0] / (n[0] + 2 * n[1])
    raw = [i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] else 0.5 for i in range(3)]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]


def _join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Joined by one plan at every size."""
    return left.join(right.hint("merge"), on, how)


def train(counts: DataFrame) -> DataFrame:
    """(order, kind, key, value) from (gram, c): log probabilities of n-grams (kind 0) and log weights of contexts (kind 1).

    The symbols seen and one unseen share the probability of order 0.
    """
    levels = {ORDER: _written(counts.where("c > 0").groupBy("gram").agg(F.sum("c").alias("c")), "counts")}
    for n in range(ORDER - 1, 0, -1):
        levels[n] = _written(levels[n + 1].groupBy(F.substring("gram", 2, n).alias("gram")).agg(F.count("*").alias("c")), "counts")
    even = 1.0 / (levels[1].count() + 1)
    out, lower = None, None
    for n in range(1, ORDER + 1):
        d = _discounts(levels[n])
        g = levels[n].withColumn("ctx", F.substring("gram", 1, n - 1))
        d_of = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        ctx = g.groupBy("ctx").agg(F.sum("c").alias("total"), (F.sum(d_of) / F.sum("c")).alias("weight"))
        g = _join(g, ctx, "ctx").withColumn("own", (F.col("c") - d_of) / F.col("total"))
        if n == 1:
            g = g.withColumn("p_low", F.lit(even))
        else:
            g = _join(g.withColumn("suffix", F.substring("gram", 2, n - 1)), lower, "suffix")
        g = _written(g.select("gram", "ctx", (F.col("own") + F.col("weight") * F.col("p_low")).alias("p"), "weight"), "model")
        lower = g.select(F.col("gram").alias("suffix"), F.col("p").alias("p_low"))
        rows = g.select(F.lit(n).alias("order"), F.lit(0).alias("kind"), F.col("gram").alias("key"), F.log("p").alias("value")).union(
            g.groupBy("ctx").agg(F.first("weight").alias("w")).select(F.lit(n), F.lit(1), "ctx", F.log("w")))
        out = rows if out is None else out.union(rows)
    return out.union(counts.sparkSession.range(1).select(F.lit(0), F.lit(0), F.lit(""), F.lit(math.log(even))))


def log_probabilities(seen: DataFrame, model: DataFrame) -> DataFrame:
    """(gram, log_p) of the distinct n-grams of ``seen``: that of each last symbol after the others."""
    def part(n: int, kind: int, key: str, value: str) -> DataFrame:
        return model.where((F.col("order") == n) & (F.col("kind") == kind)).select(F.col("key").alias(key), F.col("value").alias(value))

    rest = sum(r["value"] for r in model.where("(order = 0 and kind = 0) or (order = 1 and kind = 1)").collect())  # two rows at most
    asked = {ORDER: seen.select("gram").distinct()}
    for n in range(ORDER - 1, 0, -1):
        asked[n] = asked[n + 1].select(F.substring("gram", 2, n).alias("gram")).distinct()
    out = _join(asked[1], part(1, 0, "gram", "own"), "gram", "left").select("gram", F.coalesce("own", F.lit(float(rest))).alias("log_p"))
    for n in range(2, ORDER + 1):
        g = _join(asked[n], part(n, 0, "gram", "own"), "gram", "left")
        g = g.withColumns({"ctx": F.substring("gram", 1, n - 1), "suffix": F.substring("gram", 2, n - 1)})
        g = _join(g, part(n, 1, "ctx", "weight"), "ctx", "left")  # null for a context never seen
        g = _join(g, out.select(F.col("gram").alias("suffix"), F.col("log_p").alias("low")), "suffix")
        out = g.select("gram", F.coalesce("own", F.coalesce("weight", F.lit(0.0)) + F.col("low")).alias("log_p"))
    return out


def perplexity(docs: DataFrame, seen: DataFrame, model: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, n, perplexity) per distinct (id, text), key = xxhash64(id, text); ``seen`` are the n-grams of the ``n`` slices of ``docs``."""
    logs = _written(log_probabilities(seen, model), "logs")
    values = _join(seen.select("slice", "gram"), logs, "gram").select("slice", "gram", "log_p")
    texts = _dealt(docs, n, id_col, text_col).select("slice", "key", "text")
    sums = texts.groupBy("slice").cogroup(values.groupBy("slice")).applyInArrow(_slice_sums, "key long, log_p double, n long")
    none = docs.where(F.coalesce(F.col(text_col), F.lit("")) == "").select(F.xxhash64(id_col, text_col), F.lit(0.0), F.lit(0).cast("long"))
    out = sums.union(none).groupBy("key").agg(F.max("log_p").alias("log_p"), F.max("n").alias("n"))  # repeated rows have equal sums
    return out.select("key", "n", F.when(F.col("n") > 0, F.exp(-F.col("log_p") / F.col("n"))).alias("perplexity"))


def held_out(id_col: str):
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(5)) == 0


def quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantiles=QUANTILES) -> DataFrame:
    """(doc_id, lang, n_symbols, perplexity, low, high, kept) per row of ``docs``; ``trusted`` has the ids of trusted rows.

    Four fifths of the trusted rows train the model, the others set the quantiles.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    good = trusted.select(F.col(id_col).cast(d.schema["doc_id"].dataType).alias("doc_id")).where("doc_id is not null").distinct()
    n = slices(d)
    with _shuffles_deleted(docs.sparkSession):
        seen = grams(d, good.where(~held_out("doc_id")), n)
        sums = _written(perplexity(d, seen, train(seen), n), "perplexity")
    rows = d.select("doc_id", "lang", F.xxhash64("doc_id", "text").alias("key")).join(sums, "key")
    test = rows.join(good.where(held_out("doc_id")), "doc_id", "left_semi").where("perplexity is not null")
    low, high = (F.percentile_approx("perplexity", q, 100_000).alias(c) for q, c in zip(quantiles, ("low", "high")))
    every = test.agg(low, high).select(F.col("low").alias("low_"), F.col("high").alias("high_"))
    limit = test.groupBy("lang").agg(low, high)
    out = rows.join(limit.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l")), "left").crossJoin(F.broadcast(every))  # one row
    out = out.withColumns({c: F.coalesce(c, f"{c}_") for c in ("low", "high")})
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    return out.select("doc_id", "lang", F.col("n").alias("n_symbols"), "perplexity", "low", "high", kept.alias("kept"))
