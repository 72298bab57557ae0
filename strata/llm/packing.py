"""Hierarchical multi-length packing of tokenised documents.

A document is cut into whole long windows and one rest.  The rest goes to the smallest tier
(context size) that holds it.  Rests of the longest tier open long windows, whose gaps are filled
with the largest fitting rests of shorter tiers.  What is left is packed tier by tier into windows
of the tier's size that come out exactly full, and then into long windows again.  Sequences of a tier
are dealt to step groups of about ``STEP`` tokens so that the groups hold about as many real tokens.

Documents are dealt by a hash to buckets of about ``BUCKET`` documents and each bucket is packed by
itself: a task holds one bucket's lengths, and losing it costs that bucket.  Cuts depend on the
document alone, so tokens are read once and never shuffled.

Null texts are empty and have the end id alone; a null id stays null; rows that repeat an id are
documents of their own.
"""

from __future__ import annotations

import os
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw

BUCKET = 2500
STEP = 1 << 17
TIERS = (256, 512, 1024, 2048)
CACHE = 600_000
SIGNS = ".,;:!?"
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row int"


class ChunkTokenizer:
    """Ids of texts through caches of chunks between plain white space, which the tokenizer never joins.

    A chunk of letters and closing signs is the ids of the letters and those of the signs.  Runs of
    letters, by far the most, are encoded many at a time: each ends with the one token that ends a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.cache, self.runs = {"": b""}, {}

    def _encode_each(self, chunks: list[str]):
        for got in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False):
            yield np.array(got.ids, "<u4").tobytes()

    def _encode_runs(self, runs: list[str]) -> None:
        lines = [runs[at:at + 100] for at in range(0, len(runs), 100)]
        for line, got in zip(lines, self.tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False)):
            ids = np.array(got.ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(line) and (len(ids) == ends[-1]):
                flat, at = ids.tobytes(), 0
                for run, end in zip(line, (4 * ends).tolist()):
                    self.runs[run] = flat[at:end]
                    at = end
            else:
                self.runs.update(zip(line, self._encode_each(line)))

    def _add(self, chunks: list[str]) -> None:
        cores = [c.rstrip(SIGNS) for c in chunks]
        whole, runs, signed, other = [], [], [], []
        for c, core, low in zip(chunks, cores, "\n".join(cores).lower().split("\n")):  # no chunk holds a line feed
            # letters that neither case nor composition changes into anything but letters
            if core.isalpha() and (core.isascii() or (low.isalpha() and unicodedata.is_normalized("NFC", core))):
                run = low if core.isascii() else core
                if len(core) == len(c):
                    whole.append(c)
                    runs.append(run)
                else:
                    signed.append((c, run, c[len(core):]))
            else:
                other.append(c)
        self._encode_runs(list({*runs, *(x[1] for x in signed)}.difference(self.runs)))
        other = list({*other, *(x[2] for x in signed)}.difference(self.cache))
        self.cache.update(zip(other, self._encode_each(other)))
        self.cache.update(zip(whole, map(self.runs.__getitem__, runs)))
        self.cache.update([(c, self.runs[run] + self.cache[signs]) for c, run, signs in signed])

    def encode(self, texts: pa.Array) -> tuple[bytes, np.ndarray]:
        """Little-endian unsigned 32-bit ids of the texts one after the other, and where each text's ids end (in ids)."""
        if len(self.cache) > CACHE:
            self.cache = {"": b""}
        if len(self.runs) > CACHE:
            self.runs = {}
        texts = texts.fill_null("")
        for space in "\n\t\r":
            texts = pc.replace_substring(texts, space, " ")
        lists = pc.split_pattern(texts, " ")
        chunks = lists.flatten().dictionary_encode()
        distinct = chunks.dictionary.to_pylist()
        new = [c for c in distinct if c not in self.cache]
        for at in range(0, len(new), 10_000):
            self._add(new[at:at + 10_000])
        raw = [self.cache[c] for c in distinct]
        table = np.frombuffer(b"".join(raw), "<u4")
        size = np.array([len(r) for r in raw], np.int64) // 4
        start = np.cumsum(size) - size
        own = chunks.indices.to_numpy()
        ends = np.cumsum(size[own])
        ids = table[np.repeat(start[own] - (ends - size[own]), size[own]) + np.arange(ends[-1] if len(ends) else 0)]
        return ids.tobytes(), np.append(0, ends)[np.cumsum(pc.list_value_length(lists).to_numpy())]


_tokenizers: dict[str, ChunkTokenizer] = {}


def _piece_rows(path: str, window: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        tok = _tokenizers.get(path) or _tokenizers.setdefault(path, ChunkTokenizer(path))
        row = 0
        for batch in batches:
            for part in bw.slices(batch, "text", 1 << 22):
                out = []
                ids = part.column("doc_id").to_pylist()
                flat, ends = tok.encode(part.column("text"))
                at = 0
                for doc, to in zip(ids, (4 * ends).tolist()):
                    got = flat[at:to] + end
                    at = to
                    n = len(got) // 4
                    out += [(doc, s, min(window, n - s), zlib.crc32(got[4 * s:4 * min(s + window, n)]), n, row) for s in range(0, n, window)]
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 5 + [pa.int32()])],
                                                 ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"])

    return run


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, row): every document's ids cut into windows and a rest."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(_piece_rows(tokenizer, window, end_id), _PIECE)


class _Pool:
    """Pieces by length, with the largest one up to a size."""

    def __init__(self, lengths, items):
        self.by, self.bits = {}, 0
        for i in items:
            self.put(lengths[i], i)

    def put(self, n, i):
        self.by.setdefault(n, []).append(i)
        self.bits |= 1 << n

    def take(self, most: int):
        under = self.bits & ((1 << (most + 1)) - 1)
        if not under:
            return None
        n = under.bit_length() - 1
        got = self.by[n].pop()
        if not self.by[n]:
            self.bits ^= 1 << n
        return n, got


def _fill(pool: _Pool, size: int, opener=None):
    """Largest-first pieces for one window: (pieces, tokens)."""
    used, got = (0, []) if opener is None else (opener[0], [opener])
    while used < size and (p := pool.take(size - used)):
        got.append(p)
        used += p[0]
    return got, used


def pack(lengths: list[int], tiers=TIERS) -> list[tuple[int, list[int]]]:
    """Sequences (tier, pieces in order) for pieces of the given lengths."""
    long = tiers[-1]
    out = [(long, [i]) for i, n in enumerate(lengths) if n == long]
    rests = [i for i, n in enumerate(lengths) if n < long]
    half = tiers[-2] if len(tiers) > 1 else 0
    top = sorted((i for i in rests if lengths[i] > half), key=lambda i: (-lengths[i], i))
    pool = _Pool(lengths, sorted((i for i in rests if lengths[i] <= half), reverse=True))
    for i in top:
        got, _ = _fill(pool, long, (lengths[i], i))
        out.append((long, [p[1] for p in got]))
    back: list[tuple[int, int]] = []
    for tier in tiers[-2::-1]:
        # windows of this tier opened by its own pieces; those that don't come out full go to long windows
        while pool.bits >> (tier // 2 + 1) and (opener := pool.take(tier)) and opener[0] > tier // 2:
            got, used = _fill(pool, tier, opener)
            if used == tier:
                out.append((tier, [p[1] for p in got]))
            else:
                back.append(opener)
                for n, i in got[1:]:
                    pool.put(n, i)
    for n, i in back:
        pool.put(n, i)
    while pool.bits:
        got, used = _fill(pool, long)
        tier = used if used in tiers else long
        out.append((tier, [p[1] for p in got]))
    return out


def _pack_bucket(tiers, step: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "row"]).reset_index(drop=True)
        lengths = pdf["length"].tolist()
        sequences = pack(lengths, tiers)
        base = int(pdf["bucket"].iloc[0]) << 32
        n = len(lengths)
        seq, off, tier, group = (np.zeros(n, np.int64) for _ in range(4))
        done = 0
        for size in tiers:
            own = sorted((s for s in enumerate(sequences) if s[1][0] == size), key=lambda s: -sum(lengths[i] for i in s[1][1]))
            groups = max(1, -(-len(own) * size // step))
            for rank, (k, (_, members)) in enumerate(own):
                lap, place = divmod(rank, groups)  # dealt back and forth, fullest first
                at = 0
                for i in members:
                    seq[i], off[i], tier[i] = base + k, at, size
                    group[i] = base + done + (place if lap % 2 == 0 else groups - 1 - place)
                    at += lengths[i]
            done += groups
        return pdf.assign(sequence_id=seq, offset=off, tier=tier, step_group=group)[
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]]

    return run


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", tiers=TIERS, end_id: int = 1,
                   step: int = STEP) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group)."""
    buckets = max(1, -(-docs.count() // BUCKET))
    p = pieces(docs, tokenizer, id_col, text_col, tiers[-1], end_id)
    p = p.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "row"), F.lit(buckets)))
    return p.groupBy("bucket").applyInPandas(
        _pack_bucket(tiers, step), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long")
