"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked id pairs.

A byte-level BPE reads a space and the text, a SentencePiece BPE the text, to which it adds that space.
Tokens that share bytes belong together; a group is a connected component of that relation.  Every token
points to the farthest-right token that it overlaps (the one that ends last; of two that end together the
second tokenizer's), and the pointers of all tokens of a batch are doubled at once until they stand still:
each token then points to its component's terminal token, which labels the group.  The tokens that end
with the terminal token's last byte are linked.

Neither tokenizer joins anything across a space between two characters that aren't white space: the first
one's pattern starts a new word there and no piece of the second has a space behind another character.
Texts are cut at these spaces, the distinct chunks of a batch are encoded and aligned together, and a cache
bounded by bytes keeps them for later batches.  Ids are those of the whole text.  Memory is bounded by a
slice of about ``SLICE`` bytes of texts, or by the longest run without such a space.

Counts of linked pairs are a sharded join: a slice of documents writes each of its distinct pairs once with
how often it occurs, pairs are counted over the corpus, compared with the most frequent partner of their
second id, and joined back to the slices by pair.  A pair that occurs everywhere is one row a slice.
A slice's links are one value of two or four bytes a link: read as arrays, all the slices of a file would
be held at once, with the levels of every link beside it.

Texts that are null, empty or not reproduced by both tokenizers have no tokens: zeros and an empty string.
Null ids and repeated rows stay rows of their own.  No documents give no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import shared_table_path

from . import bytewords as bw

SLICE = 1 << 20
LINE = 4096  # characters of chunks encoded as one line
MARK = "▁"
# Fixed value: the pattern by which byte-level vocabularies of this kind cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 ones
    themselves, the others in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def overlap_successors(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For tokens that tile the same bytes, given by their increasing ends: each token's farthest-right
    overlapping token (itself included).  Tokens of ``a`` come first in the numbering, then those of ``b``."""
    n = len(a_ends)
    # the other side's token that holds this token's last byte ends last of all it overlaps
    over_a = np.searchsorted(b_ends, a_ends)
    over_b = np.searchsorted(a_ends, b_ends)
    own = np.arange(len(b_ends))
    return np.concatenate([n + over_a, np.where(a_ends[over_b] > b_ends, over_b, n + own)])


def terminal_tokens(successor: np.ndarray) -> np.ndarray:
    """Pointer jumping: successors of successors until nothing changes."""
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor
        successor = further


class _Table:
    """Byte strings by id, one after the other, for lookups of many ids at once."""

    def __init__(self, raw: list[bytes]):
        self.raw = raw
        self.flat = np.frombuffer(b"".join(raw) + b"\0", np.uint8)
        self.size = np.array([len(r) for r in raw], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def join(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids' bytes one after the other, and where each id's bytes end."""
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.start[ids] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)], ends


class Aligner:
    """Aligned chunks of texts.

    The byte-level vocabulary is encoded by ranks: its ids are the order of its merges, which is checked.
    """

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece
        import tiktoken
        with open(byte_level, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet = byte_alphabet()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(model["vocab"][x + y] != 256 + i for i, (x, y) in enumerate(merges)):
            raise ValueError("ids aren't in the order of the merges")
        raw = {i: bytes(alphabet[c] for c in t) for t, i in model["vocab"].items() if i < 256 + len(merges)}
        self.a = tiktoken.Encoding("byte_level", pat_str=WORDS, mergeable_ranks={r: i for i, r in raw.items()}, special_tokens={})
        self.a_table = _Table([raw[i] for i in range(len(raw))])
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_table = _Table([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)])
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in names):
            raise ValueError("a piece runs on into a space: texts can't be cut there")
        self.digits = _Table([b"%d," % i for i in range(max(len(raw), len(names)))])

    def _encode(self, lines: list[list[str]]) -> tuple[list, list, list]:
        """Lines of chunks as ids of both tokenizers, and the chunks of lines that both reproduce; a line
        that isn't reproduced is tried again chunk by chunk."""
        texts = [" ".join(x) for x in lines]
        a, b, kept = [], [], []
        for line, t, y in zip(lines, texts, self.b.encode(texts, num_threads=1)):
            x = self.a.encode_ordinary(" " + t)
            want = b" " + t.encode()
            if want == b"".join([self.a_table.raw[i] for i in x]) == b"".join([self.b_table.raw[i] for i in y]):
                a.append(x)
                b.append(y)
                kept += line
            elif len(line) > 1:
                for into, got in zip((a, b, kept), self._encode([[c] for c in line])):
                    into += got
        return a, b, kept

    def chunks(self, chunks: list[str]) -> dict[str, tuple[int, int, bytes, bytes]]:
        """(tokens of a, tokens of b, linked pairs, groups as text) of the chunks that both tokenizers reproduce."""
        lines, size = [[]], 0
        for c in chunks:
            if size > LINE:
                lines.append([])
                size = 0
            lines[-1].append(c)
            size += len(c) + 1
        a, b, kept = self._encode(lines if chunks else [])
        if not kept:
            return {}
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, sum(map(len, x))) for x in (a, b))
        a_ends, b_ends = np.cumsum(self.a_table.size[a]), np.cumsum(self.b_table.size[b])
        last = terminal_tokens(overlap_successors(a_ends, b_ends))
        # terminal tokens are b's; a's token with the same label that comes last ends with it
        n = len(a)
        end_b = np.flatnonzero(last[n:] == n + np.arange(len(b)))
        end_a = np.searchsorted(last[:n], n + end_b, "right") - 1
        pairs = (a[end_a] << 32 | b[end_b]).astype("<i8").tobytes()
        # groups in order, each a's tokens and then b's, ids in digits with a sign behind each
        group_a, group_b = np.searchsorted(end_a, np.arange(n)), np.searchsorted(end_b, np.arange(len(b)))
        at_a = np.arange(n) + np.append(0, end_b + 1)[group_a]
        at_b = np.arange(len(b)) + end_a[group_b] + 1
        ids = np.empty(n + len(b), np.int64)
        ids[at_a], ids[at_b] = a, b
        text, stop = self.digits.join(ids)
        text[stop[at_a[end_a]] - 1], text[stop[at_b[end_b]] - 1] = ord("|"), ord(";")
        text = text.tobytes()
        ends = np.cumsum([len(c) + 1 if c.isascii() else len(c.encode()) + 1 for c in kept])
        groups = np.append(0, np.searchsorted(b_ends[end_b], ends, "right"))
        n_a, n_b = (np.diff(np.append(0, np.searchsorted(e, ends, "right"))).tolist() for e in (a_ends, b_ends))
        cut = np.append(0, stop[at_b[end_b]])[groups].tolist()
        groups = (8 * groups).tolist()
        return {c: (x, y, pairs[p:q], text[r:s - 1]) for c, x, y, p, q, r, s in zip(kept, n_a, n_b, groups, groups[1:], cut, cut[1:])}

    def align(self, texts: list[str | None]) -> list[list[tuple]]:
        """The aligned chunks of every text in order; none for texts without tokens."""
        cut = [_CUT.split(t) if t else [] for t in texts]
        found = self.chunks(list(set().union(*cut)))
        out = [list(map(found.get, c)) for c in cut]
        return [[] if None in x else x for x in out]


_aligners: dict[tuple[str, str], Aligner] = {}

_SLICE = pa.schema([
    ("slice", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
    ("n_links", pa.list_(pa.int64())), ("groups_sha256", pa.list_(pa.string())), ("link", pa.binary()),
    ("pair", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))])
_SLICE_DDL = ("slice long, doc_id array<long>, n_a array<long>, n_b array<long>, n_links array<long>, groups_sha256 array<string>, "
              "link binary, pair array<long>, n array<long>")


def _place_type(n: int) -> str:
    """The places of ``n`` distinct pairs in as few bytes as hold them."""
    return "<u2" if n <= 1 << 16 else "<u4"


def _groups_sha256(chunks: list[tuple]) -> str:
    h = hashlib.sha256(chunks[0][3])
    for at in range(1, len(chunks), 10_000):
        h.update(b";" + b";".join([c[3] for c in chunks[at:at + 10_000]]))
    return h.hexdigest()


def _slice_rows(byte_level: str, pieces: str):
    def run(batches):
        key = (byte_level, pieces)
        aligner = _aligners.get(key) or _aligners.setdefault(key, Aligner(*key))
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in bw.slices(batch, "text", SLICE):
                n_a, n_b, n_links, sha, links = [], [], [], [], []
                for got in aligner.align(part.column("text").to_pylist()):
                    raw = b"".join([c[2] for c in got])
                    n_a.append(sum([c[0] for c in got]))
                    n_b.append(sum([c[1] for c in got]))
                    n_links.append(len(raw) // 8)
                    sha.append(_groups_sha256(got) if got else "")
                    links.append(raw)
                pair, link, n = np.unique(np.frombuffer(b"".join(links), "<i8"), return_inverse=True, return_counts=True)
                row = [number, part.column("doc_id").to_pylist(), n_a, n_b, n_links, sha, link.astype(_place_type(len(pair))).tobytes(), pair, n]
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _SLICE)], schema=_SLICE)
                number += 1

    return run


_DOC = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _doc_rows(slice_: pa.Table, stats: pa.Table) -> pa.Table:
    """Sums over the links of one slice's documents; ``stats`` has the counts of its distinct pairs."""
    col = {name: slice_.column(name).combine_chunks().flatten() for name in slice_.column_names if name not in ("slice", "link")}
    place = stats.column("place").to_numpy()
    link = np.frombuffer(slice_.column("link")[0].as_py(), _place_type(len(place)))
    ends = np.append(0, np.cumsum(col["n_links"].to_numpy()))
    sums = []
    for name in ("best", "total"):
        of = np.zeros(len(place), np.int64)
        of[place] = stats.column(name).to_numpy()
        sums.append(pa.array(np.diff(np.append(0, np.cumsum(of[link]))[ends])))
    return pa.Table.from_arrays([col["doc_id"], col["n_a"], col["n_b"], col["n_links"], col["n_links"], *sums, col["groups_sha256"]],
                                [x.split()[0] for x in _DOC.split(", ")])


def write_slices(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> str:
    """The path of slices of aligned documents, written to the shared folder: per slice its documents, their links and its distinct pairs."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    path = shared_table_path(docs.sparkSession, "alignment")
    d.mapInArrow(_slice_rows(byte_level, pieces), _SLICE_DDL).write.parquet(path)
    return path


def pair_counts(slices: DataFrame) -> DataFrame:
    """(pair, total, best): links of each id pair (first id << 32 | second id) and whether its second id has no more with another."""
    p = slices.select(F.explode(F.arrays_zip("pair", "n")).alias("p")).groupBy("p.pair").agg(F.sum("p.n").alias("total"))
    p = p.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    most = p.groupBy("b").agg(F.max("total").alias("most"))
    return p.join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).cast("long").alias("best"))


def align_tokenizers(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    path = write_slices(docs, byte_level, pieces, id_col, text_col)
    slices, rows = (docs.sparkSession.read.parquet(path) for _ in range(2))
    own = slices.select("slice", F.posexplode("pair").alias("place", "pair"))
    stats = own.join(pair_counts(slices), "pair").select("slice", "place", "total", "best")
    return rows.drop("pair", "n").groupBy("slice").cogroup(stats.groupBy("slice")).applyInArrow(_doc_rows, _DOC)


def pair_table(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a_id, b_id, links, best): which ids of the two tokenizers end together, and how often over the corpus."""
    low = F.lit((1 << 32) - 1)
    slices = docs.sparkSession.read.parquet(write_slices(docs, byte_level, pieces, id_col, text_col))
    return pair_counts(slices).select(
        F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("pair").bitwiseAND(low).cast("int").alias("b_id"),
        F.col("total").alias("links"), (F.col("best") == 1).alias("best"))
