"""SentencePiece unigram encoding and decoding over a double-array trie of pieces with log scores.

A text gets a space in front and its spaces become the whitespace marker.  No piece runs on from a
character into a marker, and none joins the characters that stand for themselves only, so the text falls
into units (markers and what follows them) whose best paths are independent.  The units of a batch that
aren't cached are encoded together: a double-array trie over the pieces' bytes is walked from all
places at once, and the Viterbi recurrence runs over places within units, for all units at a time.  Of
equal scores the path with the earlier beginning of its last piece wins.  A character without a piece of
its own costs the smallest score less ``PENALTY`` and is written as byte pieces.

Memory is bounded by bytes, not by texts or units: texts are worked on in slices, a long text in segments
cut between units, the cache of units is dropped at ``CACHE`` bytes, and a unit of over ``LONG`` bytes (a
text without spaces) is walked window by window: the recurrence looks back one piece at most, so what is
kept of earlier windows is one back pointer a byte.

Decoding joins the pieces, byte pieces as their bytes, turns markers into spaces and takes off the first
one.  It gives the text back, but for markers in the text itself, which come back as spaces.

The pieces are a public vocabulary's; one that has ranks for scores (merges) gets the log scores of a
Zipf distribution over its ranks.  Null texts have null ids; empty texts have none.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bytewords as bw

MARK = "▁"
PENALTY = 10.0
CACHE = 48 << 20  # bytes of cached units, about
LONG = 4096  # bytes of a unit from which it is walked by itself
WINDOW = 1 << 15  # characters walked at a time
SEGMENT = 1 << 20  # characters of a text split into units at a time


_SPACE_AFTER = re.compile(f"[^ {MARK}](?= )")


class DoubleArray:
    """A trie over byte strings: the child of state s by byte c is base[s] + c if check there is s."""

    def __init__(self, words: dict[bytes, int]):
        tree: list[dict[int, int]] = [{}]
        leaf = [-1]
        for word, value in words.items():
            s = 0
            for c in word:
                nxt = tree[s].get(c)
                if nxt is None:
                    nxt = tree[s][c] = len(tree)
                    tree.append({})
                    leaf.append(-1)
                s = nxt
            leaf[s] = value
        size = 2 * len(tree) + (1 << 14)
        base, check, value = (np.full(size, x, np.int32) for x in (0, -1, -1))
        used = np.zeros(size, bool)
        used[0] = True
        place, todo, hint = {0: 0}, [0], 1
        while todo:
            node = todo.pop()
            kids = tree[node]
            at = place[node]
            value[at] = leaf[node]
            if not kids:
                continue
            codes = np.fromiter(kids, np.int64, len(kids))
            b = hint
            while True:  # the first base in a stretch whose children's places are all free
                if b + 1024 + 256 >= len(used):
                    base, check, value = (np.concatenate([x, np.full(size, y, np.int32)]) for x, y in ((base, 0), (check, -1), (value, -1)))
                    used = np.concatenate([used, np.zeros(size, bool)])
                fits = np.flatnonzero(~used[b + np.arange(1024)[:, None] + codes].any(axis=1))
                if len(fits):
                    b += int(fits[0])
                    break
                b += 1024
            if b - hint > 1024:  # crowded: go on from here
                hint = b - 512
            base[at] = b
            used[b + codes] = True
            check[b + codes] = at
            for c, child in kids.items():
                place[child] = b + c
                todo.append(child)
        pad = np.zeros(256, np.int32)
        self.base, self.check, self.value = np.concatenate([base, pad]), np.concatenate([check, pad - 1]), np.concatenate([value, pad - 1])


def owner_shift(places: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """Number of units before each place (there is a place more than bytes for every unit)."""
    return np.searchsorted(zero, places, "right") - 1


class Pieces:
    """Pieces with log scores, by id; ``special`` ids are never encoded to."""

    def __init__(self, pieces: list[str], scores: np.ndarray, byte_ids: list[int], special: set[int]):
        self.byte_ids, self.scores = byte_ids, scores
        skip = set(byte_ids) | special
        self.trie = DoubleArray({p.encode(): i for i, p in enumerate(pieces) if i not in skip and p})
        normal = [p for i, p in enumerate(pieces) if i not in skip and p]
        self.unknown = min(scores[i] for i in range(len(pieces)) if i not in skip) - PENALTY
        self.raw = [p.encode() if i not in skip else b"" for i, p in enumerate(pieces)]
        for b, i in enumerate(byte_ids):
            self.raw[i] = bytes([b])
        joined = set("".join(p for p in normal if len(p) > 1))
        alone = "".join(c for c in "\n\t\r" if c not in joined)
        self.cut = not any(re.search(f"[^{MARK}]{MARK}", p) for p in normal)
        if not self.cut:
            self.unit = re.compile(r"(?s).+")
        else:
            self.unit = re.compile(f"[{alone}]|{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" if alone else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.cache: dict[str, bytes] = {}
        self.held = 0
        # all pieces' bytes one after the other, for decoding by array lookups
        self.flat = np.frombuffer(b"".join(self.raw) + b"\0", np.uint8)
        self.size = np.array([len(r) for r in self.raw], np.int64)
        self.start = np.cumsum(self.size) - self.size

    @classmethod
    def load(cls, path: str) -> Pieces:
        """From a SentencePiece model file."""
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        scores = np.array([sp.get_score(i) for i in range(n)])
        skip = special | set(byte_ids)
        normal = [i for i in range(n) if i not in skip]
        if all(float(scores[i]).is_integer() for i in normal):
            scores = scores.copy()
            total = math.log(sum(1 / (k + 2) for k in range(len(normal))))
            for i in normal:
                scores[i] = -math.log(2 - scores[i]) - total
        return cls([sp.id_to_piece(i) for i in range(n)], scores, byte_ids, special)

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """Little-endian unsigned 32-bit ids of each text."""
        short = [t if t is None or len(t) <= SEGMENT else "" for t in texts]
        out = self._encode_texts(short)
        for i, t in enumerate(texts):
            if t is not None and len(t) > SEGMENT:
                out[i] = b"".join(self._encode_texts([s], joined=True)[0] for s in (_segments(" " + t) if self.cut else [" " + t]))
        return out

    def _encode_texts(self, texts: list[str | None], joined: bool = False) -> list[bytes | None]:
        if self.held > CACHE:
            self.cache, self.held = {}, 0
        lead = "" if joined else " "  # a segment has its space already
        units = [self.unit.findall((lead + t).replace(" ", MARK)) if t else [] for t in texts]
        new, size = [], 0
        for u in set().union(*units).difference(self.cache):
            if len(u) > LONG:
                self._keep([u], [self._encode_long(u)])
                continue
            new.append(u)
            size += len(u)
            if size > 1 << 19:
                self._keep(new, self._encode_units(new))
                new, size = [], 0
        if new:
            self._keep(new, self._encode_units(new))
        get = self.cache.__getitem__
        return [None if t is None else b"".join(map(get, u)) for t, u in zip(texts, units)]

    def _keep(self, units: list[str], ids: list[bytes]) -> None:
        for u, i in zip(units, ids):
            self.cache[u] = i
            self.held += 160 + len(u) + len(i)

    def _matches(self, data: np.ndarray, starts: np.ndarray, char_end: np.ndarray, end_of: np.ndarray):
        """(begin, end, piece) of all pieces that begin at ``starts``; -1 for characters without a piece of their own."""
        state, at, live = np.zeros(len(starts), np.int64), starts.copy(), np.arange(len(starts))
        begin, end, piece = [], [], []
        single = np.zeros(len(starts), bool)
        while len(live):
            to = self.trie.base[state] + data[at]
            ok = (self.trie.check[to] == state) & (at < end_of[live])
            live, state, at = live[ok], to[ok].astype(np.int64), at[ok] + 1
            got = self.trie.value[state]
            hit = got >= 0
            begin.append(starts[live[hit]])
            end.append(at[hit])
            piece.append(got[hit].astype(np.int64))
            single[live[hit & (at == char_end[live])]] = True
        begin.append(starts[~single])
        end.append(char_end[~single])
        piece.append(np.full((~single).sum(), -1))
        return (np.concatenate(x) for x in (begin, end, piece))

    def _encode_long(self, unit: str) -> bytes:
        """The best path of one long unit, window by window."""
        data = np.frombuffer(unit.encode("utf-8", "replace") + b"\0", np.uint8)
        n = len(data) - 1
        starts = np.flatnonzero((data[:n] & 0xC0) != 0x80)
        char_end = np.append(starts[1:], n)
        back_from, back_piece = np.zeros(n + 1, np.int32), np.zeros(n + 1, np.int32)
        best, get = {0: 0.0}, float("-inf")
        for lo in range(0, len(starts), WINDOW):
            part = starts[lo:lo + WINDOW]
            begin, end, piece = self._matches(data, part, char_end[lo:lo + WINDOW], np.full(len(part), n))
            order = np.lexsort((end, begin))
            begin, end, piece = begin[order], end[order], piece[order]
            score = np.where(piece >= 0, self.scores[piece], self.unknown).tolist()
            came: dict[int, tuple[int, int]] = {}
            for a, b, p, x in zip(begin.tolist(), end.tolist(), piece.tolist(), score):
                total = best[a] + x
                if total > best.get(b, get):
                    best[b] = total
                    came[b] = (a, p)
            to = np.fromiter(came, np.int64, len(came))
            back_from[to], back_piece[to] = np.array(list(came.values()), np.int64).reshape(-1, 2).T
            last = int(char_end[min(lo + WINDOW, len(starts)) - 1])
            best = {b: v for b, v in best.items() if b >= last}
        ids, at = [], n
        while at > 0:
            a, p = int(back_from[at]), int(back_piece[at])
            ids.extend([p] if p >= 0 else [self.byte_ids[c] for c in data[a:at][::-1].tolist()])
            at = a
        return np.array(ids[::-1], "<u4").tobytes()

    def _encode_units(self, units: list[str]) -> list[bytes]:
        raw = [u.encode("utf-8", "replace") for u in units]
        data = np.frombuffer(b"".join(raw) + b"\0", np.uint8)
        first = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        n = int(first[-1])
        unit = np.repeat(np.arange(len(raw)), np.diff(first))
        starts = np.flatnonzero((data[:n] & 0xC0) != 0x80)
        end_of = first[unit[starts] + 1]
        char_end = np.minimum(np.append(starts[1:], n), end_of)
        begin, end, piece = self._matches(data, starts, char_end, end_of)
        score = np.where(piece >= 0, self.scores[piece], self.unknown)
        depth = begin - first[unit[begin]] if n else begin
        order = np.argsort(depth, kind="stable")
        begin, end, piece, score, depth = begin[order], end[order], piece[order], score[order], depth[order]
        # best[i + unit]: best score of the unit's text before byte i (a place more than bytes for each unit)
        best = np.full(n + len(raw), -np.inf)
        best[first[:-1] + np.arange(len(raw))] = 0
        back_from, back_piece = np.zeros(len(best), np.int64), np.zeros(len(best), np.int64)
        a, b = begin + unit[begin], end + unit[begin]
        cuts = np.flatnonzero(np.diff(depth)) + 1
        for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(depth))):  # all ends within a depth differ
            total = best[a[lo:hi]] + score[lo:hi]
            better = total > best[b[lo:hi]]
            to = b[lo:hi][better]
            best[to] = total[better]
            back_from[to], back_piece[to] = a[lo:hi][better], piece[lo:hi][better]
        # all units' best paths at once, from their ends
        zero = first[:-1] + np.arange(len(raw))
        at, live = first[1:] + np.arange(len(raw)), np.arange(len(raw))
        owner, ids, spans = [], [], []
        while True:
            going = at > zero[live]
            live, at = live[going], at[going]
            if not len(live):
                break
            owner.append(live)
            ids.append(back_piece[at])
            spans.append(np.stack([back_from[at], at], axis=1))
            at = back_from[at]
        if not owner:
            return [b""] * len(raw)
        step = np.concatenate([np.full(len(o), k) for k, o in enumerate(owner)])
        owner, ids, spans = np.concatenate(owner), np.concatenate(ids), np.concatenate(spans)
        order = np.lexsort((-step, owner))
        owner, ids, spans = owner[order], ids[order], spans[order]
        lost = np.flatnonzero(ids < 0)
        if len(lost):  # byte pieces for characters without one
            width = np.where(ids < 0, spans[:, 1] - spans[:, 0], 1)
            keep, owner, new = ids[ids >= 0], np.repeat(owner, width), np.full(width.sum(), -1)
            new[np.repeat(ids >= 0, width)] = keep
            place = np.concatenate([np.arange(x, y) for x, y in spans[lost] - owner_shift(spans[lost, 0], zero)[:, None]])
            new[new < 0] = np.array(self.byte_ids)[data[place]]
            ids = new
        flat = ids.astype("<u4").tobytes()
        bounds = np.searchsorted(owner, np.arange(len(raw) + 1)).tolist()
        return [flat[4 * x:4 * y] for x, y in zip(bounds, bounds[1:])]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of ids one after the other; ``ends`` says where each text's ids end."""
        size = self.size[ids]
        stop = np.cumsum(size)
        data = self.flat[np.repeat(self.start[ids] - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)]
        cuts = np.append(0, stop)[np.append(0, ends)].tolist()
        out = []
        for a, b in zip(cuts, cuts[1:]):
            text = data[a:b].tobytes().decode("utf-8", "replace").replace(MARK, " ")
            out.append(text[1:] if text.startswith(" ") else text)
        return out


def _segments(text: str):
    """Parts of a text cut before spaces that follow other characters, where units end."""
    at = 0
    while at < len(text):
        cut = _SPACE_AFTER.search(text, at + SEGMENT)
        end = cut.start() + 1 if cut else len(text)
        yield text[at:end]
        at = end


def encode(docs: DataFrame, pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, ids, ids_crc32) of every row; ``pieces`` is a broadcast of Pieces."""

    def run(batches):
        p = pieces.value
        for batch in batches:
            for part in bw.slices(batch, "text", 1 << 20):
                got = p.encode(part.column("text").to_pylist())
                size = np.concatenate([[0], np.cumsum([len(g) // 4 if g else 0 for g in got])]).astype(np.int32)
                flat = np.frombuffer(b"".join(g for g in got if g), "<u4").astype(np.int32)
                none = pa.array([g is None for g in got], pa.bool_())
                lists = pa.ListArray.from_arrays(pa.array(size), pa.array(flat), mask=none)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text"), lists, pa.array([None if g is None else zlib.crc32(g) for g in got], pa.int64())],
                    ["doc_id", "text", "ids", "ids_crc32"])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, f"doc_id {dict(d.dtypes)['doc_id']}, text string, ids array<int>, ids_crc32 long")


def decode(encoded: DataFrame, pieces) -> DataFrame:
    """The rows of ``encoded`` with ``decoded``, the text that their ids stand for."""

    def run(batches):
        p = pieces.value
        for batch in batches:
            column = batch.column(batch.schema.names.index("ids"))
            ends = np.cumsum(pc.list_value_length(column).fill_null(0).to_numpy())
            at = 0
            while at < batch.num_rows:  # rows of about 2^18 ids at a time
                done = int(ends[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + (1 << 18), "right")))
                part = column.slice(at, to - at)
                texts = p.decode(part.flatten().to_numpy(), ends[at:to] - done)
                none = part.is_null().to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(at, to - at).columns, pa.array([None if x else t for x, t in zip(none, texts)], pa.string())],
                    [*batch.schema.names, "decoded"])
                at = to

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))
