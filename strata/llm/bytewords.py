"""Vectorised word splitting and hashing over the UTF-8 bytes of Arrow string columns.

The separators are ASCII, so splitting bytes equals splitting characters.  Word hashes are
64-bit polynomials over a fixed random byte table, divided by the power of the word's place, so
equal words have equal hashes wherever they stand; all words of a batch take a few array
operations.  Texts are worked on in slices of ``SLICE`` bytes cut between words, which bounds the
memory by the longest word, not by the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
SPACES = bytes([0x20, *range(0x09, 0x0E)])

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_TABLE_LOWER = _TABLE.copy()
_TABLE_LOWER[65:91] = _TABLE[97:123]
_MULT = _rng.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 2 * SLICE), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def separators(space: bytes = SPACES) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(space)] = True
    return table


SPACE_TABLE = separators()


class Words:
    """The words of some texts: byte places, 64-bit hashes and the number of words before each text."""

    def __init__(self, data, starts, ends, hashes, first):
        self.data, self.starts, self.ends, self.hashes, self.first = data, starts, ends, hashes, first

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def string_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of an Arrow string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if len(column) else pa.array([], pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1] if off else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray, lower: bool = False, table: np.ndarray = SPACE_TABLE) -> Words:
    """Split every text at the separators of ``table`` and hash the words (A-Z as a-z if ``lower``)."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return Words(data, empty, empty, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    out = []
    text_starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    at = 0
    while at < n:
        end = min(n, at + SLICE)
        while end < n and not table[data[end]]:  # cut between words (or run on to the end of a long one)
            stop = min(n, end + 4096)
            here = np.flatnonzero(table[data[end:stop]])
            end = end + int(here[0]) if len(here) else stop
        part = data[at:end]
        word = ~table[part]
        edge = np.zeros(len(part) + 1, bool)  # a text starts here
        edge[text_starts[np.searchsorted(text_starts, at):np.searchsorted(text_starts, end)] - at] = True
        before = np.empty(len(part), bool)
        before[0] = False
        before[1:] = word[:-1]
        starts = np.flatnonzero(word & (~before | edge[:-1]))
        after = np.empty(len(part), bool)
        after[-1] = False
        after[:-1] = word[1:]
        ends = np.flatnonzero(word & (~after | edge[1:])) + 1
        out.append((starts + at, ends + at, hash_spans(part, starts, ends, lower)))
        at = end
    starts, ends, hashes = (np.concatenate(x) for x in zip(*out))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def hash_spans(part: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte spans of ``part``."""
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((_TABLE_LOWER if lower else _TABLE)[part] * _power(_BASE, len(part)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_BASE_INV, len(part) + 1)[starts] + (ends - starts).astype(np.uint64))


def run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (``len - k + 1`` values)."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(m, np.uint64)
    for j in range(k):
        total += hashes[j:j + m] * _MULT[j]
    return mix(total + _U(k))


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 * SLICE):
    """Cut a batch into pieces of about ``limit`` text bytes (zero copy); one row at least."""
    texts = batch.column(column)
    size = np.cumsum(np.concatenate([[0], np.asarray(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), np.int64)]))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, size[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end
