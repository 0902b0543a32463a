"""Words, lines and shingles of whole Arrow text columns as numpy arrays.

Every function works on one slice of rows: the UTF-8 bytes of its texts end to
end, and the offsets of the texts.  Nulls count as empty texts.  Words are
runs of bytes of a given class; bytes from 0x80 up count as letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes of text handled at once (a longer text is handled alone).
SLICE_BYTES = 1 << 20

_rng = np.random.default_rng(7)
#: A random number for each byte; FOLDED gives A-Z those of a-z.
EXACT = _rng.integers(0, 2**64, 256, dtype=U)
FOLDED = EXACT.copy()
FOLDED[65:91] = EXACT[97:123]

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_SPACE = ~SPACE
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_ROLL = _rng.integers(0, 2**64, 64, dtype=U) | U(1)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the splitmix64 finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... (n numbers, modulo 2^64); kept up to one slice."""
    if n <= SLICE_BYTES + 1:
        if base not in _powers:
            steps = np.full(SLICE_BYTES + 1, base, U)
            steps[0] = 1
            _powers[base] = np.cumprod(steps, dtype=U)
        return _powers[base][:n]
    steps = np.full(n, base, U)
    steps[0] = 1
    return np.cumprod(steps, dtype=U)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and the n + 1 offsets of the texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches, columns=("text",), limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece has up to ``limit`` bytes of text, or one row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = np.zeros(n, np.int64)
        for name in columns:
            col = batch.column(batch.schema.get_field_index(name))
            size += np.asarray(pc.fill_null(pc.binary_length(col), 0)).astype(np.int64)
        total = np.concatenate([[0], np.cumsum(size)])
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(total, total[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table=EXACT) -> np.ndarray:
    """A 64-bit hash for each span of bytes; spans in order, without overlap."""
    out = np.empty(len(starts), U)
    i, n = 0, len(starts)
    while i < n:
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        part = data[base:ends[j - 1]]
        sums = np.zeros(len(part) + 1, U)
        np.cumsum(table[part] * _power(_BASE, len(part)), out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        inverse = _power(_INVERSE, int(s[-1]) + 1)
        out[i:j] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(U))
        i = j
    return out


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """Starts, ends and text numbers of the runs of bytes for which ``inside`` is true."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    w = inside[data]
    firsts, lasts = offsets[:-1][offsets[:-1] < offsets[1:]], offsets[1:][offsets[:-1] < offsets[1:]] - 1
    edge = np.empty(n, bool)
    edge[0], edge[1:] = False, w[:-1]
    edge[firsts] = False
    starts = np.flatnonzero(w & ~edge)
    edge[:-1], edge[-1] = w[1:], False
    edge[lasts] = False
    ends = np.flatnonzero(w & ~edge) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray, inside=NOT_SPACE, table=EXACT):
    """Starts, ends, text numbers and hashes of the words, and word offsets of the texts."""
    starts, ends, doc = runs(data, offsets, inside)
    return starts, ends, doc, span_hashes(data, starts, ends, table), offsets_of(doc, len(offsets) - 1)


def offsets_of(doc: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int64)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on (positions of which so many are left)."""
    n = max(0, len(hashes) - size + 1)
    total = np.full(n, size, U)
    for k in range(size):
        total += hashes[k:k + n] * _ROLL[k]
    return mix(total)


def shingles(hashes: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word shingle.  A text of 1 to ``size`` - 1 words has one, of all its words."""
    n = np.diff(offsets)
    doc = np.repeat(np.arange(len(n)), n)
    docs, found = [], []
    if len(hashes) >= size:
        h = windows(hashes, size)
        fits = offsets[doc[:len(h)] + 1] - np.arange(len(h)) >= size
        docs.append(doc[:len(h)][fits])
        found.append(h[fits])
    for k in range(1, size):
        short = np.flatnonzero(n == k)
        if len(short):
            total = np.full(len(short), k, U)
            for i in range(k):
                total += hashes[offsets[short] + i] * _ROLL[i]
            docs.append(short)
            found.append(mix(total))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, U)
    return np.concatenate(docs), np.concatenate(found)


def counted(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text number, value) with counts, ordered by text number."""
    if not len(doc):
        return doc, value, np.zeros(0, np.int64)
    order = np.lexsort((value, doc))
    d, v = doc[order], value[order]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (v[1:] != v[:-1])])
    at = np.flatnonzero(new)
    return d[at], v[at], np.diff(np.append(at, len(d)))


class Places:
    """Where distinct 64-bit keys stand in their array, by a hash table at most a quarter full."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.table = np.full(1 << self.bits, -1, np.int32 if len(keys) < 1 << 31 else np.int64)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):
            free = self.table[slot] < 0
            self.table[slot[free]] = todo[free]  # of several keys for one slot the last stays
            left = self.table[slot] != todo
            todo, slot = todo[left], (slot[left] + 1) & (len(self.table) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(U) * U(0x9E3779B97F4A7C15) >> U(64 - self.bits)).view(np.int64)

    def find(self, sought: np.ndarray) -> np.ndarray:
        """Place of each sought key; -1: not there."""
        slot = self._slot(sought)
        at = self.table[slot].astype(np.int64)
        if not len(self.keys):
            return at
        off = np.flatnonzero((at >= 0) & (self.keys[at] != sought))
        while len(off):
            slot[off] = (slot[off] + 1) & (len(self.table) - 1)
            at[off] = self.table[slot[off]]
            off = off[(at[off] >= 0) & (self.keys[at[off]] != sought[off])]
        return at
