"""Fill-in-middle transformation with line boundaries in a Roaring-style set.

A text of n lines is cut twice, after a and after b of its lines (0 <= a <= b
<= n), into prefix, middle and suffix, which are written behind sentinels in
the order prefix, suffix, middle (psm) or suffix, prefix, middle (spm).  The
numbers that decide come from a hash of the id.

The line ends of a slice of texts, in code points from the slice's start, go
to one set of containers of 2^16 values each: sorted arrays, bitmaps, or runs,
whichever is smallest.  The cut after the k-th line of a text is the set's
(lines of the texts before + k)-th member: the container is found among the
cumulative cardinalities, the member by the container's own select.

Edge cases.  Null and empty texts, and texts that hold a sentinel, stay as they
are (form plain, null lengths).  A null id hashes like an empty one.  Rows with
repeated ids are cut alike where their texts have as many lines.  Only the id
and text columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import tokens as tk
from .ship import map_arrow

#: Sentinels before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Values of an array container at most.
ARRAY = 4096


class Sorted:
    """Container: the values in order."""

    def __init__(self, low: np.ndarray):
        self.values = low.astype(np.uint16)

    def select(self, k: np.ndarray) -> np.ndarray:
        return self.values[k].astype(np.int64)


class Runs:
    """Container: first value of each run of neighbours, and how many values stand before it."""

    def __init__(self, low: np.ndarray, at: np.ndarray):
        self.first, self.before = low[at].astype(np.uint16), at.astype(np.uint16)

    def select(self, k: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, k, "right") - 1
        return self.first[run].astype(np.int64) + k - self.before[run]


class Bitmap:
    """Container: a bit for each of 2^16 values, and the bits set up to the end of each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << 16, np.uint8)
        bits[low] = 1
        self.bytes = np.packbits(bits, bitorder="little").reshape(1024, 8)
        self.total = np.cumsum(np.bitwise_count(self.bytes).sum(1, dtype=np.int64))

    def select(self, k: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.total, k, "right")
        k = k - np.where(word > 0, self.total[word - 1], 0)
        seen = np.unpackbits(self.bytes[word], axis=1, bitorder="little").cumsum(1, dtype=np.int64)
        return word * 64 + (seen > k[:, None]).argmax(1)


def container(low: np.ndarray):
    """The smallest container of ascending values below 2^16."""
    at = np.flatnonzero(np.concatenate([[True], np.diff(low) != 1]))
    if 4 * len(at) < min(2 * len(low), 8192):
        return Runs(low, at)
    return Sorted(low) if len(low) <= ARRAY else Bitmap(low)


class BoundarySet:
    """Ascending distinct numbers from 0 up, by containers of 2^16."""

    def __init__(self, values: np.ndarray):
        self.high, first = np.unique(values >> 16, return_index=True)
        ends = np.append(first[1:], len(values)) if len(values) else first
        self.containers = [container(values[a:b] & 0xFFFF) for a, b in zip(first, ends)]
        self.total = ends.astype(np.int64)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The k-th numbers, counted from 0."""
        at = np.searchsorted(self.total, k, "right")
        out = np.zeros(len(k), np.int64)
        for c in np.unique(at):
            own = at == c
            local = k[own] - (self.total[c - 1] if c else 0)
            out[own] = (self.high[c] << 16) + self.containers[c].select(local)
        return out


def line_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code point offsets of all line ends of a slice, line offsets and code point offsets of its texts."""
    if not len(data):
        zeros = np.zeros(len(offsets), np.int64)
        return zeros[:0], zeros, zeros
    point = np.cumsum((data & 0xC0) != 0x80)
    ends = data == 0x0A
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    ends[last] = True
    place = np.flatnonzero(ends)
    return point[place], np.searchsorted(place, offsets), np.concatenate([[0], point])[offsets]


def cuts(column, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each text, and its two cuts in code points; the cuts follow h1 and h2 modulo lines + 1."""
    ends, line, start = line_ends(*tk.text_buffer(column))
    n = np.diff(line)
    a, b = h1 % (n + 1), h2 % (n + 1)
    after = np.concatenate([np.minimum(a, b), np.maximum(a, b)])
    some = after > 0
    at = np.zeros(len(after), np.int64)
    at[some] = BoundarySet(ends).select((np.tile(line[:-1], 2) + after - 1)[some]) - np.tile(start[:-1], 2)[some]
    return n, at[:len(n)], at[len(n):]


def hashes(id_col: str, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transformed(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, sentinels: tuple[str, str, str] = SENTINELS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, form (plain, psm, spm), prefix_chars, middle_chars, output of every document.

    rate: per cent of texts that are cut; spm: per cent of those with the suffix in front.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), *hashes(id_col, seed))
    schema = T.StructType([source.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                           T.StructField("output", T.StringType())])
    holds = re.compile("|".join(map(re.escape, sentinels)))
    p, s, m = sentinels

    def run(batches):
        for part in tk.slices(batches):
            h1, h2, h3, h4 = (part.column(i).to_numpy() for i in range(2, 6))
            n, first, second = cuts(part.column(1), h1, h2)
            form, output = [], []
            texts = part.column(1).to_pylist()
            for t, a, b, cut, front in zip(texts, first.tolist(), second.tolist(), (h3 % 100 < rate).tolist(), (h4 % 100 < spm).tolist()):
                if not t or not cut or holds.search(t):
                    form.append("plain")
                    output.append(t)
                elif front:
                    form.append("spm")
                    output.append(f"{s}{t[b:]}{p}{t[:a]}{m}{t[a:b]}")
                else:
                    form.append("psm")
                    output.append(f"{p}{t[:a]}{s}{t[b:]}{m}{t[a:b]}")
            plain = np.array([f == "plain" for f in form], bool)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n.astype(np.int64)), pa.array(form, pa.string()), pa.array(first, mask=plain),
                 pa.array(second - first, mask=plain), pa.array(output, pa.string())], names=schema.names)

    return map_arrow(source, run, schema)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text from its output and form.

    A cut text holds no sentinel, and none can arise across a border, as no
    sentinel ends as another begins: so the output has exactly three.
    """
    parts = F.split(output, "|".join("\\Q" + x + "\\E" for x in sentinels), -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
