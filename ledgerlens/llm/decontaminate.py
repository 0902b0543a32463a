"""Benchmark passages in documents, under word edits: CGK embedding and bit-sampling LSH.

Texts are sequences of words (runs of ASCII letters, digits and bytes from
0x80 up; A-Z lower-cased).  An item of L words matches a document that has a
passage within floor(L / 5) word edits of it.  Item-sized windows of a
document are embedded by random walks (CGK): step j reads the word under the
walk and moves on or stays as a hash of (j, word) says, so that windows a few
edits apart soon read the same words at the same steps again and edit distance
becomes Hamming distance.  Words read at a few sampled steps are one hash key;
``REPEATS`` walks, each with steps of its own, reach the target recall, and
each proposed (window, item) pair is verified by the exact edit distance
between the item and the best passage around the window.

Windows are only taken where they can matter: an item with up to k edits keeps
one of its k + 1 equal parts whole, so a document without any word q-gram of
the item, q = floor(L / (k + 1)), cannot match it.  Each shared q-gram fixes
one window of the item's size.

Items are a stated query set: they are read in blocks of up to ``BLOCK_WORDS``
words, and each block is matched against all documents in one pass without a
shuffle.

Edge cases.  Null and empty texts match nothing, as do null and empty items.
Items of fewer than ``EDIT_SHARE`` words allow no edits (floor(L / 5) is 0): they
match every document that holds them whole, found by hashes of all its windows
of their size.  Items of fewer than ``whole`` words (a parameter; 1 turns the
rule off) stand in any text by chance, so they match only a document that has
the same words and no others.  A repeated document row gives repeated results; repeated
item rows count once; items of equal text and different ids all match.  Null
ids are kept as they are.  Only the id and text columns are read by
``matches``; ``clean`` keeps all columns whatever their names.  Empty tables
give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import tokens as tk
from .ship import map_arrow, ship

U = np.uint64
EDIT_SHARE = 5
WHOLE = 3
REPEATS, SAMPLES = 32, 3
BLOCK_WORDS = 1_000_000
_SEED = 20_240_229
_BITS = 22


class Items:
    """One block of items: q-grams with the windows they fix, and the keys of the items."""

    def __init__(self, rows: list[tuple]):
        self.ids = [r[0] for r in rows]
        data, offsets = tk.text_buffer(pa.array([r[1] for r in rows], pa.string()))
        _, _, _, h, at = tk.words(data, offsets, tk.ALNUM, tk.FOLDED)
        self.words = [h[at[i]:at[i + 1]] for i in range(len(rows))]
        size = np.diff(at)
        self.short: dict[int, dict[bytes, list[int]]] = {}
        by_size: dict[int, list[int]] = {}
        for i, n in enumerate(size.tolist()):
            if n >= EDIT_SHARE:
                by_size.setdefault(n, []).append(i)
            elif n:
                self.short.setdefault(n, {}).setdefault(self.words[i].tobytes(), []).append(i)
        self.windows = {n: np.unique(tk.windows(np.concatenate([np.frombuffer(w, U) for w in found]), n)[::n])
                        for n, found in self.short.items()}
        self.grams = {}
        self.keys = {}
        found: dict[int, list] = {}
        for n, members in by_size.items():
            q = n // (n // EDIT_SHARE + 1)
            stack = np.stack([self.words[i] for i in members])
            for i, row in zip(members, stack):
                for j, g in enumerate(tk.windows(row, q).tolist()):
                    found.setdefault(q, []).append((g, n, j))
            key = embed_keys(stack)
            self.keys[n] = [(np.sort(k), np.asarray(members)[np.argsort(k, kind="stable")]) for k in key]
        for q, rows_ in found.items():
            rows_ = sorted(set(rows_))
            g = np.array([r[0] for r in rows_], U)
            bits = np.zeros(1 << _BITS, bool)
            bits[g & U((1 << _BITS) - 1)] = True
            self.grams[q] = (bits, g, np.array([r[1] for r in rows_]), np.array([r[2] for r in rows_]))


def embed_keys(windows: np.ndarray) -> np.ndarray:
    """REPEATS hash keys of each window (rows: words' hashes, all of one size)."""
    n, size = windows.shape
    rng = np.random.default_rng(_SEED + size)
    steps = 3 * size
    sampled = np.zeros((REPEATS, steps), bool)
    for r in range(REPEATS):
        sampled[r, rng.choice(steps, SAMPLES, replace=False)] = True
    seeds = rng.integers(0, 2**63, (REPEATS, steps)).astype(U)
    padded = np.concatenate([windows, np.zeros((n, 1), U)], 1)
    row = np.arange(n)[None, :]
    place = np.zeros((REPEATS, n), np.int64)
    key = np.tile(np.arange(1, REPEATS + 1, dtype=U)[:, None] * U(size), (1, n))
    for j in range(steps):
        word = padded[row, place]
        now = sampled[:, j]
        if now.any():
            key[now] = tk.mix(key[now] ^ tk.mix(word[now] + U(j)))
        move = tk.mix(word ^ seeds[:, j][:, None]) >> U(63)
        place = np.minimum(place + move.astype(np.int64), size)
    return key


def passage_edits(items: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Smallest edit distance between each row's item and any passage of its region."""
    pairs, width = regions.shape
    steps = np.arange(width + 1, dtype=np.int32)
    last = np.zeros((pairs, width + 1), np.int32)
    for i in range(items.shape[1]):
        now = np.empty_like(last)
        now[:, 0] = i + 1
        np.minimum(last[:, :-1] + (regions != items[:, i:i + 1]), last[:, 1:] + 1, out=now[:, 1:])
        last = np.minimum.accumulate(now - steps, 1) + steps
    return last.min(1)


def _between(keys: np.ndarray, found: np.ndarray):
    """(position in found, position in keys) of equal values; keys sorted."""
    lo, hi = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
    n = hi - lo
    at = np.repeat(np.arange(len(found)), n)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def find(batch: pa.RecordBatch, text_at: int, items: Items, whole: int = WHOLE) -> list[tuple]:
    """(row, item number, edits, first word of the window) of all matches in a batch."""
    out, first = [], 0
    taken: dict[int, list] = {}
    for part in tk.slices([batch], (batch.schema.field(text_at).name,)):
        data, offsets = tk.text_buffer(part.column(text_at))
        _, _, doc, h, at = tk.words(data, offsets, tk.ALNUM, tk.FOLDED)
        for n, short in items.short.items():
            p = np.flatnonzero(np.isin(tk.windows(h, n), items.windows[n]))
            p = p[p + n <= at[doc[p] + 1]]
            if n < whole:
                p = p[np.diff(at)[doc[p]] == n]
            for i, d in zip(p.tolist(), doc[p].tolist()):
                for k in short.get(h[i:i + n].tobytes(), ()):
                    out.append((first + d, k, 0, i - int(at[d])))
        spots = []
        for q, (bits, grams, sizes, places) in items.grams.items():
            g = tk.windows(h, q)
            near = np.flatnonzero(bits[g & U((1 << _BITS) - 1)])
            near = near[near + q <= at[doc[near] + 1]]
            hit, which = _between(grams, g[near])
            p = near[hit]
            spots.append(np.stack([doc[p], p - places[which] - at[doc[p]], sizes[which]], 1))
        if spots:
            for n, group in _by_size(np.unique(np.concatenate(spots), axis=0)):
                k = n // EDIT_SHARE
                word = at[group[:, 0]][:, None] + group[:, 1][:, None] + np.arange(-k, n + k)[None, :]
                inside = (word >= at[group[:, 0]][:, None]) & (word < at[group[:, 0] + 1][:, None])
                region = np.where(inside, h[np.clip(word, 0, len(h) - 1)], U(0))
                taken.setdefault(n, []).append((group[:, 0] + first, group[:, 1], region))
        first += part.num_rows
    for n, groups in taken.items():
        row, start, region = (np.concatenate(x) for x in zip(*groups))
        for i in range(0, len(row), 4096):
            out += _verified(n, row[i:i + 4096], start[i:i + 4096], region[i:i + 4096], items)
    best: dict[tuple, tuple] = {}
    for row, item, edits, start in out:
        if (row, item) not in best or (edits, start) < best[row, item]:
            best[row, item] = (edits, start)
    return [(*k, *v) for k, v in best.items()]


def _by_size(spots: np.ndarray):
    order = np.argsort(spots[:, 2], kind="stable")
    spots = spots[order]
    for group in np.split(spots, np.flatnonzero(np.diff(spots[:, 2])) + 1):
        if len(group):
            yield int(group[0, 2]), group


def _verified(n, row, start, region, items: Items) -> list[tuple]:
    k = n // EDIT_SHARE
    keys = embed_keys(np.ascontiguousarray(region[:, k:k + n]))
    pairs = []
    for found, (known, members) in zip(keys, items.keys[n]):
        at, which = _between(known, found)
        pairs.append(np.stack([at, members[which]], 1))
    pairs = np.unique(np.concatenate(pairs), axis=0)
    out = []
    for i in range(0, len(pairs), 4096):
        at, item = pairs[i:i + 4096].T
        edits = passage_edits(np.stack([items.words[x] for x in item]), region[at])
        good = edits <= k
        out += zip(row[at[good]].tolist(), item[good].tolist(), edits[good].tolist(),
                   np.maximum(start[at[good]], 0).tolist())
    return out


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text"):
    """The items in blocks of bounded size, one at a time on the driver."""
    rows = benchmark.select(F.col(id_col), F.col(text_col).cast("string")).where(
        F.col(text_col).isNotNull()).distinct().toLocalIterator()
    block, words = [], 0
    for row in rows:
        block.append(tuple(row))
        words += len(row[1]) // 2 + 1
        if words >= BLOCK_WORDS:
            yield Items(block)
            block, words = [], 0
    if block:
        yield Items(block)


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id_col: str = "item_id", item_text_col: str = "text", whole: int = WHOLE) -> DataFrame:
    """doc_id, item_id, edits, start_word (where the best window begins) of every document and item that match."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("item_id", benchmark.schema[item_id_col].dataType),
                           T.StructField("edits", T.LongType()), T.StructField("start_word", T.LongType())])
    id_type = benchmark.select(item_id_col).limit(0).toArrow().schema[0].type
    ship(spark)
    out = None
    for block in item_blocks(benchmark, item_id_col, item_text_col):
        sent = spark.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            items = sent.value
            for batch in batches:
                found = sorted(find(batch, 1, items, whole))
                if found:
                    row, item, edits, start = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row)), pa.array([items.ids[i] for i in item], id_type),
                         pa.array(edits, pa.int64()), pa.array(start, pa.int64())], names=schema.names)

        some = map_arrow(source, run, schema)
        out = some if out is None else out.unionByName(some)
    return spark.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text", whole: int = WHOLE) -> DataFrame:
    """The documents in which no item matches, with all their columns; no shuffle."""
    spark = docs.sparkSession
    at = docs.columns.index(text_col)
    names = [f"c{i}" for i in range(len(docs.columns))]
    ship(spark)
    out = docs.toDF(*names)
    schema = out.schema
    for block in item_blocks(benchmark, item_id_col, item_text_col):
        sent = spark.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[m[0] for m in find(batch, at, sent.value, whole)]] = False
                yield batch.filter(pa.array(keep))

        out = map_arrow(out, run, schema)
    return out.toDF(*docs.columns)
