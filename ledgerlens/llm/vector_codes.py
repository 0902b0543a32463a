"""Product-quantised vector codes by dual-tree Lloyd iterations, in exact integers.

Each component x becomes floor(1024 x); a vector is cut into equal consecutive
parts, and each part position has a codebook, which starts as that part of the
vectors with the smallest ids.  A round assigns every part to its nearest entry
(squared distance, the lower index of equals) and moves each entry to the
floored mean of its parts; unused entries stay.

The rows are written once, in blocks of up to ``BLOCK`` vectors; for each part
position a block holds a median-split tree of its parts: their order, and the
bounding box and sum of each leaf.  A round reads the blocks, and walks each
tree against a tree of the codebook's entries, level by level: a pair of nodes
goes when the boxes' least distance exceeds the greatest distance to another
entry node, and a single entry goes when another is nearer all over the box.  A
node left with one entry adds its cached sum as a whole; in leaves in doubt
every part is compared with the entries left.  Each task returns one sum and
count for each entry at most; Spark adds them up.

Edge cases.  Rows with null vectors, or with null or non-finite components,
are dropped.  Null ids come after all others where the start is chosen; rows
with equal ids start in the order of their vectors, and each row gets its own
code.  With fewer rows than entries there are as many entries as rows; an empty
table gives an empty result.  Null labels count as one label.  Only the id,
vector and label columns are read.  Refused: vectors of different lengths or a
length that the parts don't divide, components of 2^17 or more (the squared
distances would leave 64 bits), and more than 256 entries (two hex digits).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .scratch import Scratch
from .ship import map_arrow

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Vectors of a block, and parts of a leaf (up to twice as many).
BLOCK, LEAF = 8192, 16
#: Cells of a distance table at most (a leaf is never split).
_CELLS = 1 << 20
_LARGEST = 1 << 27
#: Share of pairs kept by a level from which on the walk goes straight to the leaves.
LITTLE = 0.75
#: Labels with more than this share of the rows are broadcast: fewer than 1 / share of them.
HEAVY = 0.001


def borders(n: int, level: int) -> np.ndarray:
    """First row of each of the 2^level nodes of a level, and n."""
    return (np.arange((1 << level) + 1, dtype=np.int64) * n) >> level


class Tree:
    """Median-split tree over rows of integers.

    order: row numbers as the tree has them; rows: the rows in that order;
    low, high, total: box and sum of the nodes of each level.
    """

    def __init__(self, rows: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, total: np.ndarray):
        self.rows, self.order, self.n = rows, order, len(rows)
        self.depth = len(low).bit_length() - 1
        self.low, self.high, self.total = [low], [high], [total]
        for _ in range(self.depth):
            self.low.insert(0, np.minimum(self.low[0][::2], self.low[0][1::2]))
            self.high.insert(0, np.maximum(self.high[0][::2], self.high[0][1::2]))
            self.total.insert(0, self.total[0][::2] + self.total[0][1::2])
        self.borders = [borders(self.n, level) for level in range(self.depth + 1)]


def grown(points: np.ndarray, leaf: int) -> Tree:
    """Tree of at least one point, with ``leaf`` to 2 x ``leaf`` - 1 points in each leaf (all, if fewer)."""
    n = len(points)
    depth = max(1, n // leaf).bit_length() - 1
    order = np.arange(n)
    for level in range(depth):
        at = borders(n, level)
        own = points[order]
        widest = (np.maximum.reduceat(own, at[:-1]) - np.minimum.reduceat(own, at[:-1])).argmax(1)
        node = np.repeat(np.arange(1 << level), np.diff(at))
        order = order[np.lexsort((own[np.arange(n), widest[node]], node))]
    rows, at = points[order], borders(n, depth)[:-1]
    return Tree(rows, order, np.minimum.reduceat(rows, at), np.maximum.reduceat(rows, at), np.add.reduceat(rows, at))


def _starts(group: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))


def _expanded(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of ``size`` numbers from ``first`` on: which run, and the number."""
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + first[which]


def walk(tree: Tree, book: Tree) -> tuple[list, np.ndarray, np.ndarray]:
    """(level, nodes, entries) lists of nodes that belong to one entry, and the rows in doubt with their entries."""
    node = other = np.zeros(1, np.int64)
    p = e = 0
    single = False  # whether ``other`` are entries, no longer nodes of the book
    whole = []
    while True:
        low, high = tree.low[p][node], tree.high[p][node]
        e_low, e_high = (book.rows[other], book.rows[other]) if single else (book.low[e][other], book.high[e][other])
        least = np.maximum(np.maximum(e_low - high, low - e_high), 0)
        most = np.maximum(e_high - low, high - e_low)
        least, most = (least * least).sum(1), (most * most).sum(1)
        at = _starts(node)
        group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(node))))
        bound = np.minimum.reduceat(most, at)
        keep = least <= bound[group]
        if single:
            near = np.flatnonzero(most == bound[group])
            pivot = other[near[_starts(group[near])]][group]
            a, b = book.rows[pivot], e_low
            step = 2 * (b - a)
            # the greatest lead, over the box, of the pivot's distance on the entry's
            lead = (np.where(step > 0, step * high, step * low) + a * a - b * b).sum(1)
            keep &= (lead > 0) | ((lead == 0) & (book.order[pivot] >= book.order[other]))
        # where a level's bounds prune little, those of the levels between it and the leaves would, too
        steps = tree.depth - p if single and keep.mean() > LITTLE else min(1, tree.depth - p)
        node, other = node[keep], other[keep]
        at = _starts(node)
        size = np.diff(np.append(at, len(node)))
        if single:
            sure = size == 1
            whole.append((p, node[at[sure]], book.order[other[at[sure]]]))
            rest = np.repeat(~sure, size)
            node, other = node[rest], other[rest]
        if not len(node) or single and p == tree.depth:
            break
        if not single:
            if e < book.depth:
                node, other, e = np.repeat(node, 2), np.repeat(other * 2, 2), e + 1
                other[1::2] += 1
            else:
                edge = book.borders[e]
                which, other = _expanded(edge[other], np.diff(edge)[other])
                node, single = node[which], True
        for _ in range(steps):
            at = _starts(node)
            size = np.diff(np.append(at, len(node)))
            which, place = _expanded(np.repeat(at, 2), np.repeat(size, 2))
            node, other, p = np.repeat(node[at] * 2, 2)[which] + which % 2, other[place], p + 1
    if not len(node):
        none = np.zeros(0, np.int64)
        return whole, none, none
    # by leaf, entries by index: the first of equal distances is the lower index
    other = book.order[other]
    order = np.lexsort((other, node))
    node, other = node[order], other[order]
    entries = np.empty_like(book.rows)
    entries[book.order] = book.rows
    # |x - e|^2 - |x|^2 = |e|^2 - 2 x e; in doubles it is exact as long as no sum of products leaves 53 bits
    width = entries.shape[1]
    largest = max(int(np.abs(x).max()) for x in (tree.low[0], tree.high[0], entries))
    kind = np.float64 if 4 * width * (largest + 1) ** 2 < 1 << 53 else np.int64
    rows, entries = tree.rows.astype(kind), entries.astype(kind)
    square = (entries * entries).sum(1)
    edge = tree.borders[tree.depth]
    wide = int(np.diff(edge).max())
    at = _starts(node)
    size = np.diff(np.append(at, len(node)))
    found_rows, found_entries = [], []
    # leaves with about as many entries left go together, the shorter lists padded by their last entry
    by_size = np.argsort(size, kind="stable")
    i = 0
    while i < len(by_size):
        j = i + 1
        while j < len(by_size) and size[by_size[j]] <= size[by_size[i]] * 1.25 + 4 and (j + 1 - i) * wide * size[by_size[j]] <= _CELLS:
            j += 1
        own = by_size[i:j]
        leaves = node[at[own]]
        row = np.minimum(edge[leaves][:, None] + np.arange(wide), edge[leaves + 1][:, None] - 1)
        left = other[at[own][:, None] + np.minimum(np.arange(size[own].max()), size[own][:, None] - 1)]
        gap = square[left][:, None, :] - 2 * np.matmul(rows[row], entries[left].transpose(0, 2, 1))
        index = np.take_along_axis(left, gap.argmin(2), 1)
        real = np.arange(wide) < np.diff(edge)[leaves][:, None]
        found_rows.append(row[real])
        found_entries.append(index[real])
        i = j
    return whole, np.concatenate(found_rows), np.concatenate(found_entries)


def moved(tree: Tree, book: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of the points that belong to each entry."""
    count, total = np.zeros(book.n, np.int64), np.zeros(book.rows.shape, np.int64)
    whole, row, entry = walk(tree, book)
    for level, node, own in whole:
        np.add.at(count, own, np.diff(tree.borders[level])[node])
        np.add.at(total, own, tree.total[level][node])
    np.add.at(count, entry, 1)
    np.add.at(total, entry, tree.rows[row])
    return count, total


def assigned(tree: Tree, book: Tree) -> np.ndarray:
    """Entry of each point, in the order of the points that the tree was grown from."""
    out = np.zeros(tree.n, np.int64)
    whole, row, entry = walk(tree, book)
    out[row] = entry
    for level, node, own in whole:
        edge = tree.borders[level]
        which, place = _expanded(edge[node], np.diff(edge)[node])
        out[place] = own[which]
    back = np.empty_like(out)
    back[tree.order] = out
    return back


_BLOCK_COLUMNS = ["order", "points", "low", "high", "total"]


def _packed(points: np.ndarray, parts: int) -> list[bytes]:
    """The trees of a block, a value for each of the block columns."""
    trees = [grown(x, LEAF) for x in np.split(points, parts, axis=1)]
    columns = ([t.order for t in trees], [t.rows for t in trees], [t.low[-1] for t in trees], [t.high[-1] for t in trees],
               [t.total[-1] for t in trees])
    return [np.stack(x).astype(np.int64 if name == "total" else np.int32).tobytes() for name, x in zip(_BLOCK_COLUMNS, columns)]


def _unpacked(values: list[bytes], n: int, parts: int) -> list[Tree]:
    order, points, low, high, total = (
        np.frombuffer(v, np.int64 if name == "total" else np.int32).astype(np.int64) for name, v in zip(_BLOCK_COLUMNS, values))
    width = len(points) // (n * parts)
    shaped = (x.reshape(parts, -1, width) for x in (points, low, high, total))
    return [Tree(r, o, a, b, s) for r, o, a, b, s in zip(next(shaped), order.reshape(parts, n), *shaped)]


def kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, vector (doubles), label of the rows whose vectors are whole and finite."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    # to Spark NaN is above infinity
    return rows.where(F.col("vector").isNotNull() & F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))


def _integers(column, width: int) -> np.ndarray:
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if (sizes != width).any():
        raise ValueError(f"vectors of {sorted(set(sizes.tolist()))[:3]} components among those of {width}")
    whole = np.floor(flat * SCALE)
    if (np.abs(whole) >= _LARGEST).any():
        raise ValueError("a component is too large for exact distances in 64 bits")
    return whole.astype(np.int64).reshape(-1, width)


def _blocks(rows: DataFrame, width: int, parts: int, block: int) -> DataFrame:
    """One row for each block: its ids, labels and trees."""
    schema = T.StructType([T.StructField("ids", T.ArrayType(rows.schema["vec_id"].dataType)),
                           T.StructField("labels", T.ArrayType(rows.schema["label"].dataType)),
                           *(T.StructField(c, T.BinaryType()) for c in _BLOCK_COLUMNS)])

    def one(table: pa.Table):
        ids, vectors, labels = (table.column(c).combine_chunks() for c in ("vec_id", "vector", "label"))
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, labels)]
        packed = [pa.array([v], pa.binary()) for v in _packed(_integers(vectors, width), parts)]
        return pa.RecordBatch.from_arrays([*lists, *packed], names=schema.names)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                piece = batch.slice(0, block - n)
                held.append(piece)
                n += piece.num_rows
                batch = batch.slice(piece.num_rows)
                if n == block:
                    yield one(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield one(pa.Table.from_batches(held))

    return map_arrow(rows, run, schema)


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round; ``books``: parts x entries x width."""
    parts, entries, width = books.shape
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()), T.StructField("n", T.LongType()),
                           *(T.StructField(f"s{i}", T.LongType()) for i in range(width))])

    def run(batches):
        trees = [grown(b, 1) for b in books]
        count, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                for i, tree in enumerate(_unpacked([row[c] for c in _BLOCK_COLUMNS], row["n"], parts)):
                    more, sums = moved(tree, trees[i])
                    count[i] += more
                    total[i] += sums
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
             *(pa.array(total[part, entry, i]) for i in range(width))], names=schema.names)

    sums = (map_arrow(blocks.select(F.size("ids").alias("n"), *_BLOCK_COLUMNS), run, schema).groupBy("part", "entry")
            .agg(F.sum("n").alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(width))))
    out = books.copy()
    for part, entry, n, *s in sums.collect():  # parts x entries rows at most
        out[part, entry] = [x // n for x in s]
    return out


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK, id_col: str = "vec_id",
        vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray] | None:
    """The written blocks of all rows and the codebooks (parts x entries x width); None without rows."""
    if entries > 256:
        raise ValueError("codes have two hex digits: up to 256 entries")
    rows = kept(vectors, id_col, vector_col, label_col)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    if not first.num_rows:
        return None
    column = first.column("vector").combine_chunks()
    width = len(column[0])
    if not width or width % parts:
        raise ValueError(f"{parts} parts don't divide {width} components")
    books = np.stack(np.split(_integers(column, width), parts, axis=1))
    blocks = Scratch(vectors.sparkSession, "vector-codes").write(_blocks(rows, width, parts, block), "blocks")
    for _ in range(rounds):
        books = _round(blocks, books)
    return blocks, books


def coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hex digits for each part), error (squared distance to the coded vector) of every row."""
    parts = len(books)
    schema = T.StructType([T.StructField("vec_id", blocks.schema["ids"].dataType.elementType),
                           T.StructField("label", blocks.schema["labels"].dataType.elementType),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches):
        trees = [grown(b, 1) for b in books]
        for batch in batches:
            for k in range(batch.num_rows):
                ids, labels = (batch.column(i).slice(k, 1).flatten() for i in (0, 1))
                values = [batch.column(2 + i)[k].as_py() for i in range(len(_BLOCK_COLUMNS))]
                codes, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                for i, tree in enumerate(_unpacked(values, len(ids), parts)):
                    entry = assigned(tree, trees[i])
                    codes[:, i] = entry
                    error[tree.order] += ((tree.rows - books[i][entry[tree.order]]) ** 2).sum(1)
                text = codes.tobytes().hex()
                step = 2 * parts
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array([text[j:j + step] for j in range(0, len(text), step)], pa.string()), pa.array(error)], names=schema.names)

    return map_arrow(blocks, run, schema)


def with_label_error(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` with label_error: error summed over equal labels, nulls together.

    Labels with more than ``HEAVY`` of the rows are broadcast, at most 1 /
    HEAVY of them; the others' rows are joined by shuffle, where no label has
    more than that share.
    """
    sums = scratch.write(rows.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"), F.count("*").alias("rows")), "labels")
    total = sums.agg(F.sum("rows")).first()[0] or 0
    heavy, light = (sums.where(c).drop("rows") for c in (F.col("rows") > HEAVY * total, F.col("rows") <= HEAVY * total))
    same = F.col("label").eqNullSafe(F.col("l"))
    return (rows.join(F.broadcast(heavy), same).drop("l")
            .unionByName(rows.join(F.broadcast(heavy.select("l")), same, "left_anti").join(light, same).drop("l")))


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' integers by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
