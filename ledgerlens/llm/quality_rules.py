"""Quality rules: fixed bounds, and an isolation forest over the rules' statistics.

The fixed rules are exact counts of whole texts.  The forest isolates texts by
random splits of random statistics, ``TREES`` trees of ``DEPTH`` levels over all texts;
a text that ends on short paths is unlike the others.  Its threshold is set
from all labelled rows: the score that costs least, where each share of the texts
labelled good that is lost costs ``GOOD_COST`` times a share of the others
missed.  Texts that fail the fixed rules count for neither.

The counts and statistics of every text are stored once (some 200 bytes a row).
The forest takes one pass over them for each level, the threshold one shuffle of
the labelled rows' scores.

Edge cases.  Null and empty texts have no words and fail the fixed rules.
Without labels of both classes the forest rejects nothing.  Rows with null or
repeated ids are judged like others; only the id and text columns are read; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from . import statistics as st, tokens as tk
from .scratch import Scratch
from .ship import map_arrow

TREES, DEPTH = 100, 8
GOOD_COST = 20.0
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
NUMBERS = tuple(f"s{i}" for i in range(len(st.SHARES)))


def planted(trees: int) -> dict[str, np.ndarray]:
    """Trees of a root each, as arrays of nodes: statistic (-1: leaf), split, children, path length at leaves; roots."""
    whole, real = np.zeros(trees, np.int64), np.zeros(trees)
    return {"feature": whole - 1, "split": real, "left": whole, "right": whole, "length": real, "roots": np.arange(trees)}


def ends(forest: dict[str, np.ndarray], root: int, x: np.ndarray) -> np.ndarray:
    """The leaf of each row in the tree below ``root``."""
    at = np.full(len(x), root)
    live = np.arange(len(x))
    while len(live):
        f = forest["feature"][at[live]]
        live = live[f >= 0]
        f = f[f >= 0]
        go = x[live, f] <= forest["split"][at[live]]
        at[live] = np.where(go, forest["left"][at[live]], forest["right"][at[live]])
    return at


def ranges(forest: dict[str, np.ndarray], root: int, x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Leaves that rows of ``x`` end in, their number of rows, and the least and greatest of each statistic."""
    at = ends(forest, root, x)
    order = np.argsort(at, kind="stable")
    nodes, first, n = np.unique(at[order], return_index=True, return_counts=True)
    sorted_x = x[order]
    return nodes, n, np.minimum.reduceat(sorted_x, first), np.maximum.reduceat(sorted_x, first)


def branched(forest: dict[str, np.ndarray], depth: int, deepest: int, rng: np.random.Generator, nodes: np.ndarray,
             n: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The forest after the leaves ``nodes`` at ``depth`` were split at random within their ranges; the new leaves."""
    forest = {k: v.copy() for k, v in forest.items()}
    forest["length"][nodes] = depth + np.array([usual(int(c)) for c in n])
    parents, new = [], len(forest["feature"])
    for i in np.argsort(nodes, kind="stable"):
        usable = np.flatnonzero(high[i] > low[i])
        if depth >= deepest or not len(usable):
            continue
        f, at = int(rng.choice(usable)), nodes[i]
        cut = float(rng.uniform(low[i, f], high[i, f]))
        if cut >= high[i, f]:  # the upper end itself was drawn
            cut = float(np.nextafter(high[i, f], low[i, f]))
        forest["feature"][at], forest["split"][at], forest["length"][at] = f, cut, 0
        forest["left"][at], forest["right"][at] = new + 2 * len(parents), new + 2 * len(parents) + 1
        parents.append(at)
    for k, blank in (("feature", -1), ("split", 0.0), ("left", 0), ("right", 0), ("length", 0.0)):
        forest[k] = np.concatenate([forest[k], np.full(2 * len(parents), blank, forest[k].dtype)])
    return forest, np.arange(new, len(forest["feature"]))


def grow(x: np.ndarray, rng: np.random.Generator, trees: int = TREES, sample: int | None = None) -> dict[str, np.ndarray]:
    """Isolation trees of rows at hand, each of all of them or of ``sample`` rows of its own."""
    size = len(x) if sample is None else min(sample, len(x))
    deepest = DEPTH if sample is None else int(np.ceil(np.log2(max(size, 2))))
    forest = planted(trees if size else 0)
    own = [x if size == len(x) else x[rng.choice(len(x), size, replace=False)] for _ in forest["roots"]]
    leaves = forest["roots"]
    for depth in range(deepest + 1):
        if not len(leaves):
            break
        met = [ranges(forest, root, rows) for root, rows in zip(forest["roots"], own)]
        nodes, n, low, high = (np.concatenate(part) for part in zip(*met))
        keep = np.isin(nodes, leaves)
        forest, leaves = branched(forest, depth, deepest, rng, nodes[keep], n[keep], low[keep], high[keep])
    return forest | {"usual": np.array([usual(size)])}


def usual(n: int) -> float:
    """Mean path length of a failed search among n."""
    if n < 2:
        return 0.0
    return 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def anomaly(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Score of each row: 2 ** -(mean path length / usual one); 0.5 without trees."""
    if not len(forest["roots"]) or not forest["usual"][0]:
        return np.full(len(x), 0.5)
    total = np.zeros(len(x))
    for root in forest["roots"]:
        total += forest["length"][ends(forest, root, x)]
    return 2.0 ** -(total / len(forest["roots"]) / forest["usual"][0])


def threshold(marked: DataFrame, scratch: Scratch, good_cost: float = GOOD_COST) -> float:
    """The score above which texts are rejected at the least cost; 1 if nothing is worth rejecting.

    ``marked``: score and y (1 good, 0 bad) of all labelled texts.  Running counts of
    score ranges, one range a task; the driver sees one row a range.
    """
    each = marked.groupBy("score").agg(F.count_if(F.col("y") == 1).alias("good"), F.count_if(F.col("y") == 0).alias("bad"))
    each = scratch.write(each.repartitionByRange("score").withColumn("part", F.spark_partition_id()), "scores")
    parts = each.groupBy("part").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy("part").collect()
    n_good, n_bad = (sum(p[k] for p in parts) for k in ("good", "bad"))
    if not n_good or not n_bad:
        return 1.0
    before, sums = [], [0, 0]
    for p in parts:
        before.append((p.part, *sums))
        sums = [sums[0] + p.good, sums[1] + p.bad]
    start = marked.sparkSession.createDataFrame(before, "part int, good0 long, bad0 long")
    so_far = Window.partitionBy("part").orderBy("score")
    lost = 1 - (F.col("good0") + F.sum("good").over(so_far)) / n_good
    missed = (F.col("bad0") + F.sum("bad").over(so_far)) / n_bad
    costs = each.join(F.broadcast(start), "part").select((good_cost * lost + missed).alias("cost"), "score")  # a row a range
    best = costs.agg(F.min(F.struct("cost", "score")).alias("b")).first().b
    return float(best.score) if best.cost <= 1 else 1.0


def base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a hash of the text, the counts, base_failed and the statistics (s0, s1, ...) of every document."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("h"),
                         F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([*source.schema.fields[:2], *(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("base_failed", T.BooleanType()),
                           *(T.StructField(n, T.DoubleType()) for n in NUMBERS)])

    def run(batches):
        for part in tk.slices(batches):
            c = st.counts(part.column(2))
            x = st.shares(c)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *(pa.array(c[k].astype(np.int64)) for k in COUNTS), pa.array(base_failed(c)),
                 *(pa.array(x[:, i]) for i in range(x.shape[1]))], names=schema.names)

    return map_arrow(source, run, schema)


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(n).to_numpy() for n in NUMBERS], 1)


def grown(rows: DataFrame, trees: int = TREES, deepest: int = DEPTH) -> dict[str, np.ndarray]:
    """The forest over all ``rows``, every tree over every row: one pass a level.

    A task sends the ranges of each leaf it met, the driver draws the splits: at most
    trees x 2 ** level rows whatever the number of texts.
    """
    size, rng = rows.count(), np.random.default_rng(1)
    forest = planted(trees if size else 0)
    leaves, k = forest["roots"], len(NUMBERS)
    ends_of = [f"{e}{i}" for e in ("low", "high") for i in range(k)]
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("n", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ends_of)])
    for depth in range(deepest + 1):
        if not len(leaves):
            break

        def run(batches, forest=forest, first=int(leaves[0]), many=len(leaves)):
            n, low, high = np.zeros(many, np.int64), np.full((many, k), np.inf), np.full((many, k), -np.inf)
            for batch in batches:
                x = matrix(batch)
                for root in forest["roots"] if len(x) else ():
                    nodes, c, lows, highs = ranges(forest, root, x)
                    own = nodes >= first
                    at = nodes[own] - first
                    n[at] += c[own]
                    low[at], high[at] = np.minimum(low[at], lows[own]), np.maximum(high[at], highs[own])
            met = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(met + first), pa.array(n[met]), *(pa.array(a[met, i]) for a in (low, high) for i in range(k))],
                                             names=schema.names)

        met = map_arrow(rows, run, schema).groupBy("node").agg(
            F.sum("n").alias("n"), *(F.min(c).alias(c) if c.startswith("low") else F.max(c).alias(c) for c in ends_of)).toArrow()
        low, high = (np.stack([met.column(f"{e}{i}").to_numpy() for i in range(k)], 1) for e in ("low", "high"))
        forest, leaves = branched(forest, depth, deepest, rng, met.column("node").to_numpy(), met.column("n").to_numpy(), low, high)
    return forest | {"usual": np.array([usual(size)])}


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        good_cost: float = GOOD_COST) -> dict:
    """The forest over all documents and its threshold over all labelled ones."""
    scratch = Scratch(docs.sparkSession, "quality-rules")
    return fit_measured(scratch.write(measured(docs, id_col, text_col), "measured"), labels, label, id_col, good_cost, scratch)


def fit_measured(rows: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", good_cost: float = GOOD_COST,
                 scratch: Scratch | None = None) -> dict:
    """``fit`` on a stored table of ``measured`` documents."""
    scratch = scratch or Scratch(rows.sparkSession, "quality-rules")
    forest = grown(rows.where("not base_failed").select(*NUMBERS))
    marks = (labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("y"))
             .where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y")))
    # an id counts once, with the text of the smallest hash
    one = scored(rows, forest).join(marks, "doc_id").groupBy("doc_id").agg(F.min(F.struct("h", "base_failed", "anomaly", "y")).alias("r"))
    bound = threshold(one.where("not r.base_failed").select(F.col("r.anomaly").alias("score"), "r.y"), scratch, good_cost)
    return {"forest": forest, "bound": bound}


def scored(rows: DataFrame, forest: dict[str, np.ndarray]) -> DataFrame:
    """``measured`` documents with their anomaly in place of the statistics."""
    schema = T.StructType([*(f for f in rows.schema.fields if f.name not in NUMBERS), T.StructField("anomaly", T.DoubleType())])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in schema.names[:-1]), pa.array(anomaly(forest, matrix(batch)))], names=schema.names)

    return map_arrow(rows, run, schema)


def judged(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed, kept and anomaly of every document."""
    return judged_measured(measured(docs, id_col, text_col), model)


def judged_measured(rows: DataFrame, model: dict) -> DataFrame:
    """``judged`` on a table of ``measured`` documents."""
    kept = ~F.col("base_failed") & (F.col("anomaly") <= model["bound"])
    return scored(rows, model["forest"]).select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "anomaly")
