"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of ASCII letters, digits and bytes from 0x80 up, with A-Z
lower-cased.  A text's features are its distinct words, word pairs, and pairs
over one or two words between, hashed to ``DIMS`` coordinates.  Follow the
regularised leader keeps z and n per coordinate: the learning rate falls with
a coordinate's own gradients, and coordinates whose |z| stays within the L1
bound weigh nothing, so that the model that is sent to the executors is a
short list of (coordinate, weight).

Fitting takes up to ``ROWS_PER_CLASS`` labelled texts of each class, by the
order of a hash of the id, in one task (the bound is the parameter); the
difference between the classes' shares in the sample and among all labels is
taken back in the intercept, so that scores are probabilities.  Scoring reads
every whole text once, without a shuffle.

Edge cases.  Null and empty texts have no features: their score is that of
the intercept.  Without labels of both classes the score is the label's share
(0 without labels).  Rows with null or repeated ids are scored like others.
Only the id and text columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import labelled, tokens as tk
from .ship import map_arrow

U = np.uint64
BITS = 20
ROWS_PER_CLASS = 6000
EPOCHS = 6
#: Longer words also count by so many first bytes, which stand in for words that training didn't meet.
STEMS = (4, 5, 6)
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.0
THRESHOLD = 0.7


def features(column, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct (row, coordinate) of the texts, by row; only coordinates in ``known`` if given; number of rows."""
    data, offsets = tk.text_buffer(column)
    starts, ends, doc, h, _ = tk.words(data, offsets, tk.ALNUM, tk.FOLDED)
    rows, found = [], []
    for k in STEMS:
        long = np.flatnonzero(ends - starts > k)
        coord = (tk.mix(tk.span_hashes(data, starts[long], starts[long] + k, tk.FOLDED) + U(1)) >> U(64 - BITS)).astype(np.int64)
        good = slice(None) if known is None else known[coord]
        rows.append(doc[long][good])
        found.append(coord[good])
    for gap in range(4):  # 0: the words themselves; 1: neighbours; 2 and 3: over one and two words
        n = max(0, len(h) - gap)
        code = tk.mix(h + U(0)) if gap == 0 else tk.mix(h[:n] * U(0x9E3779B97F4A7C15) + tk.mix(h[gap:gap + n] + U(gap)))
        coord = (code >> U(64 - BITS)).astype(np.int64)
        good = np.ones(n, bool) if gap == 0 else doc[:n] == doc[gap:gap + n]
        if known is not None:
            good &= known[coord]
        rows.append(doc[:n][good])
        found.append(coord[good])
    key = np.unique((np.concatenate(rows).astype(np.int64) << BITS) | np.concatenate(found))
    return key >> BITS, key & ((1 << BITS) - 1), len(offsets) - 1


def ftrl(rows: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, weights, intercept) after ``epochs`` passes over the rows in the given order."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    intercept = 1 << BITS  # its own coordinate, without the L1 bound

    def weights(at):
        bound = np.where(at == intercept, 0.0, L1)
        return np.where(np.abs(z[at]) <= bound, 0.0,
                        -(z[at] - np.sign(z[at]) * bound) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for at, label in zip(rows, y):
            at = np.append(at, intercept)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    at = np.flatnonzero(np.abs(z[:-1]) > L1)
    return at, weights(at), float(weights(np.array([intercept]))[0])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 3, left_out: int = 1,
        rows_per_class: int = ROWS_PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Weights of the model, learnt from labelled rows whose fold is not ``left_out``."""
    picked, sizes = labelled.sample(docs, labels, label, parts, left_out, rows_per_class, id_col, text_col)
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total if total else 0.0
    if len(sizes) < 2:
        return {"at": np.zeros(0, np.int64), "w": np.zeros(0), "base": None, "share": share}
    schema = T.StructType([T.StructField("at", T.ArrayType(T.LongType())), T.StructField("w", T.ArrayType(T.DoubleType())),
                           T.StructField("base", T.DoubleType())])

    def run(batches):
        rows, y, order = [], [], []
        for part in tk.slices(batches):
            row, coord, n = features(part.column(part.schema.get_field_index("text")))
            cut = tk.offsets_of(row, n)
            rows += [coord[cut[i]:cut[i + 1]].astype(np.int32) for i in range(n)]
            y += part.column(part.schema.get_field_index("y")).to_pylist()
            order += part.column(part.schema.get_field_index("h")).to_pylist()
        if rows:
            order = np.argsort(np.array(order), kind="stable")
            at, w, base = ftrl([rows[i] for i in order], np.array(y, float)[order])
            yield pa.RecordBatch.from_pylist([{"at": at.tolist(), "w": w.tolist(), "base": base}], schema=pa.schema(
                [("at", pa.list_(pa.int64())), ("w", pa.list_(pa.float64())), ("base", pa.float64())]))

    # one task, of at most 2 x rows_per_class texts
    found = map_arrow(picked.select("y", "text", F.xxhash64(F.col("id").cast("string"), F.lit(1)).alias("h")).repartition(1), run, schema).collect()
    if not found:
        return {"at": np.zeros(0, np.int64), "w": np.zeros(0), "base": None, "share": share}
    taken = [min(sizes[y], rows_per_class) for y in (0, 1)]
    shift = np.log(sizes[1] / sizes[0]) - np.log(taken[1] / taken[0])
    return {"at": np.array(found[0]["at"], np.int64), "w": np.array(found[0]["w"]), "base": found[0]["base"] + shift, "share": share}


def scorer(model: dict):
    """A function from a text column to its scores."""
    known = np.zeros(1 << BITS, bool)
    known[model["at"]] = True

    def score(column) -> np.ndarray:
        if model["base"] is None:
            return np.full(len(column), model["share"])
        row, coord, n = features(column, known)
        w = model["w"][np.searchsorted(model["at"], coord)] if len(coord) else np.zeros(0)
        total = model["base"] + np.bincount(row, weights=w, minlength=n)
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))

    return score


def scored(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every document."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches):
        score = scorer(model)
        for part in tk.slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score(part.column(1)))], names=["doc_id", "score"])

    return map_arrow(source, run, schema)


def accepted(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    at = docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def run(batches):
        score = scorer(model)
        for part in tk.slices(batches, (f"c{at}",)):
            yield part.filter(pa.array(score(part.column(at)) < threshold))

    return map_arrow(plain, run, plain.schema).toDF(*docs.columns)
