"""Quality by a sparse rule ensemble over text statistics.

Small trees are grown on the statistics of labelled texts; every path from a
root to a node becomes a rule, a conjunction of bounds on statistics; a
logistic regression with an L1 penalty weighs the rules and leaves most at
zero; and what is left is compiled into one Spark column expression, a sum of
weighted CASE terms.  Trees and regression are Spark ML's.

Fitting takes up to ``ROWS_PER_CLASS`` labelled texts of each class, by the
order of a hash of the id (the bound is the parameter); the intercept takes
the sample's class shares back.  Scoring reads every whole text once.

Edge cases.  Null and empty texts have statistics of zero and are scored by
them.  Without labels of both classes the score is the label's share (0
without labels).  Rows with null or repeated ids are scored like others; only
the id and text columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import labelled, statistics as st, tokens as tk
from .scratch import Scratch
from .ship import map_arrow

ROWS_PER_CLASS = 6000
TREES, DEPTH = 12, 4
PENALTY = 0.001
THRESHOLD = 0.3

#: A rule: bounds (statistic, is upper bound, value) that all hold.
Rule = tuple[tuple[int, bool, float], ...]


def with_statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns of ``keep`` (renamed k0, k1, ...) and the statistics of each text, named s0, s1, ..."""
    source = docs.select(F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)))
    names = [f"s{i}" for i in range(len(st.SHARES))]
    schema = T.StructType([*source.schema.fields[1:], *(T.StructField(n, T.DoubleType()) for n in names)])

    def run(batches):
        for part in tk.slices(batches):
            x = st.shares(st.counts(part.column(0)))
            yield pa.RecordBatch.from_arrays([*part.columns[1:], *(pa.array(x[:, i]) for i in range(x.shape[1]))], names=schema.names)

    return map_arrow(source, run, schema)


def tree_rules(text: str) -> set[Rule]:
    """Paths to all nodes of a tree as Spark ML prints it."""
    out, path = set(), []
    for line in text.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            depth = len(m[1])
            path = [p for p in path if p[0] < depth] + [(depth, (int(m[2]), m[3] == "<=", float(m[4])))]
            out.add(_tight([p[1] for p in path]))
    return out


def _tight(bounds) -> Rule:
    """One bound of each side of a statistic: the narrowest."""
    best: dict[tuple[int, bool], float] = {}
    for f, upper, v in bounds:
        old = best.get((f, upper))
        best[f, upper] = v if old is None else min(old, v) if upper else max(old, v)
    return tuple(sorted((f, u, v) for (f, u), v in best.items()))


def condition(rule: Rule) -> Column:
    out = None
    for f, upper, v in rule:
        one = F.col(f"s{f}") <= v if upper else F.col(f"s{f}") > v
        out = one if out is None else out & one
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 5, left_out: int = 0,
        rows_per_class: int = ROWS_PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Rules with weights and an intercept, learnt from labelled rows whose fold is not ``left_out``."""
    picked, sizes = labelled.sample(docs, labels, label, parts, left_out, rows_per_class, id_col, text_col)
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total if total else 0.0
    scratch = Scratch(docs.sparkSession, "quality")
    # bounded: at most 2 x rows_per_class rows of numbers, in a few partitions and one order
    data = scratch.write(with_statistics(picked, ["y", "id"]).orderBy(F.xxhash64("k1"), "k1").coalesce(4), "sample")
    classes = [r.k0 for r in data.groupBy("k0").count().collect()]
    if len(classes) < 2:
        return {"rules": [], "base": None, "share": share}
    data = data.withColumn("label", F.col("k0").cast("double"))
    vector = VectorAssembler(inputCols=[f"s{i}" for i in range(len(st.SHARES))], outputCol="x").transform(data)
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=1, featureSubsetStrategy="0.5").fit(vector)
    rules = sorted(set().union(*(tree_rules(t.toDebugString) for t in forest.trees)))
    if not rules:
        return {"rules": [], "base": None, "share": share}
    hits = data.select("label", *(condition(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)))
    rows = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="x").transform(hits)
    lasso = LogisticRegression(featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=PENALTY, maxIter=60).fit(rows)
    taken = [min(sizes[y], rows_per_class) for y in (0, 1)]
    shift = math.log(sizes[1] / sizes[0]) - math.log(taken[1] / taken[0])
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w]
    return {"rules": kept, "base": float(lasso.intercept) + shift, "share": share}


def expression(model: dict) -> Column:
    """The score as a column expression over the statistics s0, s1, ..."""
    if model["base"] is None:
        return F.lit(float(model["share"]))
    total = F.lit(model["base"])
    for rule, w in model["rules"]:
        total = total + F.when(condition(rule), w).otherwise(0.0)
    return 1 / (1 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), total))))


def scored(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every document."""
    return with_statistics(docs, [id_col], text_col).select(F.col("k0").alias("doc_id"), expression(model).alias("score"))
