"""Fitted ML features: FT3 random Fourier, FT4/FT5 KMeans, FT6 PCA.

The fitted state (RFF weights, centroids, loadings) is small and kept on the
driver.  Random Fourier features are column expressions.  Distances and
projections over many columns run in Arrow tasks, a batch of rows at a time as
one matrix (lambdas over arrays are interpreted value by value).
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import number
from ..session import write_stage
from .lookup import DEFAULT_BROADCAST_BYTES, Lookup

# Fixed values of the reference's feature set.
RFF_GAMMAS = (0.1, 0.5, 1.0, 5.0)
RFF_COMPONENTS = 5
KMEANS_KS = (3, 5, 8)
KMEANS_RESTARTS = 10
PCA_MAX_COMPONENTS = 10
CACHED_BYTES = 8 << 30   # of all fits that run at a time
SEED = 42

# the tasks' functions go to the workers whole: there this package need not be installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# FT3 ---------------------------------------------------------------------

@dataclass
class RandomFourier:
    """``sqrt(2/D) * cos(x W + b)`` with ``W ~ N(0, 2 gamma)``, ``b ~ U(0, 2 pi)``."""

    cols: list[str]
    gamma: float
    weights: np.ndarray   # (n_features, D)
    offsets: np.ndarray   # (D,)

    def columns(self) -> list[Column]:
        d = self.weights.shape[1]
        amp = math.sqrt(2.0 / d)
        out = []
        for j in range(d):
            z = F.lit(float(self.offsets[j]))
            for i, c in enumerate(self.cols):
                z = z + F.col(c).cast("double") * F.lit(float(self.weights[i, j]))
            out.append(F.lit(amp) * F.cos(z))
        return out

    def exprs(self, prefix: str) -> list[Column]:
        return [c.alias(f"{prefix}{j}") for j, c in enumerate(self.columns())]


def fit_random_fourier(cols: Sequence[str], gamma: float, n_components: int = RFF_COMPONENTS,
                       seed: int = SEED) -> RandomFourier:
    """Draws in the order of the public RBF sampler: normal weights, then offsets."""
    rng = np.random.RandomState(seed)
    w = math.sqrt(2 * gamma) * rng.normal(size=(len(cols), n_components))
    b = rng.uniform(0, 2 * np.pi, size=n_components)
    return RandomFourier(list(cols), gamma, w, b)


# shared helpers ------------------------------------------------------------

def assemble(df: DataFrame, cols: Sequence[str], out: str = "_features",
             keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns plus one DOUBLE vector of ``cols`` (nulls kept as NaN)."""
    casted = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid="keep").transform(casted).select(*keep, out)


def _matrix(lists: pa.ListArray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows x ``d`` of an array column (null as NaN), and which of its cells are null."""
    flat = lists.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, d), flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, d)


def _inputs(cols: Sequence[str]) -> Column:
    """One array of the inputs as numbers; NaN counts as null."""
    return F.array(*[number(c) for c in cols])


def _as_matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Rows x columns of a batch of doubles (null as NaN)."""
    return np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1) if batch.num_columns else np.empty((0, 0))


def _sums(df: DataFrame, cols: Sequence[str], of_batch: Callable[[np.ndarray], list], merge: Callable[[list, list], list]) -> list | None:
    """``of_batch`` of the matrix of every batch of rows, merged in each Arrow task and then in the tasks' order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for b in batches:
            if b.num_rows:
                own = of_batch(_as_matrix(b))
                total = own if total is None else merge(total, own)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              "sums": pa.array([[np.ascontiguousarray(v, float).tobytes() for v in total]], pa.list_(pa.binary()))})

    found = df.select(*[number(c).alias(f"_{i}") for i, c in enumerate(cols)]).mapInArrow(run, "part int, sums array<binary>").collect()
    out = None
    for r in sorted(found, key=lambda r: r.part):
        own = [np.frombuffer(v).copy() for v in r.sums]
        out = own if out is None else merge(out, own)
    return out


def _moments(df: DataFrame, cols: Sequence[str]) -> list[np.ndarray]:
    """Count, mean and sum of squared deviations of every column's numbers, in one pass."""
    def of_batch(x: np.ndarray) -> list:
        there = ~np.isnan(x)
        n = there.sum(0).astype(float)
        with np.errstate(all="ignore"):
            gap = x - x[there.argmax(0), np.arange(x.shape[1])]   # a constant's deviations are exactly 0
            shift = np.where(n > 0, np.nansum(gap, 0) / n, 0.0)
            return [n, np.where(n > 0, x[there.argmax(0), np.arange(x.shape[1])] + shift, 0.0), np.nansum((gap - shift) ** 2, 0)]

    def merge(a: list, b: list) -> list:
        n = a[0] + b[0]
        with np.errstate(all="ignore"):
            share = np.where(n > 0, b[0] / n, 0.0)
            gap = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
            mean = np.where(a[0] > 0, a[1] + gap * share, b[1])
            return [n, mean, a[2] + b[2] + gap * gap * a[0] * share]

    found = _sums(df, cols, of_batch, merge)
    return found if found is not None else [np.zeros(len(cols)) for _ in range(3)]


def standardize_exprs(df: DataFrame, cols: Sequence[str], with_raw: bool = False):
    """Mean and population std (zero -> 1) in one pass (``with_raw``:
    also the unreplaced stds, None for an all-null column)."""
    n, mean, m2 = _moments(df, cols)
    means = [float(m) if k else 0.0 for k, m in zip(n, mean)]
    raw = [math.sqrt(q / k) if k else None for k, q in zip(n, m2)]
    stds = [w or 1.0 for w in raw]
    if with_raw:
        return means, stds, raw
    return means, stds


def _row_arrays(apply: Callable[[np.ndarray], np.ndarray], cols: Sequence[str], means: Sequence[float], stds: Sequence[float]) -> Column:
    """Array column of ``apply`` on the matrix of standardised inputs; null for a row with a missing input."""
    d, mid, wide = len(cols), np.array(means, float), np.array(stds, float)

    @F.arrow_udf("array<double>")
    def run(x: pa.Array) -> pa.Array:
        values, missing = _matrix(x, d)
        with np.errstate(all="ignore"):
            out = apply((values - mid) / wide)
        gone = missing.any(axis=1)
        starts = pa.array(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32), mask=np.append(gone, False))
        return pa.ListArray.from_arrays(starts, pa.array(np.ascontiguousarray(out).ravel()))

    return run(_inputs(cols))


# FT4 / FT5 -----------------------------------------------------------------

@dataclass
class KMeansFeatures:
    cols: list[str]
    means: list[float]
    stds: list[float]
    centers: np.ndarray   # (k, d), canonical order
    cost: float

    @property
    def k(self) -> int:
        return self.centers.shape[0]

    def transform(self, df: DataFrame, label: str, dist_prefix: str) -> DataFrame:
        return transform_kmeans(df, [(self, label, dist_prefix)])


def distances(z: Column, centers: np.ndarray) -> list[Column]:
    """FT5: Euclidean distance of an array column to each centre (null if the array holds a null)."""
    def one(center):
        sq = F.zip_with(z, F.lit([float(v) for v in center]), lambda a, b: (a - b) * (a - b))
        return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v))
    return [one(c) for c in np.asarray(centers, dtype=float)]


def distances_to(df: DataFrame, centres: DataFrame, vector: str, centre: str, block_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """FT5 for a table of centres of any size: every row with every centre's columns and ``distance``.

    The result has rows x centres rows by definition.  The centres are dealt
    into blocks of at most about ``block_bytes``, and the rows meet one broadcast block
    after the other.
    """
    stored = Lookup.materialise(centres)
    blocks = max(1, -(-stored.bytes // block_bytes))
    part = F.pmod(F.xxhash64(*stored.df.columns), F.lit(blocks))
    out = None
    for b in range(blocks):
        own = stored.df.where(part == b) if blocks > 1 else stored.df
        met = df.crossJoin(F.broadcast(own))
        out = met if out is None else out.unionByName(met)
    sq = F.aggregate(F.zip_with(vector, centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v)
    return out.withColumn("distance", F.sqrt(sq))


def _to_centres(centers: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    def run(z: np.ndarray) -> np.ndarray:
        out = np.empty((len(z), len(centers)))
        for j, c in enumerate(centers):
            gap = z - c
            out[:, j] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        return out

    return run


def transform_kmeans(df: DataFrame, models: list[tuple[KMeansFeatures, str, str]]) -> DataFrame:
    """FT4/FT5 for several fitted models, in Arrow tasks.

    Models fitted on the same standardised inputs share one pass over them;
    the label is the first nearest centre.
    """
    shared: dict[tuple, list[tuple[KMeansFeatures, str, str]]] = {}
    for model in models:
        km = model[0]
        shared.setdefault((tuple(km.cols), tuple(km.means), tuple(km.stds)), []).append(model)
    arrays = {key: f"_z{i}" for i, key in enumerate(shared)}
    out = df.select("*", *[_row_arrays(_to_centres(np.concatenate([np.asarray(km.centers, float) for km, _, _ in own])), *key)
                           .alias(arrays[key]) for key, own in shared.items()])
    at = {}
    for key, own in shared.items():
        place = 0
        for km, label, prefix in own:
            at[label] = [F.col(arrays[key])[place + j].alias(f"{prefix}{j}") for j in range(km.k)]
            place += km.k
    out = out.select("*", *[d for _, label, _ in models for d in at[label]])
    labels = []
    for km, label, prefix in models:
        own = [F.col(f"{prefix}{j}") for j in range(km.k)]
        labels.append((F.array_position(F.array(*own), F.least(*own)) - 1).cast("int").alias(label))
    return out.select("*", *labels).drop(*arrays.values())


def fit_kmeans(df: DataFrame, cols: Sequence[str], k: int, restarts: int = KMEANS_RESTARTS,
               seed: int = SEED, max_iter: int = 300, tol: float = 1e-4) -> KMeansFeatures:
    """FT4 for one k (see ``fit_kmeans_many``)."""
    return fit_kmeans_many(df, cols, [k], restarts, seed, max_iter, tol)[0]


def fits_at_once(rows: int, dims: int, parallelism: int, cached_bytes: int = CACHED_BYTES) -> int:
    """Fits that may run together: each caches the vectors itself, some 100 bytes and 8 a number for each row."""
    return max(1, min(parallelism, cached_bytes // max(1, rows * (100 + 8 * dims))))


def _as_bytes(vec: DataFrame) -> DataFrame:
    """A table of vectors with the bytes of each one's numbers, stored: a batch of them is a matrix in Arrow's memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                z = b.column(0).flatten().to_numpy(zero_copy_only=False)
                ends = np.arange(b.num_rows + 1, dtype=np.int32) * (z.nbytes // b.num_rows)
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(z)])], ["z"])

    return write_stage(vec.select(vector_to_array("features").alias("z")).mapInArrow(run, "z binary"), "rows")


def _squares(z: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres, as one matrix product."""
    out = z @ (-2.0 * centers.T)
    out += np.einsum("ij,ij->i", z, z)[:, None]
    out += np.einsum("ij,ij->i", centers, centers)
    return np.maximum(out, 0.0, out=out)


def _round(rows: DataFrame, d: int, of_batch: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of what ``of_batch`` gives of the matrix of every batch of rows, added up in each task and then in the tasks' order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for b in batches:
            if b.num_rows:
                _, ends, values = b.column("z").buffers()
                first = int(np.frombuffer(ends, np.int32)[b.column("z").offset])
                own = of_batch(np.frombuffer(values, np.float64, b.num_rows * d, first).reshape(-1, d))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    found = rows.mapInArrow(run, "part int, sums binary").collect()
    return sum(np.frombuffer(r.sums) for r in sorted(found, key=lambda r: r.part))


def fit_kmeans_many(df: DataFrame, cols: Sequence[str], ks: Sequence[int],
                    restarts: int = KMEANS_RESTARTS, seed: int = SEED, max_iter: int = 300,
                    tol: float = 1e-4, parallelism: int = 8) -> list[KMeansFeatures]:
    """FT4: KMeans (``k-means||`` seeding) for every k and restart; the best restart of each k.

    Inputs are standardised (population std) and rows with a missing input
    left out; the vectors are written once to the checkpoint folder.  First centres are
    Spark ML's for each seed: ``parallelism`` fits without a round at a time, or as many as
    keep their copies within ``CACHED_BYTES``; the vectors are dense, so each is told its
    solver rather than count their zeros in a pass of its own.  From there all fits go
    in common rounds: an Arrow pass over the rows takes the distances to the centres of
    every fit that still moves as one matrix product, and gives back sums and counts by centre.
    Rounds are those of Spark ML's KMeans: a fit ends when no centre moves by
    more than ``tol`` or after ``max_iter`` rounds, an empty cluster keeps its centre, the cost is
    that of the last round's distances.  The best restart has
    the lowest cost (ties: lowest seed); centres are put in lexicographic order,
    so that labels don't depend on the seed's numbering.
    """
    cols, d = list(cols), len(cols)
    means, stds = standardize_exprs(df, cols)
    scaled = df.select(_row_arrays(lambda z: z, cols, means, stds).alias("_z")).where(F.col("_z").isNotNull())
    vec = write_stage(scaled.select(array_to_vector("_z").alias("features")), "kmeans")
    runs = [(k, r) for k in ks for r in range(restarts)]

    def first(run: tuple[int, int]) -> np.ndarray:
        model = KMeans(k=run[0], seed=seed + run[1], maxIter=0, initMode="k-means||", solver="row").fit(vec)
        return np.array(model.clusterCenters())

    with ThreadPool(fits_at_once(vec.count(), d, parallelism)) as pool:
        centers = pool.map(inheritable_thread_target(df.sparkSession)(first), runs, chunksize=1)
    rows, cost, moving = _as_bytes(vec), [0.0] * len(runs), list(range(len(runs)))
    for _ in range(max_iter):
        if not moving:
            break
        now = np.concatenate([centers[i] for i in moving])
        ends = np.cumsum([len(centers[i]) for i in moving])
        starts = np.append(0, ends[:-1])

        def assign(z: np.ndarray) -> np.ndarray:
            sq = _squares(z, now)
            hot, least = np.zeros(sq.shape), np.zeros(len(starts))
            for j, (a, b) in enumerate(zip(starts, ends)):
                at = sq[:, a:b].argmin(1)
                hot[np.arange(len(z)), a + at] = 1.0
                least[j] = sq[np.arange(len(z)), a + at].sum()
            return np.concatenate([(hot.T @ z).ravel(), hot.sum(0), least])

        sums = _round(rows, d, assign)
        total, count, least = sums[:now.size].reshape(now.shape), sums[now.size:now.size + len(now)], sums[now.size + len(now):]
        new = np.where(count[:, None] > 0, total / np.maximum(count, 1.0)[:, None], now)
        moved = ((new - now) ** 2).sum(1) > tol * tol
        for j, (i, a, b) in enumerate(zip(moving, starts, ends)):
            centers[i], cost[i] = new[a:b], float(least[j])
        moving = [i for i, a, b in zip(moving, starts, ends) if moved[a:b].any()]
    out = []
    for k in ks:
        _, best = min((cost[i], i) for i, (own, _) in enumerate(runs) if own == k)
        if len(centers[best]) < k:
            raise ValueError(f"fewer than {k} distinct rows")
        out.append(KMeansFeatures(cols, means, stds, centers[best][np.lexsort(centers[best].T[::-1])], cost[best]))
    return out


# FT6 -----------------------------------------------------------------------

@dataclass
class PCAFeatures:
    cols: list[str]
    means: list[float]
    stds: list[float]
    loadings: np.ndarray   # (d, n_components), sign-fixed
    explained: np.ndarray

    def transform(self, df: DataFrame, prefix: str = "pca_") -> DataFrame:
        """FT6: the standardised inputs, a batch of rows as one matrix, times the components."""
        loadings = np.asarray(self.loadings, float)
        staged = df.withColumn("_pz", _row_arrays(lambda z: z @ loadings, self.cols, self.means, self.stds))
        return staged.select("*", *[F.col("_pz")[j].alias(f"{prefix}{j + 1}") for j in range(loadings.shape[1])]).drop("_pz")

    def exprs(self, prefix: str = "pca_") -> list[Column]:
        """The same projection as column arithmetic (for a few inputs)."""
        z = [(F.col(c).cast("double") - F.lit(m)) / F.lit(s)
             for c, m, s in zip(self.cols, self.means, self.stds)]
        out = []
        for j in range(self.loadings.shape[1]):
            acc = None
            for i, zi in enumerate(z):
                t = zi * F.lit(float(self.loadings[i, j]))
                acc = t if acc is None else acc + t
            out.append(acc.alias(f"{prefix}{j + 1}"))
        return out


def fit_pca(df: DataFrame, cols: Sequence[str], n_components: int | None = None) -> PCAFeatures:
    """FT6: PCA on standardised (centred) inputs, ``min(10, d - 1)`` components.

    The covariance comes from one pass of Arrow tasks, each of which sums the products of a
    batch of rows as a matrix (d x d on the driver); rows with a missing input are left out.
    Signs are fixed so the largest-|loading| entry of each component is positive.
    """
    cols = list(cols)
    k, d = n_components or min(PCA_MAX_COMPONENTS, len(cols) - 1), len(cols)
    means, stds = standardize_exprs(df, cols)
    mid, wide = np.array(means, float), np.array(stds, float)

    def products(x: np.ndarray) -> list:
        z = (x[~np.isnan(x).any(axis=1)] - mid) / wide
        return [np.array([float(len(z))]), z.sum(0), (z.T @ z).ravel()]

    found = _sums(df, cols, products, lambda a, b: [x + y for x, y in zip(a, b)])
    n = found[0][0] if found else 0
    if n < 2:
        raise ValueError("fewer than 2 complete rows to fit components on")
    cov = (found[2].reshape(d, d) - np.outer(found[1], found[1]) / n) / (n - 1)
    u, s, _ = np.linalg.svd(cov)
    load, explained = u[:, :k].copy(), s[:k] / s.sum()
    for j in range(load.shape[1]):
        i = int(np.argmax(np.abs(load[:, j])))
        if load[i, j] < 0:
            load[:, j] = -load[:, j]
    return PCAFeatures(cols, means, stds, load, explained)
