"""Embedding whitening: eigenvectors refined in mixed precision.

Entries are put on an integer grid, so that sums over any number of tasks are
exact and hang on no order: one pass adds up counts, sums and ranges, the next
the products of the centred values.  Tasks return one row per dimension and
Spark adds them up; only the covariance (dimension x dimension) comes to the
driver.  Its eigenvectors are found in float32 and corrected in extended
precision by the matrix-multiplication iteration of Ogita and Aishima.
Eigenvalues that lie closer than the error of the moment tells them apart form
a cluster: the matrix is shifted by the cluster's mean and projected on it, and
the small problem that is left is solved on its own.  A last pass projects
every vector; the covariance of what it wrote is measured, not assumed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.session import written

# The integer grid of the entries.
GRID, OFFSET = 64, 1_000_000

COMPONENTS = 32
# A direction whose variance is below this share of the largest one is told
# apart from none by no digit that counts: it is not whitened.
LEAST_SHARE = 1e-13
ROWS = 4096  # rows of a matrix product
EXACT = 1 << 53  # integers up to here are exact as float64
LONG = 1 << 62
MAX_STEPS = 40
Extended = np.longdouble


# --------------------------------------------------------------------------
# eigenvectors
# --------------------------------------------------------------------------

def extended(exact: list[list[int]], divisor: int) -> np.ndarray:
    """Integers of any size over a divisor, rounded once to extended precision."""
    bits = 40
    out = np.zeros((len(exact), len(exact)), dtype=Extended)
    for i, row in enumerate(exact):
        for j, v in enumerate(row):
            whole, rest = divmod(v, divisor)
            low = (rest << (2 * bits)) // divisor
            out[i, j] = (Extended(whole >> bits) * Extended(1 << bits) + Extended(whole & ((1 << bits) - 1))
                         + Extended(low >> bits) / Extended(1 << bits)
                         + Extended(low & ((1 << bits) - 1)) / Extended(1 << bits) ** 2)
    return out


def clusters(values: np.ndarray, error: float) -> list[np.ndarray]:
    """Places of eigenvalues, in falling order, cut where two neighbours differ
    by more than ``error``."""
    order = np.argsort(-values, kind="stable")
    cuts = np.flatnonzero(-np.diff(values[order]) > error) + 1
    return np.split(order, cuts)


def _symmetric(m: np.ndarray) -> np.ndarray:
    return (m + m.T) / 2


def refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of the symmetric ``a``, in its precision,
    from approximate eigenvectors ``x``; quadratic convergence.

    Each step measures how far x is from orthogonal (R) and x'ax from diagonal
    (S); from both follows the correction E, x <- x + xE.  Pairs whose
    eigenvalues differ by less than the error of the step are only made
    orthogonal by it; the subspace of such a cluster converges with the others,
    and inside it the shifted, projected matrix is solved on its own."""
    kind = a.dtype.type
    one = np.eye(len(a), dtype=a.dtype)
    size = np.abs(a).sum(axis=1).max()
    least = np.finfo(a.dtype).eps * len(a)
    x, last, settled = x.astype(a.dtype), np.inf, 0
    for _ in range(MAX_STEPS):
        # symmetric to the last digit, or the correction of a narrow gap would
        # not be a rotation
        r, s = _symmetric(one - x.T @ x), _symmetric(x.T @ (a @ x))
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        error = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
        gap = values[None, :] - values[:, None]
        close = np.abs(gap) <= error
        e = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, kind(1), gap))
        x = x + x @ e
        for own in clusters(values, error):
            if len(own) > 1:
                x[:, own] = _solved(a, x[:, own])
        change = float(np.abs(e).max())
        settled = settled + 1 if change >= last / 2 else 0
        last = change
        if change <= least or settled >= 3:  # no digit is left to gain
            break
    x = x / np.sqrt((x * x).sum(axis=0))
    values = np.diag(x.T @ (a @ x))
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def _solved(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The basis ``x`` of a cluster, turned to the eigenvectors of ``a`` in it.
    Shifted by the cluster's mean, the projected matrix is as small as the
    cluster is wide, so working precision resolves differences that are far
    below its error on ``a``."""
    x = x + x @ (_symmetric(np.eye(x.shape[1], dtype=a.dtype) - x.T @ x) / 2)
    ax = a @ x
    mean = (x * ax).sum(axis=0).mean()
    small = _symmetric(x.T @ (ax - mean * x))
    scale = np.abs(small).max()
    if not scale > 0:
        return x
    _, turn = np.linalg.eigh((small / scale).astype(np.float64))
    turn = turn.astype(a.dtype)
    fix = np.eye(len(turn), dtype=a.dtype) - turn.T @ turn
    return x @ (turn + turn @ (fix / 2))


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric
    matrix in extended precision, started in float32.  Of the two directions
    the one whose entry of largest size (the first of equals) is positive."""
    size = np.abs(a).max() if a.size else 0
    if not size > 0:
        return np.zeros(len(a), dtype=a.dtype), np.eye(len(a), dtype=a.dtype)
    _, x = np.linalg.eigh((a / size).astype(np.float32))
    values, x = refine(a / size, x)
    top = np.abs(x).argmax(axis=0)
    return values * size, x * np.sign(x[top, np.arange(x.shape[1])])


# --------------------------------------------------------------------------
# distributed sums
# --------------------------------------------------------------------------

def grids(batch: pa.RecordBatch, column: str = "v") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x) per length of the usable vectors of a batch: their places and
    their grid values as longs."""
    lists = batch.column(column)
    lists = lists.cast(pa.list_(pa.float64()))
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)  # null entries are NaN
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    for d in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == d)
        c = flat[starts[rows][:, None] + np.arange(d)]
        usable = np.isfinite(c).all(axis=1)
        rows, c = rows[usable], np.floor(GRID * c[usable])
        if len(rows):
            if np.abs(c).max() >= LONG:
                raise OverflowError("an entry is too large for a grid value of type long")
            yield rows, c.astype(np.int64) + OFFSET


@dataclass
class Fit:
    """Exact moments of the fit list and its components."""
    n: int
    sums: list[int]
    centre: np.ndarray  # whole numbers next to the means
    values: np.ndarray  # eigenvalues of the components, falling
    explained: np.ndarray
    vectors: np.ndarray  # columns: components as double

    @property
    def rest(self) -> np.ndarray:
        """sums - n * centre: at most n / 2 in size."""
        return np.array([s - self.n * int(k) for s, k in zip(self.sums, self.centre)], dtype=np.int64)


def _vectors(emb: DataFrame, vector_col: str) -> DataFrame:
    return emb.select(F.col(vector_col).cast("array<double>").alias("v")).where("v IS NOT NULL")


def moments(emb: DataFrame, vector_col: str) -> tuple[int, list[int], list[int], list[int]]:
    """(n, sums, least, greatest) of the grid values per dimension, over the
    vectors of the commonest length (the longest of equals)."""
    def partial(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for _, x in grids(batch):
                d, new = x.shape[1], [len(x), x.sum(axis=0), x.min(axis=0), x.max(axis=0)]
                old = held.get(d)
                held[d] = new if old is None else [
                    old[0] + new[0], old[1] + new[1], np.minimum(old[2], new[2]), np.maximum(old[3], new[3])]
        for d, (n, s, lo, hi) in held.items():
            yield pa.RecordBatch.from_pydict({
                "d": [d], "n": [n], "s": [s.tolist()], "lo": [lo.tolist()], "hi": [hi.tolist()]},
                schema=pa.schema([("d", pa.int32()), ("n", pa.int64())]
                                 + [(c, pa.list_(pa.int64())) for c in ("s", "lo", "hi")]))

    parts = written(_vectors(emb, vector_col).mapInArrow(
        partial, "d int, n bigint, s array<bigint>, lo array<bigint>, hi array<bigint>"), "moments")
    first = parts.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if first is None:
        return 0, [], [], []
    rows = (parts.where(F.col("d") == first["d"])
            .select(F.posexplode(F.arrays_zip("s", "lo", "hi")).alias("i", "z"))
            .groupBy("i").agg(F.sum("z.s").alias("s"), F.min("z.lo").alias("lo"), F.max("z.hi").alias("hi"))
            .orderBy("i").collect())
    return first["n"], [r["s"] for r in rows], [r["lo"] for r in rows], [r["hi"] for r in rows]


def _added(parts: DataFrame, d: int, kind: str) -> dict[tuple[int, int], int]:
    """Entries of a symmetric matrix from the upper triangles of all tasks,
    added up by Spark; d(d+1)/2 of them come to the driver."""
    rows = (parts.select("i", F.posexplode("row").alias("k", "x"))
            .groupBy("i", "k").agg(F.sum("x").cast(kind).alias("x")).collect())
    return {(r["i"], r["i"] + r["k"]): r["x"] for r in rows}


def _triangle(g: np.ndarray, kind) -> Iterator[pa.RecordBatch]:
    """One row per matrix row: its number and its entries from the diagonal on."""
    schema = pa.schema([("i", pa.int32()), ("row", pa.list_(kind))])
    for i in range(len(g)):
        yield pa.RecordBatch.from_pydict({"i": [i], "row": [g[i, i:]]}, schema=schema)


def fit(emb: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Fit:
    """Moments and components of all usable vectors of a table (see
    :func:`whiten`): two passes, exact in whole numbers."""
    n, sums, lo, hi = moments(emb, vector_col)
    if not n:
        none = np.zeros(0)
        return Fit(0, [], none.astype(np.int64), none, none, np.zeros((0, 0)))
    d = len(sums)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    width = int(max(max(int(k) - a, b - int(k)) for k, a, b in zip(centre, lo, hi)))
    if n * width * width >= LONG:  # as a deviation then does not fit either
        raise OverflowError("the vectors lie too far apart for sums of type long")
    block = max(1, min(ROWS, EXACT // max(width * width, 1)))

    def products(batches):
        g = np.zeros((d, d), dtype=np.int64)
        for batch in batches:
            for _, x in grids(batch):
                if x.shape[1] != d:
                    continue
                for at in range(0, len(x), block):
                    y = x[at:at + block] - centre
                    if width * width <= EXACT:  # float64 products of so few rows are whole numbers
                        y = y.astype(np.float64)
                    g += (y.T @ y).astype(np.int64)
        yield from _triangle(g, pa.int64())

    found = _added(_vectors(emb, vector_col).mapInArrow(products, "i int, row array<bigint>"), d, "bigint")
    t = [s - n * int(k) for s, k in zip(sums, centre)]
    at = lambda i, j: found[(min(i, j), max(i, j))]
    exact = [[n * at(i, j) - t[i] * t[j] for j in range(d)] for i in range(d)]
    values, vectors = eigenvectors(extended(exact, n * n))
    trace = sum(exact[i][i] for i in range(d))
    total = extended([[trace]], n * n)[0, 0]
    k = min(components, d)
    share = values[:k] / total if trace else np.full(k, np.nan)
    return Fit(n, sums, centre, values[:k].astype(np.float64), share.astype(np.float64),
               vectors[:, :k].astype(np.float64))


# --------------------------------------------------------------------------
# whitening
# --------------------------------------------------------------------------

def project(emb: DataFrame, found: Fit, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(id, deviation, whitened) of every usable vector of the fitted length;
    ``whitened`` holds NaN where a component has no variance."""
    n, d, k = found.n, len(found.sums), len(found.values)
    centre, rest = found.centre, found.rest
    top = found.values.max(initial=0)
    there = found.values > LEAST_SHARE * top
    scale = np.where(there, 1 / np.sqrt(np.where(there, found.values, 1)), np.nan)
    turn = found.vectors
    id_type = emb.schema[id_col]

    def rows(batches):
        for batch in batches:
            for places, x in grids(batch):
                if x.shape[1] != d:
                    continue
                z = n * (x - centre) - rest  # n * x - S
                far = (z.astype(np.float64) ** 2).sum(axis=1)
                if far.max() >= LONG:
                    raise OverflowError("a deviation does not fit into a long")
                w = ((z / n) @ turn) * scale
                offsets = np.arange(0, (len(w) + 1) * k, k, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(pa.array(places)), pa.array((z * z).sum(axis=1)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.ravel()))],
                    names=["id", "deviation", "whitened"])

    schema = T.StructType([T.StructField("id", id_type.dataType), T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    own = emb.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return own.where("v IS NOT NULL").mapInArrow(rows, schema)


def identity_error(whitened: DataFrame, found: Fit) -> float | None:
    """Largest absolute entry of the covariance of ``whitened`` (divisor n,
    centred before multiplying) minus the identity, over the components with
    variance; None if there is none."""
    k = len(found.values)
    means = whitened.select(F.posexplode("whitened").alias("i", "w")).groupBy("i").agg(F.avg("w").alias("m"))
    mean = np.zeros(k)
    for r in means.collect():
        mean[r["i"]] = r["m"]

    def products(batches):
        g = np.zeros((k, k))
        for batch in batches:
            w = batch.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            for at in range(0, len(w), ROWS):
                c = w[at:at + ROWS] - mean
                g += c.T @ c
        yield from _triangle(g, pa.float64())

    sums = _added(whitened.select("whitened").mapInArrow(products, "i int, row array<double>"), k, "double")
    gaps = [abs(x / found.n - (i == j)) for (i, j), x in sums.items() if x == x]
    return float(max(gaps)) if gaps else None


def whiten(emb: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *,
           components: int = COMPONENTS) -> DataFrame:
    """Whitened components of every vector.

    Entries become whole numbers x = floor(64 c) + 1000000; components are the
    unit eigenvectors of their covariance (divisor n), by falling eigenvalue e.
    Returns one row per vector: ``id_col``, ``n`` (vectors of the fit),
    ``deviation`` (squared distance of n x from the sums, exact), ``whitened``,
    ``values`` and ``explained`` (arrays over the components: the vector, the
    eigenvalues and their shares of the trace) and ``identity_error`` (one
    value, measured).

    Left out: null and empty vectors, such with a null or non-finite entry, and
    such of another length than the commonest of the rest (the longest of
    equals).  Equal vectors and rows that repeat an id count as often as they
    stand there; a null id stays.  A component without variance (one vector,
    equal vectors, a flat direction) has null for ``whitened``; without any
    variance ``explained`` is null, too.  An empty table gives no rows.  Values
    whose exact sums exceed a long raise.  Other columns are not read.  The
    driver holds a matrix of dimension x dimension.
    """
    found = fit(emb, vector_col, components)
    id_type = emb.schema[id_col].dataType.simpleString()
    if not found.n:
        return emb.limit(0).select(
            F.col(id_col), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
            *[F.array().cast("array<double>").alias(c) for c in ("whitened", "values", "explained")],
            F.lit(None).cast("double").alias("identity_error"))
    out = written(project(emb, found, id_col, vector_col), "whitened")
    error = identity_error(out, found)
    none = F.lit(None).cast("double")
    number = lambda v: F.array(*[F.lit(float(x)) if x == x else none for x in v])
    return out.select(
        F.col("id").cast(id_type).alias(id_col), F.lit(found.n).cast("long").alias("n"), "deviation",
        F.transform("whitened", lambda w: F.when(~F.isnan(w), w)).alias("whitened"),
        number(found.values).alias("values"), number(found.explained).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def op11_whiten(spark, sf_dir: str) -> DataFrame:
    out = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return (out.select("vec_id", "n", "deviation", "explained", "identity_error",
                       F.posexplode("whitened").alias("i", "whitened"))
            .select("vec_id", (F.col("i") + 1).alias("component"), "n", "deviation", "whitened",
                    F.get("explained", "i").alias("explained"), "identity_error"))
