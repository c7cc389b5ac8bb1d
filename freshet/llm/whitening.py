"""Whitening of embeddings by a covariance over distinct vectors, weighted by how often each occurs.

Entries are put on a grid of whole numbers, so that equal vectors can be grouped: every later step works
on the distinct ones. Their weights are their counts, or one each. Sums per dimension are exact; each
vector is centred on them in whole numbers before anything is multiplied, and a task adds up its part
of the covariance as one weighted matrix product. The eigenvectors of the covariance whiten each
distinct vector once; the rows are joined back to the results.

Only sums leave the tasks: a number per dimension or per pair of dimensions, whatever the rows.

Defined results: rows whose vector is NULL, or holds a NULL, NaN or infinite entry, go; so do vectors
with an entry of 2^42 or more in size, whose grid number would not be exact, and vectors of another
length than most distinct ones have (ties: the longer length), which cannot be compared. Empty vectors
have no components. NULL and repeated keys stay, a row each; equal vectors get equal values. An empty
table, or one without a usable vector, gives an empty result. A component without variance has NULL in
``whitened`` and takes no part in ``identity_error``; a ``deviation`` beyond 64 bits is NULL. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.session import frozen

#: Steps of the grid in a unit, and what is added to each number.
STEPS, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries of this size or more have no exact grid number.
LIMIT = float(1 << 42)
#: Eigenvalues of this share of the largest, or less, count as none.
NOTHING = 1e-12

_KEYS = ["k1", "k2"]


@dataclass(frozen=True)
class Whitening:
    """What was fitted: exact sums, and unit axes by falling variance."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    variances: np.ndarray
    trace: float


def on_grid(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows that have a usable vector, with its grid numbers ``x``."""
    exact = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LIMIT, F.lit(False)))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(STEPS))) + F.lit(SHIFT).cast("bigint"))
    return rows.where(F.col(vector).isNotNull() & exact).withColumn("x", x)


def keyed(rows: DataFrame) -> DataFrame:
    """128 bits that stand for ``x`` in joins."""
    return rows.withColumns({"k1": F.xxhash64("x"), "k2": F.xxhash64(F.lit(1), "x")})


def multiplicities(rows: DataFrame, weights: str = "counts") -> DataFrame:
    """``x, weight`` of the distinct vectors; counted before they are shuffled."""
    if weights not in ("counts", "one"):
        raise ValueError("weights must be 'counts' or 'one'")
    counted = rows.groupBy("x").agg(F.count(F.lit(1)).alias("weight"))
    return counted if weights == "counts" else counted.withColumn("weight", F.lit(1).cast("bigint"))


def _matrices(batches: Iterator[pa.RecordBatch], column: str = "x") -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """The vectors and weights of each batch."""
    for batch in batches:
        if batch.num_rows:
            x = batch.column(column).flatten().to_numpy().reshape(batch.num_rows, -1)
            yield x, batch.column("weight").to_numpy(), batch


def _safe(x: np.ndarray, factor: int) -> np.ndarray:
    """``x`` in a type in which ``x * factor`` cannot overflow."""
    most = int(np.abs(x).max(initial=0)) * max(abs(int(factor)), 1)
    return x if most < 1 << 62 else x.astype(object)


def sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """The weight of all vectors and their exact weighted sum per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for x, weight, _ in _matrices(batches):
            part = (_safe(x, int(weight.sum())) * weight[:, None]).sum(axis=0).astype(object)
            total = part if total is None else total + part
            n += int(weight.sum())
        if total is not None:
            # The weight goes along as one dimension more.
            values = pa.array([Decimal(int(v)) for v in [*total, n]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), values], ["i", "value"])

    found = vectors.mapInArrow(run, "i int, value decimal(38,0)").groupBy("i").agg(F.sum("value").alias("value"))
    values = [int(r["value"]) for r in found.orderBy("i").collect()]
    return (values[-1], values[:-1]) if values else (0, [])


def _deviations(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """``n * x - sums``, exact."""
    return _safe(x, 2 * n) * n - total


def covariance(vectors: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """The weighted covariance with divisor ``n``, centred before multiplying."""
    wide = max(map(abs, total), default=0) >= 1 << 62

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, found = np.array(total, object if wide else np.int64), None
        for x, weight, _ in _matrices(batches):
            centred = _deviations(x, n, centre).astype(np.float64) / n
            part = (centred * weight[:, None]).T @ centred
            found = part if found is None else found + part
        if found is not None:
            d = len(found)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(d + 1) * d, pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), rows], ["i", "row"])

    parts = vectors.mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "value"))
    added = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((len(total), len(total)))
    out[added["i"].to_numpy(), added["j"].to_numpy()] = added["value"].to_numpy() / n
    return (out + out.T) / 2


def fit(vectors: DataFrame) -> Whitening:
    """The whitening of a written table ``x, weight`` of vectors of one length.

    The driver holds one number per pair of dimensions.
    """
    n, total = sums(vectors)
    if not n or not total:
        return Whitening(n, tuple(total), np.zeros((len(total), 0)), np.zeros(0), 0.0)
    v = covariance(vectors, n, total)
    values, axes = np.linalg.eigh(v)
    falling = np.argsort(-values, kind="stable")
    return Whitening(n, tuple(total), axes[:, falling], values[falling], float(np.trace(v)))


def project(vectors: DataFrame, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """``k1, k2, weight, deviation, values`` of every distinct vector."""
    many = min(components, model.axes.shape[1])
    present = model.variances[:many] > NOTHING * model.variances[:1]
    scale = np.where(present, np.sqrt(np.where(present, model.variances[:many], 1.0)), np.nan)
    wide = max(map(abs, model.sums), default=0) >= 1 << 62

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = np.array(model.sums, object if wide else np.int64)
        for x, _, batch in _matrices(batches):
            away = _deviations(x, model.n, centre)
            rough = (away.astype(np.float64) ** 2).sum(axis=1)
            exact = np.full(len(x), None, object)
            short = rough < float(1 << 62)
            exact[short] = (away[short] * away[short]).sum(axis=1)
            for i in np.flatnonzero(~short & (rough < 1.01 * float(1 << 63))):
                value = sum(int(d) ** 2 for d in away[i])
                exact[i] = value if value < 1 << 63 else None
            values = (away.astype(np.float64) / model.n) @ model.axes[:, :many] / scale
            flat = pa.array(values.ravel(), mask=np.isnan(values.ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * many, pa.int32()), flat)
            deviation = pa.array([None if e is None else int(e) for e in exact], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in _KEYS), batch.column("weight"), deviation, lists], [*_KEYS, "weight", "deviation", "values"])

    return keyed(vectors).mapInArrow(run, "k1 bigint, k2 bigint, weight bigint, deviation bigint, values array<double>")


def identity_error(projected: DataFrame, n: int, components: int) -> float | None:
    """The largest entry, in size, of the weighted covariance of the values less the identity."""
    entry = [F.get("values", F.lit(i)) for i in range(components)]
    if not components:
        return None
    means = projected.agg(*[(F.sum(F.col("weight") * e) / n).alias(f"m{i}") for i, e in enumerate(entry)]).first()
    kept = [i for i in range(components) if means[i] is not None]
    pairs = [(i, j) for i in kept for j in kept if i <= j]
    if not pairs:
        return None
    product = lambda i, j: F.sum(F.col("weight") * (entry[i] - F.lit(means[i])) * (entry[j] - F.lit(means[j])))
    found = projected.agg(*[(product(i, j) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[k] - (i == j)) for k, (i, j) in enumerate(pairs))


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, weights: str = "counts") -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error``: a row for every usable
    vector and component, by falling variance."""
    usable = on_grid(rows.select(F.col(key).alias("__key"), F.col(vector).alias("__vector")), "__vector").select("__key", "x")
    vectors = frozen(multiplicities(usable, weights), "distinct-vectors")
    lengths = vectors.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.col("n").desc(), F.col("length").desc()).first()
    length = common["length"] if common else 0
    vectors = vectors.where(F.size("x") == length) if length else vectors.where("false")
    model = fit(vectors)
    many = min(components, len(model.variances))
    projected = frozen(project(vectors, model, components), "whitened-vectors")
    error = identity_error(projected, model.n, many)
    share = model.variances[:many] / model.trace if model.trace > 0 else np.full(many, np.nan)
    explained = F.array(*[F.lit(float(s)) if s == s else F.lit(None).cast("double") for s in share]) if many else F.array().cast("array<double>")
    # The distinct side has one row a key, so a vector that many rows share can be split.
    met = keyed(usable).select("__key", *_KEYS).join(projected.select(*_KEYS, "deviation", "values"), _KEYS)
    each = met.select("__key", "deviation", F.posexplode("values").alias("at", "whitened"))
    return each.select(
        F.col("__key").alias(key),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).cast(T.DoubleType()).alias("identity_error"),
    )
