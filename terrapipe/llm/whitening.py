"""Whitening of embeddings by shifted Cholesky QR.

Each entry c of a vector becomes the integer x = floor(64 c) + 1,000,000. With A
the centred rows, V = AᵀA / n their covariance: a factor R of A = Q R has A's
singular values and right singular vectors, so its decomposition gives V's
eigenvectors without the squared condition of AᵀA.

1. One pass sums the integers exactly (:func:`_sums`).
2. Each Gram pass sums QᵀQ over all rows, where a row of Q is the centred row
   solved through the triangular factors found so far; the Cholesky factor of
   the sum is the next factor. The first is taken of AᵀA + s I, with the shift s
   that rounding cannot outweigh, so it exists however ill-conditioned the rows
   are. Passes end as soon as QᵀQ is the identity, but for directions without
   any variance (:func:`_factor`): after two passes on well-conditioned rows.
3. R is the product of the factors. What QᵀQ still differs from the identity is
   folded into R before its singular value decomposition.
4. One pass measures the covariance of the whitened rows, one returns them.

A pass sends a triangle of sums per task into an aggregate by place in the
triangle; the driver holds matrices of the vectors' dimension, never rows. Every
pass reads the vectors again, so pass a stored table.

Defined results: rows whose vector is null, or holds a null, NaN or infinite
entry, are left out; so are vectors of another length than most have (of
equally frequent lengths the greatest counts), as their missing entries are
null. Scaled entries beyond 2**48 count as 2**48. Null, repeated and equal ids
are kept, a row each. A component without variance has ``explained`` 0 (null
if no component has any) and null ``whitened``, and stays out of
``identity_error``, which is then null if none is left. A ``deviation`` past 64
bits is null. An empty table, or one of empty vectors, gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapipe.llm.shared import staged

SCALE, OFFSET, LARGEST = 64, 1_000_000, float(1 << 48)
#: Entries that a task works on at once.
BLOCK = 1 << 19
#: QᵀQ is the identity up to this; eigenvalues of it below the second bound are directions without variance.
CLOSE, NOTHING = 1e-10, 1e-12
PASSES = 8
ROUNDING = np.finfo(np.float64).eps / 2


@dataclass
class Rows:
    """What tasks need to centre rows: n, and each dimension's sum as ``whole * n + rest``."""

    n: int
    dimension: int
    whole: np.ndarray
    rest: np.ndarray
    factors: list[np.ndarray] = field(default_factory=list)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def solved(self, x: np.ndarray) -> np.ndarray:
        """Rows of Q: the centred rows through the triangular factors."""
        rows = self.centred(x)
        for factor in self.factors:
            out = np.empty_like(rows)
            for j in range(self.dimension):
                out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
            rows = out
        return rows

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum of (n x - S)² over the dimensions, exactly."""
        y = x - self.whole
        reach = float(np.abs(y).max(initial=0) + 1) * self.n
        if reach * reach * self.dimension < 2.0 ** 62:
            away = self.n * y - self.rest
            return pa.array((away * away).sum(axis=1))
        away = self.n * y.astype(object) - self.rest.astype(object)
        return pa.array([v if v < 1 << 63 else None for v in (away * away).sum(axis=1)], pa.int64())


def _integers(batch: pa.RecordBatch, dimension: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (places in the batch, integer rows): whole finite vectors of one length each."""
    column = batch.column("vector")
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    for size in (np.unique(sizes[sizes > 0]) if dimension is None else [dimension]):
        places = np.flatnonzero(sizes == size)
        step = max(1, BLOCK // int(size))
        for k in range(0, len(places), step):
            at = places[k:k + step]
            entries = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), size)  # null: NaN
            whole = np.isfinite(entries).all(axis=1)
            with np.errstate(over="ignore"):
                scaled = np.clip(SCALE * entries[whole], -LARGEST, LARGEST)
            yield at[whole], np.floor(scaled).astype(np.int64) + OFFSET


def _sums(vectors: DataFrame) -> Rows | None:
    """The rows to fit on, their number and sums."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for _, x in _integers(batch):
                n, s = found.get(x.shape[1], (0, 0))
                found[x.shape[1]] = n + len(x), s + x.sum(axis=0).astype(object)
        for size, (n, s) in found.items():
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()),
                     pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0))], ["dimension", "place", "n", "s"])

    sums = staged(vectors.select("vector").mapInArrow(add, "dimension int, place int, n long, s decimal(38,0)")
                  .groupBy("dimension", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "whitening-sums")
    most = sums.where("place = 0").orderBy(F.desc("n"), F.desc("dimension")).first()
    if most is None:
        return None
    parts = [divmod(int(r["s"]), most["n"]) for r in sums.where(F.col("dimension") == most["dimension"]).orderBy("place").collect()]
    return Rows(most["n"], most["dimension"], *(np.array(v, np.int64) for v in zip(*parts)))


def _gram(vectors: DataFrame, rows: Rows, size: int, change: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of the outer square of ``change`` of their integers."""
    i, j = np.triu_indices(size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for _, x in _integers(batch, rows.dimension):
                changed = change(x)
                total += changed.T @ changed
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "g"])

    sums = vectors.select("vector").mapInArrow(add, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g"))
    out = np.zeros((size, size))
    for r in sums.collect():  # a triangle of the vectors' dimension
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["g"]
    return out


def _factor(vectors: DataFrame, rows: Rows) -> np.ndarray:
    """A factor with the singular values and right singular vectors of the centred rows."""
    d = rows.dimension
    product = np.eye(d)
    for done in range(PASSES):
        gram = _gram(vectors, rows, d, rows.solved)
        values, turned = np.linalg.eigh(gram)
        settled = done > 0 and bool(((np.abs(values - 1) <= CLOSE) | (values <= NOTHING)).all())
        if settled or done == PASSES - 1:
            break
        shift = 11 * (rows.n * d + d * (d + 1)) * ROUNDING * max(float(np.trace(gram)), np.finfo(np.float64).tiny)
        try:
            factor = np.linalg.cholesky(gram + shift * np.eye(d) if done == 0 else gram).T
        except np.linalg.LinAlgError:
            factor = np.linalg.cholesky(gram + shift * np.eye(d)).T
        rows.factors.append(factor)
        product = factor @ product
    return (np.sqrt(np.clip(values, 0, None))[:, None] * turned.T) @ product


def whiten(vectors: DataFrame, components: int = 32, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Each row's coordinates on the covariance's first ``components`` eigenvectors, over the square roots of the eigenvalues.

    Returns one row per vector and component: the id, ``component`` from 1 by falling
    eigenvalue, n, deviation, whitened, explained and identity_error.
    """
    source = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    kind = source.schema["id"].dataType.simpleString()
    schema = (f"`{id_column}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = _sums(source)
    if rows is None:
        return source.sparkSession.createDataFrame([], schema)
    _, sizes, axes = np.linalg.svd(_factor(source, rows))
    k = min(components, rows.dimension)
    with np.errstate(divide="ignore", invalid="ignore"):
        explained = (sizes ** 2 / (sizes ** 2).sum())[:k]
    lasting = sizes[:k] > max(rows.n, rows.dimension) * 2 * ROUNDING * sizes[0]
    explained[~lasting] = 0 if lasting.any() else np.nan
    m = int(lasting.sum())  # the first m components have variance
    onto = axes[:m].T * (np.sqrt(rows.n) / sizes[:m])

    def whitened(x: np.ndarray) -> np.ndarray:
        return rows.centred(x) @ onto

    error = None
    if m:
        sums = _gram(source, rows, m + 1, lambda x: np.column_stack([whitened(x), np.ones(len(x))]))
        mean = sums[:m, m] / rows.n
        error = float(np.abs(sums[:m, :m] / rows.n - np.outer(mean, mean) - np.eye(m)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _integers(batch, rows.dimension):
                values = np.full((len(x), k), np.nan)
                values[:, :m] = whitened(x)
                each = np.repeat(np.arange(len(x)), k)
                count = len(each)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(count, rows.n, np.int64)), rows.deviations(x).take(pa.array(each)),
                     pa.array(values.reshape(-1), from_pandas=True), pa.array(np.tile(explained, len(x)), from_pandas=True),
                     pa.array([error], pa.float64()).take(pa.array(np.zeros(count, np.int64)))],
                    [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return source.mapInArrow(project, schema)
