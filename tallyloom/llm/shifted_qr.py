"""Whitening of embeddings by shifted CholeskyQR.

The centred rows A are never moved: every pass sends one Gram matrix from each task.
The first Gram matrix gets a shift, so that its Cholesky factor exists however badly
conditioned A is; rows are then solved against the factor, which gives nearly orthonormal
rows of another Gram matrix, and so on until that is the identity up to rounding. The
product of the factors is the R of A, and its singular value decomposition has the
eigenvectors of the covariance, without the covariance's squared condition number.

Entries become whole numbers first, so sums and centred values are exact. What reaches
the driver is d by d numbers for vectors of d entries, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

SCALE = 1024
LIFT = 100_000
COMPONENTS = 8
MAX_PASSES = 6
#: Entries beyond this have no exact whole number in a double and count as not finite.
LARGEST = 2.0 ** 52 / SCALE
_ROWS = 8192  # of a block
_LOW = (1 << 26) - 1  # sums of a block's low and high parts stay below 2**63


def _vectors(batches: Iterator[pa.RecordBatch], length: int | None,
             column: str) -> Iterator[tuple[pa.Array, int, np.ndarray]]:
    """(ids, length, whole numbers) of the usable rows, block by block and length by length."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            block = batch.slice(at, _ROWS)
            vectors = block.column(column)
            sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes[sizes > 0]).tolist() if length is None else [length]:
                rows = np.flatnonzero(sizes == size)
                entries = vectors.take(pa.array(rows)).flatten().cast(pa.float64())
                values = entries.to_numpy(zero_copy_only=False).reshape(len(rows), size)  # nulls become NaN
                good = (np.abs(values) <= LARGEST).all(axis=1)
                if good.any():
                    ids = block.column(0).take(pa.array(rows[good]))
                    yield ids, size, np.floor(values[good] * SCALE).astype(np.int64) + LIFT


def _sums(embeddings: DataFrame, column: str) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(n, sums, least, largest entry of each dimension) of the vectors of the commonest
    length (of two, the greater); n is 0 where no vector is usable."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for _, size, x in _vectors(batches, None, column):
            if size not in totals:
                far = np.iinfo(np.int64).max
                totals[size] = [0, [0] * size, np.full(size, far), np.full(size, -far)]
            total = totals[size]
            high, low = (x >> 26).sum(axis=0).tolist(), (x & _LOW).sum(axis=0).tolist()
            total[0] += len(x)
            total[1] = [s + (h << 26) + w for s, h, w in zip(total[1], high, low)]
            total[2], total[3] = np.minimum(total[2], x.min(axis=0)), np.maximum(total[3], x.max(axis=0))
        for size, (n, sums, least, largest) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, size)), pa.array(np.arange(size)), pa.array(np.full(size, n)),
                 pa.array([str(s) for s in sums]), pa.array(least), pa.array(largest)],
                ["size", "dim", "n", "total", "least", "largest"])

    partial = embeddings.select(F.lit(0), column).mapInArrow(
        run, "size BIGINT, dim BIGINT, n BIGINT, total STRING, least BIGINT, largest BIGINT")
    per_dim = partial.groupBy("size", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast(DecimalType(38, 0))).alias("total"),
        F.min("least").alias("least"), F.max("largest").alias("largest"))
    # the commonest length, its dimensions beside it: one row of d entries
    fit = per_dim.groupBy("size").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("dim", "total", "least", "largest"))).alias("dims"))
    found = fit.orderBy(F.col("n").desc(), F.col("size").desc()).first()
    if found is None:
        return 0, *(np.zeros(0, np.int64) for _ in range(3))
    dims = found["dims"]
    return (found["n"], np.array([int(d["total"]) for d in dims], object),
            np.array([d["least"] for d in dims]), np.array([d["largest"] for d in dims]))


class Centre:
    """Exact centring: a row less its mean, as doubles, and n times that as whole numbers."""

    def __init__(self, n: int, sums: np.ndarray, least: np.ndarray, largest: np.ndarray):
        self.n = n
        self.floor = np.array([int(s) // n for s in sums], np.int64)
        self.rest = np.array([int(s) % n for s in sums], np.int64)
        widest = int(max(np.abs(least - self.floor).max(), np.abs(largest - self.floor).max())) + 1
        self.small = n * widest < 1 << 62

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squares of n*x - S; null where a 64-bit integer cannot hold it."""
        part = x - self.floor
        if not self.small:
            exact = (part.astype(object) * self.n - self.rest.astype(object)) ** 2
            return [s if s < 1 << 63 else None for s in exact.sum(axis=1).tolist()]
        part = part * self.n - self.rest
        wrapped = (part * part).sum(axis=1).tolist()  # right wherever the sum itself fits
        rough = (part.astype(np.float64) ** 2).sum(axis=1)
        for row in np.flatnonzero(rough > 2.0 ** 62).tolist():
            exact = sum(int(v) ** 2 for v in part[row])
            wrapped[row] = exact if exact < 1 << 63 else None
        return wrapped


def solve(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """rows times the inverse of the factors' product, by substitution, one factor after the other."""
    for r in factors:
        done = np.zeros_like(rows.T)
        given = np.ascontiguousarray(rows.T)
        for j in range(len(r)):
            done[j] = (given[j] - r[:j, j] @ done[:j]) / r[j, j]
        rows = done.T
    return rows


def _gram(embeddings: DataFrame, column: str, size: int,
          rows: Callable[[np.ndarray], np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sum of the rows, their Gram matrix) over all usable vectors: one matrix per task,
    added up by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for _, _, x in _vectors(batches, size, column):
            a = rows(x)
            total[0] += a.sum(axis=0)
            total[1:] += a.T @ a
        place = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel())], ["place", "value"])

    partial = embeddings.select(F.lit(0), column).mapInArrow(run, "place BIGINT, value DOUBLE")
    added = partial.groupBy("place").agg(F.sum("value").alias("value")).collect()  # (width + 1) * width rows
    total = np.zeros((width + 1) * width)
    total[[r["place"] for r in added]] = [r["value"] for r in added]
    total = total.reshape(width + 1, width)
    return total[0], (total[1:] + total[1:].T) / 2


def cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper factor of the shifted matrix; the shift grows tenfold until there is one."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(shift * 10, np.finfo(float).tiny, np.finfo(float).eps * np.trace(gram))


def factors_of(gram_of: Callable[[list[np.ndarray]], np.ndarray], n: int) -> list[np.ndarray]:
    """The triangular factors, first to last. ``gram_of`` makes the pass over the rows
    that are solved against the factors so far."""
    factors: list[np.ndarray] = []
    for number in range(MAX_PASSES):
        gram = gram_of(factors)
        d = len(gram)
        unit = np.finfo(float).eps / 2
        if number == 0:
            factors.append(cholesky(gram, 11 * (n * d + d * (d + 1)) * unit * np.linalg.norm(gram, 2)))
            continue
        away = np.abs(gram - np.eye(d)).max()
        factors.append(cholesky(gram, 0.0))
        if away < 0.1:  # then the rows solved against this factor are orthonormal up to rounding
            break
    return factors


def fit(embeddings: DataFrame, components: int = COMPONENTS, column: str = "embedding"):
    """(centre, vectors, eigenvalues, trace): unit eigenvectors of the covariance as
    columns, by falling eigenvalue; of each, the entry farthest from zero is positive.
    Components whose eigenvalue is zero up to rounding are left out. None if no vector
    is usable."""
    n, *dims = _sums(embeddings, column)
    if not n:
        return None
    centre, size = Centre(n, *dims), len(dims[0])
    if all(low == high for low, high in zip(dims[1], dims[2])):
        return centre, np.zeros((size, 0)), np.zeros(0), 0.0

    def gram_of(factors: list[np.ndarray]) -> np.ndarray:
        return _gram(embeddings, column, size, lambda x: solve(centre.rows(x), factors), size)[1]

    r = np.eye(size)
    for factor in factors_of(gram_of, n):
        r = factor @ r
    _, singular, turned = np.linalg.svd(r)
    kept = min(components, int((singular > singular[0] * max(n, size) * np.finfo(float).eps).sum()))
    vectors = turned[:kept].T
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)])
    eigenvalues = singular ** 2 / n
    return centre, vectors, eigenvalues[:kept], float(eigenvalues.sum())


def whiten(embeddings: DataFrame, components: int = COMPONENTS, column: str = "embedding",
           key: str = "vec_id") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable
    row and component.

    A row is not usable, and has no rows here, if its vector is null, empty, of another
    length than the commonest, or holds an entry that is null, not finite or beyond
    ``LARGEST``. Repeated rows and rows without an id count and come back like others.
    Where all vectors are equal, or one is there, no component has an eigenvalue and no
    row comes back; nor does one of an empty table. ``deviation`` is null where it does
    not fit into 64 bits. Other columns are not looked at.
    """
    kind = embeddings.schema[key].dataType.simpleString()
    schema = (f"`{key}` {kind}, component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE, "
              "identity_error DOUBLE")
    found = fit(embeddings, components, column)
    if found is None or not found[1].shape[1]:
        return embeddings.sparkSession.createDataFrame([], schema)
    centre, vectors, eigenvalues, trace = found
    size, kept = vectors.shape
    n, turn = centre.n, vectors / np.sqrt(eigenvalues)

    def white(x: np.ndarray) -> np.ndarray:
        return centre.rows(x) @ turn

    mean, gram = _gram(embeddings, column, size, white, kept)
    error = float(np.abs(gram / n - np.outer(mean, mean) / n ** 2 - np.eye(kept)).max())
    explained = eigenvalues / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, x in _vectors(batches, size, column):
            rows = np.repeat(np.arange(len(x)), kept)
            deviation = pa.array(centre.deviation(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows)), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(rows), n)), deviation.take(pa.array(rows)), pa.array(white(x).ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(len(rows), error))],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return embeddings.select(key, column).mapInArrow(run, schema)
