"""Embedding whitening by shifted CholeskyQR: Gram passes over centred rows, triangular solves, an SVD of R."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Context

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SCALE, OFFSET = 1024, 100_000
LARGEST = float(1 << 42)  # entries from here on have no exact whole number
ROUNDS = 6  # Gram passes at most
DEPENDENT = 1e-12  # share of a dimension's length that the other dimensions do not explain, at least
SUM_ROWS = 4096  # rows of one sum, so that long tables lose no digits


@dataclass
class Whitener:
    """n and exact sums of the fitted rows; unit components as rows; their eigenvalues; the trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def dims(self) -> int:
        return len(self.sums)


def vector_size(df: DataFrame, vector: str) -> int:
    """Size that most vectors have, the larger of equally frequent ones; 0 for a table without vectors."""
    sizes = df.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return most["size"] if most else 0


def whole_numbers(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors of a batch, and floor(1024 c) + 100000 of their entries as int64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths().fill_null(-1))
    fits = np.flatnonzero(sizes == dims)
    flat = column.take(pa.array(fits)).flatten()
    entries = np.asarray(flat.cast(pa.float64()).fill_null(float("nan"))).reshape(len(fits), dims)
    good = (np.abs(entries) < LARGEST).all(axis=1)  # false for NaN and infinities too
    return fits[good], np.floor(entries[good] * SCALE).astype(np.int64) + OFFSET


def _sum_rows(rows: DataFrame, vector: str, dims: int, width: int, kind: str, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all usable vectors of ``work(x)``, a flat array of ``width`` numbers of a block of rows.

    Each task adds up its own rows and sends ``width`` numbers; Spark adds those by their place.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            _, x = whole_numbers(batch.column(0), dims)
            for at in range(0, len(x), SUM_ROWS):
                part = work(x[at : at + SUM_ROWS])
                total = part if total is None else total + part
        if total is not None:
            arrow = pa.int64() if kind == "bigint" else pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(total, arrow)], ["i", "v"])

    parts = rows.select(vector).mapInArrow(add, f"i int, v {kind}")
    out = np.zeros(width, np.int64 if kind == "bigint" else np.float64)
    for row in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():  # `width` rows at most
        out[row["i"]] = row["v"]
    return out


def scaled_deviation(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - sums, exact: in int64 where it fits, else in Python's integers."""
    most = max(int(np.abs(x).max(initial=0)), 1)
    if n * most < 1 << 61 and int(np.abs(sums).max(initial=0)) < 1 << 61:
        return n * x - sums
    return n * x.astype(object) - np.array([int(s) for s in sums], object)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x less its mean, with one rounding."""
    return (scaled_deviation(x, n, sums) / n).astype(np.float64)


def _solved(rows: np.ndarray, upper: list[np.ndarray]) -> np.ndarray:
    """rows R1^-1 R2^-1 ... by forward substitution, one column at a time."""
    q = np.asfortranarray(rows)
    for r in upper:
        out = np.empty_like(q)
        for j in range(r.shape[0]):
            out[:, j] = (q[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        q = out
    return q


def independent(gram: np.ndarray, tolerance: float = DEPENDENT) -> list[int]:
    """Columns that are no combination of the ones before, by a Cholesky step each on the largest remainder."""
    left, kept = gram.astype(float).copy(), []
    start = np.diag(gram).copy()
    for _ in range(len(gram)):
        share = np.where(start > 0, np.diag(left) / np.where(start > 0, start, 1), 0)
        share[kept] = 0
        j = int(share.argmax())
        if share[j] <= tolerance:
            break
        kept.append(j)
        column = left[:, j] / np.sqrt(left[j, j])
        left -= np.outer(column, column)
    return sorted(kept)


def fit(df: DataFrame, vector: str, components: int = 8) -> Whitener:
    """Principal components of the usable vectors of ``df``, at most ``components`` of them.

    Each pass sends a Gram matrix of d x d numbers per task. The first factor comes from the Gram
    matrix of the centred rows plus a small shift, so that nearly dependent dimensions do not break
    it; each further pass orthogonalises the rows by triangular solves with all factors so far and
    factors what is left, until the Gram matrix is the identity to rounding. The product of the factors is R
    of the QR factorisation; its singular values and right vectors are those of the rows.

    Dimensions that depend on others are found after the first pass and left out of the factors;
    their rows of R come from the products of the orthogonal rows with all dimensions. Components
    of eigenvalue zero are not returned. A component's largest entry is positive.
    """
    dims = vector_size(df, vector)
    if not dims:
        return Whitener(0, np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), 0.0)
    counted = _sum_rows(df, vector, dims, dims + 1, "bigint", lambda x: np.append(x.sum(axis=0), len(x)))
    n, sums = int(counted[-1]), counted[:-1]
    if not n:
        return Whitener(0, sums, np.zeros((0, dims)), np.zeros(0), 0.0)

    def grams(used: list[int], upper: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Products of the orthogonalised rows with themselves and with the centred rows."""
        size = len(used)

        def work(x: np.ndarray) -> np.ndarray:
            rows = centred(x, n, sums)
            q = _solved(rows[:, used], upper)
            return np.append((q.T @ q).ravel(), (q.T @ rows).ravel())

        flat = _sum_rows(df, vector, dims, size * (size + dims), "double", work)
        return flat[: size * size].reshape(size, size), flat[size * size :].reshape(size, dims)

    gram, _ = grams(list(range(dims)), [])
    trace = float(np.trace(gram)) / n
    used = [j for j in range(dims) if gram[j, j] > 0]
    if not used:
        return Whitener(n, sums, np.zeros((0, dims)), np.zeros(0), 0.0)
    unit = np.finfo(float).eps / 2

    def shifted(gram: np.ndarray) -> np.ndarray:
        d = len(gram)
        shift = 11 * (n * d + d * (d + 1)) * unit * np.trace(gram)
        return np.linalg.cholesky(gram + min(shift, np.trace(gram) / 100) * np.eye(d)).T

    part = gram[np.ix_(used, used)]
    upper = [shifted(part)]
    crossed = None
    for step in range(ROUNDS):
        gram, crossed = grams(used, upper)
        if step == 0:
            kept = independent(gram)
            if len(kept) < len(used):
                part = part[np.ix_(kept, kept)]
                used = [used[j] for j in kept]
                upper = [shifted(part)]
                gram, crossed = grams(used, upper)
        if np.abs(gram - np.eye(len(used))).max() < 1e-13 * len(used):
            break
        try:
            upper.append(np.linalg.cholesky(gram).T)
        except np.linalg.LinAlgError:
            upper.append(shifted(gram))
    r = np.eye(len(used))
    for factor in upper:
        r = factor @ r
    whole = crossed.copy()  # rows of R in all dimensions; those of the used ones come from the factors
    whole[:, used] = r
    _, singular, right = np.linalg.svd(whole, full_matrices=False)
    values = singular**2 / n
    some = min(components, int((singular > singular[0] * 1e-13).sum()))
    rows = right[:some] * np.sign(right[np.arange(some), np.abs(right[:some]).argmax(axis=1)])[:, None]
    return Whitener(n, sums, rows, values[:some], trace)


def identity_error(df: DataFrame, vector: str, model: Whitener) -> float:
    """Largest entry of the whitened rows' covariance less the identity, from two passes: means, then centred products."""
    c = len(model.values)
    if not c:
        return 0.0
    mean = _sum_rows(df, vector, model.dims, c, "double", lambda x: _whitened(x, model).sum(axis=0)) / model.n

    def products(x: np.ndarray) -> np.ndarray:
        w = _whitened(x, model) - mean
        return (w.T @ w).ravel()

    covariance = _sum_rows(df, vector, model.dims, c * c, "double", products).reshape(c, c) / model.n
    return float(np.abs(covariance - np.eye(c)).max())


def _whitened(x: np.ndarray, model: Whitener) -> np.ndarray:
    return centred(x, model.n, model.sums) @ (model.components / np.sqrt(model.values)[:, None]).T


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of each usable row and component.

    Entries c become whole numbers floor(1024 c) + 100000. ``deviation`` is the row's sum over
    dimensions of (n x - sums)^2, exact as decimal(38,0), null beyond 38 digits; ``explained`` is
    the component's share of the variance; ``identity_error`` is measured over all rows.

    Rows whose vector is null or holds a null, NaN, infinite entry or one from 2^42 on are
    left out, and so are vectors of another size than most have (of equally frequent sizes the
    larger). Repeated rows and null ids count like others. Components of no variance are not returned, so equal
    rows alone, an empty table and vectors without entries give no rows. Further columns are not used.
    """
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v"))
    model = fit(rows, "v", components)
    model.identity_error = identity_error(rows, "v", model)
    schema = T.StructType(
        [
            rows.schema["vec_id"], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
            T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    c = len(model.values)
    explained = model.values / model.trace if c else np.zeros(0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = whole_numbers(batch.column(1), model.dims)
            if not c or not len(at):
                continue
            far = squares(x, model.n, model.sums)
            count = len(at)
            columns = [
                batch.column(0).take(pa.array(np.repeat(at, c))),
                np.tile(np.arange(1, c + 1, dtype=np.int32), count),
                np.full(count * c, model.n),
                pa.array(far, pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(count), c))),
                _whitened(x, model).ravel(),
                np.tile(explained, count),
                np.full(count * c, model.identity_error),
            ]
            made = [v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(columns, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(made, schema=arrow)

    return rows.mapInArrow(project, schema)


def squares(x: np.ndarray, n: int, sums: np.ndarray) -> list:
    """Exact sums of (n x - sums)^2 of each row as Decimal; None beyond 38 digits."""
    far = scaled_deviation(x, n, sums)
    most = int(np.abs(far).max(initial=0))
    if far.dtype == object or most * most * far.shape[1] >= 1 << 63:
        far = far.astype(object)
    exact = Context(prec=60)
    return [exact.create_decimal(v) if v < 10**38 else None for v in map(int, (far * far).sum(axis=1))]
