"""Whitening of embeddings by spectral divide and conquer on polar decompositions.

Entries are brought to a grid of 1/256 (``x = floor(256 * c)``), so equal vectors are found exactly. Each distinct
vector counts once in the fit. Spark finds the distinct vectors (a hash aggregation over their packed
bytes), their exact sums and, centred by these, their covariance: every task adds up its rows in one matrix
and the matrices are added entry by entry.

The covariance, whose size depends on the number of dimensions alone, is split on the driver. The orthogonal
polar factor of the shifted covariance, found by dynamically weighted Halley steps in QR form,
is 1 on the eigenvectors above the shift and -1 on those below; half the sum with the identity projects
on the upper invariant subspace. Both subspaces are split again until single directions or multiples
of the identity are left. The leading directions are broadcast and every row is projected on them.

Rows: a row whose vector is null or empty or holds null or non-finite entries is dropped, as is one whose length
is not that of most distinct vectors (the greater length among equals). Grid values beyond 64 bits are cut to
them; a deviation beyond 64 bits is null. Repeated rows and ids are rows of their own, a null id stays null, other
columns are ignored, whatever their names. A direction without variance has ``whitened`` null and
is left out of the identity error; without any variance ``explained`` is null. No usable row: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.shared import staged

EPS = np.finfo(np.float64).eps
GRID = 256.0


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix that is not singular.

    Dynamically weighted Halley steps: the weights follow a lower bound of the smallest singular value, so a few
    steps suffice whatever the condition; each is one QR decomposition, without an inverse.
    """
    n = len(a)
    x = a / np.abs(a).sum(0).max()
    low = min(1.0, max(EPS, 1 / np.linalg.norm(np.linalg.inv(x))))
    eye = np.eye(n)
    for _ in range(60):
        square = low * low
        d = (4 * (1 - square) / square**2) ** (1 / 3) if square < 1 else 0.0
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        if abs(1 - low) < 10 * EPS and moved < EPS ** (1 / 3):
            break
    return x


def _bases(projector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range of a projector of rank ``k`` and of its complement."""
    n = len(projector)
    trial = np.random.default_rng(n).standard_normal((n, n))  # fixed: reruns give the same directions
    upper, _ = np.linalg.qr(projector @ trial[:, :k])
    upper, _ = np.linalg.qr(projector @ upper)
    lower, _ = np.linalg.qr(trial[:, k:] - projector @ trial[:, k:])
    lower, _ = np.linalg.qr(lower - projector @ lower)
    lower, _ = np.linalg.qr(lower - upper @ (upper.T @ lower))
    return upper, lower


def _divided(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift, None when no shift separates eigenvalues."""
    n = len(a)
    diagonal, mean = np.sort(np.diag(a)), np.trace(a) / n
    reach = np.linalg.norm(a - mean * np.eye(n))
    best, least = None, 1e-10 * scale
    # The median halves the work; the mean lies strictly inside the spectrum; the rest avoid eigenvalues.
    for shift in (np.median(diagonal), mean, *(mean + reach / n * f for f in (0.11, -0.13, 0.29, -0.31, 0.53, -0.59))):
        try:
            projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
        except np.linalg.LinAlgError:
            continue
        k = round(float(np.trace(projector)))
        if not 0 < k < n:
            continue
        upper, lower = _bases(projector, k)
        residue = np.linalg.norm(lower.T @ a @ upper)
        if residue <= 10 * n * EPS * scale:
            return upper, lower
        if residue < least:
            best, least = (upper, lower), residue
    return best


def spectrum(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    n = len(a)
    scale = np.linalg.norm(a)
    values, vectors = [], []
    open_parts = [(a, np.eye(n))]
    while open_parts:
        part, basis = open_parts.pop()
        m = len(part)
        split = None
        if m > 1 and np.linalg.norm(part - np.trace(part) / m * np.eye(m)) > EPS * scale:
            split = _divided(part, scale)
        if split is None:
            values += np.diag(part).tolist()
            vectors.append(basis)
            continue
        for directions in split:
            inner = directions.T @ part @ directions
            open_parts.append(((inner + inner.T) / 2, basis @ directions))
    columns = np.hstack(vectors)
    columns, triangle = np.linalg.qr(columns)  # takes out what rounding left of non-orthogonality
    columns *= np.sign(np.diag(triangle))
    values = np.einsum("ij,ij->j", columns, a @ columns)
    order = np.argsort(-values, kind="stable")
    return values[order], columns[:, order]


def _usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a list column that can be used, all their grid values, and each row's number of values."""
    lists = column
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    entries = values.to_numpy(zero_copy_only=False)  # a null is read as NaN
    bounds = offsets - offsets[0]
    lengths = np.diff(bounds)
    wrong = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    good = (lengths > 0) & (wrong[bounds[1:]] == wrong[bounds[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        grid = np.floor(entries[np.repeat(good, lengths)] * GRID)
    edge = float(2**63)
    x = np.where(grid >= edge, np.iinfo(np.int64).max, np.where(np.abs(grid) < edge, grid, -edge).astype(np.int64))
    return np.flatnonzero(good), x, lengths[good]


WIDTHS = ("<i1", "<i2", "<i4", "<i8")


def _packed(x: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """Each vector as bytes: one for the width of its numbers, then the numbers in that width, the least that holds all."""
    if len(lengths) == 0:
        return []
    starts = np.cumsum(lengths) - lengths
    high, low = np.maximum.reduceat(x, starts), np.minimum.reduceat(x, starts)
    width = np.zeros(len(lengths), np.int64)
    for k in (0, 1, 2):
        limits = np.iinfo(WIDTHS[k])
        width += (high > limits.max) | (low < limits.min)
    out = [b""] * len(lengths)
    for k in np.unique(width).tolist():
        raw, size = x.astype(WIDTHS[k]).tobytes(), 1 << k
        for i in np.flatnonzero(width == k).tolist():
            out[i] = bytes([k]) + raw[starts[i] * size : (starts[i] + lengths[i]) * size]
    return out


def _unpacked(column: pa.Array, d: int) -> np.ndarray:
    out = np.empty((len(column), d), np.int64)
    for i, raw in enumerate(column.to_pylist()):
        out[i] = np.frombuffer(raw, WIDTHS[raw[0]], d, 1)
    return out


def _off_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact: 64-bit integers where they suffice, else Python's."""
    most = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    if n * most + max(map(abs, sums)) < 2**62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _deviations(off: np.ndarray) -> pa.Array:
    """Exact sums of squares of the rows, null beyond 64 bits."""
    most = max(abs(int(off.max())), abs(int(off.min()))) if off.size else 0
    if most * most * off.shape[1] >= 2**63:
        off = off.astype(object)
    total = (off * off).sum(1).tolist()
    return pa.array([t if t < 2**63 else None for t in total], pa.int64())


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(embeddings: DataFrame, components: int = 4, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: a row per usable row and component.

    ``n`` distinct grid vectors make the fit; ``deviation`` is the sum of ``(n * x - sum)`` squared over the dimensions;
    ``whitened`` the centred row on the component in units of its standard deviation; ``explained`` the
    component's share of all variance; ``identity_error`` the largest distance of the whitened components'
    covariance, measured on the fit list, from the identity.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x, lengths = _usable(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(_packed(x, lengths), pa.binary()), pa.array(lengths.astype(np.int32))], names=["x", "d"])

    fit = staged(rows.select("v").mapInArrow(pack, "x binary, d int").distinct(), "whitening-fit")
    sizes = fit.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], SCHEMA)
    d, n = sizes["d"], sizes["count"]
    fit = fit.where(F.col("d") == d).select("x")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            x = _unpacked(batch.column(0), d)
            if x.size and max(abs(int(x.max())), abs(int(x.min()))) >= 2**40:
                x = x.astype(object)
            total = [a + int(b) for a, b in zip(total, x.sum(0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["i", "s"])

    added = fit.mapInArrow(add, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    sums = [int(r["s"]) for r in added.orderBy("i").collect()]  # a number per dimension

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            centred = _off_mean(_unpacked(batch.column(0), d), n, sums).astype(np.float64) / n
            total += centred.T @ centred
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    covariance = np.zeros((d, d))
    for r in fit.mapInArrow(multiply, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # an entry per pair of dimensions
        covariance[r["i"], r["j"]] = covariance[r["j"], r["i"]] = r["v"] / n
    values, vectors = spectrum(covariance)
    trace = float(np.trace(covariance))
    top = min(components, d)
    live = values[:top] > d * EPS * max(float(values[0]), 0.0)
    scaled = vectors[:, :top] / np.sqrt(np.where(live, values[:top], 1.0))
    model = spark.sparkContext.broadcast((n, sums, scaled, live.tolist(), [float(v) / trace if trace > 0 else None for v in values[:top]]))

    def whiten(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, sums, scaled, _, _ = model.value
        off = _off_mean(x, n, sums)
        return off, off.astype(np.float64) / n @ scaled

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((top + 1, top + 1))
        for batch in batches:
            _, z = whiten(_unpacked(batch.column(0), d))
            z = np.hstack([np.ones((len(z), 1)), z])
            total += z.T @ z
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total.ravel())], names=["i", "j", "v"])

    measured = np.zeros((top + 1, top + 1))
    for r in fit.mapInArrow(moments, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        measured[r["i"], r["j"]] = r["v"] / n
    # The rows are centred, so these means are rounding errors and nothing cancels in the difference.
    error = measured[1:, 1:] - np.outer(measured[0, 1:], measured[0, 1:]) - np.eye(top)
    identity_error = float(np.abs(error[np.ix_(live, live)]).max()) if live.any() else None

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, _, _, live, explained = model.value
        for batch in batches:
            at, x, lengths = _usable(batch.column(1))
            right = lengths == d
            x, at = x[np.repeat(right, lengths)].reshape(-1, d), at[right]
            off, z = whiten(x)
            m = len(at)
            dead = np.tile(~np.array(live), m)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(at, top))),
                    pa.array(np.tile(np.arange(1, top + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * top, n)),
                    _deviations(off).take(pa.array(np.repeat(np.arange(m), top))),
                    pa.array(z.ravel(), mask=dead),
                    pa.array(explained * m, pa.float64()),
                    pa.array([identity_error] * (m * top), pa.float64()),
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    return rows.mapInArrow(project, SCHEMA)
