"""Embedding whitening from a weighted multiplicity covariance.

Every entry c of an embedding is put on an integer grid, x = floor(64 * c) + 1000000,
so that equal vectors are equal bit by bit. Identical x vectors are grouped; a distinct
vector enters the fit with its count as weight (or with one). Sums and their mean are
exact integers; the covariance is a weighted matrix product of centred vectors, made in
each task and added up by entry in a grouped aggregate. Its eigenvectors give the
components. Each distinct vector is whitened once, and the rows get the result by a join
on the vector's digest.

Only dim * (dim + 1) / 2 matrix entries and dim sums reach the driver, whatever the
number of rows; every pass over vectors is a pass over the distinct ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.store import Scratch

GRID, SHIFT = 64, 1_000_000
#: Entries on the grid are kept below this size, so that centred ones are exact doubles.
LIMIT = 1 << 40
DIGEST = ["d1", "d2"]
RESULT = ("vec_id long, n long, deviation long, whitened array<double>, explained array<double>, "
          "identity_error double")


def _on_grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, x as 64-bit little-endian bytes) of the rows whose vector is whole."""
    for batch in batches:
        ids, found = [], []
        lengths = batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = batch.column(1).flatten()
        values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(values * GRID) + SHIFT
            whole = np.abs(x) < LIMIT  # false for NaN and infinities too
        x = np.where(whole, x, 0).astype("<i8")
        ends = np.cumsum(lengths)
        wrong = np.concatenate([[0], np.cumsum(~whole)])
        for i in np.flatnonzero((lengths > 0) & (wrong[ends] == wrong[ends - lengths])):
            ids.append(i)
            found.append(x[ends[i] - lengths[i]:ends[i]].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(found, pa.binary())],
                                         names=["vec_id", "x"])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dim)


def _weighted_sums(dim: int):
    """(entry, exact sum of weight * x) of a task's vectors; entry -1 is the sum of weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (dim + 1)
        for batch in batches:
            x, w = _matrix(batch.column(0), dim), batch.column(1).to_numpy()
            if not len(w):
                continue
            if int(np.abs(x).max()) * int(w.sum()) >= 1 << 62:
                x, w = x.astype(object), w.astype(object)
            part = w @ x
            total = [a + int(b) for a, b in zip(total, [*part, w.sum()])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(dim), -1], pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))],
            names=["entry", "value"])
    return run


class Grid:
    """Exact sums of the fit list: ``n * x - S`` without overflow for usual sizes."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.dim = n, len(sums)
        self.base = [s // n for s in sums]
        self.rest = [s - n * b for s, b in zip(sums, self.base)]

    def parts(self) -> tuple:
        return self.n, self.base, self.rest


def centred(x: np.ndarray, parts: tuple) -> np.ndarray:
    """``n * x - S`` exactly (Python integers where 64 bits don't do)."""
    n, base, rest = parts
    gap = x - np.array(base, np.int64)
    if len(gap) and (int(np.abs(gap).max()) + 1) * n >= 1 << 62:
        gap = gap.astype(object)
        return gap * n - np.array(rest, object)
    return gap * n - np.array(rest, np.int64)


def _sums_of_squares(q: np.ndarray) -> list[int | None]:
    """Exact row sums of squares; None beyond 64 bits."""
    top = int(np.abs(q).max()) if q.size else 0
    if top * top * max(q.shape[1], 1) < 1 << 63:
        return (q * q).sum(axis=1).tolist()
    sums = [sum(int(v) * int(v) for v in row) for row in q]
    return [s if s < 1 << 63 else None for s in sums]


def _gram(size: int, rows: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]):
    """(entry, weighted sum of products) of a task's centred rows, for the upper triangle."""
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if len(batch):
                z, w = rows(batch)
                total += (z * w[:, None]).T @ z
        yield pa.RecordBatch.from_arrays([pa.array((upper[0] * size + upper[1]).astype(np.int32)), pa.array(total[upper])],
                                         names=["entry", "value"])
    return run


def _covariance(vectors: DataFrame, size: int, n: int, rows) -> np.ndarray:
    """Covariance (divisor ``n``) of the centred rows that ``rows`` reads from a batch."""
    found = (vectors.mapInArrow(_gram(size, rows), "entry int, value double")
             .groupBy("entry").agg(F.sum("value").alias("value")).collect())  # size * (size + 1) / 2 rows
    out = np.zeros((size, size))
    for r in found:
        out[r.entry // size, r.entry % size] = r.value / n
    return np.triu(out) + np.triu(out, 1).T


def _whiten(parts: tuple, transform: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = transform.shape[1]
        for batch in batches:
            q = centred(_matrix(batch.column(0), transform.shape[0]), parts)
            y = (q.astype(np.float64) / parts[0]) @ transform
            offsets = pa.array(np.arange(len(y) + 1, dtype=np.int32) * size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), batch.column(3), pa.array(_sums_of_squares(q), pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(y.reshape(-1)))],
                names=["w", *DIGEST, "deviation", "whitened"])
    return run


def _values(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def identity_error(whitened: DataFrame, size: int, n: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` (columns w, whitened) minus the identity."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += batch.column(0).to_numpy() @ _values(batch, size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["entry", "value"])

    mean = np.zeros(size)
    for r in whitened.mapInArrow(sums, "entry int, value double").groupBy("entry").agg(F.sum("value").alias("value")).collect():
        mean[r.entry] = r.value / n
    cov = _covariance(whitened, size, n, lambda batch: (_values(batch, size) - mean, batch.column(0).to_numpy()))
    return float(np.abs(cov - np.eye(size)).max())


def whiten_embeddings(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                      components: int = 32, weights: str = "counts") -> DataFrame:
    """One row for each row that has a whole vector:
    ``vec_id, n, deviation, whitened, explained, identity_error``.

    ``weights`` is ``counts`` (the fit list is all rows) or ``one`` (it is the distinct vectors).
    ``n`` is the fit list's length and S its sums: ``deviation`` is the sum over dimensions of
    (n * x - S)^2, ``whitened[k]`` the projection of x - S / n on component k over the root of
    its eigenvalue, ``explained[k]`` the eigenvalue's share of the trace. ``identity_error`` is
    measured on the whitened vectors themselves.

    * null vectors, and vectors with a null or non-finite entry or one of 2^40 or more on the grid: left out;
    * vectors of another length than most (the longer one of a tie): left out, as are empty ones;
    * components without variance (eigenvalue at most dim * 2^-52 of the largest) don't exist: equal
      vectors only, or one, give empty arrays;
    * a deviation that 64 bits can't hold is null; a null id stays null;
    * repeated rows and equal vectors get equal results; an empty table gives an empty result;
      other columns are ignored.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights must be 'counts' or 'one'")
    spark = embeddings.sparkSession
    scratch, kept = Scratch(spark, "whitening"), Scratch(spark, "whitening-result")
    slim = embeddings.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                             F.col(f"`{vector_col}`").cast("array<double>").alias("vector")).filter("vector IS NOT NULL")
    grid = scratch.stage(slim.mapInArrow(_on_grid, "vec_id long, x binary")
                         .withColumns({"d1": F.xxhash64("x"), "d2": F.xxhash64(F.lit(7), "x")}), "grid")
    sizes = grid.groupBy((F.length("x") / 8).cast("int").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if sizes is None:
        scratch.clear()
        return spark.createDataFrame([], RESULT)
    dim = sizes["dim"]
    rows = kept.stage(grid.filter(F.length("x") == 8 * dim).select("vec_id", *DIGEST), "rows", keep=True)
    weight = F.count(F.lit(1)) if weights == "counts" else F.lit(1).cast("long")
    distinct = scratch.stage(grid.filter(F.length("x") == 8 * dim).groupBy("x", *DIGEST).agg(weight.alias("w"))
                             .select("x", "w", *DIGEST), "distinct")

    fit = distinct.select("x", "w")
    sums = {r.entry: int(r.value) for r in fit.mapInArrow(_weighted_sums(dim), "entry int, value decimal(38,0)")
            .groupBy("entry").agg(F.sum("value").cast("decimal(38,0)").alias("value")).collect()}
    n = sums[-1]
    parts = Grid(n, [sums[i] for i in range(dim)]).parts()
    cov = _covariance(fit, dim, n, lambda batch: (
        centred(_matrix(batch.column(0), dim), parts).astype(np.float64) / n, batch.column(1).to_numpy()))
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > max(float(values.max()), 0.0) * dim * 2.0 ** -52][:components]
    transform = vectors[:, order] / np.sqrt(values[order])

    done = kept.stage(distinct.mapInArrow(_whiten(parts, transform), "w long, d1 long, d2 long, deviation long, whitened array<double>"),
                      "vectors", keep=True)
    error = identity_error(done.select("w", "whitened"), len(order), n) if len(order) else 0.0
    scratch.clear()
    shares = [float(v) for v in values[order] / np.trace(cov)] if len(order) else []
    return rows.join(done.drop("w"), DIGEST).select(
        "vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*(F.lit(s) for s in shares)).cast("array<double>").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
