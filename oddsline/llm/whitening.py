"""Op 13. Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Components become integers floor(256 * x). The distinct vectors, centred on
their exact mean, are the rows of X; they are packed into blocks in the shared
folder. The bidiagonalisation X V = U B alternates the products Xv and X'u:

* Every step is one job over the blocks. A task forms its rows of z = Xv - beta u
  and returns what the driver needs of them: z'z, U'z and X'z, summed on the
  cluster to one row per number (as many as dimensions plus steps).
* Full reorthogonalisation: U'z takes the earlier left vectors out of z, and
  the earlier right vectors are taken out of X'u twice. A left vector is as
  long as the table, so it is never held: it is X w for a short w that the
  driver keeps, and a task forms its own rows of it when needed.
* The small bidiagonal matrix's singular values and right vectors give the
  components and their deviations. The run ends when the residuals of the
  wanted components fall below ``TOLERANCE``, or after as many steps as there
  are dimensions. An exhausted Krylov space (repeated deviations, fewer
  directions than dimensions) is left through a new start vector, and the run
  then goes on to the last dimension.

Defined cases: null vectors and vectors with null or non-finite components are
dropped; a vector that is shorter than the longest has zeros for the rest;
repeated rows are returned each for itself and fitted once; entries beyond a
long are held at its bounds; a deviation that no long holds is null; components without deviation are left out, so fewer
than two distinct vectors and an empty table give an empty result; null ids
are kept; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsline.llm.common import tidy, written

BLOCK_VALUES = 1 << 18  # entries of a packed block
TOLERANCE = 1e-13       # of a component's residual, relative to the largest deviation
EMPTY = 1e-12           # a direction with less than this part of the norm holds nothing
_LONG = (1 << 63) - 1


def integers(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, x): the vectors without null or non-finite entries, as integers."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    held = lambda c: F.floor(F.greatest(F.least(256 * c, F.lit(2.0**63)), F.lit(-(2.0**63))))
    return vectors.where(F.col(vec_col).isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(v, held).cast("array<bigint>").alias("x"))


def padded(vectors: DataFrame, dims: int) -> DataFrame:
    return vectors.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("x"))))


def packed(fit: DataFrame, dims: int) -> DataFrame:
    """(data): the vectors in blocks of bounded size, as little-endian integers."""
    rows = max(1, BLOCK_VALUES // max(dims, 1))

    def run(batches):
        held, size = [], 0
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype("<i8")
            while len(x):
                held.append(x[: rows - size])
                x, size = x[rows - size :], size + len(held[-1])
                if size == rows:
                    yield _binary(np.concatenate(held))
                    held, size = [], 0
        if size:
            yield _binary(np.concatenate(held))

    return fit.select("x").mapInArrow(tidy(run), "data binary")


def _binary(x: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["data"])


class Rows:
    """The centred rows X in blocks, and sums over all of them."""

    def __init__(self, blocks: DataFrame, n: int, sums: list[int]):
        self.blocks, self.n, self.sums, self.dims = blocks, n, sums, len(sums)
        self.mean = np.array([s / n for s in sums])

    def total(self, of) -> np.ndarray:
        """The sum over the blocks of ``of(centred rows)``, a vector: summed in
        every task, then on the cluster, a row per number."""
        dims, mean = self.dims, self.mean

        def run(batches):
            out = None
            for b in batches:
                for data in b.column(0):
                    x = np.frombuffer(data.as_buffer(), "<i8").reshape(-1, dims) - mean
                    part = of(x)
                    out = part if out is None else out + part
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out))), pa.array(out)], ["k", "value"])

        rows = self.blocks.mapInArrow(tidy(run), "k long, value double").groupBy("k").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(len(rows))
        for k, value in rows:
            out[k] = value
        return out


def _fresh(seed: int, basis: np.ndarray) -> np.ndarray:
    """A unit vector orthogonal to the rows of ``basis``."""
    v = np.random.default_rng(seed).normal(size=basis.shape[1])
    for _ in range(2):
        v -= basis.T @ (basis @ v)
    return v / np.linalg.norm(v)


def bidiagonalise(rows: Rows, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest singular values of X, and its right singular vectors as rows."""
    dims = rows.dims
    v_all, w_all, a_all = np.zeros((0, dims)), np.zeros((0, dims)), np.zeros((0, dims))  # v_j; u_j = X w_j; X'u_j
    b = np.zeros((0, 0))  # B: u_i' X v_j
    v, w_last, beta, broken, scale = _fresh(0, v_all), None, 0.0, False, 0.0
    while True:
        j = len(v_all)
        lead, earlier = (v if w_last is None or not beta else v - beta * w_last), w_all

        def products(x, lead=lead, earlier=earlier):
            z = x @ lead
            return np.concatenate(([z @ z], x.T @ z, (x @ earlier.T).T @ z))

        got = rows.total(products)
        if not len(got):
            return np.zeros(0), np.zeros((0, dims))
        zz, xz, uz = got[0], got[1 : dims + 1], got[dims + 1 :]
        alpha = float(np.sqrt(max(zz - uz @ uz, 0.0)))
        scale = max(scale, alpha, beta)
        v_all = np.vstack((v_all, v))
        grown = np.zeros((len(w_all) + 1, j + 1))
        grown[: len(w_all), :j] = b
        grown[: len(w_all), j] = uz
        if w_last is not None and beta:
            grown[len(w_all) - 1, j] += beta
        if alpha > EMPTY * max(scale, 1e-300) and alpha > 0:
            grown[-1, j] = alpha
            w_last = (lead - uz @ w_all) / alpha
            a = (xz - uz @ a_all) / alpha
            w_all, a_all, b = np.vstack((w_all, w_last)), np.vstack((a_all, a)), grown
            rest = a.copy()
            for _ in range(2):
                rest -= v_all.T @ (v_all @ rest)
            beta = float(np.linalg.norm(rest))
        else:  # Xv lies in the span of the left vectors: no new one
            b, rest, beta = grown[:-1], np.zeros(dims), 0.0
        if len(v_all) == dims:
            break
        if beta <= EMPTY * max(scale, 1e-300):
            v, w_last, beta, broken = _fresh(len(v_all), v_all), None, 0.0, True
            continue
        v = rest / beta
        if not broken and len(b) >= k:
            left, s, _ = np.linalg.svd(b)
            if beta * np.abs(left[-1, :k]).max() <= TOLERANCE * s[0]:
                break
    if not len(b):
        return np.zeros(0), np.zeros((0, dims))
    _, s, right = np.linalg.svd(b)
    keep = [i for i in range(min(k, len(s))) if s[i] > EMPTY * s[0]]
    return s[keep], right[keep] @ v_all


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 4) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    usable = integers(vectors, id_col, vec_col)
    dims = usable.agg(F.max(F.size("x"))).first()[0] or 0
    if not dims:
        return spark.createDataFrame([], schema)
    usable = padded(usable, dims)
    blocks = written(packed(usable.select("x").distinct(), dims), "whitening-rows")

    def sums(batches):
        for b in batches:
            for data in b.column(0):
                x = np.frombuffer(data.as_buffer(), "<i8").reshape(-1, dims)
                high, low = x >> 32, x & 0xFFFFFFFF  # their sums of a block stay far below 2**63
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(dims + 1)), pa.array([*high.sum(axis=0).tolist(), 0], pa.int64()),
                    pa.array([*low.sum(axis=0).tolist(), len(x)], pa.int64())], ["k", "high", "low"])

    found = blocks.mapInArrow(tidy(sums), "k long, high long, low long").groupBy("k").agg(
        *(F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low"))).collect()  # a row per dimension
    exact = {r["k"]: (int(r["high"]) << 32) + int(r["low"]) for r in found}
    n, total = exact[dims], [exact[d] for d in range(dims)]
    rows = Rows(blocks, n, total)
    s, parts = bidiagonalise(rows, components)
    if not len(s):
        return spark.createDataFrame([], schema)
    spread, k, mean = s / np.sqrt(n), len(s), rows.mean
    to_white = parts.T / spread
    trace = rows.total(lambda x: np.array([(x * x).sum()]))[0]
    explained = s * s / trace
    centre = rows.total(lambda x: (x @ to_white).sum(axis=0)) / n
    cov = rows.total(lambda x: (lambda y: (y.T @ y).ravel())(x @ to_white - centre)).reshape(k, k) / n
    error = float(np.abs(cov - np.eye(k)).max())

    def run(batches):
        for b in batches:
            count = b.num_rows
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            largest = n * (int(np.abs(x.astype(float)).max(initial=0)) + 1) + max(map(abs, total))
            if dims * largest * largest <= _LONG:
                deviation = ((n * x - np.array(total, np.int64)) ** 2).sum(axis=1).tolist()
            else:  # Python's integers
                deviation = [sum((n * c - t) ** 2 for c, t in zip(r, total, strict=True)) for r in x.tolist()]
            white = (x - mean) @ to_white
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False), k) if not b.column(0).null_count
                         else [i for i in b.column(0).to_pylist() for _ in range(k)], pa.int64()),
                pa.array(np.tile(np.arange(1, k + 1), count), pa.int32()), pa.array(np.full(count * k, n)),
                pa.array([d if d <= _LONG else None for d in deviation for _ in range(k)], pa.int64()), pa.array(white.ravel()),
                pa.array(np.tile(explained, count)), pa.array(np.full(count * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable.mapInArrow(tidy(run), schema)
