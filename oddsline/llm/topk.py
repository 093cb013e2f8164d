"""Op 9. Exact top-k: exhaustive term-at-a-time accumulation.

Components become integers floor(256 * x). A vector is a sparse row of
(dimension, weight) postings. For each block of vectors the postings of one
dimension after another are scattered, times the query's weight, into a dense
array of scores (a row per query); a partition selection then takes every
query's best of the block, and the blocks' best are merged by a ranked window
(which cuts to the best k before it shuffles).

Sums are 64-bit integers; where a block's weights are so large that 64 bits
might not hold a sum, exact Python integers are used and a result outside the
long range is clamped to it.

Defined cases: null vectors or vectors with null or non-finite components take
no part; dimensions that a vector lacks count 0 (an empty vector scores 0);
ties go to the smaller vec_id; of rows that repeat a vec_id one stays; rows
with a null vec_id take no part; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsline.llm.vectors import best_of, search, usable

_LONG = (1 << 63) - 1


def weights(v: np.ndarray) -> np.ndarray:
    """floor(256 * x): as 64-bit integers, or as Python integers if too large."""
    w = np.floor(256.0 * v)
    if np.abs(w).max(initial=0) < 2.0**53:
        return w.astype(np.int64)
    exact = np.empty(v.shape, object)
    for at, x in np.ndenumerate(v):
        a, b = float(x).as_integer_ratio()
        exact[at] = 256 * a // b
    return exact


def accumulate(q: np.ndarray, v: np.ndarray, dims: int) -> np.ndarray:
    """Scores of every query (rows) with every vector (columns)."""
    big = object in (q.dtype, v.dtype) or (
        int(np.abs(q).max(initial=0)) * int(np.abs(v).max(initial=0)) * max(dims, 1) > _LONG)
    scores = np.zeros((len(q), len(v)), object if big else np.int64)
    for d in range(dims):
        rows, at = np.flatnonzero(q[:, d] != 0), np.flatnonzero(v[:, d] != 0)  # the sparse queries; the postings of d
        if not len(rows) or not len(at):
            continue
        posted = v[at, d]
        for r in rows:
            if len(at) == len(v):
                scores[r] += q[r, d] * posted
            else:
                scores[r, at] += q[r, d] * posted
    return scores


def exact_topk(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50,
               k: int = 5, **blocks) -> DataFrame:
    """Each query's (vec_id divisible by ``every``) ``k`` highest inner products."""
    def score(q_ids, q, ids, v):
        qw, vw, dims = weights(q), weights(v), v.shape[1]
        a, b, s = [], [], []
        for at in range(0, len(qw), 64):  # the score arrays stay small
            scores = accumulate(qw[at : at + 64], vw, dims)
            for r, row in enumerate(scores):
                if row.dtype == object:
                    row = np.array([min(max(x, -_LONG - 1), _LONG) for x in row], np.int64)
                others = np.flatnonzero(ids != q_ids[at + r])
                top = others[best_of(row[others], ids[others], k)]
                a += [at + r] * len(top)
                b += top.tolist()
                s += row[top].tolist()
        return np.array(a, int), np.array(b, int), np.array(s, np.int64)

    return search(usable(vectors, id_col, vec_col), F.col("vec_id") % every == 0, score, "long", k, **blocks)
