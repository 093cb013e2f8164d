"""Op 1. Approximate nearest neighbours: a forest of random-projection trees.

Fit: trees are grown on a bounded sample (the ``SAMPLE`` vectors with the
least hash of their id), each by a task of its own. A node's plane is the
difference of two random members, cut at the median, down to leaves of about
``LEAF`` members; a plane is kept as the numbers of its two members, so the
forest is small. The trees are shared with all tasks; their size depends on
the sample only.

Index: vectors are dealt into blocks (see ``vectors``). Every block is passed
through all trees once, by the task that holds it, and keeps, per tree, its
rows in order of their leaves: the shard of the index that a search reads.
Blocks have a bounded size, so a leaf of a shard has as few rows as one of the
sample, however large the table.

Search: each query is searched once, by one priority queue over all trees. It
holds nodes by their distance beyond the planes crossed on the way and pops
the nearest, until the leaves seen hold ``SHARE`` of the sample (and at least
``LEAST`` of its vectors, so that some are found in tiny tables). The
candidates are all rows of all shards in those leaves; their exact cosines, in
double precision, decide. Many small leaves find more than few large ones: the
same share of the rows lies closer to the query. Recall is measured in the tests.

Defined cases: null vectors, zero vectors and vectors with null or non-finite
components take no part; dimensions that a vector lacks count 0; ties go to
the smaller vec_id; of rows that repeat a vec_id one stays; a sample of equal
vectors is one leaf; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsline.llm.vectors import best_of, matrix, search, usable

TREES, LEAF, SAMPLE = 128, 8, 8192
SHARE, LEAST = 0.35, 256
ROWS = 512        # projected at once
QUERY_ROWS = 512  # queries searched by one task


def unit(v: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that no square overflows or vanishes."""
    big = np.abs(v).max(axis=1, keepdims=True, initial=0)
    v = v / np.where(big > 0, big, 1)
    length = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(length > 0, length, 1)


def grow(sample: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, ...]:
    """One tree, all nodes of a level at once: its planes' two members and cuts, numbered
    as in a heap (the children of k are 2k + 1 and 2k + 2), and the leaf of every member."""
    rng = np.random.default_rng(seed)
    nodes = (1 << depth) - 1
    a, b, cut = np.zeros(nodes, np.int32), np.zeros(nodes, np.int32), np.full(nodes, np.inf)
    node = np.zeros(len(sample), np.int64)
    for _ in range(depth):
        shuffled = np.lexsort((rng.random(len(sample)), node))
        at, start, count = np.unique(node[shuffled], return_index=True, return_counts=True)
        a[at], b[at] = shuffled[start], shuffled[start + (count > 1)]
        side = ((sample[a[at]] - sample[b[at]])[np.searchsorted(at, node)] * sample).sum(axis=1)
        cut[at] = side[np.lexsort((side, node))[start + (count - 1) // 2]]
        node = 2 * node + 1 + (side > cut[node])
    return a, b, cut, (node - nodes).astype(np.int32)


class Forest:
    """Planes of all trees in arrays of (tree, node); no node has more than two children."""

    def __init__(self, sample: np.ndarray, depth: int, trees: list[tuple[np.ndarray, ...]]):
        self.sample, self.depth = sample, depth
        self.a, self.b, self.cut, leaf = (np.stack(x) for x in zip(*trees, strict=True))
        self.trees, self.leaves, self.nodes = len(trees), 1 << depth, (1 << depth) - 1
        self.members, self.first = shard(leaf, self.leaves)
        length = np.stack([np.sqrt(((sample[a] - sample[b]) ** 2).sum(axis=1)) for a, b in zip(self.a, self.b, strict=True)])
        self.length = np.where(length > 0, length, 1)

    def fitted(self, m: np.ndarray) -> np.ndarray:
        """Rows at length 1, as wide as the sample."""
        width, m = self.sample.shape[1], unit(m)
        return m[:, :width] if m.shape[1] >= width else np.pad(m, ((0, 0), (0, width - m.shape[1])))

    def leaf_of(self, v: np.ndarray) -> np.ndarray:
        """Leaf numbers (tree, row) of fitted rows."""
        out, tree = np.zeros((self.trees, len(v)), np.int32), np.arange(self.trees)[:, None]
        for at in range(0, len(v), ROWS):
            near = self.sample @ v[at : at + ROWS].T  # a plane's side is the difference of two of these
            row, node = np.arange(near.shape[1])[None, :], np.zeros((self.trees, near.shape[1]), np.int64)
            for _ in range(self.depth):
                a, b, cut = self.a[tree, node], self.b[tree, node], self.cut[tree, node]
                node = 2 * node + 1 + (near[a, row] - near[b, row] > cut)
            out[:, at : at + ROWS] = node - self.nodes
        return out

    def probe(self, q: np.ndarray, share: float, least: int) -> list[int]:
        """The leaves (tree * leaves + leaf) to look into for one fitted query."""
        near, size = self.sample @ q, len(self.sample)
        side = (near[self.a] - near[self.b] - self.cut) / self.length
        right, away_of = side > 0, np.abs(side)
        queue = [(0.0, k, 0) for k in range(self.trees)]
        covered, want, have, seen = np.zeros(size, bool), max(share * size, min(least, size)), 0, []
        while queue and have < want:
            away, k, node = heapq.heappop(queue)
            while node < self.nodes:  # the near side is as near as the node itself
                child = 2 * node + 1 + int(right[k, node])
                heapq.heappush(queue, (max(away, float(away_of[k, node])), k, 4 * node + 3 - child))
                node = child
            leaf = k * self.leaves + node - self.nodes
            seen.append(leaf)
            m = self.members[self.first[leaf] : self.first[leaf + 1]]
            have += int((~covered[m]).sum())
            covered[m] = True
        return seen


def shard(leaf: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of (tree, leaf), and where each leaf's rows begin."""
    trees, rows = leaf.shape
    code = leaf + np.arange(trees)[:, None] * leaves
    order = np.argsort(leaf, axis=1, kind="stable").astype(np.int32).ravel()
    return order, np.concatenate(([0], np.cumsum(np.bincount(code.ravel(), minlength=trees * leaves)))).astype(np.int32)


def pack(seen: list[list[int]]) -> bytes:
    """The leaves that each query looks into, as they travel: steps between sorted numbers, compressed."""
    steps = [np.diff(np.sort(s), prepend=0) for s in seen]
    return zlib.compress(np.concatenate([[len(s) for s in seen], *steps]).astype("<i4").tobytes(), 1)


def unpack(packed: bytes, queries: int) -> list[np.ndarray]:
    numbers = np.frombuffer(zlib.decompress(packed), "<i4")
    return [np.cumsum(s) for s in np.split(numbers[queries:], np.cumsum(numbers[:queries])[:-1])]


def fit(vectors: DataFrame, sample_rows: int = SAMPLE, trees: int = TREES, leaf: int = LEAF, seed: int = 7) -> Forest | None:
    """The forest of a (vec_id, v) table, grown on a bounded sample; None if it is empty."""
    spark = vectors.sparkSession
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toPandas()
    if not len(rows):
        return None
    lengths = np.array([len(v) for v in rows["v"]], "<i4")
    _, sample = matrix(rows["vec_id"].to_numpy("<i8").tobytes(), lengths.tobytes(),
                       np.concatenate([np.asarray(v, "<f8") for v in rows["v"]]).tobytes())
    sample = unit(sample)
    depth = max(0, int(np.ceil(np.log2(len(sample) / leaf))))
    shared = spark.sparkContext.broadcast(sample)  # at most sample_rows vectors

    def run(pdfs):
        for pdf in pdfs:
            for k in pdf["id"]:
                a, b, cut, at = grow(shared.value, depth, seed * 1_000_003 + int(k))
                yield pd.DataFrame({"tree": [k], "a": [a.tobytes()], "b": [b.tobytes()], "cut": [cut.tobytes()], "at": [at.tobytes()]})

    grown = spark.range(0, trees, 1, max(1, trees // 8)).mapInPandas(
        run, "tree long, a binary, b binary, cut binary, at binary").toPandas().sort_values("tree")
    shared.destroy()
    return Forest(sample, depth, [(np.frombuffer(r.a, np.int32), np.frombuffer(r.b, np.int32), np.frombuffer(r.cut),
                                   np.frombuffer(r.at, np.int32)) for r in grown.itertuples()])


def nearest(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50, k: int = 5,
            share: float = SHARE, least: int = LEAST, forest: Forest | None = None, query_rows: int = QUERY_ROWS,
            **blocks) -> DataFrame:
    """Each query's (vec_id divisible by ``every``) ``k`` nearest rows found, by cosine."""
    some = usable(vectors, id_col, vec_col).where(F.exists("v", lambda x: x != 0))
    forest = forest or fit(some)
    shared = vectors.sparkSession.sparkContext.broadcast(forest)  # bounded by the sample

    def index(v):
        f = shared.value
        return shard(f.leaf_of(f.fitted(v)), f.leaves)

    def probe(q):
        f = shared.value
        return pack([f.probe(x, share, least) for x in f.fitted(q)])

    def score(q_ids, q, ids, v, probed, indexed):
        q, v, (order, first) = unit(q), unit(v), indexed
        a, b, s = [], [], []
        for r, leaf in enumerate(unpack(probed, len(q_ids))):
            size = first[leaf + 1] - first[leaf]
            rows = order[np.repeat(first[leaf + 1] - np.cumsum(size), size) + np.arange(size.sum())]
            looked = np.zeros(len(v), bool)
            looked[rows] = True
            at = np.flatnonzero(looked & (ids != q_ids[r]))
            cosine = (v[at] * q[r]).sum(axis=1)
            top = best_of(cosine, ids[at], k)
            a += [r] * len(top)
            b += at[top].tolist()
            s += cosine[top].tolist()
        return np.array(a, int), np.array(b, int), np.array(s, float)

    return search(some, F.col("vec_id") % every == 0, score, "double", k, query_rows=query_rows,
                  index=index, probe=probe, **blocks)
