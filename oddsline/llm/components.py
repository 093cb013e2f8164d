"""Connected components of an edge table.

Edges point from the larger node u to the smaller v. A round has two steps:

* Every task contracts its own edges (at most ``CONTRACTED`` at once) to stars
  that name the same components; then every u keeps its least v, and its other
  v are tied to that one. A node has one edge per task by then, so a hub that
  millions of edges name is no large group.
* Edges jump over their v where that has a smaller one. This joins the edges
  with a table of one row per node, both read from the shared folder, so that
  a hub's rows may be split over tasks.

It ends when no u has a second v and no v a smaller one: a star per component.
Paths halve with every round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsline.llm.common import tidy, written

CONTRACTED = 1 << 20  # edges that a task contracts at once


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of every node that isn't its component's least."""
    nodes, index = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = index[: len(a)], index[len(a) :]
    least = np.arange(len(nodes))
    while len(a):
        m = np.minimum(least[a], least[b])
        for at in (a, b, least[a], least[b]):
            np.minimum.at(least, at, m)
        while not np.array_equal(after := least[least], least):
            least = after
        open_ = least[a] != least[b]
        a, b = a[open_], b[open_]
    moved = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[moved], nodes[least[moved]]


def contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges (u, v), u > v, with the components of ``edges`` (its first two columns, longs)."""
    def run(batches):
        held, size = [], 0

        def flush():
            u, v = stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns[:2]])
            size += batch.num_rows
            if size >= CONTRACTED:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return edges.mapInArrow(tidy(run), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (long columns a, b, not null); the
    root is the component's least node and is listed too. Nodes that are only
    tied to themselves are not listed."""
    now = edges
    while True:
        least = contracted(now).groupBy("u").agg(F.min("v").alias("m"), F.collect_set("v").alias("vs"))
        rows = written(least.select(F.explode(F.concat(F.array(F.struct("u", F.lit(True).alias("parent"))), F.transform(
            F.array_remove("vs", F.col("m")), lambda v: F.struct(v.alias("u"), F.lit(False).alias("parent"))))).alias("x"),
            F.col("m").alias("v")).select("x.u", "v", "x.parent"), "ties")
        up = rows.where("parent").select(F.col("u").alias("v"), F.col("v").alias("m"))
        now = written(rows.join(up, "v", "left").select("u", F.coalesce("m", "v").alias("v"),
                                                        (~F.col("parent") | F.col("m").isNotNull()).alias("open")), "edges")
        if now.where("open").isEmpty():
            break
    members = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
