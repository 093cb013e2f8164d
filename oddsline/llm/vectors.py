"""Vectors in blocks: what the two nearest-neighbour searches share.

A stated query set meets all vectors tile by tile: vectors are dealt into tiles
by hash, each met by a task of its own, and queries are packed into blocks that
are repeated once per tile. A task first holds its tile, in blocks of
``block_rows`` vectors; then query blocks pass by it one after another. So a
task holds one tile and one block of queries, whatever the table's size,
vectors travel once, queries once per tile (not per block), and nothing that
grows with the table is broadcast or passes through the driver: the two sides
are not joined but dealt out together, as Spark would take a join's side of
repeated queries for as small as the blocks were before they were repeated.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.sql.window import Window

from oddsline.llm.common import bucket, tidy

BLOCK_ROWS = 8192
QUERY_ROWS = 1024
TILE_VALUES = 1 << 23  # components of the vectors that a task holds
TASKS_A_CORE = 3       # tiles for each core, where there are blocks enough


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the vectors without null or non-finite components.

    A vec_id names a vector: of rows that repeat one, the least vector stays
    (within its block or tile). Rows with a null id take no part. Components
    are doubles, or floats where they came as such.
    """
    v = F.col(vec_col)
    if vectors.select(v).schema[0].dataType != ArrayType(FloatType()):
        v = v.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~bad)


def blocked(vectors: DataFrame, blocks: int) -> DataFrame:
    """(block, ids, lengths, data): vectors packed into ``blocks`` rows."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        kind = "<f4" if pdf["v"].iloc[0].dtype == np.float32 else "<f8"
        rows = sorted(zip(pdf["vec_id"].tolist(), map(tuple, pdf["v"])))
        rows = [r for k, r in enumerate(rows) if not k or rows[k - 1][0] != r[0]]
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])],
                             "ids": [np.array([r[0] for r in rows], "<i8").tobytes()],
                             "lengths": [np.array([len(r[1]) for r in rows], "<i4").tobytes()],
                             "data": [np.concatenate([np.asarray(r[1], kind) for r in rows]).tobytes()]})

    return vectors.withColumn("block", bucket(blocks, "vec_id")).groupBy("block").applyInPandas(
        pack, "block int, ids binary, lengths binary, data binary")


def rows_of(lengths: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Vectors as rows; shorter ones are padded with zeros."""
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = data
    return out


def matrix(ids: bytes, lengths: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors as rows) of a packed block of doubles or floats."""
    lengths = np.frombuffer(lengths, "<i4")
    kind = "<f4" if 4 * int(lengths.sum()) == len(data) else "<f8"
    return np.frombuffer(ids, "<i8"), rows_of(lengths, np.frombuffer(data, kind))


def _probed(blocks: DataFrame, probe: Callable | None) -> DataFrame:
    """Blocks of queries with what ``probe`` gives for them, in the column ``made`` (null without one)."""
    if probe is None:
        return blocks.withColumn("made", F.lit(None).cast("binary"))

    def run(pdfs):
        for pdf in pdfs:
            yield pdf.assign(made=[probe(matrix(r.ids, r.lengths, r.data)[1]) for r in pdf.itertuples(index=False)])

    return blocks.mapInPandas(run, "block int, ids binary, lengths binary, data binary, made binary")


class Tile:
    """The vectors a task holds, taken in order of their ids, in blocks of (ids, rows, what ``index`` gives for them)."""

    def __init__(self, block_rows: int, index: Callable | None):
        self.block_rows, self.index, self.last = block_rows, index, None
        self.blocks, self.held, self.count = [], [], 0

    def add(self, ids: np.ndarray, v: pa.ListArray) -> None:
        """Of rows that repeat a vec_id, the first one stays."""
        before = np.concatenate(([self.last if self.last is not None else ~ids[0]], ids[:-1]))
        fresh, self.last = ids != before, ids[-1]
        if not fresh.all():
            ids, v = ids[fresh], v.filter(pa.array(fresh))
        while len(ids):
            n = min(len(ids), self.block_rows - self.count)
            part = v.slice(0, n)
            self.held.append((ids[:n], part.value_lengths().to_numpy(), part.flatten().to_numpy()))
            self.count += n
            ids, v = ids[n:], v.slice(n)
            if self.count == self.block_rows:
                self.close()

    def close(self) -> None:
        """What is held becomes a block."""
        if self.count:
            ids, lengths, data = map(np.concatenate, zip(*self.held, strict=True))
            v = rows_of(lengths, data)
            self.blocks.append((ids, v, self.index(v) if self.index else None))
            self.held, self.count = [], 0


def _tiles(vectors: DataFrame, count: int, values: int, block_rows: int, tile_values: int) -> int:
    """How many tiles: so many that each has ``tile_values`` at most, and all cores get some."""
    spread = TASKS_A_CORE * vectors.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-values // tile_values), min(-(-count // block_rows), spread))


def search(vectors: DataFrame, is_query, score: Callable, score_type: str, k: int = 5,
           block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, index: Callable | None = None,
           probe: Callable | None = None, tile_values: int = TILE_VALUES) -> DataFrame:
    """The ``k`` best rows per query: query_id, rank, vec_id, score.

    ``score(query ids, queries, ids, rows)`` yields (query index, row index,
    score) arrays that hold at least each query's ``k`` best of the block.
    With ``index(rows)``, made once per block by the task that holds it, and
    ``probe(queries)``, bytes made once per block of queries, it takes probe's
    and index's of the two blocks as well.
    """
    count, queries, values = vectors.agg(
        F.count("*"), F.count(F.when(is_query, 1)), F.coalesce(F.sum(F.size("v")), F.lit(0))).first()
    tiles, query_blocks = _tiles(vectors, count, values, block_rows, tile_values), max(1, -(-queries // query_rows))
    asked = blocked(vectors.where(is_query), query_blocks)
    if probe:  # blocks of queries are small, but searching the index for them is not: one task each
        asked = asked.repartitionById(query_blocks, "block")
    asked = _probed(asked, probe).select(
        F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), F.col("ids").alias("q_ids"),
        F.col("lengths").alias("q_lengths"), F.col("data").alias("q_data"), F.col("made").alias("q_made"))
    dealt = vectors.select(bucket(tiles, "vec_id").alias("tile"), "vec_id", "v").unionByName(
        asked, allowMissingColumns=True).repartitionById(tiles, "tile").sortWithinPartitions(
        "tile", F.col("vec_id").asc_nulls_last(), "v").select(  # a tile's vectors, then its queries
        "tile", "vec_id", "v", "q_ids", "q_lengths", "q_data", "q_made")

    def run(batches):
        at, tile = None, None
        for b in batches:
            numbers = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if start == end:
                    continue
                if at != numbers[start]:
                    at, tile = numbers[start], Tile(block_rows, index)
                part = b.slice(start, end - start)
                n = len(part) - part.column(1).null_count
                if n:
                    tile.add(part.column(1).slice(0, n).to_numpy(), part.column(2).slice(0, n))
                if n < len(part):
                    tile.close()
                for packed in zip(*part.slice(n).columns[3:], strict=True):
                    yield from meet(tile, *(x.as_py() for x in packed))

    def meet(tile, q_ids, q_lengths, q_data, q_made):
        q_ids, q0 = matrix(q_ids, q_lengths, q_data)
        for ids, v, made in tile.blocks:
            width = max(q0.shape[1], v.shape[1])
            q, v = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q0, v))
            a, b, s = score(q_ids, q, ids, v, *((q_made, made) if index else ()))
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[a]), pa.array(ids[b]), pa.array(s)], ["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(tidy(run), f"query_id long, vec_id long, score {score_type}")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` highest scores, all ties with the last included
    only as far as the smaller ids go."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]
