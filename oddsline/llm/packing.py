"""Op 3. Packing: best-fit decreasing over a segment tree of remaining capacity.

Each document's ids (plus the end id) are first cut into full windows of
``window`` ids; only the remainder, shorter than a window, has to be placed.
Remainders are dealt into shards of about ``shard_rows`` by hash and each
shard is packed on its own: longest first, every piece into the open window
with the least room that still holds it. A segment tree over the capacities
0..window finds that window in log2(window) steps. A shard wastes at most a
few half-empty windows, so more shards cost almost no padding, and no shard
grows with the data.

Defined cases: null or empty text is one piece holding the end id only;
repeated rows are packed each for itself; ties in length go by doc_id (nulls
first), then start; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsline.llm.common import bucket, tidy
from oddsline.llm.tokens import tokenizer

WINDOW = 4096
SHARD_ROWS = 8192
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"


class RoomTree:
    """Windows by remaining room; ``tightest(n)`` is the least room >= n in use."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, room: int, by: int) -> None:
        k = room + self.size
        while k:
            self.count[k] += by
            k >>= 1

    def put(self, room: int, window: int) -> None:
        self.open[room].append(window)
        self._add(room, 1)

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.open[room].pop()

    def tightest(self, n: int) -> int:
        """-1 if no open window has room for n."""
        k = n + self.size
        if self.count[k]:
            return n
        while k > 1:
            if not k & 1 and self.count[k + 1]:
                k += 1
                while k < self.size:
                    k <<= 1
                    if not self.count[k]:
                        k += 1
                return k - self.size
            k >>= 1
        return -1


def best_fit(lengths, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset) of each length, which must come longest first."""
    tree = RoomTree(window)
    where, offset, opened = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i, n in enumerate(lengths):
        n = int(n)
        room = tree.tightest(n)
        if room < 0:
            room, at, opened = window, opened, opened + 1
        else:
            at = tree.take(room)
        where[i], offset[i] = at, window - room
        if room > n:
            tree.put(room - n, at)
    return where, offset


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 2, window: int = WINDOW,
           keep_ids: bool = False) -> DataFrame:
    """Every document's ids cut into full windows and a remainder (``PIECES``;
    with ``keep_ids`` also the ids as little-endian unsigned 32-bit bytes)."""
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches):
        enc = tokenizer(tokenizer_path)
        for b in batches:
            ids_col, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows: list[tuple] = []
            for i, ids in zip(ids_col, enc.encode_many([t or "" for t in texts]), strict=True):
                ids += end
                n = len(ids) // 4
                for s in range(0, n, window):
                    part = ids[4 * s : 4 * (s + window)]
                    rows.append((i, s, len(part) // 4, crc32(part), n, part) if keep_ids
                                else (i, s, len(part) // 4, crc32(part), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
    kinds = [pa.int64()] * 5 + [pa.binary()] * keep_ids
    schema = PIECES + ", ids binary" * keep_ids
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return some.mapInArrow(tidy(lambda it: cut(b for b in it if b.num_rows)), schema)


def pack(parts: DataFrame, rows: int, window: int = WINDOW, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Pieces of at most ``window`` ids placed into sequences (adds
    sequence_id and offset). ``rows``: about how many pieces there are, from
    which the number of shards follows."""
    shards = max(1, -(-rows // shard_rows))

    def place(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True],
                              na_position="first", kind="stable")
        where, offset = best_fit(pdf["length"].to_numpy(), window)
        pdf["sequence_id"], pdf["offset"] = (int(key[0]) << 32) + where, offset
        return pdf.drop(columns="shard")

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return (parts.withColumn("shard", bucket(shards, "doc_id", "start", "ids_crc32"))
            .groupBy("shard").applyInPandas(place, schema + ", sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, window: int = WINDOW,
                   shard_rows: int = SHARD_ROWS, keep_ids: bool = False) -> DataFrame:
    """All documents packed: one row per piece (``PACKED``)."""
    return pack(pieces(docs, tokenizer_path, end_id, window, keep_ids), docs.count(), window, shard_rows)
