"""Op 5. Token-id output: static range asymmetric numeral system (rANS).

File format: a Parquet table whose rows are blocks. Every block holds the
ids of consecutive documents, in ascending doc_id order over (part, block),
coded with one frequency table that is shared by all blocks and stored beside
them. A block is coded by ``lanes`` interleaved coders (id i belongs to lane
i mod lanes), so a decoder handles a whole row of lanes at a time; it starts
from the stored coder states at the block's head or at any checkpoint, and
checks the block's checksum. Blocks need nothing from each other: a file is
decoded in parallel by rows, and a block in parallel by checkpoints.

Jobs: sort the documents by doc_id (range shuffle), tokenise, cut into raw
blocks and write those; count ids over all blocks; code each block and write
the files. The counts give every id of the vocabulary at least one slot, so
any id can be coded.

Defined cases: null or empty text is the end id alone; a null doc_id sorts
first; repeated doc_ids are separate documents next to each other, ordered by
text; a document longer than a block runs over several; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oddsline.llm.common import scratch, tidy, written
from oddsline.llm.tokens import tokenizer

SCALE = 20                 # the frequencies sum to 2**SCALE
LOW = np.uint64(1 << 31)   # states stay in [2**31, 2**63); 32 bits move at a time
BLOCK = 1 << 20            # ids in a block
LANES = 1024
CHECKPOINT = 256           # steps (rows of lanes) between checkpoints
U32 = np.uint64(32)

RAW = "part int, block int, start long, ids binary, doc_ids binary, nulls binary, lengths binary, before binary, doc_lengths binary"
CODED = ("part int, block int, start long, n_tokens long, lanes int, ids_crc32 long, states binary, "
         "checkpoints binary, words binary, doc_ids binary, nulls binary, lengths binary, before binary, doc_lengths binary")


# ------------------------------------------------------------------ coder

def normalise(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE, each at least 1, near counts' shares."""
    total = 1 << SCALE
    counts = np.asarray(counts, np.float64)
    spare = total - len(counts)
    share = counts / max(counts.sum(), 1) * spare
    freq = np.floor(share).astype(np.int64) + 1
    left = total - int(freq.sum())
    order = np.argsort(-(share - np.floor(share)), kind="stable")
    freq[order[:left]] += 1
    return freq


class Table:
    def __init__(self, freq: np.ndarray):
        self.freq = np.asarray(freq, np.uint64)
        self.cum = np.concatenate(([0], np.cumsum(self.freq)[:-1])).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def encode(ids: np.ndarray, table: Table, lanes: int = LANES) -> tuple:
    """(lanes, states at the head, checkpoints, words) of a block's ids.

    Lanes start from the last row and work backwards, so a decoder reads
    forwards. A checkpoint is the states and the words' position before a row.
    """
    n = len(ids)
    lanes = max(1, min(lanes, n // 32))
    steps = -(-n // lanes)
    x = np.full(lanes, LOW, np.uint64)
    chunks: list[np.ndarray] = [None] * steps
    marks: dict[int, np.ndarray] = {}
    freq, cum = table.freq, table.cum
    shift = np.uint64(63 - SCALE)
    scale = np.uint64(SCALE)
    for step in range(steps - 1, -1, -1):
        s = ids[step * lanes : (step + 1) * lanes]
        part = x[: len(s)]
        f = freq[s]
        full = part >= (f << shift)
        chunks[step] = part[full].astype(np.uint32)
        part = np.where(full, part >> U32, part)
        q, r = np.divmod(part, f)
        x[: len(s)] = (q << scale) + r + cum[s]
        if step and step % CHECKPOINT == 0:
            marks[step] = x.copy()
    sizes = np.cumsum([0] + [len(c) for c in chunks])
    checkpoints = b"".join(np.uint64(sizes[k]).tobytes() + marks[k].tobytes() for k in sorted(marks))
    words = np.concatenate(chunks).tobytes() if chunks else b""
    return lanes, x.tobytes(), checkpoints, words


def decode(n: int, lanes: int, states: bytes, checkpoints: bytes, words: bytes, table: Table,
           span: int | None = None) -> np.ndarray:
    """All ids of a block, or those from checkpoint ``span`` (0: the head) to the next."""
    stream = np.frombuffer(words, np.uint32)
    first, last, at = 0, -(-n // lanes), 0
    x = np.frombuffer(states, np.uint64).copy()
    if span is not None:
        if span:
            row = checkpoints[(span - 1) * 8 * (lanes + 1) : span * 8 * (lanes + 1)]
            at, x = int(np.frombuffer(row[:8], np.uint64)[0]), np.frombuffer(row[8:], np.uint64).copy()
        first, last = span * CHECKPOINT, min(last, (span + 1) * CHECKPOINT)
    freq, cum, symbol = table.freq, table.cum, table.symbol
    mask, scale = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    out = np.empty(min(n, last * lanes) - first * lanes, np.uint32)
    for step in range(first, last):
        m = min(lanes, n - step * lanes)
        part = x[:m]
        slot = part & mask
        s = symbol[slot]
        part = freq[s] * (part >> scale) + slot - cum[s]
        need = np.flatnonzero(part < LOW)
        if len(need):
            part[need] = (part[need] << U32) | stream[at : at + len(need)]
            at += len(need)
        x[:m] = part
        out[(step - first) * lanes : (step - first) * lanes + m] = s
    return out


def crc_join(first: int, second: int, length: int) -> int:
    """CRC-32 of two buffers put together, from theirs and the second's length."""
    def times(a: int, b: int) -> int:  # polynomials modulo the CRC's, lowest power in the top bit
        out = 0
        for k in range(31, -1, -1):
            if a >> k & 1:
                out ^= b
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        return out

    power, factor, e = 0x80000000, 0x00800000, length  # 1 and x**8
    while e:
        if e & 1:
            power = times(power, factor)
        factor = times(factor, factor)
        e >>= 1
    return times(power, first) ^ second


# ------------------------------------------------------------------ jobs

def raw_blocks(docs: DataFrame, tokenizer_path: str, end_id: int = 1, block: int = BLOCK) -> DataFrame:
    """The documents' ids in ascending doc_id order, cut into raw blocks (``RAW``)."""
    def cut(batches):
        enc = tokenizer(tokenizer_path)
        end = np.asarray([end_id], "<u4").tobytes()
        small = enc.vocab <= 1 << 16 and end_id < 1 << 16
        part, number, start, have = TaskContext.get().partitionId(), 0, 0, 0
        held: list[tuple] = []  # (doc_id, ids before the piece, the piece, ids of the document)

        def emit():
            nonlocal number, start, have, held
            ids = np.frombuffer(b"".join(h[2] for h in held), "<u4")
            row = (part, number, start, (ids.astype("<u2") if small else ids).tobytes(),
                   np.array([h[0] or 0 for h in held], "<i8").tobytes(),
                   np.array([h[0] is None for h in held], np.uint8).tobytes(),
                   np.array([len(h[2]) // 4 for h in held], "<i8").tobytes(),
                   np.array([h[1] for h in held], "<i8").tobytes(),
                   np.array([h[3] for h in held], "<i8").tobytes())
            number, start, have, held = number + 1, start + len(ids), 0, []
            kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 6]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        names = ["part", "block", "start", "ids", "doc_ids", "nulls", "lengths", "before", "doc_lengths"]
        for b in batches:
            for i, ids in zip(b.column(0).to_pylist(),
                              enc.encode_many([t or "" for t in b.column(1).to_pylist()]), strict=True):
                ids, at = ids + end, 0
                while at < len(ids):
                    take = ids[at : at + 4 * (block - have)]
                    held.append((i, at // 4, take, len(ids) // 4))
                    have, at = have + len(take) // 4, at + len(take)
                    if have == block:
                        yield emit()
        if held:
            yield emit()

    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (some.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
            .mapInArrow(tidy(lambda it: cut(b for b in it if b.num_rows)), RAW))


def _ids(data: bytes, lengths: bytes) -> np.ndarray:
    n = int(np.frombuffer(lengths, "<i8").sum())
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4")


def count_ids(raw: DataFrame, vocab: int) -> np.ndarray:
    """How often each id occurs in all blocks: one row per id and task, then one per id."""
    def count(batches):
        total = np.zeros(vocab, np.int64)
        for b in batches:
            for data, lengths in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total += np.bincount(_ids(data, lengths), minlength=vocab)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    rows = (raw.select("ids", "lengths").mapInArrow(tidy(count), "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).toPandas())  # at most one row per vocabulary entry
    out = np.zeros(vocab, np.int64)
    out[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def write_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 1, block: int = BLOCK) -> None:
    """The documents' ids written under ``path``: blocks/ and table/ (Parquet)."""
    spark = docs.sparkSession
    raw = written(raw_blocks(docs, tokenizer_path, end_id, block), "raw-blocks", compression="zstd")
    vocab = max(tokenizer(tokenizer_path).vocab, end_id + 1)
    freq = normalise(count_ids(raw, vocab))
    shared = spark.sparkContext.broadcast(freq.astype(np.int32))  # bounded by the vocabulary

    def code(batches):
        table = Table(shared.value)
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                ids = _ids(r["ids"], r["lengths"])
                lanes, states, marks, words = encode(ids, table)
                r |= {"n_tokens": len(ids), "lanes": lanes, "ids_crc32": crc32(ids.astype("<u4").tobytes()),
                      "states": states, "checkpoints": marks, "words": words}
                del r["ids"]
                yield pa.RecordBatch.from_pylist([r], schema)

    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in CODED.split(", "))])
    raw.mapInArrow(tidy(code), CODED).write.option("compression", "none").parquet(f"{path}/blocks")
    spark.createDataFrame(pd.DataFrame({"freq": [freq.astype("<i4").tobytes()]})).coalesce(1).write.parquet(f"{path}/table")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document read back from the files: doc_id, start, n_tokens, ids_crc32."""
    blocks = spark.read.schema(CODED).parquet(f"{path}/blocks")
    freq = np.frombuffer(spark.read.parquet(f"{path}/table").first()["freq"], "<i4")
    shared = spark.sparkContext.broadcast(freq)  # bounded by the vocabulary

    def read(batches):
        table = Table(shared.value)
        for b in batches:
            for r in b.to_pylist():
                ids = decode(r["n_tokens"], r["lanes"], r["states"], r["checkpoints"], r["words"], table)
                flat = ids.astype("<u4").tobytes()
                if crc32(flat) != r["ids_crc32"]:
                    raise ValueError(f"block {r['part']}/{r['block']}: checksum differs")
                lengths = np.frombuffer(r["lengths"], "<i8")
                ends = np.cumsum(lengths)
                crcs = [crc32(flat[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                k = len(lengths)
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["part"]] * k, pa.int32()),
                    pa.array(np.frombuffer(r["doc_ids"], "<i8"), mask=np.frombuffer(r["nulls"], np.uint8).astype(bool)),
                    pa.array(np.frombuffer(r["before"], "<i8")), pa.array(r["start"] + ends - lengths), pa.array(lengths),
                    pa.array(np.frombuffer(r["doc_lengths"], "<i8")),
                    pa.array(crcs, pa.int64())], names)

    names = ["part", "doc_id", "before", "at", "n", "doc_n", "crc"]
    found = blocks.mapInArrow(tidy(read), "part int, doc_id long, before long, at long, n long, doc_n long, crc long")
    whole = found.where("n = doc_n").select("part", "doc_id", "at", F.col("n").alias("n_tokens"),
                                            F.col("crc").alias("ids_crc32"))

    def join_pieces(pdfs):
        for pdf in pdfs:
            pdf["ids_crc32"] = [_joined(ps) for ps in pdf.pop("ps")]
            yield pdf

    over = (found.where("n < doc_n").groupBy("part", "doc_id", (F.col("at") - F.col("before")).alias("at"))
            .agg(F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("before", "n", "crc"))).alias("ps"))
            .mapInPandas(join_pieces, "part int, doc_id long, at long, n_tokens long, ids_crc32 long"))
    sizes = blocks.groupBy("part").agg(F.sum("n_tokens").alias("size"))  # one row per written partition
    before = sizes.withColumn("base", F.sum("size").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).na.fill(0, ["base"])
    return whole.union(over).join(before, "part").select(
        "doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def _joined(ps) -> int:
    crc = 0
    for p in ps:
        crc = crc_join(crc, p["crc"], 4 * p["n"])
    return crc


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, block: int = BLOCK) -> DataFrame:
    """Write the documents to fresh files in the shared folder and read them back."""
    path = scratch(docs.sparkSession, "rans")
    write_files(docs, tokenizer_path, path, end_id, block)
    return read_files(docs.sparkSession, path)
