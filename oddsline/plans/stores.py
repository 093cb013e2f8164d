"""Persistent market store and window ledger as versioned Parquet tables.

A merge never overwrites what it read: it writes the merged table as the
next version (newest + 1 unless a free number is named) and commits it by
creating one file exclusively; the newest committed version is the current
one, and a merge that loses the race for a number starts again from it. A
writer that may replay a merge (a stream's batches) tags its versions with
(writer, batch); a batch that was already written is skipped, so the merge is
idempotent.

``stream_market_merge`` keeps the store current from a stream of incoming
market versions with ``foreachBatch``: each micro-batch is merged with the
batch operator (``lifecycle.market_snapshot_merge``), a plain grouped
aggregate; no per-key Python state is kept.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from oddsline.operators import lifecycle as C
from oddsline.operators import planning as D
from oddsline.schemas import LEDGER
from oddsline.sources.files import commit_file, delete_dir, list_dir, read_text

_VERSION = re.compile(r"v(\d{10})$")

MARKET_STORE = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("question", T.StringType()),
    T.StructField("resolved", T.IntegerType()), T.StructField("closed", T.IntegerType()),
    T.StructField("cached_at", T.StringType()), T.StructField("updated_at", T.StringType()),
])


class VersionedTable:
    """A table whose every write is a new, complete version.

    A version's rows lie in a folder of their own (``data/<unique name>``); the
    version exists once its commit file ``commits/v<number>`` does. That file is
    created exclusively, so of two writers of the same number one loses, and
    loses nothing: ``update`` merges again, with what the winner wrote. A commit
    also carries the last batch of every tagged writer.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def versions(self) -> list[int]:
        names = (p.rstrip("/").rsplit("/", 1)[1] for p in list_dir(self.spark, f"{self.root}/commits"))
        return sorted(int(m[1]) for m in map(_VERSION.match, names) if m)

    def _commit(self, version: int | None) -> dict:
        if not version:
            return {"data": None, "batches": {}}
        return json.loads(read_text(self.spark, f"{self.root}/commits/v{version:010d}"))

    def _latest(self) -> tuple[int, dict]:
        version = max(self.versions(), default=0)
        return version, self._commit(version)

    def path(self, version: int) -> str:
        """The folder of a version's rows."""
        return f"{self.root}/data/{self._commit(version)['data']}"

    def _read(self, commit: dict) -> DataFrame:
        if commit["data"] is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{commit['data']}")

    def current(self) -> DataFrame:
        return self._read(self._latest()[1])

    def update(self, merge: Callable[[DataFrame], DataFrame], version: int | None = None, tag: str | None = None) -> str | None:
        """Commit ``merge(current rows)`` as the next version, or as ``version``,
        which must be free. Where another writer commits first, its rows are
        read and merged in turn.

        ``tag`` is ``<writer>_<batch number>``; returns None (nothing written)
        when that writer's batch, or a later one, was written before."""
        writer, batch = (tag.rsplit("_", 1)[0], int(tag.rsplit("_", 1)[1])) if tag else (None, 0)
        while True:
            latest, commit = self._latest()
            if writer is not None and commit["batches"].get(writer, -1) >= batch:
                return None
            if version is not None and version <= latest and version in self.versions():
                raise FileExistsError(f"version {version} of {self.root} exists")
            name = uuid.uuid4().hex
            folder, number = f"{self.root}/data/{name}", latest + 1 if version is None else version
            merge(self._read(commit)).select(*[f.name for f in self.schema.fields]).write.parquet(folder)
            batches = commit["batches"] | ({writer: batch} if writer is not None else {})
            if commit_file(self.spark, f"{self.root}/commits/v{number:010d}", json.dumps({"data": name, "batches": batches})):
                return folder
            delete_dir(self.spark, folder)  # the loser's rows

    def write(self, df: DataFrame, version: int | None = None, tag: str | None = None) -> str | None:
        """Commit ``df`` as it is, whatever the current rows are."""
        return self.update(lambda _: df, version, tag)


def merge_markets(store: VersionedTable, incoming: DataFrame, now_iso: str, version: int | None = None,
                  tag: str | None = None) -> str | None:
    """C7 on the persistent store: current version + incoming -> new version."""
    return store.update(lambda now: C.market_snapshot_merge(now, incoming, now_iso).drop("version_seq"), version, tag)


def merge_ledger(ledger: VersionedTable, marks: DataFrame, version: int | None = None) -> str | None:
    """D6 on the persistent ledger: last write wins per window key."""
    return ledger.update(lambda now: D.window_ledger_merge(now, marks), version)


def ledger_table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, LEDGER)


def market_store_table(spark: SparkSession, root: str, schema: T.StructType | None = None) -> VersionedTable:
    """The market store; ``schema`` defaults to the compact form (id, question,
    flags, stamps); the fetch stage keeps whole market rows."""
    return VersionedTable(spark, root, schema or MARKET_STORE)


def stream_market_merge(spark: SparkSession, incoming_dir: str, incoming_schema: T.StructType,
                        store_root: str, now_iso: str, checkpoint: str, trigger: dict | None = None):
    """Keep the market store current from a directory stream of market
    versions (id, seq, question, resolved, closed).

    Each micro-batch becomes the next store version, tagged with this stream
    (its checkpoint) and the batch; a replayed batch is skipped.
    """
    store = market_store_table(spark, store_root)
    writer = f"{crc32(checkpoint.encode()):08x}"

    def apply(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            merge_markets(store, batch, now_iso, tag=f"{writer}_{batch_id}")

    src = spark.readStream.schema(incoming_schema).parquet(incoming_dir)
    w = src.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
