"""Structured Streaming counterparts of the batch ingest (A14 and §7.5).

* ``ingest_prices`` -- landed price-history payloads (a directory of
  Parquet drops) -> decoded points + provenance, and refused payloads with
  the reason: one stream, two sinks. Every micro-batch writes a folder named
  by its number in either sink, and a replayed batch overwrites its own, so
  nothing is written twice; restarts resume from the checkpoint,
  ``maxRecordsPerFile`` bounds file size and the trigger sets the flush
  interval.
* ``dedupe_prices_all`` -- the batch rule D11 (of a token's points at one time
  the first in chunk order stays) for drops that arrive in any order: every
  micro-batch writes the winners among its own points, ``read_deduped`` takes
  the winners of winners. A point is never late, and one that comes later but
  precedes in chunk order replaces the earlier winner, its price included.
* ``dedupe_prices`` -- event time = t, watermark, then
  ``dropDuplicatesWithinWatermark(token_id, t)``: bounded state; the first
  arrival stays, and later points than the watermark are dropped.
* ``trades_daily`` -- daily tumbling windows per condition in append mode;
  a day is emitted once the watermark passes its end; rows later than the
  watermark are dropped by the engine (count them with ``late_rows``). The
  days still open when the stream stops stay in its state.
* ``trades_daily_all`` -- the same totals for a run to completion: every
  micro-batch writes the sums of its own rows, ``read_trades_daily`` adds
  them up. No watermark and no state, so no day stays open and no row is late.

Checkpoint locations default to a fresh folder under the session's shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from oddsline.functions.timecols import day_bucket
from oddsline.operators.decode import decode_price_history
from oddsline.operators.planning import dedupe_price_points
from oddsline.schemas import PRICE_PAYLOADS, TRADES
from oddsline.session import checkpoint_dir
from oddsline.sources.files import with_provenance


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint dir (never reused)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/oddsline-{name}-{uuid.uuid4().hex[:12]}"


def _start(df: DataFrame, out_path: str, ckpt: str, trigger: dict | None, fmt: str = "parquet",
           mode: str = "append", max_records_per_file: int | None = None) -> StreamingQuery:
    w = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", ckpt)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start(out_path)


def ingest_prices(spark: SparkSession, landing_dir: str, out_path: str, checkpoint: str | None = None,
                  trigger: dict | None = None, max_files_per_trigger: int | None = None,
                  max_records_per_file: int | None = None) -> StreamingQuery:
    """Stream landed payloads into a decoded, provenance-stamped Parquet
    table under ``out_path``/points, the refused ones into ``out_path``/rejects."""
    reader = spark.readStream.schema(PRICE_PAYLOADS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # both sinks decode the same payloads
        try:
            points, rejects = decode_price_history(batch)
            points = with_provenance(points, "clob", "/prices-history", "1970-01-01 00:00:00") \
                .withColumn("_fetch_timestamp", F.current_timestamp())
            for name, rows in (("points", points), ("rejects", rejects)):
                w = rows.write.mode("overwrite")
                if max_records_per_file:
                    w = w.option("maxRecordsPerFile", max_records_per_file)
                w.parquet(f"{out_path}/{name}/batch={batch_id}")
        finally:
            batch.unpersist()

    w = reader.parquet(landing_dir).writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "ingest-ckpt"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def read_ingested(spark: SparkSession, out_path: str, sink: str = "points") -> DataFrame:
    """What ``ingest_prices`` has written to its ``points`` or ``rejects``."""
    return spark.read.parquet(f"{out_path}/{sink}").drop("batch")


def dedupe_prices_all(points: DataFrame, out_path: str, checkpoint: str | None = None,
                      trigger: dict | None = None) -> StreamingQuery:
    """D11 on a stream of decoded points (token_id, t, p, chunk_start, pos)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        dedupe_price_points(batch).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    w = points.writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint or scratch_path(points.sparkSession, "dedupe-ckpt"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def read_deduped(spark: SparkSession, out_path: str) -> DataFrame:
    """One point per (token_id, t) from the batches of ``dedupe_prices_all``."""
    return dedupe_price_points(spark.read.parquet(out_path).drop("batch"))


def dedupe_prices(points: DataFrame, delay: str = "1 day") -> DataFrame:
    """Streaming D11: first arrival per (token_id, t) within the watermark."""
    ev = points.withColumn("event_time", F.timestamp_millis("t"))
    return ev.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["token_id", "t"])


def trades_daily(trades: DataFrame, delay: str = "1 day") -> DataFrame:
    """Streaming F10: per condition and UTC day, emitted when the day closes."""
    ev = trades.withColumn("event_time", F.timestamp_millis("timestamp"))
    g = (ev.withWatermark("event_time", delay)
         .groupBy("conditionId", F.window("event_time", "1 day"))
         .agg(F.count(F.lit(1)).alias("trades"), F.sum("size").alias("_s"),
              F.sum(F.col("size") * F.col("price")).alias("_n")))
    return g.select("conditionId", F.unix_millis(F.col("window.start")).alias("day_ts"), "trades",
                    F.coalesce("_s", F.lit(0.0)).alias("size_sum"), F.coalesce("_n", F.lit(0.0)).alias("notional_sum"))


def trades_daily_all(trades: DataFrame, out_path: str, checkpoint: str | None = None,
                     trigger: dict | None = None) -> StreamingQuery:
    """Sums per condition and UTC day of each micro-batch, written to a folder
    named by the batch; a replayed batch overwrites its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        g = batch.groupBy("conditionId", day_bucket("timestamp").alias("day_ts")).agg(
            F.count(F.lit(1)).alias("trades"), F.sum("size").alias("size_sum"),
            F.sum(F.col("size") * F.col("price")).alias("notional_sum"))
        g.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    w = trades.writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint or scratch_path(trades.sparkSession, "trades-ckpt"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def read_trades_daily(spark: SparkSession, out_path: str) -> DataFrame:
    """One row per condition and day from the batches of ``trades_daily_all``."""
    return (spark.read.parquet(out_path).groupBy("conditionId", "day_ts")
            .agg(F.sum("trades").alias("trades"), F.coalesce(F.sum("size_sum"), F.lit(0.0)).alias("size_sum"),
                 F.coalesce(F.sum("notional_sum"), F.lit(0.0)).alias("notional_sum")))


def late_rows(q: StreamingQuery) -> int:
    """Rows the stateful operators dropped as later than the watermark,
    summed over the query's recent progress reports.

    Spark counts them at the state store, after partial aggregation, so
    late input rows of one group in one batch partition count once."""
    total = 0
    for prog in q.recentProgress:
        for op in prog.get("stateOperators", []) if isinstance(prog, dict) else getattr(prog, "stateOperators", []):
            n = op.get("numRowsDroppedByWatermark") if isinstance(op, dict) else getattr(op, "numRowsDroppedByWatermark", 0)
            total += int(n or 0)
    return total


def run_to_completion(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def ingest_prices_table(spark: SparkSession, landing: DataFrame, sink: str = "points") -> DataFrame:
    """Land ``landing`` as Parquet drops, stream them through ``ingest_prices``
    with ``availableNow`` and return the sink's table."""
    land_dir = scratch_path(spark, "landing")
    landing.write.parquet(land_dir)
    out = scratch_path(spark, "prices-out")
    run_to_completion(ingest_prices(spark, land_dir, out))
    return read_ingested(spark, out, sink)


def dedupe_prices_table(spark: SparkSession, drops: list[DataFrame]) -> DataFrame:
    """The drops (frames of points), streamed one after another, deduplicated."""
    src, out, ckpt = (scratch_path(spark, f"dedupe-{k}") for k in ("points", "out", "ckpt"))
    for k, drop in enumerate(drops):
        drop.write.parquet(f"{src}/drop{k}")
        stream = spark.readStream.schema(drop.schema).parquet(f"{src}/*")
        run_to_completion(dedupe_prices_all(stream, out, ckpt))
    return read_deduped(spark, out)


def _trades_stream(spark: SparkSession, trades: DataFrame) -> DataFrame:
    src_dir = scratch_path(spark, "trades")
    trades.select(*[f.name for f in TRADES.fields if f.name in trades.columns], "conditionId") \
        .write.parquet(src_dir)
    schema = spark.read.parquet(src_dir).schema
    return spark.readStream.schema(schema).parquet(src_dir)


def trades_daily_all_table(spark: SparkSession, trades: DataFrame) -> DataFrame:
    """All days of ``trades``, the last ones too."""
    out = scratch_path(spark, "trades-out")
    run_to_completion(trades_daily_all(_trades_stream(spark, trades), out))
    return read_trades_daily(spark, out)


def trades_daily_table(spark: SparkSession, trades: DataFrame) -> DataFrame:
    """The closed days of ``trades``."""
    stream = _trades_stream(spark, trades)
    out = scratch_path(spark, "trades-out")
    run_to_completion(_start(trades_daily(stream), out, scratch_path(spark, "trades-ckpt"), None))
    return spark.read.parquet(out)
