"""Stage drivers: the process stage (F11, F12), the filter stage (G10) and
the backfill plan (markets -> jobs -> pending chunks).

Each driver builds lazy plans from the operators and writes them. Output
row counts are read from the committed files' footers (metadata only, exact
under task retries); the filter report's counts are observed during its
single pass.
The daily means feed two outputs, so they are checkpointed once to the
shared checkpoint folder (lineage cut, survives executor loss).
"""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddsline.operators import filters as G
from oddsline.operators import planning as D
from oddsline.operators import process as P
from oddsline.schemas import LEDGER
from oddsline.session import reliable_checkpoint
from oddsline.sources.files import (
    commit_file, committed_rows, compact_parts, list_dir, part_paths, promote_run_tables, read_text, validate_columns,
    write_versioned, write_with_manifest,
)

log = logging.getLogger("oddsline.stages")


@dataclass
class ProcessResult:
    paths: dict[str, str] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    panel: dict[str, str] = field(default_factory=dict)  # paths of the panel's blocks and columns


def _nonempty(df: DataFrame) -> bool:
    return not df.isEmpty()


STEPS = ("join", "returns", "panel", "trades")


def process_stage(spark: SparkSession, out_dir: str, manifest_path: str, prices: DataFrame | None,
                  markets: DataFrame | None = None, trades: DataFrame | None = None,
                  partition_by_day: bool = False, steps: tuple[str, ...] = STEPS) -> ProcessResult:
    """Build and write prices_joined, daily_returns, price_panel, trades_daily_agg.

    Missing inputs skip the outputs that need them (with a warning).
    prices_joined and price_panel are not written when empty; daily_returns
    and trades_daily_agg are written even when empty. With
    ``partition_by_day`` the joined prices are written partitioned by UTC
    ``day`` (yyyy-MM-dd), so date-range filters prune whole directories.
    ``steps`` names the outputs to build. The panel is written in blocks of
    ``P.PANEL_BLOCK`` token columns with the table of their names beside it
    (``read_panel`` reads both), and as one wide table where one block holds all
    tokens; a panel that fails is logged and leaves the other outputs alone.
    """
    unknown = set(steps) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps {sorted(unknown)}; known: {STEPS}")
    for kind, table in (("prices", prices), ("markets", markets), ("trades", trades)):
        if table is not None:
            validate_columns(P.normalize_prices(table) if kind == "prices" else table, kind)
    res = ProcessResult()
    out = out_dir.rstrip("/")
    if "join" in steps and prices is not None and markets is not None:
        joined = P.prices_joined(prices, markets)
        parts = None
        if partition_by_day:
            joined = joined.withColumn(G.DAY_PARTITION, F.date_format(F.timestamp_millis("t"), "yyyy-MM-dd"))
            parts = [G.DAY_PARTITION]
        if _nonempty(joined):
            res.paths["prices_joined"], res.counts["prices_joined"] = write_with_manifest(
                joined, "prices_joined", f"{out}/prices_joined.parquet", manifest_path, partition_by=parts)
        else:
            log.warning("no joined prices; prices_joined not written")
    elif "join" in steps and prices is not None:
        log.warning("no markets table; prices_joined skipped")
    if prices is not None and {"returns", "panel"} & set(steps):
        daily = reliable_checkpoint(P.daily_mean_price(prices))
        if "returns" in steps:
            rets = P.returns_from_daily(daily, markets)
            res.paths["daily_returns"], res.counts["daily_returns"] = write_with_manifest(
                rets, "daily_returns", f"{out}/daily_returns.parquet", manifest_path)
        if "panel" in steps and _nonempty(daily):
            try:
                _write_panel(daily, out, manifest_path, res)
            except Exception as e:  # noqa: BLE001
                log.warning("price_panel failed: %s", e)
        elif "panel" in steps:
            log.warning("no daily prices; price_panel not written")
    elif prices is None:
        log.warning("no prices input; joined, returns and panel skipped")
    if "trades" not in steps:
        return res
    if trades is not None:
        agg = P.trades_daily_agg(trades)
        res.paths["trades_daily_agg"], res.counts["trades_daily_agg"] = write_with_manifest(
            agg, "trades_daily_agg", f"{out}/trades_daily_agg.parquet", manifest_path)
    else:
        log.warning("no trades input; trades_daily_agg skipped")
    return res


def _write_panel(daily: DataFrame, out: str, manifest_path: str, res: ProcessResult) -> None:
    """The panel's blocks in one job, partitioned by block, and the table of its
    columns' names; a panel of one block also as one table with those names."""
    panel = P.build_panel(daily)
    spark = daily.sparkSession
    res.panel["columns"] = write_versioned(panel.columns, f"{out}/price_panel_columns.parquet")
    tokens = committed_rows(spark, res.panel["columns"])
    if tokens <= P.PANEL_BLOCK:
        res.panel["blocks"] = write_versioned(panel.rows, f"{out}/price_panel_blocks.parquet", ["block"])
        wide = read_panel(spark, res).wide().sortWithinPartitions("day_ts")
        res.paths["price_panel"], _ = write_with_manifest(wide, "price_panel", f"{out}/price_panel.parquet", manifest_path)
    else:
        rows = panel.rows.sortWithinPartitions("block", "day_ts")
        res.paths["price_panel"], _ = write_with_manifest(
            rows, "price_panel", f"{out}/price_panel_blocks.parquet", manifest_path, partition_by=["block"])
        res.panel["blocks"] = res.paths["price_panel"]
    dims = P.panel_dims(daily).first()
    res.counts["price_panel"], res.counts["panel_tokens"] = dims["panel_days"], tokens


def read_panel(spark: SparkSession, res: ProcessResult) -> P.Panel:
    """The panel that a process stage wrote."""
    return P.Panel(spark.read.parquet(res.panel["blocks"]), spark.read.parquet(res.panel["columns"]), P.PANEL_BLOCK)


RUN_TABLES = ("markets", "prices", "orderbooks", "spreads", "trades", "rejects")


def consolidate_stage(spark: SparkSession, run_dir: str, out_dir: str | None = None,
                      target_file_bytes: int = 256 << 20) -> dict[str, str]:
    """The part files of a run become tables of the processed area
    (``<run>_processed`` beside the run by default; the parts stay), and the run's
    other tables are promoted with them -- only if something was compacted.

    All tables become visible at once: they are written under versioned names,
    and one commit file then names them (``read_consolidated``). A table that
    fails is logged and left out. Returns the committed tables' paths, none if
    there was nothing to compact."""
    out = out_dir or f"{run_dir.rstrip('/')}_processed"
    done: dict[str, str] = {}
    parted = [name for name in RUN_TABLES if part_paths(spark, run_dir, name)]
    for name in parted:
        try:
            done[name] = compact_parts(spark, run_dir, name, out, target_file_bytes)
        except Exception as e:  # noqa: BLE001
            log.warning("compaction of %s failed: %s", name, e)
    if not done:
        return {}
    promoted = promote_run_tables(spark, run_dir, out, [n for n in RUN_TABLES if n not in parted])
    done |= {name: path for name, path in promoted.items() if path}
    number = 1
    while not commit_file(spark, f"{out}/_commits/v{number:010d}", json.dumps(done)):
        number += 1
    return done


def read_consolidated(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """Table paths of the newest commit of ``consolidate_stage``."""
    commits = list_dir(spark, f"{out_dir}/_commits")
    return json.loads(read_text(spark, commits[-1])) if commits else {}


def filter_stage(df: DataFrame, cfg: G.FilterConfig, output_path: str) -> dict:
    """Filter, compute jumps, write; returns the report (counts observed in one pass)."""
    r = G.run_filter(df, cfg)
    r.frame.write.mode("errorifexists").parquet(output_path)
    rep = r.report()
    rep["output_path"] = output_path
    return rep


def backfill_plan(markets: DataFrame, ledger: DataFrame | None, start_ms: int, end_ms: int,
                  fidelity: int, points: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Markets -> token jobs -> 14-day chunks -> minus completed ledger windows.

    With ``points`` (fetched price points: token_id, t) each pending chunk
    gets its point count and the empty-run rule trims every token's chunk
    sequence, all in one co-grouped pass by token. Returns (pending chunks,
    job rejects).
    """
    jobs, rejects = D.token_jobs(markets, start_ms, end_ms)
    chunks = D.chunk_windows(jobs)
    if points is None:
        pending = D.pending_windows(chunks, ledger, fidelity) if ledger is not None else chunks
        return pending, rejects
    if ledger is None:
        ledger = chunks.sparkSession.createDataFrame([], LEDGER)
    counted = D.pending_with_counts(chunks, ledger, fidelity, D.chunk_of_points(points, jobs))
    return D.empty_run_cutoff(counted), rejects
