"""Command line: ``python -m oddsline <fetch|consolidate|process|filter> ...`` (or spark-submit).

The three stages with their options as flags; the session comes from the
environment (``spark-submit`` settings) or a local one.

  fetch    --landing DIR --run-dir DIR [--start YYYY-MM-DD --end YYYY-MM-DD]
           [--minutes N | --hours N | --days N | --weeks N | --months N | --years N]
           (a look-back from --end, or from now; without any bound one month)
           [--store DIR] [--ledger DIR] [--version N] [--max-trades N] [--since-ms N]
           landing DIR holds Parquet tables market_pages, window_pages,
           price_payloads, book_payloads, trade_pages (any may be absent)
  consolidate  --run-dir DIR [--out DIR]   part files into tables, then the rest of the run
  process  --run-dir DIR | --scan-root DIR | --directory DIR | --prices FILE ...
           [--markets FILE ...] [--trades FILE ...]
           --out DIR --manifest DIR [--partition-by-day]
           (--directory sorts its files by their columns; given files come first)
  filter   --input PATH --output PATH [--start-date D] [--end-date D] [--resolved-only |
           --unresolved-only] [--min-age-days N] [--max-age-days N] [--as-of D]
           [--category C ...] [--exclude-category C ...] [--market-id M ...]
           [--exclude-market-id M ...] [--compute-jumps] [--min-jump-pct X] [--max-jump-pct X]
           [--min-jump-abs X] [--max-jump-abs X]
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    """The session; steps that need the shared folder ask for it themselves."""
    from oddsline.session import apply_conf

    spark = SparkSession.builder.appName("oddsline").getOrCreate()
    apply_conf(spark)
    return spark


def _ms(day: str | None) -> int | None:
    from oddsline.functions.timecols import date_start_ms

    return None if day is None else date_start_ms(day)


def cmd_fetch(a) -> dict:
    from oddsline.plans import fetch as FX
    from oddsline.plans.stores import ledger_table, market_store_table
    from oddsline.sources.files import scan_parquet

    spark = _session()

    def land(name):
        return scan_parquet(spark, f"{a.landing}/{name}")

    inputs = FX.FetchInputs(land("market_pages"), land("window_pages"), land("price_payloads"),
                            land("book_payloads"), land("trade_pages"))
    if inputs.market_pages is None:
        raise SystemExit("landing has no market_pages table")
    now = _dt.datetime.now(_dt.timezone.utc)
    start_ms, end_ms = _ms(a.start), _ms(a.end)
    units = {u: n for u in LOOKBACK_UNITS if (n := getattr(a, u)) is not None}
    if units and start_ms is not None:
        raise SystemExit("give --start or a look-back, not both")
    if start_ms is None and (units or end_ms is None):  # without any bound: one calendar month back
        from oddsline.functions.timecols import lookback_start_ms

        end_ms = int(now.timestamp() * 1000) if end_ms is None else end_ms
        start_ms = spark.range(1).select(lookback_start_ms(end_ms, **(units or {"months": 1})).alias("s")).first()["s"]
    res = FX.fetch_stage(
        spark, inputs, a.run_dir, start_ms=start_ms, end_ms=end_ms,
        fetch_ts=now.strftime("%Y-%m-%d %H:%M:%S"), now_iso=now.isoformat(),
        store=market_store_table(spark, a.store, FX.FULL_MARKET_STORE) if a.store else None,
        ledger=ledger_table(spark, a.ledger) if a.ledger else None, version=a.version,
        max_trades=a.max_trades, since_ms=a.since_ms, resolved_only=a.resolved_only)
    return {"paths": res.paths, "counts": res.counts, "rejects": res.rejects}


def cmd_process(a) -> dict:
    from oddsline.plans import stages
    from oddsline.sources import files as S

    spark = _session()
    if a.directory or a.prices:
        files = {"prices": a.prices, "markets": a.markets, "trades": a.trades}
        if a.directory:
            found = S.discover_files(spark, a.directory)
            files = {k: given or found[k] for k, given in files.items()}
        cfg = S.RunInput(mode="files", files=files)
    else:
        cfg = (S.RunInput(mode="run_dir", run_dir=a.run_dir) if a.run_dir
               else S.RunInput(mode="scan", root=a.scan_root))
    res = stages.process_stage(spark, a.out, a.manifest, S.scan_run_table(spark, cfg, "prices"),
                               S.scan_run_table(spark, cfg, "markets"), S.scan_run_table(spark, cfg, "trades"),
                               partition_by_day=a.partition_by_day, steps=tuple(a.steps))
    return {"paths": res.paths, "counts": res.counts}


def cmd_consolidate(a) -> dict:
    from oddsline.plans import stages

    return {"paths": stages.consolidate_stage(_session(), a.run_dir, a.out)}


def cmd_filter(a) -> dict:
    from oddsline.operators.filters import FilterConfig
    from oddsline.plans import stages

    spark = _session()
    cfg = FilterConfig(
        start_date=a.start_date, end_date=a.end_date, resolved_only=a.resolved_only,
        unresolved_only=a.unresolved_only, min_age_days=a.min_age_days, max_age_days=a.max_age_days,
        as_of=a.as_of or _dt.datetime.now(_dt.timezone.utc).date().isoformat(),
        categories=a.category, exclude_categories=a.exclude_category, market_ids=a.market_id,
        exclude_market_ids=a.exclude_market_id, compute_jumps=a.compute_jumps, min_jump_pct=a.min_jump_pct,
        max_jump_pct=a.max_jump_pct, min_jump_abs=a.min_jump_abs, max_jump_abs=a.max_jump_abs)
    return stages.filter_stage(spark.read.parquet(a.input), cfg, a.output)


LOOKBACK_UNITS = ("minutes", "hours", "days", "weeks", "months", "years")


def _positive(text: str) -> int:
    n = int(text)
    if n <= 0:
        raise argparse.ArgumentTypeError("must be positive")
    return n


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="oddsline")
    sub = p.add_subparsers(dest="command", required=True)

    f = sub.add_parser("fetch")
    f.add_argument("--landing", required=True)
    f.add_argument("--run-dir", required=True)
    f.add_argument("--start")
    f.add_argument("--end")
    back = f.add_mutually_exclusive_group()  # at most one unit
    for unit in LOOKBACK_UNITS:
        back.add_argument(f"--{unit}", type=_positive)
    f.add_argument("--store")
    f.add_argument("--ledger")
    f.add_argument("--version", type=int)
    f.add_argument("--max-trades", type=int)
    f.add_argument("--resolved-only", action="store_true")
    f.add_argument("--since-ms", type=int)
    f.set_defaults(run=cmd_fetch)

    pr = sub.add_parser("process")
    src = pr.add_mutually_exclusive_group(required=True)
    src.add_argument("--run-dir")
    src.add_argument("--scan-root")
    src.add_argument("--directory")
    src.add_argument("--prices", nargs="+")
    pr.add_argument("--markets", nargs="+")
    pr.add_argument("--trades", nargs="+")
    pr.add_argument("--out", required=True)
    pr.add_argument("--manifest", required=True)
    pr.add_argument("--partition-by-day", action="store_true")
    pr.add_argument("--steps", nargs="+", default=["join", "returns", "panel", "trades"],
                    choices=["join", "returns", "panel", "trades"])
    pr.set_defaults(run=cmd_process)

    co = sub.add_parser("consolidate")
    co.add_argument("--run-dir", required=True)
    co.add_argument("--out")
    co.set_defaults(run=cmd_consolidate)

    fl = sub.add_parser("filter")
    fl.add_argument("--input", required=True)
    fl.add_argument("--output", required=True)
    fl.add_argument("--start-date")
    fl.add_argument("--end-date")
    res = fl.add_mutually_exclusive_group()
    res.add_argument("--resolved-only", action="store_true")
    res.add_argument("--unresolved-only", action="store_true")
    fl.add_argument("--min-age-days", type=int)
    fl.add_argument("--max-age-days", type=int)
    fl.add_argument("--as-of")
    for name in ("category", "exclude-category", "market-id", "exclude-market-id"):
        fl.add_argument(f"--{name}", action="append")
    fl.add_argument("--compute-jumps", action="store_true")
    for name in ("min-jump-pct", "max-jump-pct", "min-jump-abs", "max-jump-abs"):
        fl.add_argument(f"--{name}", type=float)
    fl.set_defaults(run=cmd_filter)
    return p


def main(argv=None) -> int:
    args = parser().parse_args(argv)
    out = args.run(args)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
