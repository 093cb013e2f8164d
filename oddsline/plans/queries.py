"""Registered queries: one per operator key of the inventory.

Each takes (spark, sf_dir), reads whole tables through the adapter views
and returns a DataFrame; ``present.rounded`` is the last step so that the
result compares with its oracle SQL (``oracles.py``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddsline.operators import filters as G
from oddsline.operators import process as P
from oddsline.plans.present import round6, rounded
from oddsline.plans import stages
from oddsline.session import reliable_checkpoint
from oddsline.sources import adapters as A

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Fixed query parameters (shared with oracles.py).
DATE_START, DATE_END = "2024-01-05", "2024-01-20"
AGE_AS_OF, MIN_AGE, MAX_AGE = "2024-02-15", 30, 60
CATEGORIES = ["BUILDING", "MACHINERY", "FURNITURE"]
EXCLUDE_CATEGORIES = ["FURNITURE"]
EXCLUDE_IDS = [f"M{k}" for k in range(0, 400, 4)]          # 100 ids as literals
INCLUDE_IDS_LONG = [f"M{k}" for k in range(0, 200_000, 6)]  # long list -> semi join
MIN_JUMP_PCT, MAX_JUMP_ABS = 0.5, 200.0


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _joined(spark, sf):
    return P.prices_joined(A.prices(spark, sf), A.markets(spark, sf))


# ------------------------------------------------------------------ F

@register("token_market_map")
def q_token_market_map(spark, sf):
    return rounded(P.token_market_map(A.markets(spark, sf)))


@register("prices_joined")
def q_prices_joined(spark, sf):
    return rounded(_joined(spark, sf))


@register("day_bucket")
def q_day_bucket(spark, sf):
    t = A.trades(spark, sf)
    return P.with_day(t.select("id", F.col("timestamp").alias("t")))


@register("daily_mean_price")
def q_daily_mean_price(spark, sf):
    return rounded(P.daily_mean_price(A.prices(spark, sf)))


@register("daily_returns")
def q_daily_returns(spark, sf):
    return rounded(P.daily_returns(A.prices(spark, sf)))


@register("daily_returns_edge")
def q_daily_returns_edge(spark, sf):
    return rounded(P.daily_returns(A.prices_edge(spark, sf)), kinds=("ret",))


@register("daily_returns_v2")
def q_daily_returns_v2(spark, sf):
    return rounded(P.daily_returns(A.prices_v2(spark, sf)))


@register("daily_returns_enriched")
def q_daily_returns_enriched(spark, sf):
    return rounded(P.daily_returns(A.prices(spark, sf), A.markets(spark, sf)))


@register("price_panel")
def q_price_panel(spark, sf):
    # The panel's columns follow the data, so it is compared cell by cell: the
    # wide blocks in long form again. Values are rounded before the pivot.
    daily = rounded(P.daily_mean_price(A.prices(spark, sf), value_name="price"))
    return P.build_panel(reliable_checkpoint(daily)).cells()


@register("panel_dims")
def q_panel_dims(spark, sf):
    return P.panel_dims(P.daily_mean_price(A.prices(spark, sf)))


@register("trades_daily_agg")
def q_trades_daily_agg(spark, sf):
    return rounded(P.trades_daily_agg(A.trades(spark, sf)))


# ------------------------------------------------------------------ G

@register("filter_date_range")
def q_filter_date_range(spark, sf):
    return rounded(G.filter_date_range(_joined(spark, sf), DATE_START, DATE_END))


@register("filter_resolved")
def q_filter_resolved(spark, sf):
    return rounded(G.filter_resolved(_joined(spark, sf), True))


@register("filter_unresolved")
def q_filter_unresolved(spark, sf):
    return rounded(G.filter_resolved(_joined(spark, sf), False))


@register("filter_market_age")
def q_filter_market_age(spark, sf):
    return rounded(G.filter_market_age(_joined(spark, sf), AGE_AS_OF, MIN_AGE, MAX_AGE))


@register("filter_category")
def q_filter_category(spark, sf):
    return rounded(G.filter_category(_joined(spark, sf), CATEGORIES, EXCLUDE_CATEGORIES))


@register("filter_market_ids")
def q_filter_market_ids(spark, sf):
    return rounded(G.filter_market_ids(_joined(spark, sf), include=INCLUDE_IDS_LONG, exclude=EXCLUDE_IDS))


def _combined_cfg(**jumps) -> G.FilterConfig:
    return G.FilterConfig(start_date=DATE_START, end_date=DATE_END, unresolved_only=True,
                          exclude_categories=EXCLUDE_CATEGORIES, as_of=AGE_AS_OF, max_age_days=MAX_AGE,
                          **jumps)


@register("filter_combined")
def q_filter_combined(spark, sf):
    return rounded(G.apply_filters(_joined(spark, sf), _combined_cfg())[0])


@register("compute_jumps")
def q_compute_jumps(spark, sf):
    return rounded(G.compute_jumps(A.prices(spark, sf)))


@register("compute_jumps_range")
def q_compute_jumps_range(spark, sf):
    # The skew-proof plan (range-partitioned previous row), forced.
    return rounded(G.compute_jumps(A.prices(spark, sf), mode="range"))


@register("compute_jumps_edge")
def q_compute_jumps_edge(spark, sf):
    return rounded(G.compute_jumps(A.prices_edge(spark, sf)), kinds=("jump_abs", "jump_pct"))


@register("filter_jumps")
def q_filter_jumps(spark, sf):
    cfg = _combined_cfg(min_jump_pct=MIN_JUMP_PCT, max_jump_abs=MAX_JUMP_ABS)
    res = G.run_filter(_joined(spark, sf), cfg)
    return rounded(res.frame)


@register("filter_report")
def q_filter_report(spark, sf):
    cfg = _combined_cfg(min_jump_pct=MIN_JUMP_PCT, max_jump_abs=MAX_JUMP_ABS)
    return G.filter_report_frame(_joined(spark, sf), cfg)


# ------------------------------------------------------------------ E

from oddsline.operators import book as E  # noqa: E402
from oddsline.operators import decode as B  # noqa: E402

DEPTH_DISTANCE = 0.1


def _books(spark, sf):
    return B.decode_orderbook(A.book_payloads(spark, sf))[0]


@register("book_levels")
def q_book_levels(spark, sf):
    return rounded(E.flatten_books(_books(spark, sf)))


@register("book_ladder")
def q_book_ladder(spark, sf):
    return rounded(E.book_ladder(A.book_levels(spark, sf)))


@register("best_quotes")
def q_best_quotes(spark, sf):
    return rounded(E.best_quotes(A.book_levels(spark, sf)))


@register("mid_spread")
def q_mid_spread(spark, sf):
    return rounded(E.mid_spread(E.best_quotes(A.book_levels(spark, sf))))


@register("spread_snapshot")
def q_spread_snapshot(spark, sf):
    return rounded(E.book_quotes_from_arrays(_books(spark, sf)))


@register("spread_snapshot_levels")
def q_spread_snapshot_levels(spark, sf):
    return rounded(E.spread_snapshot(A.book_levels(spark, sf)))


@register("spread_decoded_books")
def q_spread_decoded_books(spark, sf):
    # Levels of decoded books: several books of a token have timestamp 0.
    return rounded(E.spread_snapshot(E.flatten_books(_books(spark, sf))))


@register("depth_at_distance")
def q_depth_at_distance(spark, sf):
    return rounded(E.depth_at_distance(A.book_levels(spark, sf), DEPTH_DISTANCE))


@register("depth_decoded_books")
def q_depth_decoded_books(spark, sf):
    return rounded(E.depth_at_distance(E.flatten_books(_books(spark, sf)), DEPTH_DISTANCE))


@register("depth_from_books")
def q_depth_from_books(spark, sf):
    return rounded(E.depth_from_arrays(_books(spark, sf), DEPTH_DISTANCE))


# ------------------------------------------------------------------ B

from oddsline.functions import timecols as TC  # noqa: E402


@register("decode_price_history")
def q_decode_price_history(spark, sf):
    return rounded(B.decode_price_history(A.price_payloads(spark, sf))[0])


@register("normalize_timestamps")
def q_normalize_timestamps(spark, sf):
    land = A.price_payloads(spark, sf)
    v = F.try_parse_json("payload")
    pts = land.select("token_id", "chunk_start", F.posexplode(
        F.try_variant_get(v, "$.history", "array<variant>")).alias("pos", "pt"))
    tv = F.try_variant_get(F.col("pt"), "$.t", "variant")
    return pts.select("token_id", "chunk_start", "pos",
                      F.when(B._is_type(tv, "STRING"), F.lit("text")).otherwise(F.lit("number")).alias("t_kind"),
                      B.point_timestamp_ms(tv).alias("t_ms"))


@register("iso_to_epoch_ms")
def q_iso_to_epoch_ms(spark, sf):
    m = A.markets(spark, sf)
    return m.select("id", TC.iso_to_ms("created_at").alias("created_ms"), TC.iso_to_ms("end_date").alias("end_ms"),
                    TC.iso_to_ms("resolution_date").alias("resolution_ms"),
                    TC.iso_to_ms(F.concat(F.lit("day "), "id")).alias("bad_ms"))


@register("epoch_ms_to_iso")
def q_epoch_ms_to_iso(spark, sf):
    p = A.prices(spark, sf)
    return p.select("token_id", "t", TC.ms_to_iso("t").alias("iso"),
                    TC.ms_to_iso(TC.day_bucket("t")).alias("day_iso"))


@register("decode_orderbook")
def q_decode_orderbook(spark, sf):
    b = _books(spark, sf)
    return rounded(b.select(
        "token_id", "timestamp", F.size("bids").alias("n_bids"), F.size("asks").alias("n_asks"),
        F.get("bids", 0)["price"].alias("best_bid"), F.get("asks", 0)["price"].alias("best_ask"),
        F.aggregate("bids", F.lit(0.0), lambda a, x: a + x["size"]).alias("bid_size"),
        F.aggregate("asks", F.lit(0.0), lambda a, x: a + x["size"]).alias("ask_size"),
        F.concat_ws(",", F.transform("bids", lambda x: F.format_number(x["price"], 2))).alias("bid_ladder"),
        F.concat_ws(",", F.transform("asks", lambda x: F.format_number(x["price"], 2))).alias("ask_ladder")))


@register("decode_trades")
def q_decode_trades(spark, sf):
    return rounded(_trades_decoded(spark, sf))


@register("decode_trades_rest")
def q_decode_trades_rest(spark, sf):
    return B.decode_trades(A.trade_pages(spark, sf)).select("page", "pos", "id", "rest")


def _markets_decoded(spark, sf):
    return B.decode_markets(A.market_pages(spark, sf))[0]


@register("decode_markets")
def q_decode_markets(spark, sf):
    return rounded(_markets_decoded(spark, sf).drop("page", "pos"))


@register("decode_markets_rejects")
def q_decode_markets_rejects(spark, sf):
    rej = B.decode_markets(A.market_pages(spark, sf))[1]
    return rej.select("page", "pos", "reason")


@register("normalize_token_ids")
def q_normalize_token_ids(spark, sf):
    d = _markets_decoded(spark, sf)
    return d.select("id", F.concat_ws(",", "token_ids").alias("token_ids"), F.size("token_ids").alias("n_tokens"))


@register("normalize_outcomes")
def q_normalize_outcomes(spark, sf):
    d = _markets_decoded(spark, sf)
    return d.select("id", F.concat_ws(",", "outcomes").alias("outcomes"), F.col("outcomes").isNull().alias("outcomes_null"))


# ------------------------------------------------------------------ C

from oddsline.operators import lifecycle as C  # noqa: E402

WINDOW_START_MS, WINDOW_END_MS = 1704844800000, 1708387200000  # 2024-01-10, 2024-02-20 UTC
NOW_ISO = "2026-01-01T00:00:00+00:00"


def _markets_pos(spark, sf):
    m = A.markets(spark, sf)
    return m.withColumn("pos", F.substring("id", 2, 20).cast("bigint"))


def _store_markets(spark, sf):
    """Every market is stored; the resolved flag (null counts as 0) tells the
    known from the unknown ones."""
    m = _markets_pos(spark, sf)
    return m.withColumn("resolved", F.coalesce(F.col("resolved").cast("int"), F.lit(0)))


def _closed_feed(spark, sf):
    return _markets_pos(spark, sf).withColumn("question", F.concat("question", F.lit(" (window feed)")))


def _selected(spark, sf):
    return C.select_markets(_markets_pos(spark, sf), _closed_feed(spark, sf), _store_markets(spark, sf),
                            WINDOW_START_MS, WINDOW_END_MS)


@register("filter_created_before")
def q_filter_created_before(spark, sf):
    return rounded(C.filter_created_before(A.markets(spark, sf), WINDOW_END_MS))


@register("active_markets")
def q_active_markets(spark, sf):
    return rounded(C.active_markets(A.markets(spark, sf), WINDOW_END_MS))


@register("closed_in_window")
def q_closed_in_window(spark, sf):
    return rounded(C.closed_in_window(A.markets(spark, sf), WINDOW_START_MS, WINDOW_END_MS))


@register("exclude_known_resolved")
def q_exclude_known_resolved(spark, sf):
    win = C.closed_in_window(_closed_feed(spark, sf), WINDOW_START_MS, WINDOW_END_MS)
    return rounded(C.exclude_known_resolved(win, _store_markets(spark, sf)).drop("pos"))


@register("resolved_in_window")
def q_resolved_in_window(spark, sf):
    st = C.resolved_lookup(_store_markets(spark, sf))
    return rounded(C.resolved_in_window(st, WINDOW_START_MS, WINDOW_END_MS).drop("pos"))


@register("merge_market_sources")
def q_merge_market_sources(spark, sf):
    return rounded(_selected(spark, sf))


@register("resolved_markets_only")
def q_resolved_markets_only(spark, sf):
    return rounded(C.resolved_markets_only(_selected(spark, sf)))


def _merged_store(spark, sf):
    return C.market_snapshot_merge(A.market_store(spark, sf), A.market_incoming(spark, sf), NOW_ISO)


@register("market_snapshot_merge")
def q_market_snapshot_merge(spark, sf):
    return _merged_store(spark, sf)


@register("market_merge_counts")
def q_market_merge_counts(spark, sf):
    return C.market_merge_counts(A.market_store(spark, sf), A.market_incoming(spark, sf))


@register("resolved_lookup")
def q_resolved_lookup(spark, sf):
    return C.resolved_lookup(_merged_store(spark, sf)).select("id", "question", "version_seq")


@register("market_store_stats")
def q_market_store_stats(spark, sf):
    return C.market_store_stats(_merged_store(spark, sf))


# ------------------------------------------------------------------ D

from oddsline.operators import planning as D  # noqa: E402

LOOKBACK_AS_OF_MS = 1707955200000        # 2024-02-15 UTC
JOBS_START_MS, JOBS_END_MS = 1704067200000, 1707955200000
FIDELITY = 60
MARK_TIME = "2024-02-01T00:00:00+00:00"
ROW_BUDGET = 25_000
TRADES_SINCE_MS = 820454400000           # 1996-01-01 UTC


@register("lookback_window")
def q_lookback_window(spark, sf):
    return rounded(D.lookback_window(A.prices(spark, sf), LOOKBACK_AS_OF_MS, months=1))


@register("token_jobs")
def q_token_jobs(spark, sf):
    return D.token_jobs(A.markets(spark, sf), JOBS_START_MS, JOBS_END_MS)[0]


@register("distinct_tokens")
def q_distinct_tokens(spark, sf):
    return D.distinct_tokens(A.markets(spark, sf))


def _spread_jobs(spark, sf):
    """The jobs over all shuffle partitions: a job becomes up to hundreds of
    windows, while AQE would size tasks by the small job rows."""
    return A.jobs(spark, sf).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "token_id")


def _chunks(spark, sf):
    return D.chunk_windows(_spread_jobs(spark, sf))


def _ledger(spark, sf):
    """Completed windows: the chunks whose (customer key + chunk number) is a
    multiple of 3. Those chunk numbers form an arithmetic progression, so
    ``sequence`` generates exactly them (step 3 chunks) instead of every
    chunk followed by a filter."""
    j = _spread_jobs(spark, sf)
    step = D.CHUNK_MS + 1
    ck = F.substring("token_id", 2, 20).cast("bigint")
    n0 = F.pmod(-ck, F.lit(3))
    first = F.col("start_ts") + n0 * F.lit(step)
    starts = F.when(first <= F.col("end_ts") - 1,
                    F.sequence(first, F.col("end_ts") - 1, F.lit(3 * step).cast("bigint"))
                    ).otherwise(F.array().cast("array<bigint>"))
    led = (j.select("token_id", "end_ts", n0.alias("_n0"), F.posexplode(starts).alias("_i", "chunk_start"))
           .select("token_id", "chunk_start", (F.col("_n0") + 3 * F.col("_i")).cast("int").alias("chunk_no"),
                   F.least(F.col("chunk_start") + F.lit(D.CHUNK_MS), F.col("end_ts")).alias("chunk_end")))
    return led.select("token_id", F.col("chunk_start").alias("start_ts"), F.col("chunk_end").alias("end_ts"),
                      F.when(F.pmod("chunk_no", F.lit(7)) == 0, F.lit(1)).otherwise(F.lit(FIDELITY)).alias("fidelity"),
                      F.lit("2024-01-01T00:00:00+00:00").alias("completed_at"), F.lit(0).cast("bigint").alias("row_count"))


def _chunk_counts(spark, sf):
    """Every chunk with the number of points a fetch of it returns.

    A point's chunk number is computed arithmetically, so this is an equi
    join on (token, chunk) rather than a range join.
    """
    jobs = A.jobs(spark, sf).select("token_id", "start_ts", "end_ts")
    pts = A.order_points(spark, sf).join(jobs, "token_id").filter(F.col("t").between(F.col("start_ts"), F.col("end_ts")))
    per_chunk = pts.groupBy("token_id", F.floor((F.col("t") - F.col("start_ts")) / (D.CHUNK_MS + 1))
                            .cast("int").alias("chunk_no")).agg(F.count(F.lit(1)).alias("row_count"))
    return _chunks(spark, sf).join(per_chunk, ["token_id", "chunk_no"], "left").fillna(0, ["row_count"])


@register("chunk_windows")
def q_chunk_windows(spark, sf):
    return _chunks(spark, sf)


@register("pending_windows")
def q_pending_windows(spark, sf):
    return D.pending_windows(_chunks(spark, sf), _ledger(spark, sf), FIDELITY)


@register("window_ledger_merge")
def q_window_ledger_merge(spark, sf):
    # All fetched chunks are marked: every third one is in the ledger already,
    # some of them at another fidelity, so rows are replaced, kept and inserted.
    marks = _chunk_counts(spark, sf).select(
        "token_id", F.col("chunk_start").alias("start_ts"), F.col("chunk_end").alias("end_ts"),
        F.lit(FIDELITY).alias("fidelity"), F.lit(MARK_TIME).alias("completed_at"), F.col("row_count").cast("bigint"))
    return D.window_ledger_merge(_ledger(spark, sf), marks)


@register("ledger_completed_count")
def q_ledger_completed_count(spark, sf):
    return D.ledger_completed_count(_ledger(spark, sf))


@register("empty_run_cutoff")
def q_empty_run_cutoff(spark, sf):
    # D5 and the fetched-row counts in one co-grouped pass by token, then D7
    # on the same partitioning.
    pts = D.chunk_of_points(A.order_points(spark, sf), A.jobs(spark, sf))
    log = D.pending_with_counts(_chunks(spark, sf), _ledger(spark, sf), FIDELITY, pts)
    out = D.empty_run_cutoff(log)
    return out.select("token_id", "chunk_no", "chunk_start", "chunk_end", "row_count")


@register("id_batches")
def q_id_batches(spark, sf):
    return D.id_batches(_markets_pos(spark, sf).select("pos", "id"), ["pos"])


def _trades_decoded(spark, sf):
    """The columns that the oracles of trades have; ``decode_trades_rest`` has the other fields."""
    return B.decode_trades(A.trade_pages(spark, sf), rest=False)


@register("row_budget")
def q_row_budget(spark, sf):
    return rounded(D.budgeted_trades(A.trade_pages(spark, sf), ROW_BUDGET, rest=False))


@register("trades_since")
def q_trades_since(spark, sf):
    return rounded(D.trades_since(_trades_decoded(spark, sf), TRADES_SINCE_MS))


@register("dedupe_price_points")
def q_dedupe_price_points(spark, sf):
    pts = B.decode_price_history(A.price_payloads(spark, sf))[0]
    again = pts.select("token_id", "t", (F.col("p") * 2).alias("p"),
                       (F.col("chunk_start") + 1_000_000).alias("chunk_start"), "pos")
    return rounded(D.dedupe_price_points(D.union_parts([pts, again])))


@register("union_parts")
def q_union_parts(spark, sf):
    return rounded(D.union_parts([A.prices(spark, sf), A.order_points(spark, sf)]))


# ------------------------------------------------------------------ H

from oddsline.operators import rates as H  # noqa: E402

# Request quota per limiter of the request log (per 10 s).
LIMITER_QUOTAS = {"view": 1000, "click": 1000, "purchase": 190, "signup": 120, "error": 120}


@register("trailing_rate")
def q_trailing_rate(spark, sf):
    return rounded(H.trailing_rate(A.request_log(spark, sf)))


@register("quota_utilization")
def q_quota_utilization(spark, sf):
    return rounded(H.quota_utilization(A.request_log(spark, sf), LIMITER_QUOTAS))


# ------------------------------------------------------------------ A

from oddsline.sources import files as S  # noqa: E402

FETCH_TS = "2024-02-01 00:00:00"


@register("scan_prices")
def q_scan_prices(spark, sf):
    ev = S.scan_parquet(spark, f"{sf}/event*.parquet")
    return ev.select(F.concat(F.lit("T"), "user_id").alias("token_id"), TC.epoch_ms("ts").alias("t"),
                     round6(F.col("value")).alias("p"))


@register("with_provenance")
def q_with_provenance(spark, sf):
    df = S.with_provenance(A.prices(spark, sf), "clob", "/prices-history", FETCH_TS)
    return rounded(df.withColumn("_fetch_timestamp", F.date_format("_fetch_timestamp", "yyyy-MM-dd'T'HH:mm:ss")))


@register("stage_counts")
def q_stage_counts(spark, sf):
    lv = A.book_levels(spark, sf)
    return S.stage_counts(markets=A.markets(spark, sf), prices=A.prices(spark, sf), levels=lv,
                          spreads=E.spread_snapshot(lv), trades=A.trades(spark, sf))


@register("dataset_manifest")
def q_dataset_manifest(spark, sf):
    pj = _joined(spark, sf)
    return S.manifest_rows("prices_joined", "processed/prices_joined.parquet", NOW_ISO, pj).drop("schema_json")


# ------------------------------------------------------------------ streaming

from oddsline.streaming import ingest as ST  # noqa: E402


@register("stream_ingest_prices")
def q_stream_ingest_prices(spark, sf):
    out = ST.ingest_prices_table(spark, A.price_payloads(spark, sf))
    return rounded(out.drop("_fetch_timestamp"))


@register("stream_dedupe_prices")
def q_stream_dedupe_prices(spark, sf):
    # The points that win arrive in the last drop, after later chunks' points
    # at the same times and with other prices.
    pts = B.decode_price_history(A.price_payloads(spark, sf))[0]
    again = pts.withColumns({"p": F.col("p") * 2, "chunk_start": F.col("chunk_start") + 1_000_000})
    return rounded(ST.dedupe_prices_table(spark, [again, pts]))


@register("stream_ingest_rejects")
def q_stream_ingest_rejects(spark, sf):
    # Every payload lands twice: as it is, and wrapped in an error that has no history.
    good = A.price_payloads(spark, sf)
    bad = good.withColumn("payload", F.concat(F.lit('{"error":'), "payload", F.lit("}")))
    return ST.ingest_prices_table(spark, good.unionByName(bad), "rejects").select(
        "token_id", "chunk_start", F.substring("payload", 1, 9).alias("head"), "reason")


@register("stream_trades_daily")
def q_stream_trades_daily(spark, sf):
    return rounded(ST.trades_daily_all_table(spark, A.trades(spark, sf)))


@register("scan_runs")
def q_scan_runs(spark, sf):
    """Prices landed as three runs (by the token's last character), one of them
    as part files with four- and five-digit numbers only, read back in scan
    mode with the run name recovered from each row's file path."""
    root = ST.scratch_path(spark, "runs")
    p = A.prices(spark, sf)
    run = F.concat(F.lit("run"), (F.ascii(F.right("token_id", F.lit(1))) % 3).cast("string"))
    p.withColumn("_run", run).write.partitionBy("_run").parquet(f"{root}/staging")
    staged = spark.read.parquet(f"{root}/staging")
    for k, part in ((0, ""), (1, "_part0000"), (1, "_part10000"), (2, "_001")):
        rows = staged.where(F.col("_run") == f"run{k}").drop("_run")
        if k == 1:
            rows = rows.where((F.col("t") % 2 == 0) == (part == "_part0000"))
        rows.write.parquet(f"{root}/raw/run{k}/prices{part}.parquet")
    out = S.scan_run_table(spark, S.RunInput(mode="scan", root=root), "prices", with_run=True)
    return rounded(out.select("token_id", "t", "p", "run"))


@register("compact_parts")
def q_compact_parts(spark, sf):
    """Prices written as twelve numbered part files (the last two numbers have five
    digits), consolidated by the stage, and read back."""
    run = ST.scratch_path(spark, "parts")
    part = F.pmod(F.hash("token_id"), F.lit(12)).cast("int").alias("_part")
    A.prices(spark, sf).select("*", part).write.partitionBy("_part").parquet(f"{run}_staging")
    staged = spark.read.parquet(f"{run}_staging")
    for k in range(12):
        number = k if k < 10 else 9_990 + k
        staged.where(F.col("_part") == k).drop("_part").write.parquet(f"{run}/prices_part{number:04d}.parquet")
    done = stages.consolidate_stage(spark, run, f"{run}_processed")
    return rounded(spark.read.parquet(done["prices"]))
