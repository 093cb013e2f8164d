"""End to end: landed payloads -> fetch stage -> run directory -> process stage."""

import json

from pyspark.sql import functions as F

from oddsline.plans import fetch as FX
from oddsline.plans import stages
from oddsline.plans.stores import ledger_table, market_store_table, merge_ledger
from oddsline.sources import files as S

DAY = 86_400_000
T0 = 1704067200000          # 2024-01-01
START, END = T0, 1706659200000  # 2024-01-01 .. 2024-01-31


def market(mid, cond, tokens, closed, resolved, end_date, question="q"):
    return {"id": mid, "question": question, "conditionId": cond, "clobTokenIds": json.dumps(tokens),
            "outcomes": json.dumps(["YES", "NO"]), "active": not closed, "closed": closed, "resolved": resolved,
            "createdAt": "2024-01-01T00:00:00Z", "endDate": end_date, "category": "x"}


def landing(spark, m2_question="q"):
    m1 = market("m1", "c1", ["YES1", "NO1"], False, False, "2024-03-01T00:00:00Z")
    m2 = market("m2", "c2", ["YES2", "NO2"], True, True, "2024-01-15T00:00:00Z", m2_question)
    pages = spark.createDataFrame([(0, json.dumps([m1]))], "page long, payload string")
    window = spark.createDataFrame([(0, json.dumps([m2]))], "page long, payload string")
    hist = json.dumps({"history": [{"t": T0, "p": 0.4}, {"t": T0 + DAY, "p": 0.6}]})
    prices = spark.createDataFrame([(tok, T0, hist) for tok in ("YES1", "NO1", "YES2", "NO2")],
                                   "token_id string, chunk_start bigint, payload string")
    book = json.dumps({"bids": [{"price": "0.4", "size": "10"}], "asks": [{"price": "0.6", "size": "5"}],
                       "timestamp": str(T0)})
    books = spark.createDataFrame([(tok, book) for tok in ("YES1", "NO1", "YES2", "NO2")], "token_id string, payload string")
    trades = spark.createDataFrame([(0, 0, json.dumps([
        {"id": "a", "timestamp": T0, "size": 1.0, "price": 0.4, "conditionId": "c1"},
        {"id": "b", "timestamp": T0 + DAY, "size": 2.0, "price": 0.6, "conditionId": "c1"}]))],
        "batch long, page long, payload string")
    return FX.FetchInputs(pages, window, prices, books, trades)


def test_fetch_then_process(spark, tmp_dir):
    store = market_store_table(spark, f"{tmp_dir}/store", FX.FULL_MARKET_STORE)
    ledger = ledger_table(spark, f"{tmp_dir}/ledger")
    run = f"{tmp_dir}/data/raw/run1"
    res = FX.fetch_stage(spark, landing(spark), run, start_ms=START, end_ms=END, fetch_ts="2024-02-01 00:00:00",
                         now_iso="T1", store=store, ledger=ledger)
    assert res.counts == {"markets": 2, "tokens": 4, "price_points": 8, "levels": 8, "spreads": 4, "trades": 2}
    assert {r.id: r.resolved for r in store.current().collect()} == {"m1": 0, "m2": 1}
    # Only the chunk that arrived is recorded for each token, not the two later
    # 14-day chunks of m1's range.
    assert ledger.current().count() == 4 and res.rejects == 0

    cfg = S.RunInput(mode="run_dir", run_dir=run)
    out = stages.process_stage(spark, f"{tmp_dir}/data/processed", f"{tmp_dir}/manifest",
                               S.scan_run_table(spark, cfg, "prices"), S.scan_run_table(spark, cfg, "markets"),
                               S.scan_run_table(spark, cfg, "trades"))
    assert out.counts["prices_joined"] == 8 and out.counts["daily_returns"] == 8
    assert out.counts["price_panel"] == 2 and out.counts["panel_tokens"] == 4
    assert out.counts["trades_daily_agg"] == 2
    joined = spark.read.parquet(out.paths["prices_joined"])
    assert {"token_id", "t", "p", "market_id", "outcome_name"} <= set(joined.columns)

    # A second run: the resolved market's new text is ignored by the store
    # (immutable) and it still comes back through the stored-resolved feed.
    res2 = FX.fetch_stage(spark, landing(spark, m2_question="changed"), f"{tmp_dir}/data/raw/run2", start_ms=START,
                          end_ms=END, fetch_ts="2024-02-02 00:00:00", now_iso="T2", store=store, ledger=ledger)
    cur = {r.id: (r.question, r.updated_at) for r in store.current().collect()}
    assert cur["m2"] == ("q", "T1") and cur["m1"] == ("q", "T2")
    assert res2.counts["markets"] == 2
    m2 = spark.read.parquet(res2.paths["markets"]).filter("id = 'm2'").first()
    assert m2.question == "q"
    assert res2.counts["price_points"] == 0  # every chunk is in the ledger now


def test_command_line_stages(spark, tmp_dir):
    from oddsline.__main__ import main

    inputs = landing(spark)
    for name in ("market_pages", "window_pages", "price_payloads", "book_payloads", "trade_pages"):
        getattr(inputs, name).write.parquet(f"{tmp_dir}/landing/{name}")
    run = f"{tmp_dir}/raw/r1"
    assert main(["fetch", "--landing", f"{tmp_dir}/landing", "--run-dir", run, "--start", "2024-01-01",
                 "--end", "2024-01-31"]) == 0
    assert main(["process", "--run-dir", run, "--out", f"{tmp_dir}/processed", "--manifest", f"{tmp_dir}/man"]) == 0
    joined = f"{tmp_dir}/processed/prices_joined.parquet"
    assert spark.read.parquet(joined).count() == 8
    assert main(["filter", "--input", joined, "--output", f"{tmp_dir}/filtered", "--start-date", "2024-01-02",
                 "--compute-jumps"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/filtered").count() == 4


def test_rejected_payloads_stay_pending(spark, tmp_dir):
    ledger = ledger_table(spark, f"{tmp_dir}/ledger")
    good = landing(spark)
    bad = FX.FetchInputs(good.market_pages, good.window_pages,
                         good.price_payloads.withColumn("payload", F.lit('{"error":"rate limited"}')))
    args = dict(start_ms=START, end_ms=END, fetch_ts="2024-02-01 00:00:00", now_iso="T1", ledger=ledger)
    one = FX.fetch_stage(spark, bad, f"{tmp_dir}/raw/r1", **args)
    assert one.counts["price_points"] == 0 and one.rejects == 4 and ledger.current().count() == 0
    assert {r.feed for r in spark.read.parquet(one.paths["rejects"]).collect()} == {"price_payloads"}
    two = FX.fetch_stage(spark, good, f"{tmp_dir}/raw/r2", **args)
    assert two.counts["price_points"] == 8 and ledger.current().count() == 4


def test_second_run_merges(spark, tmp_dir):
    ledger = ledger_table(spark, f"{tmp_dir}/ledger")
    marks = spark.createDataFrame([("a", 0, 10, 60, "t", 1)], ledger.schema)
    for token in ("a", "b"):
        merge_ledger(ledger, marks.withColumn("token_id", F.lit(token)))
    assert {r.token_id for r in ledger.current().collect()} == {"a", "b"} and ledger.versions() == [1, 2]


def test_trades_are_not_capped_by_default(spark):
    from oddsline.operators import planning as D

    rows = spark.range(200_001).selectExpr("0L batch", "id div 1000 page", "id % 1000 pos")
    assert D.row_budget(rows).count() == 200_001 and D.row_budget(rows, 1500).count() == 1500


def test_early_stop_is_per_job(spark):
    """Two jobs of one token: each walks its own chunks."""
    from oddsline.operators import planning as D

    rows = [("m1", "t", k * 10, k * 10 + 9, 0 if k < 5 else 1, None) for k in range(6)]
    rows += [("m2", "t", 100 + k * 10, 109 + k * 10, int(k == 1), None) for k in range(6)]
    df = spark.createDataFrame(rows, "market_id string, token_id string, chunk_start long, chunk_end long, row_count long, created_at_ts long")
    assert D.empty_run_cutoff(df).groupBy("market_id").count().orderBy("market_id").collect() == [("m1", 5), ("m2", 6)]


def test_process_steps(spark, tmp_dir):
    hist = spark.createDataFrame([("YES1", T0, 0.4), ("YES1", T0 + DAY, 0.6)], "token_id string, t bigint, p double")
    out = stages.process_stage(spark, f"{tmp_dir}/p", f"{tmp_dir}/m", hist, None, None, steps=("returns",))
    assert set(out.paths) == {"daily_returns"}
