"""Registered queries work on all of their input rows."""
import json

from helpers import market_row, markets_df
from oddsline.operators import planning as D
from oddsline.plans import queries as Q

STEP = D.CHUNK_MS + 1


def test_window_ledger_merge_marks_every_chunk(spark, monkeypatch):
    jobs = spark.createDataFrame([("T1", "M0", 0, 0, 8 * STEP)],
                                 "token_id string, market_id string, created_at_ts bigint, start_ts bigint, end_ts bigint")
    points = spark.createDataFrame([("T1", 3 * STEP + k, 0.5) for k in range(4)], "token_id string, t bigint, p double")
    monkeypatch.setattr(Q.A, "jobs", lambda s, d: jobs)
    monkeypatch.setattr(Q.A, "order_points", lambda s, d: points)
    rows = Q.REGISTRY["window_ledger_merge"](spark, "").collect()
    marked = {r.start_ts: r.row_count for r in rows if r.completed_at == Q.MARK_TIME}
    assert marked == {k * STEP: 4 if k == 3 else 0 for k in range(8)}
    # Chunks 2 and 5 were in the ledger at the same fidelity: overwritten, not doubled.
    assert {r.fidelity for r in rows} == {Q.FIDELITY} and len(rows) == 8


def test_stored_markets_are_all_markets(spark, monkeypatch):
    end = "2024-02-10T00:00:00Z"
    rows = [market_row(f"M{k}", created_at=c, end_date=end, resolved=r, closed=True, question="q")
            for k, (c, r) in enumerate([("2023-12-20T00:00:00Z", True), ("2024-01-15T00:00:00Z", True),
                                        ("2024-01-15T00:00:00Z", False), ("2024-01-15T00:00:00Z", None)])]
    monkeypatch.setattr(Q.A, "markets", lambda s, d: markets_df(spark, rows))
    ids = {k: {r.id for r in Q.REGISTRY[k](spark, "").collect()}
           for k in ("resolved_in_window", "exclude_known_resolved", "resolved_markets_only")}
    assert ids == {"resolved_in_window": {"M0", "M1"}, "exclude_known_resolved": {"M2", "M3"},
                   "resolved_markets_only": {"M0", "M1"}}
    source = {r.id: r.source for r in Q.REGISTRY["merge_market_sources"](spark, "").collect()}
    assert source == {"M0": "stored_resolved", "M1": "stored_resolved", "M2": "closed", "M3": "closed"}


def test_stream_trades_daily_has_every_day(spark, monkeypatch):
    day = 86_400_000
    rows = [(d * day + 5, 2.0, 0.5, "c") for d in range(19723, 19728)] + [(19723 * day, None, None, "c"), (None, 1.0, 1.0, "d")]
    t = spark.createDataFrame(rows, "timestamp long, size double, price double, conditionId string")
    monkeypatch.setattr(Q.A, "trades", lambda s, d: t)
    got = {(r.conditionId, r.day_ts): (r.trades, r.size_sum, r.notional_sum)
           for r in Q.REGISTRY["stream_trades_daily"](spark, "").collect()}
    want = {("c", d * day): (1, 2.0, 1.0) for d in range(19723, 19728)}
    assert got == want | {("c", 19723 * day): (2, 2.0, 1.0), ("d", None): (1, 1.0, 1.0)}
    monkeypatch.setattr(Q.A, "trades", lambda s, d: t.limit(0))
    assert Q.REGISTRY["stream_trades_daily"](spark, "").collect() == []


def test_stream_trades_daily_adds_up_batches(spark):
    from oddsline.streaming import ingest as ST

    day = 86_400_000
    schema = "timestamp long, size double, price double, conditionId string"
    src, out, ckpt = (ST.scratch_path(spark, f"days-{x}") for x in ("src", "out", "ckpt"))
    for days in ([19729, 19730], [19723, 19730]):  # the second run's first day is far behind the first run
        spark.createDataFrame([(d * day, 1.0, 0.5, "c") for d in days], schema).coalesce(1).write.mode("append").parquet(src)
        ST.run_to_completion(ST.trades_daily_all(spark.readStream.schema(schema).parquet(src), out, ckpt))
    got = {r.day_ts // day: (r.trades, r.size_sum) for r in ST.read_trades_daily(spark, out).collect()}
    assert got == {19723: (1, 1.0), 19729: (1, 1.0), 19730: (2, 2.0)}


def test_trades_keep_all_their_fields(spark, tmp_path):
    from oddsline.operators.decode import decode_trades
    from oddsline.plans.fetch import FetchInputs, fetch_stage

    items = [{"id": "a", "timestamp": 1, "size": 1, "price": 0.5, "conditionId": "c", "outcome": "Yes", "a.b": None,
              "maker": {"fee": 0.25, "tags": ["x", 1]}},
             {"id": "b", "timestamp": 2, "size": 1, "price": 0.5, "conditionId": "c"}]
    pages = spark.createDataFrame([(0, 0, json.dumps(items[:1])), (0, 1, json.dumps({"data": items[1:]}))],
                                  "batch long, page long, payload string")
    want = {"a": {k: items[0][k] for k in ("outcome", "a.b", "maker")}, "b": None}

    def rest(df):
        return {r.id: r.rest and json.loads(r.rest) for r in df.collect()}

    assert rest(decode_trades(pages)) == want
    empty = spark.createDataFrame([], "page long, payload string")
    res = fetch_stage(spark, FetchInputs(market_pages=empty, trade_pages=pages), f"{tmp_path}/run", start_ms=None, end_ms=None,
                      fetch_ts="2024-02-01 00:00:00", now_iso="2024-02-01T00:00:00+00:00")
    assert rest(spark.read.parquet(res.paths["trades"])) == want


def test_ledger_completed_count(spark):
    ledger = spark.createDataFrame([("a", k, k + 1, 60, "t", 0) for k in range(3)], "token_id string, start_ts bigint, "
                                   "end_ts bigint, fidelity int, completed_at string, row_count bigint")
    assert [tuple(r) for r in D.ledger_completed_count(ledger).collect()] == [(3,)]
    assert [tuple(r) for r in D.ledger_completed_count(ledger.limit(0)).collect()] == [(0,)]
