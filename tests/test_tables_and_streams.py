"""Panel blocks, book ids, racing writers, dead letters, streamed deduplication, consolidation."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from oddsline.operators import book as E
from oddsline.operators import decode as B
from oddsline.operators import planning as D
from oddsline.operators import process as P
from oddsline.plans import stages, stores
from oddsline.sources import files as S
from oddsline.streaming import ingest as ST


def test_panel_of_many_tokens_has_a_small_plan(spark):
    daily = spark.range(20_001).selectExpr("concat('t', id) token_id", "id % 3 day_ts", "id * 0.5D price_day").withColumn(
        "price_day", F.when(F.col("day_ts") < 2, F.col("price_day")))
    panel = P.build_panel(daily)
    assert panel.columns.groupBy("block").count().orderBy("block").collect() == [(0, 5000), (1, 5000), (2, 5000), (3, 5000), (4, 1)]
    few = P.build_panel(daily.limit(10))
    plans = [p.rows._jdf.queryExecution().optimizedPlan().toString() for p in (panel, few)]
    assert abs(len(plans[0]) - len(plans[1])) < 200  # no name and no token is in it
    got = {(r.token_id, r.day_ts): r.price for r in panel.cells().collect()}
    assert got == {(r.token_id, r.day_ts): r.price_day for r in daily.where("price_day is not null").collect()}
    last = panel.wide(4)
    assert last.columns == ["day_ts", sorted(f"t{k}" for k in range(20_001))[-1]]


def test_empty_panel(spark):
    panel = P.build_panel(spark.createDataFrame([], "token_id string, day_ts long, price_day double"))
    assert panel.columns.count() == 0 and panel.rows.count() == 0 and panel.cells().collect() == []


def book(price, ts='"soon"'):
    return json.dumps({"bids": [{"price": price, "size": 1}], "asks": [{"price": 0.9, "size": 2}]})[:-1] + f', "timestamp": {ts}}}'


def test_book_ids_do_not_depend_on_partitions(spark):
    rows = [("T", book(0.1))] * 200 + [("T", book(0.2)), ("U", book(0.1)), ("U", None), (None, book(0.1)), ("T", "broken")]
    landing = spark.createDataFrame(rows, "token_id string, payload string")
    ids = [sorted((r.token_id or "", r.book_id) for r in B.decode_orderbook(landing.repartition(n))[0].collect()) for n in (1, 3, 17)]
    assert ids[0] == ids[1] == ids[2] and len(set(ids[0])) == len(ids[0]) == 203
    assert B.decode_orderbook(landing)[1].count() == 2
    # Many books of one token share timestamp 0; each keeps its own depth.
    depth = E.depth_at_distance(E.flatten_books(B.decode_orderbook(landing)[0]), 1.0)
    assert depth.count() == 203 and {r.depth_both for r in depth.collect()} == {3.0}


def test_racing_writers_both_merge(spark, tmp_dir):
    ledger = stores.ledger_table(spark, f"{tmp_dir}/ledger")
    meet, failed = threading.Barrier(4), []

    def mark(k):
        def merge(now):
            if not tries[k]:
                meet.wait(60)  # all four have read the same version by now
            tries[k] += 1
            marks = spark.createDataFrame([(f"t{k}", 0, 10, 60, "t", 1)], ledger.schema)
            return D.window_ledger_merge(now, marks)

        try:
            ledger.update(merge)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    tries = [0] * 4
    threads = [threading.Thread(target=mark, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and sum(tries) > 4  # some lost a race and merged again
    assert {r.token_id for r in ledger.current().collect()} == {"t0", "t1", "t2", "t3"} and ledger.versions() == [1, 2, 3, 4]
    assert len(S.list_dir(spark, f"{tmp_dir}/ledger/data")) == 4


def test_commit_file_has_one_winner(spark, tmp_dir):
    won = []
    threads = [threading.Thread(target=lambda k=k: won.append((k, S.commit_file(spark, f"{tmp_dir}/c/v1", str(k))))) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winner = [k for k, ok in won if ok]
    assert len(winner) == 1 and S.read_text(spark, f"{tmp_dir}/c/v1") == str(winner[0])
    assert [p.rsplit("/", 1)[1] for p in S.list_dir(spark, f"{tmp_dir}/c")] == ["v1"]


def test_claimed_paths(spark, tmp_dir):
    one = spark.range(1)
    paths = [S.write_versioned(one, f"{tmp_dir}/x.parquet").rsplit("/", 1)[1] for _ in range(3)]
    assert paths == ["x.parquet", "x_001.parquet", "x_002.parquet"]
    assert S.claim_path(spark, f"{tmp_dir}/x_001.parquet").endswith("/x_003.parquet")  # claimed, nothing written yet
    assert S.claim_path(spark, f"{tmp_dir}/x.parquet").endswith("/x_004.parquet")


def test_stream_keeps_refused_payloads(spark, tmp_dir):
    schema = "token_id string, chunk_start long, payload string"
    good, bad = '{"history":[{"t":1577836800,"p":0.5}]}', '{"error":1}'
    out, ckpt, land = f"{tmp_dir}/out", f"{tmp_dir}/ckpt", f"{tmp_dir}/land"
    spark.createDataFrame([("a", 0, good), ("a", 1, bad)], schema).write.parquet(f"{land}/d0")
    ST.run_to_completion(ST.ingest_prices(spark, f"{land}/*", out, ckpt))
    spark.createDataFrame([("b", 0, good), ("b", 1, None)], schema).write.parquet(f"{land}/d1")
    ST.run_to_completion(ST.ingest_prices(spark, f"{land}/*", out, ckpt))
    rejects = {(r.token_id, r.chunk_start, r.reason) for r in ST.read_ingested(spark, out, "rejects").collect()}
    assert rejects == {("a", 1, "missing history"), ("b", 1, "missing history")}
    # The last batch's commit is lost: it runs again and writes the same folders.
    for name in ("1", ".1.crc"):
        os.replace(f"{ckpt}/commits/{name}", f"{tmp_dir}/lost{name}")
    ST.run_to_completion(ST.ingest_prices(spark, f"{land}/*", out, ckpt))
    assert ST.read_ingested(spark, out).count() == 2 and ST.read_ingested(spark, out, "rejects").count() == 2


def test_streamed_dedupe_equals_the_batch_rule(spark):
    schema = "token_id string, t long, p double, chunk_start long, pos int"
    drops = [[("a", 10, 3.0, 30, 0), ("a", 99_000_000_000, 1.0, 30, 1)], [("a", 10, 2.0, 20, 5), ("b", 10, 9.0, 1, 0)],
             [("a", 10, 1.0, 20, 4), ("b", 10, 8.0, 1, 1), (None, 10, 5.0, 1, 0)]]
    frames = [spark.createDataFrame(d, schema) for d in drops]
    got = sorted(map(str, ST.dedupe_prices_table(spark, frames).collect()))
    whole = D.dedupe_price_points(D.union_parts(frames))
    assert got == sorted(map(str, whole.collect())) and whole.count() == 4
    assert whole.where("token_id = 'a' and t = 10").first().p == 1.0


def test_consolidation_through_the_command_line(spark, tmp_dir):
    from oddsline.__main__ import main

    run = f"{tmp_dir}/raw/r1"
    p = spark.createDataFrame([(f"T{k}", k, 0.5) for k in range(6)], "token_id string, t bigint, p double")
    for k, n in enumerate((2, 9999, 10000)):
        p.where(f"t % 3 = {k}").write.parquet(f"{run}/prices_part{n:04d}.parquet")
    spark.range(3).write.parquet(f"{run}/markets.parquet")
    assert main(["consolidate", "--run-dir", run]) == 0
    tables = stages.read_consolidated(spark, f"{run}_processed")
    assert set(tables) == {"prices", "markets"} and spark.read.parquet(tables["prices"]).count() == 6
    assert len(S.part_paths(spark, run, "prices")) == 3  # the parts stay
    # Nothing to compact: nothing is promoted either.
    spark.range(3).write.parquet(f"{tmp_dir}/raw/r2/markets.parquet")
    assert main(["consolidate", "--run-dir", f"{tmp_dir}/raw/r2"]) == 0
    assert stages.read_consolidated(spark, f"{tmp_dir}/raw/r2_processed") == {}
    # Processing a directory sorts its files by their columns.
    assert main(["process", "--directory", f"{run}_processed", "--out", f"{tmp_dir}/p", "--manifest", f"{tmp_dir}/m",
                 "--steps", "returns"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/p/daily_returns.parquet").count() == 6


def test_at_most_one_look_back_unit():
    from oddsline.__main__ import parser

    args = ["fetch", "--landing", "l", "--run-dir", "r"]
    assert parser().parse_args([*args, "--weeks", "2"]).weeks == 2
    for bad in (["--weeks", "2", "--days", "1"], ["--days", "0"]):
        with pytest.raises(SystemExit):
            parser().parse_args([*args, *bad])


def test_budget_of_pages_equals_budget_of_rows(spark):
    page = lambda k, n: json.dumps([{"id": f"{k}-{i}", "timestamp": i} for i in range(n)] + ["junk"])
    rows = [(0, 1, page(1, 3)), (0, 0, page(0, 4)), (1, 0, json.dumps({"data": json.loads(page(2, 5))})), (1, 1, "broken"), (1, 2, None), (2, 0, page(3, 2))]
    landing = spark.createDataFrame(rows, "batch long, page long, payload string")
    for budget in (None, 0, 1, 4, 5, 7, 12, 13, 14, 99):
        want = D.row_budget(B.decode_trades(landing), budget)
        got = D.budgeted_trades(landing, budget)
        assert got.columns == want.columns and sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect()), budget


def test_ledger_merge_sorts_after_the_exchange_only(spark):
    cols = "token_id string, start_ts long, end_ts long, fidelity int, completed_at string, row_count long"
    ledger = spark.createDataFrame([("a", 1, 2, 60, "x", 1), (None, 1, 2, 60, "x", 3)], cols)
    marks = spark.createDataFrame([("a", 1, 2, 60, "y", 7, 1), ("a", 1, 2, 60, "z", 8, 2), (None, 1, 2, 60, "y", 9, 1)],
                                  cols + ", write_seq long")
    out = D.window_ledger_merge(ledger, marks)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("partial_max_by") < plan.index("Exchange" if "Exchange" in plan else "RepartitionByExpression")
    got = {(r.token_id, r.completed_at, r.row_count) for r in out.collect()}
    assert got == {("a", "z", 8), (None, "y", 9)}


def test_budget_bounds_the_landing_table_by_a_filter(spark, tmp_dir):
    rows = [(i, f'{{"id":"{i}","timestamp":{i}}}') for i in range(400)]
    spark.createDataFrame(rows, "k long, item string").write.parquet(f"{tmp_dir}/k")
    items = spark.read.parquet(f"{tmp_dir}/k").groupBy(F.floor(F.col("k") / 10).alias("page")).agg(F.collect_list("item").alias("i"))
    landing = items.select(F.floor(F.col("page") / 4).alias("batch"), "page",
                           F.concat(F.lit("["), F.concat_ws(",", "i"), F.lit("]")).alias("payload"))
    out = D.budgeted_trades(landing, 95)
    scanned = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x and "k#" in x and "<= 9" in x]
    assert scanned  # pages past the budget are not built again
    assert out.count() == 95
    assert out.filter("page < 9").count() == 90
