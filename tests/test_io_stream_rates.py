import os
import random

import pytest
from pyspark.sql import functions as F

from oddsline.operators import rates as H
from oddsline.sources import files as S


def test_trailing_rate_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = [(i, rnd.choice(["a", "b"]), rnd.randrange(0, 60_000)) for i in range(400)]
    rows += [(1000, "a", 5000), (1001, "a", 5000)]  # same millisecond
    df = spark.createDataFrame(rows, "request_id long, limiter string, t long")
    got = {r.request_id: (r.window_count, r.rps) for r in H.trailing_rate(df, 10).collect()}
    for rid, lim, t in rows:
        n = sum(1 for _, l2, t2 in rows if l2 == lim and t - 10_000 <= t2 <= t)
        assert got[rid] == (n, pytest.approx(n / 10))


def test_trailing_rate_of_null_limiters_and_times(spark):
    rows = [(1, None, 0), (2, None, 9_999), (3, None, 10_001), (4, "a", None), (5, "a", None), (6, "a", 3), (7, None, None), (8, "a", 10_003)]
    df = spark.createDataFrame(rows, "request_id long, limiter string, t long")
    got = {r.request_id: r.window_count for r in H.trailing_rate(df, 10).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 2, 5: 2, 6: 1, 7: 1, 8: 2}
    assert H.trailing_rate(df.where("false"), 10).count() == 0


def test_quota_utilization(spark):
    df = spark.createDataFrame([(1, "markets", 0), (2, "markets", 5000)], "request_id long, limiter string, t long")
    r = {x.request_id: x.utilization_pct for x in H.quota_utilization(df, H.QUOTAS).collect()}
    assert r[2] == pytest.approx(2 / 120 * 100)


def test_trailing_rate_of_dense_and_negative_times(spark):
    rnd = random.Random(12)
    rows = [(i, rnd.choice(["a", None]), rnd.randrange(-40, 41)) for i in range(300)]  # edges of 10 ms windows
    df = spark.createDataFrame(rows, "request_id long, limiter string, t long")
    out = H.trailing_rate(df, 0.01)
    assert "rangeframe" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    got = {r.request_id: r.window_count for r in out.collect()}
    assert got == {i: sum(m == lim and t - 10 <= u <= t for _, m, u in rows) for i, lim, t in rows}


def test_quota_counts_dense_windows_without_a_sliding_frame(spark):
    # A frame that slides is added up whole again at every row: quadratic in a window's rows.
    df = spark.range(30_000).selectExpr("id request_id", "'markets' limiter", "id * 2 t")
    out = H.quota_utilization(df, H.QUOTAS)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "rangeframe" not in plan.lower() and "unboundedpreceding" in plan.lower()
    got = {r.request_id: r.window_count for r in out.collect()}
    assert got == {i: min(i, 5000) + 1 for i in range(30_000)}


def test_versioned_paths_and_manifest(spark, tmp_dir):
    df = spark.createDataFrame([(1, 4.0), (2, 5.0), (3, 6.0)], "x long, y double")
    base = f"{tmp_dir}/out/data.parquet"
    p1 = S.write_versioned(df, base)
    p2 = S.write_versioned(df, base)
    p3 = S.write_versioned(df, p2)
    assert (p1, p2, p3) == (base, f"{tmp_dir}/out/data_001.parquet", f"{tmp_dir}/out/data_002.parquet")
    assert sorted(tuple(r) for r in spark.read.parquet(p1).collect()) == [(1, 4.0), (2, 5.0), (3, 6.0)]
    target, rows = S.write_with_manifest(df, "d", base, f"{tmp_dir}/manifest")
    assert rows == 3 and target.endswith("_003.parquet")
    man = S.read_manifest(spark, f"{tmp_dir}/manifest").collect()
    assert len(man) == 1 and man[0].rows == 3 and man[0].cols == 2


def test_scan_glob_and_missing(spark, tmp_dir):
    df = spark.createDataFrame([(1, 4.0), (2, 5.0)], "x long, y double")
    df.write.parquet(f"{tmp_dir}/a_1.parquet")
    df.write.parquet(f"{tmp_dir}/a_2.parquet")
    assert S.scan_parquet(spark, f"{tmp_dir}/a_*.parquet").count() == 4
    assert S.scan_parquet(spark, f"{tmp_dir}/nothing_*.parquet") is None


def test_run_dirs_parts_and_compaction(spark, tmp_dir):
    run = f"{tmp_dir}/raw/run1"
    pr = spark.createDataFrame([("T1", 1, 0.5)], "token_id string, t long, p double")
    for i in range(3):
        pr.write.parquet(f"{run}/prices_part{i:04d}.parquet")
    cfg = S.RunInput(mode="run_dir", run_dir=run)
    assert len(S.run_table_paths(spark, cfg, "prices")) == 3
    assert S.scan_run_table(spark, cfg, "prices").count() == 3
    out = S.compact_parts(spark, run, "prices", f"{tmp_dir}/processed/run1_processed")
    assert spark.read.parquet(out).count() == 3 and len(S.run_table_paths(spark, cfg, "prices")) == 3
    pr.write.parquet(f"{tmp_dir}/raw/run2/prices.parquet")
    scan = S.scan_run_table(spark, S.RunInput(mode="scan", root=tmp_dir), "prices", with_run=True)
    assert {r.run for r in scan.collect()} == {"run1", "run2"}  # a run of part files counts


def test_discover_and_validate(spark, tmp_dir):
    spark.createDataFrame([("m", ["a"])], "id string, token_ids array<string>").write.parquet(f"{tmp_dir}/m1.parquet")
    spark.createDataFrame([("m", ["a"])], "id string, token_ids array<string>").write.parquet(f"{tmp_dir}/m2.parquet")
    spark.createDataFrame([("a", 1, 0.5)], "token_id string, t long, p double").write.parquet(f"{tmp_dir}/p.parquet")
    spark.createDataFrame([(1,)], "z int").write.parquet(f"{tmp_dir}/z.parquet")
    found = S.discover_files(spark, tmp_dir)
    assert [os.path.basename(p) for p in found["markets"]] == ["m1.parquet"]
    assert len(found["prices"]) == 1 and len(found["unknown"]) == 2
    with pytest.raises(ValueError):
        S.validate_columns(spark.createDataFrame([(1,)], "id int"), "markets")


def test_footers_of_many_files_are_read_in_one_job(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq

    kinds = [["token_id", "t", "p"], ["token_id", "timestamp", "price"], ["id", "token_ids"], ["z"]]
    for i in range(300):
        pq.write_table(pa.table({c: pa.array([], pa.string()) for c in kinds[i % 4]}), f"{tmp_dir}/f{i:03d}.parquet")
    with open(f"{tmp_dir}/g_damaged.parquet", "w") as f:
        f.write("no footer")
    spark.createDataFrame([("a", 0.5, 1)], "token_id string, p double, t long").write.partitionBy("t").parquet(f"{tmp_dir}/h_days.parquet")
    os.mkdir(f"{tmp_dir}/i_empty.parquet")
    sc = spark.sparkContext
    sc.setJobGroup("footers", "footers")
    rows = S.classify_files(spark, tmp_dir).collect()
    jobs = sc.statusTracker().getJobIdsForGroup("footers")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(rows) == 303 and len(jobs) <= 2  # one per shuffle stage and the result, whatever the number of files
    want = ["prices", "prices", "markets", "unknown"]
    for r in rows:
        if r.pos < 300:
            assert (r.kind, r.error) == (want[r.pos % 4], None)
    assert {r.pos: r.kind for r in rows if r.pos >= 300} == {300: None, 301: "prices", 302: None}
    found = S.discover_files(spark, tmp_dir)
    assert (len(found["prices"]), len(found["markets"]), len(found["trades"])) == (151, 1, 0)
    assert sum(map(len, found.values())) == 303
    none = f"{tmp_dir}/none"
    os.mkdir(none)
    assert S.discover_files(spark, none) == {"markets": [], "prices": [], "trades": [], "unknown": []}


def test_process_stage_refuses_tables_without_their_columns(spark, tmp_dir):
    from oddsline.plans.stages import process_stage

    prices = spark.createDataFrame([("a", 1, 0.5)], "token_id string, t long, p double")
    with pytest.raises(ValueError, match="markets data missing"):
        process_stage(spark, f"{tmp_dir}/out", f"{tmp_dir}/manifest", prices, spark.createDataFrame([(1,)], "id int"))
    with pytest.raises(ValueError, match="trades data missing"):
        process_stage(spark, f"{tmp_dir}/out", f"{tmp_dir}/manifest", None, None, spark.createDataFrame([(1,)], "id int"))
    assert not os.path.exists(f"{tmp_dir}/out")


def test_provenance_and_stage_counts(spark):
    df = S.with_provenance(spark.createDataFrame([(1,)], "x int"), "clob", "/book", "2024-02-01 00:00:00")
    assert {"_source_api", "_fetch_timestamp", "_api_endpoint"} <= set(df.columns)
    m = spark.createDataFrame([("m1", ["a", "b"]), ("m2", ["b", None])], "id string, token_ids array<string>")
    c = S.stage_counts(markets=m, trades=spark.range(4)).first()
    assert (c.markets, c.tokens, c.trades, c.levels) == (2, 2, 4, 0)


def derby_available(spark) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.derby.jdbc.EmbeddedDriver")
        return True
    except Exception:  # noqa: BLE001
        return False


def test_jdbc_roundtrip_scan_and_hybrid(spark, tmp_dir):
    if not derby_available(spark):
        pytest.skip("no embedded Derby driver on the classpath")
    from oddsline.sources.jdbc import HybridStore, JdbcStore, ParquetStore, table_name

    url = f"jdbc:derby:memory:odds{random.randrange(1 << 30)};create=true"
    db = JdbcStore(spark, url, {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    df = spark.createDataFrame([("T1", 1, 0.5, True, ["a", "b"])], "token_id string, t long, p double, flag boolean, tags array<string>")
    db.write(df, "data/raw/r1/prices.parquet")
    db.write(df, "data/raw/r2/prices.parquet")
    db.write(df, "data/raw/r2/trades.parquet")
    assert table_name("data/raw/r1/prices.parquet") == "data_raw_r1_prices"
    back = db.read("data/raw/r1/prices.parquet", schema=df.schema).first()
    assert back.tags == ["a", "b"] and back.flag is True
    assert db.scan("data/raw/*/prices.parquet").count() == 2
    hy = HybridStore(db, ParquetStore(spark, tmp_dir))
    hy.write(df, "x/y.parquet")
    assert hy.read("x/y.parquet").count() == 1


def test_stream_ingest_equals_batch(spark):
    from oddsline.operators.decode import decode_price_history
    from oddsline.streaming import ingest as ST

    land = spark.createDataFrame([("a", 0, '{"history":[{"t":1577836800,"p":0.5},{"t":"x","p":1}]}'),
                                  ("b", 1, '{"history":[{"t":1577836800001,"p":"0.25"}]}')],
                                 "token_id string, chunk_start bigint, payload string")
    out = ST.ingest_prices_table(spark, land).drop("_fetch_timestamp", "_source_api", "_api_endpoint")
    batch = decode_price_history(land)[0]
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_stream_trades_daily_closed_days(spark):
    from oddsline.streaming import ingest as ST

    day = 86_400_000
    rows = [(d * day + 5, 1.0, 0.5, "c") for d in range(19723, 19728)]
    t = spark.createDataFrame(rows, "timestamp long, size double, price double, conditionId string")
    got = sorted(r.day_ts for r in ST.trades_daily_table(spark, t).collect())
    assert got == [d * day for d in range(19723, 19726)]  # the last day(s) stay open under the watermark
    assert F is not None


def test_late_trades_are_dropped_and_counted(spark):
    from oddsline.streaming import ingest as ST

    day = 86_400_000
    schema = "timestamp long, size double, price double, conditionId string"
    src = ST.scratch_path(spark, "late-src")
    spark.createDataFrame([(d * day + 5, 1.0, 0.5, "c") for d in range(19723, 19730)], schema) \
        .coalesce(1).write.parquet(f"{src}/a")  # one file: one in-order batch
    out, ckpt = ST.scratch_path(spark, "late-out"), ST.scratch_path(spark, "late-ckpt")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    q = ST._start(ST.trades_daily(stream), out, ckpt, None)
    ST.run_to_completion(q)
    spark.createDataFrame([(19723 * day + 9, 2.0, 0.5, c) for c in ("c", "d", "e")], schema) \
        .coalesce(1).write.parquet(f"{src}/b")  # days behind the watermark
    q2 = ST._start(ST.trades_daily(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")),
                   out, ckpt, None)
    ST.run_to_completion(q2)
    assert ST.late_rows(q2) == 3
    first_day = [r for r in spark.read.parquet(out).collect() if r.day_ts == 19723 * day]
    assert len(first_day) == 1 and first_day[0].trades == 1  # the late rows changed nothing
