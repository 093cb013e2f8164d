from pyspark.sql import functions as F

from helpers import two_markets
from oddsline.operators import filters as G
from oddsline.plans import stages
from oddsline.sources import files as S

DAY = 86_400_000
T0 = 1704067200000


def prices(spark):
    rows = [(tok, ts, p) for tok in ("YES1", "NO1", "YES2", "NO2") for ts, p in ((T0, 0.4), (T0 + DAY, 0.6))]
    return spark.createDataFrame(rows, "token_id string, t bigint, p double")


def test_process_stage_writes_four_outputs(spark, tmp_dir):
    trades = spark.createDataFrame([(T0, 1.0, 0.4, "c1"), (T0 + DAY, 2.0, 0.6, "c1")],
                                   "timestamp bigint, size double, price double, conditionId string")
    res = stages.process_stage(spark, f"{tmp_dir}/processed", f"{tmp_dir}/manifest", prices(spark),
                               two_markets(spark), trades)
    assert set(res.paths) == {"prices_joined", "daily_returns", "price_panel", "trades_daily_agg"}
    assert res.counts["prices_joined"] == 8 and res.counts["daily_returns"] == 8
    assert res.counts["price_panel"] == 2 and res.counts["panel_tokens"] == 4 and res.counts["trades_daily_agg"] == 2
    man = S.read_manifest(spark, f"{tmp_dir}/manifest").collect()
    assert {r.dataset for r in man} == set(res.paths)
    again = stages.process_stage(spark, f"{tmp_dir}/processed", f"{tmp_dir}/manifest", prices(spark),
                                 two_markets(spark), trades)
    assert again.paths["daily_returns"].endswith("daily_returns_001.parquet")  # never overwrites


def test_process_stage_empty_rules(spark, tmp_dir):
    empty = prices(spark).limit(0)
    trades = spark.createDataFrame([], "timestamp bigint, size double, price double, conditionId string")
    res = stages.process_stage(spark, f"{tmp_dir}/p", f"{tmp_dir}/m", empty, two_markets(spark), trades)
    assert "prices_joined" not in res.paths and "price_panel" not in res.paths       # not written when empty
    assert res.counts["daily_returns"] == 0 and res.counts["trades_daily_agg"] == 0  # written even when empty
    none = stages.process_stage(spark, f"{tmp_dir}/q", f"{tmp_dir}/m", None, None, None)
    assert none.paths == {}


def test_filter_stage_report(spark, tmp_dir):
    df = prices(spark)
    rep = stages.filter_stage(df, G.FilterConfig(start_date="2024-01-02", compute_jumps=True), f"{tmp_dir}/f")
    assert rep["input_count"] == 8 and rep["output_count"] == 4 and rep["rows_removed"] == 4
    assert "jump_pct" in spark.read.parquet(f"{tmp_dir}/f").columns


def test_filters_reach_the_parquet_scan(spark, tmp_dir):
    prices(spark).withColumn("category", F.lit("x")).write.parquet(f"{tmp_dir}/prices")
    df = spark.read.parquet(f"{tmp_dir}/prices")
    out, _ = G.apply_filters(df, G.FilterConfig(start_date="2024-01-02", categories=["x"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ", 1)[1].split("]", 1)[0]
    assert "GreaterThanOrEqual(t,1704153600000)" in pushed
    assert "EqualTo(category,x)" in pushed or "In(category" in pushed
    assert out.count() == 4


def test_promote_run_tables_isolated(spark, tmp_dir):
    run = f"{tmp_dir}/raw/r1"
    prices(spark).write.parquet(f"{run}/markets.parquet")
    with open(f"{tmp_dir}/raw/r1/trades.parquet", "w") as fh:
        fh.write("not parquet")
    done = S.promote_run_tables(spark, run, f"{tmp_dir}/processed/r1", ["markets", "trades", "absent"])
    assert done["markets"] and done["trades"] is None and "absent" not in done
    assert spark.read.parquet(done["markets"]).count() == 8


def test_backfill_plan(spark):
    from helpers import market_row, markets_df

    m = markets_df(spark, [market_row("a", ["t1"], created_at="2024-01-01T00:00:00Z", end_date="2024-03-01T00:00:00Z")])
    ledger = spark.createDataFrame([("t1", 1704067200000, 1704067200000 + 14 * DAY, 60, "x", 1)],
                                   "token_id string, start_ts bigint, end_ts bigint, fidelity int, "
                                   "completed_at string, row_count bigint")
    pending, rej = stages.backfill_plan(m, ledger, 1704067200000, 1706745600000, 60)
    assert rej.count() == 0
    assert [r.chunk_no for r in pending.orderBy("chunk_no").collect()] == [1, 2]


def test_scale_conf_sizes_partitions(spark):
    from oddsline.session import scale_conf

    probe = scale_conf(spark, 1)
    try:
        conf = scale_conf(spark, 100 * 10**12)  # 100 TB
        assert int(conf["spark.sql.shuffle.partitions"]) == 200_000
        assert scale_conf(spark, 10 * 10**9)["spark.sql.shuffle.partitions"] == "200"
    finally:
        for k in probe:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_day_partitions_are_pruned(spark, tmp_dir):
    res = stages.process_stage(spark, f"{tmp_dir}/p", f"{tmp_dir}/m", prices(spark), two_markets(spark),
                               None, partition_by_day=True)
    df = spark.read.parquet(res.paths["prices_joined"])
    out, labels = G.apply_filters(df, G.FilterConfig(start_date="2024-01-02", end_date="2024-01-02"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan
    assert out.count() == 4 and labels == ["start_date>=2024-01-02", "end_date<=2024-01-02"]
