import math

import pytest
from pyspark.sql import functions as F

from helpers import market_row, markets_df, two_markets
from oddsline.operators import process as P

DAY = 86_400_000
T0 = 1704067200000


def prices(spark, rows, v2=False):
    schema = "token_id string, timestamp bigint, price double" if v2 else "token_id string, t bigint, p double"
    return spark.createDataFrame(rows, schema)


def fixture_prices(spark, v2=False):
    rows = [(tok, ts, p) for tok in ("YES1", "NO1", "YES2", "NO2") for ts, p in ((T0, 0.4), (T0 + DAY, 0.6))]
    return prices(spark, rows, v2)


def test_token_map_two_markets(spark):
    m = P.token_market_map(two_markets(spark))
    got = {r.token_id: (r.market_id, r.outcome_name) for r in m.collect()}
    assert got == {"YES1": ("m1", "YES"), "NO1": ("m1", "NO"), "YES2": ("m2", "YES"), "NO2": ("m2", "NO")}


def test_token_map_null_empty_and_positions(spark):
    m = markets_df(spark, [
        market_row("a", None, ["YES", "NO"]),
        market_row("b", [], ["YES", "NO"]),
        market_row("c", [None, "B"], ["YES", "NO"]),
        market_row("d", ["X", "Y", "Z"], ["YES", "NO"]),
    ])
    rows = P.token_market_map(m).collect()
    by_market = {}
    for r in rows:
        by_market.setdefault(r.market_id, []).append((r.token_id, r.outcome_name))
    # Null and empty lists keep one null-token row.
    assert [t for t, _ in by_market["a"]] == [None]
    assert [t for t, _ in by_market["b"]] == [None]
    # F2 index counts non-null tokens: B takes the first outcome.
    assert dict(by_market["c"])["B"] == "YES"
    # Past the end gives null instead of failing.
    assert dict(by_market["d"])["Z"] is None


def test_prices_joined_counts(spark):
    j = P.prices_joined(fixture_prices(spark), two_markets(spark))
    assert j.count() == 8
    assert j.columns[:3] == ["token_id", "t", "p"]


def test_prices_joined_v2_alias(spark):
    j = P.prices_joined(fixture_prices(spark, v2=True), two_markets(spark))
    assert j.count() == 8 and {"t", "p"} <= set(j.columns)


def test_daily_returns_fixture(spark):
    r = P.daily_returns(fixture_prices(spark), two_markets(spark)).filter("token_id = 'YES1'").orderBy("day_ts").collect()
    assert [x.day_ts for x in r] == [T0, T0 + DAY]
    assert r[0].ret is None and r[1].ret == pytest.approx(0.5)
    assert r[0].market_id == "m1"


def test_pct_change_fills_nulls(spark):
    vals = [10.0, 11.0, 12.0, None, 12.0]
    df = prices(spark, [("A", T0 + i * DAY, v) for i, v in enumerate(vals)])
    r = [x.ret for x in P.daily_returns(df).orderBy("day_ts").collect()]
    assert r[0] is None
    assert r[1] == pytest.approx(0.1) and r[2] == pytest.approx(1 / 11) and r[3] == 0.0 and r[4] == 0.0


def test_zero_previous_price_gives_inf_nan(spark):
    rows = [("up", T0, 0.0), ("up", T0 + DAY, 1.0), ("dn", T0, 0.0), ("dn", T0 + DAY, -1.0),
            ("eq", T0, 0.0), ("eq", T0 + DAY, 0.0)]
    r = {x.token_id: x.ret for x in P.daily_returns(prices(spark, rows)).filter("ret is not null").collect()}
    assert r["up"] == math.inf and r["dn"] == -math.inf and math.isnan(r["eq"])


def test_day_bucket_floors_negative(spark):
    df = prices(spark, [("A", -1, 1.0), ("A", DAY + 5, 1.0)])
    got = sorted(x.day_ts for x in P.daily_mean_price(df).collect())
    assert got == [-DAY, DAY]


def test_price_panel_and_blocks(spark):
    panel = P.price_panel(fixture_prices(spark))
    assert panel.count() == 2 and len(panel.columns) == 5
    blocks = P.panel_blocks(P.daily_mean_price(fixture_prices(spark)), block=3)
    assert [len(b.columns) - 1 for b in blocks] == [3, 1] and all(b.count() == 2 for b in blocks)
    dims = P.panel_dims(P.daily_mean_price(fixture_prices(spark))).first()
    assert (dims.panel_days, dims.panel_tokens) == (2, 4)


def test_trades_daily_agg(spark):
    t = spark.createDataFrame([(T0, 1.0, 0.4, "c1"), (T0 + DAY, 2.0, 0.6, "c1"), (T0, None, None, "c2")],
                              "timestamp bigint, size double, price double, conditionId string")
    got = {(r.conditionId, r.day_ts): (r.trades, r.size_sum, r.notional_sum) for r in P.trades_daily_agg(t).collect()}
    assert got[("c1", T0)] == (1, 1.0, pytest.approx(0.4))
    assert got[("c1", T0 + DAY)] == (1, 2.0, pytest.approx(1.2))
    assert got[("c2", T0)] == (1, 0.0, 0.0)  # T13: sum of nulls is 0, the row still counts


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError):
        P.trades_daily_agg(spark.createDataFrame([(1,)], "x int"))
    with pytest.raises(ValueError):
        P.daily_mean_price(spark.createDataFrame([(1,)], "x int"))


def test_daily_returns_single_exchange_per_token(spark):
    df = P.daily_returns(fixture_prices(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The aggregate's exchange on (token_id, day_ts) and the window's on token_id.
    assert plan.count("Exchange hashpartitioning") <= 2
    assert F is not None


def test_minimal_markets_give_typed_nulls(spark):
    # Only id and token_ids are required; the other map columns are typed nulls.
    m = spark.createDataFrame([("m1", ["A", "B"])], "id string, token_ids array<string>")
    tm = P.token_market_map(m)
    row = tm.filter("token_id = 'A'").first()
    assert row.market_id == "m1" and row.question is None and row.outcome_name is None
    assert dict(tm.dtypes)["resolved"] == "boolean"


def test_markets_from_two_runs_double_the_join(spark, tmp_dir):
    # Scan mode reads every run's markets file; a token in two runs joins twice.
    from oddsline.sources import files as S

    for run in ("r1", "r2"):
        two_markets(spark).write.parquet(f"{tmp_dir}/raw/{run}/markets.parquet")
    markets = S.scan_run_table(spark, S.RunInput(mode="scan", root=tmp_dir), "markets")
    assert P.prices_joined(fixture_prices(spark), markets).count() == 16


def test_wide_panels_have_no_token_limit(spark):
    daily = spark.range(10_001).selectExpr("concat('t', id) token_id", "0L day_ts", "1.0D price_day")
    blocks = P.panel_blocks(daily.union(spark.createDataFrame([(None, 0, 2.0)], "token_id string, day_ts long, price_day double")))
    assert sum(len(b.columns) - 1 for b in blocks) == 10_002 and len(blocks) == 3
    assert blocks[0].select("null").first()[0] == 2.0 and blocks[2].count() == 1
