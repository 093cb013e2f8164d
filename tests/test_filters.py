import math

import pytest

from oddsline.operators import filters as G

DAY = 86_400_000
END_DAY_START = 1705708800000  # 2024-01-20 00:00 UTC
SCHEMA = ("token_id string, t bigint, p double, market_id string, resolved boolean, category string, "
          "created_at string")


def joined(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_end_day_inclusive(spark):
    df = joined(spark, [("A", END_DAY_START, 1.0, "m", True, "x", None),
                        ("A", END_DAY_START + DAY - 1, 1.0, "m", True, "x", None),
                        ("A", END_DAY_START + DAY, 1.0, "m", True, "x", None)])
    out = G.filter_date_range(df, "2024-01-20", "2024-01-20")
    assert sorted(r.t for r in out.collect()) == [END_DAY_START, END_DAY_START + DAY - 1]


def test_resolved_null_excluded_both_ways(spark):
    df = joined(spark, [("A", 1, 1.0, "m1", True, None, None), ("B", 1, 1.0, "m2", False, None, None),
                        ("C", 1, 1.0, "m3", None, None, None)])
    assert [r.token_id for r in G.filter_resolved(df, True).collect()] == ["A"]
    assert [r.token_id for r in G.filter_resolved(df, False).collect()] == ["B"]
    with pytest.raises(ValueError):
        G.FilterConfig(resolved_only=True, unresolved_only=True)


def test_category_null_dropped_by_include_and_exclude(spark):
    df = joined(spark, [("A", 1, 1.0, "m", None, "x", None), ("B", 1, 1.0, "m", None, None, None),
                        ("C", 1, 1.0, "m", None, "y", None)])
    assert {r.token_id for r in G.filter_category(df, include=["x", "y"]).collect()} == {"A", "C"}
    assert {r.token_id for r in G.filter_category(df, exclude=["x"]).collect()} == {"C"}  # T15


def test_market_age_string_comparison(spark):
    cut = "2024-01-16T00:00:00"
    df = joined(spark, [("Z", 1, 1.0, "m", None, None, cut + "Z"), ("N", 1, 1.0, "m", None, None, cut)])
    older = {r.token_id for r in G.filter_market_age(df, "2024-02-15", min_age_days=30).collect()}
    newer = {r.token_id for r in G.filter_market_age(df, "2024-02-15", max_age_days=30).collect()}
    assert older == {"N"}          # T14: the 'Z' suffix sorts after the cut-off
    assert newer == {"Z", "N"}


def test_missing_column_skips_predicate(spark):
    df = spark.createDataFrame([("A", 1, 1.0)], "token_id string, t bigint, p double")
    out, applied = G.apply_filters(df, G.FilterConfig(categories=["x"], resolved_only=True))
    assert out.count() == 1 and applied == []


def test_market_ids_long_list_uses_semi_join(spark):
    df = joined(spark, [(f"T{i}", 1, 1.0, f"M{i}", None, None, None) for i in range(20)] +
                [("N", 1, 1.0, None, None, None, None)])
    keep = [f"M{i}" for i in range(0, 20, 2)]
    short = G.filter_market_ids(df, include=keep)
    long = G.filter_market_ids(df, include=keep, max_literal=3)
    assert sorted(r.token_id for r in short.collect()) == sorted(r.token_id for r in long.collect())
    assert "LeftSemi" in long._jdf.queryExecution().optimizedPlan().toString()
    excl = G.filter_market_ids(df, exclude=keep, max_literal=3)
    assert "N" not in {r.token_id for r in excl.collect()}  # null ids dropped, as with not-in


def test_jumps_and_thresholds(spark):
    df = joined(spark, [("A", 1, 1.0, "m", None, None, None), ("A", 2, 0.0, "m", None, None, None),
                        ("A", 3, 2.0, "m", None, None, None), ("A", 4, None, "m", None, None, None),
                        ("A", 5, 3.0, "m", None, None, None)])
    j = {r.t: (r.jump_abs, r.jump_pct) for r in G.compute_jumps(df).collect()}
    assert j[1] == (None, None)
    assert j[2] == (-1.0, -1.0)
    assert j[3][0] == 2.0 and j[3][1] == math.inf       # T11: previous price 0
    assert j[4] == (None, None) and j[5] == (None, None)  # T10: no filling for jumps
    cfg = G.FilterConfig(min_jump_abs=1.5)
    out, labels = G.filter_jumps(df, cfg)
    assert [r.t for r in out.collect()] == [3] and "jump_abs" not in out.columns and labels
    kept, _ = G.filter_jumps(df, G.FilterConfig(min_jump_abs=1.5, compute_jumps=True))
    assert "jump_abs" in kept.columns


def test_jumps_need_columns(spark):
    with pytest.raises(ValueError):  # T19
        G.compute_jumps(spark.createDataFrame([("A", 1)], "token_id string, t bigint"))


def test_row_filters_apply_before_jumps(spark):
    df = joined(spark, [("A", 1, 1.0, "m", True, None, None), ("A", 2, 5.0, "m", False, None, None),
                        ("A", 3, 2.0, "m", True, None, None)])
    res = G.run_filter(df, G.FilterConfig(resolved_only=True, compute_jumps=True))
    rows = {r.t: r.jump_abs for r in res.frame.collect()}
    assert rows == {1: None, 3: 1.0}
    rep = res.report()
    assert rep["input_count"] == 3 and rep["output_count"] == 2 and rep["rows_removed"] == 1
    assert rep["filters_applied"] == ["resolved_only"]


def test_report_frame_matches_observed(spark):
    df = joined(spark, [("A", i, float(i % 3), "m", i % 2 == 0, None, None) for i in range(1, 30)])
    cfg = G.FilterConfig(resolved_only=True, min_jump_abs=0.5)
    res = G.run_filter(df, cfg)
    n = res.frame.count()
    rep = G.filter_report_frame(df, cfg).first()
    assert rep.input_count == 29 and rep.output_count == n == res.report()["output_count"]


def test_jump_plans_equal_plain_window(spark):
    import random

    rnd = random.Random(5)
    rows = []
    for tok in ("A", "B", "C"):
        t = 0
        for _ in range(300):
            t += rnd.choice([0, 1, 3, 50, 400])
            rows.append((tok, t, rnd.choice([None, 0.0, 1.0, 2.5, float(rnd.randrange(9))]), "m", None, None, None))
    df = joined(spark, rows)
    key = ["token_id", "t", "p", "jump_abs", "jump_pct"]

    def norm(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    def rows_of(frame):
        return sorted((tuple(norm(x) for x in r) for r in frame.select(*key).collect()), key=repr)

    plain = rows_of(G.compute_jumps(df, mode="window"))
    assert rows_of(G.compute_jumps(df, mode="bucket", bucket_ms=100)) == plain
    assert rows_of(G.compute_jumps(df, mode="bucket", bucket_ms=7)) == plain
    assert rows_of(G.compute_jumps(df.repartition(5), mode="range")) == plain
    assert rows_of(G.compute_jumps(df)) == plain
    hot = joined(spark, rows + [(None, i, 1.0 * (i % 3), "m", None, None, None) for i in range(50)])
    assert rows_of(G.compute_jumps(hot.repartition(9), mode="range")) == rows_of(G.compute_jumps(hot, mode="window"))


def test_hot_token_is_spread_over_partitions(spark):
    from pyspark.sql import functions as F

    from oddsline.operators.ordering import previous_values

    n = 40_000
    df = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("T"), (F.col("id") % 97).cast("string")))
        .alias("token_id"), F.col("id").alias("t"), (F.col("id") % 13).cast("double").alias("p"))
    out = previous_values(df, "token_id", ["t", "p"], ["p"])
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("pid")).count().collect()]
    assert sum(sizes) == n
    assert max(sizes) <= 3 * n / len(sizes)  # the hot token (half the rows) is not in one task
    hot = out.filter("token_id = 'HOT' and t > 0").select(((F.col("p") - F.col("prev_p")).isNotNull()).alias("ok"))
    assert hot.filter("ok").count() == n // 2 - 1


def scans(df):
    """Number of file scans in a plan before execution."""
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_jumps_of_a_hot_hour_are_split_and_read_once(spark, tmp_dir):
    from pyspark.sql import functions as F

    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("HOT")).otherwise(F.concat(F.lit("T"), (F.col("id") % 50).cast("string")))
        .alias("token_id"), (F.col("id") * 100).alias("t"), (F.col("id") % 7).cast("double").alias("p"))
    rows.write.parquet(f"{tmp_dir}/prices")  # 50 minutes of one hour
    df = spark.read.parquet(f"{tmp_dir}/prices")
    jumps = G.compute_jumps(df)
    assert scans(jumps) == 1 and "Join" not in jumps._jdf.queryExecution().optimizedPlan().toString()
    plain = G.compute_jumps(df, mode="window")
    assert jumps.exceptAll(plain).count() == 0 and plain.exceptAll(jumps).count() == 0
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = G.compute_jumps(df).filter("token_id = 'HOT'").groupBy(F.spark_partition_id().alias("pid")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in out) < 20_000 / 2


def test_jumps_with_null_times_prices_and_single_rows(spark):
    rows = [("A", None, 1.0), ("A", None, None), ("A", None, 3.0), ("A", 5, None), ("A", 5, 2.0), ("A", 5, 2.0), ("A", 99, 4.0),
            ("A", 100, 8.0), ("A", 500, None), ("A", 900, 1.0), (None, 1, 1.0), (None, 700, 2.0), ("B", 3, 1.0)]
    df = spark.createDataFrame(rows, "token_id string, t long, p double")
    plain = sorted(map(tuple, G.compute_jumps(df, mode="window").collect()), key=repr)
    for ms in (1, 100, 1000):
        assert sorted(map(tuple, G.compute_jumps(df, bucket_ms=ms).collect()), key=repr) == plain
    assert G.compute_jumps(df.where("false")).count() == 0


def test_report_reads_once_and_counts_like_the_filters(spark, tmp_dir):
    import random

    rnd = random.Random(4)
    rows = [(rnd.choice("AB"), rnd.randrange(400_000), rnd.choice([None, 1.0, 2.0, 5.0]), "m", rnd.choice([True, False, None]), None, None)
            for _ in range(500)]
    joined(spark, rows).write.parquet(f"{tmp_dir}/joined")
    df = spark.read.parquet(f"{tmp_dir}/joined")
    for cfg in (G.FilterConfig(resolved_only=True, min_jump_abs=1.0, max_jump_pct=0.9), G.FilterConfig(unresolved_only=True),
                G.FilterConfig(resolved_only=True, compute_jumps=True)):
        frame = G.filter_report_frame(df, cfg)
        rep = frame.first()
        assert scans(frame) == 1
        assert (rep.input_count, rep.output_count) == (500, G.run_filter(df, cfg).frame.count())
