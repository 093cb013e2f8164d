import pytest
from pyspark.sql import functions as F

from oddsline.plans import stores
from oddsline.streaming.ingest import run_to_completion, scratch_path

INC = "id string, seq bigint, question string, resolved boolean, closed boolean"


def test_versioned_market_store(spark, tmp_dir):
    st = stores.market_store_table(spark, f"{tmp_dir}/store")
    assert st.current().count() == 0
    b1 = spark.createDataFrame([("m1", 1, "q1", False, False), ("m2", 2, "q2", True, True)], INC)
    assert stores.merge_markets(st, b1, "T1", 1)
    with pytest.raises(FileExistsError):
        stores.merge_markets(st, b1, "T1", 1)              # a named version must be free
    b2 = spark.createDataFrame([("m1", 1, "q1b", True, True), ("m2", 2, "changed", False, False)], INC)
    stores.merge_markets(st, b2, "T2", tag="w_0")          # the next version
    assert stores.merge_markets(st, b1, "T3", tag="w_0") is None  # a replayed batch is skipped
    cur = {r.id: r for r in st.current().collect()}
    assert st.versions() == [1, 2]
    assert (cur["m1"].question, cur["m1"].resolved, cur["m1"].cached_at, cur["m1"].updated_at) == ("q1b", 1, "T1", "T2")
    assert (cur["m2"].question, cur["m2"].updated_at) == ("q2", "T1")  # resolved rows never change
    first = {r.id: r.question for r in spark.read.parquet(st.path(1)).collect()}
    assert first == {"m1": "q1", "m2": "q2"}  # the old version is untouched


def test_ledger_versions(spark, tmp_dir):
    led = stores.ledger_table(spark, f"{tmp_dir}/ledger")
    marks = spark.createDataFrame([("a", 0, 10, 60, "t1", 3)], led.schema)
    stores.merge_ledger(led, marks, 1)
    stores.merge_ledger(led, marks.withColumn("row_count", F.lit(5).cast("bigint")), 2)
    assert [r.row_count for r in led.current().collect()] == [5]


def test_stream_market_merge(spark):
    src = scratch_path(spark, "incoming")
    spark.createDataFrame([("m1", 1, "a", False, False), ("m1", 2, "b", True, True)], INC).write.parquet(f"{src}/p1")
    root = scratch_path(spark, "store")
    ckpt = scratch_path(spark, "ckpt")
    schema = spark.read.parquet(f"{src}/p1").schema
    run_to_completion(stores.stream_market_merge(spark, f"{src}/*", schema, root, "NOW", ckpt))
    spark.createDataFrame([("m1", 3, "c", False, False), ("m2", 4, "d", False, False)], INC).write.parquet(f"{src}/p2")
    run_to_completion(stores.stream_market_merge(spark, f"{src}/*", schema, root, "LATER", ckpt))
    cur = {r.id: (r.question, r.resolved) for r in stores.market_store_table(spark, root).current().collect()}
    assert cur == {"m1": ("b", 1), "m2": ("d", 0)}
