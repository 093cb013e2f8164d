import pytest
from pyspark.sql import functions as F

from oddsline.operators import book as E
from oddsline.operators import decode as B


def books(spark, payloads):
    land = spark.createDataFrame([(f"tok{i}", p) for i, p in enumerate(payloads)], "token_id string, payload string")
    return B.decode_orderbook(land)


def test_simple_book_quotes_and_levels(spark):
    good, rej = books(spark, ['{"bids":[{"price":"0.4","size":"10"}],"asks":[{"price":"0.6","size":"5"}],'
                              '"timestamp":"1704067200000"}'])
    assert rej.count() == 0
    q = E.book_quotes_from_arrays(good).first()
    assert (q.bid, q.ask, q.mid, q.spread) == (0.4, 0.6, pytest.approx(0.5), pytest.approx(0.2))
    lv = E.flatten_books(good).collect()
    assert sorted((r.side, r.price, r.size) for r in lv) == [("ask", 0.6, 5.0), ("bid", 0.4, 10.0)]
    assert lv[0].timestamp == 1704067200000


def test_depth_fixture_both_shapes(spark):
    p = ('{"bids":[{"price":0.3,"size":5},{"price":0.4,"size":10}],'
         '"asks":[{"price":0.7,"size":6},{"price":0.6,"size":4}],"timestamp":0}')
    good, _ = books(spark, [p])
    d = E.depth_from_arrays(good, 0.1).first()
    assert (d.depth_bid, d.depth_ask, d.depth_both) == (10.0, 4.0, 14.0)
    levels = E.flatten_books(good)
    d2 = E.depth_at_distance(levels, 0.1).first()
    assert (d2.depth_bid, d2.depth_ask, d2.depth_both) == (10.0, 4.0, 14.0)
    ladder = good.first()
    assert [x.price for x in ladder.bids] == [0.4, 0.3] and [x.price for x in ladder.asks] == [0.6, 0.7]


def test_empty_and_malformed_books(spark):
    good, rej = books(spark, [
        '{"bids":[],"asks":[],"timestamp":"1704067200000"}',
        '{"bids":[{"price":"x","size":1},{"size":2},5],"asks":[{"price":0.5}],"timestamp":"soon"}',
        '{"asks":[]}',
    ])
    assert rej.count() == 1
    rows = {r.token_id: r for r in good.collect()}
    assert rows["tok1"].timestamp == 0 and rows["tok1"].bids == [] and rows["tok1"].asks == []
    q = E.book_quotes_from_arrays(good).collect()
    assert all(r.bid is None and r.mid is None for r in q)
    assert all(r.depth_both == 0.0 for r in E.depth_from_arrays(good, 0.1).collect())


def test_level_table_ops(spark):
    lv = spark.createDataFrame(
        [("A", 1, "bid", 0.4, 1.0, 1), ("A", 1, "bid", 0.4, 2.0, 2), ("A", 1, "bid", 0.5, 3.0, 3),
         ("A", 1, "ask", 0.7, 1.0, 4), ("B", 1, "bid", 0.2, 1.0, 5)],
        "token_id string, timestamp bigint, side string, price double, size double, level_seq bigint")
    lad = {r.level_seq: r.level for r in E.book_ladder(lv).collect()}
    assert lad == {3: 1, 1: 2, 2: 3, 4: 1, 5: 1}
    s = {r.token_id: r for r in E.spread_snapshot(lv).collect()}
    assert s["A"].spread == pytest.approx(0.2) and s["B"].ask is None and s["B"].mid is None


PH = [
    ('{"history":[{"t":1577836800000,"p":0.1},{"t":1577836800001,"p":0.2}]}', [(1577836800000, 0.1), (1577836800001, 0.2)]),
    ('{"history":[{"t":1577836800,"p":0.5}]}', [(1577836800000, 0.5)]),
    ('{"history":[{"t":"1577836800","p":0.5}]}', []),
    ('{"history":[{"t":"1577836800000","p":"0.5"}]}', [(1577836800000, 0.5)]),
    ('{"history":[{"p":0.5}]}', []),
    ('{"history":[]}', []),
]


@pytest.mark.parametrize("payload,expected", PH)
def test_price_history_cases(spark, payload, expected):
    land = spark.createDataFrame([("tok", 0, payload)], "token_id string, chunk_start bigint, payload string")
    good, rej = B.decode_price_history(land)
    assert [(r.t, r.p) for r in good.orderBy("pos").collect()] == expected
    assert rej.count() == 0


def test_price_history_without_history_is_rejected(spark):
    land = spark.createDataFrame([("tok", 0, "{}"), ("tok", 1, "not json")], "token_id string, chunk_start bigint, payload string")
    good, rej = B.decode_price_history(land)
    assert good.count() == 0 and rej.count() == 2


def test_trade_pages(spark):
    land = spark.createDataFrame([
        (0, 0, '[{"id":"a","timestamp":1,"size":"2","price":0.5,"conditionId":"c"},"junk"]'),
        (0, 1, '{"data":[{"id":"b","timestamp":"2","size":1,"price":null,"conditionId":"c"},3]}'),
        (0, 2, '{"other":1}'),
    ], "batch long, page long, payload string")
    rows = {r.id: r for r in B.decode_trades(land).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].size == 2.0 and rows["b"].timestamp == 2 and rows["b"].price is None


def test_market_token_and_outcome_normalisation(spark):
    pages = spark.createDataFrame([(0, '''[
      {"id":"1","clobTokenIds":"[\\"A\\", null, \\"B\\"]","outcomes":"[\\"Yes\\",\\"No\\"]"},
      {"id":"2","clobTokenIds":["A", null],"outcomes":["Y"]},
      {"id":"3","clobTokenIds":"not json","outcomes":"bad"},
      {"id":"4","clobTokenIds":null,"outcomes":5,"unknownKey":1},
      {"id":5},
      {"id":"6","tags":null},
      {"id":"7","active":"yes","closed":0,"createdAt":"2024-01-01T00:00:00Z"},
      "junk"
    ]''')], "page long, payload string")
    good, rej = B.decode_markets(pages)
    g = {r.id: r for r in good.collect()}
    assert g["1"].token_ids == ["A", "B"] and g["1"].outcomes == ["Yes", "No"]
    assert g["2"].token_ids == ["A", "None"] and g["2"].outcomes == ["Y"]
    assert g["3"].token_ids == [] and g["3"].outcomes is None
    assert g["4"].token_ids == [] and g["4"].outcomes is None
    assert g["7"].active is True and g["7"].closed is False and g["7"].tags == []
    assert set(g) == {"1", "2", "3", "4", "7"}
    assert rej.count() == 2  # numeric id, null tags


def test_iso_and_epoch_helpers(spark):
    from oddsline.functions import timecols as TC

    df = spark.createDataFrame([("2024-01-01T00:00:00Z", 1704067200123), ("", 0), ("20240101", 1)], "s string, ms bigint")
    r = df.select(TC.iso_to_ms("s").alias("a"), TC.ms_to_iso("ms").alias("b")).collect()
    assert r[0].a == 1704067200000 and r[0].b == "2024-01-01T00:00:00.123000+00:00"
    assert r[1].a is None and r[1].b == "1970-01-01T00:00:00+00:00"
    assert r[2].a is None  # T4: compact dates are not accepted
    with pytest.raises(Exception):
        df.select(TC.iso_to_ms_strict(F.lit("nope"))).collect()


def test_book_timestamp_forms(spark):
    good, _ = books(spark, [
        '{"bids":[],"asks":[],"timestamp":1704067200000}',
        '{"bids":[],"asks":[],"timestamp":1704067200000.0}',
        '{"bids":[],"asks":[],"timestamp":"1704067200000"}',
        '{"bids":[],"asks":[],"timestamp":"123"}',
        '{"bids":[],"asks":[],"timestamp":0}',
        '{"bids":[],"asks":[]}',
    ])
    got = {r.token_id: r.timestamp for r in good.collect()}
    assert got == {"tok0": 1704067200000, "tok1": 0, "tok2": 1704067200000, "tok3": 0, "tok4": 0, "tok5": 0}


def test_trade_timestamps_are_not_scaled(spark):
    # Unlike price points, trade timestamps in seconds stay as they are.
    from oddsline.operators import planning as D

    land = spark.createDataFrame([(0, 0, '[{"id":"s","timestamp":1704067200,"size":1,"price":0.5,"conditionId":"c"}]')],
                                 "batch long, page long, payload string")
    t = B.decode_trades(land)
    assert t.first().timestamp == 1704067200
    assert D.trades_since(t, 1704067200000).count() == 0  # compared with a millisecond bound


def test_trade_timestamp_cast_is_strict(spark):
    # A timestamp that is not an integer fails the decode (strict cast);
    # the lenient form turns it into null instead.
    land = spark.createDataFrame([(0, 0, '[{"id":"x","timestamp":"soon","size":1,"price":0.5,"conditionId":"c"}]')],
                                 "batch long, page long, payload string")
    with pytest.raises(Exception):
        B.decode_trades(land).collect()
    assert B.decode_trades(land, strict_timestamp=False).first().timestamp is None


def test_depth_level_and_array_forms_agree(spark):
    import json
    import random

    rnd = random.Random(8)
    payloads = []
    for _ in range(150):
        side = lambda: [{"price": rnd.randrange(1, 99) / 100, "size": rnd.randrange(1, 20)}
                        for _ in range(rnd.choice([0, 1, 3, 8]))]
        payloads.append(json.dumps({"bids": side(), "asks": side(), "timestamp": 0}))
    good, _ = books(spark, payloads)
    arr = {r.token_id: (r.depth_bid, r.depth_ask, r.depth_both) for r in E.depth_from_arrays(good, 0.05).collect()}
    lv = E.flatten_books(good).withColumn("timestamp", F.col("timestamp"))
    keyed = E.depth_at_distance(lv, 0.05)
    tab = {r.token_id: (r.depth_bid, r.depth_ask, r.depth_both) for r in keyed.collect()}
    for tok, v in tab.items():
        assert arr[tok] == pytest.approx(v), tok
    empty = set(arr) - set(tab)  # books without any level have no level rows
    assert all(arr[t] == (0.0, 0.0, 0.0) for t in empty)


ODD_PAGES = ['[{"id":1,"size":true,"price":" 2.5 ","timestamp":7,"x":[1]},3,null,"s",[{"id":"n"}],{},{"id":null,"timestamp":"8"}]',
             '{"data":[{"id":{"a":1},"size":"q","price":-2,"timestamp":null},{"side":true,"size":{},"timestamp":9}]}',
             '{"data":{"id":"z"}}', "not json", None, "[]", "[1,2]", '{"data":null}', '"t"', '[{"ID":"u","timestamp":1}]']


def test_trade_items_read_as_structs(spark):
    land = spark.createDataFrame([(i // 3, i, p) for i, p in enumerate(ODD_PAGES)], "batch long, page long, payload string")
    out = B.decode_trades(land, rest=False)
    # The kind of a whole item is not spelled out, and no item is copied as a variant.
    assert "array<variant>" not in out._jdf.queryExecution().analyzed().toString()
    rows = {(r.page, r.pos): r for r in out.collect()}
    assert rows == {(r.page, r.pos): r for r in B.decode_trades(land).drop("rest").collect()}
    assert {k: (r.id, r.size, r.price, r.timestamp) for k, r in rows.items()} == {
        (0, 0): ("1", 1.0, 2.5, 7), (0, 5): (None, None, None, None), (0, 6): (None, None, None, 8),
        (1, 0): ('{"a":1}', None, -2.0, None), (1, 1): (None, None, None, 9), (9, 0): (None, None, None, 1)}
    assert {r.page: r.n for r in B.page_sizes(land).collect()} == {0: 3, 1: 2, 9: 1, **dict.fromkeys(range(2, 9), 0)}


@pytest.mark.parametrize("rest", [False, True])
def test_trade_pages_are_parsed_once_and_numbers_read_in_the_cast(spark, rest):
    # An inner explode infers a test for items that goes below the landing table's aggregate and parses each page again.
    parts = spark.createDataFrame([(i // 3, i, p) for i, p in enumerate(ODD_PAGES)], "batch long, page long, part string")
    land = parts.groupBy("batch", "page").agg(F.concat_ws("", F.collect_list("part")).alias("payload"))
    out = B.decode_trades(land, rest=rest)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and "schemaOfVariant" not in plan
    assert {(r.page, r.pos) for r in out.collect()} == {(0, 0), (0, 5), (0, 6), (1, 0), (1, 1), (9, 0)}


def test_trade_numbers_follow_the_float_rule(spark):
    odd = ['" 1 "', '"\\t1"', '"1.5d"', '"NaN"', '" -Infinity"', '"0x10"', '""', '"abc"', '"true"', '"1,5"', '"1E+5"', "1e400", "-0.0", "1.50",
           "9223372036854775808", "123456789012345678901234567890", "0.30000000000000004", "true", "false", "null", "[1]", '{"a":1}']
    land = spark.createDataFrame([(0, i, f'[{{"size":{v},"price":{v},"timestamp":1}}]') for i, v in enumerate(odd)],
                                 "batch long, page long, payload string")
    want = land.select("page", B._float_value(F.try_variant_get(F.try_parse_json("payload"), "$[0].size", "variant")).alias("x"))
    want = {r.page: (repr(r.x), repr(r.x)) for r in want.collect()}
    for rest in (False, True):
        assert {r.page: (repr(r.size), repr(r.price)) for r in B.decode_trades(land, rest=rest).collect()} == want


def test_landed_trade_pages_exchange_no_texts(spark, tmp_dir):
    from oddsline.sources import adapters as A

    rows = [(k, n, 7, 11, q, t, s) for k, n, q, t, s in [
        (1, 2, 5.0, 0.02, "1996-01-02"), (1, 1, None, 0.0, "1996-01-01"), (0, 1, 17.5, None, "1996-01-03"), (0, 1, 17.5, None, "1996-01-03"),
        (300, 1, -0.0, 0.1, None), (300, 1, 0.0, 0.1, "1996-01-01"), (300, 2, 1e-7, 0.1, "1969-12-31")]]
    df = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_tax double, l_shipdate string")
    df.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")).write.parquet(f"{tmp_dir}/lineitem.parquet")
    pages = A.trade_pages(spark, tmp_dir)
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "transactionHash" not in plan[plan.index("collect_list("):]

    def item(k, n, size, price, t):
        return (f'{{"id":"{k}-{n}","conditionId":"S1","size":{size},"price":{price},"timestamp":{t},'
                f'"transactionHash":"0x{k}","fee":{{"bps":{n}}}}}')
    first = ",".join([item(0, 1, 17.5, "null", 820627200000)] * 2 + [item(1, 2, 5.0, 0.02, 820540800000)])
    second = ",".join([item(300, 1, "0.0", 0.1, 820454400000), item(300, 2, "1.0E-7", 0.1, -86400000)])
    assert {(r.batch, r.page): r.payload for r in pages.collect()} == {(0, 0): f'[{first},"junk"]', (0, 1): f'{{"data":[{second},"junk"]}}'}
