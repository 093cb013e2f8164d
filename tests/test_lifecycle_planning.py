import random

import pytest
from pyspark.sql import functions as F

from helpers import market_row, markets_df
from oddsline.operators import lifecycle as C
from oddsline.operators import planning as D

STORE = "id string, question string, resolved int, closed int, cached_at string, updated_at string"
INC = "id string, seq bigint, question string, resolved boolean, closed boolean"
NOW = "NOW"


def store(spark, rows):
    return spark.createDataFrame(rows, STORE)


def inc(spark, rows):
    return spark.createDataFrame(rows, INC)


def merged(spark, s, i):
    return {r.id: r for r in C.market_snapshot_merge(store(spark, s), inc(spark, i), NOW).collect()}


def test_resolved_is_immutable(spark):
    m = merged(spark, [("m1", "Original", 1, 1, "c0", "u0")], [("m1", 1, "Changed", False, False)])
    assert m["m1"].question == "Original" and m["m1"].resolved == 1 and m["m1"].updated_at == "u0"


def test_promotion_to_resolved(spark):
    m = merged(spark, [("m1", "q", 0, 0, "c0", "u0")], [("m1", 1, "q2", True, True)])
    assert m["m1"].resolved == 1 and m["m1"].question == "q2" and m["m1"].cached_at == "c0" and m["m1"].updated_at == NOW


def test_batch_fold_with_repeats(spark):
    m = merged(spark, [], [("a", 1, "v1", False, None), ("a", 2, "v2", True, None), ("a", 3, "v3", False, None)])
    assert m["a"].question == "v2" and m["a"].resolved == 1 and m["a"].closed == 0 and m["a"].cached_at == NOW
    c = C.market_merge_counts(store(spark, []), inc(spark, [("a", 1, "v1", False, None), ("a", 2, "v2", True, None),
                                                              ("a", 3, "v3", False, None)])).first()
    assert (c.inserted, c.updated) == (1, 1)


def test_counts_and_stats(spark):
    c = C.market_merge_counts(store(spark, [("m1", "q", 0, 0, "c", "u")]),
                              inc(spark, [("m1", 1, "q", True, True), ("m2", 2, "q", False, False)])).first()
    assert (c.inserted, c.updated, c.newly_resolved) == (1, 1, 1)
    st = C.market_store_stats(store(spark, [("m1", "", 1, 1, "", ""), ("m2", "", 0, 1, "", ""),
                                            ("m3", "", 0, 0, "", "")])).first()
    assert (st.total, st.resolved, st.closed_unresolved, st.active) == (3, 1, 1, 1)
    empty = C.market_store_stats(store(spark, [])).first()
    assert (empty.total, empty.resolved, empty.closed_unresolved, empty.active) == (0, 0, 0, 0)


def sequential_merge(stored, incoming):
    """The row-by-row upsert, as a reference for the closed form."""
    db = {k: dict(v) for k, v in stored.items()}
    ins = upd = 0
    for (mid, seq, q, res) in incoming:
        cur = db.get(mid)
        if cur is None:
            db[mid] = {"q": q, "res": 1 if res else 0, "seq": seq}
            ins += 1
        elif cur["res"] == 0:
            db[mid] = {"q": q, "res": 1 if res else 0, "seq": seq}
            upd += 1
    return db, ins, upd


def test_merge_matches_sequential_fold(spark):
    rnd = random.Random(7)
    s_rows, i_rows, stored = [], [], {}
    for k in range(40):
        mid = f"m{k}"
        if rnd.random() < 0.6:
            res = rnd.random() < 0.3
            stored[mid] = {"q": f"s{k}", "res": int(res), "seq": 0}
            s_rows.append((mid, f"s{k}", int(res), 0, "c", "u"))
    seq = 1
    incoming = []
    for _ in range(150):
        mid = f"m{rnd.randrange(45)}"
        res = rnd.choice([True, False, None])
        incoming.append((mid, seq, f"q{seq}", res))
        i_rows.append((mid, seq, f"q{seq}", res, None))
        seq += 1
    want, ins, upd = sequential_merge(stored, incoming)
    got = merged(spark, s_rows, i_rows)
    assert {k: (v["q"], v["res"]) for k, v in want.items()} == {k: (r.question, r.resolved) for k, r in got.items()}
    c = C.market_merge_counts(store(spark, s_rows), inc(spark, i_rows)).first()
    assert (c.inserted, c.updated) == (ins, upd)


def test_market_window_selection(spark):
    start, end = 1729209600000, 1734480000000
    feed = markets_df(spark, [
        market_row("m1", ["a"], closed=False, created_at="2024-10-01T00:00:00Z"),
        market_row("m2", ["b"], closed=False, created_at="2024-11-15T00:00:00Z"),
        market_row("m3", ["c"], closed=False, created_at="2024-12-20T00:00:00Z"),
        market_row("m5", ["e"], closed=False, created_at="not-a-date"),
        market_row("m6", ["f"], closed=False),
    ]).withColumn("pos", F.monotonically_increasing_id())
    closed = markets_df(spark, [market_row("m4", ["d"], closed=True, end_date="2024-11-01T00:00:00Z")]) \
        .withColumn("pos", F.lit(0).cast("bigint"))
    empty_store = feed.limit(0).withColumn("resolved", F.lit(0))
    sel = C.select_markets(feed, closed, empty_store, start, end)
    assert {r.id for r in sel.collect()} == {"m1", "m2", "m4", "m5", "m6"}


def test_first_source_wins(spark):
    a = markets_df(spark, [market_row("x", ["t"], closed=False, question="active")]).withColumn("pos", F.lit(1))
    b = markets_df(spark, [market_row("x", ["t"], closed=False, question="closed", end_date="2024-01-02T00:00:00Z")]) \
        .withColumn("pos", F.lit(0))
    out = C.merge_market_sources([("closed", b), ("active", a)]).collect()
    assert len(out) == 1 and out[0].question == "active" and out[0].source == "active"


# ------------------------------------------------------------------ planning

START = 1577836800000
CH = D.CHUNK_MS


def chunk_loop(s, e):
    out, cur = [], s
    while cur < e:
        ce = min(cur + CH, e)
        out.append((cur, ce))
        cur = ce + 1
    return out


@pytest.mark.parametrize("length", [2 * CH + 10_000, CH, CH + 1, CH + 2, 0, -5, 1])
def test_chunk_windows_match_loop(spark, length):
    jobs = spark.createDataFrame([("t", START, START + length)], "token_id string, start_ts bigint, end_ts bigint")
    got = [(r.chunk_start, r.chunk_end) for r in D.chunk_windows(jobs).orderBy("chunk_no").collect()]
    assert got == chunk_loop(START, START + length)


def empty_run_loop(counts, starts, created, limit=5):
    kept, run = [], 0
    for c, s in zip(counts, starts):
        kept.append(s)
        if c > 0:
            run = 0
        else:
            run += 1
            if (created is None or s >= created) and run >= limit:
                break
    return kept


def test_empty_run_cases_and_property(spark):
    rnd = random.Random(3)
    rows, want = [], {}
    cases = [([0] * 5 + [1], None), ([0] * 4 + [1] + [0] * 5, None), ([0] * 8, 6)]
    for _ in range(60):
        n = rnd.randrange(1, 25)
        cases.append(([rnd.choice([0, 0, 0, 1]) for _ in range(n)], rnd.choice([None, rnd.randrange(0, 10)])))
    for k, (counts, created) in enumerate(cases):
        starts = list(range(len(counts)))
        want[f"k{k}"] = empty_run_loop(counts, starts, created)
        rows += [(f"k{k}", s, c, created) for s, c in zip(starts, counts)]
    df = spark.createDataFrame(rows, "token_id string, chunk_start bigint, row_count bigint, created_at_ts bigint")
    got = {}
    for r in D.empty_run_cutoff(df).collect():
        got.setdefault(r.token_id, []).append(r.chunk_start)
    assert {k: sorted(v) for k, v in got.items()} == want
    assert want["k0"] == [0, 1, 2, 3, 4] and want["k1"] == list(range(10)) and want["k2"] == [0, 1, 2, 3, 4, 5, 6]


def test_pending_and_ledger_merge(spark):
    chunks = spark.createDataFrame([("a", 0, 10), ("a", 11, 20)], "token_id string, chunk_start bigint, chunk_end bigint")
    ledger = spark.createDataFrame([("a", 0, 10, 60, "t0", 3)], "token_id string, start_ts bigint, end_ts bigint, "
                                   "fidelity int, completed_at string, row_count bigint")
    assert [r.chunk_start for r in D.pending_windows(chunks, ledger, 60).collect()] == [11]
    assert D.pending_windows(chunks, ledger, 1).count() == 2
    marks = spark.createDataFrame([("a", 0, 10, 60, "t1", 5), ("a", 11, 20, 60, "t1", 0)], ledger.schema)
    m = {r.start_ts: (r.completed_at, r.row_count) for r in D.window_ledger_merge(ledger, marks).collect()}
    assert m == {0: ("t1", 5), 11: ("t1", 0)}


def test_id_batches_of_fifty(spark):
    ids = spark.createDataFrame([(i, f"id{i}") for i in range(120)] + [(999, None)], "pos long, id string")
    b = D.id_batches(ids, ["pos"]).orderBy("batch").collect()
    assert [r.n_ids for r in b] == [50, 50, 20]
    assert b[0].ids.split(",")[:2] == ["id0", "id1"] and b[2].ids.split(",")[-1] == "id119"


def test_row_budget_cuts_mid_page(spark):
    rows = [(b, p, i, f"{b}-{p}-{i}") for b in range(2) for p in range(3) for i in range(1000)]
    df = spark.createDataFrame(rows, "batch long, page long, pos int, id string")
    out = D.row_budget(df, 2500)
    assert out.count() == 2500
    last = out.agg(F.max(F.struct("batch", "page", "pos")).alias("m")).first().m
    assert (last.batch, last.page, last.pos) == (0, 2, 499)


def test_trades_since_inclusive(spark):
    t = spark.createDataFrame([(1704067200000,), (1736689600000,), (1736689601000,)], "timestamp bigint")
    assert D.trades_since(t, 1736689600000).count() == 2


def test_dedupe_keeps_chunk_order(spark):
    pts = spark.createDataFrame([("x", t, float(t), 0, i) for i, t in enumerate((0, 50, 100))] +
                                [("x", t, -float(t), 1, i) for i, t in enumerate((100, 150, 200))],
                                "token_id string, t bigint, p double, chunk_start bigint, pos int")
    got = sorted((r.t, r.p) for r in D.dedupe_price_points(pts).collect())
    assert got == [(0, 0.0), (50, 50.0), (100, 100.0), (150, -150.0), (200, -200.0)]


def test_token_jobs_clamp_and_rejects(spark):
    m = markets_df(spark, [
        market_row("a", ["t1", "t2"], created_at="2024-01-05T00:00:00Z", end_date="2024-03-01T00:00:00Z"),
        market_row("b", ["t3"], created_at="2024-01-05T00:00:00Z", resolution_date="2024-01-06T00:00:00Z",
                   end_date="2024-03-01T00:00:00Z"),
        market_row("c", [], created_at="2024-01-05T00:00:00Z"),
        market_row("d", ["t4"], created_at="garbage"),
        market_row("e", ["t5"], created_at="2024-03-01T00:00:00Z"),
    ])
    jobs, rej = D.token_jobs(m, 1704067200000, 1707955200000)
    got = {r.token_id: (r.start_ts, r.end_ts) for r in jobs.collect()}
    assert got == {"t1": (1704412800000, 1707955200000), "t2": (1704412800000, 1707955200000),
                   "t3": (1704412800000, 1704499200000)}
    assert [r.id for r in rej.collect()] == ["d"]


def test_lookback_months_clamp(spark):
    from oddsline.functions.timecols import lookback_start_ms

    mar31 = 1711843200000  # 2024-03-31 UTC
    v = spark.range(1).select(lookback_start_ms(mar31, months=1).alias("a"),
                              lookback_start_ms(mar31, weeks=1).alias("b")).first()
    assert v.a == 1709164800000  # 2024-02-29 (T6: clamped)
    assert v.b == mar31 - 7 * 86400000


def test_prefix_offsets_across_partitions(spark):
    rnd = random.Random(9)
    rows = [(k, rnd.choice([None, 0, 1, 5, 17])) for k in rnd.sample(range(100_000), 3000)]
    df = spark.createDataFrame(rows, "k long, w long").repartition(13)
    got = {r.k: r.offset for r in D.prefix_offsets(df, ["k"], "w").collect()}
    acc, want = 0, {}
    for k, w in sorted(rows):
        want[k] = acc
        acc += w or 0
    assert got == want
    empty = D.prefix_offsets(df.limit(0), ["k"], "w")
    assert empty.count() == 0


def test_cogrouped_pending_counts_equal_joins(spark):
    jobs = spark.createDataFrame([("a", 0, 100, 0), ("b", 10, 30, 10)],
                                 "token_id string, start_ts bigint, end_ts bigint, created_at_ts bigint")
    chunks = D.chunk_windows(jobs, chunk_ms=9)
    ledger = spark.createDataFrame([("a", 10, 19, 60, "x", 0), ("a", 20, 29, 1, "x", 0)],
                                   "token_id string, start_ts bigint, end_ts bigint, fidelity int, "
                                   "completed_at string, row_count bigint")
    pts = spark.createDataFrame([("a", t) for t in (0, 5, 9, 25, 99, 100)] + [("b", 31), ("b", 12)] * 3,
                                "token_id string, t bigint")
    got = {(r.token_id, r.chunk_start): r.row_count for r in
           D.pending_with_counts(chunks, ledger, 60, D.chunk_of_points(pts, jobs, chunk_ms=9)).collect()}
    pend = D.pending_windows(chunks, ledger, 60)
    want = {}
    for r in pend.collect():
        n = sum(1 for tok, t in [("a", t) for t in (0, 5, 9, 25, 99, 100)] + [("b", 31), ("b", 12)] * 3
                if tok == r.token_id and r.chunk_start <= t <= r.chunk_end)
        want[(r.token_id, r.chunk_start)] = n
    assert got == want and got[("a", 0)] == 3 and got[("b", 10)] == 3


def test_id_batches_without_list_and_page_cap(spark):
    one = D.id_batches(None, ["pos"], spark=spark).collect()
    assert len(one) == 1 and one[0].ids is None
    from oddsline.operators.decode import decode_markets

    pages = spark.createDataFrame([(p, f'[{{"id":"m{p}"}}]') for p in range(5)], "page long, payload string")
    assert decode_markets(pages, max_pages=2)[0].count() == 2


def test_backfill_plan_with_points(spark):
    from helpers import market_row, markets_df
    from oddsline.plans import stages

    day = 86_400_000
    m = markets_df(spark, [market_row("a", ["t1"], created_at="2024-01-01T00:00:00Z", end_date="2024-12-01T00:00:00Z")])
    pts = spark.createDataFrame([("t1", 1704067200000 + day)], "token_id string, t bigint")
    pending, _ = stages.backfill_plan(m, None, 1704067200000, 1730000000000, 60, points=pts)
    rows = pending.orderBy("chunk_start").collect()
    assert rows[0].row_count == 1 and len(rows) == 6  # one full chunk, then five empty ones stop it


def test_merge_in_two_steps_equals_one(spark):
    rnd = random.Random(21)
    s_rows = [(f"m{k}", f"s{k}", int(rnd.random() < 0.3), 0, "c", "u") for k in range(0, 30, 2)]
    inc_rows = [(f"m{rnd.randrange(35)}", seq, f"q{seq}", rnd.choice([True, False, None]), None)
                for seq in range(1, 121)]
    cut = 60
    one = C.market_snapshot_merge(store(spark, s_rows), inc(spark, inc_rows), "T")
    first = C.market_snapshot_merge(store(spark, s_rows), inc(spark, inc_rows[:cut]), "T").drop("version_seq")
    two = C.market_snapshot_merge(first, inc(spark, inc_rows[cut:]), "T")
    cols = ["id", "question", "resolved", "closed", "cached_at", "updated_at"]
    assert sorted(map(tuple, one.select(*cols).collect())) == sorted(map(tuple, two.select(*cols).collect()))


def test_points_land_in_their_chunk(spark):
    rnd = random.Random(13)
    ch = 9
    jobs_rows, pts_rows = [], []
    for k in range(40):
        s = rnd.randrange(0, 50)
        e = s + rnd.randrange(1, 60)
        jobs_rows.append((f"t{k}", s, e))
        pts_rows += [(f"t{k}", rnd.randrange(s - 5, e + 5)) for _ in range(15)]
    jobs = spark.createDataFrame(jobs_rows, "token_id string, start_ts bigint, end_ts bigint")
    pts = spark.createDataFrame(pts_rows, "token_id string, t bigint")
    got = sorted(map(tuple, D.chunk_of_points(pts, jobs, chunk_ms=ch).collect()))
    want = []
    chunks = {tok: chunk_list(s, e, ch) for tok, s, e in jobs_rows}
    for tok, t in pts_rows:
        hits = [(a, b) for a, b in chunks[tok] if a <= t <= b]
        assert len(hits) <= 1
        want += [(tok, a, b) for a, b in hits]
    assert got == sorted(want)


def chunk_list(s, e, ch):
    out, cur = [], s
    while cur < e:
        ce = min(cur + ch, e)
        out.append((cur, ce))
        cur = ce + 1
    return out


def test_row_budget_random(spark):
    rnd = random.Random(31)
    rows = []
    for b in range(4):
        for p in range(rnd.randrange(1, 6)):
            rows += [(b, p, i) for i in range(rnd.choice([0, 1, 7, 10, 25]))]
    df = spark.createDataFrame(rows, "batch long, page long, pos int").repartition(5)
    ordered = sorted(rows)
    for budget in (0, 1, 10, 17, len(rows) - 1, len(rows), len(rows) + 5):
        got = sorted(map(tuple, D.row_budget(df, budget).collect()))
        assert got == ordered[:budget], budget
