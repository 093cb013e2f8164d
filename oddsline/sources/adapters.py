"""Views of the driver's generic tables as prediction-market tables.

The driver ships TPC-H-like tables; each function here derives one market
table from them with plain column expressions, so every downstream query
reads whole tables and its work grows with them. ``oracle_views.py`` holds
the same definitions in DuckDB SQL.

Every view is a narrow projection over one parquet scan (plus, for a few,
an aggregate), so Catalyst prunes columns at the scan and pushes filters
into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oddsline.functions.timecols import epoch_ms

# Fixed adapter parameters (shared with oracle_views.py).
VERSION_CUT = "1998-01-01"          # market versions before this date are "stored"
SEQ_DAY_FACTOR = 1_000_000_000_000  # seq = days since epoch * factor + order key
BOOK_SNAPSHOT_ROWS = 64             # events per book snapshot (bounds every book)
BOOK_CLOCK_START_MS = 1704067200000
PAYLOAD_PAGE_ROWS = 64              # events per price-history payload
MARKET_PAGE_KEYS = 100              # customer keys (markets) per market page
TRADE_PAGE_ORDERS = 256             # order keys per trade page
TRADE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_shipdate")
TRADE_BATCH_PAGES = 8               # pages per market batch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso_day(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(token_id, t, p): one price point per event."""
    e = table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("T"), F.col("user_id")).alias("token_id"),
                    epoch_ms("ts").alias("t"), F.col("value").alias("p"))


def prices_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices with zeros ('error' events) and nulls ('signup') for the edge cases."""
    e = table(spark, sf_dir, "events")
    p = (F.when(F.col("event_type") == "error", F.lit(0.0))
         .when(F.col("event_type") == "signup", F.lit(None).cast("double"))
         .otherwise(F.col("value")))
    return e.select(F.concat(F.lit("T"), F.col("user_id")).alias("token_id"),
                    epoch_ms("ts").alias("t"), p.alias("p"))


def prices_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same points under the alternative column names (timestamp, price)."""
    return prices(spark, sf_dir).withColumnsRenamed({"t": "timestamp", "p": "price"})


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One binary market per customer k, tokens T<2k> and T<2k+1> (every
    customer is a market and no token belongs to two markets)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    created = F.date_add(F.lit("2023-12-01").cast("date"), F.pmod(k, F.lit(60)).cast("int"))
    ended = F.date_add(created, 45)
    resolved = F.when(F.pmod(k, F.lit(10)) == 0, F.lit(None).cast("boolean")).otherwise(F.col("c_acctbal") < 3000)
    closed = F.col("c_acctbal") < 5000
    return c.select(
        F.concat(F.lit("M"), k).alias("id"),
        F.col("c_name").alias("question"),
        F.concat(F.lit("segment "), F.col("c_mktsegment")).alias("description"),
        F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("-"))).alias("market_slug"),
        F.concat(F.lit("C"), k).alias("condition_id"),
        F.array(F.concat(F.lit("T"), k * 2), F.concat(F.lit("T"), k * 2 + 1)).alias("token_ids"),
        F.array(F.lit("YES"), F.lit("NO")).alias("outcomes"),
        (~closed).alias("active"),
        closed.alias("closed"),
        F.lit(False).alias("archived"),
        _iso_day(created).alias("created_at"),
        _iso_day(ended).alias("end_date"),
        resolved.alias("resolved"),
        F.when(resolved, _iso_day(ended)).alias("resolution_date"),
        F.when(resolved, F.when(F.col("c_acctbal") < 0, F.lit("NO")).otherwise(F.lit("YES"))).alias("resolution_outcome"),
        F.array(F.col("c_mktsegment")).alias("tags"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("category"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades from line items; a zero tax gives a null price."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("id"),
        F.concat(F.lit("S"), F.pmod("l_suppkey", F.lit(5))).alias("conditionId"),
        F.concat(F.lit("T"), F.col("l_partkey")).alias("asset_id"),
        F.when(F.col("l_returnflag") == "R", F.lit("SELL")).otherwise(F.lit("BUY")).alias("side"),
        F.col("l_quantity").alias("size"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("price"),
        epoch_ms("l_shipdate").alias("timestamp"),
    )


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return o.select(
        F.concat(F.lit("M"), F.col("o_custkey")).alias("id"),
        (day * F.lit(SEQ_DAY_FACTOR) + F.col("o_orderkey")).alias("seq"),
        F.col("o_orderpriority").alias("question"),
        (F.col("o_orderstatus") == "F").alias("resolved"),
        F.col("o_orderstatus").isin("F", "P").alias("closed"),
        F.col("o_orderdate"),
    )


def market_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored snapshot: the last version per id before the cut (one row per id).

    ``max_by`` is a partial aggregate, so a hot id is combined map-side.
    """
    v = _versions(spark, sf_dir).filter(F.col("o_orderdate") < F.lit(VERSION_CUT).cast("timestamp_ntz"))
    last = F.max_by(F.struct("question", "resolved", "closed", "o_orderdate"), "seq")
    s = v.groupBy("id").agg(last.alias("r"))
    stamp = _iso_day(F.col("r.o_orderdate"))
    return s.select(
        "id",
        F.col("r.question").alias("question"),
        F.col("r.resolved").cast("int").alias("resolved"),
        F.col("r.closed").cast("int").alias("closed"),
        stamp.alias("cached_at"),
        stamp.alias("updated_at"),
    )


def market_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming versions from the cut on; ``seq`` orders the batch."""
    v = _versions(spark, sf_dir).filter(F.col("o_orderdate") >= F.lit(VERSION_CUT).cast("timestamp_ntz"))
    return v.select("id", "seq", "question", "resolved", "closed")


def book_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level rows of many small books: (token_id, timestamp) is one book.

    A book snapshot covers BOOK_SNAPSHOT_ROWS consecutive events, so no book
    has more levels than that whatever the data size. Tokens divisible by 10
    quote bids only (their would-be asks are bids too), so some books have
    one side only; every event is a level.
    """
    e = table(spark, sf_dir, "events")
    token = F.pmod("user_id", F.lit(50))
    side = F.when(F.col("event_type").isin("view", "click") | (F.pmod("user_id", F.lit(10)) == 0),
                  F.lit("bid")).otherwise(F.lit("ask"))
    snap = F.floor(F.col("event_id") / BOOK_SNAPSHOT_ROWS)
    out = e.select(
        F.concat(F.lit("T"), token).alias("token_id"),
        (F.lit(BOOK_CLOCK_START_MS) + snap * 60000).cast("bigint").alias("timestamp"),
        side.alias("side"),
        ((F.pmod(F.col("event_id") * 7, F.lit(99)) + 1) / 100.0).alias("price"),
        (F.floor("value") + 1).cast("double").alias("size"),
        F.col("event_id").alias("level_seq"),
    )
    return out


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill jobs: one token per customer spanning its first to last order."""
    o = table(spark, sf_dir, "orders")
    j = o.groupBy("o_custkey").agg(F.min(epoch_ms("o_orderdate")).alias("start_ts"),
                                   F.max(epoch_ms("o_orderdate")).alias("end_ts"))
    return j.filter(F.col("start_ts") < F.col("end_ts")).select(
        F.concat(F.lit("T"), F.col("o_custkey")).alias("token_id"),
        F.concat(F.lit("M"), F.col("o_custkey")).alias("market_id"),
        "start_ts", "end_ts", F.col("start_ts").alias("created_at_ts"),
    )


def order_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a fetch of a job's chunk would return: one point per order."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("T"), F.col("o_custkey")).alias("token_id"),
                    epoch_ms("o_orderdate").alias("t"), F.col("o_totalprice").alias("p"))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request times per limiter (the event type). The log's clock counts a second of the
    events as a millisecond, so that a window holds many requests."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("request_id"), F.col("event_type").alias("limiter"),
                    F.floor(epoch_ms("ts") / 1000).cast("bigint").alias("t"))


# ---------------------------------------------------------------- landed payloads

def _json_num(c: Column) -> Column:
    return c.cast("string")


def _json_str(c: Column) -> Column:
    return F.concat(F.lit('"'), c.cast("string"), F.lit('"'))


def price_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed price-history responses, one per (token, page of events).

    Point encodings vary by event type so that decoding sees every case:
    view -> t as a JSON number of seconds; click -> t as text ms;
    signup -> t as text seconds (rejected); purchase -> p as text;
    error -> plain numbers. Every 97th event lacks its price (rejected).
    A page holds at most PAYLOAD_PAGE_ROWS points, so no payload grows with
    the data.
    """
    e = table(spark, sf_dir, "events")
    t = epoch_ms("ts")
    et = F.col("event_type")
    t_txt = (F.when(et == "view", _json_num(F.floor(t / 1000)))
             .when(et == "click", _json_str(t))
             .when(et == "signup", _json_str(F.floor(t / 1000)))
             .otherwise(_json_num(t)))
    p_txt = F.when(et == "purchase", _json_str(F.col("value"))).otherwise(_json_num(F.col("value")))
    point = F.when(F.pmod("event_id", F.lit(97)) == 0, F.concat(F.lit('{"t":'), t_txt, F.lit("}"))) \
        .otherwise(F.concat(F.lit('{"t":'), t_txt, F.lit(',"p":'), p_txt, F.lit("}")))
    page = F.floor(F.col("event_id") / PAYLOAD_PAGE_ROWS)
    rows = e.select(F.concat(F.lit("T"), F.col("user_id")).alias("token_id"), page.alias("page"),
                    F.col("event_id"), point.alias("point"))
    g = rows.groupBy("token_id", "page").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "point"))).alias("pts"))
    body = F.concat(F.lit('{"history":['), F.concat_ws(",", F.transform("pts", lambda s: s["point"])), F.lit("]}"))
    return g.select("token_id", F.col("page").cast("bigint").alias("chunk_start"), body.alias("payload"))


def _json_text(c: Column) -> Column:
    """A string as a JSON string literal (quotes and escapes), null kept null."""
    j = F.to_json(F.array(c))
    return F.when(c.isNotNull(), j.substr(F.lit(2), F.length(j) - 2))


def market_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed market-list pages (camelCase objects, API style).

    clobTokenIds is JSON text, except keys divisible by 7 where it is a real
    array; outcomes is JSON text, broken for keys divisible by 11; keys
    divisible by 13 lack an id (rejected).
    """
    m = markets(spark, sf_dir)
    k = F.substring(F.col("id"), 2, 20).cast("bigint")
    tok_json = F.to_json(F.col("token_ids"))
    tok = F.when(F.pmod(k, F.lit(7)) == 0, tok_json).otherwise(_json_text(tok_json))
    outc = F.when(F.pmod(k, F.lit(11)) == 0, F.lit('"[YES, NO"')).otherwise(_json_text(F.to_json(F.col("outcomes"))))

    def field(name: str, val: Column) -> Column:
        return F.when(val.isNull(), F.lit(None)).otherwise(F.concat(F.lit(f'"{name}":'), val))

    def s(c: str) -> Column:
        return _json_text(F.col(c))

    def b(c: str) -> Column:
        return F.col(c).cast("string")

    parts = F.concat_ws(",", *[
        F.when(F.pmod(k, F.lit(13)) == 0, F.lit(None)).otherwise(F.concat(F.lit('"id":'), s("id"))),
        field("question", s("question")), field("description", s("description")),
        field("marketSlug", s("market_slug")), field("conditionId", s("condition_id")),
        F.concat(F.lit('"clobTokenIds":'), tok), F.concat(F.lit('"outcomes":'), outc),
        field("active", b("active")), field("closed", b("closed")), field("archived", b("archived")),
        field("createdAt", s("created_at")), field("endDate", s("end_date")),
        field("resolved", b("resolved")), field("resolutionDate", s("resolution_date")),
        field("resolutionOutcome", s("resolution_outcome")),
        F.concat(F.lit('"tags":'), F.to_json("tags")), field("category", s("category")),
        F.lit('"volume":"123.4"'),
    ])
    obj = F.concat(F.lit("{"), parts, F.lit("}"))
    page = F.floor(k / MARKET_PAGE_KEYS).cast("bigint")
    g = m.select(page.alias("page"), k.alias("k"), obj.alias("obj")).groupBy("page").agg(
        F.array_sort(F.collect_list(F.struct("k", "obj"))).alias("objs"))
    return g.select("page", F.concat(F.lit("["), F.concat_ws(",", F.transform("objs", lambda x: x["obj"])),
                                     F.lit("]")).alias("payload"))


def book_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed order-book responses, one per book of ``book_levels``.

    Prices and sizes are JSON text as the API sends them; the timestamp is
    text ms, except for books of token T7, whose timestamp is broken
    (decodes to 0).
    """
    lv = book_levels(spark, sf_dir)
    level = F.concat(F.lit('{"price":"'), F.col("price").cast("string"), F.lit('","size":"'),
                     F.col("size").cast("string"), F.lit('"}'))
    g = lv.groupBy("token_id", "timestamp").agg(
        F.array_sort(F.collect_list(F.when(F.col("side") == "bid", F.struct("level_seq", level.alias("x"))))).alias("b"),
        F.array_sort(F.collect_list(F.when(F.col("side") == "ask", F.struct("level_seq", level.alias("x"))))).alias("a"),
    )
    ts = F.when(F.col("token_id") == "T7", F.lit('"soon"')).otherwise(
        F.concat(F.lit('"'), F.col("timestamp").cast("string"), F.lit('"')))
    body = F.concat(
        F.lit('{"market":"x","bids":['), F.concat_ws(",", F.transform("b", lambda s: s["x"])),
        F.lit('],"asks":['), F.concat_ws(",", F.transform("a", lambda s: s["x"])),
        F.lit('],"timestamp":'), ts, F.lit("}"))
    return g.select("token_id", F.col("timestamp").alias("book_ts"), body.alias("payload"))


def trade_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed trade pages: (batch, page, payload), TRADE_PAGE_ORDERS order keys each.

    Even pages are bare arrays, odd pages are wrapped as {"data": [...]};
    each page also carries one non-object item that decoding must skip.
    Line items are paged by order key and ordered within a page by
    TRADE_ORDER (rows equal on all of it have identical items).
    """
    li = table(spark, sf_dir, "lineitem")

    def item(r: Column) -> Column:
        return F.concat(
            F.lit('{"id":"'), r["l_orderkey"].cast("string"), F.lit("-"), r["l_linenumber"].cast("string"),
            F.lit('","conditionId":"S'), F.pmod(r["l_suppkey"], F.lit(5)).cast("string"),
            F.lit('","size":'), r["l_quantity"].cast("string"),
            F.lit(',"price":'), F.coalesce(F.nullif(r["l_tax"], F.lit(0.0)).cast("string"), F.lit("null")),
            F.lit(',"timestamp":'), epoch_ms(r["l_shipdate"]).cast("string"),
            # Fields without a column of their own.
            F.lit(',"transactionHash":"0x'), r["l_orderkey"].cast("string"),
            F.lit('","fee":{"bps":'), r["l_linenumber"].cast("string"), F.lit("}}"))

    page = F.floor(F.col("l_orderkey") / TRADE_PAGE_ORDERS).cast("bigint")
    # The text of an item is written after the exchange, which moves its narrow columns.
    g = li.groupBy(page.alias("page")).agg(F.collect_list(F.struct(*TRADE_ORDER)).alias("rows"))
    items = F.sort_array(F.transform("rows", lambda r: F.struct(*[r[c] for c in TRADE_ORDER], item(r).alias("item"))))
    g = g.select("page", items.alias("items"))
    arr = F.concat(F.lit("["), F.concat_ws(",", F.col("items")["item"]), F.lit(',"junk"]'))
    payload = F.when(F.pmod("page", F.lit(2)) == 0, arr).otherwise(F.concat(F.lit('{"data":'), arr, F.lit("}")))
    return g.select(F.floor(F.col("page") / TRADE_BATCH_PAGES).cast("bigint").alias("batch"), "page",
                    payload.alias("payload"))
