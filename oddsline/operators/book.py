"""Order-book analytics.

Two input shapes are supported:
* decoded books -- one row per (token_id, timestamp) with ``bids`` and
  ``asks`` arrays of (price, size); everything is per-row array work, no
  shuffle at all;
* level tables -- one row per level (token_id, timestamp, side, price,
  size). A book is (token_id, timestamp); quotes are partial aggregates and
  depth is a window on the book key followed by an aggregate on the same key,
  so the levels are exchanged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BOOK_KEY = ("token_id", "timestamp")


def book_key(df: DataFrame) -> tuple[str, ...]:
    """What tells books apart: also their ``book_id`` where the table has one
    (several books of a token may share a timestamp, 0 for instance)."""
    return (*BOOK_KEY, "book_id") if "book_id" in df.columns else BOOK_KEY

LEVEL = "struct<price:double,size:double>"


# ------------------------------------------------------------ array books

def ladder_sort(levels: Column, descending: bool) -> Column:
    """Stable sort of an array of (price, size) by price (bids descending)."""
    keyed = F.transform(levels, lambda x, i: F.struct(
        (-x["price"] if descending else x["price"]).alias("k"), i.alias("i"),
        x["price"].alias("price"), x["size"].alias("size")))
    return F.transform(F.sort_array(keyed), lambda x: F.struct(x["price"].alias("price"), x["size"].alias("size")))


def flatten_books(books: DataFrame) -> DataFrame:
    """One row per level with its side (bids first, then asks)."""
    tagged = F.concat(
        F.transform(F.coalesce("bids", F.array().cast(f"array<{LEVEL}>")),
                    lambda x: F.struct(F.lit("bid").alias("side"), x["price"].alias("price"), x["size"].alias("size"))),
        F.transform(F.coalesce("asks", F.array().cast(f"array<{LEVEL}>")),
                    lambda x: F.struct(F.lit("ask").alias("side"), x["price"].alias("price"), x["size"].alias("size"))),
    )
    key = book_key(books)
    return (books.select(*key, F.explode(tagged).alias("lv"))
            .select(*key, "lv.side", "lv.price", "lv.size"))


def book_quotes_from_arrays(books: DataFrame) -> DataFrame:
    """E3-E5 on decoded books: best quotes are the first ladder entries."""
    bid = F.get(F.col("bids"), 0)["price"]
    ask = F.get(F.col("asks"), 0)["price"]
    return books.select("token_id", bid.alias("bid"), ask.alias("ask"), *_mid_spread(bid, ask), "timestamp")


def depth_from_arrays(books: DataFrame, distance: float) -> DataFrame:
    """E6 on decoded books, per row: size within ``distance`` of mid."""
    bid = F.get(F.col("bids"), 0)["price"]
    ask = F.get(F.col("asks"), 0)["price"]
    mid = (bid + ask) / 2
    d = F.lit(distance)

    def total(arr: str, keep) -> Column:
        return F.aggregate(F.coalesce(arr, F.array().cast(f"array<{LEVEL}>")), F.lit(0.0),
                           lambda acc, x: acc + F.when(keep(x["price"]), x["size"]).otherwise(F.lit(0.0)))

    db = F.when(mid.isNull(), F.lit(0.0)).otherwise(total("bids", lambda p: p >= mid - d))
    da = F.when(mid.isNull(), F.lit(0.0)).otherwise(total("asks", lambda p: p <= mid + d))
    return books.select(*BOOK_KEY, db.alias("depth_bid"), da.alias("depth_ask"), (db + da).alias("depth_both"))


# ------------------------------------------------------------ level tables

def _mid_spread(bid: Column, ask: Column) -> list[Column]:
    return [((bid + ask) / 2).alias("mid"), (ask - bid).alias("spread")]


def book_ladder(levels: DataFrame, tie_break: str | None = "level_seq") -> DataFrame:
    """1-based ladder position per book side: bids by price descending,
    asks ascending, ties kept in input order (``tie_break``)."""
    order_price = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    order = [order_price] + ([F.col(tie_break)] if tie_break and tie_break in levels.columns else [])
    w = Window.partitionBy(*book_key(levels), "side").orderBy(*order)
    return levels.withColumn("level", F.row_number().over(w))


def best_quotes(levels: DataFrame) -> DataFrame:
    """Best bid (highest) and best ask (lowest) per book; null when a side is empty."""
    return levels.groupBy(*book_key(levels)).agg(
        F.max(F.when(F.col("side") == "bid", F.col("price"))).alias("bid"),
        F.min(F.when(F.col("side") == "ask", F.col("price"))).alias("ask"))


def mid_spread(quotes: DataFrame) -> DataFrame:
    """Mid and spread, null unless both sides exist."""
    return quotes.select("*", *_mid_spread(F.col("bid"), F.col("ask")))


def spread_snapshot(levels: DataFrame) -> DataFrame:
    """E5: one spread row per book (token_id, bid, ask, mid, spread, timestamp)."""
    q = mid_spread(best_quotes(levels))
    return q.select("token_id", "bid", "ask", "mid", "spread", "timestamp")


def depth_at_distance(levels: DataFrame, distance: float) -> DataFrame:
    """Size within ``distance`` of the mid, per side and both; no mid -> 0.0.

    Bids count when price >= mid - distance, asks when price <= mid +
    distance (inclusive). The mid comes from a window on the book key and
    the sums from an aggregate on the same key: one exchange of the levels.
    """
    key = book_key(levels)
    w = Window.partitionBy(*key)
    bid = F.max(F.when(F.col("side") == "bid", F.col("price"))).over(w)
    ask = F.min(F.when(F.col("side") == "ask", F.col("price"))).over(w)
    d = F.lit(distance)
    lv = levels.select(*key, "side", "price", "size", ((bid + ask) / 2).alias("_mid"))
    in_bid = (F.col("side") == "bid") & (F.col("price") >= F.col("_mid") - d)
    in_ask = (F.col("side") == "ask") & (F.col("price") <= F.col("_mid") + d)
    agg = lv.groupBy(*key).agg(
        F.coalesce(F.sum(F.when(in_bid, F.col("size"))), F.lit(0.0)).alias("depth_bid"),
        F.coalesce(F.sum(F.when(in_ask, F.col("size"))), F.lit(0.0)).alias("depth_ask"))
    return agg.withColumn("depth_both", F.col("depth_bid") + F.col("depth_ask"))
