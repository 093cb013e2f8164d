"""Derived tables: token map, joined prices, daily returns, price panel,
trade aggregates (F1-F10).

Scale notes
* The token map has one row per (market, token). How it is joined to prices
  is left to the planner and AQE.
* Daily means are a partial aggregate on (token_id, day_ts): a hot token is
  combined map-side before the exchange. The returns window then runs on
  daily rows, whose count per token is bounded by the number of days.
* The panel's columns are token numbers, not names: tokens are numbered on the
  cluster and cut into blocks of PANEL_BLOCK columns, one aggregate makes the
  rows of all blocks, and a table beside the panel tells which token a (block,
  column) is. The plan does not grow with the tokens; a block becomes a table
  with names as columns when it is asked for, and only its names reach the
  driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oddsline.functions.arrays import outcome_name
from oddsline.functions.mathcols import ieee_divide
from oddsline.functions.timecols import day_bucket

MAP_COLUMNS = ("question", "condition_id", "resolved", "resolution_outcome", "category", "created_at")
MAP_TYPES = {"question": "string", "condition_id": "string", "resolved": "boolean",
             "resolution_outcome": "string", "category": "string", "created_at": "string",
             "outcomes": "array<string>"}



# --------------------------------------------------------------------- F1

def detect_column(df: DataFrame, primary: str, alternate: str) -> str:
    """``primary`` when present, else ``alternate`` (which may be absent too)."""
    return primary if primary in df.columns else alternate


def normalize_prices(prices: DataFrame) -> DataFrame:
    """Resolve the (t, p) / (timestamp, price) alias and project the three columns."""
    t = detect_column(prices, "t", "timestamp")
    p = detect_column(prices, "p", "price")
    missing = {"token_id", t, p} - set(prices.columns)
    if missing:
        raise ValueError(f"price data missing columns {sorted(missing)}; found {prices.columns}")
    return prices.select("token_id", F.col(t).alias("t"), F.col(p).alias("p"))


def returns_columns(prices: DataFrame) -> tuple[str, str] | None:
    """For returns both names come from the same variant, or the input is rejected."""
    cols = set(prices.columns)
    if {"t", "p", "token_id"} <= cols:
        return "t", "p"
    if {"timestamp", "price", "token_id"} <= cols:
        return "timestamp", "price"
    return None


# --------------------------------------------------------------------- F2

def token_market_map(markets: DataFrame) -> DataFrame:
    """One row per (market row, token) with the outcome name of that token.

    Null or empty token lists keep one row with a null token (the join in
    ``prices_joined`` drops it); absent optional columns become typed nulls.
    """
    m = markets
    for c, typ in MAP_TYPES.items():
        if c not in m.columns:
            m = m.withColumn(c, F.lit(None).cast(typ))
    exploded = m.select(
        F.col("id").alias("market_id"), *MAP_COLUMNS, "outcomes", "token_ids",
        F.posexplode_outer("token_ids").alias("_pos", "token_id"),
    )
    return exploded.select(
        "token_id", "market_id", *MAP_COLUMNS,
        F.when(F.col("_pos").isNull(), F.get(F.col("outcomes"), F.size("outcomes") - 1))
        .otherwise(outcome_name("token_ids", "outcomes", F.col("_pos"))).alias("outcome_name"),
    )


# --------------------------------------------------------------------- F3

def prices_joined(prices: DataFrame, markets: DataFrame) -> DataFrame:
    """Inner equi-join of price points with the token map on token_id."""
    p = normalize_prices(prices)
    tm = token_market_map(markets).filter(F.col("token_id").isNotNull())
    return p.join(tm, "token_id", "inner").select(
        "token_id", "t", "p", "market_id", *MAP_COLUMNS, "outcome_name")


# --------------------------------------------------------------------- F4, F5

def with_day(df: DataFrame, t: str = "t", out: str = "day_ts") -> DataFrame:
    return df.withColumn(out, day_bucket(F.col(t)))


def daily_mean_price(prices: DataFrame, value_name: str = "price_day") -> DataFrame:
    """Mean price per (token, UTC day); nulls are ignored by the mean."""
    cols = returns_columns(prices)
    if cols is None:
        raise ValueError(f"price data needs token_id,t,p or token_id,timestamp,price; found {prices.columns}")
    t, p = cols
    return (prices.select("token_id", day_bucket(F.col(t).cast("bigint")).alias("day_ts"), F.col(p).alias("_p"))
            .groupBy("token_id", "day_ts").agg(F.avg("_p").alias(value_name)))


# --------------------------------------------------------------------- F6, F7

def token_day_window():
    return Window.partitionBy("token_id").orderBy("day_ts")


def daily_returns(prices: DataFrame, markets: DataFrame | None = None) -> DataFrame:
    """Daily mean and its percent change per token in day order.

    The change is taken against the most recent non-null daily mean (a null
    day gives 0.0 after a value); the first day of a token is null; missing
    days are not filled. Division by a zero mean gives +/-inf or NaN. With a
    markets table the token map is left-joined on.
    """
    daily = daily_mean_price(prices)
    return returns_from_daily(daily, markets)


def returns_from_daily(daily: DataFrame, markets: DataFrame | None = None) -> DataFrame:
    w = token_day_window()
    filled = F.last("price_day", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    prev = F.lag("_filled", 1).over(w)
    out = (daily.withColumn("_filled", filled)
           .withColumn("ret", ieee_divide(F.col("_filled"), prev) - F.lit(1.0))
           .drop("_filled"))
    if markets is None:
        return out
    tm = token_market_map(markets)
    return out.join(tm, "token_id", "left")


# --------------------------------------------------------------------- F8, F9

PANEL_BLOCK = 5000  # token columns of one block


@dataclass
class Panel:
    """Daily means as blocks of columns.

    ``rows``: block, day_ts and the day's prices in that block as two arrays,
    ``cols`` (ascending) and ``prices``; a day without a price in a block has no
    row there. ``columns``: token_id, block, col of every token, in token order.
    """
    rows: DataFrame
    columns: DataFrame
    block: int

    def cells(self) -> DataFrame:
        """The long form: token_id, day_ts, price."""
        cell = F.explode(F.arrays_zip("cols", "prices")).alias("x")
        long = self.rows.select("block", "day_ts", cell).select(
            "block", "day_ts", F.col("x.cols").alias("col"), F.col("x.prices").alias("price"))
        return long.join(self.columns, ["block", "col"]).select("token_id", "day_ts", "price")

    def names(self, block: int) -> list:
        """The token names of one block, at most ``self.block`` of them."""
        return [r[0] for r in self.columns.where(F.col("block") == block).orderBy("col").select("token_id").collect()]

    def wide(self, block: int = 0) -> DataFrame:
        """One block as a table: a row per day, a column per token, named by it."""
        part = Panel(self.rows.where(F.col("block") == block), self.columns.where(F.col("block") == block), self.block)
        return pivot_daily(part.cells(), self.names(block))


def number_tokens(daily: DataFrame, block: int = PANEL_BLOCK) -> DataFrame:
    """(token_id, block, col): the panel's tokens in name order, null first,
    numbered over a range-sorted table (one total per partition on the driver)."""
    from oddsline.operators.planning import prefix_offsets

    numbered = prefix_offsets(daily.select("token_id").distinct(), ["token_id"], out_col="_no")
    return numbered.select("token_id", F.floor(F.col("_no") / block).cast("int").alias("block"),
                           (F.col("_no") % block).cast("int").alias("col"))


def build_panel(daily: DataFrame, block: int = PANEL_BLOCK) -> Panel:
    """The panel of a table of daily means; ``daily`` is read twice (for its
    tokens and for its cells), so give one that is cheap to read again. Null
    means are no cells, but their tokens are columns."""
    value = "price" if "price" in daily.columns else "price_day"
    columns = number_tokens(daily, block)
    names = columns.withColumnRenamed("token_id", "_token")
    cells = daily.where(F.col(value).isNotNull()).join(names, F.col("token_id").eqNullSafe(F.col("_token")))
    row = F.sort_array(F.collect_list(F.struct("col", F.col(value).alias("price"))))
    rows = cells.groupBy("block", "day_ts").agg(row.alias("_row"))
    return Panel(rows.select("block", "day_ts", F.col("_row.col").alias("cols"), F.col("_row.price").alias("prices")),
                 columns, block)


def price_panel(prices: DataFrame, tokens: list | None = None) -> DataFrame:
    """Wide table: one row per day, one column per token of daily means. Without
    a token list the prices may have at most PANEL_BLOCK tokens."""
    daily = daily_mean_price(prices, value_name="price")
    if tokens is not None:
        return pivot_daily(daily, tokens)
    found = [r[0] for r in daily.select("token_id").distinct().limit(PANEL_BLOCK + 1).collect()]
    if len(found) > PANEL_BLOCK:
        raise ValueError(f"more than {PANEL_BLOCK} tokens do not fit one table; use build_panel")
    return pivot_daily(daily, sorted(found, key=lambda t: (t is not None, t)))


def pivot_daily(daily: DataFrame, tokens: list) -> DataFrame:
    value = "price" if "price" in daily.columns else "price_day"
    return daily.groupBy("day_ts").pivot("token_id", tokens).agg(F.first(value))


def panel_blocks(daily: DataFrame, block: int = PANEL_BLOCK) -> list[DataFrame]:
    """The blocks of the panel as tables with token names as columns, in token
    order: for callers that want every block wide. It plans one pivot a block."""
    panel = build_panel(daily, block)
    last = panel.columns.agg(F.max("block")).first()[0]
    return [panel.wide(k) for k in range(0 if last is None else last + 1)]


def panel_dims(daily: DataFrame) -> DataFrame:
    """(panel_days, panel_tokens) of the panel, without building it."""
    return daily.agg(F.count_distinct("day_ts").alias("panel_days"),
                     F.count_distinct("token_id").alias("panel_tokens"))


# --------------------------------------------------------------------- F10

def trades_daily_agg(trades: DataFrame) -> DataFrame:
    """Per (conditionId, UTC day): trade rows, sum of size, sum of size*price.

    Sums over only nulls are 0.0 (``coalesce``); the row count counts rows
    with null size or price too. Partial aggregation combines hot
    conditions map-side.
    """
    missing = {"timestamp", "size", "price", "conditionId"} - set(trades.columns)
    if missing:
        raise ValueError(f"trade data missing columns {sorted(missing)}; found {trades.columns}")
    return (trades.select("conditionId", day_bucket(F.col("timestamp").cast("bigint")).alias("day_ts"),
                          F.col("size"), (F.col("size") * F.col("price")).alias("_notional"))
            .groupBy("conditionId", "day_ts")
            .agg(F.count(F.lit(1)).alias("trades"),
                 F.coalesce(F.sum("size"), F.lit(0.0)).alias("size_sum"),
                 F.coalesce(F.sum("_notional"), F.lit(0.0)).alias("notional_sum")))
