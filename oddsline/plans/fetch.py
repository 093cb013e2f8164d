"""The fetch stage over landed payloads: decode -> select -> plan -> write.

Network fetching is not rebuilt; its inputs are landing tables of raw API
responses (see ``schemas``: market pages, price-history payloads keyed by
token and chunk start, book payloads, trade pages). The stage turns them
into the run directory that the process stage reads:

  raw/<run>/markets.parquet     selected markets (+ provenance)
  raw/<run>/prices.parquet      price points of the pending chunks
  raw/<run>/orderbooks.parquet  book levels
  raw/<run>/spreads.parquet     one spread row per book
  raw/<run>/trades.parquet      trades within the row budget (if any) and since-bound
  raw/<run>/rejects.parquet     payloads that could not be decoded, with the reason

and advances the versioned market store and window ledger. Every step is
one of the operators; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddsline.operators import book as E
from oddsline.operators import decode as B
from oddsline.operators import lifecycle as C
from oddsline.operators import planning as D
from oddsline.plans.stores import VersionedTable, merge_ledger, merge_markets
from oddsline.schemas import LEDGER, MARKETS
from oddsline.sources.files import stage_counts, with_provenance

# The store keeps whole market rows (flags as 0/1) plus the two stamps.
FULL_MARKET_STORE = T.StructType(
    [T.StructField(f.name, T.IntegerType() if f.name in ("resolved", "closed") else f.dataType, True)
     for f in MARKETS.fields]
    + [T.StructField("cached_at", T.StringType()), T.StructField("updated_at", T.StringType())])


@dataclass
class FetchInputs:
    market_pages: DataFrame                      # active feed: (page, payload)
    window_pages: DataFrame | None = None        # markets ending in the window: (page, payload)
    price_payloads: DataFrame | None = None      # (token_id, chunk_start, payload)
    book_payloads: DataFrame | None = None       # (token_id, payload)
    trade_pages: DataFrame | None = None         # (batch, page, payload)


@dataclass
class FetchResult:
    paths: dict[str, str] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    rejects: int = 0


def _ordered(decoded: DataFrame) -> DataFrame:
    """Feed order of decoded markets: (page, position) as one sortable number
    (positions are ints, pages may go up to 2**30)."""
    return decoded.withColumn("pos", F.col("page") * F.lit(1 << 31) + F.col("pos")).drop("page")


def _store_markets(store: VersionedTable | None, spark: SparkSession) -> DataFrame:
    if store is None:
        return spark.createDataFrame([], FULL_MARKET_STORE)
    return store.current()


def fetch_stage(spark: SparkSession, inputs: FetchInputs, run_dir: str, *, start_ms: int | None,
                end_ms: int | None, fetch_ts: str, now_iso: str, fidelity: int = 60,
                store: VersionedTable | None = None, ledger: VersionedTable | None = None,
                version: int | None = None, max_trades: int | None = D.MAX_TRADES_DEFAULT,
                since_ms: int | None = None, resolved_only: bool = False) -> FetchResult:
    res = FetchResult()
    out = run_dir.rstrip("/")

    # -- markets: decode the feeds, select (C1-C6), merge into the store
    rejects = []

    def decoded(feed: str, pair: tuple[DataFrame, DataFrame]) -> DataFrame:
        rejects.append(pair[1].select(F.lit(feed).alias("feed"), "reason", F.to_json(F.struct("*")).alias("row")))
        return pair[0]

    active = _ordered(decoded("market_pages", B.decode_markets(inputs.market_pages)))
    window = (_ordered(decoded("window_pages", B.decode_markets(inputs.window_pages)))
              if inputs.window_pages is not None else active.limit(0))
    stored = _store_markets(store, spark)
    # Stored rows back in market shape (boolean flags) for the selection.
    stored_markets = (stored.drop("cached_at", "updated_at")
                      .withColumn("resolved", F.col("resolved") == 1).withColumn("closed", F.col("closed") == 1)
                      .withColumn("pos", F.lit(0).cast("bigint")))
    selected = C.select_markets(active, window, stored_markets, start_ms, end_ms).drop("source")
    if resolved_only:
        selected = C.resolved_markets_only(selected)
    if store is not None:
        # The API feeds in the order they are applied: active first, then the
        # window feed without the markets already stored as resolved.
        api = C.active_markets(active, end_ms).withColumn("seq", F.col("pos") + 1)
        if start_ms is not None and end_ms is not None:
            win = C.exclude_known_resolved(C.closed_in_window(window, start_ms, end_ms), stored)
            api = api.unionByName(win.withColumn("seq", F.col("pos") + F.lit(1 << 61) + 1))
        merge_markets(store, api.drop("pos"), now_iso, version)
    markets = with_provenance(selected.select(*[f.name for f in MARKETS.fields]), "markets-api", "/markets",
                              fetch_ts)
    res.paths["markets"] = _write(markets, f"{out}/markets.parquet")

    # -- prices: jobs -> chunks -> pending -> landed points of kept chunks
    if inputs.price_payloads is not None and start_ms is not None and end_ms is not None:
        jobs = decoded("token_jobs", D.token_jobs(markets, start_ms, end_ms))
        chunks = D.chunk_windows(jobs)
        led = ledger.current() if ledger is not None else spark.createDataFrame([], LEDGER)
        points = decoded("price_payloads", B.decode_price_history(inputs.price_payloads))
        pts_in_chunks = points.select("token_id", F.col("chunk_start"), "t")
        counted = D.pending_with_counts(chunks, led, fidelity,
                                        pts_in_chunks.join(chunks.select("token_id", "chunk_start", "chunk_end"),
                                                           ["token_id", "chunk_start"], "inner")
                                        .select("token_id", "chunk_start", "chunk_end"))
        # What has landed is taken whole; the early stop only saves requests (backfill_plan).
        kept = counted
        fetched = points.join(kept.select("token_id", "chunk_start"), ["token_id", "chunk_start"], "left_semi")
        prices = D.dedupe_price_points(fetched).select("token_id", "t", "p")
        res.paths["prices"] = _write(with_provenance(prices, "prices-api", "/prices-history", fetch_ts),
                                     f"{out}/prices.parquet")
        if ledger is not None:
            # A window is complete only if a payload of it arrived and decoded.
            arrived = B.received_chunks(inputs.price_payloads)
            marks = kept.join(arrived, ["token_id", "chunk_start"], "left_semi").select("token_id", F.col("chunk_start").alias("start_ts"), F.col("chunk_end").alias("end_ts"),
                                F.lit(fidelity).alias("fidelity"), F.lit(now_iso).alias("completed_at"),
                                F.col("row_count").cast("bigint"))
            merge_ledger(ledger, marks, version)

    # -- order books: levels and spreads
    if inputs.book_payloads is not None:
        books = decoded("book_payloads", B.decode_orderbook(inputs.book_payloads))
        res.paths["orderbooks"] = _write(with_provenance(E.flatten_books(books), "books-api", "/book", fetch_ts),
                                         f"{out}/orderbooks.parquet")
        res.paths["spreads"] = _write(with_provenance(E.book_quotes_from_arrays(books), "books-api", "/book", fetch_ts),
                                      f"{out}/spreads.parquet")

    # -- trades: decode, budget, since-bound
    if inputs.trade_pages is not None:
        trades = D.trades_since(D.budgeted_trades(inputs.trade_pages, max_trades), since_ms)
        res.paths["trades"] = _write(with_provenance(trades.drop("batch", "page", "pos"), "trades-api",
                                                     "/trades", fetch_ts), f"{out}/trades.parquet")

    # -- payloads that were refused, with the reason
    refused = rejects[0]
    for r in rejects[1:]:
        refused = refused.unionByName(r)
    res.paths["rejects"] = _write(refused, f"{out}/rejects.parquet")
    res.rejects = spark.read.parquet(res.paths["rejects"]).count()

    # -- counters, from the written tables
    def read(name):
        return spark.read.parquet(res.paths[name]) if name in res.paths else None

    counts = stage_counts(markets=read("markets"), prices=read("prices"), levels=read("orderbooks"),
                          spreads=read("spreads"), trades=read("trades")).first()
    res.counts = counts.asDict()
    return res


def _write(df: DataFrame, path: str) -> str:
    df.write.mode("errorifexists").parquet(path)
    return path
