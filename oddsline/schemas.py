"""One StructType per table. Time columns are epoch milliseconds (bigint),
not timestamps; ISO dates on markets stay strings, as in the source data."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B, I = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.IntegerType()
STR_ARRAY = T.ArrayType(S)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


MARKETS = _struct(
    ("id", S), ("question", S), ("description", S), ("market_slug", S), ("condition_id", S),
    ("token_ids", STR_ARRAY), ("outcomes", STR_ARRAY), ("active", B), ("closed", B),
    ("archived", B), ("created_at", S), ("end_date", S), ("resolved", B),
    ("resolution_date", S), ("resolution_outcome", S), ("tags", STR_ARRAY), ("category", S),
)

PRICES = _struct(("token_id", S), ("t", L), ("p", D))
PRICES_V2 = _struct(("token_id", S), ("timestamp", L), ("price", D))

# Declared for the empty case only; processing needs the four of TRADES_REQUIRED.
TRADES = _struct(("id", S), ("market", S), ("asset_id", S), ("side", S), ("size", D),
                 ("price", D), ("timestamp", L))
TRADES_REQUIRED = ("timestamp", "size", "price", "conditionId")

BOOK_LEVELS = _struct(("token_id", S), ("timestamp", L), ("side", S), ("price", D), ("size", D))
SPREADS = _struct(("token_id", S), ("bid", D), ("ask", D), ("mid", D), ("spread", D), ("timestamp", L))

LEDGER = _struct(("token_id", S), ("start_ts", L), ("end_ts", L), ("fidelity", I),
                 ("completed_at", S), ("row_count", L))
LEDGER_KEY = ("token_id", "start_ts", "end_ts", "fidelity")

MANIFEST = _struct(("dataset", S), ("parquet_path", S), ("created_at", S), ("rows", L),
                   ("cols", L), ("schema_json", S))

# Landing tables of raw API payloads (decoded by operators.decode).
PRICE_PAYLOADS = _struct(("token_id", S), ("chunk_start", L), ("payload", S))
MARKET_PAGES = _struct(("page", L), ("payload", S))
BOOK_PAYLOADS = _struct(("token_id", S), ("payload", S))
TRADE_PAGES = _struct(("batch", L), ("page", L), ("payload", S))

# Columns each kind of file must have (used to classify and validate files).
REQUIRED_COLUMNS = {
    "markets": ("id", "token_ids"),
    "prices": ("token_id", "t", "p"),
    "prices_v2": ("token_id", "timestamp", "price"),
    "trades": TRADES_REQUIRED,
}

MS_PER_SECOND = 1000
MS_PER_DAY = 86_400_000
