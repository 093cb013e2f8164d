"""Decoding landed API payloads into typed tables.

Input is a landing table of raw responses (text). Each payload is parsed
once with ``try_parse_json`` into a VARIANT, exploded with its position,
and every field is read with ``try_variant_get``; ``schema_of_variant``
tells JSON numbers from JSON text where the two are treated differently.
All work is per row and bounded by one payload; there is no shuffle.

Each decoder returns ``(good, rejects)``: rejects keep the raw input and a
reason instead of being logged and lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddsline.functions.timecols import MAX_VALID_TIMESTAMP_MS, MIN_VALID_TIMESTAMP_MS, SECONDS_LIMIT

NUMERIC_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def _vtype(v: Column) -> Column:
    """Upper-case type name of a variant value (NULL for SQL null)."""
    return F.when(v.isNull(), F.lit(None)).otherwise(F.upper(F.schema_of_variant(v)))


def _kind_is_number(k: Column) -> Column:
    return k.isin(*NUMERIC_TYPES) | k.startswith("DECIMAL")


def _is_number(v: Column) -> Column:
    return _kind_is_number(_vtype(v))


def _kind_is(k: Column, name: str) -> Column:
    """Type test on a type name; OBJECT and ARRAY match by prefix (the schema
    text lists the inner fields)."""
    if name in ("OBJECT", "ARRAY"):
        return k.startswith(name)
    return k == name


def _is_type(v: Column, name: str) -> Column:
    return _kind_is(_vtype(v), name)


def with_kinds(df: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Add, for each ``name -> (variant column, path)``, the field's variant
    ``name`` and its type ``name_k`` as columns of their own.

    Conditional expressions are not shared by common-subexpression
    elimination, so the field lookup and its type are computed once here and
    read by every branch afterwards.
    """
    out = df.select("*", *[_field(F.col(src), path).alias(n) for n, (src, path) in fields.items()])
    return out.select("*", *[_vtype(F.col(n)).alias(f"{n}_k") for n in fields])


def _field(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _present(v: Column) -> Column:
    """The field exists and is not JSON null."""
    return v.isNotNull() & ~F.coalesce(F.is_variant_null(v), F.lit(False))


def _items(payload: Column, path: str = "$") -> Column:
    return F.try_variant_get(F.try_parse_json(payload), path, "array<variant>")


# ----------------------------------------------------------- B5 timestamps

def text_timestamp_ms(s: Column) -> Column:
    """Text timestamp: must be an integer; 0, or ms within [2020, 2040]; else null."""
    n = F.trim(s).try_cast("bigint")
    return F.when(n == 0, F.lit(0).cast("bigint")).when(
        n.between(MIN_VALID_TIMESTAMP_MS, MAX_VALID_TIMESTAMP_MS), n)


def point_timestamp_ms(v: Column, kind: Column | None = None) -> Column:
    """Price-point time: a JSON number below 1e10 is seconds (x1000, truncated),
    otherwise ms with no range check; JSON text follows ``text_timestamp_ms``;
    anything else (null, object, array) is invalid (null). ``kind`` is the
    precomputed type name of ``v`` when available."""
    k = _vtype(v) if kind is None else kind
    x = F.try_variant_get(v, "$", "double")
    num = F.when(x < SECONDS_LIMIT, (x * 1000).try_cast("bigint")).otherwise(x.try_cast("bigint"))
    b = F.try_variant_get(v, "$", "boolean").cast("bigint") * 1000
    return (F.when(_kind_is_number(k), num)
            .when(_kind_is(k, "BOOLEAN"), b)
            .when(_kind_is(k, "STRING"), text_timestamp_ms(F.try_variant_get(v, "$", "string"))))


def strict_timestamp_ms(v: Column) -> Column:
    """Book timestamp rule: a JSON integer or integer text, 0 or within range;
    anything else (a JSON number with a fraction or exponent included) -> 0."""
    s = F.try_variant_get(v, "$", "string")
    i = F.try_variant_get(v, "$", "bigint")
    int_ok = _vtype(v).isin("BIGINT", "INT", "SMALLINT", "TINYINT")
    from_int = F.when(int_ok & ((i == 0) | i.between(MIN_VALID_TIMESTAMP_MS, MAX_VALID_TIMESTAMP_MS)), i)
    got = F.when(_is_type(v, "STRING"), text_timestamp_ms(s)).otherwise(from_int)
    return F.coalesce(got, F.lit(0).cast("bigint"))


def _float_value(v: Column, kind: Column | None = None) -> Column:
    """float(x) for a JSON number, boolean or numeric text; null otherwise."""
    k = _vtype(v) if kind is None else kind
    return (F.when(_kind_is_number(k), F.try_variant_get(v, "$", "double"))
            .when(_kind_is(k, "BOOLEAN"), F.try_variant_get(v, "$", "boolean").cast("double"))
            .when(_kind_is(k, "STRING"), F.trim(F.try_variant_get(v, "$", "string")).try_cast("double")))


# ----------------------------------------------------------- B4 prices

def decode_price_history(landing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(token_id, chunk_start, payload) -> points (token_id, t, p, chunk_start, pos).

    Bad points are dropped; a payload without a ``history`` key is rejected
    whole; an empty or non-list history gives no rows.
    """
    v = F.try_parse_json("payload")
    base = landing.select("token_id", "chunk_start", "payload", v.alias("_v"))
    # A path lookup is null unless the root is an object holding the key.
    hist_ok = F.coalesce(_field(F.col("_v"), "$.history").isNotNull(), F.lit(False))
    rejects = base.filter(~hist_ok).select(
        "token_id", "chunk_start", "payload", F.lit("missing history").alias("reason"))
    pts = (base.filter(hist_ok)
           .select("token_id", "chunk_start",
                   F.posexplode(F.coalesce(F.try_variant_get(F.col("_v"), "$.history", "array<variant>"),
                                           F.array().cast("array<variant>"))).alias("pos", "pt")))
    pts = with_kinds(pts, {"_tv": ("pt", "$.t"), "_pv": ("pt", "$.p")})
    t = point_timestamp_ms(F.col("_tv"), F.col("_tv_k"))
    p = _float_value(F.col("_pv"), F.col("_pv_k"))
    good = (pts.select("token_id", t.alias("t"), p.alias("p"), "chunk_start", "pos")
            .filter(F.col("t").isNotNull() & F.col("p").isNotNull()))
    return good, rejects


def received_chunks(landing: DataFrame) -> DataFrame:
    """(token_id, chunk_start) of every landed payload that decodes."""
    ok = F.coalesce(_field(F.try_parse_json("payload"), "$.history").isNotNull(), F.lit(False))
    return landing.filter(ok).select("token_id", "chunk_start").distinct()


# ----------------------------------------------------------- B8 order books

LEVEL_T = "struct<price:double,size:double>"


def _levels(arr: Column) -> Column:
    """Valid (price, size) levels of a variant array, input order kept."""
    parsed = F.transform(arr, lambda x: F.when(
        _is_type(x, "OBJECT"),
        F.struct(_float_value(_field(x, "$.price")).alias("price"),
                 _float_value(_field(x, "$.size")).alias("size"))))
    return F.filter(parsed, lambda s: s.isNotNull() & s["price"].isNotNull() & s["size"].isNotNull())


COPY_SALTS = 64  # equal payloads are numbered in so many groups


def with_book_id(landing: DataFrame) -> DataFrame:
    """``_book``: the SHA-256 of (token_id, payload) and an ordinal among equal rows.

    Equal rows are interchangeable, so any numbering of them gives the same
    table. They are numbered within salted groups, each after the groups
    before it, so that a payload that landed very often isn't one task's.
    """
    text = F.concat_ws("\n", F.coalesce("token_id", F.lit("")), F.coalesce("payload", F.lit("")))
    rows = landing.withColumn("_hash", F.sha2(text.cast("binary"), 256)) \
        .withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(COPY_SALTS)))
    groups = rows.groupBy("_hash", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_hash").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    first = groups.select("_hash", "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    rank = F.row_number().over(Window.partitionBy("_hash", "_salt").orderBy(F.lit(0))) - 1
    return (rows.withColumn("_rank", rank).join(first, ["_hash", "_salt"])
            .withColumn("_book", F.concat("_hash", F.lit("-"), F.col("_first") + F.col("_rank")))
            .drop("_hash", "_salt", "_first", "_rank"))


def decode_orderbook(landing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(token_id, payload) -> books (token_id, timestamp, bids, asks).

    Levels need both price and size (text is parsed); bad levels are
    dropped; bids are sorted by price descending and asks ascending, stably.
    A payload without a ``bids`` or ``asks`` list is rejected; a missing or
    bad timestamp becomes 0. Every payload is a book of its own: ``book_id``
    tells books with the same token and timestamp apart, and is the same
    however the landing table is partitioned (``with_book_id``).
    """
    from oddsline.operators.book import ladder_sort

    base = with_book_id(landing).withColumn("_v", F.try_parse_json("payload"))
    bids = F.try_variant_get(F.col("_v"), "$.bids", "array<variant>")
    asks = F.try_variant_get(F.col("_v"), "$.asks", "array<variant>")
    ok = bids.isNotNull() & asks.isNotNull()
    rejects = base.filter(~ok).select(*[c for c in landing.columns],
                                      F.lit("missing bids or asks").alias("reason"))
    ts = F.when(_field(F.col("_v"), "$.timestamp").isNull(), F.lit(0).cast("bigint")).otherwise(
        strict_timestamp_ms(_field(F.col("_v"), "$.timestamp")))
    good = base.filter(ok).select(
        "token_id", F.col("_book").alias("book_id"), ts.alias("timestamp"),
        ladder_sort(_levels(bids), descending=True).alias("bids"),
        ladder_sort(_levels(asks), descending=False).alias("asks"))
    return good, rejects


# ----------------------------------------------------------- B9, B10 trades

TRADE_FIELDS = {"id": "string", "market": "string", "asset_id": "string", "conditionId": "string",
                "side": "string", "size": "double", "price": "double"}


def _rest_json(item: Column, known: list[str]) -> Column:
    """The fields of a variant object but for the known ones, as JSON (null if there are none)."""
    rest = F.map_filter(F.try_variant_get(item, "$", "map<string,variant>"), lambda k, _: ~k.isin(known))
    return F.when(F.size(rest) > 0, F.to_json(rest, {"ignoreNullFields": "false"}))


def _page_items(landing: DataFrame, item: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``_items``, the items of a trade page each read as ``item`` (null if it
    is of another kind): an empty array for any other payload. A payload is parsed once."""
    at = lambda path: F.try_variant_get("_page", path, f"array<{item}>")
    return (landing.select(*keep, F.try_parse_json("payload").alias("_page"))
            .select(*keep, F.coalesce(at("$.data"), at("$"), F.array().cast(f"array<{item}>")).alias("_items")))


def page_sizes(landing: DataFrame) -> DataFrame:
    """(batch, page, n): how many trades ``decode_trades`` finds on a page; no field is decoded."""
    page = ["batch", "page"]
    objects = F.size(F.array_compact("_items")).alias("n")  # an item that is no object is null
    return _page_items(landing, "struct<id:variant>", page).select(*page, objects).groupBy(*page).agg(F.sum("n").alias("n"))


def decode_trades(landing: DataFrame, strict_timestamp: bool = True, rest: bool = True) -> DataFrame:
    """(batch, page, payload) -> trade rows with (batch, page, pos).

    Fields of an item without a column of their own are kept as JSON in
    ``rest`` (left out on request). A page is a bare array or ``{"data": [...]}``;
    non-object items are skipped; any other payload yields nothing. The timestamp is
    cast to bigint strictly (a non-integer raises, and so does a page on which no
    trade has one) unless ``strict_timestamp`` is off.

    A page's items are read as structs of the known fields in one cast, numbers
    as doubles by the rule of ``_float_value``; only ``rest`` needs each item as
    a variant of its own.
    """
    page = ["batch", "page"]
    struct = f"struct<{','.join(f'{n}:{t}' for n, t in (TRADE_FIELDS | {'timestamp': 'variant'}).items())}>"
    if rest:
        items = _page_items(landing, "variant", page)
        dated = F.exists("_items", lambda x: _present(_field(x, "$.timestamp")))
    else:
        items = _page_items(landing, struct, page)
        dated = F.exists("_items", lambda x: _present(x["timestamp"]))
    # The page's flag is worked out below the explode, once a page. An inner explode would
    # also test each page for items below whatever builds it, which parses every page twice.
    items = (items.select(*page, dated.alias("_dated"), "_items")
             .select(*page, "_dated", F.posexplode_outer("_items").alias("pos", "it")))
    read = F.try_variant_get("it", "$", struct) if rest else F.col("it")
    items = items.select("*", read.alias("_f")).filter(F.col("_f").isNotNull())
    cols = [F.col("_f")[name].alias(name) for name in TRADE_FIELDS]
    tsv = F.col("_f")["timestamp"]
    if strict_timestamp:
        ts = F.when(~F.col("_dated"), F.raise_error(F.lit("trades without a timestamp")).cast("bigint")).when(
            _present(tsv), F.variant_get(tsv, "$", "bigint"))
    else:
        ts = F.try_variant_get(tsv, "$", "bigint")
    others = [_rest_json(F.col("it"), [*TRADE_FIELDS, "timestamp"]).alias("rest")] if rest else []
    return items.select(*page, "pos", *cols, ts.alias("timestamp"), *others)


# ----------------------------------------------------------- B1-B3 markets

# The JSON keys of a market object in the landed payload
# (camelCase, as the market API sends them) and the column each maps to.
TOKEN_IDS_KEY = "clobTokenIds"
STR_FIELDS = {  # output name -> JSON key
    "question": "question", "description": "description", "market_slug": "marketSlug",
    "condition_id": "conditionId", "created_at": "createdAt", "end_date": "endDate",
    "resolution_date": "resolutionDate", "resolution_outcome": "resolutionOutcome", "category": "category",
}
BOOL_FIELDS = ("active", "closed", "archived", "resolved")
# Text accepted as booleans by the lax model validation.
TRUE_TEXT = ("1", "on", "t", "true", "y", "yes")
FALSE_TEXT = ("0", "off", "f", "false", "n", "no")


def _as_str_list(arr: Column, drop_nulls: bool) -> Column:
    """Elements as text: strings kept, numbers/booleans as their text; JSON
    nulls dropped (``drop_nulls``) or turned into the text ``None``."""
    def one(x):
        txt = F.when(_is_type(x, "STRING"), F.try_variant_get(x, "$", "string")).when(
            _is_type(x, "BOOLEAN"), F.when(F.try_variant_get(x, "$", "boolean"), F.lit("True")).otherwise(F.lit("False"))
        ).otherwise(F.to_json(x))
        return F.when(F.coalesce(F.is_variant_null(x), F.lit(True)), F.lit(None if drop_nulls else "None")).otherwise(txt)

    out = F.transform(arr, one)
    return F.filter(out, lambda s: s.isNotNull()) if drop_nulls else out


def normalize_token_ids(v: Column) -> Column:
    """B2: list -> strings; JSON-text list -> strings without nulls; null,
    non-list, or bad JSON -> empty list."""
    as_list = F.try_variant_get(v, "$", "array<variant>")
    from_text = F.try_variant_get(F.try_parse_json(F.try_variant_get(v, "$", "string")), "$", "array<variant>")
    empty = F.array().cast("array<string>")
    return (F.when(_is_type(v, "ARRAY"), _as_str_list(as_list, drop_nulls=False))
            .when(_is_type(v, "STRING"), F.coalesce(_as_str_list(from_text, drop_nulls=True), empty))
            .otherwise(empty))


def _str_list_or_invalid(arr: Column) -> tuple[Column, Column]:
    """(list<string>, ok): ok is false when any element is not a string."""
    ok = F.forall(arr, lambda x: _is_type(x, "STRING"))
    return F.transform(arr, lambda x: F.try_variant_get(x, "$", "string")), ok


def normalize_outcomes(v: Column) -> tuple[Column, Column]:
    """List kept, JSON-text list parsed, anything else null (not empty).

    Returns (value, ok); ok is false when the list holds a non-string,
    which rejects the market.
    """
    as_list = F.try_variant_get(v, "$", "array<variant>")
    from_text = F.try_variant_get(F.try_parse_json(F.try_variant_get(v, "$", "string")), "$", "array<variant>")
    arr = F.when(_is_type(v, "ARRAY"), as_list).when(_is_type(v, "STRING"), from_text)
    vals, ok = _str_list_or_invalid(arr)
    return vals, F.coalesce(ok, F.lit(True))


def _bool_value(v: Column) -> tuple[Column, Column]:
    """(value, ok) of an optional boolean: JSON booleans, the JSON integers
    0 and 1, and the TRUE_TEXT / FALSE_TEXT words (any case); null or absent
    is None; anything else is invalid."""
    s = F.lower(F.try_variant_get(v, "$", "string"))
    i = F.try_variant_get(v, "$", "bigint")
    is_int = _vtype(v).isin("BIGINT", "INT", "SMALLINT", "TINYINT")
    val = (F.when(~_present(v), F.lit(None).cast("boolean"))
           .when(_is_type(v, "BOOLEAN"), F.try_variant_get(v, "$", "boolean"))
           .when(is_int & i.isin(0, 1), i == 1)
           .when(_is_type(v, "STRING") & s.isin(*TRUE_TEXT), F.lit(True))
           .when(_is_type(v, "STRING") & s.isin(*FALSE_TEXT), F.lit(False)))
    ok = ~_present(v) | val.isNotNull()
    return val, ok


def decode_markets(pages: DataFrame, max_pages: int | None = None) -> tuple[DataFrame, DataFrame]:
    """B1: (page, payload) of JSON arrays of market objects -> MARKETS rows.

    camelCase keys map to snake_case, unknown keys are ignored, non-object
    items are skipped. A market whose id is missing or not text, or whose
    fields have the wrong JSON type, goes to the rejects frame. With
    ``max_pages`` only pages 0 .. max_pages-1 count (the page cap).
    """
    if max_pages is not None:
        pages = pages.filter(F.col("page") < F.lit(max_pages))
    items = pages.select("page", F.posexplode(F.coalesce(_items(F.col("payload")), F.array().cast("array<variant>")))
                         .alias("pos", "it")).filter(_is_type(F.col("it"), "OBJECT"))
    it = F.col("it")
    checks: list[Column] = []
    cols: list[Column] = []
    idv = _field(it, "$.id")
    checks.append(_is_type(idv, "STRING"))
    cols.append(F.try_variant_get(idv, "$", "string").alias("id"))
    for out, key in STR_FIELDS.items():
        f = _field(it, f"$.{key}")
        checks.append(~_present(f) | _is_type(f, "STRING"))
        cols.append(F.try_variant_get(f, "$", "string").alias(out))
    tok = _field(it, f"$.{TOKEN_IDS_KEY}")
    cols.append(F.when(tok.isNull(), F.array().cast("array<string>")).otherwise(normalize_token_ids(tok)).alias("token_ids"))
    outc, outc_ok = normalize_outcomes(_field(it, "$.outcomes"))
    checks.append(outc_ok)
    cols.append(outc.alias("outcomes"))
    for b in BOOL_FIELDS:
        val, ok = _bool_value(_field(it, f"$.{b}"))
        checks.append(ok)
        cols.append(val.alias(b))
    tags = _field(it, "$.tags")
    tag_vals, tag_ok = _str_list_or_invalid(F.try_variant_get(tags, "$", "array<variant>"))
    checks.append(tags.isNull() | (_is_type(tags, "ARRAY") & F.coalesce(tag_ok, F.lit(False))))
    cols.append(F.coalesce(tag_vals, F.array().cast("array<string>")).alias("tags"))
    valid = checks[0]
    for c in checks[1:]:
        valid = valid & F.coalesce(c, F.lit(False))
    decoded = items.select("page", "pos", *cols, F.coalesce(valid, F.lit(False)).alias("_ok"), F.to_json("it").alias("raw"))
    from oddsline.schemas import MARKETS

    good = decoded.filter("_ok").select(*[F.col(f.name) for f in MARKETS.fields], "page", "pos")
    rejects = decoded.filter(~F.col("_ok")).select("page", "pos", "raw", F.lit("validation failed").alias("reason"))
    return good, rejects
