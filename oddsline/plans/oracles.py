"""DuckDB oracle SQL for the registered queries (same keys as queries.py).

Each string computes the expected result straight from the driver's
tables through the DuckDB adapter views, independently of the Spark code.
"""

from __future__ import annotations

from oddsline.plans import queries as Q
from oddsline.plans.present import r, sql_kind
from oddsline.sources.oracle_views import add_view, day, with_views

ORACLES: dict[str, str] = {}


def oracle(name: str, body: str, *views: str) -> None:
    ORACLES[name] = with_views(body, *views)


def _lit_list(xs) -> str:
    return "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + ")"


JOINED = """(SELECT p.token_id, p.t, p.p, m.market_id, m.question, m.condition_id, m.resolved,
                    m.resolution_outcome, m.category, m.created_at, m.outcome_name
             FROM prices p JOIN token_map m ON p.token_id = m.token_id)"""
JOINED_COLS = (f"token_id, t, {r('p', 'p')}, market_id, question, condition_id, resolved, "
               "resolution_outcome, category, created_at, outcome_name")

# ------------------------------------------------------------------ F

oracle("token_market_map", """
SELECT token_id, market_id, question, condition_id, resolved, resolution_outcome, category,
       created_at, outcome_name FROM token_map""", "token_map")

oracle("prices_joined", f"SELECT {JOINED_COLS} FROM {JOINED}", "prices", "token_map")

oracle("day_bucket", f"""SELECT id, "timestamp" AS t, {day('"timestamp"')} AS day_ts FROM trades""", "trades")

DAILY = f"(SELECT token_id, {day('t')} AS day_ts, avg(p) AS price_day FROM {{src}} GROUP BY 1, 2)"

oracle("daily_mean_price", f"SELECT token_id, day_ts, {r('price_day', 'price_day')} FROM {DAILY.format(src='prices')}",
       "prices")


def _returns(src: str, kind: bool = False) -> str:
    ret = "filled / lag(filled) OVER (PARTITION BY token_id ORDER BY day_ts) - 1"
    ret_sql = sql_kind(f"({ret})", "ret") if kind else r(ret, "ret")
    return f"""
SELECT token_id, day_ts, {r('price_day', 'price_day')}, {ret_sql}
FROM (SELECT *, last_value(price_day IGNORE NULLS) OVER (PARTITION BY token_id ORDER BY day_ts
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
      FROM {DAILY.format(src=src)})"""


oracle("daily_returns", _returns("prices"), "prices")
oracle("daily_returns_edge", _returns("prices_edge", kind=True), "prices_edge")
oracle("daily_returns_v2", _returns("prices"), "prices")
oracle("daily_returns_enriched", f"""
SELECT d.*, m.market_id, m.question, m.condition_id, m.resolved, m.resolution_outcome, m.category,
       m.created_at, m.outcome_name
FROM ({_returns('prices')}) d LEFT JOIN token_map m ON d.token_id = m.token_id""", "prices", "token_map")

oracle("price_panel", f"""
SELECT token_id, day_ts, round(price_day, 6) AS price FROM {DAILY.format(src='prices')} WHERE price_day IS NOT NULL""",
       "prices")

oracle("panel_dims", f"""
SELECT count(DISTINCT day_ts) AS panel_days, count(DISTINCT token_id) AS panel_tokens
FROM {DAILY.format(src='prices')}""", "prices")

oracle("trades_daily_agg", f"""
SELECT "conditionId", {day('"timestamp"')} AS day_ts, count(*) AS trades,
       {r('coalesce(sum(size), 0.0::DOUBLE)', 'size_sum')},
       {r('coalesce(sum(size * price), 0.0::DOUBLE)', 'notional_sum')}
FROM trades GROUP BY 1, 2""", "trades")

# ------------------------------------------------------------------ G

START_MS, END_MS = 1704412800000, 1705795199999  # 2024-01-05 00:00 .. 2024-01-20 23:59:59.999 UTC
MIN_AGE_CUT, MAX_AGE_CUT = "2024-01-16T00:00:00", "2023-12-17T00:00:00"

oracle("filter_date_range", f"SELECT {JOINED_COLS} FROM {JOINED} WHERE t >= {START_MS} AND t <= {END_MS}",
       "prices", "token_map")
oracle("filter_resolved", f"SELECT {JOINED_COLS} FROM {JOINED} WHERE resolved = true", "prices", "token_map")
oracle("filter_unresolved", f"SELECT {JOINED_COLS} FROM {JOINED} WHERE resolved = false", "prices", "token_map")
oracle("filter_market_age", f"""
SELECT {JOINED_COLS} FROM {JOINED} WHERE created_at <= '{MIN_AGE_CUT}' AND created_at >= '{MAX_AGE_CUT}'""",
       "prices", "token_map")
oracle("filter_category", f"""
SELECT {JOINED_COLS} FROM {JOINED}
WHERE category IN {_lit_list(Q.CATEGORIES)} AND NOT (category IN {_lit_list(Q.EXCLUDE_CATEGORIES)})""",
       "prices", "token_map")
oracle("filter_market_ids", f"""
SELECT {JOINED_COLS} FROM {JOINED}
WHERE market_id IS NOT NULL AND TRY_CAST(substr(market_id, 2) AS BIGINT) % 6 = 0
  AND TRY_CAST(substr(market_id, 2) AS BIGINT) < 200000
  AND NOT (market_id IN {_lit_list(Q.EXCLUDE_IDS)})""", "prices", "token_map")

COMBINED_WHERE = f"""t >= {START_MS} AND t <= {END_MS} AND resolved = false
  AND NOT (category IN {_lit_list(Q.EXCLUDE_CATEGORIES)}) AND created_at >= '{MAX_AGE_CUT}'"""

oracle("filter_combined", f"SELECT {JOINED_COLS} FROM {JOINED} WHERE {COMBINED_WHERE}", "prices", "token_map")

JUMPS = """(SELECT *, p - lag(p) OVER w AS jump_abs, (p - lag(p) OVER w) / lag(p) OVER w AS jump_pct
            FROM {src} WINDOW w AS (PARTITION BY token_id ORDER BY t, p NULLS FIRST))"""

oracle("compute_jumps", f"""
SELECT token_id, t, {r('p', 'p')}, {r('jump_abs', 'jump_abs')}, {r('jump_pct', 'jump_pct')}
FROM {JUMPS.format(src='prices')}""", "prices")
ORACLES["compute_jumps_range"] = ORACLES["compute_jumps"]
oracle("compute_jumps_edge", f"""
SELECT token_id, t, {r('p', 'p')}, {sql_kind('jump_abs', 'jump_abs')}, {sql_kind('jump_pct', 'jump_pct')}
FROM {JUMPS.format(src='prices_edge')}""", "prices_edge")

FILTERED = f"(SELECT * FROM {JOINED} WHERE {COMBINED_WHERE})"
JUMP_WHERE = f"abs(jump_pct) >= {Q.MIN_JUMP_PCT} AND abs(jump_abs) <= {Q.MAX_JUMP_ABS}"

oracle("filter_jumps", f"""
SELECT {JOINED_COLS} FROM {JUMPS.format(src=FILTERED)} WHERE {JUMP_WHERE}""", "prices", "token_map")

_labels = ";".join([
    f"start_date>={Q.DATE_START}", f"end_date<={Q.DATE_END}", "unresolved_only",
    f"max_age_days<={Q.MAX_AGE}", f"exclude_categories={Q.EXCLUDE_CATEGORIES}",
    f"min_jump_pct>={Q.MIN_JUMP_PCT}", f"max_jump_abs<={Q.MAX_JUMP_ABS}",
]).replace("'", "''")

oracle("filter_report", f"""
SELECT n_in AS input_count, n_out AS output_count, n_in - n_out AS rows_removed,
       '{_labels}' AS filters_applied
FROM (SELECT (SELECT count(*) FROM {JOINED}) AS n_in,
             (SELECT count(*) FROM {JUMPS.format(src=FILTERED)} WHERE {JUMP_WHERE}) AS n_out)""",
       "prices", "token_map")


# ------------------------------------------------------------------ E

BOOK_TS = """CASE WHEN token_id = 'T7' THEN 0 ELSE "timestamp" END"""

# A book's id: the SHA-256 of its token and its landed payload, and its number among equal payloads.
_side = """coalesce(string_agg('{{"price":"' || price || '","size":"' || size || '"}}', ',' ORDER BY level_seq)
                   FILTER (WHERE side = '{0}'), '')"""
add_view("book_ids", f"""
SELECT token_id, "timestamp", h || '-' || (row_number() OVER (PARTITION BY h ORDER BY "timestamp") - 1) AS book_id
FROM (SELECT token_id, "timestamp", sha256(token_id || chr(10) || '{{"market":"x","bids":[' || {_side.format('bid')} ||
             '],"asks":[' || {_side.format('ask')} || '],"timestamp":' ||
             CASE WHEN token_id = 'T7' THEN '"soon"' ELSE '"' || "timestamp" || '"' END || '}}') AS h
      FROM book_levels GROUP BY token_id, "timestamp")""", "book_levels")

oracle("book_levels", f"""
SELECT token_id, {BOOK_TS} AS "timestamp", book_id, side, round(price, 6) AS price, round(size, 6) AS size
FROM book_levels JOIN book_ids USING (token_id, "timestamp")""", "book_levels", "book_ids")

oracle("book_ladder", """
SELECT token_id, "timestamp", side, round(price, 6) AS price, round(size, 6) AS size, level_seq,
       row_number() OVER (PARTITION BY token_id, "timestamp", side
                          ORDER BY CASE WHEN side = 'bid' THEN -price ELSE price END, level_seq) AS level
FROM book_levels""", "book_levels")

QUOTES = """(SELECT token_id, "timestamp", max(CASE WHEN side = 'bid' THEN price END) AS bid,
                    min(CASE WHEN side = 'ask' THEN price END) AS ask
             FROM book_levels GROUP BY token_id, "timestamp")"""

oracle("best_quotes", f"""SELECT token_id, "timestamp", {r('bid', 'bid')}, {r('ask', 'ask')} FROM {QUOTES}""",
       "book_levels")
oracle("mid_spread", f"""
SELECT token_id, "timestamp", {r('bid', 'bid')}, {r('ask', 'ask')}, {r('(bid + ask) / 2', 'mid')},
       {r('ask - bid', 'spread')} FROM {QUOTES}""", "book_levels")
oracle("spread_snapshot", f"""
SELECT token_id, {r('bid', 'bid')}, {r('ask', 'ask')}, {r('(bid + ask) / 2', 'mid')}, {r('ask - bid', 'spread')},
       {BOOK_TS} AS "timestamp" FROM {QUOTES}""", "book_levels")
oracle("spread_snapshot_levels", f"""
SELECT token_id, {r('bid', 'bid')}, {r('ask', 'ask')}, {r('(bid + ask) / 2', 'mid')}, {r('ask - bid', 'spread')},
       "timestamp" FROM {QUOTES}""", "book_levels")
ORACLES["spread_decoded_books"] = ORACLES["spread_snapshot"]

DEPTH = f"""(SELECT l.token_id, l."timestamp",
       coalesce(sum(CASE WHEN l.side = 'bid' AND l.price >= (q.bid + q.ask) / 2 - {Q.DEPTH_DISTANCE}
                         THEN l.size END), 0.0::DOUBLE) AS depth_bid,
       coalesce(sum(CASE WHEN l.side = 'ask' AND l.price <= (q.bid + q.ask) / 2 + {Q.DEPTH_DISTANCE}
                         THEN l.size END), 0.0::DOUBLE) AS depth_ask
FROM book_levels l JOIN {QUOTES} q ON l.token_id = q.token_id AND l."timestamp" = q."timestamp"
GROUP BY l.token_id, l."timestamp")"""

oracle("depth_at_distance", f"""
SELECT token_id, "timestamp", {r('depth_bid', 'depth_bid')}, {r('depth_ask', 'depth_ask')},
       {r('depth_bid + depth_ask', 'depth_both')} FROM {DEPTH}""", "book_levels")
oracle("depth_decoded_books", f"""
SELECT token_id, {BOOK_TS} AS "timestamp", book_id, {r('depth_bid', 'depth_bid')}, {r('depth_ask', 'depth_ask')},
       {r('depth_bid + depth_ask', 'depth_both')} FROM {DEPTH} JOIN book_ids USING (token_id, "timestamp")""",
       "book_levels", "book_ids")
oracle("depth_from_books", f"""
SELECT token_id, {BOOK_TS} AS "timestamp", {r('depth_bid', 'depth_bid')}, {r('depth_ask', 'depth_ask')},
       {r('depth_bid + depth_ask', 'depth_both')} FROM {DEPTH}""", "book_levels")

# ------------------------------------------------------------------ B

from oddsline.sources.oracle_views import ms as _ms  # noqa: E402

POINTS = f"""(SELECT 'T' || user_id AS token_id, CAST(floor(event_id / 64) AS BIGINT) AS chunk_start,
       CAST(row_number() OVER (PARTITION BY user_id, floor(event_id / 64) ORDER BY event_id) - 1 AS INTEGER) AS pos,
       event_type, event_id, {_ms('ts')} AS t0, value
FROM events)"""

oracle("decode_price_history", f"""
SELECT token_id, CASE WHEN event_type = 'view' THEN (t0 // 1000) * 1000 ELSE t0 END AS t,
       round(value, 6) AS p, chunk_start, pos
FROM {POINTS} WHERE event_type <> 'signup' AND event_id % 97 <> 0""")

oracle("normalize_timestamps", f"""
SELECT token_id, chunk_start, pos,
       CASE WHEN event_type IN ('click', 'signup') THEN 'text' ELSE 'number' END AS t_kind,
       CASE WHEN event_type = 'view' THEN (t0 // 1000) * 1000 WHEN event_type = 'signup' THEN NULL
            ELSE t0 END AS t_ms
FROM {POINTS}""")


def _iso_ms(col: str) -> str:
    return f"epoch_ms(try_cast({col} AS TIMESTAMPTZ))"


oracle("iso_to_epoch_ms", f"""
SELECT id, {_iso_ms('created_at')} AS created_ms, {_iso_ms('end_date')} AS end_ms,
       {_iso_ms('resolution_date')} AS resolution_ms, CAST(NULL AS BIGINT) AS bad_ms FROM markets""", "markets")


def _ms_iso(t: str) -> str:
    return (f"(strftime(make_timestamp(({t}) * 1000), '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN ({t}) % 1000 = 0 THEN '' ELSE '.' || lpad(CAST((({t}) % 1000) * 1000 AS VARCHAR), 6, '0') END"
            f" || '+00:00')")


oracle("epoch_ms_to_iso", f"""
SELECT token_id, t, {_ms_iso('t')} AS iso, {_ms_iso(day('t'))} AS day_iso FROM prices""", "prices")

oracle("decode_orderbook", f"""
SELECT token_id, {BOOK_TS} AS "timestamp",
       count(*) FILTER (WHERE side = 'bid')::INTEGER AS n_bids, count(*) FILTER (WHERE side = 'ask')::INTEGER AS n_asks,
       {r("max(price) FILTER (WHERE side = 'bid')", 'best_bid')}, {r("min(price) FILTER (WHERE side = 'ask')", 'best_ask')},
       {r("coalesce(sum(size) FILTER (WHERE side = 'bid'), 0.0::DOUBLE)", 'bid_size')},
       {r("coalesce(sum(size) FILTER (WHERE side = 'ask'), 0.0::DOUBLE)", 'ask_size')},
       coalesce(string_agg(printf('%.2f', price), ',' ORDER BY -price, level_seq) FILTER (WHERE side = 'bid'), '') AS bid_ladder,
       coalesce(string_agg(printf('%.2f', price), ',' ORDER BY price, level_seq) FILTER (WHERE side = 'ask'), '') AS ask_ladder
FROM book_levels GROUP BY token_id, "timestamp\"""", "book_levels")

oracle("decode_trades", f"""
SELECT CAST(floor(page / 8) AS BIGINT) AS batch, page, pos, id, CAST(NULL AS VARCHAR) AS market,
       CAST(NULL AS VARCHAR) AS asset_id, "conditionId", CAST(NULL AS VARCHAR) AS side,
       round(size, 6) AS size, round(price, 6) AS price, "timestamp"
FROM (SELECT CAST(floor(l_orderkey / 256) AS BIGINT) AS page,
             CAST(row_number() OVER (PARTITION BY floor(l_orderkey / 256)
                  ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_tax, l_shipdate) - 1
                  AS INTEGER) AS pos,
             l_orderkey || '-' || l_linenumber AS id, 'S' || (l_suppkey % 5) AS "conditionId",
             l_quantity AS size, nullif(l_tax, 0.0::DOUBLE) AS price, {_ms('l_shipdate')} AS "timestamp"
      FROM lineitem)""")

oracle("decode_trades_rest", """
SELECT CAST(floor(l_orderkey / 256) AS BIGINT) AS page,
       CAST(row_number() OVER (PARTITION BY floor(l_orderkey / 256)
            ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_tax, l_shipdate) - 1
            AS INTEGER) AS pos,
       l_orderkey || '-' || l_linenumber AS id,
       '{"fee":{"bps":' || l_linenumber || '},"transactionHash":"0x' || l_orderkey || '"}' AS rest
FROM lineitem""")

MK = "TRY_CAST(substr(id, 2) AS BIGINT)"
DECODED_MARKETS = f"""(SELECT id, question, description, market_slug, condition_id, token_ids,
       CASE WHEN {MK} % 11 = 0 THEN NULL ELSE outcomes END AS outcomes, active, closed, archived,
       created_at, end_date, resolved, resolution_date, resolution_outcome, tags, category
FROM markets WHERE {MK} % 13 <> 0)"""

oracle("decode_markets", f"""
SELECT id, question, description, market_slug, condition_id, array_to_string(token_ids, ',') AS token_ids,
       array_to_string(outcomes, ',') AS outcomes, active, closed, archived, created_at, end_date, resolved,
       resolution_date, resolution_outcome, array_to_string(tags, ',') AS tags, category
FROM {DECODED_MARKETS}""", "markets")

oracle("decode_markets_rejects", f"""
SELECT page, pos, 'validation failed' AS reason FROM (
  SELECT CAST(floor({MK} / 100) AS BIGINT) AS page,
         CAST(row_number() OVER (PARTITION BY floor({MK} / 100) ORDER BY {MK}) - 1 AS INTEGER) AS pos,
         {MK} % 13 = 0 AS rej
  FROM markets) WHERE rej""", "markets")

oracle("normalize_token_ids", f"""
SELECT id, array_to_string(token_ids, ',') AS token_ids, CAST(len(token_ids) AS INTEGER) AS n_tokens
FROM {DECODED_MARKETS}""", "markets")

oracle("normalize_outcomes", f"""
SELECT id, coalesce(array_to_string(outcomes, ','), '') AS outcomes, outcomes IS NULL AS outcomes_null
FROM {DECODED_MARKETS}""", "markets")


# ------------------------------------------------------------------ C

W_START, W_END = Q.WINDOW_START_MS, Q.WINDOW_END_MS
MCOLS = ("id, question, description, market_slug, condition_id, array_to_string(token_ids, ',') AS token_ids, "
         "array_to_string(outcomes, ',') AS outcomes, active, closed, archived, created_at, end_date, resolved, "
         "resolution_date, resolution_outcome, array_to_string(tags, ',') AS tags, category")


def iso(col: str) -> str:
    return f"epoch_ms(try_cast(nullif(trim({col}), '') AS TIMESTAMPTZ))"


add_view("mpos", f"SELECT *, {MK} AS pos FROM markets", "markets")
add_view("store_m", """
SELECT * REPLACE (CAST(coalesce(resolved, false) AS INTEGER) AS resolved) FROM mpos""", "mpos")
add_view("closed_feed", "SELECT * REPLACE (question || ' (window feed)' AS question) FROM mpos", "mpos")
add_view("feed_active", f"""
SELECT *, 0 AS rnk, 'active' AS source FROM mpos
WHERE closed = false AND ({iso('created_at')} IS NULL OR {iso('created_at')} <= {W_END})""", "mpos")
add_view("feed_stored", f"""
SELECT * REPLACE (true AS resolved), 1 AS rnk, 'stored_resolved' AS source FROM store_m
WHERE resolved = 1 AND coalesce(nullif({iso('resolution_date')}, 0), nullif({iso('end_date')}, 0))
      BETWEEN {W_START} AND {W_END}""", "store_m")
add_view("feed_closed", f"""
SELECT *, 2 AS rnk, 'closed' AS source FROM closed_feed
WHERE {iso('end_date')} BETWEEN {W_START} AND {W_END}
  AND id NOT IN (SELECT id FROM store_m WHERE resolved = 1)""", "closed_feed", "store_m")
add_view("selected", """
SELECT * EXCLUDE (rn, rnk, pos) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY rnk, pos) AS rn
  FROM (SELECT * FROM feed_active UNION ALL BY NAME SELECT * FROM feed_stored
        UNION ALL BY NAME SELECT * FROM feed_closed)) WHERE rn = 1""", "feed_active", "feed_stored", "feed_closed")

oracle("filter_created_before", f"""
SELECT {MCOLS} FROM markets WHERE {iso('created_at')} IS NULL OR {iso('created_at')} <= {W_END}""", "markets")
oracle("active_markets", f"""
SELECT {MCOLS} FROM markets
WHERE closed = false AND ({iso('created_at')} IS NULL OR {iso('created_at')} <= {W_END})""", "markets")
oracle("closed_in_window", f"""
SELECT {MCOLS} FROM markets WHERE {iso('end_date')} BETWEEN {W_START} AND {W_END}""", "markets")
oracle("exclude_known_resolved", f"""
SELECT {MCOLS} FROM closed_feed WHERE {iso('end_date')} BETWEEN {W_START} AND {W_END}
  AND id NOT IN (SELECT id FROM store_m WHERE resolved = 1)""", "closed_feed", "store_m")
oracle("resolved_in_window", f"""
SELECT {MCOLS} FROM store_m WHERE resolved = 1
  AND coalesce(nullif({iso('resolution_date')}, 0), nullif({iso('end_date')}, 0)) BETWEEN {W_START} AND {W_END}""",
       "store_m")
oracle("merge_market_sources", f"SELECT {MCOLS}, source FROM selected", "selected")
oracle("resolved_markets_only", f"SELECT {MCOLS}, source FROM selected WHERE resolved = true", "selected")

add_view("mversions", """
SELECT id, CAST(0 AS BIGINT) AS seq, question, resolved = 1 AS resolved, closed = 1 AS closed, cached_at, updated_at
FROM market_store
UNION ALL
SELECT id, seq, question, coalesce(resolved, false), coalesce(closed, false), NULL, NULL FROM market_incoming""",
         "market_store", "market_incoming")
add_view("merged_store", f"""
SELECT a.id, v.question, CAST(v.resolved AS INTEGER) AS resolved, CAST(v.closed AS INTEGER) AS closed,
       coalesce(a.s_cached, '{Q.NOW_ISO}') AS cached_at,
       CASE WHEN a.n_in > 0 AND (a.r IS NULL OR a.min_in <= a.r) THEN '{Q.NOW_ISO}' ELSE a.s_updated END AS updated_at,
       v.seq AS version_seq
FROM (SELECT id, min(CASE WHEN resolved THEN seq END) AS r, max(seq) AS mx,
             count(*) FILTER (WHERE seq > 0) AS n_in, min(seq) FILTER (WHERE seq > 0) AS min_in,
             max(cached_at) AS s_cached, max(updated_at) AS s_updated
      FROM mversions GROUP BY id) a
JOIN mversions v ON v.id = a.id AND v.seq = coalesce(a.r, a.mx)""", "mversions")

oracle("market_snapshot_merge", "SELECT * FROM merged_store", "merged_store")
oracle("market_merge_counts", """
SELECT CAST(count(*) FILTER (WHERE stored IS NULL AND i.seq = min_in) AS BIGINT) AS inserted,
       CAST(count(*) FILTER (WHERE r IS NULL OR i.seq <= r)
            - count(*) FILTER (WHERE stored IS NULL AND i.seq = min_in) AS BIGINT) AS updated,
       CAST(count(*) FILTER (WHERE coalesce(i.resolved, false) AND stored_res IS NULL) AS BIGINT) AS newly_resolved
FROM market_incoming i JOIN (
  SELECT id, min(CASE WHEN resolved THEN seq END) AS r, max(CASE WHEN seq = 0 THEN 1 END) AS stored,
         max(CASE WHEN seq = 0 AND resolved THEN 1 END) AS stored_res, min(seq) FILTER (WHERE seq > 0) AS min_in
  FROM mversions GROUP BY id) p ON i.id = p.id""", "mversions", "market_incoming")
oracle("resolved_lookup", "SELECT id, question, version_seq FROM merged_store WHERE resolved = 1", "merged_store")
oracle("market_store_stats", """
SELECT count(*) AS total, count(*) FILTER (WHERE resolved = 1) AS resolved,
       count(*) FILTER (WHERE closed = 1 AND resolved = 0) AS closed_unresolved,
       count(*) FILTER (WHERE closed = 0) AS active FROM merged_store""", "merged_store")

# ------------------------------------------------------------------ D

CH = 14 * 86400000

oracle("lookback_window", f"SELECT token_id, t, {r('p', 'p')} FROM prices WHERE t >= 1705276800000", "prices")

oracle("token_jobs", f"""
SELECT unnest(token_ids) AS token_id, start_ts, end_ts, id AS market_id, created_at_ts FROM (
  SELECT id, token_ids, coalesce({iso('created_at')}, {Q.JOBS_START_MS}) AS created_at_ts,
         greatest({Q.JOBS_START_MS}, coalesce({iso('created_at')}, {Q.JOBS_START_MS})) AS start_ts,
         least({Q.JOBS_END_MS},
               CASE WHEN nullif(resolution_date, '') IS NOT NULL THEN least({Q.JOBS_END_MS}, {iso('resolution_date')})
                    WHEN nullif(end_date, '') IS NOT NULL THEN least({Q.JOBS_END_MS}, {iso('end_date')})
                    ELSE {Q.JOBS_END_MS} END) AS end_ts
  FROM markets) WHERE start_ts < end_ts""", "markets")

oracle("distinct_tokens", """
SELECT DISTINCT token_id FROM (SELECT unnest(token_ids) AS token_id FROM markets) WHERE token_id IS NOT NULL""",
       "markets")

add_view("chunks", f"""
SELECT token_id, market_id, created_at_ts, CAST(u.i - 1 AS INTEGER) AS chunk_no, u.s AS chunk_start,
       least(u.s + {CH}, end_ts) AS chunk_end
FROM jobs, unnest(range(start_ts, end_ts, {CH + 1})) WITH ORDINALITY AS u(s, i)""", "jobs")
add_view("ledger", f"""
SELECT token_id, chunk_start AS start_ts, chunk_end AS end_ts,
       CASE WHEN chunk_no % 7 = 0 THEN 1 ELSE {Q.FIDELITY} END AS fidelity,
       '2024-01-01T00:00:00+00:00' AS completed_at, CAST(0 AS BIGINT) AS row_count
FROM chunks WHERE (CAST(substr(token_id, 2) AS BIGINT) + chunk_no) % 3 = 0""", "chunks")
add_view("chunk_counts", f"""
SELECT c.*, coalesce(n.row_count, 0) AS row_count FROM chunks c LEFT JOIN (
  SELECT p.token_id, CAST(floor((p.t - j.start_ts) / {CH + 1}) AS INTEGER) AS chunk_no, count(*) AS row_count
  FROM order_points p JOIN jobs j ON p.token_id = j.token_id WHERE p.t BETWEEN j.start_ts AND j.end_ts
  GROUP BY 1, 2) n ON c.token_id = n.token_id AND c.chunk_no = n.chunk_no""", "chunks", "order_points", "jobs")
add_view("fetch_log", f"""
SELECT c.*, {Q.FIDELITY} AS fidelity FROM chunk_counts c
WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.token_id = c.token_id AND l.start_ts = c.chunk_start
                  AND l.end_ts = c.chunk_end AND l.fidelity = {Q.FIDELITY})""", "chunk_counts", "ledger")

oracle("chunk_windows", "SELECT * FROM chunks", "chunks")
# A chunk is one number: the token's times a bound on chunk numbers, plus its own.
oracle("pending_windows", f"""
SELECT token_id, chunk_start, chunk_end, {Q.FIDELITY} AS fidelity, market_id, created_at_ts, chunk_no
FROM (SELECT *, CAST(substr(token_id, 2) AS BIGINT) * 1000000 + chunk_no AS k FROM chunks)
ANTI JOIN (SELECT CAST(substr(token_id, 2) AS BIGINT) * 1000000 + chunk_no AS k FROM chunks
           WHERE (CAST(substr(token_id, 2) AS BIGINT) + chunk_no) % 3 = 0 AND chunk_no % 7 <> 0) USING (k)""", "chunks")
oracle("window_ledger_merge", f"""
SELECT token_id, start_ts, end_ts, fidelity, arg_max(completed_at, w) AS completed_at, arg_max(row_count, w) AS row_count
FROM (SELECT *, 0 AS w FROM ledger
      UNION ALL
      SELECT token_id, chunk_start, chunk_end, {Q.FIDELITY}, '{Q.MARK_TIME}', row_count, 1
      FROM chunk_counts)
GROUP BY token_id, start_ts, end_ts, fidelity""", "ledger", "chunk_counts")
oracle("ledger_completed_count", "SELECT count(*) AS completed FROM ledger", "ledger")
oracle("empty_run_cutoff", """
SELECT token_id, chunk_no, chunk_start, chunk_end, row_count FROM (
  SELECT *, min(CASE WHEN row_count = 0 AND run >= 5 AND (created_at_ts IS NULL OR chunk_start >= created_at_ts)
                     THEN rn END) OVER (PARTITION BY token_id) AS stop_rn
  FROM (SELECT *, CASE WHEN row_count = 0 THEN rn - coalesce(max(CASE WHEN row_count <> 0 THEN rn END) OVER (
                      PARTITION BY token_id ORDER BY chunk_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
                  ELSE 0 END AS run
        FROM (SELECT *, row_number() OVER (PARTITION BY token_id ORDER BY chunk_start) AS rn FROM fetch_log)))
WHERE stop_rn IS NULL OR rn <= stop_rn""", "fetch_log")

oracle("id_batches", f"""
SELECT CAST((rn - 1) // 50 AS BIGINT) AS batch, CAST(count(*) AS INTEGER) AS n_ids, string_agg(id, ',' ORDER BY pos) AS ids
FROM (SELECT id, {MK} AS pos, row_number() OVER (ORDER BY {MK}) AS rn FROM markets) GROUP BY 1""", "markets")

TRADES_DECODED = ORACLES["decode_trades"].strip()
BUDGETED = f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY page, pos) AS rn
                FROM ({TRADES_DECODED})) WHERE rn <= {Q.ROW_BUDGET})"""
oracle("row_budget", f"SELECT * FROM {BUDGETED}")
oracle("trades_since", f'SELECT * FROM ({TRADES_DECODED}) WHERE "timestamp" >= {Q.TRADES_SINCE_MS}')

PTS_DECODED = f"""(SELECT token_id, CASE WHEN event_type = 'view' THEN (t0 // 1000) * 1000 ELSE t0 END AS t,
       value AS p, chunk_start, pos FROM {POINTS} WHERE event_type <> 'signup' AND event_id % 97 <> 0)"""
oracle("dedupe_price_points", f"""
SELECT token_id, t, round(p, 6) AS p, chunk_start, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY token_id, t ORDER BY chunk_start, pos) AS rn FROM (
    SELECT * FROM {PTS_DECODED} UNION ALL SELECT token_id, t, p * 2, chunk_start + 1000000, pos FROM {PTS_DECODED}))
WHERE rn = 1""")
oracle("union_parts", f"""
SELECT token_id, t, round(p, 6) AS p FROM prices UNION ALL SELECT token_id, t, round(p, 6) FROM order_points""",
       "prices", "order_points")

# ------------------------------------------------------------------ H

RATE = ("(SELECT request_id, limiter, t, count(*) OVER (PARTITION BY limiter ORDER BY t "
        "RANGE BETWEEN 10000 PRECEDING AND CURRENT ROW) AS window_count FROM request_log)")
QUOTA_CASE = "CASE limiter " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in Q.LIMITER_QUOTAS.items()) + " END"

oracle("trailing_rate", f"""
SELECT request_id, limiter, t, window_count, {r('window_count / 10.0::DOUBLE', 'rps')} FROM {RATE}""", "request_log")
oracle("quota_utilization", f"""
SELECT request_id, limiter, t, window_count, {r('window_count / 10.0::DOUBLE', 'rps')},
       CAST({QUOTA_CASE} AS INTEGER) AS max_requests,
       {r(f'window_count / ({QUOTA_CASE}) * 100.0::DOUBLE', 'utilization_pct')} FROM {RATE}""", "request_log")

# ------------------------------------------------------------------ A

oracle("scan_prices", f"SELECT 'T' || user_id AS token_id, {_ms('ts')} AS t, round(value, 6) AS p FROM events")
oracle("with_provenance", f"""
SELECT token_id, t, {r('p', 'p')}, 'clob' AS _source_api, '2024-02-01T00:00:00' AS _fetch_timestamp,
       '/prices-history' AS _api_endpoint FROM prices""", "prices")
oracle("stage_counts", f"""
SELECT (SELECT count(*) FROM markets) AS markets,
       (SELECT count(DISTINCT t) FROM (SELECT unnest(token_ids) AS t FROM markets) WHERE t IS NOT NULL) AS tokens,
       (SELECT count(*) FROM prices) AS price_points, (SELECT count(*) FROM book_levels) AS levels,
       (SELECT count(*) FROM (SELECT DISTINCT token_id, "timestamp" FROM book_levels)) AS spreads,
       (SELECT count(*) FROM trades) AS trades""", "markets", "prices", "book_levels", "trades")
oracle("dataset_manifest", f"""
SELECT 'prices_joined' AS dataset, 'processed/prices_joined.parquet' AS parquet_path, '{Q.NOW_ISO}' AS created_at,
       count(*) AS rows, CAST(11 AS BIGINT) AS cols FROM {JOINED}""", "prices", "token_map")


# ------------------------------------------------------------------ streaming

oracle("stream_ingest_prices", f"""
SELECT token_id, t, round(p, 6) AS p, chunk_start, pos, 'clob' AS _source_api, '/prices-history' AS _api_endpoint
FROM {PTS_DECODED}""")
ORACLES["stream_dedupe_prices"] = ORACLES["dedupe_price_points"]
oracle("stream_ingest_rejects", """
SELECT DISTINCT 'T' || user_id AS token_id, CAST(floor(event_id / 64) AS BIGINT) AS chunk_start, '{"error":' AS head,
       'missing history' AS reason FROM events""")
oracle("stream_trades_daily", f"""
SELECT "conditionId", {day('"timestamp"')} AS day_ts, count(*) AS trades,
       {r('coalesce(sum(size), 0.0::DOUBLE)', 'size_sum')},
       {r('coalesce(sum(size * price), 0.0::DOUBLE)', 'notional_sum')}
FROM trades GROUP BY 1, 2""", "trades")

oracle("scan_runs", f"SELECT token_id, t, {r('p', 'p')}, 'run' || (ascii(right(token_id, 1)) % 3) AS run FROM prices", "prices")
oracle("compact_parts", f"SELECT token_id, t, {r('p', 'p')} FROM prices", "prices")
