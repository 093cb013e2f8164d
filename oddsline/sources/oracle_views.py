"""The adapter views of ``adapters.py`` written in DuckDB SQL.

Used only to build the oracle SQL strings that check the Spark queries.
Each entry is (sql, dependencies); ``with_views`` composes the CTEs a query
needs in dependency order.

DuckDB notes: ``epoch_ms(timestamp)`` rounds sub-millisecond parts, Spark's
``unix_millis`` truncates, so ``epoch_us(ts) // 1000`` is used; ``//`` and
``%`` truncate toward zero, so floors use explicit ``pmod`` forms; decimal
literals are cast to DOUBLE.
"""

from __future__ import annotations

MS = "(epoch_us({0}) // 1000)"


def ms(col: str) -> str:
    return MS.format(col)


def pmod(x: str, m: str) -> str:
    return f"((({x}) % ({m}) + ({m})) % ({m}))"


def day(t: str) -> str:
    return f"(({t}) - {pmod(t, '86400000')})"


VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "prices": (f"""
        SELECT 'T' || user_id AS token_id, {ms('ts')} AS t, value AS p FROM events""", ()),
    "prices_edge": (f"""
        SELECT 'T' || user_id AS token_id, {ms('ts')} AS t,
               CASE WHEN event_type = 'error' THEN 0.0::DOUBLE
                    WHEN event_type = 'signup' THEN NULL::DOUBLE ELSE value END AS p
        FROM events""", ()),
    "markets": (f"""
        SELECT 'M' || c_custkey AS id, c_name AS question, 'segment ' || c_mktsegment AS description,
               lower(replace(c_name, '#', '-')) AS market_slug, 'C' || c_custkey AS condition_id,
               ['T' || (c_custkey * 2), 'T' || (c_custkey * 2 + 1)] AS token_ids, ['YES', 'NO'] AS outcomes,
               NOT (c_acctbal < 5000) AS active, c_acctbal < 5000 AS closed, false AS archived,
               strftime(DATE '2023-12-01' + CAST({pmod('c_custkey', '60')} AS INTEGER), '%Y-%m-%dT%H:%M:%SZ') AS created_at,
               strftime(DATE '2023-12-01' + CAST({pmod('c_custkey', '60')} AS INTEGER) + 45, '%Y-%m-%dT%H:%M:%SZ') AS end_date,
               CASE WHEN {pmod('c_custkey', '10')} = 0 THEN NULL ELSE c_acctbal < 3000 END AS resolved,
               CASE WHEN {pmod('c_custkey', '10')} <> 0 AND c_acctbal < 3000 THEN
                    strftime(DATE '2023-12-01' + CAST({pmod('c_custkey', '60')} AS INTEGER) + 45, '%Y-%m-%dT%H:%M:%SZ') END AS resolution_date,
               CASE WHEN {pmod('c_custkey', '10')} <> 0 AND c_acctbal < 3000 THEN
                    CASE WHEN c_acctbal < 0 THEN 'NO' ELSE 'YES' END END AS resolution_outcome,
               [c_mktsegment] AS tags, nullif(c_mktsegment, 'HOUSEHOLD') AS category
        FROM customer""", ()),
    "token_map": ("""
        SELECT u.token_id, m.id AS market_id, m.question, m.condition_id, m.resolved,
               m.resolution_outcome, m.category, m.created_at,
               m.outcomes[u.pos] AS outcome_name
        FROM markets m, unnest(m.token_ids) WITH ORDINALITY AS u(token_id, pos)""", ("markets",)),
    "trades": (f"""
        SELECT l_orderkey || '-' || l_linenumber AS id, 'S' || {pmod('l_suppkey', '5')} AS "conditionId",
               'T' || l_partkey AS asset_id, CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS side,
               l_quantity AS size, nullif(l_tax, 0.0::DOUBLE) AS price, {ms('l_shipdate')} AS "timestamp"
        FROM lineitem""", ()),
    "versions": ("""
        SELECT 'M' || o_custkey AS id,
               CAST(o_orderdate::DATE - DATE '1970-01-01' AS BIGINT) * 1000000000000 + o_orderkey AS seq,
               o_orderpriority AS question, o_orderstatus = 'F' AS resolved,
               o_orderstatus IN ('F', 'P') AS closed, o_orderdate
        FROM orders""", ()),
    "market_store": ("""
        SELECT id, r.question AS question, CAST(r.resolved AS INTEGER) AS resolved,
               CAST(r.closed AS INTEGER) AS closed,
               strftime(r.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS cached_at,
               strftime(r.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS updated_at
        FROM (SELECT id, arg_max({'question': question, 'resolved': resolved, 'closed': closed,
                                  'o_orderdate': o_orderdate}, seq) AS r
              FROM versions WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY id)""", ("versions",)),
    "market_incoming": ("""
        SELECT id, seq, question, resolved, closed FROM versions
        WHERE o_orderdate >= TIMESTAMP '1998-01-01'""", ("versions",)),
    "book_levels": (f"""
        SELECT 'T' || {pmod('user_id', '50')} AS token_id,
               CAST(1704067200000 + floor(event_id / 64) * 60000 AS BIGINT) AS "timestamp",
               CASE WHEN event_type IN ('view', 'click') OR {pmod('user_id', '10')} = 0 THEN 'bid' ELSE 'ask' END
                   AS side,
               ({pmod('event_id * 7', '99')} + 1) / 100.0::DOUBLE AS price,
               CAST(floor(value) + 1 AS DOUBLE) AS size, event_id AS level_seq
        FROM events""", ()),
    "jobs": (f"""
        SELECT 'T' || o_custkey AS token_id, 'M' || o_custkey AS market_id, start_ts, end_ts,
               start_ts AS created_at_ts
        FROM (SELECT o_custkey, min({ms('o_orderdate')}) AS start_ts, max({ms('o_orderdate')}) AS end_ts
              FROM orders GROUP BY o_custkey)
        WHERE start_ts < end_ts""", ()),
    "order_points": (f"""
        SELECT 'T' || o_custkey AS token_id, {ms('o_orderdate')} AS t, o_totalprice AS p FROM orders""", ()),
    "request_log": (f"""
        SELECT event_id AS request_id, event_type AS limiter, {ms('ts')} // 1000 AS t FROM events""", ()),
}


def with_views(body: str, *names: str) -> str:
    """``WITH <needed views> <body>`` with dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][0]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


def add_view(name: str, sql: str, *deps: str) -> None:
    VIEWS[name] = (sql, tuple(deps))
