"""Backfill planning as table operations.

A fetch plan is data: jobs (one row per token and time range) expand into
14-day chunks, the completed-window ledger is anti-joined away, the
empty-run rule trims each token's chunk sequence, and id batches / row
budgets are computed over ordered tables.

Scale notes
* Chunks per job are bounded by (range / 14 days), so the explode and the
  per-token windows of the empty-run rule are bounded per token.
* Ordered indexes (id batches, row budgets) need a global order. They use a
  distributed prefix sum: a range-partitioned sort, one total per
  partition (a handful of numbers to the driver), then per-partition
  offsets in a narrow ``mapInPandas`` -- never a window without
  PARTITION BY and never the rows on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddsline.functions.timecols import iso_to_ms, lookback_start_ms
from oddsline.schemas import LEDGER_KEY, MS_PER_DAY

# Price-history chunk length, empty-run limit, id batch size, trade row budget.
CHUNK_MS = 14 * MS_PER_DAY
EMPTY_CHUNK_LIMIT = 5
ID_BATCH_SIZE = 50
MAX_TRADES_DEFAULT = None  # no cap unless the caller asks for one


# ------------------------------------------------------------ D1

def lookback_window(df: DataFrame, as_of_ms: int, t_col: str = "t", **units) -> DataFrame:
    """Rows at or after the look-back start computed from ``as_of_ms``."""
    return df.filter(F.col(t_col) >= lookback_start_ms(as_of_ms, **units))


# ------------------------------------------------------------ D2

def token_jobs(markets: DataFrame, global_start_ms: int, global_end_ms: int) -> tuple[DataFrame, DataFrame]:
    """Per market: [max(start, created), min(end, resolution else end date)],
    empty ranges dropped, one row per token (null/empty token lists vanish).

    Returns (jobs, rejects); rows whose non-empty date text does not parse
    go to rejects instead of failing the whole stage.
    """
    def parsed(c):
        txt = F.nullif(F.col(c), F.lit(""))
        return txt, iso_to_ms(c)

    c_txt, c_ms = parsed("created_at")
    r_txt, r_ms = parsed("resolution_date")
    e_txt, e_ms = parsed("end_date")
    bad = ((c_txt.isNotNull() & c_ms.isNull()) | (r_txt.isNotNull() & r_ms.isNull())
           | (r_txt.isNull() & e_txt.isNotNull() & e_ms.isNull()))
    gs, ge = F.lit(global_start_ms), F.lit(global_end_ms)
    created = F.coalesce(c_ms, gs)
    market_end = (F.when(r_txt.isNotNull(), F.least(ge, r_ms))
                  .when(e_txt.isNotNull(), F.least(ge, e_ms)).otherwise(ge))
    base = markets.select("id", "token_ids", "created_at", "end_date", "resolution_date",
                          F.coalesce(bad, F.lit(False)).alias("_bad"),
                          created.alias("created_at_ts"),
                          F.greatest(gs, created).alias("start_ts"),
                          F.least(ge, market_end).alias("end_ts"))
    rejects = base.filter("_bad").select("id", "created_at", "end_date", "resolution_date",
                                         F.lit("unparseable date").alias("reason"))
    jobs = (base.filter(~F.col("_bad") & (F.col("start_ts") < F.col("end_ts")))
            .select(F.explode("token_ids").alias("token_id"), "start_ts", "end_ts",
                    F.col("id").alias("market_id"), "created_at_ts"))
    return jobs, rejects


# ------------------------------------------------------------ D3

def distinct_tokens(markets: DataFrame) -> DataFrame:
    return (markets.select(F.explode("token_ids").alias("token_id"))
            .filter(F.col("token_id").isNotNull()).distinct())


# ------------------------------------------------------------ D4

def chunk_windows(jobs: DataFrame, chunk_ms: int = CHUNK_MS) -> DataFrame:
    """Inclusive windows [s, min(s + chunk, end)], next s = previous end + 1,
    while s < end. Jobs with start >= end give nothing."""
    step = chunk_ms + 1
    valid = jobs.filter(F.col("start_ts") < F.col("end_ts"))
    starts = F.sequence(F.col("start_ts"), F.col("end_ts") - 1, F.lit(step).cast("bigint"))
    keep = [c for c in jobs.columns if c not in ("start_ts", "end_ts")]
    out = valid.select(*keep, "end_ts", F.posexplode(starts).alias("chunk_no", "chunk_start"))
    return out.select(*keep, "chunk_no", "chunk_start",
                      F.least(F.col("chunk_start") + F.lit(chunk_ms), F.col("end_ts")).alias("chunk_end"))


# ------------------------------------------------------------ D5, D6

def pending_windows(chunks: DataFrame, ledger: DataFrame, fidelity: int) -> DataFrame:
    """Chunks whose (token, start, end, fidelity) is not in the ledger: chunks
    and completed windows are unioned and marked in one pass by token."""
    key = ["token_id", "chunk_start", "chunk_end"]
    led = (ledger.filter(F.col("fidelity") == F.lit(fidelity))
           .select("token_id", F.col("start_ts").alias("chunk_start"), F.col("end_ts").alias("chunk_end"),
                   F.lit(True).alias("_done")))
    u = chunks.withColumn("_done", F.lit(False)).unionByName(led, allowMissingColumns=True).repartition("token_id")
    done = F.max("_done").over(Window.partitionBy(*key))
    return (u.withColumn("_any", done).filter(~F.col("_done") & ~F.col("_any")).drop("_done", "_any")
            .withColumn("fidelity", F.lit(fidelity)).select(*key, "fidelity", *[c for c in chunks.columns if c not in key]))


def window_ledger_merge(ledger: DataFrame, marks: DataFrame) -> DataFrame:
    """Ledger upsert: later writes replace earlier ones on the 4-column key.

    ``marks`` rows are written after the ledger; within ``marks`` a
    ``write_seq`` column (if present) orders the writes. Rows are exchanged by
    key before they are combined: keys seldom repeat, and ``max_by`` of texts
    combines sorted rows, so a map-side pass would sort whole map tasks (large
    where windows have just been generated from jobs) and combine little.
    """
    old = ledger.select(*LEDGER_KEY, "completed_at", "row_count", F.lit(0).cast("bigint").alias("_w"))
    seq = F.col("write_seq").cast("bigint") + 1 if "write_seq" in marks.columns else F.lit(1).cast("bigint")
    new = marks.select(*LEDGER_KEY, "completed_at", "row_count", seq.alias("_w"))
    last = F.max_by(F.struct("completed_at", "row_count"), "_w")
    return old.unionByName(new).repartition(*LEDGER_KEY).groupBy(*LEDGER_KEY).agg(last.alias("_v")).select(*LEDGER_KEY, "_v.*")


def ledger_completed_count(ledger: DataFrame) -> DataFrame:
    """Number of completed windows in the ledger (one row)."""
    return ledger.agg(F.count(F.lit(1)).alias("completed"))


def chunk_of_points(points: DataFrame, jobs: DataFrame, chunk_ms: int = CHUNK_MS) -> DataFrame:
    """Assign fetched points (token_id, t) to their chunk of the token's job.

    The chunk number is arithmetic, floor((t - start) / (chunk + 1)), so this
    is an equi-join on token plus a range check, never a range join.
    Points outside [start, end] or in the uncovered last millisecond of a
    range (see ``chunk_windows``) get no chunk.
    """
    j = jobs.select("token_id", F.col("start_ts").alias("_s"), F.col("end_ts").alias("_e"))
    k = F.floor((F.col("t") - F.col("_s")) / F.lit(chunk_ms + 1)).cast("bigint")
    cs = F.col("_s") + k * F.lit(chunk_ms + 1)
    inside = F.col("t").between(F.col("_s"), F.col("_e")) & (cs < F.col("_e"))  # the chunk must exist
    return (points.join(j, "token_id", "inner").filter(inside)
            .select("token_id", cs.alias("chunk_start"),
                    F.least(cs + F.lit(chunk_ms), F.col("_e")).alias("chunk_end")))


def pending_with_counts(chunks: DataFrame, ledger: DataFrame, fidelity: int, point_chunks: DataFrame,
                        carry: tuple[str, ...] = ("market_id", "chunk_no", "created_at_ts")) -> DataFrame:
    """D5 plus fetched-row counts in one co-grouped pass.

    Chunks, completed ledger windows of this fidelity, and per-chunk point
    counts are tagged and unioned, all hash-partitioned by token_id, and one
    window on the chunk key tells which are completed and how many points
    each holds. The windows (also those of ``empty_run_cutoff`` after it)
    reuse the token partitioning, so the chunk rows are exchanged once
    instead of once per join key. A token may have several jobs (markets);
    every job keeps its own chunk rows. ``carry``: chunk columns passed
    through, as far as they exist.
    """
    carry = tuple(x for x in carry if x in chunks.columns)
    key = ["token_id", "chunk_start", "chunk_end"]
    n = F.lit(0).cast("bigint")
    c = chunks.select(*key, F.lit(0).alias("_kind"), n.alias("_n"), *carry)
    led = (ledger.filter(F.col("fidelity") == F.lit(fidelity))
           .select("token_id", F.col("start_ts").alias("chunk_start"), F.col("end_ts").alias("chunk_end"),
                   F.lit(1).alias("_kind"), n.alias("_n"),
                   *[F.lit(None).cast(c.schema[x].dataType).alias(x) for x in carry]))
    # Points are raw rows: count them per chunk first (a partial aggregate),
    # so that only chunk-level rows -- bounded per token -- go through the
    # token exchange below, however hot a token is.
    pts = (point_chunks.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
           .select(*key, F.lit(2).alias("_kind"), "_n",
                   *[F.lit(None).cast(c.schema[x].dataType).alias(x) for x in carry]))
    u = c.unionByName(led).unionByName(pts).repartition("token_id")
    same = Window.partitionBy(*key)
    g = (u.withColumn("_done", F.max(F.col("_kind") == 1).over(same))
         .withColumn("row_count", F.sum("_n").over(same)))
    return (g.filter((F.col("_kind") == 0) & ~F.col("_done"))
            .select(*key, *carry, F.lit(fidelity).alias("fidelity"), "row_count"))


# ------------------------------------------------------------ D7

def empty_run_cutoff(chunks: DataFrame, limit: int = EMPTY_CHUNK_LIMIT, rows_col: str = "row_count",
                     created_col: str = "created_at_ts") -> DataFrame:
    """Per job (market and token) in chunk order, drop the chunks after the early stop.

    The run of empty chunks (reset by a non-empty one) reaching ``limit`` at
    a chunk starting at or after creation (or with creation unknown) stops
    the job; that chunk is kept, later ones are dropped. All windows share
    one partitioning and order (chunk_start).
    """
    job = [c for c in ("market_id", "token_id") if c in chunks.columns]
    w = Window.partitionBy(*job).orderBy("chunk_start")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    empty = F.coalesce(F.col(rows_col), F.lit(0)) == 0
    rn = F.row_number().over(w)
    with_rn = chunks.withColumn("_rn", rn).withColumn("_empty", empty)
    last_full = F.max(F.when(~F.col("_empty"), F.col("_rn"))).over(upto)
    run = F.when(F.col("_empty"), F.col("_rn") - F.coalesce(last_full, F.lit(0))).otherwise(F.lit(0))
    created = F.col(created_col) if created_col in chunks.columns else F.lit(None).cast("bigint")
    can_stop = created.isNull() | (F.col("chunk_start") >= created)
    stop_here = F.col("_empty") & (F.col("_run") >= limit) & can_stop
    stop_rn = F.min(F.when(F.col("_stop"), F.col("_rn"))).over(Window.partitionBy(*job))
    return (with_rn.withColumn("_run", run).withColumn("_stop", stop_here)
            .withColumn("_stop_rn", stop_rn)
            .filter(F.col("_stop_rn").isNull() | (F.col("_rn") <= F.col("_stop_rn")))
            .drop("_rn", "_empty", "_run", "_stop", "_stop_rn"))


# ------------------------------------------------------------ ordered prefix sums

def prefix_offsets(df: DataFrame, order_cols: list[str], weight_col: str | None = None,
                   out_col: str = "offset") -> DataFrame:
    """Exclusive running sum of ``weight_col`` (1 when None) in ``order_cols`` order.

    Distributed: the frame is range-sorted and checkpointed (so both passes
    see the same partitions), partition totals (one number per partition)
    go to the driver, and each partition adds its base offset. No single
    task ever holds more than its own partition.
    """
    from oddsline.session import reliable_checkpoint

    spark = df.sparkSession
    weight = F.coalesce(F.col(weight_col).cast("bigint"), F.lit(0)) if weight_col else F.lit(1).cast("bigint")
    # A reliable checkpoint fixes the partitions: both passes below read the
    # same sorted partitions, so spark_partition_id() is stable between them.
    ck = reliable_checkpoint(df.withColumn("_wgt", weight), list(order_cols))
    tagged = ck.withColumn("_pid", F.spark_partition_id())
    totals = {r[0]: r[1] for r in tagged.groupBy("_pid").agg(F.sum("_wgt")).collect()}  # one row per partition
    base, acc = {}, 0
    for pid in sorted(totals):
        base[pid] = acc
        acc += totals[pid] or 0
    base_b = spark.sparkContext.broadcast(base)
    out_schema = T.StructType(tagged.schema.fields + [T.StructField(out_col, T.LongType(), False)])

    def running(batches):
        off = None
        for pdf in batches:  # the batches of one partition, in order
            if pdf.empty:
                continue
            if off is None:
                off = base_b.value.get(int(pdf["_pid"].iloc[0]), 0)
            w = pdf["_wgt"].astype("int64")
            pdf[out_col] = off + w.cumsum() - w
            off += int(w.sum())
            yield pdf

    return tagged.mapInPandas(running, out_schema).drop("_wgt", "_pid")


# ------------------------------------------------------------ D8

def id_batches(ids: DataFrame | None, order_cols: list[str], id_col: str = "id", size: int = ID_BATCH_SIZE,
               spark=None) -> DataFrame:
    """Non-null ids in ``order_cols`` order, cut into consecutive batches of
    ``size``; each batch as (batch, n_ids, ids joined by commas). Without an
    id list (``ids=None``) there is one unfiltered batch (null ids)."""
    if ids is None:
        return spark.createDataFrame([(0, 0, None)], "batch bigint, n_ids int, ids string")
    clean = ids.filter(F.col(id_col).isNotNull()).select(*dict.fromkeys(order_cols + [id_col]))
    idx = prefix_offsets(clean, order_cols, out_col="_idx")
    b = idx.withColumn("batch", F.floor(F.col("_idx") / size).cast("bigint"))
    g = b.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("_idx", F.col(id_col).alias("v")))).alias("_a"))
    return g.select("batch", F.size("_a").alias("n_ids"),
                    F.concat_ws(",", F.transform("_a", lambda s: s["v"])).alias("ids"))


# ------------------------------------------------------------ D9, D10

def row_budget(rows: DataFrame, budget: int | None = MAX_TRADES_DEFAULT, page_cols=("batch", "page"),
               pos_col: str = "pos") -> DataFrame:
    """The first ``budget`` rows in (batch, page, pos) order, cut mid-page (None: all rows).

    Pages are counted (one row per page), a distributed prefix sum gives
    each page the number of rows before it, and rows are kept while that
    plus their rank within the page is under the budget. Pages entirely past
    the budget are pruned before the join.
    """
    if budget is None:
        return rows
    page_cols = list(page_cols)
    counts = rows.groupBy(*page_cols).agg(F.count(F.lit(1)).alias("_n"))
    offs = prefix_offsets(counts, page_cols, "_n", "_before").filter(F.col("_before") < budget)
    rank = F.row_number().over(Window.partitionBy(*page_cols).orderBy(pos_col)) - 1
    kept = rows.join(offs.select(*page_cols, "_before"), page_cols, "inner")
    return (kept.withColumn("_rank", rank)
            .filter(F.col("_before") + F.col("_rank") < budget)
            .drop("_before", "_rank"))


def budgeted_trades(landing: DataFrame, budget: int | None = MAX_TRADES_DEFAULT, rest: bool = True) -> DataFrame:
    """D9 on landed trade pages: the trades that ``row_budget`` would keep of all
    decoded ones, but only pages that begin within the budget are decoded.

    Pages are sized by their payloads' arrays (a row per page, no field is
    read) and a distributed prefix sum gives the trades before each. Pages that
    begin within the budget are the first ones in order, so the last of them
    (one row to the driver) bounds the landing table by a plain filter, which
    also goes below whatever builds or reads it. Only the page at the
    boundary is ranked and cut.
    """
    from oddsline.operators.decode import decode_trades, page_sizes

    if budget is None:
        return decode_trades(landing, rest=rest)
    page = ["batch", "page"]
    begin = prefix_offsets(page_sizes(landing), page, "n", "_before").filter(F.col("_before") < budget)
    last = begin.dropna(subset=page).agg(F.max(F.struct(*page)).alias("m")).first()["m"]  # null pages take no part
    b, p = (F.lit(last[c] if last else None).cast(landing.schema[c].dataType) for c in page)
    first = landing.filter((F.col("batch") < b) | ((F.col("batch") == b) & (F.col("page") <= p)))
    rows = decode_trades(first, rest=rest)
    rows = rows.join(begin.select(*page, (F.lit(budget) - F.col("_before")).alias("_left"), F.col("n").alias("_n")), page)
    rank = F.row_number().over(Window.partitionBy(*page).orderBy("pos"))
    whole = rows.filter(F.col("_n") <= F.col("_left"))
    cut = rows.filter(F.col("_n") > F.col("_left")).withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_left"))
    return whole.union(cut.drop("_rank")).drop("_left", "_n")


def trades_since(trades: DataFrame, since_ms: int | None) -> DataFrame:
    """``timestamp >= since`` (inclusive); applied after the budget."""
    return trades if since_ms is None else trades.filter(F.col("timestamp") >= F.lit(since_ms))


# ------------------------------------------------------------ D11, D12

def dedupe_price_points(points: DataFrame, order_cols=("chunk_start", "pos")) -> DataFrame:
    """One point per (token_id, t): the first in chunk order.

    ``min_by`` over (chunk_start, pos) is a partial aggregate.
    """
    rest = [c for c in points.columns if c not in ("token_id", "t")]
    first = F.min_by(F.struct(*rest), F.struct(*order_cols))
    return points.groupBy("token_id", "t").agg(first.alias("_r")).select("token_id", "t", "_r.*")


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """Vertical concatenation; every part must have the same column set."""
    if not parts:
        raise ValueError("no parts to union")
    cols = set(parts[0].columns)
    for p in parts[1:]:
        if set(p.columns) != cols:
            raise ValueError(f"part columns differ: {sorted(cols)} vs {sorted(p.columns)}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
