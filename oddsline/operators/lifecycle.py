"""Market lifecycle: window selection, source merging and the immutable
snapshot store (C1-C10).

The store is a table (id, question, ..., resolved int, closed int,
cached_at, updated_at) rewritten per merge; resolved rows never change.
The merge is a closed form over versions instead of a row-by-row fold:
per id, versions are ordered by ``seq`` (stored row = 0, incoming rows =
their batch position); ``r`` = the first resolved seq; versions up to ``r``
are applied and the surviving row is the version at ``r`` (or the last one
when nothing is resolved). All of it is one grouped aggregate whose
functions (``min``, ``min_by``, ``max_by``, ``count``) combine partially
map-side, so a hot id never sits whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsline.functions.timecols import iso_to_ms

SOURCE_RANK = {"active": 0, "stored_resolved": 1, "closed": 2}


# ------------------------------------------------------------ C1-C4, C6

def filter_created_before(markets: DataFrame, end_ms: int) -> DataFrame:
    """Keep markets whose created_at is unparseable/missing or <= end."""
    ms = iso_to_ms("created_at")
    return markets.filter(ms.isNull() | (ms <= F.lit(end_ms)))


def active_markets(markets: DataFrame, end_ms: int | None = None) -> DataFrame:
    """The active feed (``closed = false``), creation-filtered when an end bound is given."""
    out = markets.filter(F.col("closed") == F.lit(False))
    return filter_created_before(out, end_ms) if end_ms is not None else out


def closed_in_window(markets: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """The window feed: markets whose end date lies in [start, end] (any status)."""
    e = iso_to_ms("end_date")
    return markets.filter(e.between(F.lit(start_ms), F.lit(end_ms)))


def exclude_known_resolved(closed: DataFrame, store: DataFrame) -> DataFrame:
    """Drop window-feed markets already stored as resolved (anti join on id)."""
    known = resolved_lookup(store).select("id")
    return closed.join(known, "id", "left_anti")


def resolved_in_window(stored_resolved: DataFrame, start_ms: int | None, end_ms: int | None) -> DataFrame:
    """C4: stored resolved markets whose resolution date (else end date) is in
    [start, end]; zero or missing dates exclude; needs both bounds."""
    if start_ms is None or end_ms is None:
        return stored_resolved.limit(0)
    res = F.nullif(iso_to_ms("resolution_date"), F.lit(0))
    end = F.nullif(iso_to_ms("end_date"), F.lit(0))
    rel = F.coalesce(res, end)
    return stored_resolved.filter(rel.between(F.lit(start_ms), F.lit(end_ms)))


def resolved_markets_only(markets: DataFrame) -> DataFrame:
    """``resolved is true`` (null excluded)."""
    return markets.filter(F.col("resolved") == F.lit(True))


# ------------------------------------------------------------ C5

def merge_market_sources(sources: list[tuple[str, DataFrame]], order_col: str = "pos") -> DataFrame:
    """Union the feeds; per id the first occurrence wins, in feed order
    (active, stored resolved, closed) then ``order_col`` within a feed.

    ``min_by`` on (rank, position) is a partial aggregate: duplicates of a hot
    id are reduced map-side.
    """
    tagged = None
    for name, df in sources:
        t = df.withColumn("_rank", F.lit(SOURCE_RANK.get(name, len(SOURCE_RANK)))).withColumn("source", F.lit(name))
        tagged = t if tagged is None else tagged.unionByName(t)
    cols = [c for c in tagged.columns if c not in ("id", "_rank", order_col)]
    best = F.min_by(F.struct(*cols), F.struct("_rank", order_col))
    return tagged.groupBy("id").agg(best.alias("_m")).select("id", "_m.*")


def select_markets(active: DataFrame, closed_feed: DataFrame, store_markets: DataFrame,
                   start_ms: int | None, end_ms: int | None, resolved_only: bool = False,
                   order_col: str = "pos") -> DataFrame:
    """The market-selection step: bound gating, C1-C6 in the source's order.

    ``store_markets`` holds the stored markets as market rows with an int
    ``resolved`` flag (as kept by the store).
    """
    feeds = [("active", active_markets(active, end_ms))]
    if start_ms is not None and end_ms is not None:
        stored_res = resolved_lookup(store_markets).withColumn("resolved", F.lit(True))
        feeds.append(("stored_resolved", resolved_in_window(stored_res, start_ms, end_ms)))
        win = closed_in_window(closed_feed, start_ms, end_ms)
        feeds.append(("closed", exclude_known_resolved(win, store_markets)))
    out = merge_market_sources(feeds, order_col)
    return resolved_markets_only(out) if resolved_only else out


# ------------------------------------------------------------ C7, C8

def _versions(store: DataFrame, incoming: DataFrame, fields: list[str]) -> DataFrame:
    s = store.select("id", F.lit(0).cast("bigint").alias("seq"), *fields,
                     (F.col("resolved") == 1).alias("resolved"), (F.col("closed") == 1).alias("closed"),
                     "cached_at", "updated_at")
    i = incoming.select("id", F.col("seq").cast("bigint"), *fields,
                        F.coalesce("resolved", F.lit(False)).alias("resolved"),
                        F.coalesce("closed", F.lit(False)).alias("closed"),
                        F.lit(None).cast("string").alias("cached_at"), F.lit(None).cast("string").alias("updated_at"))
    return s.unionByName(i)


def _payload_fields(store: DataFrame, incoming: DataFrame) -> list[str]:
    skip = {"id", "seq", "resolved", "closed", "cached_at", "updated_at"}
    return [c for c in incoming.columns if c not in skip and c in store.columns]


def market_snapshot_merge(store: DataFrame, incoming: DataFrame, now_iso: str) -> DataFrame:
    """The store after applying ``incoming`` (seq >= 1 orders the batch).

    New ids are inserted; unresolved stored rows take incoming versions up to
    and including the first resolved one; resolved rows never change.
    ``cached_at`` is kept (``now`` for new ids); ``updated_at`` moves to
    ``now`` when any incoming version was applied. Null flags count as 0.
    """
    fields = _payload_fields(store, incoming)
    v = _versions(store, incoming, fields)
    row = F.struct(*fields, "resolved", "closed", "seq")
    first_res = F.when(F.col("resolved"), F.col("seq"))
    agg = v.groupBy("id").agg(
        F.min(first_res).alias("r"),
        F.min_by(row, first_res).alias("at_r"),
        F.max_by(row, "seq").alias("last"),
        F.count(F.when(F.col("seq") > 0, 1)).alias("n_in"),
        F.min(F.when(F.col("seq") > 0, F.col("seq"))).alias("min_in"),
        F.max("cached_at").alias("s_cached"),
        F.max("updated_at").alias("s_updated"),
    )
    win = F.coalesce(F.col("at_r"), F.col("last"))
    applied = (F.col("n_in") > 0) & (F.col("r").isNull() | (F.col("min_in") <= F.col("r")))
    now = F.lit(now_iso)
    return agg.select(
        "id", *[win[f].alias(f) for f in fields],
        win["resolved"].cast("int").alias("resolved"), win["closed"].cast("int").alias("closed"),
        F.coalesce("s_cached", now).alias("cached_at"),
        F.when(applied, now).otherwise(F.col("s_updated")).alias("updated_at"),
        win["seq"].alias("version_seq"),
    )


def market_merge_counts(store: DataFrame, incoming: DataFrame) -> DataFrame:
    """(inserted, updated, newly_resolved) of a merge.

    inserted = ids without a stored row; updated = applied incoming versions
    minus inserted; newly_resolved = incoming resolved versions whose id is
    not stored as resolved. Per-id facts come from one partial aggregate,
    joined back to the incoming rows on id (shuffle join, AQE splits a hot id).
    """
    per_id = (_versions(store, incoming, [])
              .groupBy("id").agg(F.min(F.when(F.col("resolved"), F.col("seq"))).alias("r"),
                                 F.max(F.when(F.col("seq") == 0, F.lit(1))).alias("stored"),
                                 F.max(F.when((F.col("seq") == 0) & F.col("resolved"), F.lit(1))).alias("stored_res"),
                                 F.min(F.when(F.col("seq") > 0, F.col("seq"))).alias("min_in")))
    inc = incoming.select("id", "seq", F.coalesce("resolved", F.lit(False)).alias("res"))
    j = inc.join(per_id, "id", "inner")
    applied = F.col("r").isNull() | (F.col("seq") <= F.col("r"))
    c = j.agg(
        F.count_if(applied).alias("applied"),
        F.count_if(F.col("stored").isNull() & (F.col("seq") == F.col("min_in"))).alias("inserted"),
        F.count_if(F.col("res") & F.col("stored_res").isNull()).alias("newly_resolved"))
    return c.select(F.col("inserted").cast("bigint"), (F.col("applied") - F.col("inserted")).cast("bigint").alias("updated"),
                    F.col("newly_resolved").cast("bigint"))


# ------------------------------------------------------------ C9, C10

def resolved_lookup(store: DataFrame) -> DataFrame:
    """Stored rows with resolved = 1 (select ``id`` for the id lookup).
    The flag may be stored as 0/1 or as a boolean."""
    return store.filter(F.col("resolved").cast("int") == 1)


def market_store_stats(store: DataFrame) -> DataFrame:
    """Total, resolved, closed-but-unresolved, active; zeros on an empty store."""
    return store.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("resolved") == 1).alias("resolved"),
        F.count_if((F.col("closed") == 1) & (F.col("resolved") == 0)).alias("closed_unresolved"),
        F.count_if(F.col("closed") == 0).alias("active"))
