"""Trailing request rates (H1-H2): how many requests of the same limiter fall
in [t - window, t] at each request time t, as a rate and as a share of quota.

Scale: requests are first pre-aggregated to one row per (limiter, ms), before
any shuffle -- a hot limiter collapses to at most one row per millisecond. A
millisecond's count is then sent to its own time bucket of one window length,
where it enters, and, by the same pass, to the next one, where it leaves. A
millisecond lies at the same place of the bucket in both, so the window's sum
is the bucket's running sum plus all of the bucket before: one step a row,
where a sliding frame adds up the whole window again at every row. A window
partition holds at most two windows' worth of distinct milliseconds whatever
the data size, and the counts go back to the requests by (limiter, ms). The
requests are read twice: their two narrow columns for the counts, and whole
for the answer, since neither the whole requests of a hot window nor those of
a hot millisecond may be gathered in one window partition.

Null limiters are a limiter of their own; requests at a null time count the
requests at a null time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Limiter quotas (requests per 10 s window) by name.
DEFAULT_WINDOW_SECONDS = 10
QUOTAS = {"markets": 120, "books": 1000, "trades": 190}


def trailing_counts(requests: DataFrame, window_seconds: float = DEFAULT_WINDOW_SECONDS,
                    key: str = "limiter", t_col: str = "t") -> DataFrame:
    """(limiter, t, n_at_t, window_count) for every distinct request time."""
    w_ms = int(window_seconds * 1000)
    per_ms = requests.groupBy(key, t_col).agg(F.count(F.lit(1)).alias("n_at_t"))
    bucket = F.floor(F.col(t_col) / w_ms).cast("bigint")
    copies = F.when(F.col(t_col).isNull(), F.array(bucket)).otherwise(F.array(bucket, bucket + 1))
    placed = per_ms.select("*", F.posexplode(copies).alias("_copy", "_bucket"))
    in_bucket = Window.partitionBy(key, "_bucket")
    # At equal places the entering copy comes first: the window's lower edge is inclusive.
    upto = in_bucket.orderBy(F.pmod(F.col(t_col), F.lit(w_ms)), "_copy").rowsBetween(Window.unboundedPreceding, 0)
    enters = F.when(F.col("_copy") == 0, F.col("n_at_t")).otherwise(-F.col("n_at_t"))
    before = F.when(F.col("_copy") == 1, F.col("n_at_t")).otherwise(0)
    return (placed.withColumn("window_count", F.sum(enters).over(upto) + F.sum(before).over(in_bucket))
            .where(F.col("_copy") == 0).drop("_copy", "_bucket"))


def trailing_rate(requests: DataFrame, window_seconds: float = DEFAULT_WINDOW_SECONDS,
                  key: str = "limiter", t_col: str = "t") -> DataFrame:
    """H1: per request, requests in the trailing window and their rate per second."""
    c = trailing_counts(requests, window_seconds, key, t_col).drop("n_at_t")
    c = c.withColumnsRenamed({key: "_key", t_col: "_t"})
    out = requests.join(c, F.col(key).eqNullSafe(F.col("_key")) & F.col(t_col).eqNullSafe(F.col("_t")), "left")
    out = out.drop("_key", "_t")
    return out.withColumn("rps", F.col("window_count") / F.lit(float(window_seconds)))


def quota_utilization(requests: DataFrame, quotas: dict[str, int], window_seconds: float = DEFAULT_WINDOW_SECONDS,
                      key: str = "limiter", t_col: str = "t") -> DataFrame:
    """H2: per request, window count and its percent of the limiter's quota."""
    q = F.create_map(*[x for k, v in quotas.items() for x in (F.lit(k), F.lit(int(v)))])
    r = trailing_rate(requests, window_seconds, key, t_col)
    quota = q[F.col(key)]
    return r.withColumn("max_requests", quota).withColumn(
        "utilization_pct", F.col("window_count") / quota * 100.0)
