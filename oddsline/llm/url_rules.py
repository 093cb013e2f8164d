"""Op 2. URL filters: a sort-merge range join of hosts against nested rules.

A host's key is its labels in reverse, each ended by U+0001, so a rule's host
and all its subdomains are one interval of keys: from the key itself up to the
key with its last mark raised to U+0002. Such intervals nest or lie apart.
Walking over the sorted interval ends, the stack of rules whose interval is
open changes only there; the stack after each end follows from the rules
alone (a rule's ancestors). The sweep: urls and interval ends are sorted
together by key, and every url takes the last stack before it, from which the
longest rule whose path prefix fits decides.

Urls are dealt to sweeps by hash, not by host, so a hot host is spread evenly;
every sweep gets all interval ends (two rows per rule host). All of it is
DataFrame operations: one shuffle, one sort, one window.

Defined cases: a url that is null or has no ``://`` has empty host and path
and no rule; without a fitting rule the verdict is ``default``; of equally
long rules the longer host wins, then block over allow; repeated rows are
judged each for itself; an empty rule list gives every url the default; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oddsline.llm.common import bucket, partitions

RULE = "array<struct<host:string,path:string,verdict:string>>"
OPEN, CLOSED = "\x01", "\x02"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def reversed_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]")), OPEN), F.lit(OPEN))


def interval_ends(rules: DataFrame) -> DataFrame:
    """(key, stack): the rules that are open from this key on, for each end of a rule host's interval."""
    hosts = rules.groupBy("host").agg(F.collect_list(F.struct("host", "path", "verdict")).alias("own"))
    labels = F.split("host", "[.]")
    ancestors = hosts.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))).alias("up"))
    found = ancestors.join(hosts.select(F.col("host").alias("up"), "own"), "up")
    stacks = found.groupBy("host").agg(
        F.flatten(F.collect_list("own")).alias("inside"),
        F.flatten(F.collect_list(F.when(F.col("up") != F.col("host"), F.col("own")))).alias("outside"))
    key = reversed_key(F.col("host"))
    after = F.concat(F.substr(key, F.lit(1), F.length(key) - 1), F.lit(CLOSED))
    return stacks.select(key.alias("key"), F.col("inside").alias("stack")).union(
        stacks.select(after.alias("key"), F.col("outside").alias("stack")))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
          url_col: str = "url", sweeps: int | None = None) -> DataFrame:
    """page_id, host, path, rule (like ``net/``, null if none fits), verdict of every url.

    ``rules``: (host, path, verdict); a rule list is configuration, repeated
    in each of the ``sweeps`` (by default eight per shuffle partition).
    """
    sweeps = sweeps or 8 * partitions(pages.sparkSession)
    url = F.col(url_col).cast("string")
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    urls = urls.withColumn("sweep", bucket(sweeps, "page_id", "host", "path")).select(
        "sweep", reversed_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "page_id", "host", "path",
        F.lit(None).cast(RULE).alias("stack"))
    ends = interval_ends(rules).select(
        F.explode(F.sequence(F.lit(0), F.lit(sweeps - 1))).alias("sweep"), "key", F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("page_id"), F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"), F.col("stack").cast(RULE).alias("stack"))
    sweep = Window.partitionBy("sweep").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = urls.union(ends).withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    fits = F.filter("open", lambda r: ((F.col("host") == r.host) | F.col("host").endswith(F.concat(F.lit("."), r.host)))
                    & F.col("path").startswith(r.path))
    best = F.array_max(F.transform(fits, lambda r: F.struct(
        (F.length(r.host) + F.length(r.path)).alias("length"), F.length(r.host).alias("host_length"),
        r.verdict.alias("verdict"), F.concat(r.host, r.path).alias("rule"))))
    return swept.withColumn("best", best).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
