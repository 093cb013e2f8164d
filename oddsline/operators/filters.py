"""Row filters over joined prices and jump detection.

Row predicates are plain Column comparisons, so Catalyst pushes them into
the Parquet scan. They must be applied *below* the jump window (they change
which row is "previous"), and the jump thresholds above it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from oddsline.functions.mathcols import ieee_divide
from oddsline.functions.timecols import date_start_ms
from oddsline.operators.joins import MAX_LITERAL, semi_by_values
from oddsline.schemas import MS_PER_DAY

JUMP_COLUMNS = ("jump_abs", "jump_pct")


@dataclass
class FilterConfig:
    start_date: str | None = None        # YYYY-MM-DD, inclusive from 00:00 UTC
    end_date: str | None = None          # YYYY-MM-DD, inclusive to 23:59:59.999 UTC
    resolved_only: bool = False
    unresolved_only: bool = False
    min_age_days: int | None = None
    max_age_days: int | None = None
    as_of: str | None = None             # YYYY-MM-DD "today" for the age filters
    categories: list[str] | None = None
    exclude_categories: list[str] | None = None
    market_ids: list[str] | None = None
    exclude_market_ids: list[str] | None = None
    compute_jumps: bool = False
    min_jump_pct: float | None = None
    max_jump_pct: float | None = None
    min_jump_abs: float | None = None
    max_jump_abs: float | None = None
    applied: list[str] = field(default_factory=list, repr=False)

    def __post_init__(self):
        if self.resolved_only and self.unresolved_only:
            raise ValueError("resolved_only and unresolved_only are mutually exclusive")

    def needs_jumps(self) -> bool:
        return self.compute_jumps or any(getattr(self, r.option) is not None for r in RULES if r.on == "jump")


# ------------------------------------------------------------------ G1-G5

def age_cutoff_text(as_of: str | None, days: int) -> str:
    """Midnight of ``as_of`` minus ``days``, as ``YYYY-MM-DDTHH:MM:SS`` text."""
    if as_of is None:
        raise ValueError("age filters need an explicit as_of date")
    d = _dt.date.fromisoformat(as_of) - _dt.timedelta(days=days)
    return f"{d.isoformat()}T00:00:00"


DAY_PARTITION = "day"  # yyyy-MM-dd UTC partition column of day-partitioned price tables


@dataclass(frozen=True)
class Rule:
    """One option of a FilterConfig: it compares ``column`` with a bound worked out
    from the option's value, and is left out where the column is absent."""
    option: str
    column: str
    compare: str
    label: str | None                       # text of the report; None: no entry of its own
    bound: Callable = lambda value, cfg: value
    on: str = "filter"                      # "filter" (below the jump window) or "jump" (above it)


COMPARE = {
    "at least": lambda c, bound: c >= F.lit(bound),
    "at most": lambda c, bound: c <= F.lit(bound),
    "is": lambda c, bound: c == F.lit(bound),
    "in": lambda c, bound: c.isin(list(bound)),
    "not in": lambda c, bound: ~c.isin(list(bound)),
    "size at least": lambda c, bound: F.abs(c) >= F.lit(bound),
    "size at most": lambda c, bound: F.abs(c) <= F.lit(bound),
}

# The option names, and the texts that the report shows for them.
RULES = [
    Rule("start_date", "t", "at least", "{option}>={value}", lambda v, _: date_start_ms(v)),
    Rule("end_date", "t", "at most", "{option}<={value}", lambda v, _: date_start_ms(v) + MS_PER_DAY - 1),
    # On a day-partitioned table the dates prune whole folders; ``t`` keeps the exact bounds.
    Rule("start_date", DAY_PARTITION, "at least", None),
    Rule("end_date", DAY_PARTITION, "at most", None),
    Rule("resolved_only", "resolved", "is", "{option}"),
    Rule("unresolved_only", "resolved", "is", "{option}", lambda _, __: False),
    # created_at is compared as text.
    Rule("min_age_days", "created_at", "at most", "{option}>={value}", lambda v, cfg: age_cutoff_text(cfg.as_of, v)),
    Rule("max_age_days", "created_at", "at least", "{option}<={value}", lambda v, cfg: age_cutoff_text(cfg.as_of, v)),
    Rule("categories", "category", "in", "{option}={value}"),
    Rule("exclude_categories", "category", "not in", "{option}={value}"),
    Rule("market_ids", "market_id", "in", "{option}={count} ids"),
    Rule("exclude_market_ids", "market_id", "not in", "{option}={count} ids"),
    Rule("min_jump_pct", "jump_pct", "size at least", "{option}>={value}", on="jump"),
    Rule("max_jump_pct", "jump_pct", "size at most", "{option}<={value}", on="jump"),
    Rule("min_jump_abs", "jump_abs", "size at least", "{option}>={value}", on="jump"),
    Rule("max_jump_abs", "jump_abs", "size at most", "{option}<={value}", on="jump"),
]


def predicates(columns, cfg: FilterConfig, on: str, max_literal: int | None = MAX_LITERAL) -> list[tuple[Column | None, str | None]]:
    """The set options' (predicate, label) in the order of RULES.

    A list of more than ``max_literal`` ids has a label but no predicate:
    ``apply_filters`` joins it.
    """
    def one(rule: Rule) -> tuple[Column | None, str | None]:
        value = getattr(cfg, rule.option)
        listed = isinstance(value, (list, tuple))
        label = rule.label and rule.label.format(option=rule.option, value=list(value) if listed else value,
                                                 count=len(value) if listed else 1)
        long = listed and rule.column == "market_id" and max_literal is not None and len(value) > max_literal
        return (None if long else COMPARE[rule.compare](F.col(rule.column), rule.bound(value, cfg))), label

    def is_set(value) -> bool:
        return value is not None and value is not False and value != []

    return [one(r) for r in RULES if r.on == on and r.column in set(columns) and is_set(getattr(cfg, r.option))]


def apply_filters(df: DataFrame, cfg: FilterConfig) -> tuple[DataFrame, list[str]]:
    """AND of the applicable predicates (G6); none -> the input unchanged."""
    preds = predicates(df.columns, cfg, "filter")
    if not preds:
        return df, []
    shown = [p for p, label in preds if p is not None]
    out = df.filter(reduce(lambda a, b: a & b, shown)) if shown else df
    if "market_id" in df.columns:  # long id lists are tables, not literals
        for ids, keep in ((cfg.market_ids, True), (cfg.exclude_market_ids, False)):
            if ids and len(ids) > MAX_LITERAL:
                out = semi_by_values(out, "market_id", ids, keep)
    return out, [label for _, label in preds if label]


def filter_date_range(df, start_date=None, end_date=None):
    return apply_filters(df, FilterConfig(start_date=start_date, end_date=end_date))[0]


def filter_resolved(df, resolved: bool = True):
    cfg = FilterConfig(resolved_only=resolved, unresolved_only=not resolved)
    return apply_filters(df, cfg)[0]


def filter_market_age(df, as_of: str, min_age_days=None, max_age_days=None):
    return apply_filters(df, FilterConfig(as_of=as_of, min_age_days=min_age_days, max_age_days=max_age_days))[0]


def filter_category(df, include=None, exclude=None):
    return apply_filters(df, FilterConfig(categories=include, exclude_categories=exclude))[0]


def filter_market_ids(df, include=None, exclude=None, max_literal: int = MAX_LITERAL):
    """Market-id lists; long lists go through a semi/anti join."""
    if "market_id" not in df.columns:
        return df
    if include:
        df = semi_by_values(df, "market_id", include, keep=True, max_literal=max_literal)
    if exclude:
        df = semi_by_values(df, "market_id", exclude, keep=False, max_literal=max_literal)
    return df


# ------------------------------------------------------------------ G7-G9

DEFAULT_JUMP_BUCKET_MS = 60_000  # window partitions are (token, minute of t)


def _bucketed_previous(df: DataFrame, keys: list[str], tie: str, bucket_ms: int) -> DataFrame:
    """Add ``_prev_p``, the price of the previous row of ``keys`` in (t, tie) order, in one pass.

    Inside a (keys, bucket of t) the previous row is the window's. Only the
    bucket's first row needs a row from elsewhere, and only its last row is
    needed elsewhere: these two go on to a window per ``keys`` (at most two
    rows a bucket, so its length is bounded by time, not by rows), while the
    rows between them stay dealt by bucket and pass through.
    """
    inside = Window.partitionBy(*keys, "_bucket").orderBy("t", tie)
    rows = (df.withColumn("_bucket", F.floor(F.col("t") / F.lit(bucket_ms)))
            .withColumn("_prev_p", F.lag("p").over(inside))
            .withColumn("_first", F.row_number().over(inside) == 1)
            .withColumn("_edge", F.col("_first") | F.lead(F.lit(True)).over(inside).isNull()))
    across = Window.partitionBy(*keys, "_edge", F.when(~F.col("_edge"), F.col("_bucket"))).orderBy("t", tie, ~F.col("_first"))
    return rows.withColumn("_prev_p", F.when(F.col("_first"), F.lag("p").over(across)).otherwise(F.col("_prev_p"))) \
        .drop("_bucket", "_first", "_edge")


def compute_jumps(df: DataFrame, tie_break: str | None = None,
                  bucket_ms: int | None = DEFAULT_JUMP_BUCKET_MS, mode: str = "bucket",
                  within: tuple[str, ...] = ()) -> DataFrame:
    """Change from the previous row per token in time order (no filling).

    ``jump_pct`` divides by the previous price with float semantics. A tie
    on (token_id, t) is ordered by ``tie_break`` (default: p) so that the
    result is deterministic. Rows that differ in a column of ``within`` never
    are each other's previous row.

    Skew: a plain ``lag`` over ``partitionBy(token_id)`` puts a hot token in
    one task. Three plans:

    * ``mode="range"``: the previous row over a global
      range-partitioned order (``ordering.previous_values``); balanced
      whatever the skew, even a hot instant. ``within`` is not offered.
    * ``mode="bucket"`` (default): windows over (token, ``bucket_ms`` bucket
      of t), whose edge rows are stitched by a second window
      (``_bucketed_previous``): the input is read once and nothing is joined.
      A hot token and a hot hour are split by time; a hot bucket is not.
    * ``mode="window"``: the single per-token window.
    """
    if not {"token_id", "t", "p"} <= set(df.columns):
        raise ValueError(f"cannot compute jumps: need token_id, t, p; found {df.columns}")
    tie, keys = tie_break or "p", ["token_id", *within]

    if mode == "window" or (mode == "bucket" and bucket_ms is None):
        out = df.withColumn("_prev_p", F.lag("p").over(Window.partitionBy(*keys).orderBy("t", tie)))
    elif mode == "range":
        from oddsline.operators.ordering import previous_values

        if within:
            raise ValueError("mode 'range' has no further group columns")
        order = ["t"] if tie == "p" else ["t", tie]
        out = previous_values(df, "token_id", order + (["p"] if tie == "p" else []), ["p"], prefix="_prev_")
    elif mode == "bucket":
        out = _bucketed_previous(df, keys, tie, bucket_ms)
    else:
        raise ValueError(f"unknown jump mode {mode!r}")
    diff = F.col("p") - F.col("_prev_p")
    return (out.withColumn("jump_abs", diff).withColumn("jump_pct", ieee_divide(diff, F.col("_prev_p")))
            .drop("_prev_p"))


def filter_jumps(df: DataFrame, cfg: FilterConfig, tie_break: str | None = None) -> tuple[DataFrame, list[str]]:
    """Jump computation (when any jump option is set) and thresholds.

    Rows whose jump is null fail every threshold. Helper columns are dropped
    unless ``compute_jumps`` asks to keep them.
    """
    if not cfg.needs_jumps():
        return df, []
    out = compute_jumps(df, tie_break)
    preds = predicates(JUMP_COLUMNS, cfg, "jump")
    if preds:
        out = out.filter(reduce(lambda a, b: a & b, [p for p, _ in preds]))
    if not cfg.compute_jumps:
        out = out.drop(*JUMP_COLUMNS)
    return out, [label for _, label in preds]


# ------------------------------------------------------------------ G10

@dataclass
class FilterResult:
    frame: DataFrame
    applied: list[str]
    source: DataFrame
    output_obs: Observation

    def report(self) -> dict:
        """Counts; valid once the frame has been written. The input is counted
        by itself (from the footers, for Parquet), so that the filters reach
        its scan."""
        n_in = self.source.count()
        n_out = self.output_obs.get.get("rows", 0)
        return {"input_count": n_in, "output_count": n_out, "rows_removed": n_in - n_out,
                "filters_applied": list(self.applied)}


def run_filter(df: DataFrame, cfg: FilterConfig, tie_break: str | None = None) -> FilterResult:
    """Row filters, then jumps and thresholds; the output count is observed in the same pass."""
    obs_out = Observation("filter_output")
    filtered, applied = apply_filters(df, cfg)
    filtered, jump_applied = filter_jumps(filtered, cfg, tie_break)
    out = filtered.observe(obs_out, F.count(F.lit(1)).alias("rows"))
    return FilterResult(out, applied + jump_applied, df, obs_out)


def filter_report_frame(df: DataFrame, cfg: FilterConfig, tie_break: str | None = None) -> DataFrame:
    """The report as a one-row DataFrame computed by one aggregate.

    Rows are tagged as kept or not instead of being filtered, so input and
    output counts come from one scan. Dropped rows go through the jump windows
    in groups of their own (narrow: keys, time and price only).
    """
    preds = predicates(df.columns, cfg, "filter", max_literal=None)
    keep = reduce(lambda a, b: a & b, [p for p, _ in preds]) if preds else F.lit(True)
    labels = [lbl for _, lbl in preds if lbl]
    tagged = df.withColumn("_keep", F.coalesce(keep, F.lit(False)))
    jumps = predicates(JUMP_COLUMNS, cfg, "jump")
    if jumps:
        labels += [lbl for _, lbl in jumps]
        passed = reduce(lambda a, b: a & b, [p for p, _ in jumps])
        tagged = compute_jumps(tagged, tie_break, within=("_keep",)).withColumn(
            "_keep", F.col("_keep") & F.coalesce(passed, F.lit(False)))
    rep = tagged.agg(F.count(F.lit(1)).alias("input_count"),
                     F.count_if(F.col("_keep")).alias("output_count"))
    return rep.select(
        "input_count", "output_count", (F.col("input_count") - F.col("output_count")).alias("rows_removed"),
        F.lit(";".join(labels)).alias("filters_applied"))
