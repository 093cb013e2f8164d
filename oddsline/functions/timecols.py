"""Epoch-millisecond helpers. All return Columns and stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from oddsline.schemas import MS_PER_DAY, MS_PER_SECOND

# The accepted range for millisecond timestamps given as text
# (2020-01-01T00:00:00Z .. 2040-01-01T00:00:00Z); numbers below SECONDS_LIMIT are seconds.
MIN_VALID_TIMESTAMP_MS = 1577836800000
MAX_VALID_TIMESTAMP_MS = 2208988800000
SECONDS_LIMIT = 10_000_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_ms(ts) -> Column:
    """Epoch ms of a timestamp column; TIMESTAMP_NTZ is read as UTC wall time."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def day_bucket(t, unit_ms: int = MS_PER_DAY) -> Column:
    """Floor of ``t`` to its UTC day (floor, not truncation, for negative t)."""
    t = _c(t).cast("bigint")
    return t - F.pmod(t, F.lit(unit_ms))


def iso_to_ms(s) -> Column:
    """Lenient ISO-8601 text -> epoch ms; empty, null or unparseable -> null.

    A trailing ``Z`` means UTC; text without a zone is read in the session
    zone (UTC).
    """
    s = F.trim(_c(s))
    dated = s.rlike(r"^[+-]?\d{4,}-\d{2}-\d{2}([T ]|$)")  # else a bare time would be taken as today's
    return F.unix_millis(F.try_to_timestamp(F.when(dated, s)))


def iso_to_ms_strict(s) -> Column:
    """Strict form: unparseable non-empty text raises; empty/null -> null."""
    s = _c(s)
    clean = F.nullif(F.trim(s), F.lit(""))
    parsed = iso_to_ms(s)
    return F.when(clean.isNull(), F.lit(None).cast("bigint")).when(
        parsed.isNull(), F.raise_error(F.concat(F.lit("invalid ISO timestamp: "), s)).cast("bigint")
    ).otherwise(parsed)


def ms_to_iso(ms) -> Column:
    """Epoch ms -> ISO text in UTC, ``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00``.

    Fractional seconds appear only when the millisecond part is non-zero.
    """
    ms = _c(ms).cast("bigint")
    base = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.pmod(ms, F.lit(MS_PER_SECOND))
    micros = F.lpad((frac * 1000).cast("string"), 6, "0")
    return F.concat(base, F.when(frac == 0, F.lit("")).otherwise(F.concat(F.lit("."), micros)),
                    F.lit("+00:00"))


def ms_to_timestamp(ms) -> Column:
    return F.timestamp_millis(_c(ms).cast("bigint"))


def lookback_start_ms(as_of_ms: int | Column, minutes: int = 0, hours: int = 0, days: int = 0,
                      weeks: int = 0, months: int = 0, years: int = 0) -> Column:
    """Start of a look-back window ending at ``as_of_ms``.

    Months move by calendar month (Spark clamps 31 March - 1 month to the end
    of February); weeks are 7 days and years 365 days of fixed length.
    """
    as_of = F.lit(as_of_ms) if isinstance(as_of_ms, int) else as_of_ms
    ts = F.timestamp_millis(as_of)
    if months > 0:
        ts = ts - F.make_ym_interval(F.lit(0), F.lit(months))
    fixed_ms = (((days + weeks * 7 + years * 365) * 24 + hours) * 60 + minutes) * 60 * MS_PER_SECOND
    return F.unix_millis(ts) - F.lit(fixed_ms)


def date_start_ms(d: str) -> int:
    """Midnight UTC of a ``YYYY-MM-DD`` date as epoch ms (a driver-side constant)."""
    import datetime as _dt

    day = _dt.date.fromisoformat(d)
    return int(_dt.datetime(day.year, day.month, day.day, tzinfo=_dt.timezone.utc).timestamp() * 1000)
