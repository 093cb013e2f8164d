"""Presentation step applied to registered query results before checking.

Doubles are rounded to 6 places (sum order differs between engines) and
non-finite doubles are split into a value (null) and a text kind column,
arrays are flattened to comma-joined text. The same step is written into
each oracle SQL string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def round6(c):
    """Round to DIGITS places as ``round(x * 10^d) / 10^d`` on the binary value.

    Spark's ``round(x, d)`` rounds the shortest decimal text of x, DuckDB's
    rounds the binary value; this form gives DuckDB's result exactly
    (checked on 50 000 values, halves included).
    """
    k = float(10 ** DIGITS)
    return F.round(c * F.lit(k)) / F.lit(k)


def rounded(df: DataFrame, kinds: tuple[str, ...] = ()) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in kinds:
            x = c
            kind = (F.when(x.isNull(), F.lit("null")).when(F.isnan(x), F.lit("nan"))
                    .when(x == float("inf"), F.lit("+inf")).when(x == float("-inf"), F.lit("-inf"))
                    .otherwise(F.lit("finite")))
            cols.append(F.when(kind == "finite", round6(x)).alias(f.name))
            cols.append(kind.alias(f"{f.name}_kind"))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round6(c).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            cols.append(F.when(c.isNotNull(), F.concat_ws(",", c.cast("array<string>"))).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def sql_kind(expr: str, name: str) -> str:
    """DuckDB text of the (value, kind) pair for a possibly non-finite double."""
    return (f"CASE WHEN isfinite({expr}) THEN round({expr}, {DIGITS}) END AS {name}, "
            f"CASE WHEN ({expr}) IS NULL THEN 'null' WHEN isnan({expr}) THEN 'nan' "
            f"WHEN ({expr}) = 'inf'::DOUBLE THEN '+inf' WHEN ({expr}) = '-inf'::DOUBLE THEN '-inf' "
            f"ELSE 'finite' END AS {name}_kind")


def r(expr: str, name: str) -> str:
    return f"round({expr}, {DIGITS}) AS {name}"
