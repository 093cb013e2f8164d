"""Join helpers. Join strategies are left to the planner and AQE."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LITERAL = 1000  # ids written into the plan as literals; a longer list is a table


def semi_by_values(df: DataFrame, column: str, values, keep: bool, max_literal: int = MAX_LITERAL,
                   spark=None) -> DataFrame:
    """Keep (``keep=True``) or drop rows whose ``column`` is in ``values``.

    Short lists become an ``isin`` that reaches the Parquet scan; long lists
    become a table and a semi / anti join. Null values of
    ``column`` are dropped either way, as ``not (null in (...))`` is null.
    """
    values = list(values)
    if len(values) <= max_literal:
        cond = F.col(column).isin(values)
        return df.filter(cond if keep else ~cond)
    spark = spark or df.sparkSession
    ids = spark.createDataFrame([(v,) for v in values], f"{column} string").distinct()
    how = "left_semi" if keep else "left_anti"
    return df.filter(F.col(column).isNotNull()).join(ids, column, how)
