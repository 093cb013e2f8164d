"""Prediction-market analytics as Spark DataFrame jobs.

Sub-packages:
  functions  -- Column-returning helpers (time, arithmetic, arrays)
  sources    -- scans, sinks, manifest, JDBC, adapter views over landed tables
  operators  -- decode, market lifecycle, backfill planning, order books,
                processing, filters, trailing rates
  plans      -- stage drivers that chain operators and write their outputs
  streaming  -- Structured Streaming ingest and windowed aggregates
"""

from oddsline.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
