"""Per-row operators on Structured Streaming DataFrames.

The reference has no stream processing. The column-expression operators
(projections, casts, flags, text cleaning, formatting, array maths) are plain
``Column`` expressions and run unchanged on a streaming DataFrame; operators
that need whole-table facts (factor levels, one-hot levels, z-scores, global
positions) do not, and are not offered here.
"""

from kiln.streaming.rowwise import stream_parquet, run_to_files  # noqa: F401
