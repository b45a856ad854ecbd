"""fillbook: prediction-market trade analytics as plain Spark DataFrame functions.

Every public function takes and returns DataFrames (or Columns), so the same
code runs in batch jobs and inside Structured Streaming ``foreachBatch``.
"""

__version__ = "0.1.0"
