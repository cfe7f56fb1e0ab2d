"""tierforge: layered (bronze / silver / gold) analytics on Spark DataFrames.

Sub-packages
------------
sources     table readers, source fixtures and the versioned table store
functions   column expressions (parsing, calendar parts, surrogate keys)
operators   reusable DataFrame operators: incremental load, merge, dedup,
            SCD2 history, calendars, data-quality checks, run-log analytics
plans       the two model families (TPC-H sales, online-retail orders) as
            pure functions of DataFrames, plus the day-by-day runner
streaming   Structured Streaming driver for the incremental models
"""

__version__ = "0.1.0"
