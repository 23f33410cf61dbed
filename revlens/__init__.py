"""revlens: sales and revenue analytics on Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` function (usable with
``DataFrame.transform``) built from built-in Spark SQL expressions, so that
Catalyst prunes columns, pushes filters into the scan and plans partial
aggregation. No Python UDF sits on a hot path.

Layout
------
``revlens.functions``   scalar column expressions (lenient parsing, rounding, ratios)
``revlens.sources``     CSV/Parquet scans, column checks, sinks, snapshots, test views
``revlens.operators``   cleaning, joins, aggregates, pivots, windows, versions, reports
``revlens.streaming``   incremental late-data report on the streaming file source
``revlens.plans``       the registered queries and their SQL oracles
"""

__version__ = "0.1.0"
