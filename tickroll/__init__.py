"""tickroll: market time-series analytics on Spark DataFrames.

Candle rollups, incremental candle ingest, JSON payload mapping and keyed
table merges, all expressed as DataFrame / Structured Streaming operators.
"""

__version__ = "0.1.0"
