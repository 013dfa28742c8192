"""Payment analytics on Spark: totals, calendar reports, settlement and routing as DataFrames."""

__version__ = "0.1.0"
