"""ledgerlens — consumer-credit portfolio analytics expressed as Spark DataFrame jobs.

Layers:
  sources/    readers (CSV / Parquet landing, portfolio derived from order tables), sinks
  functions/  Column builders: domain encodings and exact decimal rounding
  operators/  unpivot, wide-row features, data-quality audits, distributed positions, segments
  plans/      mart build + the report catalogue (risk, collections, KPI, EDA)
  streaming/  incremental landing -> mart load with Structured Streaming
"""

__version__ = "0.1.0"
