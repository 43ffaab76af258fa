"""inkstream: news-text analytics as plain Spark DataFrame / SQL / Structured Streaming jobs.

Sub-packages:
  sources    readers (parquet tables, derived fixture views, HTML, files, message feeds)
  functions  column-expression libraries (text cleaning, dates)
  operators  table operators (chunking, embedding, search, keyed tables, datasets, profiling)
  streaming  Structured Streaming flows (queue source, change capture, feature flow)
  plans      the registry of named queries and their DuckDB oracle SQL
"""

__version__ = "0.1.0"
