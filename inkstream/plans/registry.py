"""Registry of named queries: key -> (Spark builder, DuckDB oracle SQL or None).

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame. The oracle SQL runs on DuckDB over
the same Parquet tables (views named after the tables) and must return the same rows and column
names. Keys with ``sql=None`` get a rows-only check plus their own tests.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    key: str
    build: Builder
    sql: str | None
    ids: str  # inventory ids covered (SURVEY §2)


REGISTRY: dict[str, Entry] = {}


def register(key: str, ids: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key!r}")
        REGISTRY[key] = Entry(key, fn, sql, ids)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # Importing the plan modules fills REGISTRY.
    from inkstream.plans import (  # noqa: F401
        q_text, q_dates, q_ingest, q_chunks, q_search, q_tables, q_dataset, q_explore, q_stream,
    )
    return REGISTRY
