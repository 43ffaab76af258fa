"""File sources and sinks.

Readers always pass an explicit schema (no inference pass over the data). Writers use Spark's
committers, so a lost executor's half-written files never become visible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Edge white space is kept; NULL is written as \\N, so it stays apart from an empty string.
CSV_OPTIONS = {"header": "true", "quoteAll": "true", "escape": '"', "multiLine": "true", "nullValue": "\\N",
               "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K9: CSV export with a header row, every field quoted, quotes doubled."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header and multi-line quoted fields, read with an explicit schema."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line."""
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = False) -> DataFrame:
    """JSON lines (or one JSON array per file with ``multiline``), explicit schema."""
    return spark.read.schema(schema).option("multiLine", str(multiline).lower()).json(path)


def write_text_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Text dump, one serialised record per line."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode(mode).text(path)


def read_text_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    t = spark.read.text(path)
    return t.select(F.from_json("value", schema).alias("r")).select("r.*")


def append_partitioned(df: DataFrame, path: str, partition_col: str, mode: str = "append") -> None:
    """Bulk insert into a table partitioned by ``partition_col`` (``mode='overwrite'`` =
    drop and recreate). Rows are rebalanced by that column first, so a partition gets few files and
    a hot one is split."""
    df = df.hint("rebalance", partition_col)
    df.write.mode(mode).partitionBy(partition_col).parquet(path)
