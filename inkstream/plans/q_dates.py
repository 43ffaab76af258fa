"""Registered queries for the date functions (E1..E6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstream.functions import dates as D
from inkstream.plans.registry import register
from inkstream.sources import fixtures as fx
from inkstream.sources.tables import read_table

AS_OF_TS = "2024-07-26 12:00:00"
WINDOW_HOURS = 24


_MEANT = "CASE doc_id % {} {} END".format(len(fx.DATE_TEXTS), " ".join(
    f"WHEN {k} THEN '{v}'" for k, (_, v) in enumerate(fx.DATE_TEXTS) if v))


@register("parse_dates", "E1 E6", f"SELECT doc_id, substr({_MEANT}, 1, 10) AS published_at, {_MEANT} AS parsed_ts FROM documents")
def parse_dates(spark, sf_dir):
    d = fx.date_strings(spark, sf_dir)
    return d.select("doc_id", D.parse_date("raw_date").alias("published_at"),
                    F.date_format(D.parse_timestamp("raw_date"), "yyyy-MM-dd HH:mm:ss").alias("parsed_ts"))


@register("relative_minutes", "E3", fx.with_views(
    f"SELECT doc_id, {D.relative_minutes_sql('raw_delta')} AS minutes FROM date_strings", "date_strings"))
def relative_minutes(spark, sf_dir):
    d = fx.date_strings(spark, sf_dir)
    return d.select("doc_id", D.relative_minutes("raw_delta").alias("minutes"))


@register("relative_date", "E4 E2", fx.with_views(
    f"SELECT doc_id, {D.minutes_before_sql(AS_OF_TS, D.relative_minutes_sql('raw_delta'))} AS published_at "
    f"FROM date_strings", "date_strings"))
def relative_date(spark, sf_dir):
    d = fx.date_strings(spark, sf_dir)
    return d.select("doc_id", D.minutes_before(AS_OF_TS, D.relative_minutes("raw_delta")).alias("published_at"))


_ws, _we = D.window_pair_sql("ts", WINDOW_HOURS)


@register("time_window_pair", "E5", f"SELECT event_id, {_ws} AS window_start, {_we} AS window_end FROM events")
def time_window_pair(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", "event_id", "ts")
    start, end = D.window_pair("ts", WINDOW_HOURS)
    return e.select("event_id", start.alias("window_start"), end.alias("window_end"))
