"""Keyed state of streams: newest version per key, first rows within a watermark."""

import pyarrow as pa
from pyspark.sql import functions as F

from inkstream.session import fresh_path
from inkstream.streaming.state import NewestVersion, _best_of_batch, first_within, newest_versions, start_keyed

SCHEMA = "key string, seq long, then string, value string"


def run(spark, landing, out, ckpt, changes):
    writer = (changes.writeStream.outputMode("update").option("checkpointLocation", ckpt).trigger(availableNow=True)
              .foreachBatch(lambda df, b: df.write.mode("overwrite").parquet(f"{out}/b={b}")))
    q = start_keyed(spark, writer.start, 2)
    q.awaitTermination()


def test_changes_of_odd_versions_over_restarts(spark):
    parts = [[("a", 1, "x", "a1"), ("a", 3, "x", "a3"), ("a", 2, "z", "a2"), (None, 5, "x", "n5"), ("b", None, None, "b-")],
             [("a", 3, "x", "again"), ("a", 3, "y", "a3y"), ("b", None, "k", "bk"), ("c", 1, None, "c1")],
             [("a", 3, "x", "again"), ("a", 3, "y", "a3y"), ("b", None, "k", "bk"), ("c", 1, None, "c1")],      # replayed
             [("hot", i, "h", f"h{i}") for i in range(500)] + [("b", 0, None, "b0"), (None, 4, "x", "old")]]
    landing, out, ckpt = (fresh_path(spark, n) for n in ("t-state-in", "t-state-out", "t-state-ckpt"))
    for part in parts:
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(landing)
        run(spark, landing, out, ckpt, newest_versions(spark.readStream.schema(SCHEMA).parquet(landing), ["key"], "seq", "then"))
    got = {(r.b, r.value) for r in spark.read.parquet(out).collect()}
    assert got == {(0, "a3"), (0, "n5"), (0, "b-"), (1, "a3y"), (1, "bk"), (1, "c1"), (3, "h499"), (3, "b0")}


def test_best_of_a_batch_keeps_one_row_per_key():
    batch = pa.RecordBatch.from_pylist([{"t": t, "k": k, "s": s, "e": e} for t, k, s, e in [
        ("x", "a", 1, "p"), ("x", "a", 2, "p"), ("y", "a", 1, "p"), ("x", None, None, None), ("x", None, 1, None),
        ("x", "a", 2, "q"), ("y", None, 7, "r")]])
    got = pa.Table.from_batches(_best_of_batch(["t", "k"], "s", "e")([batch, batch.slice(0, 0)])).to_pylist()
    assert [(r["t"], r["k"], r["s"], r["e"]) for r in got] == [("y", "a", 1, "p"), ("x", None, 1, None), ("x", "a", 2, "q"), ("y", None, 7, "r")]
    assert NewestVersion._order(None, "z") < NewestVersion._order(-5, None) < NewestVersion._order(-5, "")


def test_session_settings_are_restored(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")}
    assert start_keyed(spark, lambda: spark.conf.get("spark.sql.shuffle.partitions"), 3) == "3"
    assert before == {k: spark.conf.get(k, None) for k in before}


def test_repeats_leave_once_and_late_rows_are_dropped(spark):
    landing, out, ckpt = (fresh_path(spark, n) for n in ("t-mark-in", "t-mark-out", "t-mark-ckpt"))
    parts = [[("a", "2024-01-10"), ("a", "2024-01-11"), ("b", "2024-01-01"), ("c", "2024-01-20")],
             [("a", "2024-01-12"), ("b", "2024-01-21"), ("d", "2024-01-16"), ("e", "2024-01-15"), ("f", "2024-01-02")],
             [("c", "2024-01-21"), ("g", "2024-01-22")]]
    for part in parts:
        spark.createDataFrame(part, "k string, d string").select("k", F.to_timestamp("d").alias("at")) \
            .coalesce(1).write.mode("append").parquet(landing)
        rows = spark.readStream.schema("k string, at timestamp").parquet(landing)
        q = (first_within(rows, ["k"], "at", "5 days").select("k").writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).trigger(availableNow=True))
        start_keyed(spark, q.start, 2).awaitTermination()
    # mark after the first part: 15 January. e and f are not after it; a's row of the second part is late too;
    # b was forgotten (1 + 5 days) and may come again; c is still known
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["a", "b", "b", "c", "d", "g"]


def test_the_state_of_versions_needs_no_python_unless_asked(spark):
    landing = fresh_path(spark, "t-native-in")
    spark.createDataFrame([("a", 1, "x", "a1")], SCHEMA).write.parquet(landing)
    plan = lambda **more: newest_versions(spark.readStream.schema(SCHEMA).parquet(landing), ["key"], "seq", "then", **more)._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan() and "MapInArrow" not in plan() and "TransformWithState" in plan(hold_rows=False)


def test_both_forms_of_the_state_let_the_same_changes_pass(spark):
    parts = [[("a", 1, "x", "a1"), ("b", None, None, "b-"), (None, 5, "x", "n5")], [("a", 1, "x", "again"), (None, 4, "z", "old")],
             [("a", 1, "y", "a1y"), ("b", None, "k", "bk"), (None, 5, "x", "again")]]
    for hold in (True, False):
        landing, out, ckpt = (fresh_path(spark, n) for n in ("t-forms-in", "t-forms-out", "t-forms-ckpt"))
        for part in parts:
            spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(landing)
            run(spark, landing, out, ckpt, newest_versions(spark.readStream.schema(SCHEMA).parquet(landing), ["key"], "seq", "then", hold))
        assert {(r.b, r.value) for r in spark.read.parquet(out).collect()} == {(0, "a1"), (0, "b-"), (0, "n5"), (2, "a1y"), (2, "bk")}
