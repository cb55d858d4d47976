"""The ledger is the same however often an epoch runs; windows take late rows."""

from datetime import datetime

from pyspark.sql import functions as F

from skysift.streaming.ingest import append_new, latest_windows, run_ledger, run_windows


def test_ledger_is_replay_safe(spark, tmp_path):
    schema = "stream_name string, dedupe_key string, at long"
    one = spark.createDataFrame([("s", "a", 2), ("s", "a", 1), ("s", "b", 5)], schema)
    two = spark.createDataFrame([("s", "b", 1), ("s", "c", 9), ("s", "dead", 1)], schema)
    dead = spark.createDataFrame([("s", "dead")], "stream_name string, dedupe_key string")
    path = str(tmp_path / "ledger")
    for _ in range(2):
        for epoch, batch in enumerate((one, two)):
            append_new(batch, epoch, path, ["stream_name", "dedupe_key"], ["at"], dead)
    assert sorted((r.dedupe_key, r.at) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 5), ("c", 9)]


def test_streams_drain_and_resume(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    rows = spark.createDataFrame([("s", "a", datetime(2021, 1, 1, 1, 5)), ("s", "a", datetime(2021, 1, 1, 1, 9))], "stream_name string, dedupe_key string, at timestamp")
    rows.write.parquet(str(src))
    read = lambda: spark.readStream.schema(rows.schema).parquet(str(src))
    for _ in range(2):
        run_ledger(read(), f"{out}/ledger", f"{out}/c1", ["stream_name", "dedupe_key"], ["at"])
        run_windows(read(), "at", "stream_name", f"{out}/windows", f"{out}/c2")
        rows.withColumn("dedupe_key", F.lit("late")).write.mode("append").parquet(str(src))
    assert {r.dedupe_key for r in spark.read.parquet(f"{out}/ledger").collect()} == {"a", "late"}
    assert [r.n for r in latest_windows(spark, f"{out}/windows", "stream_name").collect()] == [4]
