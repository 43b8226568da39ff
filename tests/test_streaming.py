from tablework.session import scratch_dir
from tablework.sinks.tables import write_table
from tablework.streaming.copy import stream_copy, stream_counts, stream_to_memory
from tests.conftest import rows


def test_second_run_copies_only_new_rows(spark, db):
    checkpoint = scratch_dir(spark, "cp")
    write_table(spark.range(5), f"{db}.src")
    stream_copy(spark, f"{db}.src", checkpoint, f"{db}.dst")
    stream_copy(spark, f"{db}.src", checkpoint, f"{db}.dst")
    assert spark.table(f"{db}.dst").count() == 5
    write_table(spark.range(5, 8), f"{db}.src", "append")
    stream_copy(spark, f"{db}.src", checkpoint, f"{db}.dst")
    assert rows(spark.table(f"{db}.dst")) == [(i,) for i in range(8)]


def test_running_counts(spark, db):
    checkpoint = scratch_dir(spark, "cp")
    for lo in (0, 10):
        write_table(spark.range(lo, lo + 10).selectExpr("id % 3 AS k"), f"{db}.src", "append")
        stream_counts(spark, f"{db}.src", ["k"], f"{db}.counts", checkpoint)
    assert rows(spark.table(f"{db}.counts")) == [(0, 7), (1, 7), (2, 6)]


def test_interval_path_and_memory(spark, db):
    write_table(spark.range(5), f"{db}.src")
    path = scratch_dir(spark, "sink")
    q = stream_copy(spark, f"{db}.src", scratch_dir(spark, "cp"), path=path, interval="1 second")
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(path).count() == 5
    assert spark.table(stream_to_memory(spark.readStream.table(f"{db}.src"))).count() == 5
