"""Streams over files, drained once."""

import math

import pytest

from kinetrail.streaming import episodes


def drain(stream, name):
    query = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    return stream.sparkSession.table(name).collect()


@pytest.fixture
def source(spark, tmp_path):
    def make(rows, schema):
        path = str(tmp_path / "in")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        return spark.readStream.schema(schema).parquet(path)

    return make


def test_count_windows(source):
    stream = source([(1, i, float(i)) for i in range(20)] + [(2, 0, 5.0)], "k long, idx long, value double")
    got = drain(episodes.count_windows(stream, "k", 9, 4), "windows")
    assert sorted((r.start, r.first, r.last) for r in got) == [(0, 0.0, 8.0), (4, 4.0, 12.0), (8, 8.0, 16.0)]


def test_unwrap(source):
    turn = 2 * math.pi
    stream = source([(1, i, (0.9 * i) % turn) for i in range(20)], "k long, idx long, value double")
    got = sorted((r.idx, r.unwrapped) for r in drain(episodes.unwrapped(stream, "k"), "angles"))
    assert all(v == pytest.approx(0.9 * i) for i, v in got)


def test_first_wins(source):
    stream = source([(1, "a", "2024-01-01 00:00:00"), (2, "a", "2024-01-01 00:00:01"), (3, "b", "2024-01-01 00:00:02")], "id long, fp string, at string")
    from pyspark.sql import functions as F

    got = drain(episodes.first_wins(stream.withColumn("at", F.to_timestamp("at")), "fp", "at"), "firsts")
    assert sorted(r.fp for r in got) == ["a", "b"]
