"""Interval algebra against plain Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kinetrail.operators import intervals as iv
from kinetrail.operators import windows

SMALL = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def runs(points):
    out = []
    for i in sorted(set(points)):
        if out and out[-1][1] == i:
            out[-1][1] = i + 1
        else:
            out.append([i, i + 1])
    return [tuple(x) for x in out]


@SMALL
@given(st.lists(st.integers(0, 25), max_size=12), st.integers(0, 2))
def test_islands(spark, points, padding):
    n = 26
    rows = spark.createDataFrame([(1, i) for i in points] + [(2, None)], "e int, idx bigint")
    lengths = spark.createDataFrame([(1, n), (2, n)], "e int, n bigint")
    got = sorted((r.start, r.stop) for r in iv.islands(rows, lengths, ["e"], padding=padding).collect())
    assert got == runs([j for i in points for j in range(max(0, i - padding), min(n, i + padding + 1))])


@SMALL
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 8)), min_size=1, max_size=12))
def test_coalesce(spark, spans):
    rows = spark.createDataFrame([("k", a, a + n) for a, n in spans], "k string, start bigint, stop bigint")
    want = []
    for a, b in sorted((a, a + n) for a, n in spans):
        if want and a <= want[-1][1]:
            want[-1][1] = max(want[-1][1], b)
        else:
            want.append([a, b])
    assert sorted((r.start, r.stop) for r in iv.coalesce(rows, ["k"]).collect()) == [tuple(x) for x in want]


@SMALL
@given(st.lists(st.integers(0, 12).map(lambda x: x * 4), min_size=1, max_size=12))
def test_compact_and_expand(spark, starts):
    rows = spark.createDataFrame([(1, s) for s in starts], "e int, start bigint")
    ranges = iv.compact(rows, ["e"], 4)
    assert all(r["count"] == (r.stop - r.start) // 4 for r in ranges.collect())
    assert sorted(r.start for r in iv.expand(ranges).collect()) == sorted(set(starts))


def test_windows_of_one_episode(spark):
    """241 frames, one hard action interval: five video windows, three joint, two downgraded."""
    policy = windows.WindowPolicy()
    episodes = spark.createDataFrame([("e", 241), ("short", 80)], "episode_id string, n bigint")
    bad = spark.createDataFrame([("e", 100, 101, ["action"], "hard"), ("e", 0, 241, ["video"], "soft")], "episode_id string, start bigint, stop bigint, domains array<string>, severity string")
    rows = windows.split(windows.starts(episodes, policy), bad, policy.width).collect()
    assert len(rows) == 5
    assert sorted(r.start for r in rows if r.mode == "joint") == [0, 120, 160]
    assert {r.start for r in rows if r.mode == "video_only"} == {40, 80}


def test_timeline_drops_unknown_times(spark):
    rows = spark.createDataFrame([("e", "source_control", 10.0, 10.2), ("e", "source_control", None, 1.0)], "episode_id string, timeline string, start_s double, stop_s double")
    spans = spark.createDataFrame([("e", 10.0, 100)], "episode_id string, origin_s double, n_target bigint")
    got = iv.to_timeline(rows, spans, 20.0).collect()
    assert [(r.start, r.stop) for r in got] == [(0, 4)]
