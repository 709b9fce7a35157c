"""Audits of clocks and signals: known shapes and folds written out in Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kinetrail.operators import resample, signals, stats, temporal


def long(spark, values, key="e"):
    return spark.createDataFrame([(key, i, i / 20.0, None if v is None else float(v)) for i, v in enumerate(values)], "k string, idx bigint, t double, value double")


@pytest.mark.parametrize(
    ("values", "abrupt", "floor"),
    [
        ([0.0] * 60 + [0.01 * i for i in range(1, 41)], False, 0.0),
        ([0.01 * i if i != 50 else 100.0 for i in range(100)], True, 0.0),
        ([(i % 7) * 1e-5 for i in range(100)], False, 0.01),
        ([0.0] * 20, False, 0.0),
    ],
)
def test_abrupt_steps(spark, values, abrupt, floor):
    row = signals.dimension_metrics(long(spark, values), ["k"], floor=floor).first()
    assert (row.abrupt_step_count > 0) == abrupt
    assert row.finite_ratio == 1.0


def test_values_that_are_not_finite_count_only_in_lengths(spark):
    row = signals.dimension_metrics(long(spark, [1.0, float("nan"), 2.0, float("inf"), 3.0, None]), ["k"]).first()
    assert (row.sample_count, row.finite_count, row.maximum_abs_step) == (6, 3, 0.0)
    assert row.p50 == 2.0


def test_derivatives(spark):
    rows = signals.derivatives(long(spark, [0, 1, 4, 9, 16]), ["k"]).orderBy("idx").collect()
    assert rows[0].velocity is None
    assert rows[1].velocity == pytest.approx(20.0)
    assert rows[2].acceleration == pytest.approx(800.0)
    assert rows[3].jerk == pytest.approx(0.0, abs=1e-6)


def test_unwrap_is_the_fold(spark):
    random.seed(4)
    values = [random.choice([random.uniform(-9, 9), float("nan")]) if random.random() < 0.2 else random.uniform(-4, 4) for _ in range(200)]
    want, last = [], None
    for v in values:
        if math.isfinite(v):
            while last is not None and v - last > math.pi:
                v -= 2 * math.pi
            while last is not None and v - last < -math.pi:
                v += 2 * math.pi
            last = v
        want.append(v)
    got = [r.unwrapped for r in signals.unwrap(long(spark, values), ["k"]).orderBy("idx").collect()]
    assert all((math.isnan(a) and math.isnan(b)) or a == pytest.approx(b) for a, b in zip(got, want, strict=True))


def test_quaternion_signs_are_the_fold(spark):
    random.seed(7)
    rows = []
    for i in range(150):
        q = [random.gauss(0, 1) for _ in range(4)]
        kind = random.random()
        rows.append((1, i, *([None] * 4 if kind < 0.05 else [0.0] * 4 if kind < 0.1 else [float("nan")] * 4 if kind < 0.13 else q)))
    want, last = [], None
    for r in rows:
        q = r[2:]
        if q[0] is None:
            want.append(None)
            continue
        norm = math.sqrt(sum(x * x for x in q))
        if not math.isfinite(norm) or norm <= 1e-12:
            want.append(None)
            last = None
            continue
        q = [x / norm for x in q]
        sign = 1
        if last is not None and sum(a * b for a, b in zip(last, q, strict=True)) < 0:
            sign, q = -1, [-x for x in q]
        last = q
        want.append(sign)
    df = spark.createDataFrame(rows, "k int, idx int, qx double, qy double, qz double, qw double")
    got = [r.sign for r in signals.quaternion_continuity(df, ["k"]).orderBy("idx").collect()]
    assert got == want


def test_clock_audit(spark):
    times = [0.0, 0.05, 0.1, 0.15, 1.0, 1.05]
    rows = spark.createDataFrame([("a", i, t) for i, t in enumerate(times)] + [("b", 0, 0.0), ("b", 1, 0.0), ("c", 0, 1.0), ("d", 0, float("nan")), ("d", 1, 1.0)], "episode_id string, idx bigint, t double")
    got = {r.episode_id: r for r in temporal.audit(rows, declared_fps=20.0).collect()}
    assert (got["a"].gap_count, got["a"].strictly_increasing) == (1, True)
    assert got["a"].inferred_fps == pytest.approx(20.0)
    assert got["b"].strictly_increasing is False and got["b"].duration_s is None
    assert got["c"].strictly_increasing is True and got["c"].median_delta_s is None
    assert got["d"].finite is False
    assert [r.idx for r in temporal.gaps(rows).where("episode_id = 'a'").collect()] == [4]


def test_contiguity_and_parts(spark):
    rows = spark.createDataFrame([(1, 3), (1, 4), (1, 5), (2, 1), (2, 4), (3, None)], "k int, v bigint")
    got = {r.k: r.contiguous for r in temporal.contiguous(rows, ["k"], "v", ["v"]).collect()}
    assert got == {1: True, 2: False, 3: False}
    assert {r.k: r.missing for r in temporal.missing_parts(rows, ["k"], "v").collect()} == {1: [], 2: [2, 3]}


def test_resampling_is_bisection(spark):
    random.seed(1)
    times = sorted({round(random.uniform(0, 4), 2) for _ in range(25)} | {0.0, 0.5, 1.0})
    values = [random.choice([random.uniform(-1, 1)] * 4 + [float("nan")]) for _ in times]
    frames = spark.createDataFrame([("e", i, t, v, v) for i, (t, v) in enumerate(zip(times, values, strict=True))], "episode_id string, idx bigint, t double, v double, h double")
    wanted = resample.targets(frames, 20.0)
    near = {r.k: r for r in resample.nearest(frames, wanted, ["idx"]).collect()}
    blend = {r.k: r for r in resample.interpolate(frames, wanted, ["v", "h"], held=("h",)).collect()}
    assert len(near) == len(blend) == int(times[-1] * 20 + 1e-8) + 1
    for k in near:
        at = k / 20.0
        right = next((i for i, t in enumerate(times) if t >= at), len(times) - 1)
        left = right if times[right] <= at else max(0, right - 1)
        alpha = 0.0 if left == right else (at - times[left]) / (times[right] - times[left])
        assert near[k].idx == (left if alpha <= 0.5 else right)
        a, b = values[left], values[right]
        ok = math.isfinite(a) and (left == right or math.isfinite(b))
        assert blend[k].v_valid == ok
        assert blend[k].v == pytest.approx((a * (1 - alpha) + b * alpha if left != right else a) if ok else 0.0)
        assert blend[k].h_valid == math.isfinite(a)


def test_statistics_count_a_row_once(spark):
    """Two overlapping windows of 81 over 130 rows cover 121 rows of mean 60 (next values: 120 of 60.5)."""
    from kinetrail.operators import windows

    starts = spark.createDataFrame([("e", 0), ("e", 40)], "episode_id string, start bigint")
    for width, count, first, mean in ((81, 121, 0, 60.0), (80, 120, 1, 60.5)):
        covered = windows.covered_rows(starts, width, ["episode_id"])
        frames = spark.range(130).select(F.lit("e").alias("episode_id"), F.col("id").alias("idx"), F.array((F.col("id") + first).cast("double"), F.lit(1.0)).alias("v"), F.array(F.lit(True), F.lit(False)).alias("m"))
        got = {r.slot: r for r in stats.masked_moments(frames.join(covered, ["episode_id", "idx"]), ["episode_id"], "v", "m").collect()}
        assert (got[0]["count"], got[0]["mean"], got[0]["valid"]) == (count, mean, True)
        assert (got[1]["count"], got[1]["mean"], got[1]["std"], got[1]["valid"]) == (0, 0.0, 1.0, False)


def test_alignment_finds_the_lag(spark):
    random.seed(3)
    x = [random.gauss(0, 1) for _ in range(120)]
    rows = [("e", s, i, x[i], x[i - 3] if i >= 3 else float("nan")) for s in (0, 1) for i in range(120)]
    got = stats.lag_alignment(spark.createDataFrame(rows, "k string, slot int, idx bigint, action double, state double"), ["k"], longest=10).first()
    assert (got.best_lag, got.status, got.dims) == (3, "passed", 2)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "episode_id string, idx bigint, t double, value double")
    assert temporal.audit(none).count() == 0
    assert signals.dimension_metrics(none, ["episode_id"]).count() == 0
    assert resample.targets(none, 20.0).count() == 0
