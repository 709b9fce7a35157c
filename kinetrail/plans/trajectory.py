"""Registered queries over events: a user is an episode, the event times its clock, ``value`` its signal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinetrail.operators import intervals as iv
from kinetrail.operators import resample, signals, stats, temporal, windows
from kinetrail.plans.base import rounded, table

POLICY = windows.WindowPolicy(width=9, stride=4, ratio=2, least_unique=2)

#: as a CTE: the same frames in SQL
FRAMES = "frames AS (SELECT user_id AS episode_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx, epoch_us(ts) / 1e6 AS t, value FROM events)"
DELTAS = FRAMES + ", d AS (SELECT *, t - lag(t) OVER (PARTITION BY episode_id ORDER BY idx) AS delta FROM frames), med AS (SELECT episode_id, median(delta) FILTER (WHERE delta > 0) AS m, count(*) AS n FROM d GROUP BY 1)"
GAPS = DELTAS + ", bad AS (SELECT episode_id, idx, n FROM d JOIN med USING (episode_id) WHERE delta > 3 * m)"
#: islands of (episode_id, idx, n) with a padding of one sample
ISLANDS = """pts AS (SELECT DISTINCT episode_id, unnest(range(greatest(idx - 1, 0), least(idx + 1, n - 1) + 1)) AS i FROM bad),
isl AS (SELECT episode_id, min(i) AS start, max(i) + 1 AS stop FROM (SELECT episode_id, i, i - row_number() OVER (PARTITION BY episode_id ORDER BY i) AS g FROM pts) GROUP BY episode_id, g)"""
STARTS = "starts AS (SELECT episode_id, unnest(range(0, n - 9 + 1, 4)) AS start FROM (SELECT episode_id, count(*) AS n FROM frames GROUP BY 1) WHERE n >= 9)"


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return events.select(F.col("user_id").alias("episode_id"), (F.row_number().over(order) - 1).cast("bigint").alias("idx"), (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("t"), "value")


def lengths(rows: DataFrame) -> DataFrame:
    return rows.groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"))


def temporal_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(temporal.audit(frames(spark, sf_dir), declared_fps=0.001))


def timestamp_gap_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir)
    return iv.islands(temporal.gaps(rows), lengths(rows), ["episode_id"], padding=1)


def bad_intervals(rows: DataFrame) -> DataFrame:
    """Hard intervals: gaps of the clock (temporal) and abrupt steps (state and action)."""
    n = lengths(rows)
    clock = iv.islands(temporal.gaps(rows), n, ["episode_id"], padding=1).withColumn("domains", F.array(F.lit("temporal"))).withColumn("reason", F.lit("timestamp_gap"))
    order = Window.partitionBy("episode_id").orderBy("idx")
    moved = rows.withColumn("step", F.abs(F.col("value") - F.lag("value").over(order)))
    middle = moved.groupBy("episode_id").agg(F.median("step").alias("m"))
    jumps = moved.select("episode_id", "idx", "step").join(middle, "episode_id").where(F.col("step") > 3 * F.col("m"))
    control = iv.islands(jumps.select("episode_id", "idx"), n, ["episode_id"]).withColumn("domains", F.array(F.lit("action"), F.lit("state"))).withColumn("reason", F.lit("abrupt_signal_step"))
    return clock.unionByName(control).withColumn("severity", F.lit("hard"))


BAD = (
    GAPS
    + ", "
    + ISLANDS
    + """, clock AS (SELECT * FROM isl),
s AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY episode_id ORDER BY idx)) AS step FROM frames),
sm AS (SELECT episode_id, median(step) AS m FROM s GROUP BY 1),
j AS (SELECT episode_id, idx AS i FROM s JOIN sm USING (episode_id) WHERE step > 3 * m),
control AS (SELECT episode_id, min(i) AS start, max(i) + 1 AS stop FROM (SELECT episode_id, i, i - row_number() OVER (PARTITION BY episode_id ORDER BY i) AS g FROM j) GROUP BY episode_id, g)"""
)
SPLIT = (
    BAD
    + ", "
    + STARTS
    + """, seen AS (SELECT * FROM starts w WHERE NOT EXISTS (SELECT 1 FROM clock c WHERE c.episode_id = w.episode_id AND w.start < c.stop AND w.start + 9 > c.start)),
modes AS (SELECT episode_id, start, CASE WHEN EXISTS (SELECT 1 FROM control c WHERE c.episode_id = w.episode_id AND w.start < c.stop AND w.start + 9 > c.start) THEN 'video_only' ELSE 'joint' END AS mode FROM seen w)"""
)


def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.starts(lengths(frames(spark, sf_dir)), POLICY)


def split_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir)
    return windows.split(windows.starts(lengths(rows), POLICY), bad_intervals(rows), POLICY.width)


def blocked_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir)
    return iv.blocked(windows.starts(lengths(rows), POLICY), bad_intervals(rows), POLICY.width, ["video", "temporal"])


def window_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.index(split_windows(spark, sf_dir), POLICY.stride)


def interval_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap intervals in seconds, mapped to a timeline of one frame a thousand seconds and coalesced."""
    rows = frames(spark, sf_dir)
    gaps = timestamp_gap_intervals(spark, sf_dir)
    at = rows.select("episode_id", "idx", "t")
    ends = rows.groupBy("episode_id").agg(F.min("t").alias("origin_s"), F.max("t").alias("last"), F.max("idx").alias("top"))
    timed = gaps.join(at.withColumnsRenamed({"idx": "start", "t": "start_s"}), ["episode_id", "start"]).join(at.withColumnsRenamed({"idx": "stop", "t": "stop_t"}), ["episode_id", "stop"], "left").join(ends, "episode_id")
    delta = temporal.audit(rows).select("episode_id", "median_delta_s")
    timed = timed.join(delta, "episode_id").withColumn("stop_s", F.coalesce("stop_t", F.col("last") + F.col("median_delta_s"))).withColumn("timeline", F.lit("source_control"))
    spans = ends.select("episode_id", "origin_s", (F.floor((F.col("last") - F.col("origin_s")) * 0.001 + 1e-8).cast("bigint") + 1).alias("n_target"))
    mapped = iv.to_timeline(timed.select("episode_id", "timeline", "start", "stop", "start_s", "stop_s"), spans, 0.001)
    return iv.coalesce(mapped, ["episode_id"])


def covered_norm_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: masked moments by domain and slot over the distinct rows that joint windows cover."""
    rows = frames(spark, sf_dir)
    joint = windows.split(windows.starts(lengths(rows), POLICY), bad_intervals(rows), POLICY.width).where("mode = 'joint'")
    covered = windows.covered_rows(joint, POLICY.width, ["episode_id"])
    order = Window.partitionBy("episode_id").orderBy("idx")
    step = F.col("value") - F.lag("value").over(order)
    vectors = rows.withColumn("vector", F.array("value", F.coalesce(step, F.lit(0.0)))).withColumn("mask", F.array(F.lit(True), step.isNotNull()))
    used = vectors.join(covered, ["episode_id", "idx"]).withColumn("domain", F.pmod("episode_id", F.lit(5)))
    return rounded(stats.masked_moments(used, ["domain"], "vector", "mask"))


def signal_dim_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(signals.dimension_metrics(frames(spark, sf_dir), ["episode_id"], floor=0.01))


def signal_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = signals.derivatives(frames(spark, sf_dir), ["episode_id"])
    scaled = [(F.col(x) * 1e6).alias(x) for x in ("velocity", "acceleration", "jerk")]
    return rounded(out.select("episode_id", "idx", *scaled))


def derivative_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = signals.derivatives(frames(spark, sf_dir).withColumn("t", F.col("idx").cast("double")), ["episode_id"])
    return rounded(signals.derivative_outliers(out, ["episode_id"], "acceleration"))


def lag_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Action is the value, state its running mean of three: the best lag of each user."""
    order = Window.partitionBy("episode_id").orderBy("idx").rowsBetween(-2, 0)
    rows = frames(spark, sf_dir).withColumn("state", F.avg("value").over(order)).withColumnRenamed("value", "action").withColumn("slot", F.lit(0))
    return rounded(stats.lag_alignment(rows, ["episode_id"], longest=5))


def _origin(rows: DataFrame) -> DataFrame:
    return rows.withColumn("t", F.col("t") - F.min("t").over(Window.partitionBy("episode_id")))


def asof_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _origin(frames(spark, sf_dir))
    return rounded(resample.nearest(rows, resample.targets(rows, 0.0005), ["idx", "value"]))


def resample_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _origin(frames(spark, sf_dir)).withColumn("held", F.col("value"))
    return rounded(resample.interpolate(rows, resample.targets(rows, 0.0005), ["value", "held"], held=("held",)))


ASOF = (
    FRAMES
    + """, o AS (SELECT episode_id, idx, t - min(t) OVER (PARTITION BY episode_id) AS t, value FROM frames),
tg AS (SELECT episode_id, k, k / 0.0005 AS tm FROM (SELECT episode_id, unnest(range(0, CAST(floor(max(t) * 0.0005 + 1e-8) AS BIGINT) + 1)) AS k FROM o GROUP BY episode_id)),
l AS (SELECT tg.*, o.idx AS li, o.t AS lt, o.value AS lv FROM tg ASOF LEFT JOIN o ON tg.episode_id = o.episode_id AND tg.tm >= o.t),
b AS (SELECT l.*, o.idx AS ri, o.t AS rt, o.value AS rv FROM l ASOF LEFT JOIN o ON l.episode_id = o.episode_id AND l.tm <= o.t),
f AS (SELECT episode_id, k, tm, coalesce(li, ri) AS li, coalesce(lt, rt) AS lt, coalesce(lv, rv) AS lv, coalesce(ri, li) AS ri, coalesce(rt, lt) AS rt, coalesce(rv, lv) AS rv FROM b),
g AS (SELECT *, CASE WHEN rt > lt THEN (tm - lt) / (rt - lt) ELSE 0 END AS alpha FROM f)"""
)


def next_row_hold_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(resample.hold_next(frames(spark, sf_dir), "value", ["episode_id"], "action").select("episode_id", "idx", "value", "action"))


def angle_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values read as angles modulo a turn."""
    rows = frames(spark, sf_dir).withColumn("value", F.pmod(F.col("value") * 3.0, F.lit(6.283185307179586)))
    return rounded(signals.unwrap(rows, ["episode_id"]).select("episode_id", "idx", "unwrapped", "wrapped"))


def relative_action_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir)
    pairs = stats.relative_pairs(rows.join(lengths(rows), "episode_id"), 4, ["episode_id"], "value", "value")
    return rounded(stats.column_stats(pairs.select(F.pmod("episode_id", F.lit(5)).alias("domain"), F.array("value").alias("v")), ["domain"], "v"))


def memory_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eleven rows before each row, padded on the left by the first, in groups of eight, two and one, and the progress."""
    rows = frames(spark, sf_dir)
    order = Window.partitionBy("episode_id").orderBy("idx")
    every = Window.partitionBy("episode_id")
    past = F.collect_list("idx").over(order.rowsBetween(-11, -1))
    padded = F.concat(F.array_repeat(F.lit(0).cast("bigint"), F.lit(11) - F.size("past")), F.col("past"))
    out = rows.withColumn("past", past).withColumn("n", F.count(F.lit(1)).over(every)).withColumn("all", padded)
    return rounded(
        out.select(
            "episode_id",
            "idx",
            F.array_join(F.slice("all", 1, 8), ",").alias("far"),
            F.array_join(F.slice("all", 9, 2), ",").alias("middle"),
            F.array_join(F.slice("all", 11, 1), ",").alias("near"),
            F.size("past").cast("bigint").alias("known"),
            (F.col("idx") / F.greatest(F.col("n") - 1, F.lit(1))).alias("progress"),
        )
    )


def evenly_spaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven evenly spaced samples of each episode; halves round to even."""
    rows = frames(spark, sf_dir)
    picks = lengths(rows).select("episode_id", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("k"), "n").select("episode_id", F.bround(F.col("k") * (F.col("n") - 1) / 6.0, 0).cast("bigint").alias("idx")).distinct()
    return rounded(rows.join(picks, ["episode_id", "idx"]).select("episode_id", "idx", "value"))


def probe_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle joint window of each episode from start 8 on, or of any mode where there is no joint one."""
    ready = split_windows(spark, sf_dir).where("start >= 8").withColumn("joint", F.col("mode") == "joint")
    every, order = Window.partitionBy("episode_id"), Window.partitionBy("episode_id").orderBy("start")
    kept = ready.withColumn("any_joint", F.bool_or("joint").over(every)).where(F.col("joint") | ~F.col("any_joint"))
    ranked = kept.withColumn("i", F.row_number().over(order)).withColumn("n", F.count(F.lit(1)).over(every))
    return ranked.where(F.col("i") == F.floor(F.col("n") / 2).cast("int") + 1).select("episode_id", "start", "mode")


QUERIES = {
    f.__name__: f
    for f in (
        temporal_audit, timestamp_gap_intervals, sliding_windows, split_windows, blocked_windows, window_index, interval_timeline, covered_norm_stats, signal_dim_metrics, signal_derivatives, derivative_outliers,
        lag_alignment, asof_nearest, resample_linear, next_row_hold_last, angle_unwrap, relative_action_stats, memory_history, evenly_spaced, probe_windows,
    )
}

ORACLE_SQL = {
    "temporal_audit": f"""WITH {DELTAS},
a AS (SELECT episode_id, median(abs(delta - m)) FILTER (WHERE delta > 0) AS mad, count(*) FILTER (WHERE delta > 3 * m) AS gaps, min(delta) FILTER (WHERE delta > 0) AS lo, max(delta) FILTER (WHERE delta > 0) AS hi,
 coalesce(bool_and(delta > 0), true) AS inc, max(t) - min(t) AS span FROM d JOIN med USING (episode_id) GROUP BY 1)
SELECT episode_id, n AS sample_count, true AS finite, inc AS strictly_increasing, round(CASE WHEN inc AND n >= 2 THEN span END, 6) AS duration_s, round(m, 6) AS median_delta_s, round(mad, 6) AS delta_mad_s,
 round(mad / m, 6) AS jitter_mad_ratio, round(lo, 6) AS minimum_delta_s, round(hi, 6) AS maximum_delta_s, gaps AS gap_count, round(1.0 / m, 6) AS inferred_fps, round(abs(1.0 / m - 0.001) / 0.001, 6) AS fps_relative_error
FROM a JOIN med USING (episode_id)""",
    "timestamp_gap_intervals": f"WITH {GAPS}, {ISLANDS} SELECT * FROM isl",
    "sliding_windows": f"WITH {FRAMES}, {STARTS} SELECT * FROM starts",
    "split_windows": f"WITH {SPLIT} SELECT * FROM modes",
    "blocked_windows": f"WITH {SPLIT} SELECT * FROM starts EXCEPT SELECT * FROM seen",
    "window_index": f"""WITH {SPLIT}, r AS (SELECT *, start // 4 - row_number() OVER (PARTITION BY episode_id, mode ORDER BY start) AS g FROM modes)
SELECT episode_id, mode, min(start) AS start, max(start) + 4 AS stop, 4 AS stride, count(*) AS count FROM r GROUP BY episode_id, mode, g""",
    "interval_timeline": f"""WITH {GAPS}, {ISLANDS},
e AS (SELECT episode_id, min(t) AS origin, max(t) AS last FROM frames GROUP BY 1),
s AS (SELECT i.episode_id, a.t - origin AS s, coalesce(b.t, last + m) - origin AS e, CAST(floor((last - origin) * 0.001 + 1e-8) AS BIGINT) + 1 AS nt
 FROM isl i JOIN e USING (episode_id) JOIN med USING (episode_id) JOIN frames a ON a.episode_id = i.episode_id AND a.idx = i.start LEFT JOIN frames b ON b.episode_id = i.episode_id AND b.idx = i.stop),
x AS (SELECT episode_id, nt, greatest(0, CAST(floor(s * 0.001 + 1e-8) AS BIGINT)) AS start, e FROM s),
y AS (SELECT episode_id, nt, start, least(nt, greatest(start + 1, CAST(ceil(e * 0.001 - 1e-8) AS BIGINT))) AS stop FROM x),
z AS (SELECT * FROM y WHERE start < nt AND stop > 0),
n AS (SELECT *, CASE WHEN start <= max(stop) OVER (PARTITION BY episode_id ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM z),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY episode_id ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS g FROM n)
SELECT episode_id, min(start) AS start, max(stop) AS stop FROM g GROUP BY episode_id, g""",
    "covered_norm_stats": f"""WITH {SPLIT},
cov AS (SELECT DISTINCT episode_id, unnest(range(start, start + 9)) AS idx FROM modes WHERE mode = 'joint'),
vec AS (SELECT f.episode_id % 5 AS domain, value, value - lag(value) OVER (PARTITION BY episode_id ORDER BY idx) AS step, episode_id, idx FROM frames f),
used AS (SELECT vec.* FROM vec JOIN cov USING (episode_id, idx)),
slots AS (SELECT domain, 0 AS slot, value AS x FROM used UNION ALL SELECT domain, 1, step FROM used)
SELECT domain, slot, count(x) AS count, round(coalesce(avg(x), 0), 6) AS mean, round(CASE WHEN count(x) > 0 THEN greatest(stddev_pop(x), 1e-6) ELSE 1 END, 6) AS std, count(x) > 0 AS valid FROM slots GROUP BY 1, 2""",
    "signal_dim_metrics": f"""WITH {FRAMES}, s AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY episode_id ORDER BY idx)) AS step FROM frames),
b AS (SELECT episode_id, count(*) AS n, quantile_cont(value, [0.01, 0.5, 0.99]) AS q, max(value) - min(value) AS rg, median(step) AS ms, max(step) AS mx FROM s GROUP BY 1),
a AS (SELECT episode_id, step, CASE WHEN step > greatest(1e-12, rg * 1e-10) THEN step END AS act FROM s JOIN b USING (episode_id)),
m AS (SELECT episode_id, median(act) AS m, count(act) AS na FROM a GROUP BY 1),
d AS (SELECT episode_id, median(abs(act - m)) AS mad FROM a JOIN m USING (episode_id) GROUP BY 1),
l AS (SELECT episode_id, na, m, mad, CASE WHEN m IS NULL THEN 0 ELSE greatest(1e-6, 0.01, m * 20, m + 12.0 * 1.4826 * mad) END AS lim FROM m JOIN d USING (episode_id)),
o AS (SELECT episode_id, count(*) FILTER (WHERE lim > 0 AND step > lim) AS ab, count(*) FILTER (WHERE lim > 0 AND step > lim * 10) AS ex FROM a JOIN l USING (episode_id) GROUP BY 1)
SELECT episode_id, n AS sample_count, n AS finite_count, 1.0::DOUBLE AS finite_ratio, round(q[1], 6) AS p01, round(q[2], 6) AS p50, round(q[3], 6) AS p99, round(rg, 6) AS range, round(coalesce(ms, 0), 6) AS median_abs_step, na AS active_step_count,
 round(coalesce(m, 0), 6) AS median_active_abs_step, round(coalesce(mad, 0), 6) AS step_mad, round(coalesce(mx, 0), 6) AS maximum_abs_step, round(lim, 6) AS abrupt_threshold, ab AS abrupt_step_count, round(ab / greatest(n - 1, 1), 6) AS abrupt_step_ratio,
 ex AS extreme_abrupt_step_count, round(ex / greatest(n - 1, 1), 6) AS extreme_abrupt_step_ratio, rg <= 1e-8 AS constant FROM b JOIN l USING (episode_id) JOIN o USING (episode_id)""",
    "signal_derivatives": f"""WITH {FRAMES}, v AS (SELECT *, t - lag(t) OVER w AS dt, (value - lag(value) OVER w) / (t - lag(t) OVER w) AS v FROM frames WINDOW w AS (PARTITION BY episode_id ORDER BY idx)),
a AS (SELECT *, (v - lag(v) OVER w) / dt AS a FROM v WINDOW w AS (PARTITION BY episode_id ORDER BY idx)), j AS (SELECT *, (a - lag(a) OVER w) / dt AS j FROM a WINDOW w AS (PARTITION BY episode_id ORDER BY idx))
SELECT episode_id, idx, round(v * 1e6, 6) AS velocity, round(a * 1e6, 6) AS acceleration, round(j * 1e6, 6) AS jerk FROM j""",
    "derivative_outliers": f"""WITH {FRAMES}, v AS (SELECT *, value - lag(value) OVER (PARTITION BY episode_id ORDER BY idx) AS v FROM frames), a AS (SELECT episode_id, abs(v - lag(v) OVER (PARTITION BY episode_id ORDER BY idx)) AS x FROM v),
c AS (SELECT *, CASE WHEN x > 1e-12 THEN x END AS act FROM a), b AS (SELECT episode_id, count(*) AS n, count(x) AS fc, median(act) AS m, max(x) AS mx FROM c GROUP BY 1),
d AS (SELECT episode_id, median(abs(act - m)) AS mad FROM c JOIN b USING (episode_id) GROUP BY 1), l AS (SELECT *, CASE WHEN m IS NULL THEN 0 ELSE greatest(1e-6, m * 20, m + 12.0 * 1.4826 * mad) END AS lim FROM b JOIN d USING (episode_id)),
o AS (SELECT episode_id, count(*) FILTER (WHERE lim > 0 AND x > lim) AS oc FROM c JOIN l USING (episode_id) GROUP BY 1)
SELECT episode_id, fc AS finite_count, round(coalesce(mx, 0), 6) AS maximum_abs, round(coalesce(m, 0), 6) AS median_active_abs, round(coalesce(mad, 0), 6) AS mad, round(lim, 6) AS outlier_threshold, oc AS outlier_count, round(oc / greatest(n - 1, 1), 6) AS outlier_ratio FROM l JOIN o USING (episode_id)""",
    "lag_alignment": f"""WITH {FRAMES}, s AS (SELECT episode_id, idx, value AS action, avg(value) OVER (PARTITION BY episode_id ORDER BY idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS state FROM frames),
p AS (SELECT a.episode_id, lag, a.action, b.state FROM s a CROSS JOIN (SELECT unnest(range(0, 6)) AS lag) JOIN s b ON a.episode_id = b.episode_id AND b.idx = a.idx + lag),
c AS (SELECT episode_id, lag, corr(action, state) AS r FROM p GROUP BY 1, 2 HAVING count(*) >= 8 AND stddev_pop(action) * sqrt(count(*)) > 1e-12 AND stddev_pop(state) * sqrt(count(*)) > 1e-12),
k AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY r DESC, lag) AS rn FROM c)
SELECT episode_id, lag::INT AS best_lag, round(r, 6) AS score, 1::BIGINT AS dims, CASE WHEN r >= 0.2 THEN 'passed' ELSE 'low_confidence' END AS status FROM k WHERE rn = 1""",
    "asof_nearest": f"WITH {ASOF} SELECT episode_id, k, round(tm, 6) AS \"at\", CASE WHEN alpha <= 0.5 THEN li ELSE ri END AS idx, round(CASE WHEN alpha <= 0.5 THEN lv ELSE rv END, 6) AS value, round(abs(CASE WHEN alpha <= 0.5 THEN lt ELSE rt END - tm), 6) AS error_s FROM g",
    "resample_linear": f"WITH {ASOF} SELECT episode_id, k, round(tm, 6) AS \"at\", round(lv * (1 - alpha) + rv * alpha, 6) AS value, true AS value_valid, round(lv, 6) AS held, true AS held_valid FROM g",
    "next_row_hold_last": f"WITH {FRAMES} SELECT episode_id, idx, round(value, 6) AS value, round(coalesce(lead(value) OVER (PARTITION BY episode_id ORDER BY idx), value), 6) AS action FROM frames",
    "angle_unwrap": f"""WITH RECURSIVE {FRAMES}, a AS (SELECT episode_id, idx, (value * 3.0) - floor((value * 3.0) / 6.283185307179586) * 6.283185307179586 AS x FROM frames),
d AS (SELECT *, x - lag(x) OVER (PARTITION BY episode_id ORDER BY idx) AS d FROM a),
k AS (SELECT *, sum(CASE WHEN d > pi() THEN -1 WHEN d < -pi() THEN 1 ELSE 0 END) OVER (PARTITION BY episode_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS k FROM d)
SELECT episode_id, idx, round(x + k * 2 * pi(), 6) AS unwrapped, k <> 0 AS wrapped FROM k""",
    "relative_action_stats": f"""WITH {FRAMES}, n AS (SELECT episode_id, count(*) AS n FROM frames GROUP BY 1),
p AS (SELECT a.episode_id % 5 AS domain, b.value - a.value AS x FROM frames a JOIN n USING (episode_id) JOIN frames b ON b.episode_id = a.episode_id AND b.idx BETWEEN a.idx AND a.idx + 3 WHERE a.idx < n - 4)
SELECT domain, 0 AS dim, count(x) AS count, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max, round(quantile_cont(x, 0.01), 6) AS q01, round(quantile_cont(x, 0.99), 6) AS q99 FROM p GROUP BY 1""",
    "memory_history": f"""WITH {FRAMES}, n AS (SELECT *, count(*) OVER (PARTITION BY episode_id) AS n FROM frames),
h AS (SELECT episode_id, idx, n, list_transform(range(idx - 11, idx), lambda i: greatest(i, 0)) AS a FROM n)
SELECT episode_id, idx, array_to_string(a[1:8], ',') AS far, array_to_string(a[9:10], ',') AS middle, array_to_string(a[11:11], ',') AS near, least(idx, 11)::BIGINT AS known, round(idx / greatest(n - 1, 1), 6) AS progress FROM h""",
    "evenly_spaced": f"""WITH {FRAMES}, n AS (SELECT episode_id, count(*) AS n FROM frames GROUP BY 1), p AS (SELECT DISTINCT episode_id, CAST(round_even(k * (n - 1) / 6.0, 0) AS BIGINT) AS idx FROM n CROSS JOIN (SELECT unnest(range(0, 7)) AS k))
SELECT episode_id, idx, round(value, 6) AS value FROM frames JOIN p USING (episode_id, idx)""",
    "probe_windows": f"""WITH {SPLIT}, r AS (SELECT *, bool_or(mode = 'joint') OVER (PARTITION BY episode_id) AS aj FROM modes WHERE start >= 8),
k AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY start) AS i, count(*) OVER (PARTITION BY episode_id) AS n FROM r WHERE mode = 'joint' OR NOT aj)
SELECT episode_id, start, mode FROM k WHERE i = n // 2 + 1""",
}
