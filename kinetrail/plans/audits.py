"""Registered queries of audits, canonical materialisation and training cases over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinetrail.operators import audits as au
from kinetrail.operators import cases as ca
from kinetrail.operators import curation as cu
from kinetrail.operators import materialize as ma
from kinetrail.operators import reports as rp
from kinetrail.plans.base import rounded, table
from kinetrail.plans.selection import _L, _U, _lines
from kinetrail.plans.trajectory import FRAMES, frames

NAMES = ("base_orientation_x", "base_orientation.y", "base_orientation z", "base_orientation-w", "x", "y", "z", "w", "left_gripper", "arm_yaw_rad", "yaw_speed", "joint")
SOURCES = ("state/pose", "state/quat", "gripper/open", "state/twist")


def _k(name: str = "o_orderkey") -> Column:
    return F.col(name)


def _pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in values]), index.cast("int"))


# --- meaning of dimensions ------------------------------------------------------------------------------


def _dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.floor(F.col("p_partkey") / 6).alias("episode"))
    shift = F.when(F.col("episode") % 3 == 0, 0).when(F.col("episode") % 3 == 1, 4).otherwise(F.col("episode") % 7)
    return part.select("episode", _pick(SOURCES, F.col("episode") % 4).alias("source_key"), (F.col("part") % 6).alias("dim"), _pick(NAMES, (F.col("part") % 6 + shift) % 12).alias("name"))


def dimension_meanings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return au.dimension_meaning(_dims(spark, sf_dir), ["episode"])


def meaning_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = au.dimension_meaning(_dims(spark, sf_dir), ["episode"]).select("episode", "dim", "meaning")
    metrics = metrics.select("*", F.col("dim").alias("abrupt_steps"), (F.col("dim") / 10.0).alias("abrupt_ratio"), (F.col("dim") * 2).alias("extreme_steps"), (F.col("dim") / 20.0).alias("extreme_ratio"), F.lit(3).cast("bigint").alias("derivative_outliers"))
    return rounded(au.with_meaning(metrics))


# --- alignment -------------------------------------------------------------------------------------------


def slot_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = _lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("episode"), (F.col("part") % 70).cast("int").alias("slot")).agg(F.min("q").alias("q"), F.min("flag").alias("flag"))
    flag = F.when(F.col("q") % 5 == 0, False).when(F.col("q") % 5 == 1, True)
    state = one.select("episode", "slot", (F.col("q") % 7 > 0).alias("active"), flag.alias("alignment_safe"), F.lit("state").alias("source_key"), F.when(F.col("q") % 6 == 0, "wheel_speed").otherwise("joint").alias("source_name"), F.lit(None).cast("string").alias("semantic"))
    action = one.select("episode", "slot", (F.col("q") % 11 > 0).alias("active"), F.when(F.col("q") % 3 == 0, True).alias("alignment_safe"), F.when(F.col("flag") == "A", "action/velocity").otherwise("action").alias("source_key"), F.lit("j").alias("source_name"), F.lit("joint").alias("semantic"))
    return au.common_slots(state, action, ["episode"])


def slot_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's values against their running mean (slot 7) and their running sum as a state whose derivative is compared (slot 9)."""
    rows = frames(spark, sf_dir)
    w = Window.partitionBy("episode_id").orderBy("idx")
    value = F.when(F.col("idx") % 17 == 3, F.lit(float("nan"))).otherwise(F.col("value"))
    rows = rows.withColumn("mean", F.avg("value").over(w.rowsBetween(-3, 0))).withColumn("sum", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("value", value)
    one = rows.select("episode_id", F.lit(7).alias("slot"), "idx", F.col("mean").alias("state"), F.col("value").alias("action"), F.lit("direct_feedback").alias("comparison"))
    two = rows.select("episode_id", F.lit(9).alias("slot"), "idx", F.col("sum").alias("state"), F.col("value").alias("action"), F.lit("action_vs_state_derivative").alias("comparison"))
    episodes = rows.select("episode_id").distinct().withColumn("fps", (F.col("episode_id") % 4 * 5).cast("double"))
    out = au.alignment(one.unionByName(two), episodes, "episode_id").select("episode_id", "status", F.col("best_lag").cast("bigint").alias("best_lag"), "best_lag_ms", "score", "dims")
    return rounded(out, 5)


# --- sparse visual samples ---------------------------------------------------------------------------------

VISUAL = au.VisualPolicy(extreme_ratio=0.2, least_entropy=0.78, least_sharpness=0.55, freeze_difference=0.14, freeze_distance=30)


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five vectors a camera as gray frames."""
    gray = F.transform("embedding", lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor((x.cast("double") + 0.5) * 255).cast("int"))))
    rows = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 5).alias("camera"), (F.col("vec_id") % 5).alias("sample"), (F.col("vec_id") % 5 * 2 + F.col("vec_id") % 2).cast("double").alias("t"), gray.alias("p"))
    m = rp.luma_metrics(F.col("p"), dark=60, bright=190)
    code = rp.difference_hash(F.col("p"), 8, 8)
    rows = rows.select("camera", "sample", "t", "p", "*", *[x.alias(k) for k, x in m.items()], rp.laplacian_variance(F.col("p"), 8, 8).alias("sharpness"), code.alias("code"), rp.hash_text(code).alias("dhash"))
    return rows.withColumn("flags", au.frame_flags(VISUAL))


def visual_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(au.sample_intervals(_samples(spark, sf_dir).select("camera", "sample", "t", "flags"), ["camera"]))


def visual_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _samples(spark, sf_dir).select("camera", "sample", "p", "code", "dhash", "flags", "mean_luma", "entropy", "sharpness")
    pairs = rp.frozen_pairs(rows, ["camera"], "sample", "p", "code", VISUAL.freeze_difference, VISUAL.freeze_distance)
    out = au.visual_report(rows, pairs, ["camera"])
    return rounded(out.withColumn("flags", F.array_join("flags", ",")), 5)


def visual_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as cameras of small groups."""
    k = F.col("c_custkey")
    cameras = table(spark, sf_dir, "customer").select(
        F.floor(k / 3).alias("episode"),
        _pick(["passed", "failed", "passed", "pending", "passed"], k % 5 * (k % 2)).alias("status"),
        F.when(k % 4 > 0, _pick(["passed", "warning", "failed", "pending", "passed", "failed", "failed"], k % 7)).alias("sparse_status"),
        F.when(k % 6 > 0, F.sha2(k.cast("string"), 256)).alias("fingerprint"),
    )
    out = au.visual_stage(cameras, ["episode"])
    return out.select("episode", "visual_status", *[F.array_join(c, ",").alias(c) for c in ("visual_failures", "visual_warnings", "visual_passed", "visual_pending")], "visual_sha256")


def trajectory_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir)
    holes = F.when(F.col("idx") % 13 == 5, F.lit(float("nan"))).when(F.col("idx") % 13 == 6, F.lit(float("-inf"))).otherwise(F.col("value"))
    one = rows.select("episode_id", "idx", F.lit("a").alias("signal"), F.array(holes, F.col("idx").cast("double")).alias("vector"))
    two = rows.select("episode_id", "idx", F.lit("b").alias("signal"), F.array(-F.col("value")).alias("vector"))
    return au.trajectory_fingerprints(one.unionByName(two), "episode_id")


# --- stages ------------------------------------------------------------------------------------------------


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("q")
    return _lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.concat(F.lit("s"), F.col("line").cast("string")).alias("name"),
        (F.col("line") % 3 > 0).alias("relevant"),
        (q % 23 > 0).alias("present"),
        F.when(q % 19 == 0, 2).otherwise(1).alias("widths"),
        F.when(q % 17 == 0, 0.9).otherwise(1.0).alias("least_finite"),
        (q % 10 / 30.0).alias("abrupt"),
        (q % 4 / 40.0).alias("extreme"),
        (q % 8 == 0).cast("int").alias("constant_dims"),
        (q % 9 == 0).cast("int").alias("sign_flips"),
        (q % 31 == 0).cast("int").alias("norm_errors"),
        (q % 29 == 0).cast("int").alias("rapid_turns"),
    )


def signal_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = au.signal_codes(_signals(spark, sf_dir), "o_orderkey")
    return out.select("o_orderkey", *[F.array_join(c, ",").alias(c) for c in ("signal_reasons", "signal_blockers", "signal_warnings", "kinematic_reasons")], "sign_flips")


def _episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _k()
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (k % 5 > 0).alias("prompt_usable"),
        F.when(k % 4 > 0, _pick(["passed", "warning", "failed"], k % 3)).alias("visual_status"),
        F.when(k % 4 > 0, F.when(k % 3 == 2, F.array(F.lit("all_video_containers_failed"))).otherwise(F.array().cast("array<string>"))).alias("visual_failures"),
        F.when(k % 3 == 1, F.array(F.lit("sparse_visual_quality_flags"))).alias("visual_warnings"),
        F.when(k % 3 == 0, F.array(F.lit("visual_container"))).alias("visual_passed"),
        F.lit(None).cast("array<string>").alias("visual_pending"),
        (k % 6 > 0).alias("supported"),
        (k % 7 > 0).alias("readable"),
        F.when(k % 37 == 0, 0).otherwise(100).alias("n_rows"),
        F.when(k % 8 == 0, 99).otherwise(100).alias("declared_rows"),
        (k % 9 > 0).alias("has_time"),
        (k % 11 > 0).alias("strictly_increasing"),
        (k % 10 == 0).cast("int").alias("gaps"),
        (k % 14 / 40.0).alias("jitter"),
        F.when(k % 2 == 0, k % 13 / 100.0).alias("rate_error"),
        (k % 12 > 0).alias("has_index"),
        (k % 15 > 0).alias("contiguous"),
        (k % 16 > 0).alias("has_state"),
        (k % 32 > 0).alias("has_action"),
        _pick(["passed", "passed", "low_confidence", "pending", "passed"], k % 5).alias("alignment_status"),
        (k % 2 > 0).alias("mapping_verified"),
    )
    return rows.join(au.signal_codes(_signals(spark, sf_dir), "o_orderkey"), "o_orderkey", "left")


CODES = ("failures", "warnings", "action_blockers", "video_blockers", "passed_checks", "pending_checks")


def episode_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of an episode, their codes, and what three training stages accept."""
    audited = au.audit(_episodes(spark, sf_dir), "o_orderkey").join(_episodes(spark, sf_dir).select("o_orderkey", "prompt_usable"), "o_orderkey")
    mode = F.when(F.size("failures") > 0, "reject").when(F.col("action_verified"), "joint_video_action").otherwise("video_only")
    out = au.admission_stages(audited.withColumn("mode", mode).withColumn("reasons", F.col("failures")))
    return out.select("o_orderkey", *[c for c in out.columns if c.endswith("_stage")], *[F.array_join(c, ",").alias(c) for c in (*CODES, "stage1_reasons", "stage2_reasons", "stage3_reasons")], "native_action_verified", "action_verified", "mode", "stage1", "stage2")


# --- canonical episodes ---------------------------------------------------------------------------------------


def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _k()
    records = table(spark, sf_dir, "orders").select(
        "o_orderkey", _pick("AABBBC", k % 6).alias("tier"), _pick(["joint_video_action", "video_only", "video_only", "reject"], k % 4).alias("mode"), (k % 5 > 0).alias("supported"), (k % 7 > 0).alias("opened"), (k % 11).alias("n_rows"),
        F.when(k % 13 > 0, k % 3).alias("num_frames"), (k % 17 > 5).alias("has_time"), F.when(k % 19 > 8, 20.0).alias("fps"), (k % 23 > 3).alias("increasing"),
    )
    return ma.skip_reason(records).select("o_orderkey", "reason").unionByName(ma.skip_reason(records, with_tier_b=False).select((-_k()).alias("o_orderkey"), "reason"))


def rescaled_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' clocks, every third in nanoseconds."""
    rows = frames(spark, sf_dir)
    rows = rows.select("episode_id", "idx", F.when(F.col("episode_id") % 3 == 0, F.col("t") * 1e9).otherwise(F.col("t")).alias("t"))
    out = ma.seconds_from_zero(rows, ["episode_id"], "t", "idx")
    last = out.groupBy("episode_id").agg(F.max("t").alias("last")).withColumn("frames", ma.target_count(F.col("last"), 0.01))
    return rounded(last, 1)


def derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").cast("bigint").alias("label"), "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("pose"))
    derived = [
        {"target": "picked", "source": "pose", "op": "identity", "indices": [4, 2, 60]},
        {"target": "next", "source": "picked", "op": "next_row_hold_last"},
        {"target": "gone", "source": "absent", "op": "identity"},
        {"target": "turned", "source": "pose", "op": "pose_quaternion_wxyz_to_rotvec", "indices": [0, 1, 2, 3, 4, 5, 6]},
        {"target": "pose", "source": "pose", "op": "identity", "indices": [1]},
    ]
    out = ma.read_with_derived(rows, ["label"], "vec_id", derived, ["pose", "picked", "next", "gone", "turned"])
    cells = [F.get("pose", F.lit(0)).alias("p0"), F.size("pose").cast("bigint").alias("n_pose"), F.get("next", F.lit(0)).alias("n0"), F.get("next", F.lit(2)).alias("n2"), F.get("turned", F.lit(2)).alias("z"), F.sqrt(sum((F.get("turned", F.lit(i)) * F.get("turned", F.lit(i)) for i in (3, 4, 5)), F.lit(0.0))).alias("angle")]
    return rounded(out.select("label", "vec_id", *cells), 5)


def canonical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's first events at one frame in 1,000 seconds: a blended slot with holes, a held one, and one that no source has."""
    rows = frames(spark, sf_dir).where("idx < 12")
    value = F.when((F.col("idx") + F.col("episode_id")) % 5 == 2, F.lit(float("nan"))).otherwise(F.col("value"))
    rows = rows.select("episode_id", "idx", "t", F.array(value, F.col("idx").cast("double")).alias("v"))
    out = ma.canonical_rows(rows, ["episode_id"], "idx", "t", [(0, 3), (1, 6)], [6], "v", 8, fps=0.001)
    return rounded(out.select("episode_id", "frame", *[F.get("values", F.lit(k)).alias(f"v{k}") for k in (0, 3, 6)], *[F.get("mask", F.lit(k)).alias(f"m{k}") for k in (0, 3, 6)]), 2)


# --- mappings and cases ------------------------------------------------------------------------------------------


def mapping_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    entries = lines.select("l_orderkey", F.col("line").alias("ordinal"), F.col("flag").alias("source_key"), (F.col("q") % 9).alias("source_index"), (F.col("part") % 86 - 2).alias("slot"))
    features = lines.where("q > 4").groupBy("l_orderkey", F.col("flag").alias("source_key")).agg(F.when(F.min("q") % 3 > 0, F.lit(6)).alias("width"))
    return ca.mapping_problems(entries, features, ["l_orderkey"])


def mapping_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select("l_orderkey", "line", F.when(F.col("q") % 5 > 0, (F.col("part") % 20).cast("int")).alias("slot"), F.when(F.col("q") % 7 > 0, "high").otherwise("medium").alias("confidence"))
    out = ca.mapping_verdict(cu.mapping_with_collisions(lines, ["l_orderkey"], "slot", ["line"]), ["l_orderkey"])
    return out.withColumn("valid_slots", F.array_join("valid_slots", ","))


def held_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select("l_orderkey", (F.col("part") % 20).cast("int").alias("slot"), (F.col("q") % 3 > 0).alias("active"), _pick(["left_Gripper", "joint_1", None], F.col("line") % 3).alias("semantic"))
    return au.zero_order(ca.unverified(lines).withColumn("active", F.col("candidate")), ["l_orderkey"]).select("l_orderkey", F.array_join("slots", ",").alias("slots"))


def case_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _k()
    tasks = F.when(k % 3 == 0, F.array(F.concat(F.lit("  pick "), F.col("o_orderstatus")), F.lit(None).cast("string"), F.concat(F.lit("pick\t"), F.col("o_orderstatus")), F.lit("place"))).when(k % 3 == 1, F.array(F.lit(" ")))
    said = ca.prompt(tasks, F.when(k % 4 > 0, F.concat(F.lit("lab/pick_up__"), F.col("o_orderstatus"))), F.when(k % 5 > 0, "task_namespace"))
    return table(spark, sf_dir, "orders").select("o_orderkey", said.alias("p")).select("o_orderkey", "p.primary", F.array_join("p.alternatives", ",").alias("alternatives"), "p.valid", "p.source")


def case_cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    key = F.concat(F.lit("cam"), F.col("line").cast("string")).alias("source_key")
    cameras = lines.select("l_orderkey", key, F.when(F.col("q") % 3 == 0, "").when(F.col("q") % 3 == 1, "tar://a!m").alias("source_uri"))
    reports = lines.where("q % 2 = 0").select("l_orderkey", key, _pick(["passed", "failed", "passed"], F.col("q") % 3).alias("status"), F.when(F.col("q") % 5 == 0, "failed").alias("sparse_status"))
    videos = lines.where("q % 7 > 2").select("l_orderkey", key, F.concat(F.lit("file/"), F.col("q").cast("string")).alias("uri"))
    out = ca.with_reports(cameras, reports, videos, ["l_orderkey", "source_key"])
    return out.withColumn("failed", ca.failed_camera())


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _k()
    return table(spark, sf_dir, "orders").select(
        k.alias("episode_id"), _pick(["a", "b", "c"], k % 3).alias("dataset"), F.when(k % 4 == 0, F.concat(F.lit("line"), (k % 50).cast("string"))).alias("lineage_id"), F.when(k % 4 == 1, F.concat(F.lit("uri"), k.cast("string"))).alias("source_uri"),
        F.when(k % 6 > 0, F.array(F.col("o_orderpriority"))).alias("tasks"), F.lit("space/one").alias("task_namespace"), _pick("AABD", k % 4).alias("tier"), F.when(k % 2 == 0, "joint_video_action").otherwise("video_only").alias("mode"), (k % 10 / 10.0).alias("audit_weight"),
        F.when(k % 21 == 0, 30.0).otherwise(20.0).alias("target_fps"), F.lit(81).alias("state_steps"), F.lit(80).alias("action_steps"), F.array_repeat(F.lit(True), 80).alias("state_slot_mask"), F.array_repeat(F.lit(True), 80).alias("action_slot_mask"),
        F.lit("u").alias("canonical_uri"), (k % 40).alias("start"), (k % 40 + 80).alias("stop"), F.lit(40).cast("bigint").alias("stride"), F.lit(2).alias("start_count"),
    )


def _cases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    profiles = spark.createDataFrame([("a", 2.0, None), ("b", 0.0, "task_namespace")], "dataset string, mixture_weight double, language_fallback string")
    roles = F.array(*[F.lit(x) for x in ("global_primary", "global_secondary", "left_wrist", "right_wrist", "auxiliary")])
    slots = table(spark, sf_dir, "orders").where("o_orderkey % 17 <> 0").select(_k().alias("episode_id"), roles.alias("camera_roles"), F.sequence(F.lit(0), F.lit(4)).alias("camera_indices"), F.array_repeat(_k() % 9 > 0, 5).alias("camera_mask"))
    return ca.build(_windows(spark, sf_dir), profiles, slots)


def case_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = _cases(spark, sf_dir)
    kept = ["episode_id", "split_group_id", "case_id", "split", "sample_weight", "action_loss"]
    one = ca.checked(good).select(*kept, F.col("prompt.primary").alias("prompt"), F.lit("").alias("failures"))
    return rounded(one.unionByName(bad.select(*kept, F.col("prompt.primary").alias("prompt"), F.array_join("failures", ",").alias("failures"))))


def case_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.filtered(_cases(spark, sf_dir)[0], tiers=("A", "B")).select("episode_id", "tier", "split")


def case_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select("l_orderkey", "line", F.col("flag").alias("domain"), (F.col("line") % 3).alias("slot"), F.when(F.col("q") % 9 > 0, F.col("price")).alias("value"))
    known = lines.groupBy("domain", "slot").agg(F.avg("value").alias("mean"), (F.stddev_pop("value") / 20).alias("std"), (F.max("slot") < 2).alias("valid"))
    return rounded(ca.normalised(lines, known, ["domain", "slot"]).select("l_orderkey", "line", "z"), 4)


QUERIES = {
    f.__name__: f
    for f in (
        dimension_meanings, meaning_overrides, slot_pairs, slot_alignment, visual_intervals, visual_reports, visual_stages, trajectory_fingerprints, signal_codes, episode_audit, skip_reasons, rescaled_clock, derived_columns, canonical_rows,
        mapping_problems, mapping_verdicts, held_slots, case_prompts, case_cameras, case_build, case_filter, case_normalised,
    )
}


# --- SQL ------------------------------------------------------------------------------------------------------------


def _codes(*pairs: str) -> str:
    """A sorted, joined list of the codes whose conditions hold: condition, code, condition, code ..."""
    cells = ", ".join(f"CASE WHEN {c} THEN {code} END" for c, code in zip(pairs[::2], pairs[1::2], strict=True))
    return f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{cells}], lambda x: x IS NOT NULL))), ','), '')"


_DIM = f"""d AS (SELECT p_partkey // 6 AS episode, {list(SOURCES)}[(p_partkey // 6) % 4 + 1] AS source_key, p_partkey % 6 AS dim,
 {list(NAMES)}[(p_partkey % 6 + CASE (p_partkey // 6) % 3 WHEN 0 THEN 0 WHEN 1 THEN 4 ELSE (p_partkey // 6) % 7 END) % 12 + 1] AS name FROM part),
g AS (SELECT *, CASE WHEN name LIKE 'base_orientation%' THEN 'base_orientation' WHEN source_key = 'state/quat' AND name IN ('x', 'y', 'z', 'w') THEN source_key END AS grp, right(name, 1) AS axis FROM d),
whole AS (SELECT episode, source_key, grp FROM g WHERE grp IS NOT NULL GROUP BY ALL HAVING count(DISTINCT axis) = 4),
meant AS (SELECT episode, source_key, dim, name, w.grp AS quaternion, CASE WHEN w.grp IS NOT NULL THEN 'quaternion_component' WHEN source_key LIKE '%gripper%' OR name LIKE '%gripper%' THEN 'zero_order_gripper' END AS meaning, name = 'arm_yaw_rad' AS angle FROM g LEFT JOIN whole w USING (episode, source_key, grp))"""
_GRAY = "p AS (SELECT vec_id // 5 AS camera, vec_id % 5 AS sample, (vec_id % 5 * 2 + vec_id % 2)::DOUBLE AS t, list_transform(embedding, lambda x: least(255, greatest(0, floor((x::DOUBLE + 0.5) * 255)::INT))) AS p FROM embeddings)"
_SAMPLES = f"""{_GRAY}, b AS (SELECT *, list_transform(range(0, 16), lambda b: len(list_filter(p, lambda x: x // 16 = b)) / 64.0) AS h, list_transform(list_transform(range(0, 36), lambda k: (k // 6 + 1) * 8 + k % 6 + 2), lambda i: (4 * p[i] - p[i - 1] - p[i + 1] - p[i - 8] - p[i + 8])::DOUBLE) AS lap,
 list_sum(list_transform(range(0, 64), lambda k: CASE WHEN p[(k // 8) * 8 + round_even(k % 8 * 7 / 8.0, 0)::INT + 1] > p[(k // 8) * 8 + round_even((k % 8 + 1) * 7 / 8.0, 0)::INT + 1] THEN (1::UBIGINT << (63 - k)::UBIGINT) ELSE 0::UBIGINT END))::UBIGINT AS code FROM p),
s AS (SELECT camera, sample, t, p, code, list_sum(p) / 64.0 AS luma, -list_sum(list_transform(h, lambda q: CASE WHEN q > 0 THEN q * log2(q) ELSE 0 END)) / 4.0 AS entropy, (list_sum(list_transform(lap, lambda x: x * x)) / 36 - (list_sum(lap) / 36) ** 2) / 65025.0 AS sharp,
 len(list_filter(p, lambda x: x <= 60)) / 64.0 >= 0.2 AS dark, len(list_filter(p, lambda x: x >= 190)) / 64.0 >= 0.2 AS bright FROM b),
f AS (SELECT *, entropy < 0.78 AS dull, sharp < 0.55 AS soft FROM s)"""
_SIG = f"""{_L}, s AS (SELECT l_orderkey AS k, 's' || line AS n, line % 3 > 0 AS use, q % 23 > 0 AS here, q % 23 > 0 AND q % 19 = 0 AS ragged, q % 23 > 0 AND q % 17 = 0 AS holes, q % 23 > 0 AND q % 10 / 30.0 > 0.2 AND q % 4 / 40.0 > 0.05 AS wild, q % 23 > 0 AND q % 10 / 30.0 > 0.02 AS jumpy,
 q % 23 > 0 AND q % 8 = 0 AS flat, q % 23 > 0 AND q % 9 = 0 AS flips, q % 23 > 0 AND q % 31 = 0 AS norm, q % 23 > 0 AND q % 29 = 0 AS turn FROM l),
c AS (SELECT k, n, use, unnest([CASE WHEN NOT here THEN 'signal_column_missing:' || n END, CASE WHEN ragged THEN 'variable_signal_width:' || n END, CASE WHEN wild THEN 'excessive_abrupt_steps:' || n END, CASE WHEN holes THEN 'non_finite_signal:' || n END]) AS code FROM s),
kin AS (SELECT k, unnest([CASE WHEN norm THEN 'quaternion_norm_outlier:' || n END, CASE WHEN turn THEN 'rapid_quaternion_rotation:' || n END]) AS code FROM s),
warn AS (SELECT k, code FROM kin UNION ALL SELECT k, code FROM c WHERE code LIKE 'non_finite%' UNION ALL SELECT k, 'monitor_only_' || code FROM c WHERE NOT use AND code NOT LIKE 'non_finite%' UNION ALL SELECT k, 'frequent_abrupt_steps:' || n FROM s WHERE jumpy UNION ALL SELECT k, 'constant_signal_dimensions:' || n FROM s WHERE flat),
sig AS (SELECT k, bool_or(flips) AS flips FROM s GROUP BY 1),
sc AS (SELECT sig.k, flips, (SELECT coalesce(list(DISTINCT code), []) FROM c WHERE c.k = sig.k AND code IS NOT NULL) AS r, (SELECT coalesce(list(DISTINCT code), []) FROM c WHERE c.k = sig.k AND use AND code IS NOT NULL) AS b, (SELECT coalesce(list(DISTINCT code), []) FROM warn w WHERE w.k = sig.k AND code IS NOT NULL) AS w, (SELECT coalesce(list(DISTINCT code), []) FROM kin WHERE kin.k = sig.k AND code IS NOT NULL) AS m FROM sig)"""
_ALIGN = f"""{FRAMES}, a AS (SELECT episode_id, idx, CASE WHEN idx % 17 <> 3 THEN value END AS act, avg(value) OVER (PARTITION BY episode_id ORDER BY idx ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS mean, value AS raw, CASE WHEN episode_id % 4 = 0 THEN 20.0 ELSE episode_id % 4 * 5.0 END AS fps FROM frames),
st AS (SELECT episode_id, 7 AS slot, idx, act, mean AS state, fps FROM a UNION ALL SELECT episode_id, 9, idx, act, CASE WHEN idx > 0 THEN raw * fps END, fps FROM a),
lags AS (SELECT x.episode_id, x.slot, lag, count(*) AS n, corr(x.act, y.state) AS r FROM st x CROSS JOIN range(0, 41) l(lag) JOIN st y ON x.episode_id = y.episode_id AND x.slot = y.slot AND y.idx = x.idx + lag WHERE x.act IS NOT NULL AND y.state IS NOT NULL AND lag <= greatest(1, least(40, round_even(x.fps * 0.5, 0))) GROUP BY 1, 2, 3 HAVING count(*) >= 8 AND stddev_pop(x.act) > 1e-12 AND stddev_pop(y.state) > 1e-12),
med AS (SELECT episode_id, lag, median(r) AS score, count(*) AS dims FROM lags GROUP BY 1, 2), best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY round(score, 12) DESC, lag) AS o FROM med) WHERE o = 1)"""

_P = {
    "native": "k % 6 = 0", "broken": "k % 6 > 0 AND k % 7 = 0", "deep": "(k % 6 > 0 AND k % 7 > 0)", "schema": "(k % 16 > 0 OR k % 32 > 0)", "both": "(k % 16 > 0 AND k % 32 > 0)",
}
_AUDIT = f"""{_SIG}, o AS (SELECT o_orderkey AS k, coalesce(sc.r, []) AS sr, coalesce(sc.b, []) AS sb, coalesce(sc.w, []) AS sw, coalesce(sc.m, []) AS sm, coalesce(sc.flips, false) AS flips FROM orders LEFT JOIN sc ON sc.k = o_orderkey),
e AS (SELECT *, k % 6 = 0 AS native, {_P['broken']} AS broken, {_P['deep']} AS deep, {_P['schema']} AS sch, {_P['both']} AND k % 5 IN (0, 1, 4) AS al, {_P['both']} AND k % 5 = 2 AS vague, k % 4 > 0 AND k % 3 = 2 AS vfail FROM o),
t AS (SELECT *, deep AND k % 9 > 0 AND k % 11 = 0 AS jump, deep AND k % 9 > 0 AND k % 10 = 0 AS gap, deep AND k % 9 = 0 AS untimed, deep AND k % 12 > 0 AND k % 15 = 0 AS torn, deep AND k % 37 = 0 AS empt, deep AND (CASE WHEN k % 8 = 0 THEN 99 ELSE 100 END) <> (CASE WHEN k % 37 = 0 THEN 0 ELSE 100 END) AS short FROM e),
u AS (SELECT *, deep AND NOT jump AND NOT gap AND NOT untimed AND NOT torn AS clock, deep AND sch AND len(sb) = 0 AS sok, deep AND sch AND len(sm) = 0 AS kok FROM t),
v AS (SELECT *, deep AND {_P['both']} AND clock AND sok AND al AND NOT empt AND NOT jump AND NOT vfail AND NOT short AS ver FROM u)"""


def _joined(*lists: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list_filter({' || '.join(lists)}, lambda x: x IS NOT NULL))), ',')"


def _list(*pairs: str) -> str:
    return "[" + ", ".join(f"CASE WHEN {c} THEN '{code}' END" for c, code in zip(pairs[::2], pairs[1::2], strict=True)) + "]"


_FAIL = _list("broken", "episode_data_unreadable", "empt", "empty_episode", "jump", "temporal_discontinuity", "vfail", "all_video_containers_failed")
_BLOCK = "(" + _list(
    "native", "native_format_not_converted", "broken", "episode_data_unreadable", "short", "metadata_row_count_mismatch", "jump", "temporal_discontinuity", "gap", "timestamp_gaps", "untimed", "timestamp_missing", "torn", "frame_index_not_contiguous",
    "deep AND NOT sch", "state_or_action_schema_missing", "deep AND vague", "low_action_state_alignment", "deep AND NOT al AND NOT vague", "action_state_alignment_pending", "ver AND k % 2 = 0", "canonical_action_mapping_unverified",
) + " || CASE WHEN deep THEN sb ELSE [] END)"
_JOINT = "(ver AND k % 2 > 0)"
_REJECT = "(broken OR empt OR jump OR vfail)"

ORACLE_SQL = {
    "dimension_meanings": f"WITH {_DIM} SELECT episode, source_key, dim, name, quaternion, meaning, angle FROM meant",
    "meaning_overrides": f"""WITH {_DIM}, q AS (SELECT *, meaning = 'quaternion_component' IS TRUE AS qq, meaning = 'zero_order_gripper' AS gg FROM meant), z AS (SELECT episode, dim, meaning, coalesce(meaning = 'quaternion_component', false) AS qq, coalesce(meaning = 'zero_order_gripper', false) AS gg FROM meant)
SELECT episode, dim, meaning, CASE WHEN qq THEN 0 ELSE dim END AS abrupt_steps, CASE WHEN qq THEN 0.0::DOUBLE ELSE round(dim / 10.0, 6) END AS abrupt_ratio, CASE WHEN gg THEN 0 ELSE dim * 2 END AS extreme_steps, CASE WHEN gg THEN 0.0::DOUBLE ELSE round(dim / 20.0, 6) END AS extreme_ratio,
 CASE WHEN qq OR gg THEN 0 ELSE 3 END::BIGINT AS derivative_outliers, CASE WHEN qq THEN dim END AS raw_abrupt_steps, CASE WHEN gg THEN dim * 2 END AS raw_extreme_steps FROM z""",
    "slot_pairs": f"""WITH {_L}, m AS (SELECT l_orderkey AS episode, (part % 70)::INT AS slot, min(q) AS q, min(flag) AS flag FROM l GROUP BY 1, 2)
SELECT episode, slot, CASE WHEN flag = 'A' AND q % 6 <> 0 THEN 'action_vs_state_derivative' ELSE 'direct_feedback' END AS comparison FROM m WHERE q % 7 > 0 AND q % 11 > 0 AND slot < 64 AND q % 5 <> 0 AND (slot >= 6 OR (q % 5 = 1 AND q % 3 = 0))""",
    "slot_alignment": f"""WITH {_ALIGN}, e AS (SELECT DISTINCT episode_id, fps FROM a) SELECT e.episode_id, CASE WHEN lag IS NULL THEN 'pending' WHEN score >= 0.2 THEN 'passed' ELSE 'low_confidence' END AS status, lag AS best_lag, round(1000.0 * lag / e.fps, 5) AS best_lag_ms, round(score, 5) AS score, dims FROM e LEFT JOIN best USING (episode_id)""",
    "visual_intervals": f"""WITH {_SAMPLES}, n AS (SELECT *, lag(dark) OVER w AS d1, lead(dark) OVER w AS d2, lag(bright) OVER w AS b1, lead(bright) OVER w AS b2, lag(t) OVER w AS t1, lead(t) OVER w AS t2 FROM f WINDOW w AS (PARTITION BY camera ORDER BY sample)),
h AS (SELECT *, (dark AND (coalesce(d1, false) OR coalesce(d2, false))) OR (bright AND (coalesce(b1, false) OR coalesce(b2, false))) AS near, coalesce((t1 + t) / 2, 0.0) AS l, CASE WHEN t2 IS NOT NULL THEN (t + t2) / 2 WHEN t1 IS NOT NULL THEN t + (t - t1) / 2 ELSE t + 1e-3 END AS r FROM n),
x AS (SELECT *, unnest(list_filter([CASE WHEN dark THEN 'extreme_dark' END, CASE WHEN bright THEN 'extreme_bright' END, CASE WHEN dull THEN 'low_entropy' END, CASE WHEN soft THEN 'low_sharpness' END], lambda v: v IS NOT NULL)) AS reason FROM h)
SELECT camera, sample, reason, CASE WHEN reason LIKE 'extreme%' AND near THEN 'hard' ELSE 'soft' END AS severity, round(greatest(0.0, l), 6) AS start_s, round(greatest(l + 1e-6, r), 6) AS stop_s FROM x""",
    "visual_reports": f"""WITH {_SAMPLES}, o AS (SELECT camera, sample, p, code, lag(p) OVER w AS q, lag(code) OVER w AS c2 FROM f WINDOW w AS (PARTITION BY camera ORDER BY sample)), pr AS (SELECT camera, list_sum(list_transform(range(1, 65), lambda i: abs(p[i] - q[i]))) / 64.0 / 255.0 AS mad, bit_count(xor(code, c2)) AS hm FROM o WHERE q IS NOT NULL),
pf AS (SELECT camera, bool_and(mad <= 0.14 AND hm <= 30) AS af, bool_or(mad <= 0.14 AND hm <= 30) AS nf, median(mad) AS md FROM pr GROUP BY 1),
r AS (SELECT camera, count(*) AS n, bool_and(dark OR bright) AS ax, bool_or(dark) AS d, bool_or(bright) AS b, bool_or(dull) AS e, bool_or(soft) AS s, median(luma) AS luma, min(entropy) AS me, min(sharp) AS ms, sha256(string_agg(lpad(lower(to_hex(code)), 16, '0'), '|' ORDER BY sample)) AS fp FROM f GROUP BY 1)
SELECT camera, CASE WHEN ax THEN 'failed' WHEN d OR b OR e OR s OR coalesce(nf, false) THEN 'warning' ELSE 'passed' END AS status, n AS samples, {_codes("b", "'extreme_bright'", "d", "'extreme_dark'", "e", "'low_entropy'", "s", "'low_sharpness'", "nf", "'possible_frozen_video'")} AS flags, ax AS all_extreme, coalesce(af, false) AS all_frozen,
 round(luma, 5) AS median_luma, round(me, 5) AS least_entropy, round(ms, 5) AS least_sharpness, round(md, 5) AS median_difference, fp AS fingerprint FROM r LEFT JOIN pf USING (camera)""",
    "visual_stages": f"""WITH c AS (SELECT c_custkey // 3 AS episode, ['passed', 'failed', 'passed', 'pending', 'passed'][c_custkey % 5 * (c_custkey % 2) + 1] AS st, CASE WHEN c_custkey % 4 > 0 THEN ['passed', 'warning', 'failed', 'pending', 'passed', 'failed', 'failed'][c_custkey % 7 + 1] END AS sp, CASE WHEN c_custkey % 6 > 0 THEN sha256(c_custkey::VARCHAR) END AS fp FROM customer),
g AS (SELECT episode, bool_and(st = 'failed') AS nothing, bool_and(st = 'pending') AS unread, bool_or(st = 'passed') AS opened, bool_or(st = 'failed') AS broken, count(*) FILTER (WHERE st = 'passed' AND sp <> 'pending') AS j, count(*) FILTER (WHERE st = 'passed' AND sp = 'failed') AS nf, count(*) FILTER (WHERE st = 'passed' AND sp IN ('failed', 'warning')) AS nw, sha256(string_agg(fp, '|' ORDER BY fp)) AS visual_sha256 FROM c GROUP BY 1),
h AS (SELECT *, NOT nothing AND NOT unread AS rd, j > 0 AND nf = j AS dk FROM g)
SELECT episode, CASE WHEN nothing THEN 'failed' WHEN unread THEN 'pending' WHEN dk THEN 'failed' WHEN nw > 0 THEN 'warning' ELSE 'passed' END AS visual_status, {_codes("nothing", "'all_video_containers_failed'", "rd AND dk", "'all_sampled_camera_visual_quality_failed'")} AS visual_failures,
 {_codes("NOT nothing AND broken", "'partial_camera_audit_failure'", "rd AND NOT dk AND nw > 0", "'sparse_visual_quality_flags'")} AS visual_warnings, {_codes("NOT nothing AND opened", "'visual_container'", "rd AND j > 0 AND nw = 0", "'sparse_visual_quality'")} AS visual_passed,
 {_codes("NOT nothing AND unread", "'visual_format_audit'", "rd AND j = 0", "'sparse_visual_quality'")} AS visual_pending, visual_sha256 FROM h""",
    "trajectory_fingerprints": f"""WITH {FRAMES}, n AS (SELECT episode_id, count(*) AS n, least(32, count(*)) AS k FROM frames GROUP BY 1), x AS (SELECT DISTINCT episode_id, n, round_even(i * (n - 1)::DOUBLE / greatest(k - 1, 1), 0)::BIGINT AS idx FROM n CROSS JOIN range(0, 32) r(i) WHERE i < k),
v AS (SELECT x.episode_id, n, x.idx, CASE x.idx % 13 WHEN 5 THEN 'nan' WHEN 6 THEN '-inf' ELSE printf('%.6f', round(value, 6) + 0.0) END || ',' || printf('%.6f', x.idx::DOUBLE) AS a, printf('%.6f', round(-value, 6) + 0.0) AS b FROM x JOIN frames f ON f.episode_id = x.episode_id AND f.idx = x.idx),
l AS (SELECT episode_id, n, 'a' AS s, idx, 'a:' || idx || ':' || a AS t FROM v UNION ALL SELECT episode_id, n, 'b', idx, 'b:' || idx || ':' || b FROM v) SELECT episode_id, n AS rows, sha256(n || '#' || string_agg(t, '|' ORDER BY s, idx)) AS trajectory_sha256 FROM l GROUP BY 1, 2""",
    "signal_codes": f"WITH {_SIG} SELECT k AS o_orderkey, {_joined('r')} AS signal_reasons, {_joined('b')} AS signal_blockers, {_joined('w')} AS signal_warnings, {_joined('m')} AS kinematic_reasons, flips AS sign_flips FROM sc",
    "episode_audit": f"""WITH {_AUDIT} SELECT k AS o_orderkey, CASE WHEN k % 5 > 0 THEN 'passed' ELSE 'pending' END AS language_stage, CASE WHEN k % 4 = 0 THEN 'pending' ELSE ['passed', 'warning', 'failed'][k % 3 + 1] END AS visual_stage,
 CASE WHEN native THEN 'pending' WHEN broken OR empt THEN 'failed' WHEN short THEN 'warning' ELSE 'passed' END AS structure_stage, CASE WHEN NOT deep THEN 'pending' WHEN jump THEN 'failed' WHEN clock THEN 'passed' ELSE 'warning' END AS temporal_stage,
 CASE WHEN NOT deep THEN 'pending' WHEN sok THEN 'passed' ELSE 'warning' END AS signal_stage, CASE WHEN NOT deep OR NOT sch THEN 'pending' WHEN kok THEN 'passed' ELSE 'warning' END AS kinematic_stage, CASE WHEN NOT deep THEN 'pending' WHEN al THEN 'passed' WHEN vague THEN 'low_confidence' ELSE 'pending' END AS alignment_stage,
 {_joined(_FAIL)} AS failures,
 {_joined(_list("k % 5 = 0", "missing_or_unusable_task_prompt", "short", "metadata_row_count_mismatch", "gap", "timestamp_gaps", "deep AND k % 9 > 0 AND k % 14 / 40.0 > 0.25", "high_timestamp_jitter", "deep AND k % 9 > 0 AND k % 2 = 0 AND k % 13 / 100.0 > 0.1", "declared_fps_mismatch", "torn", "frame_index_not_contiguous", "deep AND vague", "low_action_state_alignment", "k % 3 = 1", "sparse_visual_quality_flags"), "CASE WHEN deep THEN sw ELSE [] END")} AS warnings,
 {_joined(_BLOCK)} AS action_blockers, {_joined(_list("broken", "episode_data_unreadable", "empt", "empty_episode", "vfail", "all_video_containers_failed"))} AS video_blockers,
 {_joined(_list("k % 5 > 0", "language", "deep AND NOT empt", "episode_data_readable", "clock", "temporal", "sok", "signal", "kok", "kinematic", "deep AND al", "action_state_alignment", "deep AND flips", "quaternion_sign_continuity", "k % 3 = 0", "visual_container"))} AS passed_checks,
 {_joined(_list("k % 5 = 0", "language_review", "k % 4 = 0", "visual", "native", "native_format_deep_audit", "untimed", "timestamp_missing", "deep AND k % 12 = 0", "frame_index_missing", "deep AND NOT sch", "schema_inference", "deep AND vague", "action_state_alignment_review", "deep AND NOT al AND NOT vague", "action_state_alignment", "ver AND k % 2 = 0", "canonical_action_mapping_review"))} AS pending_checks,
 {_joined(f"CASE WHEN {_REJECT} THEN {_FAIL} ELSE [] END", _list("k % 5 = 0", "language_missing_or_fallback_required"))} AS stage1_reasons, {_joined(_BLOCK, _list("NOT " + _JOINT + " OR " + _REJECT, "joint_video_action_not_verified"))} AS stage2_reasons,
 {_joined(_BLOCK, _list("NOT " + _JOINT + " OR " + _REJECT, "joint_video_action_not_verified", _JOINT + " AND NOT " + _REJECT, "target_dataset_and_success_policy_required"))} AS stage3_reasons,
 ver AS native_action_verified, {_JOINT} AS action_verified, CASE WHEN {_REJECT} THEN 'reject' WHEN {_JOINT} THEN 'joint_video_action' ELSE 'video_only' END AS mode, NOT {_REJECT} AS stage1, {_JOINT} AND NOT {_REJECT} AS stage2 FROM v""",
    "skip_reasons": """WITH r AS (SELECT o_orderkey AS k, ['A', 'A', 'B', 'B', 'B', 'C'][o_orderkey % 6 + 1] AS tier, o_orderkey % 4 AS m, CASE WHEN o_orderkey % 13 > 0 THEN o_orderkey % 3 ELSE 0 END AS nf, o_orderkey % 19 > 8 AS rated FROM orders),
b AS (SELECT *, 1 AS sign FROM r UNION ALL SELECT *, -1 FROM r) SELECT k * sign AS o_orderkey, CASE WHEN tier = 'C' OR m = 3 OR (sign < 0 AND tier = 'B') THEN 'training_admission_or_quality_tier' WHEN k % 5 = 0 THEN CASE WHEN m NOT IN (1, 2) OR nf < 2 OR NOT rated THEN 'native_converter_or_timeline_metadata_required' END
 WHEN k % 7 = 0 THEN 'materialization_failed' WHEN k % 11 < 2 THEN 'too_few_rows' WHEN k % 17 <= 5 THEN CASE WHEN NOT rated THEN 'timestamp_and_fps_missing' END WHEN k % 23 <= 3 THEN 'non_monotonic_timestamp' END AS reason FROM b""",
    "rescaled_clock": f"WITH {FRAMES} SELECT episode_id, round(max(t) - min(t), 1) AS last, floor((max(t) - min(t)) * 0.01 + 1e-8)::BIGINT + 1 AS frames FROM frames GROUP BY 1",
    "derived_columns": """WITH e AS (SELECT label::BIGINT AS label, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r, count(*) OVER (PARTITION BY label) AS n FROM embeddings)
SELECT e.label, e.vec_id, round(e.v[2], 5) AS p0, 1::BIGINT AS n_pose, round(coalesce(x.v[5], e.v[5]), 5) AS n0, round(coalesce(x.v[61], e.v[61]), 5) AS n2, round(e.v[3], 5) AS z, round(abs(CASE WHEN 2 * atan2(sqrt(e.v[5] ** 2 + e.v[6] ** 2 + e.v[7] ** 2), e.v[4]) > pi() THEN 2 * atan2(sqrt(e.v[5] ** 2 + e.v[6] ** 2 + e.v[7] ** 2), e.v[4]) - 2 * pi() ELSE 2 * atan2(sqrt(e.v[5] ** 2 + e.v[6] ** 2 + e.v[7] ** 2), e.v[4]) END), 5) AS angle
FROM e LEFT JOIN e x ON x.label = e.label AND x.r = e.r + 1""",
    "canonical_rows": f"""WITH {FRAMES}, s AS (SELECT episode_id, idx, t - min(t) OVER (PARTITION BY episode_id) AS t, CASE WHEN (idx + episode_id) % 5 <> 2 THEN value::FLOAT::DOUBLE END AS v FROM frames WHERE idx < 12), n AS (SELECT episode_id, floor(max(t) * 0.001 + 1e-8)::BIGINT AS last FROM s GROUP BY 1),
k AS (SELECT episode_id, unnest(range(0, last + 1)) AS frame FROM n), a AS (SELECT k.episode_id, frame, max(idx) AS i FROM k JOIN s ON s.episode_id = k.episode_id AND s.t <= frame * 1000.0 + 1e-6 GROUP BY 1, 2),
b AS (SELECT a.*, l.v AS lv, r.v AS rv, r.idx IS NULL OR (frame * 1000.0 - l.t) / (r.t - l.t) < 1e-9 AS hit, (frame * 1000.0 - l.t) / (r.t - l.t) AS x FROM a JOIN s l ON l.episode_id = a.episode_id AND l.idx = i LEFT JOIN s r ON r.episode_id = a.episode_id AND r.idx = i + 1)
SELECT episode_id, frame, 0.0::DOUBLE AS v0, round(coalesce(CASE WHEN hit THEN lv ELSE lv * (1 - x) + rv * x END, 0.0), 2) AS v3, i::DOUBLE AS v6, false AS m0, lv IS NOT NULL AND (hit OR rv IS NOT NULL) AS m3, true AS m6 FROM b""",
    "mapping_problems": f"""WITH {_L}, f AS (SELECT l_orderkey, flag, CASE WHEN min(q) % 3 > 0 THEN 6 END AS w FROM l WHERE q > 4 GROUP BY 1, 2), m AS (SELECT l.l_orderkey, line AS ordinal, l.flag, q % 9 AS si, part % 86 - 2 AS slot, f.l_orderkey IS NULL AS gone, w, row_number() OVER (PARTITION BY l.l_orderkey, part % 86 ORDER BY line) AS r FROM l LEFT JOIN f ON f.l_orderkey = l.l_orderkey AND f.flag = l.flag)
SELECT l_orderkey, ordinal, 'unknown_feature' AS problem FROM m WHERE gone UNION ALL SELECT l_orderkey, ordinal, 'slot_out_of_range' FROM m WHERE slot < 0 OR slot > 79 UNION ALL SELECT l_orderkey, ordinal, 'duplicate_slot' FROM m WHERE r > 1 UNION ALL SELECT l_orderkey, ordinal, 'index_out_of_range' FROM m WHERE si >= w""",
    "mapping_verdicts": f"""WITH {_L}, m AS (SELECT l_orderkey, line, (part % 20)::INT AS slot, q % 7 > 0 AS high, row_number() OVER (PARTITION BY l_orderkey, part % 20 ORDER BY line) = 1 AS kept FROM l WHERE q % 5 > 0)
SELECT l_orderkey, count(*) FILTER (WHERE kept) AS mapped, count(*) FILTER (WHERE NOT kept) AS collisions, bool_and(kept AND high) AS verified, coalesce(string_agg(slot, ',' ORDER BY slot) FILTER (WHERE kept AND high), '') AS valid_slots FROM m GROUP BY 1""",
    "held_slots": f"WITH {_L} SELECT l_orderkey, coalesce(array_to_string(list_sort(list(DISTINCT (part % 20)::INT) FILTER (WHERE q % 3 > 0 AND line % 3 = 0)), ','), '') AS slots FROM l GROUP BY 1",
    "case_prompts": """SELECT o_orderkey, CASE WHEN k % 3 = 0 THEN 'pick ' || s WHEN k % 4 > 0 AND k % 5 > 0 THEN 'lab pick up ' || s ELSE '' END AS primary, CASE WHEN k % 3 = 0 THEN 'None,place' ELSE '' END AS alternatives, k % 3 = 0 OR (k % 4 > 0 AND k % 5 > 0) AS valid,
 CASE WHEN k % 3 = 0 THEN 'tasks' WHEN k % 4 > 0 AND k % 5 > 0 THEN 'task_namespace_fallback' ELSE 'missing' END AS source FROM (SELECT o_orderkey, o_orderkey AS k, o_orderstatus AS s FROM orders)""",
    "case_cameras": f"""WITH {_L}, c AS (SELECT l_orderkey, 'cam' || line AS source_key, CASE WHEN q % 3 = 1 THEN 'tar://a!m' WHEN q % 7 > 2 THEN 'file/' || q END AS source_uri, CASE WHEN q % 2 = 0 THEN CASE WHEN q % 3 = 1 THEN 'failed' ELSE 'passed' END END AS audit_status, CASE WHEN q % 2 = 0 AND q % 5 = 0 THEN 'failed' END AS sparse_status FROM l)
SELECT *, CASE WHEN source_uri IS NULL THEN 'embedded' WHEN source_uri LIKE 'tar://%' THEN 'tar_member' ELSE 'file' END AS storage, coalesce(audit_status = 'failed', false) OR coalesce(sparse_status = 'failed', false) AS failed FROM c""",
}
_CASE = f"""w AS (SELECT o_orderkey AS k, o_orderpriority AS pr, CASE WHEN o_orderkey % 4 = 0 THEN 'line' || (o_orderkey % 50) WHEN o_orderkey % 4 = 1 THEN sha256('uri' || o_orderkey) ELSE o_orderkey::VARCHAR END AS src, CASE WHEN o_orderkey % 2 = 0 THEN 'joint_video_action' ELSE 'video_only' END AS mode FROM orders),
g AS (SELECT *, substr(sha256(src), 1, 24) AS grp, substr(sha256(k || chr(31) || (k % 40) || chr(31) || (k % 40 + 80) || chr(31) || mode), 1, 24) AS case_id, (CASE k % 3 WHEN 0 THEN 2.0 ELSE 1.0 END) * ([1.0, 1.0, 0.5, 0.0][k % 4 + 1]) * (k % 10 / 10.0) AS wt,
 CASE WHEN k % 6 > 0 THEN pr WHEN k % 3 = 1 THEN 'space one' ELSE '' END AS prompt FROM w), u AS (SELECT *, {_U.format("sha256('episodes-v1' || chr(31) || grp)")} AS u FROM g), s AS (SELECT *, CASE WHEN u < 0.98 THEN 'train' WHEN u < 0.98 + 0.01 THEN 'validation' ELSE 'test' END AS split FROM u),
c AS (SELECT *, {_codes("k % 21 = 0", "'target_fps_must_be_20'", "k % 17 = 0", "'camera_roles_must_match_fixed_five_slots'", "k % 17 = 0", "'camera_slot_indices_invalid'", "k % 17 = 0 OR k % 9 = 0", "'no_valid_camera_slot'")} AS failures FROM s)"""
ORACLE_SQL |= {
    "case_build": f"WITH {_CASE} SELECT k AS episode_id, grp AS split_group_id, case_id, split, round(wt, 6) AS sample_weight, mode = 'joint_video_action' AS action_loss, prompt, failures FROM c",
    "case_filter": f"WITH {_CASE} SELECT k AS episode_id, ['A', 'A', 'B', 'D'][k % 4 + 1] AS tier, split FROM c WHERE failures = '' AND split = 'train' AND mode = 'joint_video_action' AND k % 4 < 3",
    "case_normalised": f"""WITH {_L}, x AS (SELECT l_orderkey, line, flag, line % 3 AS slot, CASE WHEN q % 9 > 0 THEN price END AS v FROM l), m AS (SELECT flag, slot, avg(v) AS mean, stddev_pop(v) / 20 AS std FROM x GROUP BY 1, 2)
SELECT l_orderkey, line, CASE WHEN slot < 2 AND v IS NOT NULL THEN round(greatest(-10.0, least(10.0, (v - mean) / std)), 4) ELSE 0.0 END AS z FROM x JOIN m USING (flag, slot)""",
}
