"""Audits of episodes: the meaning of dimensions, alignment on common slots, sparse visual samples, and the stages that lead to
failures, warnings and blockers of an episode."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetrail.functions.scalar import finite, is_velocity
from kinetrail.operators.curation import reasons

# --- meaning of dimensions ----------------------------------------------------------------------------

# Names that say what a dimension is.
QUATERNION_NAME = r"^(.*(?:orientation|quaternion|quat))[^a-z0-9]*([xyzw])$"
QUATERNION_KEY = "orientation|quaternion|quat"
ANGLE_NAME = r"(?:^|[^a-z])(yaw|pitch|roll)(?:[^a-z]|$)|euler|_rad$|\.rad"
RATE_NAME = "velocity|speed|twist"


def dimension_meaning(dims: DataFrame, keys: list[str], source_key: str = "source_key", dim: str = "dim", name: str = "name") -> DataFrame:
    """dims with ``meaning`` (quaternion_component, zero_order_gripper or null), ``quaternion`` (its group's name) and ``angle``.

    A quaternion needs all of x, y, z and w in one group: named alike but for the axis, or bare axes under a key that says so. A key with
    gripper in it makes all of its dimensions grippers."""
    low, key = F.lower(F.coalesce(F.col(name), F.lit(""))), F.lower(F.coalesce(F.col(source_key), F.lit("")))
    group, axis = F.regexp_extract(low, QUATERNION_NAME, 1), F.regexp_extract(low, QUATERNION_NAME, 2)
    bare = F.regexp_replace(low, "[^a-z]", "")
    under = (axis == "") & key.rlike(QUATERNION_KEY) & bare.isin("x", "y", "z", "w")
    rows = dims.withColumn("__g__", F.when(axis != "", group).when(under, key)).withColumn("__a__", F.when(axis != "", axis).when(under, bare))
    axes = F.size(F.collect_set("__a__").over(Window.partitionBy(*keys, source_key, "__g__")))
    whole = F.col("__g__").isNotNull() & (axes == 4)
    gripper = key.contains("gripper") | low.contains("gripper")
    angle = low.rlike(ANGLE_NAME) & ~low.rlike(RATE_NAME)
    out = rows.withColumn("quaternion", F.when(whole, F.col("__g__")))
    meaning = F.when(F.col("quaternion").isNotNull(), "quaternion_component").when(gripper, "zero_order_gripper")
    return out.withColumn("meaning", meaning).withColumn("angle", angle).drop("__g__", "__a__")


def with_meaning(metrics: DataFrame, meaning: str = "meaning") -> DataFrame:
    """Metrics of dimensions after what their meaning excuses: components of a quaternion have no abrupt steps (their share of
    extreme ones stays as measured), grippers no extreme ones; neither has outliers of a derivative. Raw values stay beside."""
    quaternion, gripper = F.coalesce(F.col(meaning) == "quaternion_component", F.lit(False)), F.coalesce(F.col(meaning) == "zero_order_gripper", F.lit(False))
    zero = F.lit(0)
    return (
        metrics.withColumn("raw_abrupt_steps", F.when(quaternion, F.col("abrupt_steps")))
        .withColumn("raw_extreme_steps", F.when(gripper, F.col("extreme_steps")))
        .withColumn("abrupt_steps", F.when(quaternion, zero).otherwise(F.col("abrupt_steps")))
        .withColumn("abrupt_ratio", F.when(quaternion, F.lit(0.0)).otherwise(F.col("abrupt_ratio")))
        .withColumn("extreme_steps", F.when(gripper, zero).otherwise(F.col("extreme_steps")))
        .withColumn("extreme_ratio", F.when(gripper, F.lit(0.0)).otherwise(F.col("extreme_ratio")))
        .withColumn("derivative_outliers", F.when(quaternion | gripper, zero).otherwise(F.col("derivative_outliers")))
    )


def zero_order(mapping: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, slots): the active slots that hold their last value between samples, those of grippers."""
    held = F.col("active") & F.lower("semantic").contains("gripper")
    return mapping.groupBy(*keys).agg(F.array_sort(F.collect_set(F.when(held, F.col("slot")))).alias("slots"))


# --- alignment -----------------------------------------------------------------------------------------


def common_slots(state: DataFrame, action: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, slot, comparison) of the slots below 64 that state and action both use and that may be compared.

    Mappings: (keys, slot, active, alignment_safe, source_key, source_name, semantic). A flag that is not set counts as safe from
    slot 6 on; below, both must say so. An action that is a velocity is compared with the derivative of a state that is none."""
    def side(df: DataFrame, name: str) -> DataFrame:
        rows = df.where("active").select(*keys, "slot", F.struct("alignment_safe", is_velocity(F.col("source_key"), F.col("source_name"), F.col("semantic")).alias("velocity")).alias(name))
        return rows

    both = side(state, "s").join(side(action, "a"), [*keys, "slot"])
    safe = F.coalesce("s.alignment_safe", F.lit(True)) & F.coalesce("a.alignment_safe", F.lit(True))
    said = F.coalesce("s.alignment_safe", F.lit(False)) & F.coalesce("a.alignment_safe", F.lit(False))
    rows = both.where(F.col("slot").between(0, 63) & safe & ((F.col("slot") >= 6) | said))
    derived = F.col("a.velocity") & ~F.col("s.velocity")
    return rows.select(*keys, "slot", F.when(derived, "action_vs_state_derivative").otherwise("direct_feedback").alias("comparison"))


def alignment(samples: DataFrame, episodes: DataFrame, key: str, seconds: float = 0.5, least: float = 0.2, most_lag: int = 40) -> DataFrame:
    """Best lag of the state behind the action for each episode, and its score.

    samples: (key, slot, idx, state, action, comparison); episodes: (key, fps), a rate that is null or 0 is 20. Lags run from 0 to
    half a second, 1 to 40 frames. Score of a lag: the median over slots of Pearson's correlation over finite pairs, 8 at least, of series that
    vary; the first of the best lags wins. Without one the status is pending. All lags are columns of one pass over one partitioning."""
    rate = F.coalesce(F.nullif(F.col("fps").cast("double"), F.lit(0.0)), F.lit(20.0))
    known = episodes.select(key, rate.alias("__fps__"))
    order = Window.partitionBy(key, "slot").orderBy("idx")
    rows = samples.join(known, key)
    clean = lambda c: F.when(finite(F.col(c)), F.col(c))
    rows = rows.withColumn("state", clean("state")).withColumn("action", clean("action"))
    derived = (F.col("state") - F.lag("state").over(order)) * F.col("__fps__")
    rows = rows.withColumn("state", F.when(F.col("comparison") == "action_vs_state_derivative", derived).otherwise(F.col("state")))
    ahead = rows.select(key, "slot", "action", *[F.lead("state", k).over(order).alias(f"s{k}") for k in range(most_lag + 1)])
    sums = []
    for k in range(most_lag + 1):
        both = F.col("action").isNotNull() & F.col(f"s{k}").isNotNull()
        a, s, n = F.when(both, F.col("action")), F.when(both, F.col(f"s{k}")), F.count_if(both)
        varies = (n >= 8) & (F.sqrt(F.var_pop(a) * n) > 1e-12) & (F.sqrt(F.var_pop(s) * n) > 1e-12)
        sums.append(F.when(varies, F.corr(a, s)).alias(f"r{k}"))
    each = ahead.groupBy(key, "slot").agg(*sums)
    scores = each.groupBy(key).agg(*[F.median(f"r{k}").alias(f"m{k}") for k in range(most_lag + 1)], *[F.count(f"r{k}").alias(f"c{k}") for k in range(most_lag + 1)])
    longest = F.greatest(F.lit(1), F.least(F.lit(most_lag), F.bround(F.col("__fps__") * seconds).cast("int")))
    tried = F.array(*[F.when((F.lit(k) <= longest) & F.col(f"m{k}").isNotNull(), F.struct(F.col(f"m{k}").alias("score"), F.lit(-k).alias("back"), F.col(f"c{k}").alias("dims"))) for k in range(most_lag + 1)])
    best = F.array_max(F.array_compact(tried))
    out = known.join(scores, key, "left").withColumn("b", best)
    status = F.when(F.col("b").isNull(), "pending").when(F.col("b.score") >= least, "passed").otherwise("low_confidence")
    return out.select(key, status.alias("status"), (-F.col("b.back")).alias("best_lag"), (F.lit(1000.0) * -F.col("b.back") / F.col("__fps__")).alias("best_lag_ms"), F.col("b.score").alias("score"), F.col("b.dims").alias("dims"))


# --- sparse visual samples --------------------------------------------------------------------------------


@dataclass(frozen=True)
class VisualPolicy:
    extreme_ratio: float = 0.98
    least_entropy: float = 0.08
    least_sharpness: float = 0.0005
    freeze_difference: float = 0.002
    freeze_distance: int = 1


def frame_flags(policy: VisualPolicy = VisualPolicy()) -> Column:
    """Flags of a frame with columns dark_ratio, bright_ratio, entropy and sharpness."""
    return F.array_compact(
        F.array(
            F.when(F.col("dark_ratio") >= policy.extreme_ratio, F.lit("extreme_dark")),
            F.when(F.col("bright_ratio") >= policy.extreme_ratio, F.lit("extreme_bright")),
            F.when(F.col("entropy") < policy.least_entropy, F.lit("low_entropy")),
            F.when(F.col("sharpness") < policy.least_sharpness, F.lit("low_sharpness")),
        )
    )


def sample_intervals(frames: DataFrame, keys: list[str], order: str = "sample", time: str = "t") -> DataFrame:
    """(keys, order, reason, severity, start_s, stop_s): one interval for each flag of a sample, from the midpoint before to the midpoint after.

    An extreme flag is hard where a neighbouring sample has it too, all others are soft. frames: (keys, order, time, flags)."""
    w = Window.partitionBy(*keys).orderBy(order)
    extreme = F.filter("flags", lambda x: x.isin("extreme_dark", "extreme_bright"))
    rows = frames.withColumn("__x__", extreme)
    near = F.coalesce(F.arrays_overlap("__x__", F.lag("__x__").over(w)), F.lit(False)) | F.coalesce(F.arrays_overlap("__x__", F.lead("__x__").over(w)), F.lit(False))
    t, before, after = F.col(time), F.lag(time).over(w), F.lead(time).over(w)
    left = F.coalesce((before + t) / 2, F.lit(0.0))
    right = F.coalesce((t + after) / 2, t + (t - before) / 2, t + 1e-3)
    rows = rows.select(*keys, order, "flags", near.alias("__near__"), F.greatest(F.lit(0.0), left).alias("start_s"), F.greatest(left + 1e-6, right).alias("stop_s"))
    each = rows.withColumn("reason", F.explode("flags"))
    severity = F.when(F.col("reason").isin("extreme_dark", "extreme_bright") & F.col("__near__"), "hard").otherwise("soft")
    return each.select(*keys, order, "reason", severity.alias("severity"), "start_s", "stop_s")


def visual_report(frames: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Status of a camera from its samples: failed if all are extreme, a warning for any flag or frozen pair, else passed.

    frames: (keys, sample, flags, mean_luma, entropy, sharpness, dhash); pairs: (keys, mad, frozen). The fingerprint is a digest of the samples' hashes
    in order."""
    extreme = F.exists("flags", lambda x: x.isin("extreme_dark", "extreme_bright"))
    hashes = F.array_sort(F.collect_list(F.struct("sample", "dhash")))
    seen = frames.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("samples"),
        F.bool_and(extreme).alias("all_extreme"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("flags")))).alias("__f__"),
        F.median("mean_luma").alias("median_luma"),
        F.min("entropy").alias("least_entropy"),
        F.min("sharpness").alias("least_sharpness"),
        F.sha2(F.array_join(F.transform(hashes, lambda x: x["dhash"]), "|"), 256).alias("fingerprint"),
    )
    still = pairs.groupBy(*keys).agg(F.bool_and("frozen").alias("all_frozen"), F.bool_or("frozen").alias("any_frozen"), F.median("mad").alias("median_difference"))
    both = seen.join(still, keys, "left")
    frozen = F.coalesce("any_frozen", F.lit(False))
    flags = F.array_sort(F.when(frozen, F.array_append("__f__", F.lit("possible_frozen_video"))).otherwise(F.col("__f__")))
    status = F.when(F.col("all_extreme"), "failed").when(F.size(flags) > 0, "warning").otherwise("passed")
    return both.select(*keys, status.alias("status"), "samples", flags.alias("flags"), "all_extreme", F.coalesce("all_frozen", F.lit(False)).alias("all_frozen"), "median_luma", "least_entropy", "least_sharpness", "median_difference", "fingerprint")


def visual_stage(cameras: DataFrame, keys: list[str]) -> DataFrame:
    """The visual stage of an episode from its cameras' containers and samples, with codes.

    cameras: (keys, status, sparse_status, fingerprint); status: passed, failed or pending of the container, sparse_status null where no samples were read.
    Episodes without cameras have no row here and are pending."""
    container, sparse = F.col("status"), F.when(F.col("status") == "passed", F.nullif(F.col("sparse_status"), F.lit("pending")))
    any_of = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    seen = cameras.groupBy(*keys).agg(
        F.bool_and(container == "failed").alias("none"),
        F.bool_and(container == "pending").alias("unread"),
        any_of(container == "passed").alias("some"),
        any_of(container == "failed").alias("broken"),
        F.count(sparse).alias("judged"),
        F.bool_and(sparse == "failed").alias("dark"),
        any_of(sparse.isin("warning", "failed")).alias("flagged"),
        F.array_sort(F.collect_list("fingerprint")).alias("prints"),
    )
    none, unread, judged = F.col("none"), F.col("unread"), F.col("judged") > 0
    dark = judged & F.col("dark")
    status = (
        F.when(none, "failed").when(unread, "pending").when(dark, "failed").when(judged & F.col("flagged"), "warning").otherwise("passed")
    )
    read = ~none & ~unread
    failures = reasons((none, "all_video_containers_failed"), (read & dark, "all_sampled_camera_visual_quality_failed"))
    warnings = reasons((~none & F.col("broken"), "partial_camera_audit_failure"), (read & judged & ~F.col("dark") & F.col("flagged"), "sparse_visual_quality_flags"))
    passed = reasons((~none & F.col("some"), "visual_container"), (read & judged & ~F.col("flagged"), "sparse_visual_quality"))
    pending = reasons((~none & unread, "visual_format_audit"), (read & ~judged, "sparse_visual_quality"))
    print_of = F.when(F.size("prints") > 0, F.sha2(F.array_join("prints", "|"), 256))
    return seen.select(*keys, status.alias("visual_status"), failures.alias("visual_failures"), warnings.alias("visual_warnings"), passed.alias("visual_passed"), pending.alias("visual_pending"), print_of.alias("visual_sha256"))


# --- fingerprints ----------------------------------------------------------------------------------------


def trajectory_fingerprints(samples: DataFrame, key: str, index: str = "idx", signal: str = "signal", vector: str = "vector", most: int = 32) -> DataFrame:
    """(key, rows, trajectory_sha256): a digest of up to 32 evenly spaced rows of all signals, rounded to 6 places, and the number of rows.

    Equal digests mean equal content at these rows; the digest's text form is this engine's own."""
    last = F.max(index).over(Window.partitionBy(key))
    rows = samples.withColumn("__n__", last + 1)
    k = F.least(F.lit(most), F.col("__n__"))
    picks = F.transform(F.sequence(F.lit(0).cast("bigint"), k - 1), lambda i: F.bround(i * (F.col("__n__") - 1) / F.greatest(k - 1, F.lit(1))).cast("bigint"))
    chosen = rows.where(F.array_contains(picks, F.col(index)))
    text = F.transform(vector, lambda x: F.when(x.isNull() | F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf").otherwise(F.format_string("%.6f", F.round(x, 6) + F.lit(0.0))))
    each = chosen.select(key, "__n__", F.struct(F.col(signal), F.col(index), F.array_join(text, ",").alias("t")).alias("x"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: F.concat(x[signal], F.lit(":"), x[index].cast("string"), F.lit(":"), x["t"])), "|")
    return each.groupBy(key).agg(F.max("__n__").alias("rows"), body.alias("b")).select(key, "rows", F.sha2(F.concat(F.col("rows").cast("string"), F.lit("#"), "b"), 256).alias("trajectory_sha256"))


# --- the stages of an episode -----------------------------------------------------------------------------


@dataclass(frozen=True)
class AuditPolicy:
    jitter_warning: float = 0.25
    rate_error_warning: float = 0.10
    least_finite: float = 1.0
    abrupt_warning: float = 0.02
    abrupt_block: float = 0.20
    extreme_block: float = 0.05


def signal_codes(signals: DataFrame, key: str, policy: AuditPolicy = AuditPolicy()) -> DataFrame:
    """(key, signal_ok, codes by kind) from one row for each signal of an episode.

    signals: (key, name, relevant, present, widths, least_finite, abrupt, extreme, constant_dims, sign_flips, norm_errors, rapid_turns). Signals that no
    active mapping uses are only monitored: their faults become warnings."""
    name, use, here = F.col("name"), F.col("relevant"), F.col("present")

    def code(text: str) -> Column:
        return F.concat(F.lit(text + ":"), name)

    missing, ragged = ~here, here & (F.col("widths") > 1)
    holes = here & (F.col("least_finite") < policy.least_finite)
    wild = here & (F.col("abrupt") > policy.abrupt_block) & (F.col("extreme") > policy.extreme_block)
    norm, turn = here & (F.col("norm_errors") > 0), here & (F.col("rapid_turns") > 0)
    faults = F.array_compact(F.array(F.when(missing, code("signal_column_missing")), F.when(ragged, code("variable_signal_width")), F.when(holes, code("non_finite_signal")), F.when(wild, code("excessive_abrupt_steps"))))
    monitored = F.filter(faults, lambda x: ~x.startswith("non_finite_signal"))
    kinematic = F.array_compact(F.array(F.when(norm, code("quaternion_norm_outlier")), F.when(turn, code("rapid_quaternion_rotation"))))
    warned = F.array_compact(F.array(F.when(holes, code("non_finite_signal")), F.when(here & (F.col("abrupt") > policy.abrupt_warning), code("frequent_abrupt_steps")), F.when(here & (F.col("constant_dims") > 0), code("constant_signal_dimensions"))))
    rows = signals.select(
        key,
        faults.alias("f"),
        F.when(use, faults).otherwise(F.array().cast("array<string>")).alias("b"),
        F.concat(warned, kinematic, F.when(use, F.array().cast("array<string>")).otherwise(F.transform(monitored, lambda x: F.concat(F.lit("monitor_only_"), x)))).alias("w"),
        kinematic.alias("k"),
        (here & (F.col("sign_flips") > 0)).alias("flips"),
    )
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return rows.groupBy(key).agg(flat("f").alias("signal_reasons"), flat("b").alias("signal_blockers"), flat("w").alias("signal_warnings"), flat("k").alias("kinematic_reasons"), F.bool_or("flips").alias("sign_flips"))


def audit(episodes: DataFrame, key: str, policy: AuditPolicy = AuditPolicy()) -> DataFrame:
    """Stage statuses and sorted codes of each episode, from the audits joined by key (a row for each episode).

    Columns: prompt_usable; visual_status and its four arrays (null: not audited); supported, readable; n_rows, declared_rows; has_time, strictly_increasing,
    gaps, jitter, rate_error; has_index, contiguous; has_state, has_action; the columns of ``signal_codes`` (null without signals); alignment_status,
    alignment_reason; mapping_verified. An episode in a format that cannot be read, or that fails to open, has only its language and visual stages."""
    c, no = F.col, F.lit(False)
    none = F.array().cast("array<string>")
    yes = lambda x: F.coalesce(c(x), no)
    listed = lambda x: F.coalesce(c(x), none)
    native, broken = ~yes("supported"), yes("supported") & ~yes("readable")
    deep = yes("supported") & yes("readable")
    empty, short = deep & (c("n_rows") <= 0), deep & F.coalesce(c("declared_rows") != c("n_rows"), no)
    timed, indexed = yes("has_time"), yes("has_index")
    jump, gap = deep & timed & ~yes("strictly_increasing"), deep & timed & (F.coalesce(c("gaps"), F.lit(0)) > 0)
    jitter, drift = deep & timed & F.coalesce(c("jitter") > policy.jitter_warning, no), deep & timed & F.coalesce(c("rate_error") > policy.rate_error_warning, no)
    untimed, broken_index = deep & ~timed, deep & indexed & ~yes("contiguous")
    clock_ok = deep & ~jump & ~gap & ~untimed & ~broken_index
    schema = yes("has_state") | yes("has_action")
    signal_ok = deep & schema & (F.size(listed("signal_blockers")) == 0)
    aligned = F.when(yes("has_state") & yes("has_action"), F.coalesce(c("alignment_status"), F.lit("pending"))).otherwise("pending")
    aligned_ok, vague = deep & (aligned == "passed"), deep & (aligned == "low_confidence")
    waiting = deep & ~aligned_ok & ~vague
    prompt, seen = yes("prompt_usable"), c("visual_status").isNotNull()
    kinematic_ok = deep & schema & (F.size(listed("kinematic_reasons")) == 0)

    first = lambda a, b: F.array_sort(F.array_distinct(F.concat(a, b)))
    failures = first(reasons((broken, "episode_data_unreadable"), (empty, "empty_episode"), (jump, "temporal_discontinuity")), listed("visual_failures"))
    video = first(reasons((broken, "episode_data_unreadable"), (empty, "empty_episode")), listed("visual_failures"))
    own = reasons(
        (native, "native_format_not_converted"),
        (broken, "episode_data_unreadable"),
        (short, "metadata_row_count_mismatch"),
        (jump, "temporal_discontinuity"),
        (gap, "timestamp_gaps"),
        (untimed, "timestamp_missing"),
        (broken_index, "frame_index_not_contiguous"),
        (deep & ~schema, "state_or_action_schema_missing"),
        (vague, "low_action_state_alignment"),
        (waiting, "action_state_alignment_pending"),
    )
    blockers = first(own, F.when(deep, listed("signal_blockers")).otherwise(none))
    verified = deep & yes("has_state") & yes("has_action") & clock_ok & signal_ok & aligned_ok & (F.size(failures) == 0) & (F.size(blockers) == 0)
    unmapped = verified & ~yes("mapping_verified")
    warnings = first(
        reasons(
            (~prompt, "missing_or_unusable_task_prompt"),
            (short, "metadata_row_count_mismatch"),
            (gap, "timestamp_gaps"),
            (jitter, "high_timestamp_jitter"),
            (drift, "declared_fps_mismatch"),
            (broken_index, "frame_index_not_contiguous"),
            (vague, "low_action_state_alignment"),
        ),
        F.concat(listed("visual_warnings"), F.when(deep, listed("signal_warnings")).otherwise(none)),
    )
    passed = first(
        reasons(
            (prompt, "language"),
            (deep & ~empty, "episode_data_readable"),
            (clock_ok, "temporal"),
            (signal_ok, "signal"),
            (kinematic_ok, "kinematic"),
            (aligned_ok, "action_state_alignment"),
            (deep & yes("sign_flips"), "quaternion_sign_continuity"),
        ),
        listed("visual_passed"),
    )
    pending = first(
        reasons(
            (~prompt, "language_review"),
            (~seen, "visual"),
            (native, "native_format_deep_audit"),
            (untimed, "timestamp_missing"),
            (deep & ~indexed, "frame_index_missing"),
            (deep & ~schema, "schema_inference"),
            (vague, "action_state_alignment_review"),
            (waiting, "action_state_alignment"),
            (unmapped, "canonical_action_mapping_review"),
        ),
        listed("visual_pending"),
    )
    stage = F.when(native, "pending").when(broken, "failed").when(empty, "failed").when(short, "warning").otherwise("passed")
    clock = F.when(~deep, "pending").when(jump, "failed").when(clock_ok, "passed").otherwise("warning")
    return episodes.select(
        key,
        F.when(prompt, "passed").otherwise("pending").alias("language_stage"),
        F.coalesce("visual_status", F.lit("pending")).alias("visual_stage"),
        stage.alias("structure_stage"),
        clock.alias("temporal_stage"),
        F.when(~deep, "pending").when(signal_ok, "passed").otherwise("warning").alias("signal_stage"),
        F.when(~deep | ~schema, "pending").when(kinematic_ok, "passed").otherwise("warning").alias("kinematic_stage"),
        F.when(deep, aligned).otherwise("pending").alias("alignment_stage"),
        failures.alias("failures"),
        warnings.alias("warnings"),
        F.when(unmapped, F.array_sort(F.array_append(blockers, F.lit("canonical_action_mapping_unverified")))).otherwise(blockers).alias("action_blockers"),
        video.alias("video_blockers"),
        passed.alias("passed_checks"),
        pending.alias("pending_checks"),
        verified.alias("native_action_verified"),
        (verified & yes("mapping_verified")).alias("action_verified"),
    )


def admission_stages(rows: DataFrame, mode: str = "mode", reason: str = "reasons", blockers: str = "action_blockers", language: str = "prompt_usable") -> DataFrame:
    """rows with what each of three training stages accepts and the sorted reasons against it."""
    none = F.array().cast("array<string>")
    joint, rejected = F.col(mode) == "joint_video_action", F.col(mode) == "reject"
    add = lambda base, cond, code: F.array_sort(F.array_distinct(F.concat(base, F.when(cond, F.array(F.lit(code))).otherwise(none))))
    against = F.coalesce(F.col(blockers), none)
    one = add(F.when(rejected, F.coalesce(F.col(reason), none)).otherwise(none), ~F.coalesce(F.col(language), F.lit(False)), "language_missing_or_fallback_required")
    two = add(against, ~joint, "joint_video_action_not_verified")
    return rows.select("*", (~rejected).alias("stage1"), one.alias("stage1_reasons"), joint.alias("stage2"), two.alias("stage2_reasons"), add(two, joint, "target_dataset_and_success_policy_required").alias("stage3_reasons"))
