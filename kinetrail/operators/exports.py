"""Exports for model targets, training cases, schedules and report gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetrail.functions.scalar import spaced, stable_id
from kinetrail.operators.curation import reasons
from kinetrail.operators.selection import stop_where

# --- vectors for a target -----------------------------------------------------------------------


def inverse_channels(channels: list[int], size: int) -> list[int]:
    """For each model channel the place of its value in the compact vector; the compact width where it has none."""
    if len(set(channels)) != len(channels) or not channels or min(channels) < 0 or max(channels) >= size:
        raise ValueError("channels must be distinct and inside the model's width")
    return [channels.index(k) if k in channels else len(channels) for k in range(size)]


def compact(vector: Column, indices: list[int]) -> Column:
    """The chosen source values in order, as floats; null where the source is too short."""
    return F.array(*[F.get(vector, F.lit(i)).cast("float") for i in indices])


def into_channels(values: Column, channels: list[int], size: int) -> Column:
    """Compact values at their model channels, 0 elsewhere."""
    return F.array(*[F.coalesce(F.get(values, F.lit(k)), F.lit(0.0).cast("float")) if k < len(channels) else F.lit(0.0).cast("float") for k in inverse_channels(channels, size)])


def modality_slices(vector: Column, spans: dict[str, tuple[int, int]]) -> dict[str, Column]:
    """Named parts [start, stop) of a packed vector; null where the vector is too short."""
    for name, (start, stop) in spans.items():
        if not 0 <= start < stop:
            raise ValueError(f"{name}: no such span")
    return {name: F.when(F.size(vector) >= stop, F.slice(vector, start + 1, stop - start)) for name, (start, stop) in spans.items()}


def slot_validity(rows: DataFrame, keys: list[str], mask: str, own: list[bool]) -> DataFrame:
    """(keys, slot, valid): a slot is valid in a window if every row's mask and its own flag say so."""
    each = rows.select(*keys, F.posexplode(mask).alias("slot", "ok"))
    flags = F.array(*[F.lit(x) for x in own])
    return each.groupBy(*keys, "slot").agg(F.bool_and(F.coalesce("ok", F.lit(False))).alias("all")).select(*keys, "slot", (F.col("all") & F.coalesce(F.get(flags, F.col("slot")), F.lit(False))).alias("valid"))


# --- segments and jobs ----------------------------------------------------------------------------


def segment_problems(segments: DataFrame, key: str = "episode_id") -> DataFrame:
    """Segments (key, ordinal, start, stop, text, n) that overlap the one before, run backwards or past the end, or have no text."""
    before = F.max("stop").over(Window.partitionBy(key).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1))
    bad = (F.col("start") < F.coalesce(before, F.lit(0))) | (F.col("start") < 0) | (F.col("stop") <= F.col("start")) | (F.col("stop") > F.col("n")) | (F.coalesce(spaced(F.col("text")), F.lit("")) == "")
    return segments.withColumn("bad", F.coalesce(bad, F.lit(True))).where("bad").drop("bad")


def frame_ids(start: Column, stop: Column, stride: int) -> Column:
    """Every stride-th frame of [start, stop), cut to one more than a multiple of four."""
    count = F.floor((stop - start - 1) / stride) + 1
    usable = 1 + F.floor((count - 1) / 4) * 4
    return F.when(stop > start, F.sequence(start, start + (usable - 1) * stride, F.lit(stride).cast("bigint")))


def latent_jobs(segments: DataFrame, cameras: list[str], stride: int) -> DataFrame:
    """One job for each segment and camera, with its frame ids."""
    return segments.withColumn("frame_ids", frame_ids(F.col("start"), F.col("stop"), stride)).withColumn("camera", F.explode(F.array(*[F.lit(c) for c in cameras])))


def job_coverage(jobs: DataFrame, outputs: DataFrame, keys: list[str], group: str) -> DataFrame:
    """(group, jobs, done, complete): outputs that exist for the jobs of each group. outputs: keys."""
    joined = jobs.join(outputs.select(*keys, F.lit(True).alias("__done__")).distinct(), keys, "left")
    done = F.coalesce("__done__", F.lit(False))
    return joined.groupBy(group).agg(F.count(F.lit(1)).alias("jobs"), F.count_if(done).alias("done"), F.bool_and(done).alias("complete"))


def stab(points: DataFrame, segments: DataFrame, key: str, point: str, name: str) -> DataFrame:
    """points with the first segment by name that holds them (start <= point < stop), null without one."""
    spans = segments.select(F.col(key).alias("__key__"), F.struct(F.col(name), F.col("start"), F.col("stop")).alias("__s__"))
    inside = (F.col(key) == F.col("__key__")) & (F.col(point) >= F.col("__s__.start")) & (F.col(point) < F.col("__s__.stop"))
    best = points.select(key, point).join(spans, inside, "left").groupBy(key, point).agg(F.min("__s__").alias("s"))
    return best.select(key, point, F.col("s")[name].alias(name), F.col("s.start").alias("start"), F.col("s.stop").alias("stop"))


# --- schedules ---------------------------------------------------------------------------------------


def chunk_schedule(episodes: DataFrame, chunks: str, cache: int, block: int = 2, per_chunk: int = 8, feedback: int = 4, start: str = "start_frame") -> DataFrame:
    """One row for each chunk of an episode: cache segment, visible context [context_start, context_stop) and first and last frame seen."""
    rows = episodes.where(F.col(chunks) > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(chunks).cast("bigint") - 1)))
    segment = F.floor(F.col("chunk") / cache) * cache
    anchor = F.col(start) + F.col("chunk") * per_chunk
    return rows.select(
        "*",
        segment.alias("segment_start"),
        F.least(segment + cache, F.col(chunks)).alias("segment_stop"),
        F.when(F.col("chunk") > 0, segment * block).alias("context_start"),
        F.when(F.col("chunk") > 0, 1 + F.col("chunk") * block).alias("context_stop"),
        F.when(F.col("chunk") > 0, anchor - feedback + 1).otherwise(F.col(start)).alias("first_frame"),
        anchor.alias("last_frame"),
    )


def decoded_frames(chunks: Column, block: int = 2, stride: int = 4) -> Column:
    """Frames that a number of chunks decode to: ten chunks give 81."""
    return 1 + stride * chunks * block


# --- training cases ---------------------------------------------------------------------------------

STATE_STEPS, ACTION_STEPS, TARGET_FPS, SLOTS = 81, 80, 20.0, 80
# The five camera slots in order.
CAMERA_ROLES = ("global_primary", "global_secondary", "left_wrist", "right_wrist", "auxiliary")


def case_failures(cases: DataFrame) -> DataFrame:
    """cases with the sorted codes of their contract that fail; none for a case that may be used.

    Columns: target_fps, state_steps, action_steps, video_offsets, state_slot_mask, action_slot_mask, camera_roles, camera_indices, camera_mask (arrays),
    canonical_uri, start_count, mode, action_loss.
    What is null fails."""

    def no(condition: Column) -> Column:
        return ~F.coalesce(condition, F.lit(False))

    loss = F.coalesce("action_loss", F.lit(False))
    codes = reasons(
        (no(F.col("target_fps") == TARGET_FPS), "target_fps_must_be_20"),
        (no(F.col("state_steps") == STATE_STEPS), "state_steps_must_be_81"),
        (no(F.col("action_steps") == ACTION_STEPS), "action_steps_must_be_80"),
        (no(F.size("state_slot_mask") == SLOTS), "state_slot_mask_must_have_80_dimensions"),
        (no(F.size("action_slot_mask") == SLOTS), "action_slot_mask_must_have_80_dimensions"),
        (no(F.col("video_offsets") == F.array(*[F.lit(x) for x in range(0, STATE_STEPS, 4)])), "video_offsets_must_be_0_to_80_stride_4"),
        (no(F.col("camera_roles") == F.array(*[F.lit(x) for x in CAMERA_ROLES])), "camera_roles_must_match_fixed_five_slots"),
        (no(F.col("camera_indices") == F.array(*[F.lit(x) for x in range(len(CAMERA_ROLES))])), "camera_slot_indices_invalid"),
        (no(F.exists("camera_mask", lambda x: x)), "no_valid_camera_slot"),
        (no(F.col("canonical_uri") != ""), "canonical_parquet_missing"),
        (no(F.col("start_count") > 0), "no_valid_starts"),
        (no(F.col("mode") != "joint_video_action") & ~loss, "joint_mode_requires_action_loss"),
        ((F.col("mode") == "video_only") & loss, "video_only_must_disable_action_loss"),
    )
    return cases.withColumn("failures", codes)


def expand_cases(cases: DataFrame, key: str = "case_id") -> DataFrame:
    """One row for each start of a case's compact range: concrete id, row ranges and the 21 video frame indices."""
    starts = cases.withColumn("at", F.explode(F.sequence("start", F.col("stop") - F.col("stride"), F.col("stride"))))
    return starts.select(
        key,
        stable_id(F.col(key), F.col("at")).alias("concrete_case_id"),
        F.col("at").alias("state_start"),
        (F.col("at") + STATE_STEPS).alias("state_stop"),
        (F.col("at") + ACTION_STEPS).alias("action_stop"),
        F.sequence(F.col("at"), F.col("at") + STATE_STEPS - 1, F.lit(4).cast("bigint")).alias("video_frames"),
    )


# --- report gates ------------------------------------------------------------------------------------


def gates(records: DataFrame, run: str, baseline: DataFrame | None = None, least_psnr: float = 3.0, least_ssim: float = 0.05, most_ratio: float = 0.5) -> DataFrame:
    """Every candidate of a run against its baseline: gains, five gates and whether all pass. The action gate counts only where both
    have the metric.

    records and baseline: (run, step, sample_index, window_start, psnr, ssim, action_l1, memory_ratio). Without a baseline table (a row a run)
    a run's first record by step is its baseline and the others are candidates. The query fails for a baseline that is not at step 0."""
    fields = ("step", "sample_index", "window_start", "psnr", "ssim", "action_l1")
    if baseline is None:
        w = Window.partitionBy(run).orderBy("step", "sample_index", "window_start", "psnr")  # evaluations of one run: few
        rows = records.withColumn("base", F.first(F.struct(*fields)).over(w)).withColumn("__r__", F.row_number().over(w))
    else:
        rows = records.join(baseline.select(run, F.struct(*fields).alias("base")), run).withColumn("__r__", F.lit(2))
    rows = stop_where(rows, F.col("base.step") != 0, F.concat(F.lit("no baseline at step 0: run "), F.col(run).cast("string"))).where("__r__ > 1")
    same = lambda c: F.coalesce(c, F.lit(-1)) == F.coalesce(F.col(f"base.{c}"), F.lit(-1))
    ratio = F.col("action_l1") / F.greatest(F.col("base.action_l1"), F.lit(1e-12))
    out = rows.select(
        run,
        "step",
        (F.col("psnr") - F.col("base.psnr")).alias("psnr_gain"),
        (F.col("ssim") - F.col("base.ssim")).alias("ssim_gain"),
        F.when(F.col("base.action_l1").isNotNull(), ratio).alias("action_ratio"),
        (same("sample_index") & same("window_start")).alias("same_sample"),
        F.coalesce(F.col("memory_ratio") >= 0.999, F.lit(False)).alias("memory_valid"),
    )
    ok = F.col("same_sample") & F.col("memory_valid") & (F.col("psnr_gain") >= least_psnr) & (F.col("ssim_gain") >= least_ssim) & F.coalesce(F.col("action_ratio") <= most_ratio, F.lit(True))
    return out.withColumn("passed", ok)
