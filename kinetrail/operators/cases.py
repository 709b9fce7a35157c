"""Training cases: cameras that failed, prompts, mappings, contracts, filters and normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrail.functions.scalar import spaced, stable_id
from kinetrail.operators.curation import reasons, sample_weight, split, split_group
from kinetrail.operators.exports import case_failures
from kinetrail.operators.selection import repeated, stop_where
from kinetrail.operators.stats import z_score


def with_reports(cameras: DataFrame, reports: DataFrame, videos: DataFrame, keys: list[str]) -> DataFrame:
    """cameras with their audit (status, sparse_status) and, where the camera itself has no address, that of the video table."""
    audit = reports.select(*keys, F.col("status").alias("audit_status"), F.col("sparse_status").alias("sparse_status"))
    places = videos.select(*keys, F.col("uri").alias("__uri__"))
    both = cameras.join(audit, keys, "left").join(places, keys, "left")
    uri = F.coalesce(F.nullif(F.col("source_uri"), F.lit("")), F.col("__uri__"))
    storage = F.when(F.nullif(uri, F.lit("")).isNull(), "embedded").when(uri.startswith("tar://"), "tar_member").otherwise("file")
    return both.withColumn("source_uri", uri).withColumn("storage", storage).drop("__uri__")


def failed_camera() -> Column:
    """Did the container or the sampled frames of the camera fail?"""
    return F.coalesce(F.col("audit_status") == "failed", F.lit(False)) | F.coalesce(F.col("sparse_status") == "failed", F.lit(False))


def prompt(tasks: Column, namespace: Column, fallback: Column) -> Column:
    """(primary, alternatives, valid, source) of the distinct tasks; the namespace's words stand in where the profile allows it."""
    found = F.array_distinct(F.filter(F.transform(F.coalesce(tasks, F.array().cast("array<string>")), lambda x: spaced(F.coalesce(x, F.lit("None")))), lambda x: x != ""))
    other = F.nullif(F.trim(F.regexp_replace(namespace, "[_/]+", " ")), F.lit(""))
    stand_in = (F.size(found) == 0) & F.coalesce(fallback == "task_namespace", F.lit(False)) & other.isNotNull()
    every = F.when(stand_in, F.array(other)).otherwise(found)
    source = F.when(stand_in, "task_namespace_fallback").when(F.size(every) > 0, "tasks").otherwise("missing")
    return F.struct(
        F.coalesce(F.get(every, F.lit(0)), F.lit("")).alias("primary"),
        F.slice(every, 2, F.greatest(F.size(every), F.lit(1))).alias("alternatives"),
        (F.size(every) > 0).alias("valid"),
        source.alias("source"),
    )


def mapping_problems(entries: DataFrame, features: DataFrame, keys: list[str], slots: int = 80) -> DataFrame:
    """(keys, ordinal, problem) of explicit mapping entries that name an unknown feature, an index past its width, a slot out of range, or a
    slot that an earlier entry has. entries: (keys, ordinal, source_key, source_index, slot); features: (keys, source_key, width)."""
    known = features.select(*keys, "source_key", F.col("width").alias("__w__"), F.lit(True).alias("__here__"))
    both = entries.join(known, [*keys, "source_key"], "left")
    first = entries.groupBy(*keys, "slot").agg(F.min("ordinal").alias("__first__"))
    both = both.join(first, [*keys, "slot"], "left")
    index, slot = F.col("source_index"), F.col("slot")
    checks = reasons(
        (F.col("__here__").isNull(), "unknown_feature"),
        (F.coalesce(~slot.between(0, slots - 1), F.lit(True)), "slot_out_of_range"),
        (F.col("ordinal") > F.col("__first__"), "duplicate_slot"),
        (F.col("__w__").isNotNull() & ~((index >= 0) & (index < F.col("__w__"))), "index_out_of_range"),
    )
    return both.select(*keys, "ordinal", F.explode(checks).alias("problem"))


def mapping_verdict(mappings: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, mapped, collisions, verified, valid_slots): verified if something is mapped, nothing collides and all is of high confidence.

    mappings: (keys, slot, kept, confidence)."""
    kept = F.col("kept") & F.col("slot").isNotNull()
    seen = mappings.where("slot IS NOT NULL").groupBy(*keys).agg(
        F.count_if(kept).alias("mapped"), F.count_if(~kept).alias("collisions"), F.bool_and(F.when(kept, F.col("confidence") == "high")).alias("__high__"),
        F.array_sort(F.collect_set(F.when(kept & (F.col("confidence") == "high"), F.col("slot")))).alias("valid_slots"),
    )
    sure = (F.col("mapped") > 0) & (F.col("collisions") == 0) & F.coalesce("__high__", F.lit(False))
    return seen.select(*keys, "mapped", "collisions", sure.alias("verified"), "valid_slots")


def unverified(mappings: DataFrame) -> DataFrame:
    """The same candidates, none of them active."""
    return mappings.withColumn("candidate", F.col("active")).withColumn("active", F.lit(False))


def filtered(cases: DataFrame, splits: tuple[str, ...] = ("train",), modes: tuple[str, ...] = ("joint_video_action",), tiers: tuple[str, ...] = ("A",)) -> DataFrame:
    return cases.where(F.col("split").isin(*splits) & F.col("mode").isin(*modes) & F.col("tier").isin(*tiers))


def checked(cases: DataFrame, key: str = "case_id") -> DataFrame:
    """The cases as a loader takes them: the query fails at the first that breaks its contract or whose id occurs twice."""
    twice = repeated(cases, [key]).select(key, F.lit(True).alias("__twice__"))
    rows = stop_where(cases.join(twice, key, "left"), F.col("__twice__"), F.concat(F.lit("case id occurs twice: "), F.col(key).cast("string"))).drop("__twice__")
    judged = case_failures(rows)
    return stop_where(judged, F.size("failures") > 0, F.concat(F.lit("case breaks its contract: "), F.array_join("failures", ", "))).drop("failures")


def normalised(values: DataFrame, statistics: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """values with ``z`` by the mean and deviation of their (domain, slot); the query fails where a domain has no statistics.

    statistics: (keys, mean, std, valid). An invalid slot is 0; scores stay within 10."""
    known = statistics.select(*keys, "mean", "std", "valid", F.lit(True).alias("__known__"))
    both = stop_where(values.join(known, keys, "left"), F.col("__known__").isNull(), F.lit("no statistics for a domain"))
    return both.withColumn("z", z_score(F.col(value), F.col("mean"), F.col("std"), F.col("valid"))).drop("__known__", "mean", "std", "valid")


def build(windows: DataFrame, profiles: DataFrame, slots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cases of episodes and those that break the contract, with their codes.

    windows: (episode_id, dataset, lineage_id, source_uri, tasks, task_namespace, tier, mode, audit_weight, target_fps, state_steps, action_steps, state_slot_mask, action_slot_mask,
    canonical_uri, start, stop, stride, start_count); profiles: (dataset, mixture_weight, language_fallback); slots: (episode_id, camera_roles,
    camera_indices, camera_mask)."""
    rows = windows.join(profiles, "dataset", "left").join(slots, "episode_id", "left")
    said = prompt(F.col("tasks"), F.col("task_namespace"), F.col("language_fallback"))
    group = split_group(F.col("lineage_id"), F.col("source_uri"), F.col("episode_id").cast("string"))
    weight = sample_weight(F.col("mixture_weight"), F.col("tier"), F.col("audit_weight"))
    rows = rows.withColumn("prompt", said).withColumn("split_group_id", group).withColumn("case_id", stable_id(F.col("episode_id"), F.col("start"), F.col("stop"), F.col("mode")))
    rows = rows.withColumn("split", split(F.col("split_group_id"))).withColumn("sample_weight", weight).withColumn("action_loss", F.col("mode") == "joint_video_action")
    rows = rows.withColumn("video_offsets", F.array(*[F.lit(x) for x in range(0, 81, 4)]))
    judged = case_failures(rows)
    return judged.where(F.size("failures") == 0).drop("failures"), judged.where(F.size("failures") > 0)
