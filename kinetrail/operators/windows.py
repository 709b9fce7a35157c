"""Sliding windows over episodes, filtered by intervals and kept as compact ranges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrail.operators import intervals as iv


@dataclass(frozen=True)
class WindowPolicy:
    width: int = 81
    stride: int = 40
    ratio: int = 4
    least_unique: int = 8

    def __post_init__(self) -> None:
        if self.width < 2 or self.stride < 1 or self.least_unique < 2:
            raise ValueError("width, stride or least_unique is too small")
        if (self.width - 1) % self.ratio or (self.width - 1) // self.ratio % 4:
            raise ValueError("width - 1 must be a multiple of four times the ratio")


def starts(episodes: DataFrame, policy: WindowPolicy, length: str = "n", key: str = "episode_id") -> DataFrame:
    """(key, start): 0, stride, 2 * stride ... of the windows that fit. Shorter episodes have none."""
    fits = episodes.where(F.col(length) >= policy.width)  # a descending sequence must not arise
    last = F.col(length).cast("bigint") - policy.width
    return fits.select(key, F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(policy.stride).cast("bigint"))).alias("start"))


def unique_frames(points: Column, duration: Column, fps: Column) -> Column:
    """Distinct source frames that the points of a window can show."""
    return F.least(points, F.floor(duration * fps + 1e-8).cast("bigint") + 1)


def split(windows: DataFrame, bad: DataFrame, width: int, key: str = "episode_id") -> DataFrame:
    """(key, start, mode): hard trouble of video or time drops a window, of state or action makes it video_only, else joint.

    One range join within the episode's partitioning: intervals of a kind are united first, so a window meets few."""
    kinds = {"seen": ["video", "temporal"], "moved": ["state", "action"]}
    flags = [F.arrays_overlap("domains", F.array(*[F.lit(d) for d in v])).alias(k) for k, v in kinds.items()]
    hard = iv.coalesce(bad.where("severity = 'hard'").select(key, "start", "stop", *flags).where("seen OR moved"), [key, "seen", "moved"])
    spans = hard.select(F.col(key).alias("__k__"), F.col("start").alias("__a__"), F.col("stop").alias("__b__"), "seen", "moved")
    meets = (F.col(key) == F.col("__k__")) & (F.col("start") < F.col("__b__")) & (F.col("start") + width > F.col("__a__"))
    both = windows.select(key, "start").join(spans, meets, "left").groupBy(key, "start")
    judged = both.agg(F.coalesce(F.bool_or("seen"), F.lit(False)).alias("seen"), F.coalesce(F.bool_or("moved"), F.lit(False)).alias("moved"))
    return judged.where("NOT seen").select(key, "start", F.when(F.col("moved"), "video_only").otherwise("joint").alias("mode"))


def index(windows: DataFrame, stride: int, key: str = "episode_id") -> DataFrame:
    """One row for each run of windows of an episode and mode."""
    return iv.compact(windows, [key, "mode"], stride)


def covered_rows(ranges: DataFrame, width: int, keys: list[str], start: str = "start") -> DataFrame:
    """(keys, idx) of every row that a window covers, once. Ranges are united before they are expanded, so overlap costs nothing."""
    spans = ranges.select(*keys, F.col(start).alias("start"), (F.col(start) + width).alias("stop"))
    return iv.coalesce(spans, keys).select(*keys, F.explode(F.sequence("start", F.col("stop") - 1)).alias("idx"))
