"""Audits of an episode's clock."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinetrail.functions.scalar import finite


def steps(frames: DataFrame, key: str = "episode_id") -> DataFrame:
    """frames (key, idx, t) with ``delta`` to the frame before; null for an episode with any time that is not finite."""
    order = Window.partitionBy(key).orderBy("idx")
    whole = F.bool_and(finite(F.col("t"))).over(Window.partitionBy(key))
    return frames.withColumn("finite", whole).withColumn("delta", F.when(F.col("finite"), F.col("t") - F.lag("t").over(order)))


def audit(frames: DataFrame, declared_fps: float | None = None, gap_factor: float = 3.0, key: str = "episode_id") -> DataFrame:
    """One row an episode: clock regularity by median and median absolute deviation, gaps, rate.

    All passes are partitioned by the episode, so there is one shuffle. An empty table gives none."""
    moved = steps(frames, key)
    up = F.when(F.col("delta") > 0, F.col("delta"))
    first = moved.groupBy(key).agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.bool_and("finite").alias("finite"),
        F.coalesce(F.bool_and(F.when(F.col("delta").isNotNull(), F.col("delta") > 0)), F.lit(True)).alias("rising"),
        F.median(up).alias("median_delta_s"),
        F.min(up).alias("minimum_delta_s"),
        F.max(up).alias("maximum_delta_s"),
        (F.max("t") - F.min("t")).alias("span"),
    )
    both = moved.select(key, "delta").join(first.select(key, "median_delta_s"), key)
    second = both.groupBy(key).agg(
        F.median(F.when(F.col("delta") > 0, F.abs(F.col("delta") - F.col("median_delta_s")))).alias("delta_mad_s"),
        F.count_if(F.col("delta") > F.col("median_delta_s") * gap_factor).alias("gap_count"),
    )
    rate = F.lit(1.0) / F.col("median_delta_s")
    rising = F.col("finite") & F.col("rising")
    out = first.join(second, key).select(
        key,
        "sample_count",
        "finite",
        rising.alias("strictly_increasing"),
        F.when(rising & (F.col("sample_count") >= 2), F.col("span")).alias("duration_s"),
        "median_delta_s",
        "delta_mad_s",
        (F.col("delta_mad_s") / F.col("median_delta_s")).alias("jitter_mad_ratio"),
        "minimum_delta_s",
        "maximum_delta_s",
        "gap_count",
        rate.alias("inferred_fps"),
    )
    error = F.abs(F.col("inferred_fps") - F.lit(declared_fps)) / F.lit(declared_fps) if declared_fps else F.lit(None).cast("double")
    return out.withColumn("fps_relative_error", error)


def gaps(frames: DataFrame, gap_factor: float = 3.0, key: str = "episode_id") -> DataFrame:
    """(key, idx) of the samples that follow a gap."""
    moved = steps(frames, key)
    middle = moved.groupBy(key).agg(F.median(F.when(F.col("delta") > 0, F.col("delta"))).alias("m"))
    return moved.select(key, "idx", "delta").join(middle, key).where(F.col("delta") > F.col("m") * gap_factor).select(key, "idx")


def contiguous(rows: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """(keys, contiguous, strictly_increasing): each value is one more (any more) than the one before; no row with null is either."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    each = rows.withColumn("step", F.col(value) - before).withColumn("first", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1)
    ok = F.bool_and(F.coalesce(F.col("first") | (F.col("step") == 1), F.lit(False)) & F.col(value).isNotNull())
    up = F.bool_and(F.coalesce(F.col("first") | (F.col("step") > 0), F.lit(False)) & F.col(value).isNotNull())
    return each.groupBy(*keys).agg(ok.alias("contiguous"), up.alias("strictly_increasing"))


def missing_parts(parts: DataFrame, keys: list[str], part: str) -> DataFrame:
    """(keys, missing): numbers between the least and the greatest part that do not occur, sorted."""
    found = parts.where(F.col(part).isNotNull()).groupBy(*keys).agg(F.collect_set(F.col(part).cast("bigint")).alias("have"))
    return found.select(*keys, F.array_except(F.sequence(F.array_min("have"), F.array_max("have")), F.col("have")).alias("missing"))
