"""Half-open intervals as rows: islands of bad samples, coalescing, mapping between timelines, overlap with windows.

Interval columns: episode_id, timeline, start, stop, reason, domains (sorted array), severity (hard or soft), source_key, and
where known start_s, stop_s. Everything is equi-partitioned by episode; an overlap is an equi join with a range condition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: columns that must agree before two intervals may become one
SEMANTICS = ("timeline", "domains", "severity", "reason", "source_key")


def islands(points: DataFrame, lengths: DataFrame, keys: list[str], index: str = "idx", padding: int = 0) -> DataFrame:
    """(keys, start, stop) of the maximal runs of the points, each widened by ``padding`` and clipped to [0, n).

    lengths: (keys, n). Null points are ignored; points outside the episode widen into it as far as the padding reaches."""
    wide = points.where(F.col(index).isNotNull()).join(lengths, keys).where("n > 0")
    low, high = F.greatest(F.col(index) - padding, F.lit(0)), F.least(F.col(index) + padding, F.col("n") - 1)
    each = wide.where(low <= high).select(*keys, F.explode(F.sequence(low, high)).alias("i")).distinct()
    order = Window.partitionBy(*keys).orderBy("i")
    return each.withColumn("g", F.col("i") - F.row_number().over(order)).groupBy(*keys, "g").agg(F.min("i").alias("start"), (F.max("i") + 1).alias("stop")).drop("g")


def coalesce(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start, stop): intervals that touch or overlap become one, within equal keys."""
    order = Window.partitionBy(*keys).orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.withColumn("new", F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0))
    grouped = marked.withColumn("g", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(*keys, "g").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("g")


def to_timeline(intervals: DataFrame, spans: DataFrame, fps: float, key: str = "episode_id") -> DataFrame:
    """Intervals in seconds (start_s, stop_s) to frame indexes of a timeline. spans: (key, origin_s, n_target).

    Only intervals of the source's own timeline are measured from its origin. What falls outside is dropped."""
    both = intervals.where("start_s IS NOT NULL AND stop_s IS NOT NULL").join(spans, key)
    shift = F.when(F.col("timeline") == "source_control", F.col("origin_s")).otherwise(F.lit(0.0))
    start = F.greatest(F.lit(0), F.floor((F.col("start_s") - shift) * fps + 1e-8).cast("bigint"))
    stop = F.least(F.col("n_target"), F.greatest(start + 1, F.ceil((F.col("stop_s") - shift) * fps - 1e-8).cast("bigint")))
    return both.withColumn("start", start).withColumn("stop", stop).where((F.col("start") < F.col("n_target")) & (F.col("stop") > 0)).drop("origin_s", "n_target")


def overlaps(starts: DataFrame, intervals: DataFrame, width: int, domains: list[str], severities: tuple[str, ...] = ("hard",), key: str = "episode_id") -> Column:
    same = starts[key] == intervals[key]
    domain = F.arrays_overlap(intervals["domains"], F.array(*[F.lit(d) for d in domains]))
    return same & domain & intervals["severity"].isin(*severities) & (starts["start"] < intervals["stop"]) & (starts["start"] + F.lit(width) > intervals["start"])


def blocked(starts: DataFrame, intervals: DataFrame, width: int, domains: list[str], **options) -> DataFrame:
    """Window starts whose window meets a relevant interval."""
    return starts.join(intervals, overlaps(starts, intervals, width, domains, **options), "left_semi")


def unblocked(starts: DataFrame, intervals: DataFrame, width: int, domains: list[str], **options) -> DataFrame:
    return starts.join(intervals, overlaps(starts, intervals, width, domains, **options), "left_anti")


def compact(starts: DataFrame, keys: list[str], stride: int, start: str = "start") -> DataFrame:
    """Runs of starts at one stride as (keys, start, stop, stride, count); stop is one stride past the last."""
    each = starts.select(*keys, F.col(start).alias("s")).where("s IS NOT NULL").distinct()
    order = Window.partitionBy(*keys).orderBy("s")
    runs = each.withColumn("g", F.sum(F.when(F.col("s") == F.lag("s").over(order) + stride, 0).otherwise(1)).over(order))
    return runs.groupBy(*keys, "g").agg(F.min("s").alias("start"), (F.max("s") + stride).alias("stop"), F.lit(stride).cast("bigint").alias("stride"), F.count(F.lit(1)).alias("count")).drop("g")


def expand(ranges: DataFrame) -> DataFrame:
    """The starts of compact ranges, as late as possible."""
    keep = [x for x in ranges.columns if x not in ("start", "stop", "stride", "count")]
    return ranges.select(*keep, F.explode(F.sequence("start", F.col("stop") - F.col("stride"), F.col("stride"))).alias("start"))
