"""Resampling of episodes onto a regular timeline: as-of joins from unions and running windows.

Spark has no as-of join. Samples and target times of an episode are united and sorted once; the neighbours of a target are the last
sample before and the first after in that order. One shuffle by episode, no pairs of samples and targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinetrail.functions.scalar import finite


def targets(frames: DataFrame, fps: float, key: str = "episode_id", time: str = "t") -> DataFrame:
    """(key, k, at): floor(duration * fps + 1e-8) + 1 target times k / fps from the first sample."""
    ends = frames.groupBy(key).agg(F.min(time).alias("a"), F.max(time).alias("b"))
    last = F.floor((F.col("b") - F.col("a")) * fps + 1e-8).cast("bigint")
    return ends.select(key, F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("k")).withColumn("at", F.col("k") / F.lit(float(fps)))


def bracket(frames: DataFrame, wanted: DataFrame, carry: list[str], key: str = "episode_id", time: str = "t") -> DataFrame:
    """wanted (key, k, at) with structs ``left`` and ``right`` of the samples around each time: (t, carry).

    frames' ``time`` counts from the episode's start. An exact hit is both left and right. Beyond an end the
    end sample stands on both sides."""
    sample = frames.select(key, F.col(time).alias("at"), F.lit(0).alias("side"), F.lit(None).cast("bigint").alias("k"), F.struct(F.col(time).alias("t"), *carry).alias("s"))
    probe = wanted.select(key, "at", F.lit(1).alias("side"), "k", F.lit(None).cast(sample.schema["s"].dataType).alias("s"))
    both = sample.unionByName(probe)
    ahead = Window.partitionBy(key).orderBy("at", "side")
    left = F.last("s", ignorenulls=True).over(ahead.rowsBetween(Window.unboundedPreceding, 0))
    # from behind, a sample at the time of a probe must come before it too
    behind = Window.partitionBy(key).orderBy(F.col("at").desc(), F.col("side"))
    right = F.last("s", ignorenulls=True).over(behind.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("left", left).withColumn("right", right).where("side = 1")
    return found.select(key, "k", "at", F.coalesce("left", "right").alias("left"), F.coalesce("right", "left").alias("right"))


def _alpha():
    gap = F.col("right.t") - F.col("left.t")
    return F.when(gap > 0, F.least(F.greatest((F.col("at") - F.col("left.t")) / gap, F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))


def nearest(frames: DataFrame, wanted: DataFrame, carry: list[str], key: str = "episode_id", time: str = "t") -> DataFrame:
    """wanted with the nearest sample's columns and the error in seconds; the left one if both are as near."""
    found = bracket(frames, wanted, carry, key, time).withColumn("near", F.when(_alpha() <= 0.5, F.col("left")).otherwise(F.col("right")))
    return found.select(key, "k", "at", *[F.col("near")[x].alias(x) for x in carry], F.abs(F.col("near.t") - F.col("at")).alias("error_s"))


def interpolate(frames: DataFrame, wanted: DataFrame, values: list[str], held: tuple[str, ...] = (), key: str = "episode_id", time: str = "t") -> DataFrame:
    """wanted with each value and ``<value>_valid``. Values blend linearly and are valid if both neighbours are; ``held`` values and
    exact hits take the left one. What is invalid is 0."""
    found = bracket(frames, wanted, values, key, time).withColumn("alpha", _alpha())
    out = [key, "k", "at"]
    for x in values:
        left, right = F.col("left")[x], F.col("right")[x]
        if x in held:
            ok, value = finite(left), left
        else:
            exact = F.col("alpha") <= 0
            ok = finite(left) & (exact | finite(right))
            value = F.when(exact, left).otherwise(left * (1 - F.col("alpha")) + right * F.col("alpha"))
        ok = F.coalesce(ok, F.lit(False))
        out += [F.when(ok, value).otherwise(F.lit(0.0)).alias(x), ok.alias(f"{x}_valid")]
    return found.select(*out)


def hold_next(frames: DataFrame, value: str, keys: list[str], into: str = "next") -> DataFrame:
    """frames with the next row's value; the last row keeps its own."""
    order = Window.partitionBy(*keys).orderBy("idx")
    return frames.withColumn(into, F.coalesce(F.lead(value).over(order), F.col(value)))
