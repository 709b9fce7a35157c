"""Audits of signals in long form: (keys..., idx, t, value), one row a sample and dimension."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetrail.functions.scalar import finite

EPSILON = 1e-12
SPREAD = 12.0 * 1.4826


def long_form(frames: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """(keep, dim, value) of an array column; rows shorter than the widest lack the dimension, null rows are one NaN."""
    values = F.coalesce(F.col(vector), F.array(F.lit(float("nan"))))
    return frames.select(*keep, F.posexplode(values).alias("dim", "value"))


def threshold(median: Column, mad: Column, floor: Column | float = 0.0) -> Column:
    """Beyond it a step is abrupt: 20 medians or 12 deviations above the median of the active steps, or the floor; 0 without any."""
    floor = floor if isinstance(floor, Column) else F.lit(float(floor))
    return F.when(median.isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(1e-6), floor, median * 20.0, median + SPREAD * mad))


def dimension_metrics(samples: DataFrame, keys: list[str], floor: float = 0.0, extreme: float = 10.0) -> DataFrame:
    """One row a dimension: quantiles, robust step statistics, abrupt and extreme counts. keys name one dimension of one episode.

    Medians and deviations are windows over the dimension, so that samples are dealt and sorted once. Non-finite samples count in the lengths only."""
    value, whole = F.col("value"), Window.partitionBy(*keys)
    steps = samples.withColumn("clean", F.when(finite(value), value))
    steps = steps.withColumn("step", F.abs(F.col("clean") - F.lag("clean").over(whole.orderBy("idx"))))
    steps = steps.withColumn("__range__", F.max("clean").over(whole) - F.min("clean").over(whole))
    steps = steps.withColumn("a", F.when(F.col("step") > F.greatest(F.lit(EPSILON), F.coalesce("__range__", F.lit(0.0)) * 1e-10), F.col("step")))
    steps = steps.withColumn("m", F.median("a").over(whole))
    steps = steps.withColumn("mad", F.median(F.abs(F.col("a") - F.col("m"))).over(whole))
    steps = steps.withColumn("limit", threshold(F.col("m"), F.col("mad"), floor))
    found = steps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.count("clean").alias("finite_count"),
        F.percentile("clean", F.array(F.lit(0.01), F.lit(0.5), F.lit(0.99))).alias("q"),
        F.max("__range__").alias("range"),
        F.coalesce(F.median("step"), F.lit(0.0)).alias("median_abs_step"),
        F.coalesce(F.max("step"), F.lit(0.0)).alias("maximum_abs_step"),
        F.count("a").alias("active_step_count"),
        F.max("m").alias("m"),
        F.max("mad").alias("mad"),
        F.max("limit").alias("limit"),
        F.count_if((F.col("limit") > 0) & (F.col("step") > F.col("limit"))).alias("abrupt_step_count"),
        F.count_if((F.col("limit") > 0) & (F.col("step") > F.col("limit") * extreme)).alias("extreme_abrupt_step_count"),
    )
    ratio = F.greatest(F.col("sample_count") - 1, F.lit(1))
    return found.select(
        *keys,
        "sample_count",
        "finite_count",
        (F.col("finite_count") / F.greatest("sample_count", F.lit(1))).alias("finite_ratio"),
        F.get("q", F.lit(0)).alias("p01"),
        F.get("q", F.lit(1)).alias("p50"),
        F.get("q", F.lit(2)).alias("p99"),
        "range",
        "median_abs_step",
        "active_step_count",
        F.coalesce("m", F.lit(0.0)).alias("median_active_abs_step"),
        F.coalesce("mad", F.lit(0.0)).alias("step_mad"),
        "maximum_abs_step",
        F.col("limit").alias("abrupt_threshold"),
        "abrupt_step_count",
        (F.col("abrupt_step_count") / ratio).alias("abrupt_step_ratio"),
        "extreme_abrupt_step_count",
        (F.col("extreme_abrupt_step_count") / ratio).alias("extreme_abrupt_step_ratio"),
        F.coalesce(F.col("range") <= 1e-8, F.lit(False)).alias("constant"),
    )


def derivatives(samples: DataFrame, keys: list[str]) -> DataFrame:
    """samples with velocity, acceleration and jerk; null where a neighbour is not finite or time does not advance."""
    order = Window.partitionBy(*keys).orderBy("idx")
    out = samples.withColumn("dt", F.col("t") - F.lag("t").over(order))
    before = F.when(finite(F.col("value")), F.col("value"))
    for name in ("velocity", "acceleration", "jerk"):
        out = out.withColumn(name, F.when(F.col("dt") > 0, (before - F.lag(before).over(order)) / F.col("dt")))
        before = F.col(name)
    return out.drop("dt")


def derivative_outliers(samples: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Robust summary of one derivative: active median, deviation, threshold, outliers (by size)."""
    size = F.abs(F.col(column))
    each = samples.select(*keys, size.alias("x")).withColumn("a", F.when(F.col("x") > EPSILON, F.col("x")))
    base = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count("x").alias("finite_count"), F.median("a").alias("m"), F.coalesce(F.max("x"), F.lit(0.0)).alias("maximum_abs"))
    spread = each.join(base.select(*keys, "m"), keys).groupBy(*keys).agg(F.median(F.abs(F.col("a") - F.col("m"))).alias("mad"))
    limits = base.join(spread, keys).withColumn("limit", threshold(F.col("m"), F.col("mad")))
    over = each.join(limits.select(*keys, "limit"), keys).groupBy(*keys).agg(F.count_if((F.col("limit") > 0) & (F.col("x") > F.col("limit"))).alias("outlier_count"))
    return limits.join(over, keys).select(*keys, "finite_count", "maximum_abs", F.coalesce("m", F.lit(0.0)).alias("median_active_abs"), F.coalesce("mad", F.lit(0.0)).alias("mad"), F.col("limit").alias("outlier_threshold"), "outlier_count", (F.col("outlier_count") / F.greatest(F.col("n") - 1, F.lit(1))).alias("outlier_ratio"))


def unwrap(samples: DataFrame, keys: list[str]) -> DataFrame:
    """samples with ``unwrapped``: whole turns taken out between finite neighbours, as running sums instead of a fold."""
    order = Window.partitionBy(*keys).orderBy("idx")
    ok = finite(F.col("value"))
    last = F.last(F.when(ok, F.col("value")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    d = F.col("value") - last
    turns = F.when(ok & (d > math.pi), -F.ceil((d - math.pi) / (2 * math.pi))).when(ok & (d < -math.pi), F.ceil((-d - math.pi) / (2 * math.pi))).otherwise(F.lit(0)).cast("bigint")
    marked = samples.withColumn("turn", turns).withColumn("turns", F.sum("turn").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    value = F.when(finite(F.col("value")), F.col("value") + F.col("turns") * (2 * math.pi)).otherwise(F.col("value"))
    return marked.withColumn("unwrapped", value).withColumn("wrapped", finite(F.col("value")) & (F.col("turns") != 0)).drop("turn", "turns")


def quaternion_continuity(rows: DataFrame, keys: list[str], parts: tuple[str, str, str, str] = ("qx", "qy", "qz", "qw"), tolerance: float = 0.05, fastest: float = 1.5) -> DataFrame:
    """rows with sign (that keeps the sequence on one half of the sphere), norm_error, angle to the sample before and flags.

    A row whose parts are null is too short: it is invalid but does not break the sequence; one that is not finite or has no length
    breaks it. The sign is the parity of the negative dot products since the last break or zero dot product."""
    order = Window.partitionBy(*keys).orderBy("idx")
    q = [F.col(x) for x in parts]
    short = F.lit(False)
    for x in q:
        short = short | x.isNull()
    whole = F.lit(True)
    for x in q:
        whole = whole & finite(x)
    norm = F.sqrt(sum((x * x for x in q[1:]), q[0] * q[0]))
    good = F.coalesce(whole & (norm > EPSILON), F.lit(False))
    unit = F.when(good, F.array(*[x / norm for x in q]))
    base = rows.withColumn("short", short).withColumn("good", good).withColumn("norm", F.when(good, norm)).withColumn("unit", unit)
    state = F.when(~F.col("short"), F.struct(F.col("good").alias("good"), F.col("unit").alias("unit")))
    past = F.last(state, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    linked = base.withColumn("past", past)
    dot = F.aggregate(F.zip_with("unit", "past.unit", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    linked = linked.withColumn("dot", F.when(F.col("good") & F.col("past.good"), dot))
    fresh = F.when(F.col("good") & (F.col("dot").isNull() | (F.col("dot") == 0)), 1).otherwise(0)
    linked = linked.withColumn("run", F.sum(fresh).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(*keys, "run").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    odd = F.sum(F.when(F.col("dot") < 0, 1).otherwise(0)).over(inside) % 2
    linked = linked.withColumn("sign", F.when(F.col("good"), F.when(odd == 1, -1).otherwise(1)))
    angle = F.lit(2.0) * F.acos(F.least(F.lit(1.0), F.abs(F.col("dot"))))
    out = linked.withColumn("angle", angle).withColumn("flipped", F.coalesce(F.col("sign") == -1, F.lit(False)))
    out = out.withColumn("invalid", ~F.col("good")).withColumn("norm_error", F.coalesce(F.abs(F.col("norm") - 1) > tolerance, F.lit(False)))
    return out.withColumn("rapid", F.coalesce(F.col("angle") > fastest, F.lit(False))).drop("short", "good", "norm", "unit", "past", "dot", "run")
