"""Status tables, evaluation metrics, leaderboards, samplers and sparse frame metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetrail.functions.scalar import unit_hash

# --- catalogues -----------------------------------------------------------------------------------


def status(lock: DataFrame, marker: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """lock ⟕ marker ⟕ present by key, with a word for each repository; the first that applies: missing (no folder), complete (marker ok at the
    locked revision), partial (unfinished files), failed, interrupted_or_running, present_untracked.

    lock: (key, revision); marker: (key, marker_status, marker_revision); present: (key, incomplete), the number of unfinished files."""
    here = present.groupBy(key).agg(F.sum(F.coalesce("incomplete", F.lit(0))).alias("incomplete"))
    joined = lock.join(marker, key, "left").join(here, key, "left")
    said = F.col("marker_status")
    word = (
        F.when(F.col("incomplete").isNull(), "missing")
        .when((said == "ok") & (F.col("marker_revision") == F.col("revision")), "complete")
        .when(F.col("incomplete") > 0, "partial")
        .when(said.isNotNull() & ~said.isin("ok", "running"), "failed")
        .when(said == "running", "interrupted_or_running")
        .otherwise("present_untracked")
    )
    return joined.withColumn("status", word)


def verify(expected: DataFrame, local: DataFrame, key: str, size: str) -> DataFrame:
    """(key, problem) of files that are missing or have another size."""
    missing = expected.join(local, key, "left_anti").select(key, F.lit("missing").alias("problem"))
    other = expected.select(key, F.col(size).alias("a")).join(local.select(key, F.col(size).alias("b")), key).where("a <> b").select(key, F.lit("size").alias("problem"))
    return missing.unionByName(other)


def two_level_counts(rows: DataFrame, outer: str, inner: str) -> DataFrame:
    """Counts by (outer, inner), by outer, and in all; null marks a level that is summed over."""
    return rows.rollup(outer, inner).agg(F.count(F.lit(1)).alias("count"))


# --- metrics --------------------------------------------------------------------------------------


def pair_errors(truth: DataFrame, guess: DataFrame, keys: list[str], step: str, value: str, peak: float = 1.0) -> DataFrame:
    """MAE, MSE, RMSE and PSNR over the positions that both have; PSNR is infinite without error."""
    both = truth.select(*keys, step, F.col(value).alias("a")).join(guess.select(*keys, step, F.col(value).alias("b")), [*keys, step])
    d = F.col("a") - F.col("b")
    out = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(d)).alias("mae"), F.avg(d * d).alias("mse"))
    psnr = F.when(F.col("mse") > 0, 10 * F.log10(peak * peak / F.col("mse"))).otherwise(F.lit(float("inf")))
    return out.withColumn("rmse", F.sqrt("mse")).withColumn("psnr", psnr)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum of value times weight over the weights' sum, 1 at least."""
    return F.sum(value * weight) / F.greatest(F.sum(weight), F.lit(1.0))


def leaderboard(scores: DataFrame, group: str, name: str, value: str) -> DataFrame:
    """Averages by name in each group and in all groups; null marks all."""
    return scores.groupingSets([[group, name], [name]], group, name).agg(F.avg(value).alias("score"), F.count(F.lit(1)).alias("n"))


def best_checkpoint(candidates: DataFrame, passed: str, gain: Column, step: str, keys: list[str]) -> DataFrame:
    """The best passing candidate of each key, or the best of all where none passes; the later step on ties."""
    order = Window.partitionBy(*keys).orderBy(F.col(passed).desc(), F.col("__gain__").desc(), F.col(step).desc())
    return candidates.withColumn("__gain__", gain).withColumn("__r__", F.row_number().over(order)).where("__r__ = 1").drop("__r__").withColumnRenamed("__gain__", "gain")


# --- sampling -------------------------------------------------------------------------------------


def balanced_sample(rows: DataFrame, group: str, key: str, total: int, seed: str) -> DataFrame:
    """The same quota from each group, groups with the least hashes one more for the remainder; rows by hash, wrapping round a
    group that is too small. ``draw`` numbers the draws of a group. The quota is the feature here; groups' sizes and ranks are windows."""
    groups = rows.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    count = groups.agg(F.count(F.lit(1)).alias("__n__"))
    order = Window.orderBy(unit_hash(F.lit(seed), F.lit("group"), F.col(group)), F.col(group))  # one row a group
    quotas = groups.crossJoin(F.broadcast(count)).withColumn("__i__", F.row_number().over(order))
    quotas = quotas.withColumn("quota", F.floor(F.lit(total) / F.col("__n__")).cast("bigint") + F.when(F.col("__i__") <= F.lit(total) % F.col("__n__"), 1).otherwise(0)).select(group, "size", "quota")
    # before anything is ranked, rows whose hash is far beyond the quota's share go: eight deviations keep the quota but for one draw in 10 ** 14
    share = (F.col("quota") + 8 * F.sqrt("quota") + 16) / F.col("size")
    near = rows.withColumn("__u__", unit_hash(F.lit(seed), F.col(group), F.col(key))).join(quotas, group).where(F.col("__u__") <= share)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy("__u__", key)) - 1)
    drawn = ranked.where(F.col("rank") < F.col("quota"))
    turns = F.floor((F.col("quota") - 1 - F.col("rank")) / F.col("size")).cast("bigint")
    return drawn.select(group, key, F.explode(F.sequence(F.lit(0).cast("bigint"), turns)).alias("turn"), "rank", "size").select(group, key, (F.col("rank") + F.col("turn") * F.col("size")).alias("draw"))


def round_robin(rows: DataFrame, order: list[str], workers: int) -> DataFrame:
    """rows with ``worker``: position in order modulo the number of workers. Positions come from counts of range partitions."""
    ranged = rows.repartitionByRange(*order).withColumn("__p__", F.spark_partition_id())
    counts = ranged.groupBy("__p__").agg(F.count(F.lit(1)).alias("c"))
    before = counts.select("__p__", F.coalesce(F.sum("c").over(Window.orderBy("__p__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    place = F.row_number().over(Window.partitionBy("__p__").orderBy(*order)) - 1
    return ranged.join(F.broadcast(before), "__p__").withColumn("worker", F.pmod(F.col("b") + place, F.lit(workers))).drop("__p__", "b")


# --- sparse frames --------------------------------------------------------------------------------


def luma_metrics(pixels: Column, dark: int = 10, bright: int = 245) -> dict[str, Column]:
    """Mean, shares of dark and bright pixels and 16-bin entropy over 4 of an array of gray values 0..255."""
    n = F.size(pixels).cast("double")
    bins = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda b: F.size(F.filter(pixels, lambda p: F.floor(p / 16) == b)) / n)
    entropy = F.aggregate(bins, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0)) / 4.0
    return {
        "mean_luma": F.aggregate(pixels, F.lit(0.0), lambda s, p: s + p) / n,
        "dark_ratio": F.size(F.filter(pixels, lambda p: p <= dark)) / n,
        "bright_ratio": F.size(F.filter(pixels, lambda p: p >= bright)) / n,
        "entropy": entropy,
    }


def laplacian_variance(pixels: Column, width: int, height: int) -> Column:
    """Population variance of the four-neighbour Laplacian over inner pixels, over 255²."""
    inner = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(height - 2)), lambda y: F.transform(F.sequence(F.lit(1), F.lit(width - 2)), lambda x: y * width + x)))
    at = lambda i: F.get(pixels, i).cast("double")
    values = F.transform(inner, lambda i: at(i - 1) + at(i + 1) + at(i - width) + at(i + width) - 4 * at(i))
    n = (width - 2) * (height - 2)
    mean = F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / n
    square = F.aggregate(values, F.lit(0.0), lambda s, v: s + v * v) / n
    return (square - mean * mean) / (255.0 * 255.0)


def difference_hash(pixels: Column, width: int, height: int) -> Column:
    """64 bits, the first the highest: on a grid of 8 rows and 9 columns over the whole image (places rounded half to even), is a pixel
    brighter than the next to its right? As a bigint; ``hash_text`` gives its 16 hex digits."""
    rows = [min(height - 1, round(y * (height - 1) / 7)) for y in range(8)]
    columns = [min(width - 1, round(x * (width - 1) / 8)) for x in range(9)]
    places = F.array(*[F.struct(F.lit(y * width + columns[x]).alias("l"), F.lit(y * width + columns[x + 1]).alias("r")) for y in rows for x in range(8)])
    bit = lambda p: F.when(F.get(pixels, p["l"]) > F.get(pixels, p["r"]), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    return F.aggregate(places, F.lit(0).cast("bigint"), lambda s, p: F.shiftleft(s, 1).bitwiseOR(bit(p)))


def hash_text(code: Column) -> Column:
    return F.lower(F.lpad(F.hex(code), 16, "0"))


def frozen_pairs(frames: DataFrame, keys: list[str], order: str, pixels: str, code: str, difference: float = 0.002, distance: int = 1) -> DataFrame:
    """(keys, order, mad, hamming, frozen) of each frame against the one before."""
    before = Window.partitionBy(*keys).orderBy(order)
    both = frames.withColumn("__p__", F.lag(pixels).over(before)).withColumn("__c__", F.lag(code).over(before)).where("__p__ IS NOT NULL")
    mad = F.aggregate(F.zip_with(pixels, "__p__", lambda a, b: F.abs(a - b).cast("double")), F.lit(0.0), lambda s, x: s + x) / F.size(pixels) / 255.0
    out = both.select(*keys, order, mad.alias("mad"), F.bit_count(F.col(code).bitwiseXOR(F.col("__c__"))).cast("bigint").alias("hamming"))
    return out.withColumn("frozen", (F.col("mad") <= difference) & (F.col("hamming") <= distance))
