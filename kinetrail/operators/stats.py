"""Statistics over vectors, slots and windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetrail.functions.scalar import finite


def masked_moments(rows: DataFrame, keys: list[str], vector: str, mask: str | None = None, least_std: float = 1e-6) -> DataFrame:
    """(keys, slot, count, mean, std, valid): population moments of each slot over its valid entries; 0 and 1 for a slot without any."""
    columns = [F.col(vector).alias("v")] + ([F.col(mask).alias("m")] if mask else [])
    each = rows.select(*keys, *columns).select(*keys, *(["m"] if mask else []), F.posexplode("v").alias("slot", "value"))
    ok = finite(F.col("value").cast("double"))
    if mask:
        ok = ok & F.coalesce(F.get("m", F.col("slot")), F.lit(False))
    value = F.when(ok, F.col("value").cast("double"))
    sums = each.withColumn("x", value).groupBy(*keys, "slot").agg(F.count("x").alias("count"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("s2"))
    mean = F.col("s") / F.col("count")
    spread = F.sqrt(F.greatest(F.col("s2") / F.col("count") - mean * mean, F.lit(0.0)))
    some = F.col("count") > 0
    return sums.select(
        *keys,
        "slot",
        "count",
        F.when(some, mean).otherwise(F.lit(0.0)).alias("mean"),
        F.when(some, F.greatest(spread, F.lit(least_std))).otherwise(F.lit(1.0)).alias("std"),
        some.alias("valid"),
    )


def column_stats(rows: DataFrame, keys: list[str], vector: str, approximate: bool | None = None, exact_rows: int = 100_000) -> DataFrame:
    """(keys, dim, count, mean, std, min, max, q01, q99). Quantiles are exact at every size and no task holds all values of a group, see ``quantiles``;
    ``exact_rows`` is the size of a group up to which its values are ranked whole. With ``approximate`` they come from a sketch with a rank error of
    1 in 10,000; where it is False, from one aggregate that holds a group's distinct values."""
    each = rows.select(*keys, F.posexplode(vector).alias("dim", "value")).withColumn("value", F.col("value").cast("double")).where(finite(F.col("value")))
    by, at = [*keys, "dim"], [0.01, 0.99]
    near = [min(max(x + d, 0.0), 1.0) for x in at for d in (-SLACK, SLACK)]
    q = F.percentile_approx("value", at, 10_000) if approximate else F.percentile("value", F.array(*[F.lit(x) for x in at])) if approximate is False else F.percentile_approx("value", near, 10_000)
    out = each.groupBy(*by).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"), q.alias("q")
    )
    if approximate is None:
        exact = quantiles(each, by, "value", at, out.where(F.col("count") > exact_rows).select(*by, F.col("q").alias("near")))
        exact = exact.select(*[F.col(k).alias(f"__{k}__") for k in by], "q")
        out = out.drop("q").join(exact, _same(by))
    return out.select(*keys, "dim", "count", "mean", "std", "min", "max", F.get("q", F.lit(0)).alias("q01"), F.get("q", F.lit(1)).alias("q99"))


#: how far from a quantile its bounds are asked for, as a share of the ranks: thrice the sketch's error of 1 in 10,000
SLACK = 3e-4


def _same(keys: list[str]) -> Column:
    """The join of keys with ``__keys__``, null with null."""
    both = [F.col(k).eqNullSafe(F.col(f"__{k}__")) for k in keys]
    return reduce(lambda x, y: x & y, both)


def quantiles(each: DataFrame, keys: list[str], value: str, at: list[float], bounds: DataFrame) -> DataFrame:
    """(keys, q): exact quantiles with linear interpolation, in the ascending order of ``at``.

    bounds: (keys, near) for large groups, a lower and an upper value for each quantile. Of these groups only the values between bounds go on, one row for
    each distinct value; all others are counted where they lie. Groups without bounds go on whole. There is a group with bounds for so many values that
    bounds are small enough to be sent to all tasks. Bounds that miss a rank stop the query."""
    marks = F.broadcast(bounds.select(*[F.col(k).alias(f"__{k}__") for k in keys], "near"))
    x, edge = F.col(value), lambda i: F.get("near", F.lit(i))
    inside = reduce(lambda a, b: a | b, [x.between(edge(2 * i), edge(2 * i + 1)) for i in range(len(at))])
    past = reduce(lambda a, b: a + b, [(x > edge(2 * i + 1)).cast("int") for i in range(len(at))])
    cells = each.join(marks, _same(keys), "left").select(*keys, F.coalesce(past, F.lit(0)).alias("past"), F.when(F.col("near").isNull() | inside, x).alias("x"))
    cells = cells.groupBy(*keys, "past", "x").agg(F.count(F.lit(1)).alias("c"))
    # values past equally many upper bounds: first those below the next lower bound, which have no x, then those inside
    order = Window.partitionBy(*keys).orderBy("past", F.col("x").asc_nulls_first())
    ranked = cells.withColumn("upto", F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.sum("c").over(Window.partitionBy(*keys)))
    place = lambda q: F.lit(q) * (F.col("n") - 1)
    holds = lambda rank: (rank >= F.col("upto") - F.col("c")) & (rank < F.col("upto"))
    found = [F.max(F.when(holds(f(place(q))), F.col("x"))).alias(f"{name}{i}") for i, q in enumerate(at) for name, f in (("low", F.floor), ("high", F.ceil))]
    picked = ranked.groupBy(*keys).agg(F.max("n").alias("n"), *found)
    known = lambda c: F.coalesce(F.col(c), F.raise_error(F.lit("quantiles: bounds miss a rank")).cast("double"))
    part = lambda q: place(q) - F.floor(place(q))
    return picked.select(*keys, F.array(*[known(f"low{i}") * (1 - part(q)) + known(f"high{i}") * part(q) for i, q in enumerate(at)]).alias("q"))


def relative_pairs(frames: DataFrame, horizon: int, keys: list[str], action: str, state: str, index: str = "idx", length: str = "n") -> DataFrame:
    """action[t + o] - state[t] for o in [0, horizon) and t < n - horizon, pooled: (keys, t, o, value). An equi join on shifted rows."""
    base = frames.where(F.col(index) < F.col(length) - horizon).select(*keys, F.col(index).alias("t"), F.col(state).alias("s"))
    asked = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))).alias("o")).withColumn("at", F.col("t") + F.col("o"))
    given = frames.select(*keys, F.col(index).alias("at"), F.col(action).alias("a"))
    return asked.join(given, [*keys, "at"]).select(*keys, "t", "o", (F.col("a") - F.col("s")).alias("value"))


def z_score(value: Column, mean: Column, std: Column, valid: Column, limit: float = 10.0) -> Column:
    """Clipped normal score; 0 where invalid."""
    score = F.greatest(F.least((value - mean) / std, F.lit(limit)), F.lit(-limit))
    return F.when(valid & finite(value), score).otherwise(F.lit(0.0))


def un_z(score: Column, mean: Column, std: Column, valid: Column) -> Column:
    return F.when(valid, score * std + mean).otherwise(F.lit(0.0))


def lag_alignment(pairs: DataFrame, keys: list[str], slot: str = "slot", longest: int = 10, least: float = 0.2, index: str = "idx") -> DataFrame:
    """Best lag between action and state series: for each lag the median over slots of Pearson's correlation of action(t) with
    state(t + lag), over finite pairs, 8 at least; the best median, the lowest lag on ties.

    pairs: (keys, slot, idx, action, state), a row for each place. Lags are columns of one pass over one partitioning."""
    order = Window.partitionBy(*keys, slot).orderBy(index)
    clean = lambda c: F.when(finite(F.col(c)), F.col(c))
    rows = pairs.select(*keys, slot, index, clean("action").alias("action"), clean("state").alias("state"))
    rows = rows.select(*keys, slot, "action", *[F.lead("state", k).over(order).alias(f"s{k}") for k in range(longest + 1)])
    found = []
    for k in range(longest + 1):
        both = F.col("action").isNotNull() & F.col(f"s{k}").isNotNull()
        a, s, n = F.when(both, F.col("action")), F.when(both, F.col(f"s{k}")), F.count_if(both)
        varies = (n >= 8) & (F.stddev_pop(a) * F.sqrt(n) > 1e-12) & (F.stddev_pop(s) * F.sqrt(n) > 1e-12)
        found.append(F.when(varies, F.corr(a, s)).alias(f"r{k}"))
    each = rows.groupBy(*keys, slot).agg(*found)
    scores = each.groupBy(*keys).agg(*[F.median(f"r{k}").alias(f"m{k}") for k in range(longest + 1)], *[F.count(f"r{k}").alias(f"c{k}") for k in range(longest + 1)])
    tried = F.array(*[F.when(F.col(f"m{k}").isNotNull(), F.struct(F.col(f"m{k}").alias("score"), F.lit(-k).alias("back"), F.col(f"c{k}").alias("dims"))) for k in range(longest + 1)])
    best = scores.select(*keys, F.array_max(F.array_compact(tried)).alias("b")).where("b IS NOT NULL")
    status = F.when(F.col("b.score") >= least, F.lit("passed")).otherwise(F.lit("low_confidence"))
    return best.select(*keys, (-F.col("b.back")).alias("best_lag"), F.col("b.score").alias("score"), F.col("b.dims").alias("dims"), status.alias("status"))
