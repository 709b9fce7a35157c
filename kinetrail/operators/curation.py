"""Scores, tiers, admission, duplicates, splits and weights of episodes, from reason codes and stage statuses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetrail.functions.scalar import stable_id, unit_hash

# Weights of the component scores, scores of the stage statuses.
WEIGHTS = {"integrity": 0.25, "temporal": 0.20, "visual": 0.20, "kinematic": 0.20, "language": 0.10, "novelty": 0.05}
STAGE_SCORES = {"passed": 1.0, "warning": 0.65, "low_confidence": 0.40, "pending": 0.50, "failed": 0.0}
TIER_WEIGHTS = {"A": 1.0, "B": 0.5}


@dataclass(frozen=True)
class AdmissionPolicy:
    least_frames: int = 81
    fps: float = 20.0

    @property
    def least_seconds(self) -> float:
        return (self.least_frames - 1) / self.fps


def stage_score(status: Column) -> Column:
    return F.coalesce(*[F.when(status == k, F.lit(v)) for k, v in STAGE_SCORES.items()], F.lit(0.5))


def unit(x: Column) -> Column:
    """x within [0, 1]; null stays null (greatest and least skip nulls)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def component_score(parts: dict[str, Column]) -> Column:
    """Weighted mean of the components that are present (not null), each within [0, 1]; null if none is."""
    top = sum((F.coalesce(unit(parts[k]) * w, F.lit(0.0)) for k, w in WEIGHTS.items() if k in parts), F.lit(0.0))
    low = sum((F.when(parts[k].isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for k, w in WEIGHTS.items() if k in parts), F.lit(0.0))
    return F.when(low > 0, top / low)


def penalty_score(failures: Column, warnings: Column, pending: Column, short: Column, has_action: Column, has_state: Column) -> Column:
    """The score of an episode without components: counts of reason codes and missing parts take from 1."""
    zero = F.lit(0.0)
    taken = 0.45 * failures + 0.08 * warnings + 0.03 * pending
    return unit(1.0 - taken - F.when(short, 0.15).otherwise(zero) - F.when(has_action, zero).otherwise(0.1) - F.when(has_state, zero).otherwise(0.1))


def tiers(failed: Column, video: Column, long: Column, state: Column, action: Column, action_ok: Column, visual_ok: Column) -> dict[str, Column]:
    """tier and candidate_tier, video_eligible and action_eligible."""
    seen = video & ~failed
    full = seen & long & state & action & action_ok & visual_ok
    maybe = state & action & long
    return {
        "video_eligible": seen,
        "action_eligible": full,
        "tier": F.when(failed, "C").when(full, "A").otherwise("B"),
        "candidate_tier": F.when(failed, "C").when(full | maybe, "A").otherwise("B"),
    }


def reasons(*pairs: tuple[Column, str]) -> Column:
    """Sorted distinct codes whose conditions hold."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(cond, F.lit(code)) for cond, code in pairs]))))


def duration(measured: Column, recorded: Column, frames: Column, *rates: Column) -> Column:
    """Measured seconds, else recorded, else frames at the first positive rate."""
    rate = F.coalesce(*[F.when(r > 0, r) for r in rates])
    return F.coalesce(measured, recorded, F.greatest(F.lit(0.0), (frames - 1) / rate))


def admission_mode(tier: Column, video_eligible: Column, action_eligible: Column, seconds: Column, policy: AdmissionPolicy = AdmissionPolicy()) -> Column:
    long = F.coalesce(seconds + 1e-8 >= policy.least_seconds, F.lit(False))
    return F.when((tier == "C") | ~video_eligible | ~long, "reject").when(action_eligible, "joint_video_action").otherwise("video_only")


def first_wins(rows: DataFrame, fingerprint: str, order: list[str], holder: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """rows with ``duplicate_of`` (the first holder's id, null for the first) and status; nothing is dropped.

    The first holder is a grouped minimum joined back, so a fingerprint that a third of all rows share is one row a task before the
    shuffle and the join can be split. Null fingerprints are pending."""
    first = rows.where(F.col(fingerprint).isNotNull()).groupBy(*keys, fingerprint).agg(F.min(F.struct(*order, F.col(holder).alias("__first__"))).alias("__f__"))
    both = rows.join(first, [*keys, fingerprint], "left")
    own = F.col("__f__.__first__").eqNullSafe(F.col(holder))
    status = F.when(F.col(fingerprint).isNull(), "pending").when(own, "unique").otherwise("duplicate")
    return both.withColumn("duplicate_of", F.when(~own, F.col("__f__.__first__"))).withColumn("dedupe_status", status).drop("__f__")


def split_group(lineage: Column, uri: Column, episode: Column) -> Column:
    return stable_id(F.coalesce(lineage, F.sha2(uri, 256), episode))


def split(group: Column, seed: str = "episodes-v1", train: float = 0.98, validation: float = 0.01) -> Column:
    u = unit_hash(F.lit(seed), group)
    return F.when(u < train, "train").when(u < train + validation, "validation").otherwise("test")


def sample_weight(mixture: Column, tier: Column, audit: Column) -> Column:
    """Product of the weights; a mixture weight of 0 or none counts as 1."""
    by_tier = F.coalesce(*[F.when(tier == k, F.lit(v)) for k, v in TIER_WEIGHTS.items()], F.lit(0.0))
    return F.coalesce(F.nullif(mixture, F.lit(0.0)), F.lit(1.0)) * by_tier * audit


def ranked_slots(items: DataFrame, keys: list[str], role: str, order: list[Column], roles: list[str]) -> DataFrame:
    """(keys, slot, item): the best item of each role, then a second primary as the secondary and any other as the auxiliary.

    Greedy choice as ranks: items are ranked within (keys, role) once, what is left over once more."""
    best = Window.partitionBy(*keys, role).orderBy(*order)
    ranked = items.withColumn("__r__", F.row_number().over(best))
    first = ranked.where("__r__ = 1").withColumn("slot", F.col(role))
    has = first.groupBy(*keys).agg(F.collect_set("slot").alias("__have__"))
    rest = ranked.where("__r__ > 1").join(has, keys)
    primary, secondary, spare = roles[0], roles[1], roles[-1]
    second = rest.where((F.col(role) == primary) & (F.col("__r__") == 2) & ~F.array_contains("__have__", secondary)).withColumn("slot", F.lit(secondary))
    used = second.select(*keys, F.col(role), F.col("__r__"), F.lit(True).alias("__used__"))
    left = rest.join(used, [*keys, role, "__r__"], "left").where("__used__ IS NULL AND NOT array_contains(__have__, '%s')" % spare)
    other = left.withColumn("__o__", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__o__ = 1").withColumn("slot", F.lit(spare))
    kept = [*items.columns, "slot"]
    return first.select(*kept).unionByName(second.select(*kept)).unionByName(other.select(*kept))


def top_by_role(items: DataFrame, keys: list[str], role: str, order: list[Column], limit: int) -> DataFrame:
    """One item of each role first, by order, then the others: the first ``limit`` of each key."""
    ranked = items.withColumn("__r__", F.row_number().over(Window.partitionBy(*keys, role).orderBy(*order)))
    chosen = ranked.withColumn("__p__", F.row_number().over(Window.partitionBy(*keys).orderBy((F.col("__r__") > 1).cast("int"), *order)))
    return chosen.where(F.col("__p__") <= limit).withColumn("rank", F.col("__p__").cast("bigint")).drop("__r__", "__p__")


def resolve_profiles(rows: DataFrame, profiles: DataFrame, key: str, defaults: dict) -> DataFrame:
    """rows with each default column, taken from the profile of ``key`` where it sets one."""
    joined = rows.join(profiles, key, "left")
    return joined.select(*[rows[x] for x in rows.columns], *[F.coalesce(profiles[x], F.lit(v)).alias(x) for x, v in defaults.items()])


def mapping_with_collisions(features: DataFrame, keys: list[str], slot: str, order: list[str]) -> DataFrame:
    """features with ``kept``: the first occupant of each slot; the others are collisions."""
    rank = F.row_number().over(Window.partitionBy(*keys, slot).orderBy(*order))
    return features.withColumn("kept", F.col(slot).isNotNull() & (rank == 1))


def scatter(rows: DataFrame, mapping: list[tuple[int, int]], vector: str, size: int = 80) -> list[Column]:
    """[slots, mask] columns from (source index, slot) pairs: 0 and false where the source is missing or not finite."""
    where = {s: i for i, s in mapping}
    cells = []
    for s in range(size):
        value = F.get(F.col(vector), F.lit(where[s])).cast("float") if s in where else F.lit(None).cast("float")
        cells.append(F.when(F.isnan(value) | (F.abs(value) == float("inf")), F.lit(None)).otherwise(value) if s in where else value)
    found = F.array(*cells)
    return [F.transform(found, lambda x: F.coalesce(x, F.lit(0.0).cast("float"))), F.transform(found, lambda x: x.isNotNull())]
