"""Which rows are taken: repositories, files, episodes, samples and slots; whose row wins a join; checks that stop a run."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetrail.functions.scalar import unit_hash

# --- checks -----------------------------------------------------------------------------------------


def stop_where(rows: DataFrame, bad: Column, message: Column) -> DataFrame:
    """rows as they are; the query fails with the message at the first row that is bad (null counts as good)."""
    guard = F.when(F.coalesce(bad, F.lit(False)), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return rows.where(guard)


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n) of the keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def drifting(rows: DataFrame, keys: list[str], contract: list[str]) -> DataFrame:
    """(keys, column) where a column that must be the same in all rows of a key is not; null is a value of its own."""
    spread = rows.groupBy(*keys).agg(*[F.count_distinct(F.struct(c)).alias(c) for c in contract])
    names = F.array_compact(F.array(*[F.when(F.col(c) > 1, F.lit(c)) for c in contract]))
    return spread.select(*keys, F.explode(names).alias("column"))


def descending(rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """(keys, order) of the rows whose value is below the one before; indices must not fall."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    return rows.select(*keys, order, (F.col(value) < before).alias("__falls__")).where("__falls__").drop("__falls__")


def resumable(stored: DataFrame, expected: DataFrame, key: str, identity: list[str]) -> DataFrame:
    """stored rows with ``differs``: the parts of the identity, sorted, that are not as expected; all of them where nothing is expected."""
    wanted = expected.select(key, F.struct(*identity).alias("__want__"), F.lit(True).alias("__known__"))
    both = stored.join(wanted, key, "left")
    differs = [F.when(F.col("__known__").isNull() | ~F.col(c).eqNullSafe(F.col("__want__")[c]), F.lit(c)) for c in sorted(identity)]
    return both.withColumn("differs", F.array_compact(F.array(*differs))).drop("__want__", "__known__")


# --- repositories and files -------------------------------------------------------------------------


def glob_pattern(glob: str) -> str:
    """A regular expression of a shell pattern with *, ? and [...], for whole names."""
    out, i = [], 0
    while i < len(glob):
        end = glob.find("]", i + 2) if glob[i] == "[" else -1
        if end > 0:
            body = glob[i + 1 : end].replace("\\", "\\\\")
            out.append("[" + ("^" + body[1:] if body[0] == "!" else body) + "]")
            i = end
        else:
            out.append({"*": ".*", "?": "."}.get(glob[i], re.sub(r"([^\w])", r"\\\1", glob[i])))
        i += 1
    return "^(?s:" + "".join(out) + ")$"


def repositories(lock: DataFrame, names: list[str] | None = None, glob: str | None = None, most: int | None = None) -> DataFrame:
    """The repositories of the wanted datasets (none or ``all``: every one) whose id or local name fits the pattern, the first ``most``
    in lock order. lock: (ordinal, dataset, repo_id, local_name). An unknown dataset is an error, and so is an empty result."""
    if most is not None and most < 1:
        raise ValueError("the number of repositories must be positive")
    out = lock
    if names and "all" not in names:
        known = {r.dataset for r in lock.select("dataset").distinct().collect()}  # one row a dataset
        unknown = sorted(set(names) - known)
        if unknown:
            raise ValueError(f"unknown datasets: {unknown}")
        out = out.where(F.col("dataset").isin(*names))
    if glob:
        fits = glob_pattern(glob)
        out = out.where(F.col("repo_id").rlike(fits) | F.col("local_name").rlike(fits))
    if most is not None:
        out = out.orderBy("ordinal").limit(most)
    if out.isEmpty():
        raise ValueError("no repository is left")
    return out


def remote_files(files: DataFrame, components: list[str], shards: list[str] | None = None, path: str = "path") -> DataFrame:
    """Files below the wanted top folders and, where shards are named, with one of their base names."""
    parts = F.split(F.col(path), "/")
    out = files.where(F.get(parts, F.lit(0)).isin(*components))
    return out if shards is None else out.where(F.element_at(parts, -1).isin(*shards))


def is_partial(path: Column) -> Column:
    """Is this the name of a file that is still being written?"""
    return F.lower(path).rlike(r"\.(part|partial|tmp|incomplete)$|\.incomplete(/|$)")


def newest(results: DataFrame, keys: list[str], launched: str, changed: str, slack: float = 2.0) -> DataFrame:
    """The newest result of each key that is not older than its launch, by ``slack`` seconds; none where all are older."""
    fresh = results.where(F.col(changed) >= F.col(launched) - slack)
    return fresh.groupBy(*keys).agg(F.max_by(F.struct(*results.columns), F.struct(changed, *[c for c in results.columns if c not in (*keys, changed)])).alias("r")).select("r.*")


def error_class(name: Column, status: Column, transport: Column) -> dict[str, Column]:
    """Label of a failed download and whether another try may help. name: the error's class; transport: a time-out or lost connection."""
    low = F.lower(F.coalesce(name, F.lit("")))
    code = status.cast("int")
    gone = F.coalesce(transport, F.lit(False)) | low.rlike("timeout|connection|proxy")
    label = (
        F.when(low.contains("gated") | (code == 403), "needs_approval")
        .when(code == 401, "authentication_failed")
        .when(low.contains("repositorynotfound") | (code == 404), "not_found_or_no_access")
        .when(code == 429, "rate_limited")
        .when(code >= 400, F.concat(F.lit("http_"), code.cast("string")))
        .when(gone, "network_error")
        .otherwise("error")
    )
    final = label.isin("needs_approval", "authentication_failed", "not_found_or_no_access")
    again = F.when(final, False).when((code >= 400) & (code < 500) & (code != 429), code.isin(408, 409, 425)).otherwise(True)
    return {"label": label, "retryable": again}


def redacted(text: Column, secrets: list[str], most: int = 2000) -> Column:
    """White space collapsed, secrets masked, then cut."""
    out = F.trim(F.regexp_replace(text, r"\s+", " "))
    for secret in secrets:
        if secret:
            out = F.replace(out, F.lit(secret), F.lit("<redacted>"))
    return F.substring(out, 1, most)


# --- whose row wins ----------------------------------------------------------------------------------


def first_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``: a grouped minimum, one row a key and task before the shuffle."""
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("__row__")).select("__row__.*")


def last_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("__row__")).select("__row__.*")


def with_members(episodes: DataFrame, members: DataFrame, tasks: DataFrame, key: str) -> DataFrame:
    """episodes with the member of the first archive and the task of the last file that name them; null without one.

    members: (key, archive_ordinal, member); tasks: (key, file_ordinal, row_ordinal, task). A key with any number of members costs one row a task."""
    first = first_of(members, [key], ["archive_ordinal", "member"]).select(key, "member")
    last = last_of(tasks, [key], ["file_ordinal", "row_ordinal"]).select(key, "task")
    return episodes.join(first, key, "left").join(last, key, "left")


def with_baselines(scores: DataFrame, baselines: DataFrame, task: str, value: str) -> DataFrame:
    """A row for each score and policy of the fixed baselines: its value and the difference. baselines: (task, policy, baseline)."""
    both = scores.join(baselines, task, "left")
    return both.withColumn("delta", F.col(value) - F.col("baseline"))


def merged_shards(expected: DataFrame, shards: DataFrame, key: str) -> DataFrame:
    """(key, problem): keys that no shard holds, that several hold, or that are not expected. Empty: the shards may be united."""
    held = shards.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    both = expected.select(key, F.lit(True).alias("__due__")).distinct().join(held, key, "full_outer")
    problem = F.when(F.col("n").isNull(), "missing").when(F.col("__due__").isNull(), "unexpected").when(F.col("n") > 1, "duplicate")
    return both.select(key, problem.alias("problem")).where("problem IS NOT NULL")


def in_order(selection: DataFrame, shards: DataFrame, key: str, ordinal: str) -> DataFrame:
    """The shards' rows with the place of their key in the selection; the query fails where the keys are not the selection's, once each."""
    problems = merged_shards(selection, shards, key).agg(F.count(F.lit(1)).alias("__bad__"))
    both = shards.join(selection.select(key, ordinal), key).crossJoin(F.broadcast(problems))  # one row
    return stop_where(both, F.col("__bad__") > 0, F.lit("the shards do not cover the selection")).drop("__bad__")


def union_distinct(*paths: DataFrame) -> DataFrame:
    """Rows (path) of several manifests, each path once, at its first place: (place, path)."""
    every = None
    for i, one in enumerate(paths):
        part = one.select(F.struct(F.lit(i).alias("manifest"), F.col("ordinal")).alias("at"), "path")
        every = part if every is None else every.unionByName(part)
    return every.groupBy("path").agg(F.min("at").alias("at")).select("path", F.col("at.manifest").alias("manifest"), F.col("at.ordinal").alias("ordinal"))


def variants(episodes: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Each episode once for every variant of its key, with the variant's columns; episodes without variants stay once."""
    return episodes.join(table, on, "left")


# --- limits and slices --------------------------------------------------------------------------------


def first_in_order(rows: DataFrame, ordinal: str, most: int) -> DataFrame:
    """The rows that come first in their manifest. Ordinals are dense, so this is a filter that reaches the scan."""
    return rows.where(F.col(ordinal) < most)


def longest(episodes: DataFrame, length: str, index: str, most: int, need: int = 0, start: int = 0, chosen: list[int] | None = None) -> DataFrame:
    """The chosen episodes, else the ``most`` longest that have ``need`` frames from ``start`` on; the lower index first on ties."""
    if chosen is not None:
        return episodes.where(F.col(index).isin(*chosen))
    return episodes.where(F.col(length) - start >= need).orderBy(F.col(length).desc(), index).limit(most)


def sliced(samples: DataFrame, case: str, order: str, skip: int = 0, per_case: int | None = None, offset: int = 0, stride: int = 1, most: int | None = None) -> DataFrame:
    """Samples after a cut in each case, then every ``stride``-th from ``offset`` on over all cases, then a cut of the rest.

    Places over all cases come from the cases' sizes, a running sum over one row a case."""
    place = F.row_number().over(Window.partitionBy(case).orderBy(order)) - 1
    rows = samples.withColumn("__i__", place - skip).where("__i__ >= 0")
    rows = rows if per_case is None else rows.where(F.col("__i__") < per_case)
    sizes = rows.groupBy(case).agg(F.count(F.lit(1)).alias("__n__"))
    before = sizes.select(case, F.coalesce(F.sum("__n__").over(Window.orderBy(case).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b__"))
    at = F.col("__b__") + F.col("__i__") - offset
    out = rows.join(before, case).withColumn("place", F.floor(at / stride).cast("bigint")).where((at >= 0) & (F.pmod(at, F.lit(stride)) == 0))
    out = out if most is None else out.where(F.col("place") < most)
    return out.drop("__i__", "__b__")


def memory_ready(windows: DataFrame, keys: list[str], start: str = "start", mode: str = "mode", least: int = 40) -> DataFrame:
    """The windows of each key that start late enough to have a history: the joint ones, else all late ones, else all."""
    late, joint = F.col(start) >= least, F.col(mode) == "joint_video_action"
    level = F.when(late & joint, 0).when(late, 1).otherwise(2)
    best = F.min("__level__").over(Window.partitionBy(*keys))
    return windows.withColumn("__level__", level).withColumn("__best__", best).where("__level__ = __best__").drop("__level__", "__best__")


def free_slots(workers: DataFrame, slots: int, taken: DataFrame, worker: str = "gpu") -> DataFrame:
    """(slot, worker, place) of the free slots: slot by slot, in each by worker. Workers are machines, few."""
    every = workers.select(worker, F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    free = every.join(taken.select(worker, "slot"), [worker, "slot"], "left_anti")
    return free.withColumn("place", F.row_number().over(Window.orderBy("slot", worker)) - 1)


def capped(values: Column, most: int) -> Column:
    """The first values of a sorted array, for reports."""
    return F.slice(F.array_sort(values), 1, most)


# --- vectors of samples --------------------------------------------------------------------------------


def shifted(vector: Column) -> dict[str, Column]:
    """States are all values but the last, actions all but the first."""
    n = F.size(vector)
    return {"state": F.slice(vector, 1, F.greatest(n - 1, F.lit(0))), "action": F.slice(vector, 2, F.greatest(n - 1, F.lit(0)))}


def widened(vector: Column, slots: list[int], size: int = 80) -> Column:
    """A packed vector at its slots of the wide layout, 0 elsewhere."""
    return F.array(*[F.coalesce(F.get(vector, F.lit(slots.index(k))), F.lit(0.0)) if k in slots else F.lit(0.0) for k in range(size)])


def packed(vector: Column, slots: list[int]) -> Column:
    """The slots of a wide vector in packed order."""
    return F.array(*[F.get(vector, F.lit(k)) for k in slots])


def latent_window(length: Column, width: int, seed: int, *key: Column) -> Column:
    """A start in [0, length - width], the same for one seed and key; null if the latent is too short."""
    free = length - width + 1
    return F.when(free > 0, F.floor(unit_hash(F.lit(seed), *key) * free).cast("bigint"))


# --- chunks ------------------------------------------------------------------------------------------


def feedback_schedule(episodes: DataFrame, chunks: str, start: str, length: str, frames: int = 4, temporal: int = 4, stride: int = 1) -> DataFrame:
    """One row for each chunk whose observations are fed back: the first has (frames - 1) * temporal of them, later ones frames * temporal.

    (first_frame, last_frame, observations) follow each other at the stride; ``inside`` says whether the chunk ends within the episode.
    The last chunk is not fed back."""
    rows = episodes.where(F.col(chunks) > 1).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(chunks).cast("bigint") - 2)))
    full, less = frames * temporal, (frames - 1) * temporal
    count = F.when(F.col("chunk") == 0, less).otherwise(full).cast("bigint")
    before = F.when(F.col("chunk") == 0, 0).otherwise(less + (F.col("chunk") - 1) * full).cast("bigint")
    first = F.col(start) + before * stride
    out = rows.withColumn("observations", count).withColumn("first_frame", first).withColumn("last_frame", first + (count - 1) * stride)
    return out.withColumn("inside", F.col("last_frame") < F.col(length))


def action_cursor(chunks: DataFrame, keys: list[str], order: str, steps: str) -> DataFrame:
    """chunks with [from_step, to_step): a running sum of the steps that each uses."""
    upto = F.sum(steps).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return chunks.withColumn("from_step", upto - F.col(steps)).withColumn("to_step", upto)


def executed(actions: DataFrame, chunks: DataFrame, key: str, index: str, vector: str, steps: int = 8, columns: tuple[int, ...] = (0, 1, 2, 3, 4, 5, 6, 14)) -> DataFrame:
    """(key, chunk, step, executed) of the first ``steps`` actions of each chunk; ``short`` chunks lack some of them.

    chunks: (key, chunk, anchor). The steps are an equi join on the row index."""
    asked = chunks.select(key, "chunk", F.explode(F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda s: F.struct(s.cast("bigint").alias("step"), (F.col("anchor") + s).cast("bigint").alias(index)))).alias("x"))
    asked = asked.select(key, "chunk", "x.step", F.col("x")[index].alias(index))
    both = asked.join(actions.select(key, index, packed(F.col(vector), list(columns)).alias("executed")), [key, index], "left")
    have = F.count("executed").over(Window.partitionBy(key, "chunk"))
    return both.withColumn("short", have < steps).drop(index)


# --- groups -------------------------------------------------------------------------------------------


def transition_moments(steps: DataFrame, task: str, episode: str, order: str, value: str) -> DataFrame:
    """By task: transitions, mean and population deviation of value(t + 1) - value(t), episodes, least and greatest length."""
    step = F.col(value) - F.lag(value).over(Window.partitionBy(task, episode).orderBy(order))
    each = steps.withColumn("__d__", step).groupBy(task, episode).agg(F.count(F.lit(1)).alias("n"), F.count("__d__").alias("k"), F.sum("__d__").alias("s"), F.sum(F.col("__d__") * F.col("__d__")).alias("q"))
    out = each.groupBy(task).agg(F.count(F.lit(1)).alias("episodes"), F.min("n").alias("shortest"), F.max("n").alias("longest"), F.sum("k").alias("transitions"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    mean = F.try_divide(F.col("s"), F.col("transitions"))
    spread = F.sqrt(F.greatest(F.try_divide(F.col("q"), F.col("transitions")) - mean * mean, F.lit(0.0)))
    return out.select(task, "episodes", "shortest", "longest", "transitions", mean.alias("mean"), spread.alias("std"))


def probe_means(probes: DataFrame, keys: list[str], slot: str, value: str) -> DataFrame:
    """Means over the probes that have a value, by slot and over all slots (null)."""
    return probes.groupingSets([[*keys, slot], keys], *keys, slot).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def segment_conflicts(jobs: DataFrame, keys: list[str], frames: str = "frame_ids", text: str = "text", camera: str = "camera") -> DataFrame:
    """(keys, problem) of segments whose cameras differ in frames or text, or are named twice."""
    seen = jobs.groupBy(*keys).agg(F.count_distinct(F.to_json(F.struct(frames))).alias("f"), F.count_distinct(F.struct(text)).alias("t"), F.count(F.lit(1)).alias("n"), F.count_distinct(camera).alias("c"))
    checks = F.array_compact(F.array(F.when(F.col("f") > 1, F.lit("frames_differ")), F.when(F.col("t") > 1, F.lit("text_differs")), F.when(F.col("c") < F.col("n"), F.lit("camera_twice"))))
    return seen.select(*keys, F.explode(checks).alias("problem"))


def prompts_in_order(rows: DataFrame, keys: list[str], prompt: str, ordinal: str) -> DataFrame:
    """(keys, prompts): distinct prompts by first place. Grouped twice, so a prompt in a third of all rows is one row a task."""
    first = rows.where(F.col(prompt).isNotNull()).groupBy(*keys, prompt).agg(F.min(ordinal).alias("at"))
    listed = F.array_sort(F.collect_list(F.struct("at", F.col(prompt).alias("p"))))
    return first.groupBy(*keys).agg(listed.alias("x")).select(*keys, F.transform("x", lambda r: r["p"]).alias("prompts"))


def agreed_stab(hits: DataFrame, key: str, point: str, camera: str, value: str, cameras: int, every: int = 4) -> DataFrame:
    """(key, point, value) where all cameras name one value; ``agreed`` is false where they differ or one is missing.

    Only every fourth frame counts."""
    rows = hits.where(F.pmod(F.col(point), F.lit(every)) == 0)
    seen = rows.groupBy(key, point).agg(F.count_distinct(value).alias("v"), F.count_distinct(F.when(F.col(value).isNotNull(), F.col(camera))).alias("c"), F.min(value).alias(value))
    agreed = (F.col("v") == 1) & (F.col("c") == cameras)
    return seen.select(key, point, F.when(agreed, F.col(value)).alias(value), agreed.alias("agreed"))
