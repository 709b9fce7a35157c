"""Registered queries of curation, catalogue, metric and sampling operators over the other tables."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinetrail.functions import scalar as sc
from kinetrail.operators import curation as cu
from kinetrail.operators import intervals as iv
from kinetrail.operators import reports as rp
from kinetrail.operators import signals, stats, temporal
from kinetrail.plans.base import rounded, table

# --- catalogues and sets --------------------------------------------------------------------------


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber")).distinct()


def frame_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.contiguous(_numbers(spark, sf_dir), ["l_orderkey"], "l_linenumber", ["l_linenumber"])


def missing_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = temporal.missing_parts(_numbers(spark, sf_dir), ["l_orderkey"], "l_linenumber")
    return out.select("l_orderkey", F.array_join("missing", ",").alias("missing"))


def compact_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.compact(_numbers(spark, sf_dir), ["l_orderkey"], 1, "l_linenumber")


def interval_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of event days: [day, day + 1 + n) where n comes from the properties, coalesced by user and type."""
    events = table(spark, sf_dir, "events")
    day = F.expr("unix_micros(CAST(ts AS timestamp)) DIV 86400000000")  # towards zero before 1970, and n keeps its sign, as in the SQL
    n = F.coalesce(F.round(F.get_json_object("props", "$.k").cast("decimal(38,10)")).cast("bigint"), F.lit(0).cast("bigint"))
    spans = events.select("user_id", "event_type", day.alias("start"), (day + 1 + n % 3).alias("stop"))
    return iv.coalesce(spans, ["user_id", "event_type"])


def valid_index_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys that lineitem, orders and the first half of the key range all hold."""
    lines, orders = table(spark, sf_dir, "lineitem").select("l_orderkey"), table(spark, sf_dir, "orders")
    limit = orders.agg((F.max("o_orderkey") / 2).alias("m"))
    half = orders.crossJoin(F.broadcast(limit)).where("o_orderkey <= m").select("o_orderkey")
    return lines.intersect(orders.select("o_orderkey")).intersect(half).withColumnRenamed("l_orderkey", "idx")


def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as locked repositories, finished ones as markers, those with lines as present: status by priority and in all."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    lock = orders.select("o_orderkey", "o_orderpriority", F.col("o_orderstatus").alias("revision"))
    k = F.col("o_orderkey")
    said = F.when(k % 3 == 1, "ok").when(k % 7 == 0, "running").otherwise("error")
    marker = orders.where("o_orderkey % 3 <> 0").select("o_orderkey", said.alias("marker_status"), F.when(k % 5 == 0, "old").otherwise(F.col("o_orderstatus")).alias("marker_revision"))
    here = lines.where("l_orderkey % 13 <> 0").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_quantity") > 48).cast("int").alias("incomplete"))
    return rp.two_level_counts(rp.status(lock, marker, here, "o_orderkey"), "o_orderpriority", "status")


def missing_and_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a remote manifest against suppliers as local files, sizes from the nations."""
    remote = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("file"), F.col("c_nationkey").alias("size"))
    local = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("file"), F.col("s_nationkey").alias("size"))
    return rp.verify(remote, local, "file", "size")


def destination_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types that parts of several brands share: one destination, different sources."""
    parts = table(spark, sf_dir, "part")
    return parts.groupBy("p_type").agg(F.countDistinct("p_brand").alias("sources")).where("sources > 1")


# --- identifiers, names and text -------------------------------------------------------------------


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ident = sc.stable_id(F.col("source"), F.col("lang"), F.col("doc_id"))
    return rounded(docs.select("doc_id", ident.alias("stable_id"), sc.unit_hash(F.lit("seed"), ident).alias("u"), sc.slug(F.concat(F.col("source"), F.lit(" / "), F.col("lang"))).alias("slug")))


def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    group = cu.split_group(F.lit(None).cast("string"), F.col("text"), F.col("doc_id").cast("string"))
    return docs.select("doc_id", group.alias("grp")).withColumn("split", cu.split(F.col("grp"), train=0.8, validation=0.1))


def prompt_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of a conversation's user turns: normalised, distinct in turn order, the first usable one."""
    turns = table(spark, sf_dir, "conversations").where("role = 'user'")
    tasks = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.concat(F.lit("  "), F.col("text"), F.lit(" \n ")).alias("x")))).alias("t")).select("conv_id", F.col("t.x").alias("tasks"))
    made = sc.prompts(F.concat("tasks", "tasks"))
    return tasks.select("conv_id", F.size(made["prompts"]).cast("bigint").alias("n_prompts"), made["primary_prompt"].alias("primary_prompt"), made["usable"].alias("usable"))


def dedupe_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("fp"))
    return cu.first_wins(docs, "fp", ["doc_id"], "doc_id").select("doc_id", "duplicate_of", F.col("dedupe_status").alias("status"))


_NAMES = (
    ("left_arm_joint_1_rad", "observation.state"), ("left_gripper_open", "observation.state"), ("right_arm_joint_3_rad", "action"), ("head_left_camera", "camera"), ("base_velocity_x", "action"),
    ("left_joint_0", "state/left_joint_position"), ("right_arm_2", "joint_states"), ("left_eef_pos_x", "observation.state"), ("right_tcp_rotvec_z", "observation.state"), ("chassis_twist_angular_z", "a"),
    ("torso_2", "x"), ("head_position_1", "x"), ("waist_twist_linear_y", "x"), ("pitch", "robot.waist"), ("patch", "robot.head"), ("arm_right_position_4", "x"), ("unknown_thing", "x"), ("left_gripper", "state/effector_position"),
)


def canonical_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of feature names of every nation's robot; two features for one slot collide."""
    names = spark.createDataFrame([(i, n, k) for i, (n, k) in enumerate(_NAMES)], "ordinal int, name string, key string")
    robots = table(spark, sf_dir, "nation").select("n_nationkey")
    slots = robots.crossJoin(F.broadcast(sc.with_canonical_slot(names, "name", F.lit("state"), "key", "m")))
    kept = cu.mapping_with_collisions(slots.withColumn("slot", F.col("m.slot")), ["n_nationkey"], "slot", ["ordinal"])
    return kept.select("n_nationkey", "name", "slot", F.col("m.semantic").alias("semantic"), F.col("m.confidence").alias("confidence"), "kept")


_SLOTS = (
    (14, "left_joint_1", "high", True), (6, "left_gripper", "high", True), (23, "right_joint_3", "high", True), (None, None, None, False), (52, "mobile_base", "high", True), (14, "left_joint_1", "high", False),
    (23, "right_joint_3", "high", False), (0, "left_ee_position_x", "medium", True), (12, "right_ee_rotation_vector_z", "medium", True), (57, "mobile_base_angular_z", "high", True), (59, "torso_head", "high", True),
    (59, "torso_head_position_1", "high", False), (59, "torso_head_linear_y", "high", False), (58, "waist_pitch", "high", True), (61, "head_pitch", "high", True), (25, "right_joint_5", "high", True), (None, None, None, False),
    (6, "left_gripper", "high", False),
)


def camera_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of camera keys made from part names and fixed words."""
    words = ("left_wrist", "hand right", "head_right", "front", "chest", "nothing")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("p_partkey") % len(words) + 1).cast("int")).alias("w"))
    role = sc.camera_role(F.concat(F.lit("obs."), F.col("w")))
    rank = F.row_number().over(Window.partitionBy("grp", "role").orderBy("p_partkey"))
    out = parts.withColumn("role", role).withColumn("grp", F.floor(F.col("p_partkey") / 10).cast("bigint")).withColumn("r", rank)
    return out.select("p_partkey", "role", F.when(F.col("r") == 1, F.col("role")).otherwise(F.concat("role", F.lit("_"), F.col("r"))).alias("slot"))


def profile_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = spark.createDataFrame([("src0", 2.0, None), ("src1", None, "strict"), ("src2", 0.0, "loose")], "source string, mixture double, policy string")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    out = cu.resolve_profiles(docs, profiles, "source", {"mixture": 1.0, "policy": "default"})
    return rounded(out.withColumn("weight", cu.sample_weight(F.col("mixture"), F.lit("B"), F.lit(0.5))))


# --- scores and admission ---------------------------------------------------------------------------


def quality_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as episodes: component scores, tier, admission mode and weight from labels and lengths."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    both = docs.join(labels, "doc_id", "left")
    status = F.when(F.col("quality") == 1, "passed").when(F.col("quality") == 0, "failed").otherwise("pending")
    score = cu.component_score({"integrity": cu.stage_score(status), "temporal": F.when(F.col("n_chars") > 500, F.lit(1.0)).otherwise(F.lit(0.65)), "language": F.when(F.col("lang") == "en", F.lit(1.2)), "novelty": F.lit(0.2)})
    frames = F.floor(F.col("n_chars") / 10).cast("bigint")
    t = cu.tiers(F.coalesce(F.col("toxic") == 1, F.lit(False)), F.col("n_chars") > 50, frames >= 81, F.lit(True), F.col("lang") != "de", F.col("quality").isNotNull(), F.col("source") != "src1")
    seconds = cu.duration(F.lit(None).cast("double"), F.when(F.col("doc_id") % 2 == 0, frames / 25.0), frames, F.lit(0.0), F.lit(20.0))
    codes = cu.reasons((F.col("toxic") == 1, "toxic"), (frames < 81, "shorter_than_window"), (F.col("quality").isNull(), "unverified"), (F.col("quality").isNull(), "unverified"))
    out = both.select("doc_id", score.alias("score"), *[c.alias(k) for k, c in t.items()], seconds.alias("seconds"), F.array_join(codes, ",").alias("reasons"))
    out = out.withColumn("mode", cu.admission_mode(F.col("tier"), F.col("video_eligible"), F.col("action_eligible"), F.col("seconds")))
    return rounded(out.withColumn("weight", cu.sample_weight(F.lit(1.0), F.col("tier"), F.col("score"))))


def tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_admission(spark, sf_dir).groupBy("tier", "mode").agg(F.count(F.lit(1)).alias("episodes"), F.count_if("action_eligible").alias("action_eligible"))


def camera_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as cameras, return flags and line statuses as roles: one slot a role, back-filled."""
    roles = ["global_primary", "global_secondary", "left_wrist", "right_wrist", "auxiliary"]
    items = _cameras(spark, sf_dir, roles)
    order = [F.col("pixels").desc(), F.col("fps").desc(), F.col("l_linenumber").desc(), F.col("l_partkey").desc()]
    return rounded(cu.ranked_slots(items, ["l_orderkey"], "role", order, roles).select("l_orderkey", "l_linenumber", "l_partkey", "slot"))


def _cameras(spark: SparkSession, sf_dir: str, roles: list[str]) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", F.col("l_quantity").alias("pixels"), F.col("l_tax").alias("fps")).distinct()
    return lines.withColumn("role", F.element_at(F.array(*[F.lit(r) for r in roles]), (F.col("l_partkey") % len(roles) + 1).cast("int")))


def audit_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _cameras(spark, sf_dir, ["a", "b", "c"])
    return cu.top_by_role(items, ["l_orderkey"], "role", [F.col("pixels").desc(), F.col("l_linenumber"), F.col("l_partkey")], 3).select("l_orderkey", "l_linenumber", "l_partkey", "role", "rank")


# --- vectors ------------------------------------------------------------------------------------------


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("bigint").alias("label"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))


def vector_dim_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.column_stats(_vectors(spark, sf_dir), ["label"], "v"), 5)


def vector_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four source dimensions and a missing one scattered into slots 14, 6, 0, 79 and 20 of 80."""
    slots, mask = cu.scatter(table(spark, sf_dir, "embeddings"), [(0, 14), (1, 6), (2, 0), (63, 79), (64, 20)], "embedding")
    out = table(spark, sf_dir, "embeddings").select("vec_id", slots.alias("s"), mask.alias("m"))
    picked = [F.get("s", F.lit(k)).cast("double").alias(f"slot_{k}") for k in (0, 6, 14, 20, 79)]
    return rounded(out.select("vec_id", *picked, F.size("s").cast("bigint").alias("width"), F.size(F.filter("m", lambda x: x)).cast("bigint").alias("valid")), 5)


def rotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding dimensions as roll, pitch and yaw and as quaternions; relative poses to the first vector of a label."""
    rows = _vectors(spark, sf_dir)
    e = lambda k: F.get("v", F.lit(k))
    a, b = sc.rpy_to_rotvec(e(0) * 3, e(1) * 3, e(2) * 3), sc.quaternion_to_rotvec(e(3), e(4), e(5), e(6))
    base = rows.groupBy("label").agg(F.min_by("v", "vec_id").alias("base"))
    rel = sc.relative_pose([e(k) for k in range(7, 14)], [F.get("base", F.lit(k)) for k in range(7, 14)])
    out = rows.join(base, "label").select("vec_id", a.alias("a"), b.alias("b"), rel.alias("r"))
    return rounded(out.select("vec_id", *[F.get("a", F.lit(k)).alias(f"rpy_{k}") for k in range(3)], *[F.get("b", F.lit(k)).alias(f"quat_{k}") for k in range(3)], F.get("r", F.lit(0)).alias("rel_x"), F.get("r", F.lit(6)).alias("rel_w")), 5)


def quaternion_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir).select("label", F.col("vec_id").alias("idx"), *[F.get("v", F.lit(k)).alias(n) for k, n in enumerate(("qx", "qy", "qz", "qw"))])
    return rounded(signals.quaternion_continuity(rows, ["label"]).select("label", "idx", "sign", "angle", "rapid", "norm_error"), 5)


def action_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions 0..31 against 32..63 of each vector as truth and guess, by label."""
    each = _vectors(spark, sf_dir).select("vec_id", "label", F.posexplode("v").alias("dim", "x"))
    step = F.col("vec_id") * 32 + F.col("dim") % 32
    truth, guess = each.where("dim < 32").select("label", step.alias("step"), "x"), each.where("dim >= 32").select("label", step.alias("step"), "x")
    return rounded(rp.pair_errors(truth, guess, ["label"], "step", "x"), 5)


def masked_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    error = (F.col("l_discount") - F.col("l_tax")) * (F.col("l_discount") - F.col("l_tax"))
    return rounded(lines.groupBy("l_returnflag").agg(rp.weighted_mean(error, (F.col("l_quantity") > 25).cast("double")).alias("loss")))


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    gray = F.transform("embedding", lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor((x.cast("double") + 0.5) * 255).cast("int"))))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("bigint").alias("label"), gray.alias("p"))


def frame_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = rp.luma_metrics(F.col("p"), dark=60, bright=190)
    out = _frames(spark, sf_dir).select("vec_id", *[x.alias(k) for k, x in m.items()], rp.laplacian_variance(F.col("p"), 8, 8).alias("laplacian_variance"), rp.hash_text(rp.difference_hash(F.col("p"), 8, 8)).alias("dhash"), rp.hash_text(rp.difference_hash(F.col("p"), 16, 4)).alias("dhash_wide"))
    return rounded(out)


def freeze_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _frames(spark, sf_dir).withColumn("code", rp.difference_hash(F.col("p"), 8, 8))
    return rounded(rp.frozen_pairs(rows, ["label"], "vec_id", "p", "code", difference=0.2, distance=28))


# --- reports and samples -------------------------------------------------------------------------------


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return rounded(rp.leaderboard(orders.withColumn("score", F.col("o_totalprice") / 1000.0), "o_orderpriority", "o_orderstatus", "score"), 4)


def best_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as checkpoints: gates on quantity and discount, gain from price and tax."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("step"), (F.col("l_quantity") > 30).alias("passed"), "l_extendedprice", "l_tax").distinct()
    return rounded(rp.best_checkpoint(lines, "passed", F.col("l_extendedprice") / 1000 + 10 * F.col("l_tax"), "step", ["l_orderkey"]).select("l_orderkey", "step", "passed", "gain"))


def balanced_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp.balanced_sample(table(spark, sf_dir, "events"), "event_type", "event_id", 1003, "seed")


def worker_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey").distinct()
    return rp.round_robin(rows, ["o_orderkey"], 4).select("o_orderkey", F.col("worker").cast("bigint").alias("worker"))


def quantile_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketched quantiles, and whether each lies between the exact ones a thousandth of the ranks to either side."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", F.array("l_extendedprice", "l_quantity").alias("v"))
    sketch = stats.column_stats(lines, ["l_returnflag"], "v", approximate=True)
    exact = lines.select("l_returnflag", F.posexplode("v").alias("dim", "x")).groupBy("l_returnflag", "dim").agg(F.percentile("x", F.array(*[F.lit(q) for q in (0.009, 0.011, 0.989, 0.991)])).alias("e"))
    inside = lambda q, i: F.col(q).between(F.floor(F.get("e", F.lit(i))), F.ceil(F.get("e", F.lit(i + 1))))
    return sketch.join(exact, ["l_returnflag", "dim"]).select("l_returnflag", "dim", "count", inside("q01", 0).alias("q01_near"), inside("q99", 2).alias("q99_near"))


QUERIES = {
    f.__name__: f
    for f in (
        frame_contiguity, missing_parts, compact_ranges, interval_coalesce, valid_index_intersection, status_rollup, missing_and_mismatch, destination_conflicts, stable_ids, split_assign, prompt_normalize, dedupe_first_wins,
        canonical_mapping, camera_roles, profile_resolve, quality_admission, tier_counts, camera_slots, audit_top3, vector_dim_stats, vector_scatter, rotations, quaternion_continuity, action_metrics, masked_loss, frame_metrics,
        freeze_pairs, leaderboard, best_checkpoint, balanced_sample, worker_shares, quantile_approx,
    )
}

_U = "CAST(('0x' || substr({0}, 1, 16))::UBIGINT AS DOUBLE) / 18446744073709551616.0"
_ID = "substr(sha256(coalesce(source, 'None') || chr(31) || coalesce(lang, 'None') || chr(31) || coalesce(doc_id::VARCHAR, 'None')), 1, 24)"
_VEC = "v AS (SELECT vec_id, label::BIGINT AS label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), each AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS dim FROM v)"
_GRAY = "g AS (SELECT vec_id, label::BIGINT AS label, list_transform(embedding, lambda x: least(255, greatest(0, floor((x::DOUBLE + 0.5) * 255)::INT))) AS p FROM embeddings)"
_PLACE = "round_even((k // 8) * ({h} - 1) / 7.0, 0)::INT * {w} + round_even((k % 8 + {o}) * ({w} - 1) / 8.0, 0)::INT + 1"


def _dhash(w: int, h: int) -> str:
    """The difference hash in SQL: bits by list, as one unsigned number."""
    left, right = (_PLACE.format(w=w, h=h, o=o) for o in (0, 1))
    return f"list_sum(list_transform(range(0, 64), lambda k: CASE WHEN p[{left}] > p[{right}] THEN (1::UBIGINT << (63 - k)::UBIGINT) ELSE 0::UBIGINT END))::UBIGINT"
_QUALITY = """q AS (SELECT doc_id, n_chars, lang, source, quality, toxic, (n_chars // 10) AS fr,
 (0.25 * (CASE WHEN quality = 1 THEN 1.0 WHEN quality = 0 THEN 0.0 ELSE 0.5 END) + 0.2 * (CASE WHEN n_chars > 500 THEN 1.0 ELSE 0.65 END) + CASE WHEN lang = 'en' THEN 0.1 ELSE 0 END + 0.05 * 0.2)::DOUBLE
 / (0.25 + 0.2 + CASE WHEN lang = 'en' THEN 0.1 ELSE 0 END + 0.05)::DOUBLE AS score, coalesce(toxic = 1, false) AS failed FROM documents LEFT JOIN labels USING (doc_id)),
t AS (SELECT *, n_chars > 50 AND NOT failed AS ve, n_chars > 50 AND NOT failed AND fr >= 81 AND lang <> 'de' AND quality IS NOT NULL AND source <> 'src1' AS ae, CASE WHEN doc_id % 2 = 0 THEN fr / 25.0 ELSE greatest(0.0, (fr - 1) / 20.0) END::DOUBLE AS seconds FROM q),
r AS (SELECT doc_id, round(score, 6) AS score, ve AS video_eligible, ae AS action_eligible, CASE WHEN failed THEN 'C' WHEN ae THEN 'A' ELSE 'B' END AS tier, CASE WHEN failed THEN 'C' WHEN ae OR (lang <> 'de' AND fr >= 81) THEN 'A' ELSE 'B' END AS candidate_tier, round(seconds, 6) AS seconds,
 array_to_string(list_filter([CASE WHEN fr < 81 THEN 'shorter_than_window' END, CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN quality IS NULL THEN 'unverified' END], lambda x: x IS NOT NULL), ',') AS reasons,
 CASE WHEN failed OR NOT ve OR seconds + 1e-8 < 4.0 THEN 'reject' WHEN ae THEN 'joint_video_action' ELSE 'video_only' END AS mode, round(CASE WHEN failed THEN 0 WHEN ae THEN score ELSE 0.5 * score END, 6) AS weight FROM t)"""
_LINES = "n AS (SELECT DISTINCT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem)"


def _cam_sql(roles: list[str]) -> str:
    return f"c AS (SELECT DISTINCT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_quantity AS pixels, l_tax AS fps, {roles!r}[l_partkey % {len(roles)} + 1] AS role FROM lineitem)"


ORACLE_SQL = {
    "frame_contiguity": f"WITH {_LINES}, s AS (SELECT l_orderkey, l_linenumber - lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS d FROM n) SELECT l_orderkey, coalesce(bool_and(d = 1), true) AS contiguous, coalesce(bool_and(d > 0), true) AS strictly_increasing FROM s GROUP BY 1",
    "missing_parts": f"WITH {_LINES}, g AS (SELECT l_orderkey, list(l_linenumber) AS have, min(l_linenumber) AS a, max(l_linenumber) AS b FROM n GROUP BY 1) SELECT l_orderkey, array_to_string(list_filter(range(a, b + 1), lambda x: NOT list_contains(have, x)), ',') AS missing FROM g",
    "compact_ranges": f"WITH {_LINES}, r AS (SELECT l_orderkey, l_linenumber AS s, l_linenumber - row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS g FROM n) SELECT l_orderkey, min(s) AS start, max(s) + 1 AS stop, 1::BIGINT AS stride, count(*) AS count FROM r GROUP BY l_orderkey, g",
    "interval_coalesce": """WITH s AS (SELECT user_id, event_type, epoch_us(ts) // 86400000000 AS start, epoch_us(ts) // 86400000000 + 1 + coalesce((props->>'$.k')::BIGINT, 0) % 3 AS stop FROM events),
f AS (SELECT *, CASE WHEN start <= max(stop) OVER (PARTITION BY user_id, event_type ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM s),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id, event_type ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS g FROM f) SELECT user_id, event_type, min(start) AS start, max(stop) AS stop FROM g GROUP BY user_id, event_type, g""",
    "valid_index_intersection": "SELECT l_orderkey AS idx FROM lineitem INTERSECT SELECT o_orderkey FROM orders INTERSECT SELECT o_orderkey FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) / 2 FROM orders)",
    "status_rollup": """WITH m AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN 'ok' WHEN o_orderkey % 7 = 0 THEN 'running' ELSE 'error' END AS said, CASE WHEN o_orderkey % 5 = 0 THEN 'old' ELSE o_orderstatus END AS rev FROM orders WHERE o_orderkey % 3 <> 0),
h AS (SELECT l_orderkey AS o_orderkey, count(*) FILTER (WHERE l_quantity > 48) AS unfinished FROM lineitem WHERE l_orderkey % 13 <> 0 GROUP BY 1),
s AS (SELECT o_orderpriority, CASE WHEN unfinished IS NULL THEN 'missing' WHEN said = 'ok' AND rev = o_orderstatus THEN 'complete' WHEN unfinished > 0 THEN 'partial' WHEN said NOT IN ('ok', 'running') THEN 'failed' WHEN said = 'running' THEN 'interrupted_or_running'
 ELSE 'present_untracked' END AS status FROM orders LEFT JOIN m USING (o_orderkey) LEFT JOIN h USING (o_orderkey))
SELECT o_orderpriority, status, count(*) AS count FROM s GROUP BY ROLLUP (o_orderpriority, status)""",
    "missing_and_mismatch": "SELECT c_custkey AS file, 'missing' AS problem FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT c_custkey, 'size' FROM customer JOIN supplier ON c_custkey = s_suppkey WHERE c_nationkey <> s_nationkey",
    "destination_conflicts": "SELECT p_type, count(DISTINCT p_brand) AS sources FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1",
    "stable_ids": f"WITH i AS (SELECT doc_id, {_ID} AS stable_id, regexp_replace(regexp_replace(lower(source || ' / ' || lang), '[^a-z0-9._-]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM documents) SELECT doc_id, stable_id, round({_U.format('sha256(%sseed%s || chr(31) || stable_id)' % (chr(39), chr(39)))}, 6) AS u, slug FROM i",
    "split_assign": f"WITH i AS (SELECT doc_id, substr(sha256(sha256(text)), 1, 24) AS grp FROM documents), u AS (SELECT *, {_U.format('sha256(%sepisodes-v1%s || chr(31) || grp)' % (chr(39), chr(39)))} AS u FROM i) SELECT doc_id, grp, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.8 + 0.1 THEN 'validation' ELSE 'test' END AS split FROM u",
    "prompt_normalize": r"""WITH t AS (SELECT conv_id, turn, trim(regexp_replace('  ' || text || ' ' || chr(10) || ' ', '\s+', ' ', 'g')) AS x FROM conversations WHERE role = 'user'), d AS (SELECT conv_id, x, min(turn) AS f FROM t WHERE x <> '' GROUP BY 1, 2)
SELECT c.conv_id, count(x) AS n_prompts, arg_min(x, f) FILTER (WHERE length(x) >= 2) AS primary_prompt, coalesce(bool_or(length(x) >= 2), false) AS usable FROM (SELECT DISTINCT conv_id FROM t) c LEFT JOIN d USING (conv_id) GROUP BY 1""",
    "dedupe_first_wins": "WITH f AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS first FROM documents) SELECT doc_id, CASE WHEN first <> doc_id THEN first END AS duplicate_of, CASE WHEN first = doc_id THEN 'unique' ELSE 'duplicate' END AS status FROM f",
    "canonical_mapping": "WITH m(name, key, slot, semantic, confidence, kept) AS (VALUES " + ", ".join("(" + ", ".join("NULL" if x is None else ("true" if x is True else "false" if x is False else str(x) if isinstance(x, int) else f"'{x}'") for x in (*a, *b)) + ")" for a, b in zip(_NAMES, _SLOTS, strict=True)) + ") SELECT n_nationkey, name, slot::INT AS slot, semantic, confidence, kept FROM nation CROSS JOIN m",
    "camera_roles": """WITH r AS (SELECT p_partkey, p_partkey // 10 AS grp, ['left_wrist', 'right_wrist', 'global_secondary', 'global_primary', 'auxiliary', 'auxiliary'][p_partkey % 6 + 1] AS role FROM part),
k AS (SELECT *, row_number() OVER (PARTITION BY grp, role ORDER BY p_partkey) AS r FROM r) SELECT p_partkey, role, CASE WHEN r = 1 THEN role ELSE role || '_' || r END AS slot FROM k""",
    "profile_resolve": """WITH p(source, mixture, policy) AS (VALUES ('src0', 2.0, NULL), ('src1', NULL, 'strict'), ('src2', 0.0, 'loose'))
SELECT doc_id, source, coalesce(mixture, 1.0)::DOUBLE AS mixture, coalesce(policy, 'default') AS policy, (coalesce(nullif(coalesce(mixture, 1.0), 0), 1.0) * 0.5 * 0.5)::DOUBLE AS weight FROM documents LEFT JOIN p USING (source)""",
    "quality_admission": f"WITH {_QUALITY} SELECT * FROM r",
    "tier_counts": f"WITH {_QUALITY} SELECT tier, mode, count(*) AS episodes, count(*) FILTER (WHERE action_eligible) AS action_eligible FROM r GROUP BY 1, 2",
    "camera_slots": f"""WITH {_cam_sql(['global_primary', 'global_secondary', 'left_wrist', 'right_wrist', 'auxiliary'])},
k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, role ORDER BY pixels DESC, fps DESC, l_linenumber DESC, l_partkey DESC) AS r FROM c),
a AS (SELECT *, role AS slot FROM k WHERE r = 1), s AS (SELECT k.*, 'global_secondary' AS slot FROM k WHERE role = 'global_primary' AND r = 2 AND NOT EXISTS (SELECT 1 FROM a WHERE a.l_orderkey = k.l_orderkey AND a.slot = 'global_secondary')),
l AS (SELECT k.* FROM k WHERE r > 1 AND NOT EXISTS (SELECT 1 FROM s WHERE s.l_orderkey = k.l_orderkey AND s.role = k.role AND s.r = k.r) AND NOT EXISTS (SELECT 1 FROM a WHERE a.l_orderkey = k.l_orderkey AND a.slot = 'auxiliary')),
o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY pixels DESC, fps DESC, l_linenumber DESC, l_partkey DESC) AS o FROM l)
SELECT l_orderkey, l_linenumber, l_partkey, slot FROM a UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, slot FROM s UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'auxiliary' FROM o WHERE o = 1""",
    "audit_top3": f"""WITH {_cam_sql(['a', 'b', 'c'])}, k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, role ORDER BY pixels DESC, l_linenumber, l_partkey) AS r FROM c),
p AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY (r > 1)::INT, pixels DESC, l_linenumber, l_partkey) AS rank FROM k) SELECT l_orderkey, l_linenumber, l_partkey, role, rank FROM p WHERE rank <= 3""",
    "vector_dim_stats": f"WITH {_VEC} SELECT label, dim::INT AS dim, count(x) AS count, round(avg(x), 5) AS mean, round(stddev_pop(x), 5) AS std, round(min(x), 5) AS min, round(max(x), 5) AS max, round(quantile_cont(x, 0.01), 5) AS q01, round(quantile_cont(x, 0.99), 5) AS q99 FROM each GROUP BY 1, 2",
    "vector_scatter": "SELECT vec_id, round(embedding[3]::DOUBLE, 5) AS slot_0, round(embedding[2]::DOUBLE, 5) AS slot_6, round(embedding[1]::DOUBLE, 5) AS slot_14, 0.0::DOUBLE AS slot_20, round(embedding[64]::DOUBLE, 5) AS slot_79, 80::BIGINT AS width, 4::BIGINT AS valid FROM embeddings",
    "quantile_approx": "SELECT l_returnflag, unnest([0, 1])::INT AS dim, count(*) AS count, true AS q01_near, true AS q99_near FROM lineitem GROUP BY l_returnflag",
    "rotations": f"""WITH {_VEC}, h AS (SELECT *, v[1] * 1.5 AS r, v[2] * 1.5 AS p, v[3] * 1.5 AS y, first_value(v) OVER (PARTITION BY label ORDER BY vec_id) AS b, sqrt(v[4] ** 2 + v[5] ** 2 + v[6] ** 2 + v[7] ** 2) AS n FROM v),
q AS (SELECT *, sin(r) * cos(p) * cos(y) - cos(r) * sin(p) * sin(y) AS qx, cos(r) * sin(p) * cos(y) + sin(r) * cos(p) * sin(y) AS qy, cos(r) * cos(p) * sin(y) - sin(r) * sin(p) * cos(y) AS qz, cos(r) * cos(p) * cos(y) + sin(r) * sin(p) * sin(y) AS qw FROM h),
k AS (SELECT *, sqrt(qx * qx + qy * qy + qz * qz) AS l1, sqrt(v[4] ** 2 + v[5] ** 2 + v[6] ** 2) / n AS l2 FROM q),
w AS (SELECT *, 2 * atan2(l1, qw) AS a1, 2 * atan2(l2, v[7] / n) AS a2 FROM k),
z AS (SELECT *, CASE WHEN l1 <= 1e-12 THEN 0 ELSE (CASE WHEN a1 > pi() THEN a1 - 2 * pi() ELSE a1 END) / l1 END AS s1, CASE WHEN l2 <= 1e-12 THEN 0 ELSE (CASE WHEN a2 > pi() THEN a2 - 2 * pi() ELSE a2 END) / l2 END AS s2 FROM w)
SELECT vec_id, round(qx * s1, 5) AS rpy_0, round(qy * s1, 5) AS rpy_1, round(qz * s1, 5) AS rpy_2, round(v[4] / n * s2, 5) AS quat_0, round(v[5] / n * s2, 5) AS quat_1, round(v[6] / n * s2, 5) AS quat_2, round(v[8] - b[8], 5) AS rel_x,
 round(b[14] * v[14] + b[11] * v[11] + b[12] * v[12] + b[13] * v[13], 5) AS rel_w FROM z""",
    "quaternion_continuity": f"""WITH {_VEC}, n AS (SELECT label, vec_id AS idx, sqrt(v[1] ** 2 + v[2] ** 2 + v[3] ** 2 + v[4] ** 2) AS n, v FROM v),
d AS (SELECT *, (v[1] * lag(v[1]) OVER w + v[2] * lag(v[2]) OVER w + v[3] * lag(v[3]) OVER w + v[4] * lag(v[4]) OVER w) / (n * lag(n) OVER w) AS dot FROM n WINDOW w AS (PARTITION BY label ORDER BY idx)),
s AS (SELECT *, sum(CASE WHEN dot < 0 THEN 1 ELSE 0 END) OVER (PARTITION BY label ORDER BY idx ROWS UNBOUNDED PRECEDING) % 2 AS odd FROM d)
SELECT label, idx, CASE WHEN odd = 1 THEN -1 ELSE 1 END AS sign, round(2 * acos(least(1.0, abs(dot))), 5) AS angle, coalesce(2 * acos(least(1.0, abs(dot))) > 1.5, false) AS rapid, abs(n - 1) > 0.05 AS norm_error FROM s""",
    "action_metrics": f"""WITH {_VEC}, p AS (SELECT a.label, a.x - b.x AS d FROM each a JOIN each b ON a.vec_id = b.vec_id AND b.dim = a.dim + 32 WHERE a.dim < 32), m AS (SELECT label, count(*) AS n, avg(abs(d)) AS mae, avg(d * d) AS mse FROM p GROUP BY 1)
SELECT label, n, round(mae, 5) AS mae, round(mse, 5) AS mse, round(sqrt(mse), 5) AS rmse, round(10 * log10(1 / mse), 5) AS psnr FROM m""",
    "masked_loss": "SELECT l_returnflag, round(sum((l_discount - l_tax) ** 2 * (l_quantity > 25)::INT) / greatest(sum((l_quantity > 25)::INT), 1), 6) AS loss FROM lineitem GROUP BY 1",
    "frame_metrics": f"""WITH {_GRAY}, b AS (SELECT *, list_transform(range(0, 16), lambda b: len(list_filter(p, lambda x: x // 16 = b)) / 64.0) AS h, list_transform(range(0, 36), lambda k: (k // 6 + 1) * 8 + k % 6 + 2) AS c FROM g),
l AS (SELECT *, list_transform(c, lambda i: (p[i - 1] + p[i + 1] + p[i - 8] + p[i + 8] - 4 * p[i])::DOUBLE) AS lap FROM b)
SELECT vec_id, round(list_sum(p) / 64.0, 6) AS mean_luma, round(len(list_filter(p, lambda x: x <= 60)) / 64.0, 6) AS dark_ratio, round(len(list_filter(p, lambda x: x >= 190)) / 64.0, 6) AS bright_ratio,
 round(-list_sum(list_transform(h, lambda q: CASE WHEN q > 0 THEN q * log2(q) ELSE 0 END)) / 4.0, 6) AS entropy, round((list_sum(list_transform(lap, lambda x: x * x)) / 36 - (list_sum(lap) / 36) ** 2) / 65025.0, 6) AS laplacian_variance, lpad(lower(to_hex({_dhash(8, 8)})), 16, '0') AS dhash, lpad(lower(to_hex({_dhash(16, 4)})), 16, '0') AS dhash_wide FROM l""",
    "freeze_pairs": f"""WITH {_GRAY}, c AS (SELECT label, vec_id, p, {_dhash(8, 8)} AS code FROM g), o AS (SELECT *, lag(p) OVER w AS q, lag(code) OVER w AS d FROM c WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
m AS (SELECT label, vec_id, list_sum(list_transform(range(1, 65), lambda i: abs(p[i] - q[i]))) / 64.0 / 255.0 AS mad, bit_count(xor(code, d))::BIGINT AS hamming FROM o WHERE q IS NOT NULL) SELECT label, vec_id, round(mad, 6) AS mad, hamming, mad <= 0.2 AND hamming <= 28 AS frozen FROM m""",
    "leaderboard": "SELECT o_orderpriority, o_orderstatus, round(avg(o_totalprice / 1000.0), 4) AS score, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderpriority, o_orderstatus), (o_orderstatus))",
    "best_checkpoint": """WITH l AS (SELECT DISTINCT l_orderkey, l_partkey * 10 + l_linenumber AS step, l_quantity > 30 AS passed, l_extendedprice, l_tax FROM lineitem), g AS (SELECT *, l_extendedprice / 1000 + 10 * l_tax AS gain FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY passed DESC, gain DESC, step DESC) AS r FROM g) SELECT l_orderkey, step, passed, round(gain, 6) AS gain FROM r WHERE r = 1""",
    "balanced_sample": f"""WITH g AS (SELECT event_type, count(*) AS size FROM events GROUP BY 1), q AS (SELECT *, 1003 // (SELECT count(*) FROM g) + CASE WHEN row_number() OVER (ORDER BY {_U.format("sha256('seed' || chr(31) || 'group' || chr(31) || event_type)")}, event_type) <= 1003 % (SELECT count(*) FROM g) THEN 1 ELSE 0 END AS quota FROM g),
r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY {_U.format("sha256('seed' || chr(31) || event_type || chr(31) || event_id)")}, event_id) - 1 AS rank FROM events)
SELECT event_type, event_id, rank + turn * size AS draw FROM (SELECT r.*, size, unnest(range(0, (quota - 1 - rank) // size + 1)) AS turn FROM r JOIN q USING (event_type) WHERE rank < quota)""",
    "worker_shares": "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) % 4 AS worker FROM (SELECT DISTINCT o_orderkey FROM orders)",
}
