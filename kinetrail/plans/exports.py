"""Registered queries of export, schedule, case and gate operators: orders are episodes, their lines segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinetrail.operators import exports as ex
from kinetrail.plans.base import rounded, table

LONG = "bigint"


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("episode_id"), F.col("l_linenumber").cast(LONG).alias("ordinal"), (F.col("l_linenumber") * 10).cast(LONG).alias("start"), F.col("l_quantity").cast(LONG).alias("q"), F.col("l_returnflag").alias("text")).distinct()
    one = lines.groupBy("episode_id", "ordinal", "start").agg(F.min("q").alias("q"), F.min("text").alias("text"))
    return one.withColumn("stop", F.col("start") + F.col("q") % 14).withColumn("n", F.lit(70).cast(LONG)).drop("q")


_SEGMENTS = "seg AS (SELECT l_orderkey AS episode_id, l_linenumber::BIGINT AS ordinal, l_linenumber::BIGINT * 10 AS start, l_linenumber::BIGINT * 10 + min(l_quantity::BIGINT) % 14 AS stop, min(l_returnflag) AS text, 70::BIGINT AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"


def segment_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.segment_problems(_segments(spark, sf_dir))


def latent_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = ex.latent_jobs(_segments(spark, sf_dir).where("stop > start"), ["head", "left", "right"], 2)
    return jobs.select("episode_id", "ordinal", "camera", F.array_join("frame_ids", ",").alias("frame_ids"))


def job_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = ex.latent_jobs(_segments(spark, sf_dir).where("stop > start"), ["head", "left"], 2)
    done = jobs.where("(episode_id + ordinal) % 3 <> 0 OR camera = 'head'").select("episode_id", "ordinal", "camera")
    return ex.job_coverage(jobs, done, ["episode_id", "ordinal", "camera"], "episode_id")


def segment_stab(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = _segments(spark, sf_dir).withColumn("name", F.concat("text", F.lit("_"), F.col("ordinal")))
    points = segments.select("episode_id").distinct().withColumn("x", F.explode(F.sequence(F.lit(5).cast(LONG), F.lit(65).cast(LONG), F.lit(6).cast(LONG))))
    return ex.stab(points, segments.select("episode_id", "start", "stop", "name"), "episode_id", "x", "name")


def chunk_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 7).alias("chunks"), (F.col("o_custkey") % 11).alias("start_frame")).distinct()
    out = ex.chunk_schedule(orders, "chunks", 3)
    return out.withColumn("decoded", ex.decoded_frames(F.col("chunks")))


def case_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as training cases with flaws here and there: failure codes of each."""
    k = F.col("o_orderkey")
    cases = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(k % 7 == 0, 30.0).otherwise(20.0).alias("target_fps"),
        F.when(k % 5 == 0, 80).otherwise(81).alias("state_steps"),
        F.when(k % 11 == 0, None).otherwise(80).alias("action_steps"),
        F.array_repeat(F.lit(True), 80).alias("state_slot_mask"),
        F.array_repeat(F.lit(True), F.when(k % 13 == 0, 79).otherwise(80).cast("int")).alias("action_slot_mask"),
        F.array_repeat(k % 3 == 0, 5).alias("camera_mask"),
        F.sequence(F.lit(0), F.when(k % 19 == 0, 76).otherwise(80), F.lit(4)).alias("video_offsets"),
        F.sequence(F.when(k % 23 == 0, 1).otherwise(0), F.when(k % 23 == 0, 5).otherwise(4)).alias("camera_indices"),
        F.array(F.lit("global_primary"), F.lit("global_secondary"), F.lit("left_wrist"), F.when(k % 29 == 0, "wrist").otherwise("right_wrist"), F.lit("auxiliary")).alias("camera_roles"),
        F.when(k % 17 == 0, "").otherwise("uri").alias("canonical_uri"),
        (k % 4).alias("start_count"),
        F.when(k % 2 == 0, "joint_video_action").otherwise("video_only").alias("mode"),
        (k % 6 < 3).alias("action_loss"),
    )
    return ex.case_failures(cases).select("o_orderkey", F.array_join("failures", ",").alias("failures"))


def case_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("case_id"), (F.col("c_custkey") % 5).alias("start"), F.lit(40).cast(LONG).alias("stride"), (F.col("c_custkey") % 5 + 40 * (F.col("c_custkey") % 3 + 1)).alias("stop"))
    out = ex.expand_cases(cases)
    return out.withColumn("video_frames", F.array_join("video_frames", ","))


def report_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as evaluation steps, counted from its first line."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("q"), F.min("l_discount").alias("d"), F.min("l_tax").alias("t"), F.min("l_returnflag").alias("f"))
    step = F.col("l_linenumber") - F.min("l_linenumber").over(Window.partitionBy("l_orderkey"))
    records = lines.select(F.col("l_orderkey").alias("run"), step.alias("step"), F.ascii("f").alias("sample_index"), F.when(F.col("q") > 5, F.col("q").cast("int") % 2).alias("window_start"), F.col("q").alias("psnr"), F.col("d").alias("ssim"), F.when(F.col("t") > 0.02, F.col("t")).alias("action_l1"), F.when(F.col("q") > 3, 1.0).alias("memory_ratio"))
    return rounded(ex.gates(records, "run"))


def target_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five dimensions of a vector at seven model channels, and a named slice of it."""
    vectors = table(spark, sf_dir, "embeddings")
    small = ex.compact(F.col("embedding"), [3, 1, 4, 15, 9])
    wide = ex.into_channels(F.col("small"), [6, 0, 2, 5, 1], 7)
    part = ex.modality_slices(F.col("embedding"), {"arm": (10, 13), "far": (60, 65)})
    out = vectors.select("vec_id", small.alias("small"), part["arm"].alias("arm"), part["far"].isNull().alias("far_missing")).withColumn("wide", wide)
    return rounded(out.select("vec_id", *[F.get("wide", F.lit(k)).cast("double").alias(f"c{k}") for k in range(7)], F.get("arm", F.lit(2)).cast("double").alias("arm_2"), "far_missing"), 5)


def window_slot_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label's vectors as rows of a window: a slot is valid if all its values exceed a bound and the slot is even."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").cast(LONG).alias("label"), F.transform("embedding", lambda x: x > -0.25).alias("m"))
    return ex.slot_validity(rows, ["label"], "m", [k % 2 == 0 for k in range(64)])


QUERIES = {f.__name__: f for f in (segment_problems, latent_jobs, job_coverage, segment_stab, chunk_schedule, case_contract, case_expand, report_gates, target_channels, window_slot_validity)}

_JOBS = "j AS (SELECT seg.*, camera FROM seg CROSS JOIN (SELECT unnest(['head', 'left']) AS camera) WHERE stop > start)"
ORACLE_SQL = {
    "segment_problems": f"WITH {_SEGMENTS}, b AS (SELECT *, max(stop) OVER (PARTITION BY episode_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM seg) SELECT episode_id, ordinal, start, text, stop, n FROM b WHERE start < coalesce(before, 0) OR start < 0 OR stop <= start OR stop > n OR trim(text) = ''",
    "latent_jobs": f"WITH {_SEGMENTS}, c AS (SELECT *, (stop - start - 1) // 2 + 1 AS k FROM seg WHERE stop > start) SELECT episode_id, ordinal, camera, array_to_string(list_transform(range(0, 1 + ((k - 1) // 4) * 4), lambda i: start + 2 * i), ',') AS frame_ids FROM c CROSS JOIN (SELECT unnest(['head', 'left', 'right']) AS camera)",
    "job_coverage": f"WITH {_SEGMENTS}, {_JOBS}, d AS (SELECT episode_id, (episode_id + ordinal) % 3 <> 0 OR camera = 'head' AS done FROM j) SELECT episode_id, count(*) AS jobs, count(*) FILTER (WHERE done) AS done, bool_and(done) AS complete FROM d GROUP BY 1",
    "segment_stab": f"""WITH {_SEGMENTS}, p AS (SELECT episode_id, unnest(range(5, 66, 6)) AS x FROM (SELECT DISTINCT episode_id FROM seg)), h AS (SELECT p.episode_id, x, text || '_' || ordinal AS name, start, stop, row_number() OVER (PARTITION BY p.episode_id, x ORDER BY text || '_' || ordinal, start, stop) AS r
 FROM p LEFT JOIN seg ON p.episode_id = seg.episode_id AND x >= start AND x < stop) SELECT episode_id, x, name, start, stop FROM h WHERE r = 1""",
    "chunk_schedule": """WITH o AS (SELECT DISTINCT o_orderkey, o_custkey % 7 AS chunks, o_custkey % 11 AS start_frame FROM orders), c AS (SELECT *, unnest(range(0, chunks)) AS chunk FROM o WHERE chunks > 0)
SELECT *, chunk // 3 * 3 AS segment_start, least(chunk // 3 * 3 + 3, chunks) AS segment_stop, CASE WHEN chunk > 0 THEN chunk // 3 * 6 END AS context_start, CASE WHEN chunk > 0 THEN 1 + chunk * 2 END AS context_stop,
 CASE WHEN chunk > 0 THEN start_frame + chunk * 8 - 3 ELSE start_frame END AS first_frame, start_frame + chunk * 8 AS last_frame, 1 + 8 * chunks AS decoded FROM c""",
    "case_contract": """SELECT o_orderkey, array_to_string(list_sort(list_filter([CASE WHEN k % 7 = 0 THEN 'target_fps_must_be_20' END, CASE WHEN k % 5 = 0 THEN 'state_steps_must_be_81' END, CASE WHEN k % 11 = 0 THEN 'action_steps_must_be_80' END,
 CASE WHEN k % 13 = 0 THEN 'action_slot_mask_must_have_80_dimensions' END, CASE WHEN k % 19 = 0 THEN 'video_offsets_must_be_0_to_80_stride_4' END, CASE WHEN k % 23 = 0 THEN 'camera_slot_indices_invalid' END, CASE WHEN k % 29 = 0 THEN 'camera_roles_must_match_fixed_five_slots' END, CASE WHEN k % 3 <> 0 THEN 'no_valid_camera_slot' END, CASE WHEN k % 17 = 0 THEN 'canonical_parquet_missing' END, CASE WHEN k % 4 = 0 THEN 'no_valid_starts' END,
 CASE WHEN k % 2 = 0 AND k % 6 >= 3 THEN 'joint_mode_requires_action_loss' END, CASE WHEN k % 2 = 1 AND k % 6 < 3 THEN 'video_only_must_disable_action_loss' END], lambda x: x IS NOT NULL)), ',') AS failures FROM (SELECT o_orderkey, o_orderkey AS k FROM orders)""",
    "case_expand": """WITH c AS (SELECT c_custkey AS case_id, unnest(range(c_custkey % 5, c_custkey % 5 + 40 * (c_custkey % 3 + 1), 40)) AS a FROM customer)
SELECT case_id, substr(sha256(case_id || chr(31) || a), 1, 24) AS concrete_case_id, a AS state_start, a + 81 AS state_stop, a + 80 AS action_stop, array_to_string(range(a, a + 81, 4), ',') AS video_frames FROM c""",
    "report_gates": """WITH l AS (SELECT l_orderkey AS run, l_linenumber, min(l_quantity) AS q, min(l_discount) AS d, CASE WHEN min(l_tax) > 0.02 THEN min(l_tax) END AS t, min(l_returnflag) AS f FROM lineitem GROUP BY 1, 2),
n AS (SELECT *, l_linenumber - min(l_linenumber) OVER (PARTITION BY run) AS step, CASE WHEN q > 5 THEN q::INT % 2 ELSE -1 END AS w FROM l),
g AS (SELECT a.run, a.step, a.q - b.q AS pg, a.d - b.d AS sg, CASE WHEN b.t IS NOT NULL THEN a.t / greatest(b.t, 1e-12) END AS ar, a.f = b.f AND a.w = b.w AS same, a.q > 3 AS mem FROM n a JOIN n b ON a.run = b.run AND b.step = 0 WHERE a.step > 0)
SELECT run, step, round(pg, 6) AS psnr_gain, round(sg, 6) AS ssim_gain, round(ar, 6) AS action_ratio, same AS same_sample, mem AS memory_valid, same AND mem AND pg >= 3 AND sg >= 0.05 AND coalesce(ar <= 0.5, true) AS passed FROM g""",
    "target_channels": """SELECT vec_id, round(embedding[2]::DOUBLE, 5) AS c0, round(embedding[10]::DOUBLE, 5) AS c1, round(embedding[5]::DOUBLE, 5) AS c2, 0.0::DOUBLE AS c3, 0.0::DOUBLE AS c4, round(embedding[16]::DOUBLE, 5) AS c5, round(embedding[4]::DOUBLE, 5) AS c6,
 round(embedding[13]::DOUBLE, 5) AS arm_2, true AS far_missing FROM embeddings""",
    "window_slot_validity": "WITH e AS (SELECT label::BIGINT AS label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS slot FROM embeddings) SELECT label, slot::INT AS slot, bool_and(x > -0.25::FLOAT) AND slot % 2 = 0 AS valid FROM e GROUP BY label, slot",
}
