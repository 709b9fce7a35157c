"""Scores, admission, names and reports."""

import hashlib

import pytest
from pyspark.sql import functions as F

from kinetrail.functions import scalar as sc
from kinetrail.operators import curation as cu
from kinetrail.operators import reports as rp


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_identifiers(spark):
    digest = hashlib.sha256("a\x1f7\x1fNone".encode()).hexdigest()
    parts = (F.lit("a"), F.lit(7), F.lit(None))
    assert one(spark, sc.stable_id(*parts)) == digest[:24]
    assert one(spark, sc.unit_hash(*parts)) == int(digest[:16], 16) / 2**64


@pytest.mark.parametrize(("text", "value"), [("30000/1001", 30000 / 1001), ("25", 25.0), ("0/0", None), ("N/A", None), ("-5", None)])
def test_rates(spark, text, value):
    got = one(spark, sc.rate(F.lit(text)))
    assert got is None if value is None else got == pytest.approx(value)


def test_small_functions(spark):
    assert one(spark, sc.base26(F.lit("ba"))) == 26
    assert one(spark, sc.slug(F.lit("  A b/c "))) == "a-b-c"
    assert one(spark, sc.chunk_path("d/%03d/e_%06d", F.lit(1000), F.lit(2500))) == "d/002/e_002500"
    made = sc.prompts(F.array(F.lit(" a  b "), F.lit("a b"), F.lit("x"), F.lit(""), F.lit("long one")))
    assert one(spark, made["prompts"]) == ["a b", "x", "long one"]
    assert one(spark, made["primary_prompt"]) == "a b"
    assert one(spark, sc.prompt_or_namespace(F.lit(None).cast("array<string>"), F.lit("pick_up/cup"))) == "pick up cup"


def test_rotations(spark):
    identity = one(spark, sc.quaternion_to_rotvec(*[F.lit(float(x)) for x in (0, 0, 0, 2)]))
    assert identity == [0, 0, 0]
    half = 0.5**0.5
    assert one(spark, sc.quaternion_to_rotvec(*[F.lit(x) for x in (0.0, 0.0, half, half)])) == pytest.approx([0, 0, 1.5707963267948966])
    assert one(spark, sc.rpy_to_rotvec(F.lit(0.0), F.lit(0.0), F.lit(0.5))) == pytest.approx([0, 0, 0.5])
    with pytest.raises(Exception, match="no length"):
        one(spark, sc.quaternion_to_rotvec(*[F.lit(0.0)] * 4))
    pose = [F.lit(x) for x in (1.0, 2.0, 3.0, 0.0, 0.0, half, half)]
    assert one(spark, sc.relative_pose(pose, pose)) == pytest.approx([0, 0, 0, 0, 0, 0, 1])


def test_scores(spark):
    part = {"integrity": F.lit(1.0), "temporal": F.lit(None).cast("double"), "novelty": F.lit(2.0)}
    assert one(spark, cu.component_score(part)) == pytest.approx(1.0)
    assert one(spark, cu.component_score({"integrity": F.lit(None).cast("double")})) is None
    assert one(spark, cu.penalty_score(F.lit(1), F.lit(1), F.lit(1), F.lit(True), F.lit(False), F.lit(True))) == pytest.approx(1 - 0.45 - 0.08 - 0.03 - 0.15 - 0.1)
    assert one(spark, cu.sample_weight(F.lit(0.0), F.lit("B"), F.lit(0.8))) == pytest.approx(0.4)
    yes, no = F.lit(True), F.lit(False)
    assert one(spark, cu.tiers(no, yes, yes, yes, yes, yes, yes)["tier"]) == "A"
    assert one(spark, cu.tiers(no, yes, yes, yes, yes, no, yes)["candidate_tier"]) == "A"
    assert one(spark, cu.tiers(yes, yes, yes, yes, yes, yes, yes)["tier"]) == "C"
    assert one(spark, cu.admission_mode(F.lit("A"), yes, yes, F.lit(3.9))) == "reject"
    assert one(spark, cu.admission_mode(F.lit("A"), yes, yes, F.lit(4.0))) == "joint_video_action"
    assert one(spark, cu.reasons((yes, "b"), (yes, "a"), (F.lit(None).cast("boolean"), "c"), (yes, "a"))) == ["a", "b"]


def test_first_wins_marks_and_drops_nothing(spark):
    rows = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y"), (4, None), (5, "x")], "id int, fp string")
    got = {r.id: (r.duplicate_of, r.dedupe_status) for r in cu.first_wins(rows, "fp", ["id"], "id").collect()}
    assert got == {1: (None, "unique"), 3: (1, "duplicate"), 5: (1, "duplicate"), 2: (None, "unique"), 4: (None, "pending")}


def test_scatter_masks(spark):
    slots, mask = cu.scatter(None, [(0, 3), (1, 5), (9, 7)], "v", 8)
    row = spark.createDataFrame([([1.5, float("nan")],)], "v array<double>").select(slots.alias("s"), mask.alias("m")).first()
    assert row.s == [0, 0, 0, 1.5, 0, 0, 0, 0]
    assert row.m == [False, False, False, True, False, False, False, False]


def test_camera_slots_are_greedy(spark):
    roles = ["global_primary", "global_secondary", "left_wrist", "right_wrist", "auxiliary"]
    rows = spark.createDataFrame([("e", "p1", "global_primary", 9), ("e", "p2", "global_primary", 8), ("e", "p3", "global_primary", 7), ("e", "w", "left_wrist", 1)], "e string, key string, role string, px int")
    got = {r.slot: r.key for r in cu.ranked_slots(rows, ["e"], "role", [F.col("px").desc()], roles).collect()}
    assert got == {"global_primary": "p1", "global_secondary": "p2", "left_wrist": "w", "auxiliary": "p3"}


def test_status_and_verification(spark):
    want = {"a": "complete", "b": "present_untracked", "c": "partial", "d": "missing", "e": "failed", "f": "interrupted_or_running", "g": "present_untracked", "h": "complete"}
    lock = spark.createDataFrame([(k, "1") for k in want], "repo string, revision string")
    marker = spark.createDataFrame([("a", "ok", "1"), ("b", "ok", "0"), ("d", "ok", "1"), ("e", "error", "1"), ("f", "running", "1"), ("h", "ok", "1")], "repo string, marker_status string, marker_revision string")
    here = spark.createDataFrame([("a", 0), ("a", 0), ("b", 0), ("c", 2), ("e", 0), ("f", None), ("g", 0), ("h", 1)], "repo string, incomplete int")
    assert {r.repo: r.status for r in rp.status(lock, marker, here, "repo").collect()} == want
    want = spark.createDataFrame([("f", 1), ("g", 2), ("h", 3)], "f string, size int")
    have = spark.createDataFrame([("f", 1), ("g", 9)], "f string, size int")
    assert {(r.f, r.problem) for r in rp.verify(want, have, "f", "size").collect()} == {("g", "size"), ("h", "missing")}


def test_errors_without_error_are_infinite(spark):
    rows = spark.createDataFrame([("k", 0, 1.0), ("k", 1, 2.0), ("k", 2, 3.0)], "k string, step int, v double")
    got = rp.pair_errors(rows, rows.where("step < 2"), ["k"], "step", "v").first()
    assert (got.n, got.mae, got.psnr) == (2, 0.0, float("inf"))


def test_frozen_and_dark_frames(spark):
    frames = spark.createDataFrame([("a", 0, [0] * 64), ("a", 1, [0] * 64), ("a", 2, [(i * 37) % 256 for i in range(64)])], "k string, i int, p array<int>")
    out = frames.withColumn("code", rp.difference_hash(F.col("p"), 8, 8))
    assert [r.frozen for r in rp.frozen_pairs(out, ["k"], "i", "p", "code").orderBy("i").collect()] == [True, False]
    m = rp.luma_metrics(F.col("p"))
    rows = frames.select("i", m["dark_ratio"].alias("d"), m["entropy"].alias("e")).orderBy("i").collect()
    assert rows[0].d == 1.0 and rows[0].e == 0.0 and rows[2].e > 0.9


def test_balanced_sample_wraps(spark):
    rows = spark.createDataFrame([("a", i) for i in range(3)] + [("b", i) for i in range(50)], "g string, k int")
    got = rp.balanced_sample(rows, "g", "k", 21, "s").groupBy("g").count().collect()
    assert sorted(r["count"] for r in got) == [10, 11]


def test_round_robin(spark):
    rows = spark.range(37).withColumnRenamed("id", "k")
    got = {r.k: r.worker for r in rp.round_robin(rows, ["k"], 4).collect()}
    assert got == {k: k % 4 for k in range(37)}


def test_exports(spark):
    from kinetrail.operators import exports as ex

    assert ex.inverse_channels([2, 0], 4) == [1, 2, 0, 2]
    with pytest.raises(ValueError):
        ex.inverse_channels([0, 0], 4)
    assert one(spark, ex.frame_ids(F.lit(0).cast("bigint"), F.lit(20).cast("bigint"), 2)) == [0, 2, 4, 6, 8, 10, 12, 14, 16]
    assert one(spark, ex.decoded_frames(F.lit(10))) == 81 and one(spark, ex.decoded_frames(F.lit(114))) == 913
    segments = spark.createDataFrame([("e", 0, 0, 5, "a", 10), ("e", 1, 4, 8, "b", 10), ("e", 2, 8, 11, "c", 10), ("e", 3, None, 9, "d", 10)], "episode_id string, ordinal int, start long, stop long, text string, n long")
    assert sorted(r.ordinal for r in ex.segment_problems(segments).collect()) == [1, 2, 3]
    roles = ["global_primary", "global_secondary", "left_wrist", "right_wrist", "auxiliary"]
    good = (list(range(0, 81, 4)), roles, [0, 1, 2, 3, 4], 20.0, 81, 80, [True] * 80, [True] * 80, [True] * 5, "u", 3, "joint_video_action", True)
    bad = (list(range(0, 81, 5)), roles[::-1], None, None, 81, 80, [True] * 80, None, [False] * 5, None, 0, "video_only", True)
    columns = "video_offsets array<int>, camera_roles array<string>, camera_indices array<int>, target_fps double, state_steps int, action_steps int, state_slot_mask array<boolean>, action_slot_mask array<boolean>, camera_mask array<boolean>, canonical_uri string, start_count int, mode string, action_loss boolean"
    rows = [r.failures for r in ex.case_failures(spark.createDataFrame([good, bad], columns)).collect()]
    assert rows[0] == []
    assert rows[1] == ["action_slot_mask_must_have_80_dimensions", "camera_roles_must_match_fixed_five_slots", "camera_slot_indices_invalid", "canonical_parquet_missing", "no_valid_camera_slot", "no_valid_starts", "target_fps_must_be_20", "video_offsets_must_be_0_to_80_stride_4", "video_only_must_disable_action_loss"]


def test_difference_hash_covers_the_image(spark):
    """A whole image of another size: 8 rows and 9 columns at rounded places, the first bit the highest."""
    width, height = 20, 11
    pixels = [(x * x * 7 + y * 31) % 256 for y in range(height) for x in range(width)]
    bits = ""
    for y in range(8):
        at = round(y * (height - 1) / 7) * width
        bits += "".join(str(int(pixels[at + round(x * (width - 1) / 8)] > pixels[at + round((x + 1) * (width - 1) / 8)])) for x in range(8))
    row = spark.createDataFrame([(pixels,)], "p array<int>")
    assert row.select(rp.hash_text(rp.difference_hash(F.col("p"), width, height)).alias("h")).first().h == f"{int(bits, 2):016x}"


def test_gates_need_a_first_step(spark):
    from kinetrail.operators import exports as ex

    schema = "run string, step int, sample_index int, window_start int, psnr double, ssim double, action_l1 double, memory_ratio double"
    good = spark.createDataFrame([("r", 0, 1, 5, 10.0, 0.1, 0.4, 1.0), ("r", 9, 1, 5, 14.0, 0.2, 0.1, 1.0), ("r", 10, 1, 6, 14.0, 0.2, 0.1, 1.0), ("r", 11, 1, 5, 14.0, 0.2, 0.3, 1.0), ("r", 12, 1, 5, 14.0, 0.2, None, 0.5)], schema)
    assert {r.step: r.passed for r in ex.gates(good, "run").collect()} == {9: True, 10: False, 11: False, 12: False}
    late = good.where("step > 0")
    with pytest.raises(Exception, match="step 0"):
        ex.gates(late, "run").collect()
    assert {r.step: r.passed for r in ex.gates(late, "run", baseline=good.where("step = 0")).collect()} == {9: True, 10: False, 11: False, 12: False}
