"""Selection, audits, materialisation, cases, configuration and sources: what the registered queries do not show."""

import json

import pytest
from pyspark.sql import functions as F

from kinetrail import __main__ as cli
from kinetrail import config
from kinetrail.operators import audits, cases, materialize
from kinetrail.operators import selection as se
from kinetrail.operators.windows import WindowPolicy
from kinetrail.sources import episodes, sinks


def test_repository_errors(spark):
    lock = spark.createDataFrame([(0, "a", "o/x", "x"), (1, "b", "o/y", "y")], "ordinal int, dataset string, repo_id string, local_name string")
    assert [r.repo_id for r in se.repositories(lock, ["all"], "*x*").collect()] == ["o/x"]
    assert [r.repo_id for r in se.repositories(lock, None, None, 1).collect()] == ["o/x"]
    for bad in ({"names": ["c"]}, {"glob": "nothing"}, {"most": 0}):
        with pytest.raises(ValueError):
            se.repositories(lock, **bad)


def test_stops(spark):
    rows = spark.createDataFrame([(1, True), (2, None)], "k int, bad boolean")
    with pytest.raises(Exception, match="row 1"):
        se.stop_where(rows, F.col("bad"), F.concat(F.lit("row "), F.col("k").cast("string"))).collect()
    assert se.stop_where(rows.where("k = 2"), F.col("bad"), F.lit("no")).count() == 1
    wanted = spark.createDataFrame([(1, 0), (2, 1)], "k int, place int")
    with pytest.raises(Exception, match="cover"):
        se.in_order(wanted, rows.where("k = 1"), "k", "place").collect()


def test_partial_names(spark):
    names = ["a.part", "a.TMP", "x.incomplete", "cache/x.incomplete/y", "part.tar", "a.partial.tar"]
    got = spark.createDataFrame([(x,) for x in names], "p string").select(se.is_partial(F.col("p")).alias("x")).collect()
    assert [r.x for r in got] == [True, True, True, True, False, False]


def test_quaternion_groups(spark):
    rows = [("pose", i, n) for i, n in enumerate(["tool_quat_x", "tool_quat_y", "tool_quat_z", "tool_quat_w", "yaw", "yaw_velocity", "wrist.rad", None])]
    rows += [("hand_orientation", i, n) for i, n in enumerate("xyzw")] + [("half_quat", i, n) for i, n in enumerate("xyz")] + [("left_gripper", 0, "any")]
    dims = spark.createDataFrame([("e", *r) for r in rows], "e string, source_key string, dim int, name string")
    got = {(r.source_key, r.dim): (r.meaning, r.angle) for r in audits.dimension_meaning(dims, ["e"]).collect()}
    assert all(got["pose", i][0] == "quaternion_component" for i in range(4)) and all(got["hand_orientation", i][0] == "quaternion_component" for i in range(4))
    assert all(got["half_quat", i][0] is None for i in range(3)) and got["left_gripper", 0][0] == "zero_order_gripper"
    assert [got["pose", i][1] for i in (4, 5, 6, 7)] == [True, False, True, False]


def test_velocity_actions_follow_the_derivative(spark):
    """A state of positions whose differences are the action: lag 0, passed; without samples: pending."""
    import math

    speed = [math.sin(i * 0.7) for i in range(60)]
    place = [0.0]
    for v in speed[1:]:
        place.append(place[-1] + v / 20)
    rows = [("e", 9, i, place[i], speed[i], "action_vs_state_derivative") for i in range(60)]
    samples = spark.createDataFrame(rows, "e string, slot int, idx int, state double, action double, comparison string")
    known = spark.createDataFrame([("e", 0.0), ("none", 10.0)], "e string, fps double")
    got = {r.e: r for r in audits.alignment(samples, known, "e").collect()}
    assert got["e"].status == "passed" and got["e"].best_lag == 0 and got["e"].score == pytest.approx(1.0) and got["none"].status == "pending"


def test_extreme_samples(spark):
    """Two dark frames side by side are hard; the end of the last sample lies half a step on."""
    rows = [("c", 0, 0.0, ["extreme_dark"]), ("c", 1, 1.0, ["extreme_dark", "low_entropy"]), ("c", 2, 3.0, []), ("c", 3, 4.0, ["extreme_dark"]), ("d", 0, 2.0, ["low_sharpness"])]
    frames = spark.createDataFrame(rows, "c string, sample int, t double, flags array<string>")
    got = {(r.c, r.sample, r.reason): (r.severity, r.start_s, r.stop_s) for r in audits.sample_intervals(frames, ["c"]).collect()}
    assert got["c", 0, "extreme_dark"] == ("hard", 0.0, 0.5) and got["c", 1, "extreme_dark"] == ("hard", 0.5, 2.0)
    assert got["c", 1, "low_entropy"][0] == "soft" and got["c", 3, "extreme_dark"] == ("soft", 3.5, 4.5)
    assert got["d", 0, "low_sharpness"] == ("soft", 0.0, pytest.approx(2.001))


def test_derived_columns(spark):
    frames = spark.createDataFrame([("e", 0, [1.0, 2.0]), ("e", 1, [3.0, 4.0])], "e string, i int, v array<double>")
    out = materialize.read_with_derived(frames, ["e"], "i", [{"target": "a", "source": "v", "op": "next_row_hold_last", "indices": [1]}], ["a"])
    assert [r.a for r in out.orderBy("i").collect()] == [[4.0], [4.0]]
    with pytest.raises(ValueError, match="unknown"):
        materialize.derive(F.col("v"), "twist")


def test_built_and_skipped_are_all(spark):
    schema = "k int, tier string, mode string, supported boolean, opened boolean, n_rows int, num_frames int, has_time boolean, fps double, increasing boolean"
    rows = [(0, "A", "joint_video_action", True, True, 9, 9, True, 20.0, True), (1, "C", "reject", True, True, 9, 9, True, 20.0, True), (2, "B", "video_only", False, None, None, 9, None, 20.0, None), (3, "A", "x", True, True, 1, 9, True, 20.0, True), (4, None, None, None, None, None, None, None, None, None)]
    built, skipped = materialize.built_and_skipped(spark.createDataFrame(rows, schema))
    assert {r.k for r in built.collect()} == {0, 2}
    assert {r.k: r.reason for r in skipped.collect()} == {1: "training_admission_or_quality_tier", 3: "too_few_rows", 4: "native_converter_or_timeline_metadata_required"}


def test_loader_contract(spark):
    roles = ["global_primary", "global_secondary", "left_wrist", "right_wrist", "auxiliary"]
    good = ("a", list(range(0, 81, 4)), roles, [0, 1, 2, 3, 4], 20.0, 81, 80, [True] * 80, [True] * 80, [True] * 5, "u", 3, "video_only", False)
    schema = "case_id string, video_offsets array<int>, camera_roles array<string>, camera_indices array<int>, target_fps double, state_steps int, action_steps int, state_slot_mask array<boolean>, action_slot_mask array<boolean>, camera_mask array<boolean>, canonical_uri string, start_count int, mode string, action_loss boolean"
    assert cases.checked(spark.createDataFrame([good], schema)).count() == 1
    with pytest.raises(Exception, match="twice"):
        cases.checked(spark.createDataFrame([good, good], schema)).collect()
    with pytest.raises(Exception, match="no_valid_starts"):
        cases.checked(spark.createDataFrame([(*good[:11], 0, *good[12:])], schema)).collect()
    with pytest.raises(Exception, match="statistics"):
        values = spark.createDataFrame([("d", 1.0)], "domain string, value double")
        cases.normalised(values, spark.createDataFrame([], "domain string, mean double, std double, valid boolean"), ["domain"]).collect()


def test_configuration(tmp_path):
    known = {"A": "x", "EMPTY": ""}
    assert config.expanded({"k": ["${A}/${B:-y}", 3], "e": "${EMPTY:-z}"}, known) == {"k": ["x/y", 3], "e": "z"}
    with pytest.raises(config.ConfigError):
        config.expanded("${EMPTY}", known)
    assert config.merged({"a": {"b": 1, "c": [1]}, "d": 2}, {"a": {"c": [2]}}) == {"a": {"b": 1, "c": [2]}, "d": 2}
    assert config.profile({"defaults": {"w": {"a": 1, "b": 2}}, "datasets": {"x": {"w": {"b": 3}}}}, "x") == {"w": {"a": 1, "b": 3}}
    assert config.policy(WindowPolicy, {"stride": 8}).stride == 8
    for bad in (lambda: config.policy(WindowPolicy, {"strid": 8}), lambda: config.TargetProfile("t", channels=(1, 1)), lambda: config.TargetProfile("t", fps=0)):
        with pytest.raises(config.ConfigError):
            bad()
    (tmp_path / "c.json").write_text(json.dumps({"a": 1}))
    assert config.load(str(tmp_path / "c.json")) == {"a": 1}


def test_sources_and_sinks(spark, tmp_path):
    root = tmp_path / "r"
    (root / "meta").mkdir(parents=True)
    (root / "meta" / "info.json").write_text(json.dumps({"codebase_version": "v3.0", "fps": 10.0, "chunks_size": 10, "features": {}}))
    (root / "meta" / "episodes.jsonl").write_text('{"episode_index": 0, "length": 3, "tasks": []}\n')
    with pytest.raises(Exception, match="v3.0"):
        episodes.strict_layout(spark, str(root)).collect()
    with pytest.raises(ValueError, match="unknown source"):
        episodes.scan(spark, "floppy", "x")
    one = spark.range(1)
    path = one.select(episodes.templated(F.lit("c{episode_chunk:03d}/e_{episode_index}.p"), F.lit(1000), F.lit(12345)).alias("p")).first().p
    assert path == "c012/e_12345.p"
    (tmp_path / "in.txt").write_text("abc")
    sinks.write_receipt_of(spark, str(tmp_path / "receipt.json"), {"k": 1}, [str(tmp_path / "in.txt")])
    said = json.loads((tmp_path / "receipt.json").read_text())
    assert list(said["inputs"].values()) == ["ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"]
    assert said["sha256"] == sinks.digest({k: v for k, v in said.items() if k != "sha256"})
    table = sinks.markdown(spark.createDataFrame([(1, "a|b", None), (2, "c", 0.5)], "k int, s string, x double"), "T", 1)
    assert "| 1 | a\\|b |  |" in table and "More than 1 rows." in table


def test_command_line(spark, capsys, tmp_path):
    assert cli.main(["queries"]) == 0 and "status_rollup" in capsys.readouterr().out
    assert cli.main(["run", "nothing", "x"]) == 2
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "a").write_text("12")
    (tmp_path / "want.jsonl").write_text('{"path": "a", "size": 2}\n{"path": "b", "size": 1}\n')
    assert cli.main(["verify", str(tmp_path / "want.jsonl"), str(tmp_path / "files"), ]) == 0
    shown = capsys.readouterr().out
    assert "missing" in shown and "size" not in shown.replace("problem", "")
