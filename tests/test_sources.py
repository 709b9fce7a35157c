"""Readers and writers over small files made here."""

import io
import json
import pickle
import tarfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from kinetrail.sources import archives, files, sinks


@pytest.fixture
def layout(tmp_path):
    """Two episodes of 100 and 50 frames at 20 frames a second, with a camera."""
    features = {
        "observation.state": {"dtype": "float64", "shape": [2], "names": ["left_arm_joint_1_rad", "left_gripper_open"], "info": None},
        "cam": {"dtype": "video", "shape": [480, 640, 3], "names": ["height", "width", "channels"], "info": {"video.fps": "30000/1001", "video.codec": "av1"}},
    }
    (tmp_path / "meta").mkdir()
    (tmp_path / "data/chunk-000").mkdir(parents=True)
    (tmp_path / "meta/info.json").write_text(json.dumps({"robot_type": "arm", "fps": 20.0, "chunks_size": 1000, "codebase_version": "v2.1", "total_episodes": 2, "total_frames": 150, "features": features}, indent=1))
    (tmp_path / "meta/episodes.jsonl").write_text("\n".join(json.dumps({"episode_index": i, "length": n, "tasks": ["pick"]}) for i, n in ((0, 100), (1, 51))) + "\n\n")
    for i, n in ((0, 100), (1, 50)):
        pq.write_table(pa.table({"observation.state": [[k / 100, 1.0] for k in range(n)], "timestamp": [k / 20 for k in range(n)], "frame_index": list(range(n))}), tmp_path / f"data/chunk-000/episode_{i:06d}.parquet")
    return str(tmp_path)


def test_layout(spark, layout):
    episodes = files.episode_layout(spark, layout)
    rows = episodes.orderBy("episode_index").collect()
    assert [(r.num_frames, r.fps, r.duration_s) for r in rows] == [(100, 20.0, 99 / 20), (51, 20.0, 2.5)]
    assert rows[0].data_uri.endswith("data/chunk-000/episode_000000.parquet")
    camera = files.cameras(episodes).first()
    assert (camera.source_key, camera.height, camera.width, camera.codec) == ("cam", 480, 640, "av1")
    assert camera.fps == pytest.approx(29.97, abs=0.01)
    frames = files.episode_frames(spark, layout, ["observation.state", "timestamp", "absent"])
    assert frames.columns == ["episode_index", "observation.state", "timestamp"]
    frames = frames.withColumnRenamed("observation.state", "state")
    assert {(r.problem, r.episode_index) for r in files.layout_problems(episodes, frames, "state").collect()} == {("row_count", 1)}


def test_strict_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert sorted(r.a for r in files.json_lines(spark, str(tmp_path / "a.jsonl"), "a int").collect()) == [1, 2]
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n{oops\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        files.json_lines(spark, str(tmp_path / "b.jsonl"), "a int").collect()


def test_results_and_checkpoints(spark, tmp_path):
    for step, rank in ((10, 0), (2, 0), (2, 1)):
        (tmp_path / f"step_{step}_rank_{rank}.json").write_text('{"psnr": 1.5}')
    (tmp_path / "other.json").write_text('{"psnr": 9}')
    got = files.step_records(spark, str(tmp_path), "psnr double", rank=0).orderBy("step").collect()
    assert [(r.step, r.rank) for r in got] == [(2, 0), (10, 0)]
    (tmp_path / "r").mkdir()
    (tmp_path / "r/x.txt").write_text("start\n0.25\n7\n0.5\nbye\n")
    assert files.last_rate(spark, str(tmp_path / "r")).first().value == 0.5
    listing = spark.createDataFrame([("a", "a/step_5/w"), ("a", "a/step_5/o"), ("a", "a/step_9/w"), ("a", "a/readme")], "run string, path string")
    assert files.complete_checkpoints(listing, ["w", "o"]).first().step == 5


def _tar(path, members, mode="w"):
    with tarfile.open(path, mode) as tar:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


def test_tar_members(spark, tmp_path):
    _tar(tmp_path / "a.tar", {"100/videos/head.mp4": b"video", "100/depth/1.png": b"d"})
    _tar(tmp_path / "b.tar.gz", {"200/videos/head.mp4": b"other"}, "w:gz")
    rows = archives.tar_members(spark, [str(tmp_path / "a.tar"), str(tmp_path / "b.tar.gz")], r"\.mp4$")
    assert {(r.member, bytes(r.payload)) for r in rows.collect()} == {("100/videos/head.mp4", b"video"), ("200/videos/head.mp4", b"other")}
    index = archives.tar_members(spark, [str(tmp_path / "a.tar")], payload=False)
    assert {(r.member, bytes(r.payload)) for r in archives.members_by_offset(index).collect()} == {("100/videos/head.mp4", b"video"), ("100/depth/1.png", b"d")}
    assert archives.split_uri("tar:///x/a.tar!m/n") == ("/x/a.tar", "m/n")


class _Evil:
    def __reduce__(self):
        return (print, ("no",))


def test_pickles_are_restricted(spark, tmp_path):
    import numpy as np

    steps = [{"observation": {"state": np.arange(2.0) + i}, "partly": i} if i else {"observation": {"state": np.arange(2.0)}} for i in range(3)]
    _tar(tmp_path / "p.tar", {"e.pkl": pickle.dumps(steps)})
    members = archives.tar_members(spark, [str(tmp_path / "p.tar")])
    got = archives.pickled_frames(members, ["observation.state", "partly"], 10.0).orderBy("frame_index").collect()
    assert [r.signals for r in got] == [{"observation.state": [float(i), i + 1.0]} for i in range(3)]
    assert got[2].t == pytest.approx(0.2)
    with pytest.raises(pickle.UnpicklingError):
        archives.load_steps(pickle.dumps([_Evil()]))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    sinks.write_table(df, str(tmp_path / "t"))
    with pytest.raises(Exception, match="exist"):
        sinks.write_table(df, str(tmp_path / "t"))
    sinks.write_json_lines(df, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first().value == '{"a":"x","b":1}'
    sinks.write_receipt(str(tmp_path / "r/x.json"), {"b": 1, "a": 2})
    assert list(json.loads((tmp_path / "r/x.json").read_text())) == ["a", "b"]
    assert sinks.digest({"b": 1, "a": 2}) == sinks.digest({"a": 2, "b": 1})
