"""Registered queries of sources and sinks: each writes a small archive, repository or table from the test tables and reads it back."""

from __future__ import annotations

import io
import json
import os
import pickle
import tarfile
import tempfile
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetrail.plans.base import rounded, table
from kinetrail.sources import archives, episodes, files, sinks


def _folder(spark: SparkSession) -> str:
    """A new folder in the shared one, where that is a mounted path; on one machine a temporary one."""
    shared = (spark.sparkContext.getConf().get("spark.checkpoint.dir") or "").removeprefix("file:")
    if shared.startswith("/"):
        path = os.path.join("/" + shared.lstrip("/"), f"kinetrail-{uuid.uuid4().hex[:12]}")
        os.makedirs(path)
        return path
    return tempfile.mkdtemp(prefix="kinetrail-")


def _nations(spark: SparkSession, sf_dir: str) -> list:
    """The 25 nations: what the archives hold."""
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("k"), F.col("n_regionkey").cast("bigint").alias("r"), "n_name").orderBy("k").collect()


def _tar(path: str, members: list[tuple[str, bytes]], mode: str = "w") -> str:
    with tarfile.open(path, mode) as tar:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return path


def _parquet(columns: dict) -> bytes:
    out = io.BytesIO()
    pq.write_table(pa.table(columns), out)
    return out.getvalue()


def archive_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as episodes in two archives, region 2 in both: the first archive wins. The next row's key is a derived column."""
    folder, rows = _folder(spark), _nations(spark, sf_dir)

    def member(r: int, shift: int) -> tuple[str, bytes]:
        own = [x for x in rows if x.r == r]
        return f"data/{r}.parquet", _parquet({"key": [[float(x.k + shift), 1.0] for x in own], "name": [x.n_name for x in own], "left": [1] * len(own)})

    paths = [_tar(f"{folder}/a.tar", [member(0, 0), member(2, 0), ("data/readme.txt", b"x")]), _tar(f"{folder}/b.tar.gz", [member(2, 100), member(4, 0)], "w:gz")]
    derived = [{"target": "next_key", "source": "key", "op": "next_row_hold_last", "indices": [0]}, {"target": "none", "source": "absent", "op": "identity"}]
    out = episodes.read_archives(spark, paths, "key array<double>, name string, missing int", ["key", "name", "next_key", "missing"], derived)
    return out.select("episode_id", "row", "name", F.get("key", F.lit(0)).alias("key"), F.get("next_key", F.lit(0)).alias("next_key"), "missing")


def archive_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _tar(f"{_folder(spark)}/names.tar", [(f"{x.r}/{x.k}.txt", (x.n_name * (x.k + 1)).encode()) for x in _nations(spark, sf_dir)])
    index = archives.tar_members(spark, [path], pattern=r"\.txt$", payload=False)
    found = archives.members_by_offset(episodes.by_episode(index).where("episode_id <> '3'"), span=4096)
    return found.select("member", F.octet_length("payload").cast("bigint").alias("size"), F.sha2("payload", 256).alias("sha256"))


def pickled_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as step lists in pickles; a key that one step lacks is left out."""
    rows = _nations(spark, sf_dir)
    members = []
    for r in range(5):
        steps = [{"obs": {"key": [float(x.k), 2.0]}, **({"odd": 1.0} if x.k % 4 else {})} for x in rows if x.r == r]
        members.append((f"{r}.pkl", pickle.dumps({"steps": steps})))
    path = _tar(f"{_folder(spark)}/steps.tar", members)
    out = archives.pickled_frames(archives.tar_members(spark, [path]), ["obs.key", "odd"], 5.0)
    key = F.try_element_at("signals", F.lit("obs.key"))
    return rounded(out.select("member", "frame_index", "t", F.get(key, F.lit(0)).alias("key"), F.size(key).cast("bigint").alias("width"), F.try_element_at("signals", F.lit("odd")).isNotNull().alias("odd")))


def _layout(spark: SparkSession, sf_dir: str) -> str:
    root = _folder(spark) + "/repo"
    os.makedirs(f"{root}/meta")
    os.makedirs(f"{root}/data/chunk-000")
    os.makedirs(f"{root}/data/chunk-001")
    rows = _nations(spark, sf_dir)
    info = {"robot_type": "arm", "fps": 10.0, "chunks_size": 3, "codebase_version": "v2.1", "total_episodes": 5, "total_frames": 25, "data_path": "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet", "video_path": None, "features": {}}
    with open(f"{root}/meta/info.json", "w", encoding="utf-8") as file:
        json.dump(info, file)
    with open(f"{root}/meta/episodes.jsonl", "w", encoding="utf-8") as file:
        for r in range(5):
            own = [x for x in rows if x.r == r]
            file.write(json.dumps({"episode_index": r, "length": len(own), "tasks": [own[0].n_name]}) + "\n\n")
            if r != 3:
                with open(f"{root}/data/chunk-{r // 3:03d}/episode_{r:06d}.parquet", "wb") as data:
                    data.write(_parquet({"observation.state": [[float(x.k)] for x in own], "frame_index": list(range(len(own)))}))
    return root


def layout_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repository found by its info file: episodes, their templated paths and whether the files exist."""
    root = _layout(spark, sf_dir)
    found = episodes.repositories(spark, os.path.dirname(root)).first().repository
    rows = episodes.with_existing(episodes.strict_layout(spark, root), episodes.listed(spark, f"{root}/data", "*.parquet"))
    path = episodes.templated(F.lit("data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet"), F.lit(3), F.col("episode_index"))
    return rounded(rows.select("episode_index", "num_frames", F.get("tasks", F.lit(0)).alias("task"), "fps", "duration_s", path.alias("path"), F.col("data_uri").endswith(path).alias("same_path"), "exists").withColumn("repository", F.lit(found.endswith("/repo"))))


def layout_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _layout(spark, sf_dir)
    derived = [{"target": "action", "source": "observation.state", "op": "next_row_hold_last"}]
    out = episodes.read_layout(spark, root, ["observation.state", "action", "gone"], derived)
    return out.select(F.col("episode_index").cast("bigint").alias("episode_index"), "frame_index", F.get("`observation.state`", F.lit(0)).alias("state"), F.get("action", F.lit(0)).alias("action"))


def rewritten_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written, one column made anew in a second, some rows laid over it in a third, metadata kept."""
    folder = _folder(spark)
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    sinks.write_table(sinks.with_metadata(base, "c_nationkey", {"unit": "key"}), f"{folder}/a")
    sinks.rewrite_column(spark, f"{folder}/a", f"{folder}/b", "c_mktsegment", F.lower("c_mktsegment"))
    over = spark.read.parquet(f"{folder}/b").where("c_custkey % 10 = 0").withColumn("c_mktsegment", F.lit("laid over"))
    sinks.overlay(over, f"{folder}/b", f"{folder}/c", ["c_custkey"])
    unit = spark.read.parquet(f"{folder}/c").schema["c_nationkey"].metadata.get("unit") or spark.read.parquet(f"{folder}/b").schema["c_nationkey"].metadata.get("unit")
    return spark.read.parquet(f"{folder}/c").withColumn("unit", F.lit(unit))


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON lines, some appended, and read strictly."""
    path = _folder(spark) + "/log"
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("string").alias("price"))
    sinks.write_json_lines(rows.where("o_orderkey % 3 = 0"), path)
    sinks.append_events(rows.where("o_orderkey % 3 = 1").select("o_orderkey", "price"), path)
    return files.json_lines(spark, path, "o_orderkey bigint, o_orderstatus string, price string")


QUERIES = {f.__name__: f for f in (archive_frames, archive_offsets, pickled_steps, layout_scan, layout_frames, rewritten_tables, manifest_lines)}

_N = "n AS (SELECT n_nationkey::BIGINT AS k, n_regionkey::BIGINT AS r, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS i, lead(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS nx, count(*) OVER (PARTITION BY n_regionkey) AS c FROM nation)"
ORACLE_SQL = {
    "archive_frames": f"WITH {_N} SELECT r::VARCHAR AS episode_id, i AS row, n_name AS name, k::DOUBLE AS key, coalesce(nx, k)::DOUBLE AS next_key, NULL::INT AS missing FROM n WHERE r IN (0, 2, 4)",
    "archive_offsets": f"WITH {_N} SELECT r || '/' || k || '.txt' AS member, length(n_name) * (k + 1) AS size, sha256(repeat(n_name, k + 1)) AS sha256 FROM n WHERE r <> 3",
    "pickled_steps": f"WITH {_N}, o AS (SELECT r, bool_and(k % 4 <> 0) AS odd FROM n GROUP BY 1) SELECT r || '.pkl' AS member, i AS frame_index, round(i / 5.0, 6) AS t, k::DOUBLE AS key, 2::BIGINT AS width, odd FROM n JOIN o USING (r)",
    "layout_scan": f"WITH {_N} SELECT r::INT AS episode_index, c::INT AS num_frames, n_name AS task, 10.0::DOUBLE AS fps, round((c - 1) / 10.0, 6) AS duration_s, 'data/chunk-00' || (r // 3) || '/episode_00000' || r || '.parquet' AS path, true AS same_path, r <> 3 AS exists, true AS repository FROM n WHERE i = 0",
    "layout_frames": f"WITH {_N} SELECT r AS episode_index, i AS frame_index, k::DOUBLE AS state, coalesce(nx, k)::DOUBLE AS action FROM n WHERE r <> 3",
    "rewritten_tables": "SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 10 = 0 THEN 'laid over' ELSE lower(c_mktsegment) END AS c_mktsegment, 'key' AS unit FROM customer",
    "manifest_lines": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS o_orderstatus, o_totalprice::VARCHAR AS price FROM orders WHERE o_orderkey % 3 < 2",
}
