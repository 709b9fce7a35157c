"""Scans of manifests, tables, episode layouts and result files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinetrail.functions.scalar import rate


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One object a line, strictly: a line that is no such object stops the scan. Blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def json_objects(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One object a file."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", True).json(path)


def parquet_columns(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame:
    """The wanted columns that the table has; absent ones are left out, and audits say so later."""
    found = spark.read.parquet(path)
    return found.select(*[found[f"`{x}`"] for x in wanted if x in found.columns])


def source_kind(uri: Column) -> Column:
    """How a source is read, by its address."""
    plain = F.lower(uri)
    return (
        F.when(plain.startswith("tar://") & plain.endswith(".parquet"), "tar_parquet")
        .when(plain.startswith("tar://") & plain.rlike(r"\.(h5|hdf5)$"), "tar_hdf5")
        .when(plain.startswith("tar://") & plain.rlike(r"\.(pkl|pickle)$"), "tar_pickle")
        .when(plain.endswith(".parquet"), "parquet")
        .when(plain.rlike(r"\.(h5|hdf5)$"), "hdf5")
        .otherwise("unknown")
    )


INFO = "robot_type string, fps double, chunks_size int, codebase_version string, total_episodes int, total_frames int, data_path string, video_path string, features map<string, struct<dtype: string, shape: array<int>, names: array<string>, info: map<string, string>>>"
EPISODES = "episode_index int, length int, tasks array<string>"


def episode_layout(spark: SparkSession, root: str) -> DataFrame:
    """Episodes of a repository with meta/info.json and meta/episodes.jsonl: length, rate, tasks, data path, features."""
    info = json_objects(spark, f"{root}/meta/info.json", INFO)
    episodes = json_lines(spark, f"{root}/meta/episodes.jsonl", EPISODES)
    both = episodes.crossJoin(F.broadcast(info))  # info is one row
    chunk = F.floor(F.col("episode_index") / F.greatest(F.coalesce("chunks_size", F.lit(1000)), F.lit(1))).cast("int")
    path = F.concat(F.lit("data/chunk-"), F.lpad(chunk.cast("string"), 3, "0"), F.lit("/episode_"), F.lpad(F.col("episode_index").cast("string"), 6, "0"), F.lit(".parquet"))
    return both.select("episode_index", F.col("length").alias("num_frames"), "tasks", "robot_type", "fps", "features", F.concat(F.lit(root.rstrip("/") + "/"), path).alias("data_uri"), F.greatest(F.lit(0.0), (F.col("length") - 1) / F.col("fps")).alias("duration_s"))


def cameras(episodes: DataFrame) -> DataFrame:
    """A row for each camera feature: those of dtype video or with a codec."""
    each = episodes.select("episode_index", F.explode(F.map_entries("features")).alias("f"))
    codec = F.try_element_at("f.value.info", F.lit("video.codec"))
    wide = each.where((F.col("f.value.dtype") == "video") | codec.isNotNull())
    names, shape = F.col("f.value.names"), F.col("f.value.shape")

    def size(name: str) -> Column:
        return F.get(shape, (F.array_position(names, name) - 1).cast("int"))

    return wide.select("episode_index", F.col("f.key").alias("source_key"), size("height").alias("height"), size("width").alias("width"), codec.alias("codec"), rate(F.try_element_at("f.value.info", F.lit("video.fps"))).alias("fps"))


def episode_frames(spark: SparkSession, root: str, columns: list[str]) -> DataFrame:
    """All frames of the layout with their episode number from the file name."""
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "episode_*.parquet").parquet(f"{root}/data")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"episode_(\d+)", 1).cast("int")
    return found.select(number.alias("episode_index"), *[found[f"`{x}`"] for x in columns if x in found.columns])


def layout_problems(episodes: DataFrame, frames: DataFrame, vector: str) -> DataFrame:
    """(problem, episode_index) of a strict reading: index twice or negative, row count that differs, values that are not finite, widths that vary."""
    twice = episodes.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("duplicate_index").alias("problem"), "episode_index")
    negative = episodes.where("episode_index < 0").select(F.lit("negative_index").alias("problem"), "episode_index")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    seen = frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("rows"), F.max(F.size(vector)).alias("w1"), F.min(F.size(vector)).alias("w0"), F.bool_or(bad).alias("bad"))
    both = episodes.join(seen, "episode_index", "left")
    checks = F.array_compact(F.array(F.when(F.coalesce("rows", F.lit(0)) != F.col("num_frames"), F.lit("row_count")), F.when(F.col("bad"), F.lit("not_finite")), F.when(F.col("w0") != F.col("w1"), F.lit("ragged"))))
    return twice.unionByName(negative).unionByName(both.select(F.explode(checks).alias("problem"), "episode_index"))


def step_records(spark: SparkSession, path: str, schema: str, rank: int | None = None) -> DataFrame:
    """Evaluation results named step_<n>_rank_<r>.json with their step and rank."""
    found = spark.read.schema(schema).option("multiLine", True).json(path)
    name = r"step_(\d+)_rank_(\d+)\.json$"
    out = found.select("*", F.regexp_extract("_metadata.file_name", name, 1).try_cast("bigint").alias("step"), F.regexp_extract("_metadata.file_name", name, 2).try_cast("int").alias("rank")).where("step IS NOT NULL")
    return out if rank is None else out.where(F.col("rank") == rank)


def last_rate(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): the last line of each text file that is a number in [0, 1]."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.split("value", "\n").alias("lines"))
    numbers = F.filter(F.transform("lines", lambda x: F.trim(x).try_cast("double")), lambda x: x.between(0, 1))
    return whole.select("file", F.try_element_at(numbers, F.lit(-1)).alias("value"))


def complete_checkpoints(files: DataFrame, required: list[str], below: int | None = None) -> DataFrame:
    """The greatest complete checkpoint step of each run. files: (run, path) as <run>/step_<n>/<file>; null names are ignored."""
    step = F.regexp_extract("path", r"step_(\d+)/", 1).try_cast("bigint")
    rows = files.select("run", step.alias("step"), F.element_at(F.split("path", "/"), -1).alias("name")).where("step IS NOT NULL")
    if below is not None:
        rows = rows.where(F.col("step") < below)
    done = rows.groupBy("run", "step").agg(F.collect_set("name").alias("have")).where(F.size(F.array_except(F.array(*[F.lit(x) for x in required]), F.col("have"))) == 0)
    return done.groupBy("run").agg(F.max("step").alias("step"))
