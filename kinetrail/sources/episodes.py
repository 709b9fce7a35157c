"""Episodes out of archives and repositories: members as tables, members by episode, discovery, versions and unified reads."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinetrail.operators.materialize import read_with_derived
from kinetrail.operators.selection import stop_where
from kinetrail.shipping import ship
from kinetrail.sources import archives, files


def parquet_members(members: DataFrame, schema: T.StructType | str) -> DataFrame:
    """(archive, member, row and the schema's columns) of members that are Parquet files; columns that a member lacks are null, others are not read.

    members: (archive, member, payload). A member is read whole by one task."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out = T.StructType([T.StructField("archive", T.StringType()), T.StructField("member", T.StringType()), T.StructField("row", T.LongType()), *wanted.fields])
    ship(members.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(out)
        for batch in batches:
            for archive, member, payload in zip(*(batch.column(k).to_pylist() for k in ("archive", "member", "payload")), strict=True):
                file = pq.ParquetFile(io.BytesIO(payload))
                have = [f.name for f in wanted.fields if f.name in file.schema_arrow.names]
                at = 0
                for part in file.iter_batches(columns=have):
                    n = part.num_rows
                    columns = [pa.array([archive] * n, pa.string()), pa.array([member] * n, pa.string()), pa.array(range(at, at + n), pa.int64())]
                    columns += [part.column(f.name).cast(kinds.field(f.name).type) if f.name in have else pa.nulls(n, kinds.field(f.name).type) for f in wanted.fields]
                    yield pa.RecordBatch.from_arrays(columns, schema=kinds)
                    at += n

    return members.select("archive", "member", "payload").mapInArrow(run, out)


def by_episode(members: DataFrame, pattern: str = r"^([^/]+)/") -> DataFrame:
    """members with ``episode_id``, the first group of the pattern in the member's name; members that do not match are left out."""
    found = F.regexp_extract("member", pattern, 1)
    return members.withColumn("episode_id", F.nullif(found, F.lit(""))).where("episode_id IS NOT NULL")


def listed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(path, length) of the files below a folder whose names fit a pattern; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(root)
    return found.select("path", "length")


def repositories(spark: SparkSession, root: str) -> DataFrame:
    """(repository) of every folder below root with meta/info.json."""
    found = listed(spark, root, "info.json").where(F.col("path").endswith("/meta/info.json"))
    return found.select(F.regexp_replace("path", "/meta/info\\.json$", "").alias("repository"))


def templated(template: Column, chunk_size: Column, episode: Column) -> Column:
    """A path of a template with {episode_chunk:03d} and {episode_index:06d}, of any width."""
    chunk = F.floor(episode / F.greatest(F.coalesce(chunk_size, F.lit(1000)), F.lit(1))).cast("string")
    out = template
    for name, value in (("episode_chunk", chunk), ("episode_index", episode.cast("string"))):
        width = F.coalesce(F.nullif(F.regexp_extract(out, r"\{" + name + r":0(\d+)d\}", 1), F.lit("")).cast("int"), F.lit(0))
        shown = F.when(width > F.length(value), F.lpad(value, width, "0")).otherwise(value)
        out = F.regexp_replace(out, F.lit(r"\{" + name + r"(:0\d+d)?\}"), shown)
    return out


def strict_layout(spark: SparkSession, root: str, version: str = "v2") -> DataFrame:
    """Episodes of a repository of one major version; the query fails for any other, and so it does for an episode index that is negative or there twice."""
    info = files.json_objects(spark, f"{root}/meta/info.json", files.INFO).select("codebase_version", "total_episodes")
    episodes = files.episode_layout(spark, root).crossJoin(F.broadcast(info))  # one row
    episodes = stop_where(episodes, ~F.col("codebase_version").startswith(version), F.concat(F.lit("not supported: layout "), F.col("codebase_version")))
    twice = episodes.groupBy("episode_index").agg(F.count(F.lit(1)).alias("__n__"))
    checked = stop_where(episodes.join(twice, "episode_index"), (F.col("__n__") > 1) | (F.col("episode_index") < 0), F.lit("episode index twice or negative"))
    return checked.drop("__n__", "codebase_version", "total_episodes")


def with_existing(episodes: DataFrame, found: DataFrame, uri: str = "data_uri") -> DataFrame:
    """episodes with ``exists``: is there a file at the address? found: (path) of a listing."""
    plain = lambda c: F.regexp_replace(F.regexp_replace(c, "^file:/+", "/"), "/{2,}", "/")
    there = found.select(plain(F.col("path")).alias("__p__"), F.lit(True).alias("__e__")).distinct()
    both = episodes.withColumn("__p__", plain(F.col(uri))).join(there, "__p__", "left")
    return both.withColumn("exists", F.coalesce("__e__", F.lit(False))).drop("__p__", "__e__")


def read_layout(spark: SparkSession, root: str, columns: list[str], derived: list[dict] = (), order: str = "frame_index") -> DataFrame:
    """All frames of a repository with derived columns: the wanted columns that exist, by episode."""
    sources = [d["source"] for d in derived]
    frames = files.episode_frames(spark, root, list(dict.fromkeys([order, *columns, *sources])))
    return read_with_derived(frames, ["episode_index"], order, list(derived), columns)


def read_archives(spark: SparkSession, paths: list[str], schema: str, columns: list[str], derived: list[dict] = (), pattern: str = r"([^/]+)\.parquet$") -> DataFrame:
    """The same for archives of Parquet members, one an episode: of a member that several archives hold, the first archive's."""
    first = {p: i for i, p in enumerate(paths)}
    members = by_episode(archives.tar_members(spark, paths, pattern=r"\.parquet$"), pattern)
    place = F.create_map(*[F.lit(x) for pair in first.items() for x in pair])
    chosen = members.groupBy("episode_id").agg(F.min_by(F.struct("archive", "member"), F.try_element_at(place, "archive")).alias("x")).select("episode_id", "x.*")
    frames = parquet_members(members.join(chosen, ["episode_id", "archive", "member"]), schema).join(chosen, ["archive", "member"])
    return read_with_derived(frames.drop("archive", "member"), ["episode_id"], "row", list(derived), columns)


#: scans by kind of source: (spark, root or paths, options) to a catalogue or frames
ADAPTERS: dict[str, Callable[..., DataFrame]] = {
    "layout": files.episode_layout,
    "layout_strict": strict_layout,
    "layout_frames": read_layout,
    "archive_members": archives.tar_members,
    "archive_frames": read_archives,
    "manifest": files.json_lines,
    "repositories": repositories,
    "step_results": files.step_records,
    "text_results": files.last_rate,
}


def scan(spark: SparkSession, kind: str, *args, **options) -> DataFrame:
    """A scan by its name; a name that is not known is an error."""
    if kind not in ADAPTERS:
        raise ValueError(f"unknown source: {kind}; known: {sorted(ADAPTERS)}")
    return ADAPTERS[kind](spark, *args, **options)
