"""Archives as Python data sources: members of tar files, read by offset, and step lists in restricted pickles.

A partition of the scan is an archive; members are read in the order they lie in it. The reader opens plain local paths and
whatever pyarrow's file systems reach, so archives may lie in a shared store."""

from __future__ import annotations

import io
import pickle
import re
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from kinetrail.shipping import ship


def opened(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    if "://" not in path:
        return open(path, "rb")
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def split_uri(uri: str) -> tuple[str, str]:
    """Archive and member of tar://archive!member."""
    archive, mark, member = uri.removeprefix("tar://").partition("!")
    if not mark or not archive or not member:
        raise ValueError(f"no member address: {uri}")
    return archive, member


class Archive(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class TarReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = [x for x in options.get("paths", "").split("\n") if x]
        self.pattern = re.compile(options.get("pattern", ""))
        self.payload = options.get("payload", "true").lower() == "true"

    def partitions(self) -> list[Archive]:
        return [Archive(p) for p in self.paths]

    def read(self, partition: Archive) -> Iterator[tuple]:
        with opened(partition.path) as raw, tarfile.open(fileobj=raw, mode="r|*") as tar:
            for member in tar:
                if member.isfile() and self.pattern.search(member.name):
                    data = tar.extractfile(member).read() if self.payload else None
                    yield partition.path, member.name, member.offset_data, member.size, data


class TarSource(DataSource):
    """spark.read.format("tar_members").option("paths", newline-joined).option("pattern", regex).option("payload", "false")."""

    @classmethod
    def name(cls) -> str:
        return "tar_members"

    def schema(self) -> str:
        return "archive string, member string, offset bigint, size bigint, payload binary"

    def reader(self, schema) -> TarReader:
        return TarReader(dict(self.options))


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(TarSource)


def tar_members(spark: SparkSession, paths: list[str], pattern: str = "", payload: bool = True):
    """(archive, member, offset, size, payload) of the files of archives, compressed or not."""
    register(spark)
    return spark.read.format("tar_members").option("paths", "\n".join(paths)).option("pattern", pattern).option("payload", str(payload).lower()).load()


def members_by_offset(members, payloads: str = "payload", span: int = 1 << 28):
    """members (archive, offset, size) with payloads read by seeking; for uncompressed archives whose index is known.

    Tasks take stretches of ``span`` bytes, so one large archive is read by many."""
    from pyspark.sql import functions as F

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, object] = {}
            out = []
            try:
                for archive, offset, size in zip(*(batch.column(k).to_pylist() for k in ("archive", "offset", "size")), strict=True):
                    source = held.get(archive) or held.setdefault(archive, opened(archive))
                    source.seek(offset)
                    out.append(source.read(size))
            finally:
                for source in held.values():
                    source.close()
            yield pa.RecordBatch.from_arrays([batch.column("archive"), batch.column("member"), pa.array(out, pa.binary())], names=["archive", "member", payloads])

    return members.select("archive", "member", "offset", "size").repartition("archive", F.floor(F.col("offset") / span)).sortWithinPartitions("archive", "offset").mapInArrow(run, f"archive string, member string, {payloads} binary")


class StepUnpickler(pickle.Unpickler):
    """Allows containers, numbers, text and numpy arrays; nothing that could run."""

    # The names that numpy arrays and scalars need.
    ALLOWED = {
        ("numpy", "dtype"),
        ("numpy", "ndarray"),
        ("numpy.core.multiarray", "_reconstruct"),
        ("numpy.core.multiarray", "scalar"),
        ("numpy._core.multiarray", "_reconstruct"),
        ("numpy._core.multiarray", "scalar"),
        ("numpy._core.numeric", "_frombuffer"),
        ("numpy.core.numeric", "_frombuffer"),
        ("collections", "OrderedDict"),
    }

    def find_class(self, module: str, name: str):
        if (module, name) not in self.ALLOWED:
            raise pickle.UnpicklingError(f"{module}.{name} is not allowed")
        return super().find_class(module, name)


def load_steps(payload: bytes) -> list[dict]:
    steps = StepUnpickler(io.BytesIO(payload)).load()
    if isinstance(steps, dict):
        steps = steps.get("steps", [])
    if not isinstance(steps, list):
        raise ValueError("no list of steps")
    return steps


def _nested(step: dict, key: str):
    for part in key.split("."):
        if not isinstance(step, dict) or part not in step:
            return None
        step = step[part]
    return step


def pickled_frames(members, keys: list[str], fps: float):
    """(archive, member, frame_index, t, values map) of step pickles; a key that any step lacks is left out, t is index / fps."""
    import numpy as np

    kind = pa.map_(pa.string(), pa.list_(pa.float64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for archive, member, payload in zip(*(batch.column(k).to_pylist() for k in ("archive", "member", "payload")), strict=True):
                steps = load_steps(payload)
                have = [k for k in keys if steps and all(_nested(s, k) is not None for s in steps)]
                for i, step in enumerate(steps):
                    found = [(k, [float(x) for x in np.atleast_1d(_nested(step, k)).ravel()]) for k in have]
                    for out, value in zip(rows, (archive, member, i, i / fps, found), strict=True):
                        out.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.float64()), pa.array(rows[4], kind)],
                names=["archive", "member", "frame_index", "t", "signals"],
            )

    return members.select("archive", "member", "payload").mapInArrow(run, "archive string, member string, frame_index bigint, t double, signals map<string, array<double>>")
