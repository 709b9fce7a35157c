"""Helpers shared by the corpus operators: shared-folder tables and vectorised byte work."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: ASCII white space: the characters that part words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


# --- tables in the folder that the whole cluster shares --------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset a new local one on a single machine, and an error on a cluster."""
    context = spark.sparkContext
    there = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not there:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        there = tempfile.mkdtemp(prefix="kinetrail-")
        context.setCheckpointDir(there)
    return there.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/kinetrail-{uuid.uuid4().hex[:12]}-{name}"
    _remove_at_exit(spark, path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """df as a table written to the shared folder: lineage ends here, and a lost executor costs no recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kinetrail_path = path
    return out


def unstage(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Deletes staged tables that no later plan reads."""
    for table in tables:
        path = table if isinstance(table, str) else getattr(table, "_kinetrail_path", None)
        if path:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    def remove() -> None:
        try:
            _delete(spark, path)
        except Exception:  # the session has ended; nothing can be asked of it
            pass

    atexit.register(remove)


# --- bytes, words and hashes -------------------------------------------------------------------


def carried(docs: DataFrame, kept: list[str], text: str):
    """docs with the columns ``kept`` and the text, which travels once, and the function that takes it from a batch.

    text may be the name of a column or, as top.field, of a field of a kept column."""
    top, _, field = text.partition(".")
    if text in kept:
        return docs.select(*[docs[x] for x in kept]), lambda batch: batch.column(text)
    if field and text not in docs.columns and top in kept:
        return docs.select(*[docs[x] for x in kept]), lambda batch: pc.struct_field(batch.column(top), field)
    held = "__text__"
    while held in kept:
        held += "_"
    return docs.select(*[docs[x] for x in kept], docs[text].alias(held)), lambda batch: batch.column(held)


_TRIM: list = []


def release() -> None:
    """Gives memory that Arrow and the allocator hold for later back to the system: workers live long and share a budget."""
    pa.default_memory_pool().release_unused()
    if not _TRIM:
        import ctypes

        _TRIM.append(getattr(ctypes.CDLL(None), "malloc_trim", None))
    if _TRIM[0] is not None:
        _TRIM[0](0)


def byte_chunks(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [i, j) of a string column as (i, j, bytes, offsets): about ``limit`` bytes each, always whole texts.

    Null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n, buffers = len(column), column.buffers()
    if not n:
        return
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1))
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j
    del column, data, buffers
    release()


def spans_where(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``solid`` bytes inside each text, and each text's first run (n + 1 values)."""
    n = len(solid)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    before = np.empty(n, bool)
    before[0], before[1:] = False, solid[:-1]
    before[offsets[offsets < n]] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, solid[1:]
    after[offsets[offsets > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    return starts, np.flatnonzero(solid & ~after) + 1, np.searchsorted(starts, offsets)


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without ASCII white space) of each text: starts, ends, each text's first word."""
    return spans_where(~SPACE[buf], offsets)


def lines(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each text as split at \\n, empty ones included: starts, ends, each text's first line.

    An empty text has one empty line, as str.split has."""
    breaks = np.flatnonzero(buf == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    owner = np.sort(np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1]), kind="stable")
    first = np.searchsorted(owner, np.arange(len(offsets)))
    ends = np.empty(len(starts), np.int64)
    if len(starts):
        ends[:-1] = starts[1:] - 1
        last = first[1:] - 1
        ends[last] = offsets[1:]
    return starts, ends, first


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        n = max(n, 1 << 20)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


class SpanHasher:
    """64-bit hashes of byte spans of one buffer: equal spans hash alike wherever they stand."""

    def __init__(self, buf: np.ndarray):
        power, self.inverse = _powers(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[: len(buf)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def gram_hashes(hasher: SpanHasher, n: int) -> np.ndarray:
    """Hashes of all n-byte substrings of the hasher's buffer."""
    m = len(hasher.sums) - n
    if m <= 0:
        return np.empty(0, np.uint64)
    out = hasher.sums[n:] - hasher.sums[:m]
    out *= hasher.inverse[:m]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the windows of n consecutive values; len(hashes) - n + 1 of them."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:m].copy()
    for k in range(1, n):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += hashes[k : k + m]
    return mix(out + np.uint64(n))


def window_rows(first: np.ndarray, n: int, m: int) -> np.ndarray:
    """Which of the m windows of n values lie inside one text; first: each text's first value."""
    inside = np.zeros(m + 1, np.int8)  # texts do not overlap, so the running sum is 0 or 1
    low, high = first[:-1], np.maximum(first[:-1], first[1:] - n + 1)
    keep = high > low
    np.add.at(inside, low[keep], 1)
    np.add.at(inside, np.minimum(high[keep], m), -1)
    return np.cumsum(inside[:-1], dtype=np.int8).astype(bool)


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each value."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def twice(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur at least twice; is this not its first occurrence."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    ranked = keys[order]
    same[1:-1] = ranked[1:] == ranked[:-1]
    often, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    often[order], later[order] = same[1:] | same[:-1], same[:-1]
    return often, later


def covered(at: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` values lie in a window of n values that starts at one of ``at``."""
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + n, total), -1)
    return np.cumsum(edge[:-1]) > 0


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values by text."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]
