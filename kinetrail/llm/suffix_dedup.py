"""Exact substring dedup by external induced suffix sorting.

Every byte of a text that is covered by a string of ``length`` bytes which also starts anywhere else in the corpus is removed;
strings never cross texts, overlaps count, and all strings are judged on the input.

The suffixes are sorted in shards. Equal strings must meet in one shard, so shards are dealt by content:

1. The anchor of a string of ``length`` bytes is its ``gram``-byte substring with the least hash, the leftmost of equals.
   Equal strings have equal anchors at equal places. Neighbouring strings with one anchor form a stretch; a text has
   about 2 / (length - gram + 2) stretches a byte.
2. Stretches are counted by (anchor, content) with partial sums in each task, so copies and hot passages cost a row a task.
   Of an anchor with one stretch in all nothing is repeated; a content that occurs twice is repeated as a whole.
3. One copy of each different content of the remaining anchors goes to the anchor's shard. There ``external_sais`` sorts all
   suffixes of the shard by induction, with queues on disk and common prefixes carried along; neighbours that share
   ``length`` bytes mark their strings.
4. An anchor whose contents exceed ``anchor_bytes`` (a phrase in many surroundings) is divided before it is dealt: a string holds its
   anchor at one offset, and all strings whose offset lies in a range share the bytes about the anchor that each of them covers.
   Halving the range widens these bytes, from the anchor itself up to the whole string, so equal strings stay together while others part.
   Ranges are halved where a group is still too large; a range of one offset holds a single string, so every group ends up bounded.
5. Marks return to all stretches by (anchor, content), are united by text, and the covered bytes are cut out.

Two strings of one shard never meet by chance: marks come from compared bytes. Content and anchor keys are 64 bits each; a text
is known by two 64-bit hashes, of its key and of itself; a null key is a key like others, so its texts lose and give as any do. Null texts are empty. Texts shorter than ``length`` lose nothing. Repeated rows are
copies of each other. Other columns pass through; the made columns win over input columns of those names.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinetrail.llm import common as c
from kinetrail.llm.external_sais import suffix_lcp

_SPANS = "array<struct<start:bigint,stop:bigint>>"


@dataclass(frozen=True)
class SubstringPolicy:
    length: int = 200
    gram: int = 40
    #: bytes of stretches in a shard, about
    shard_bytes: int = 2 << 20
    #: bytes of different stretches of one anchor (or part of an anchor) beyond which it is divided
    anchor_bytes: int = 1 << 20
    #: ids of texts up to which a filter is broadcast
    broadcast_ids: int = 1_500_000
    #: bytes of a queue run in memory before it goes to disk
    run_memory: int = 32 << 20


def stretches(buf: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, stop, anchor, content) of the stretches in a buffer; start and stop in the buffer."""
    none = np.empty(0, np.int64)
    n = len(buf) - length + 1
    if n <= 0:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hasher = c.SpanHasher(buf)
    grams = c.gram_hashes(hasher, gram)
    least = grams & np.uint64(0xFFFFFFFF00000000)
    least |= np.arange(len(grams), dtype=np.uint64)
    wide, span = length - gram + 1, 1
    while span < wide:
        step = min(span, wide - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    start = np.flatnonzero(c.window_rows(offsets, length, n))
    anchor = least.astype(np.uint32)[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    if not len(first):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    begin, stop = start[first], start[np.append(first[1:], len(start)) - 1] + length
    return np.searchsorted(offsets, begin, "right") - 1, begin, stop, grams[anchor[first]], hasher(begin, stop)


def repeated_spans(contents: list[bytes], length: int, memory: int) -> list[list[tuple[int, int]]]:
    """For each content the maximal runs covered by strings of ``length`` bytes that start twice or more among all contents."""
    sizes = np.array([len(x) for x in contents], np.int64)
    # UTF-8 has no byte above 0xF4, so bytes plus 2 leave room for 1, which parts contents, and 0, which ends the text
    text = np.ones(int(sizes.sum()) + len(contents) + 1, np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    for b, x in zip(begin, contents, strict=False):
        text[b : b + len(x)] = np.frombuffer(x, np.uint8) + 2
    text[-1] = 0
    order, common = suffix_lcp(text, 247, cap=length, memory=memory)
    left = np.zeros(len(text), np.int64)
    owner = np.repeat(np.arange(len(contents)), sizes + 1)
    left[: len(owner)] = begin[1:][owner] - 1 - np.arange(len(owner))
    same = common >= length
    twice = same.copy()
    twice[:-1] |= same[1:]
    starts = np.sort(order[twice])
    starts = starts[left[starts] >= length]
    out: list[list[tuple[int, int]]] = [[] for _ in contents]
    if len(starts):
        who = owner[starts]
        new = np.concatenate([[True], (who[1:] != who[:-1]) | (starts[1:] > starts[:-1] + length)])
        at = np.flatnonzero(new)
        ends = starts[np.append(at[1:], len(starts)) - 1] + length
        for w, a, b in zip(who[at].tolist(), starts[at].tolist(), ends.tolist(), strict=True):
            out[w].append((a - int(begin[w]), b - int(begin[w])))
    return out


def _stretch_rows(policy: SubstringPolicy, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offsets in c.byte_chunks(batch.column("text"), 1 << 19):
                text, begin, stop, anchor, content = stretches(buf, offsets, policy.length, policy.gram)
                if not len(text):
                    continue
                which = pa.array(text + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(which), batch.column("h").take(which), pa.array(begin - offsets[text]), pa.array(stop - begin), pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64))], names=names
                )

    return run


def _cut_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the stretches wanted from each text."""
    for batch in batches:
        text = batch.column("text").cast(pa.binary())
        keys: list[tuple] = []
        for raw, wanted in zip(text, batch.column("wanted").to_pylist(), strict=True):
            raw = raw.as_py()
            keys += [(x["shard"], x["a"], x["c"], raw[x["start"] : x["start"] + x["n"]]) for x in wanted]
        shard, a, k, content = zip(*keys, strict=True) if keys else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(a, pa.int64()), pa.array(k, pa.int64()), pa.array(content, pa.binary())], names=["shard", "a", "c", "content"])


def _sorted_shard(policy: SubstringPolicy):
    def run(table: pa.Table) -> pa.Table:
        spans = repeated_spans(table.column("content").to_pylist(), policy.length, policy.run_memory)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        found = pa.array([[{"start": a, "stop": b} for a, b in x] for x in spans], kind)
        out = pa.Table.from_arrays([table.column("a"), table.column("c"), found], names=["a", "c", "spans"])
        c.release()
        return out.filter(pa.array([bool(x) for x in spans]))

    return run


_PIECE = "a bigint, c bigint, at bigint, p bigint, low bigint, high bigint, k bigint, d bigint, content binary"


def _key(head: bytes, body: bytes) -> int:
    return struct.unpack("<q", hashlib.blake2b(head + body, digest_size=8).digest())[0]


def anchor_place(content: bytes, anchor: int, length: int, gram: int) -> int:
    """Where the anchor of a stretch stands in it: its first place that all strings of the stretch cover."""
    grams = c.gram_hashes(c.SpanHasher(np.frombuffer(content, np.uint8)), gram).view(np.int64)
    first = len(content) - length
    return first + int(np.flatnonzero(grams[first:] == anchor)[0])


def halves(content: bytes, p: int, low: int, high: int, length: int) -> Iterator[tuple[int, int, int, int, int, int, bytes]]:
    """The parts of a stretch whose strings hold the anchor (at p) at an offset in the lower and in the upper half of [low, high].

    (place in content, place of the anchor, low, high, group, key in the group, bytes); equal strings come into equal groups."""
    middle = (low + high) // 2
    for below, above in ((low, middle), (middle + 1, high)):
        first, last = max(0, p - above), min(len(content) - length, p - below)
        if below > above or first > last:
            continue
        part, place = content[first : last + length], p - first
        shared = part[place - below : place - above + length]  # what every string of the range covers
        yield first, place, below, above, _key(struct.pack("<qq", below, above), shared), _key(struct.pack("<q", place), part), part


def _pieces(policy: SubstringPolicy, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for i in range(0, len(rows), 4096):
                made = []
                for row in rows[i : i + 4096]:
                    p = row["p"]
                    if p is None:
                        p = anchor_place(row["content"], row["a"], policy.length, policy.gram)
                    for place, *rest in halves(row["content"], p, row["low"], row["high"], policy.length):
                        made.append((row["a"], row["c"], row["at"] + place, *rest))
                kinds = [pa.int64()] * 8 + [pa.binary()]
                columns = zip(*made, strict=True) if made else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names=names)

    return run


def divided(contents: DataFrame, policy: SubstringPolicy) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Divides the contents (a, c, content) of over-full anchors until every group is within ``anchor_bytes``.

    Each level gives marks (a, c, spans) of the pieces that occur twice as a whole, and the groups that are now small enough, as
    rows (k, a, c, at, content, times). A content goes on by one of its copies, whose marks stand for it where it occurs once."""
    names = [x.split()[0] for x in _PIECE.split(", ")]
    state = contents.select("a", "c", "content", *[F.lit(x).cast("bigint").alias(n) for n, x in (("at", 0), ("p", None), ("low", 0), ("high", policy.length - policy.gram))])
    while True:
        pieces = c.staged(state.select("a", "c", "at", "p", "low", "high", "content").mapInArrow(_pieces(policy, names), _PIECE), "pieces")
        one = pieces.groupBy("k", "d").agg(F.count(F.lit(1)).alias("times"), F.first(F.struct("a", "c", "at", "p", "low", "high", "content")).alias("one"))
        one = c.staged(one.select("k", "d", "times", "one.*"), "kinds")
        groups = one.groupBy("k").agg(F.count(F.lit(1)).alias("kinds"), F.sum("times").alias("all"), F.sum(F.length("content")).alias("bytes")).where("all > 1")
        one = one.join(groups, "k")
        whole = pieces.join(one.where("times > 1").select("k", "d"), ["k", "d"])
        span = F.array(F.struct(F.col("at").alias("start"), (F.col("at") + F.length("content")).alias("stop"))).cast(_SPANS)
        small = one.where((F.col("kinds") > 1) & (F.col("bytes") <= policy.anchor_bytes)).select("k", "a", "c", "at", "content", "times")
        yield whole.select("a", "c", span.alias("spans")), small
        state = one.where((F.col("kinds") > 1) & (F.col("bytes") > policy.anchor_bytes))
        if state.isEmpty():
            return


def _only(rows: DataFrame, ids: DataFrame, keys: list[str], limit: int, count: int, kind: str) -> DataFrame:
    """rows with (or without) a key among ids; a filter of counted size is broadcast so that other rows stay where they are."""
    return rows.join(F.broadcast(ids) if count <= limit else ids, keys, kind)


def _shard(key: str, total: int, policy: SubstringPolicy):
    return F.pmod(F.xxhash64(key), F.lit(max(1, -(-total // policy.shard_bytes)))).alias("shard")


def _contents(source: DataFrame, kinds: DataFrame, total: int, policy: SubstringPolicy) -> DataFrame:
    """(shard, a, c, content): the bytes of one place of each content."""
    wanted = kinds.select("one.id", "one.h", F.struct(_shard("a", total, policy), "a", "c", "one.start", "one.n").alias("w"))
    wanted = c.staged(wanted.groupBy("id", "h").agg(F.collect_list("w").alias("wanted")), "wanted")
    texts = _only(source.where(F.col("text") != ""), wanted.select("id", "h"), ["id", "h"], policy.broadcast_ids, wanted.count(), "left_semi")
    found = texts.join(wanted, ["id", "h"]).mapInArrow(_cut_contents, "shard bigint, a bigint, c bigint, content binary")
    # a repeated row would hand its contents in twice
    return found.groupBy("shard", "a", "c").agg(F.first("content").alias("content")) if _repeats(source) else found


def _sorted(contents: DataFrame, policy: SubstringPolicy) -> DataFrame:
    return contents.groupBy("shard").applyInArrow(_sorted_shard(policy), f"a bigint, c bigint, spans {_SPANS}")


def covered_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", policy: SubstringPolicy | None = None) -> DataFrame:
    """(id, h, spans): the covered runs of each text that has any, possibly overlapping; id and h are xxhash64 of key and text."""
    policy = policy or SubstringPolicy()
    source = docs.select(F.xxhash64(docs[key]).alias("id"), F.coalesce(docs[text], F.lit("")).alias("text")).select("id", F.xxhash64("text").alias("h"), "text")
    schema = T.StructType([source.schema["id"], *(T.StructField(x, T.LongType()) for x in ("h", "start", "n", "a", "c"))])
    rows = c.staged(source.mapInArrow(_stretch_rows(policy, schema.names), schema), "stretches")
    kinds = rows.groupBy("a", "c").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("id", "h", "start", "n")).alias("one"))
    several = kinds.groupBy("a").agg(F.count(F.lit(1)).alias("kinds"), F.sum("times").alias("all"), F.sum("one.n").alias("bytes")).where("all > 1")
    kinds = c.staged(kinds.join(several, "a").select("a", "c", "times", "one", "kinds", "bytes"), "contents")
    marks = kinds.where("times > 1").select("a", "c", F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("one.n").alias("stop"))).cast(_SPANS).alias("spans"))
    crowded = F.col("bytes") > policy.anchor_bytes
    total, over = kinds.where("kinds > 1").agg(F.sum(F.when(~crowded, F.col("one.n"))), F.sum(F.when(crowded, F.col("one.n")))).first()
    if total:
        contents = _contents(source, kinds.where("kinds > 1").where(~crowded), total, policy)
        partly = _sorted(contents, policy).join(kinds.where("times > 1").select("a", "c"), ["a", "c"], "left_anti")
        marks = marks.unionByName(c.staged(partly, "marks"))
    if over:
        contents = c.staged(_contents(source, kinds.where("kinds > 1").where(crowded), over, policy).select("a", "c", "content"), "crowded")
        for whole, small in divided(contents, policy):
            small = c.staged(small.withColumn("no", F.monotonically_increasing_id()), "groups")
            size = small.agg(F.sum(F.length("content"))).first()[0]
            marks = marks.unionByName(whole)
            if size:
                spans = _sorted(small.select(_shard("k", size, policy), F.col("k").alias("a"), F.col("no").alias("c"), "content"), policy)
                found = spans.select(F.col("c").alias("no"), "spans").join(small.where("times = 1").select("no", "a", "c", "at"), "no")
                moved = F.transform("spans", lambda x: F.struct((x["start"] + F.col("at")).alias("start"), (x["stop"] + F.col("at")).alias("stop")))
                marks = marks.unionByName(c.staged(found.select("a", "c", moved.cast(_SPANS).alias("spans")), "marks"))
    placed = rows.join(marks, ["a", "c"]).select("id", "h", "start", F.explode("spans").alias("x")).select("id", "h", (F.col("start") + F.col("x.start")).alias("start"), (F.col("start") + F.col("x.stop")).alias("stop"))
    return placed.groupBy("id", "h").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def _repeats(source: DataFrame) -> bool:
    return not source.groupBy("id", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def _cut(raw: bytes, spans) -> tuple[bytes, int, int]:
    """The bytes outside the spans, how many are inside, and in how many maximal runs."""
    kept, removed, runs, at = [], 0, 0, 0
    reach = -1
    for a, b in sorted((x["start"], x["stop"]) for x in spans or ()):
        if a > reach:
            kept.append(raw[at:a])
            runs += 1
            removed += b - a
            reach = b
        elif b > reach:
            removed += b - reach
            reach = b
        at = reach
    kept.append(raw[at:])
    return b"".join(kept), removed, runs


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", policy: SubstringPolicy | None = None, digests: bool = False) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans and, in ``kept``, the remaining bytes (or with ``digests`` their SHA-256 in kept_sha256,
    in which case only ``key`` stays of the other columns)."""
    policy = policy or SubstringPolicy()
    spans = c.staged(covered_spans(docs, text, key, policy), "spans")
    n = spans.count()
    made = ["n_bytes", "n_removed", "n_spans", "kept_sha256" if digests else "kept"]
    columns = [x for x in docs.columns if x not in made]
    row = F.struct(docs[key].alias("k")) if digests else F.struct(*[docs[x] for x in columns])
    source = docs.select(row.alias("row"), F.xxhash64(docs[key]).alias("id"), F.coalesce(docs[text], F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ids = spans.select("id", "h")
    if n <= policy.broadcast_ids:  # only texts that lose something are moved
        touched = source.join(F.broadcast(ids), ["id", "h"], "left_semi").join(spans, ["id", "h"])
        same = source.join(F.broadcast(ids), ["id", "h"], "left_anti").withColumn("spans", F.lit(None).cast(_SPANS))
        both = touched.unionByName(same)
    else:
        both = source.join(spans, ["id", "h"], "left")
    kind = T.StringType() if digests else T.BinaryType()
    schema = T.StructType([both.schema["row"], *(T.StructField(x, T.LongType()) for x in made[:3]), T.StructField(made[3], kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for raw, found in zip(batch.column("text").cast(pa.binary()), batch.column("spans"), strict=True):
                raw = raw.as_py()
                rest, removed, runs = _cut(raw, found.as_py())
                for x, y in zip(out, (len(raw), removed, runs, hashlib.sha256(rest).hexdigest() if digests else rest), strict=True):
                    x.append(y)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string() if digests else pa.binary())], names=["row", *made]
            )

    result = both.select("row", "text", "spans").mapInArrow(run, schema)
    return result.select(F.col("row.k").alias(key), *made) if digests else result.select(*[F.col("row")[x].alias(x) for x in columns], *made)
