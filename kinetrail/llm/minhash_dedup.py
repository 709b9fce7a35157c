"""Near-duplicates by improved consistent weighted sampling over TF-IDF word shingles.

A text is its set of five-word shingles (a text of one to four words is one shingle), each weighted by its count in the
text times an inverse document frequency, ln(1 + N / max(df, smooth_share * N)) for N documents: one smoothed formula at every
size of the input. A shingle in no more than ``smooth_share`` of the documents has the full factor, so only shingles beyond it need a count of
their own; there are at most (mean shingles of a document) / smooth_share of them, whatever the size of the corpus, and they are counted
exactly: tasks report what is in more than half that share of a block of their documents, sums of the reports name a bounded
superset, a second pass counts those.

Improved consistent weighted sampling draws (r, c, beta) for each shingle and each of rows * bands samples from tables of quantiles
and keeps the shingle and its quantised weight with the least a = c / exp(r (t - beta + 1)); equal samples have the probability of
weighted Jaccard similarity. ``rows`` samples make a band; texts with an equal band share a bucket. A pair at similarity 0.8 shares
one with probability 1 - (1 - 0.8 ** 5) ** 18 = 0.9992.

Rows never grow with the pairs of a group. Both steps below give each group to a task, which searches it and returns the links of a
spanning forest: a member is compared with those that no tree holds yet, so n members give n - 1 links at most and no link is lost.

1. Candidates: in each bucket, members whose samples agree in at least ``similarity`` less ``slack`` standard errors (one pair in
   three millions at the similarity asked for has fewer). Connected components of these links are the groups of step 2.
2. Classes: each text of a group is shingled again and sent once; members are compared by exact weighted Jaccard similarity
   of their shingles (64-bit hashes, exact counts). Classes are connected components of these links.

A group beyond its bound (``bucket_size`` members, ``group_shingles`` shingles) is cut into parts by the hash of the text. A few members, the hubs,
are added to every part. Where the links of the parts leave more than one class, every two parts meet in a block, so that all pairs
across classes are compared whatever the size: n members cost (number of parts - 1) rows each there, which grows with the square of
a group that stays apart.

Equal texts are one vertex from the start, so copies cost one row a task. Null text is the empty text; texts without words are near
only to equal texts. class_id is the least doc_id of the class (null if all are null). Repeated rows share a class. An empty table gives an
empty result. Long texts are taken whole; one text is held in a task at least. Other columns pass through; ``class_id`` wins over an input column
of that name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetrail.llm import common as c
from kinetrail.llm.graph import components

#: rows of digests (some 80 bytes each) that are broadcast; beyond it they are joined by shuffle
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class NearPolicy:
    words: int = 5
    similarity: float = 0.8
    rows: int = 5
    bands: int = 18
    smooth_share: float = 0.01
    slack: float = 5.0
    bucket_size: int = 1500
    group_shingles: int = 1 << 19
    hubs: int = 4
    #: shingles that a task gathers before it reports what is common among them, and documents at least
    block: int = 1 << 21
    block_docs: int = 256

    @property
    def least(self) -> int:
        """Equal samples that a candidate pair has at least."""
        n, p = self.rows * self.bands, self.similarity
        return max(1, int(np.floor(n * p - self.slack * np.sqrt(n * p * (1 - p)))))


@dataclass(frozen=True)
class Common:
    """Sorted shingles of large document frequency and their factors."""

    shingles: np.ndarray
    factors: np.ndarray

    def weigh(self, shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
        weight = count.astype(np.float64)
        if len(self.shingles):
            place = np.minimum(np.searchsorted(self.shingles, shingle), len(self.shingles) - 1)
            known = self.shingles[place] == shingle
            weight[known] *= self.factors[place[known]]
        return weight


def shingles(buf: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of distinct shingles, by text and shingle."""
    starts, ends, first = c.words(buf, offsets)
    word = c.SpanHasher(buf)(starts, ends)
    grams = c.rolling(word, n)
    at = np.flatnonzero(c.window_rows(first, n, len(grams)))
    owner = np.repeat(np.arange(len(first) - 1), np.maximum(np.diff(first) - n + 1, 0))
    value = grams[at]
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < n))
    if len(few):
        short = [c.mix(np.bitwise_xor.reduce(c.mix(word[first[t] : first[t + 1]] + np.arange(first[t + 1] - first[t], dtype=np.uint64)), keepdims=True))[0] for t in few]
        owner, value = np.concatenate([owner, few]), np.concatenate([value, np.array(short, np.uint64)])
    if len(few) or len(value) < 64 * (len(first) - 1):
        order = np.lexsort((value, owner))
        owner, value = owner[order], value[order]
    else:  # few and long texts: sorted one by one
        value = value.copy()
        cuts = np.searchsorted(owner, np.arange(len(first)))
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            value[i:j].sort()
    new = np.ones(len(value), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return owner[at], value[at], np.diff(np.append(at, len(value)))


# --- document frequencies ---------------------------------------------------------------------


def _reports(policy: NearPolicy, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = docs = 0

        def report() -> pa.RecordBatch:
            value, n = np.unique(np.concatenate(held), return_counts=True)
            often = n > share / 2 * docs
            return pa.RecordBatch.from_arrays([pa.array(value[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["shingle", "n"])

        for batch in batches:
            for i, j, buf, offsets in c.byte_chunks(batch.column("text")):
                value = shingles(buf, offsets, policy.words)[1]
                held.append(value)
                size, docs = size + len(value), docs + j - i
                if size >= policy.block and docs >= policy.block_docs:
                    yield report()
                    held, size, docs = [], 0, 0
        if size:
            yield report()

    return run


def _exact(policy: NearPolicy, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for _, _, buf, offsets in c.byte_chunks(batch.column("text")):
                value = shingles(buf, offsets, policy.words)[1]
                place = np.minimum(np.searchsorted(wanted, value), len(wanted) - 1)
                total += np.bincount(place[wanted[place] == value], minlength=len(wanted))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[at].view(np.int64)), pa.array(total[at])], names=["shingle", "n"])

    return run


def common_shingles(docs: DataFrame, text: str, policy: NearPolicy) -> Common:
    """All shingles whose document frequency lowers their weight, with factors from exact frequencies over all documents.

    Factors are relative to that of a shingle in no more than ``smooth_share`` of the documents."""
    n = docs.count()
    share = policy.smooth_share
    source = docs.select(docs[text].alias("text"))
    reports = source.mapInArrow(_reports(policy, share), "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    # sums of at least half the share: at most 2 / share times the mean number of shingles of a document
    often = reports.where((F.col("n") >= share / 2 * n) & (F.col("n") > 1)).select("shingle").toArrow()
    wanted = np.sort(often.column("shingle").to_numpy().view(np.uint64))
    if not len(wanted):
        return Common(np.empty(0, np.uint64), np.empty(0))
    exact = source.mapInArrow(_exact(policy, docs.sparkSession.sparkContext.broadcast(wanted)), "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = exact.where(F.col("n") > max(1.0, share * n)).toArrow()
    shingle, df = rows.column("shingle").to_numpy().view(np.uint64), rows.column("n").to_numpy().astype(np.float64)
    order = np.argsort(shingle)
    return Common(shingle[order], np.log1p(n / df[order]) / np.log1p(n / max(1.0, share * n)))


# --- signatures ---------------------------------------------------------------------------------


def _gamma2_quantiles() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at 65,536 even steps, by Newton's method on its distribution function."""
    u = (np.arange(65536) + 0.5) / 65536
    x = np.where(u < 0.5, np.sqrt(2 * u), 2 - np.log1p(-u))
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - u) / np.maximum(x * np.exp(-x), 1e-300), 1e-9)
    return x


class Sampler:
    """Improved consistent weighted sampling with tables: 65,536 quantiles of c, 256 each of r and beta."""

    #: shingles worked on at a time: their values stay in the processor's cache
    SLICE = 1 << 14

    def __init__(self, samples: int):
        fine = _gamma2_quantiles()
        self.log_c = np.log(fine).astype(np.float32)
        r, beta = fine[128::256], (np.arange(256) + 0.5) / 256
        self.r, self.beta = np.repeat(r, 256).astype(np.float32), np.tile(beta, 256).astype(np.float32)
        self.drop = self.r * (1 - self.beta)  # weight 1: t is 0
        self.seeds = c.mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def __call__(self, owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int) -> np.ndarray:
        """Samples by text, as 32-bit values; rows of texts without shingles are all alike."""
        out = np.full((texts, len(self.seeds)), np.inf, np.float32)
        for low in range(0, len(owner), self.SLICE):
            part, held = shingle[low : low + self.SLICE], owner[low : low + self.SLICE]
            at = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
            whose = held[at]
            odd = np.flatnonzero(weight[low : low + self.SLICE] != 1)
            log_weight = np.log(weight[low : low + self.SLICE][odd]).astype(np.float32)
            best = np.empty((len(at), len(self.seeds)), np.float32)
            x = np.empty(len(part), np.uint64)
            quarters = x.view(np.uint16).reshape(-1, 4)
            for k, seed in enumerate(self.seeds):
                np.multiply(part, seed, out=x)
                i, j = quarters[:, 3].astype(np.intp), quarters[:, 2].astype(np.intp)
                a = self.log_c.take(i, mode="clip")
                a -= self.drop.take(j, mode="clip")
                if len(odd):
                    r, beta = self.r[j[odd]], self.beta[j[odd]]
                    a[odd] = self.log_c[i[odd]] - r * (np.floor(log_weight / r + beta) - beta + 1)
                best[:, k] = np.minimum.reduceat(a, at)
            out[whose] = np.minimum(out[whose], best)
        return out.view(np.uint32)


def _signatures(policy: NearPolicy, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(policy.rows * policy.bands)
        for batch in batches:
            for i, j, buf, offsets in c.byte_chunks(batch.column("text")):
                owner, value, count = shingles(buf, offsets, policy.words)
                samples = sampler(owner, value, common.value.weigh(value, count), j - i)
                keys = np.empty((j - i, policy.bands), np.uint64)
                for b in range(policy.bands):
                    key = np.full(j - i, b + 1, np.uint64)
                    for k in range(b * policy.rows, (b + 1) * policy.rows):
                        key = c.mix(key * np.uint64(0x9FB21C651E98DF25) + samples[:, k].astype(np.uint64))
                    keys[:, b] = key
                some = np.zeros(j - i, bool)
                some[owner] = True
                length = np.where(some, policy.bands, 0)
                cuts = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(keys[some].ravel().view(np.int64)))
                rows = batch.slice(i, j - i)
                short = (c.mix(samples.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8)
                signs = pa.array([x.tobytes() for x in short], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column("v"), rows.column("id"), lists, signs], names=["v", "id", "bands", "sign"])

    return run


def _weighed(policy: NearPolicy, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offsets in c.byte_chunks(batch.column("text")):
                owner, value, count = shingles(buf, offsets, policy.words)
                weight = common.value.weigh(value, count)
                cut = np.searchsorted(owner, np.arange(j - i + 1)).tolist()
                spans = list(zip(cut[:-1], cut[1:], strict=True))
                plain = np.add.reduceat(np.append(weight != 1, False), cut[:-1]) == 0 if spans else []
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.slice(i, j - i).column("v"),
                        pa.array([value[a:b].tobytes() for a, b in spans], pa.binary()),
                        pa.array([b"" if p else weight[a:b].tobytes() for p, (a, b) in zip(plain, spans, strict=True)], pa.binary()),
                        pa.array([b - a for a, b in spans], pa.int64()),
                    ],
                    names=["v", "s", "w", "size"],
                )

    return run


# --- links of a group ---------------------------------------------------------------------------

Near = Callable[[int, np.ndarray], np.ndarray]


def spanning(n: int, near: Near, label: np.ndarray | None = None, part: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links of a spanning forest of the members 0 to n - 1; ``near(i, others)`` says which others are linked to i.

    Members of equal label hang together already, and only members of different parts are compared, where given."""
    left = np.ones(n, bool)
    links: list[tuple[int, int]] = []
    for start in range(n):
        stack = [start] if left[start] else []
        left[start] = False
        while stack:
            i = stack.pop()
            if label is not None:
                same = np.flatnonzero(left & (label == label[i]))
                left[same] = False
                stack.extend(same.tolist())
            others = np.flatnonzero(left if part is None else left & (part != part[i]))
            if len(others):
                hit = others[near(i, others)]
                left[hit] = False
                stack.extend(hit.tolist())
                links += [(i, j) for j in hit.tolist()]
    return links


def near_samples(signs: np.ndarray, least: int) -> Near:
    """Members whose samples agree in ``least`` or more."""
    return lambda i, others: (signs[others] == signs[i]).sum(axis=1) >= least


def near_sets(values: list[np.ndarray], weights: list[np.ndarray], limit: float) -> Near:
    """Members whose weighted Jaccard similarity is ``limit`` or more; each has distinct shingles and their weights."""
    size = np.array([len(x) for x in values])
    first = np.concatenate([[0], np.cumsum(size)])
    _, ids = np.unique(np.concatenate(values), return_inverse=True)
    flat = np.concatenate(weights)
    total = np.add.reduceat(flat, first[:-1])
    mine = np.zeros(int(ids.max()) + 1)

    def near(i: int, others: np.ndarray) -> np.ndarray:
        # the similarity is at most the ratio of the totals
        fits = np.minimum(total[others], total[i]) >= limit * np.maximum(total[others], total[i]) * (1 - 1e-12)
        some = others[fits]
        if not len(some):
            return fits
        own = slice(first[i], first[i + 1])
        mine[ids[own]] = flat[own]
        cut = np.concatenate([[0], np.cumsum(size[some])])
        if 2 * cut[-1] > first[some[-1] + 1] - first[some[0]]:  # all from the first to the last
            span = slice(first[some[0]], first[some[-1] + 1])
            shared = np.add.reduceat(np.minimum(mine[ids[span]], flat[span]), first[some[0] : some[-1] + 1] - first[some[0]])[some - some[0]]
        else:
            at = np.arange(cut[-1]) + np.repeat(first[some] - cut[:-1], size[some])
            shared = np.add.reduceat(np.minimum(mine[ids[at]], flat[at]), cut[:-1])
        mine[ids[own]] = 0
        out = fits.copy()
        out[fits] = shared >= limit * (total[some] + total[i] - shared) * (1 - 1e-12)
        return out

    return near


def _by_samples(policy: NearPolicy) -> Callable[[pa.Table], Near]:
    return lambda rows: near_samples(np.stack([np.frombuffer(x, np.uint8) for x in rows.column("sign").to_pylist()]), policy.least)


def _by_sets(policy: NearPolicy) -> Callable[[pa.Table], Near]:
    def build(rows: pa.Table) -> Near:
        values = [np.frombuffer(x, np.uint64) for x in rows.column("s").to_pylist()]
        weights = [np.frombuffer(x) if x else np.ones(len(s)) for x, s in zip(rows.column("w").to_pylist(), values, strict=True)]
        return near_sets(values, weights, policy.similarity)

    return build


LINK = "a binary, b binary"


def _forests(build: Callable[[pa.Table], Near]):
    """The links of all groups of a bin of rows (group, v, and optionally label and part, and what ``build`` reads)."""

    def run(table: pa.Table) -> pa.Table:
        a, b = [], []
        table = table.combine_chunks().sort_by("group")
        group = table.column("group").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(group)]]).tolist()
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if j - i > 1:
                rows = table.slice(i, j - i)
                v = rows.column("v").to_pylist()
                label = np.unique(np.array([x.hex() for x in rows.column("label").to_pylist()]), return_inverse=True)[1] if "label" in rows.column_names else None
                part = rows.column("part").to_numpy() if "part" in rows.column_names else None
                found = spanning(j - i, build(rows), label, part)
                a += [v[x] for x, _ in found]
                b += [v[y] for _, y in found]
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _binned(members: DataFrame, bins: int, build) -> DataFrame:
    return members.withColumn("bin", F.pmod(F.xxhash64("group"), F.lit(bins))).groupBy("bin").applyInArrow(_forests(build), LINK)


def _parts(bound: int) -> tuple[F.Column, F.Column]:
    """The parts of half the bound that a group of ``total`` is cut into, three or more, and a member's part."""
    parts = F.greatest(F.ceil(F.col("total") / max(1, bound // 2)), F.lit(3)).cast("bigint")
    return parts, F.pmod(F.xxhash64("v"), parts)


def _blocks(members: DataFrame, bound: int) -> DataFrame:
    """members (group, total, v and others) of over-full groups in blocks, one for each two parts: all pairs of different parts meet."""
    parts, part = _parts(bound)
    others = F.filter(F.sequence(F.lit(0).cast("bigint"), parts - 1), lambda q: q != part)
    placed = members.select("*", part.alias("part"), F.explode(others).alias("other"))
    block = F.xxhash64("group", F.least("part", "other"), F.greatest("part", "other"))
    return placed.withColumn("group", block).drop("total", "other")


def _linked(members: DataFrame, bound: int, build, policy: NearPolicy) -> DataFrame:
    """Links (a, b), staged, that leave no two near members of a group apart; members: (group, v, size and what ``build`` reads)."""
    sizes = members.groupBy("group").agg(F.sum("size").alias("total"))
    every, largest = sizes.agg(F.sum("total"), F.max("total")).first()
    if every is None:
        return c.staged(members.select(F.col("v").alias("a"), F.col("v").alias("b")).limit(0), "links")
    bins = int(-(-every // bound))
    if largest <= bound:
        return c.staged(_binned(members.drop("size"), bins, build), "links")
    over = c.staged(sizes.where(F.col("total") > bound), "over-full")
    small = _binned(members.join(over, "group", "left_anti").drop("size"), bins, build)
    full = c.staged(members.join(over, "group").drop("size"), "full")
    parts, part = _parts(bound)
    placed = full.select("*", part.alias("part"))
    first = [F.min(F.struct(F.xxhash64(F.lit(k), "v"), F.col("v").alias("hub"))).alias(f"h{k}") for k in range(policy.hubs)]
    hubs = full.groupBy("group").agg(*first).select("group", F.explode(F.array_distinct(F.array(*[f"h{k}.hub" for k in range(policy.hubs)]))).alias("v"))
    spread = placed.join(hubs, ["group", "v"]).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("to")).where("to <> part")
    ready = placed.unionByName(spread.drop("part").withColumnRenamed("to", "part")).withColumn("group", F.xxhash64("group", "part")).drop("total", "part")
    links = c.staged(small.unionByName(ready.groupBy("group").applyInArrow(_forests(build), LINK)), "links")
    labels = components(links)
    known = full.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))
    mixed = known.groupBy("group").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("group")
    rest = _blocks(known.join(mixed, "group", "left_semi"), bound).groupBy("group").applyInArrow(_forests(build), LINK)
    return c.staged(links.unionByName(rest), "links")


# --- classes -------------------------------------------------------------------------------------


def _vertex(text) -> F.Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _few(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def text_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", policy: NearPolicy | None = None) -> DataFrame:
    """(v, label) of the distinct texts that are near another text; v: digest of the text."""
    policy = policy or NearPolicy()
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, text, policy))
    source = docs.select(_vertex(docs[text]).alias("v"), F.xxhash64(docs[key]).alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    # id: of the rows with equal text, those whose hashed key is least stand for it
    signed = source.mapInArrow(_signatures(policy, common), "v binary, id bigint, bands array<bigint>, sign binary")
    signed = c.staged(signed.groupBy("v").agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("sign").alias("sign")), "signatures")
    banded = signed.select(F.explode("bands").alias("group"), "v")  # signatures stay behind until few rows are left
    crowded = banded.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group")
    close = c.staged(banded.join(crowded, "group"), "close")
    chosen = c.staged(close.select("v").distinct().join(signed.select("v", "id", "sign"), "v"), "chosen")
    members = close.join(chosen.select("v", "sign"), "v").select("group", "v", F.lit(1).cast("bigint").alias("size"), "sign")
    groups = components(_linked(c.staged(members, "members"), policy.bucket_size, _by_samples(policy), policy))

    own = c.staged(groups.select("v").join(chosen.select("v", F.col("id").alias("own")), "v"), "own")
    texts = source.join(_few(own, own.count()), "v").where(F.col("id") == F.col("own")).select("v", "text")
    sets = texts.mapInArrow(_weighed(policy, common), "v binary, s binary, w binary, size bigint").dropDuplicates(["v"])
    grouped = sets.join(groups, "v").select(F.xxhash64("label").alias("group"), "v", "size", "s", "w")
    return components(_linked(c.staged(grouped, "sets"), policy.group_shingles, _by_sets(policy), policy))


def _members(docs: DataFrame, text: str, key: str, policy: NearPolicy | None) -> DataFrame:
    """(v, id, label): the least key of each distinct text and the label of its class; made of ids and digests only."""
    labels = text_classes(docs, text, key, policy)
    ids = docs.select(docs[key].alias("id"), _vertex(docs[text]).alias("v")).groupBy("v").agg(F.min("id").alias("id"))
    return c.staged(ids.join(labels, "v", "left").select("v", "id", F.coalesce("label", "v").alias("label")), "class-ids")


def classify(docs: DataFrame, text: str = "text", key: str = "doc_id", policy: NearPolicy | None = None) -> DataFrame:
    """docs with ``class_id``, the least ``key`` of the rows whose texts are linked."""
    ids = _members(docs, text, key, policy)
    kept = [x for x in docs.columns if x != "class_id"]
    least = ids.groupBy("label").agg(F.min("id").alias("class_id"))
    named = ids.join(least, "label").select("v", "class_id")
    rows = docs.select(F.struct(*[docs[x] for x in kept]).alias("row"), _vertex(docs[text]).alias("v"))
    return rows.join(named, "v").select(*[F.col("row")[x].alias(x) for x in kept], "class_id")


def representatives(docs: DataFrame, text: str = "text", key: str = "doc_id", policy: NearPolicy | None = None) -> DataFrame:
    """One row of each class, that of the least ``key`` (null last) and, among texts that share it, the least digest; of equal rows with
    one key the one with the least content."""
    ids = _members(docs, text, key, policy)
    first = ids.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "v")).alias("x")).select("x.v", F.col("x.id").alias("own"))
    rows = docs.select(F.struct(*[docs[x] for x in docs.columns]).alias("row"), docs[key].alias("id"), _vertex(docs[text]).alias("v"))
    # texts move once, at every size: the kept digests grow with the documents
    found = rows.join(first, "v").where(F.col("id").eqNullSafe(F.col("own")))
    unique = rows.groupBy("v", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    if not unique:  # only then texts move
        found = found.withColumn("content", F.to_json("row")).groupBy("v").agg(F.min_by("row", "content").alias("row"))
    return found.select("row.*")
