"""Language-model scoring: an interpolated modified Kneser-Ney n-gram model over whole words, of any order from 2.

Tokens are runs without ASCII white space, A-Z made small, and one end token a text. Words are 64-bit hashes throughout, and so are n-grams.

Counting is one Spark job of ``order`` shuffles. Tasks count the n-grams of their training texts and send them, summed, to shards by
the top bits of the n-gram's own hash, so that a frequent word burdens no shard. A shard task merges its n-grams, writes their counts to the shared
folder as sorted hash arrays, and sends on, summed, the sums of each context (the words before the last), and each suffix (the words after the first)
with the number of different words that stood before it. Shards of the next shuffle write the contexts' sums, merge the suffixes as n-grams of one order
less, and so on down to single words. The number of shards follows from the counted bytes of the training texts. Only counts of
counts reach the driver, a few numbers a shard.

Scoring reads every whole text once; workers memory-map the arrays and look up sorted batches of hashes. A shared folder that is
mounted is mapped in place; from any other store a worker copies shards to its own temporary folder first.

    p_k(w | v) = (c_k(v w) - D_k(c)) / c_k(v) + g_k(v) p_k-1(w | v')        p_1(w) = (t(w) - D_1(t)) / T + g_1 / (V + 1)

v: the k - 1 words before, v' without their first; c_k: training count at the highest order, below it the number of different words before; t(w): distinct
words before w, T: their sum, V: distinct training tokens, D_k: the three discounts of the modified method from the counts of counts of the order, g: the
mass they set free. A context never seen leaves the order below. Before a text stand as many begin marks as the order asks for.

Null texts are empty: they have the end token only. Rows whose ``train`` is null or false are scored but not learned from.
Repeated rows count each. Long texts are taken whole. Without training rows, as with an empty table, the model is uniform. Made columns win over input
columns of those names.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinetrail.llm import common as c

BEGIN, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: tokens that a task counts before it sends them on, and about as many a shard
_FLUSH, _SHARD = 1 << 21, 1 << 22
_ROWS = "shard int, parts array<binary>, sums array<bigint>"
#: shards of contexts are numbered from here on, those of n-grams from 0, rows of sums below 0
_CONTEXTS = 1 << 20


def tokens(buf: np.ndarray, offsets: np.ndarray, order: int = 2) -> tuple[list[np.ndarray], np.ndarray]:
    """The n-grams of the texts in a buffer, one for each token, as an array for each place (the last holds the tokens), and
    the number of tokens of each text."""
    starts, ends, first = c.words(buf, offsets)
    word = c.SpanHasher(_LOWER[buf])(starts, ends)
    token, n = np.insert(word, first[1:], END), np.diff(first) + 1
    place = np.arange(len(token)) - np.repeat(np.cumsum(n) - n, n)
    grams = [token]
    for back in range(1, order):
        before = np.full(len(token), BEGIN)
        before[back:] = token[: len(token) - back] if back < len(token) else token[:0]
        before[place < back] = BEGIN
        grams.insert(0, before)
    return grams, n


def gram_keys(words: list[np.ndarray]) -> np.ndarray:
    """One hash for each n-gram; a single word is its own."""
    key = words[0]
    for word in words[1:]:
        key = c.mix(key * np.uint64(0x9FB21C651E98DF25) + word)
    return key


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys and where each distinct one starts."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    return order, np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(key) else order[:0]


def _summed(words: list[np.ndarray], *counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Distinct n-grams by key, with their keys and summed counts."""
    key = gram_keys(words)
    order, at = _grouped(key)
    return key[order[at]], [w[order[at]] for w in words], [np.add.reduceat(n[order], at) if len(at) else n[:0] for n in counts]


def _cuts(values: np.ndarray, bits: int) -> np.ndarray:
    """Where sorted hashes pass from one shard to the next."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(values, edges), [len(values)]])


def _small(n: np.ndarray) -> np.ndarray:
    """Counts in as few bytes each as the largest needs."""
    most = int(n.max()) if len(n) else 0
    return n.astype(next(kind for size, kind in _KINDS.items() if most < 1 << 8 * size))


def _packed(n: np.ndarray) -> bytes:
    """Counts with the size of an item before them."""
    small = _small(n)
    return bytes([small.itemsize]) + small.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, _KINDS[raw[0]], offset=1).astype(np.int64)


def _dealt_grams(bits: int, key: np.ndarray, words: list[np.ndarray], counts: list[np.ndarray]) -> list[tuple]:
    """Rows of n-grams by shard, in the order of their first words: each of these once with its run, the other words, then counts."""
    if len(words) == 1:
        return _dealt(0, bits, key, words, counts)
    cut = _cuts(key, bits)
    rows = []
    for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
        if b > a:
            order, at = _grouped(words[0][a:b])
            runs = np.diff(np.append(at, b - a))
            rows.append((k, [words[0][a:b][order[at]].tobytes(), _packed(runs), *(w[a:b][order].tobytes() for w in words[1:]), *(_packed(n[a:b][order]) for n in counts)], None))
    return rows


def _gram_parts(table: pa.Table, size: int, counts: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The words and counts of all rows of a shard, each put together."""
    if size == 1:
        word, *n = _parts(table, 1, counts)
        return [word], n
    rows = table.column("parts").to_pylist()
    first = np.concatenate([np.repeat(np.frombuffer(r[0], np.uint64), _unpacked(r[1])) for r in rows])
    words = [np.concatenate([np.frombuffer(r[i], np.uint64) for r in rows]) for i in range(2, size + 1)]
    return [first, *words], [np.concatenate([_unpacked(r[i]) for r in rows]) for i in range(size + 1, size + 1 + counts)]


def _dealt(base: int, bits: int, key: np.ndarray, hashes: list[np.ndarray], counts: list[np.ndarray]) -> list[tuple]:
    """Rows of sorted keys by shard: hashes in eight bytes each, then counts."""
    cut = _cuts(key, bits)
    return [(base + k, [*(x[a:b].tobytes() for x in hashes), *(_packed(x[a:b]) for x in counts)], None) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64()))
    columns = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(columns, kinds, strict=True)], names=["shard", "parts", "sums"])


def _count(bits: int, order: int, text: str, train: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        waiting = 0

        def flush() -> pa.RecordBatch:
            words = [np.concatenate(x) for x in zip(*held, strict=True)]
            key, words, (n,) = _summed(words, np.ones(len(words[0]), np.int64))
            return _batch(_dealt_grams(bits, key, words, [n]))

        for batch in batches:
            batch = batch.filter(batch.column(train))
            for _, _, buf, offsets in c.byte_chunks(batch.column(text)):
                held.append(tokens(buf, offsets, order)[0])
                waiting += len(held[-1][0])
                if waiting >= _FLUSH:
                    yield flush()
                    held.clear()
                    waiting = 0
        if held:
            yield flush()
        held.clear()
        c.release()

    return run


def _parts(table: pa.Table, hashes: int, counts: int) -> list[np.ndarray]:
    """The parts of all rows of a shard, each put together."""
    rows = table.column("parts").to_pylist()
    return [np.concatenate([np.frombuffer(r[i], np.uint64) if i < hashes else _unpacked(r[i]) for r in rows]) for i in range(hashes + counts)]


def _merge(bits: int, folder: str, size: int, highest: bool):
    """One shard of n-grams of ``size`` words, or of the contexts of one word more. At the highest order the count is that of the text."""

    def contexts(shard: int, table: pa.Table) -> list[tuple]:
        key, *sums = _parts(table, 1, 4)
        order, at = _grouped(key)
        _write(folder, f"contexts{size + 1}-{shard}", [key[order[at]], *(_small(np.add.reduceat(x[order], at)) for x in sums)])
        return []

    def grams(shard: int, table: pa.Table) -> list[tuple]:
        words, counts = _gram_parts(table, size, 1 if highest else 2)
        del table
        key, words, counts = _summed(words, *counts)
        n, times = counts[0], counts[-1]
        _write(folder, f"grams{size}-{shard}", [key, _small(n), *([_small(times)] if size == 1 else [])])
        rows = [(-1 - shard, None, [size, len(n), int(n.sum()), *(int((n == k).sum()) for k in (1, 2, 3, 4)), int((n > 2).sum())])]
        if size > 1:
            context = gram_keys(words[:-1])
            order, at = _grouped(context)
            sums = [np.add.reduceat(x[order].astype(np.int64), at) for x in (n, n == 1, n == 2, n > 2)]
            rows += _dealt(_CONTEXTS, bits, context[order[at]], [context[order[at]]], sums)
            key, words, (before, times) = _summed(words[1:], np.ones(len(n), np.int64), times)
            rows += _dealt_grams(bits, key, words, [before, times])
        return rows

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        if shard < 0:
            return table.select(["shard", "parts", "sums"])
        rows = contexts(shard - _CONTEXTS, table) if shard >= _CONTEXTS else grams(shard, table)
        out = pa.Table.from_batches([_batch(rows)])
        del rows, table
        c.release()
        return out

    return run


# --- arrays in the shared folder -----------------------------------------------------------------


def _store(folder: str):
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def _write(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """One file: lengths and item sizes, then the arrays. Written aside and renamed, so a task that runs twice does no harm."""
    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    aside = f"{root}/.{name}-{uuid.uuid4().hex[:8]}"
    with store.open_output_stream(aside) as out:
        head = np.zeros(16, np.int64)
        head[: len(arrays)] = [len(a) for a in arrays]
        head[8 : 8 + len(arrays)] = [a.itemsize for a in arrays]
        out.write(head.tobytes())
        for a in sorted(range(len(arrays)), key=lambda k: -arrays[k].itemsize):
            out.write(memoryview(np.ascontiguousarray(arrays[a])).cast("B") if len(arrays[a]) else b"")
    store.move(aside, f"{root}/{name}")


_KINDS = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}


@lru_cache(maxsize=4096)
def _mapped(folder: str, name: str) -> tuple[np.ndarray, ...] | None:
    """The arrays of a file, memory-mapped; None if there is no such shard."""
    from pyarrow import fs

    store, root = _store(folder)
    path = f"{root}/{name}"
    if store.get_file_info(path).type == fs.FileType.NotFound:
        return None
    if isinstance(store, fs.LocalFileSystem):
        raw = np.memmap(path, np.uint8, "r")
    else:
        with tempfile.NamedTemporaryFile() as own:  # unlinked at once: the mapping alone keeps the copy
            with store.open_input_stream(path) as source:
                while block := source.read(1 << 24):
                    own.write(block)
            own.flush()
            raw = np.memmap(own.name, np.uint8, "r", shape=(os.path.getsize(own.name),))
    head = np.frombuffer(raw[:128].tobytes(), np.int64)
    count = int((head[8:] > 0).sum())
    arrays: list[np.ndarray] = [np.empty(0)] * count
    at = 128
    for k in sorted(range(count), key=lambda k: -head[8 + k]):
        stop = at + int(head[k] * head[8 + k])
        arrays[k] = raw[at:stop].view(_KINDS[int(head[8 + k])])
        at = stop
    return tuple(arrays)


def _lookup(folder: str, name: str, bits: int, wanted: np.ndarray, values: int) -> list[np.ndarray]:
    """The first ``values`` arrays beside the keys (0 where absent) of sorted distinct hashes."""
    out = [np.zeros(len(wanted)) for _ in range(values)]
    cut = _cuts(wanted, bits)
    for shard, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
        arrays = _mapped(folder, f"{name}-{shard}") if b > a else None
        if arrays is None or not len(arrays[0]):
            continue
        place = np.minimum(np.searchsorted(arrays[0], wanted[a:b]), len(arrays[0]) - 1)
        real = arrays[0][place] == wanted[a:b]
        for k, o in enumerate(out, 1):
            o[a:b][real] = arrays[k][place[real]]
    return out


# --- the model ------------------------------------------------------------------------------------


def discounts(counts: list[int]) -> np.ndarray:
    """[0, D1, D2, D3+] from the numbers of types seen once, twice, three and four times."""
    n1, n2, n3, n4 = counts
    if not n1:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.05), k) for k, d in enumerate(raw, 1))])


@dataclass(frozen=True)
class NgramModel:
    folder: str
    bits: int
    order: int
    tokens: int
    types: int
    #: distinct pairs of neighbouring words
    pair_types: int
    #: discounts by order, from 1
    discounts: tuple[np.ndarray, ...]
    word_free: float

    def log10(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability, training count of the token) of each token after the words before it."""
        word, back = np.unique(words[-1], return_inverse=True)
        before, count = (x[back] for x in _lookup(self.folder, "grams1", self.bits, word, 2))
        p = (before - self.discounts[0][np.minimum(before, 3).astype(int)]) / max(self.pair_types, 1) + self.word_free / (self.types + 1)
        for k in range(2, self.order + 1):
            keys, back = np.unique(gram_keys(words[-k:]), return_inverse=True)
            seen = _lookup(self.folder, f"grams{k}", self.bits, keys, 1)[0][back]
            context, back = np.unique(gram_keys(words[-k:-1]), return_inverse=True)
            total, one, two, more = (x[back] for x in _lookup(self.folder, f"contexts{k}", self.bits, context, 4))
            d, known = self.discounts[k - 1], total > 0
            total = np.where(known, total, 1)
            p = np.where(known, (seen - d[np.minimum(seen, 3).astype(int)]) / total + (d[1] * one + d[2] * two + d[3] * more) / total * p, p)
        return np.log10(p), count


def fit(docs: DataFrame, train: Column, text: str = "text", order: int = 3) -> NgramModel:
    """Counts the rows that ``train`` allows, all of them."""
    if order < 2:
        raise ValueError("the order must be 2 or more")
    spark = docs.sparkSession
    folder = c.new_path(spark, "ngrams")
    source = docs.select(docs[text].alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    size = source.where("train").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(16, max(2, (size // (6 * _SHARD)).bit_length()))
    rows = source.mapInArrow(_count(bits, order, "text", "train"), _ROWS)
    for k in range(order, 0, -1):
        rows = rows.groupBy("shard").applyInArrow(_merge(bits, folder, k, k == order), _ROWS)
    each = rows.where("sums IS NOT NULL").select(F.col("sums")[0].cast("int").alias("k"), F.posexplode("sums").alias("i", "n"))
    found = {k: [0] * 8 for k in range(1, order + 1)}
    for r in each.groupBy("k", "i").agg(F.sum("n").alias("n")).collect():
        found[r.k][r.i] = r.n
    # kind, types, sum of counts, types seen once, twice, three and four times, types seen more than twice
    d = tuple(discounts(found[k][3:7]) for k in range(1, order + 1))
    word = found[1]
    free = (d[0][1] * word[3] + d[0][2] * word[4] + d[0][3] * word[7]) / word[2] if word[2] else 1.0
    # every token ends one n-gram
    return NgramModel(folder, bits, order, found[order][2], word[1], word[2], d, free)


def score(docs: DataFrame, model: NgramModel, text: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """docs' columns ``keep`` (all by default) with n_tokens, n_known, train_tokens, base_score, score and perplexity."""
    made = [T.StructField(x, T.LongType()) for x in ("n_tokens", "n_known", "train_tokens")] + [T.StructField(x, T.DoubleType()) for x in ("base_score", "score", "perplexity")]
    names = {x.name for x in made}
    kept = [x for x in (docs.columns if keep is None else keep) if x not in names]
    source, body = c.carried(docs, kept, text)
    schema = T.StructType([docs.schema[x] for x in kept] + made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offsets in c.byte_chunks(body(batch), 2 << 20):
                words, n = tokens(buf, offsets, model.order)
                log, count = model.log10(words)
                at = np.concatenate([[0], np.cumsum(n)[:-1]])
                base = np.add.reduceat(np.log10((count + 1) / (model.tokens + model.types + 1)), at)
                total = np.add.reduceat(log, at)
                known = np.add.reduceat((count > 0).astype(np.int64), at)
                rows = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(k) for k in kept), pa.array(n.astype(np.int64)), pa.array(known), pa.array(np.full(j - i, model.tokens, np.int64)), pa.array(base), pa.array(total), pa.array(10.0 ** (-total / n))],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)
