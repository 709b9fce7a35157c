"""Benchmark decontamination: windows of a text within a bounded edit distance of a benchmark item.

Texts and items are word sequences (runs of ASCII letters, digits and non-ASCII bytes; A-Z and Latin-1 capitals made small).
An item of n words is leaked by a document when one of the document's windows, of any length, is at most e = floor(``edit_share`` * n) word
insertions, deletions and substitutions away from it (only n - e to n + e words can be that close).

1. Each edit breaks at most two pairs of neighbouring words, so a window within e edits holds n - 1 - 2 e of the pairs that items of n words
   have (where that number is not positive: n - e of their words). Starts of windows that hold fewer are passed over. This loses
   nothing, and its cost does not depend on the number of items. Neighbouring starts that stay form a run.
2. The CGK random walk embeds the windows of n words at these starts: at step j the walk writes the word it stands on and moves on if the random
   bit of (repeat, j, word) is set. Small edit distance becomes small Hamming distance.
3. Bit-sampling LSH: each repeat hashes the symbols at a few sampled steps, taken from a span that differs between repeats; a window that has
   an item's key is the source of a candidate. The number of repeats for each length is twice the least by which the share of trial pairs that
   met reaches ``recall``; trial pairs have the full number of edits, of mixed kinds, insertions, deletions or substitutions only. For a length
   whose trials do not reach it in ``max_repeats`` repeats, all starts of step 1 are candidates of all its items, and nothing is lost.
4. All starts of a run in which a candidate was met are verified: exact edit distances of the item to all windows that start there, which
   may run up to the end of the text.

Items are broadcast in blocks of at most ``block_words`` words; documents are read once, by the same tasks and without a
shuffle, and pass one block after the other. Item ids may be of any type. Null texts and null items have no words; an item without words leaks nowhere.
Repeated items with one id are variants of that item; items with a null id are not looked for. Repeated documents are judged each. Ties
of the edit count go to the earliest window, then the shortest. Empty tables give empty results; long texts are taken whole. The column named by ``into``
wins over an input column of that name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinetrail.llm import common as c

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass(frozen=True)
class LeakPolicy:
    edit_share: float = 0.2
    recall: float = 0.99
    #: sampled steps a repeat, and repeats beyond which a length is scanned instead
    samples: int = 3
    max_repeats: int = 200
    #: pairs by which the number of repeats is set
    trials: int = 100
    seed: int = 11
    block_words: int = 1_000_000

    def edits(self, n: int) -> int:
        return int(self.edit_share * n + 1e-9)


def normal_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the normalised words, and each text's first word."""
    small = buf.copy()
    small[(buf >= 65) & (buf <= 90)] += 32
    if len(buf) > 1:
        latin = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)
        small[1:][latin] += 32
    starts, ends, first = c.spans_where(_WORD[buf], offsets)
    return c.SpanHasher(small)(starts, ends), first


def walk_keys(windows: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """LSH keys by repeat and window: each repeat walks over every row of ``windows`` and hashes the symbols that stand at its
    row of ``steps``; beyond the end stands 0."""
    repeats, samples = steps.shape
    n, last = windows.shape[1], int(steps.max()) + 1
    salts = _salts(repeats, last)
    keys = np.empty((repeats, len(windows)), np.uint64)
    for block in range(0, len(windows), 128):
        part = windows[block : block + 128]
        flat = np.zeros((len(part), n + 1), np.uint64)
        flat[:, :n] = part
        flat = flat.ravel()
        base = np.arange(len(part)) * (n + 1)
        at = np.tile(base, (repeats, 1))
        stop = np.tile(base + n, (repeats, 1))
        seen = np.empty((last, repeats, len(part)), np.uint64)
        for j in range(last):
            here = seen[j] = flat[at]
            at += (((here ^ salts[:, j : j + 1]) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(63)).astype(np.int64)
            np.minimum(at, stop, out=at)
        key = np.full((repeats, len(part)), 0x51ED270B, np.uint64)
        rows = np.arange(repeats)
        for i in range(samples):
            key = c.mix(key * np.uint64(0x9FB21C651E98DF25) + seen[steps[:, i], rows])
        keys[:, block : block + 128] = key
    return keys


def _salts(repeats: int, steps: int) -> np.ndarray:
    return c.mix(np.arange(1, repeats + 1, dtype=np.uint64)[:, None] * np.uint64(1_000_003) + np.arange(steps, dtype=np.uint64))


def wide_matches(windows: np.ndarray, item: np.ndarray, e: int) -> np.ndarray:
    """For each window, the words that the item has at most e places away, or the words of the item that the window has
    so, whichever are fewer."""
    width, n = windows.shape[1], len(item)
    found, back = np.zeros(windows.shape, bool), np.zeros((len(windows), n), bool)
    for shift in range(-min(e, n - 1), min(e, width - 1) + 1):
        low, high = max(0, shift), min(width, n + shift)
        same = windows[:, low:high] == item[None, low - shift : high - shift]
        found[:, low:high] |= same
        back[:, low - shift : high - shift] |= same
    return np.minimum(found.sum(axis=1), back.sum(axis=1))


def prefix_distances(windows: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Levenshtein distances of the item to the first 0, 1, 2, ... symbols of each row."""
    step = np.arange(windows.shape[1] + 1, dtype=np.int32)
    row = np.tile(step, (len(windows), 1))
    for i, symbol in enumerate(item):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (windows != symbol))
        row = np.minimum.accumulate(new - step, axis=1) + step
    return row


def leak_type(item_key: T.DataType) -> T.StructType:
    numbers = [T.StructField(x, T.IntegerType()) for x in ("edits", "start_word", "n_words")]
    return T.StructType([T.StructField("item_id", item_key), *numbers])


def word_pairs(symbols: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring words."""
    return c.mix(symbols[:-1] * np.uint64(0x9FB21C651E98DF25) + symbols[1:])


def edited(item: np.ndarray, edits: int, kind: int, random: np.random.Generator) -> np.ndarray:
    """item after so many random edits; kind 0: mixed, 1: substitutions, 2: insertions, 3: deletions."""
    out = item.tolist()
    for _ in range(edits):
        what = kind or int(random.integers(1, 4))
        place, new = int(random.integers(max(1, len(out)))), int(random.integers(1, 1 << 62))
        if what == 2 or not out:
            out.insert(place, new)
        elif what == 1:
            out[place] = new
        else:
            del out[place]
    return np.array(out, np.uint64)


class LengthIndex:
    """LSH tables of the items of one length."""

    def __init__(self, members: list[int], sequences: list[np.ndarray], policy: LeakPolicy):
        self.members, self.n = members, len(sequences[members[0]])
        self.e = policy.edits(self.n)
        pairs = self.n - 1 - 2 * self.e
        #: a window's known pairs (or words) at least, and the places they may be spread over
        self.by_pairs = pairs > 0
        self.need, self.span = (pairs, self.n + self.e - 1) if self.by_pairs else (max(1, self.n - self.e), self.n + self.e)
        self.steps = self._plan([sequences[k] for k in members], policy)
        self.table: tuple[np.ndarray, np.ndarray] | None = None
        if self.steps is not None:
            keys = walk_keys(np.stack([sequences[k] for k in members]), self.steps)
            order = np.argsort(keys, axis=1)
            self.table = np.take_along_axis(keys, order, 1), np.array(members)[order]

    def _plan(self, items: list[np.ndarray], policy: LeakPolicy) -> np.ndarray | None:
        """Sampled steps of as many repeats as the target recall takes; None: out of reach."""
        n, e = self.n, self.e
        random = np.random.default_rng([policy.seed, n])
        widths = [2 * n >> k for k in range(2 * n) if 2 * n >> k > policy.samples] or [policy.samples + 1]
        steps = np.stack([random.integers(0, widths[r % len(widths)], policy.samples) for r in range(policy.max_repeats)])
        if not e:
            return steps[:1]
        left, right = [], []
        for i in range(policy.trials):
            item = items[i % len(items)]
            around = random.integers(1, 1 << 62, 2 * n + 2 * e + 4).astype(np.uint64)
            body = np.concatenate([around[:1], edited(item, e, i % 4, random), around[1:]])
            left.append(item)
            right += [body[k : k + n] for k in range(3)]
        own = walk_keys(np.stack(left), steps)
        met = (walk_keys(np.stack(right), steps).reshape(len(steps), policy.trials, 3) == own[:, :, None]).any(axis=2)
        share = np.maximum.accumulate(met, axis=0).mean(axis=1)
        enough = np.flatnonzero(share >= policy.recall)
        return steps[: 2 * (int(enough[0]) + 1)] if len(enough) else None

    def met(self, shown: np.ndarray) -> list[tuple[int, int]]:
        """(row of shown, item) of equal keys in any repeat."""
        if self.table is None:
            return [(w, k) for w in range(len(shown)) for k in self.members]
        out: set[tuple[int, int]] = set()
        for probe, known, owner in zip(walk_keys(shown, self.steps), *self.table, strict=True):
            low, high = np.searchsorted(known, probe, "left"), np.searchsorted(known, probe, "right")
            for w in np.flatnonzero(high > low).tolist():
                out.update((w, k) for k in owner[low[w] : high[w]].tolist())
        return sorted(out)


class ItemIndex:
    """LSH tables of a block of items. Built on the driver, sent to the workers."""

    def __init__(self, ids: list, sequences: list[np.ndarray], policy: LeakPolicy):
        self.ids, self.sequences = ids, sequences
        by_length: dict[int, list[int]] = defaultdict(list)
        for k, s in enumerate(sequences):
            by_length[len(s)].append(k)
        self.lengths = [LengthIndex(by_length[n], sequences, policy) for n in sorted(by_length)]
        self.known = {kind: self._vocabulary(kind) for kind in (True, False)}
        #: a symbol that no item has, for places beyond the end of a text
        taken = {int(x) for s in sequences for x in s}
        self.absent = next(x for x in range(len(taken) + 1) if x not in taken)

    def _vocabulary(self, by_pairs: bool) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]] | None:
        """Known pairs (or words), a table of their upper bits, and which of them each length has."""
        of = [np.unique(np.concatenate([word_pairs(self.sequences[k]) if by_pairs else self.sequences[k] for k in x.members])) for x in self.lengths if x.by_pairs == by_pairs]
        if not of:
            return None
        every = np.unique(np.concatenate(of))
        maybe = np.zeros(1 << 20, bool)
        maybe[(every >> np.uint64(44)).astype(np.int64)] = True
        return every, maybe, [np.isin(every, x, assume_unique=True) for x in of]

    def find(self, symbols: np.ndarray, first: np.ndarray) -> list[tuple[int, object, int, int, int]]:
        """(text, item, edits, start word, words) of the leaks in a chunk of texts, the best window of each text and item."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        text = c.owners(first)
        for by_pairs, known in self.known.items():
            if known is None or not len(symbols):
                continue
            every, maybe, has = known
            values = word_pairs(symbols) if by_pairs else symbols
            at = np.flatnonzero(maybe[(values >> np.uint64(44)).astype(np.int64)])
            if by_pairs:
                at = at[text[at] == text[at + 1]]
            place = np.minimum(np.searchsorted(every, values[at]), len(every) - 1)
            real = every[place] == values[at]
            at, place = at[real], place[real]
            for index, own in zip((x for x in self.lengths if x.by_pairs == by_pairs), has, strict=True):
                starts, run = runs_with(at[own[place]], index.need, index.span, text, first)
                if len(starts):
                    self._search(index, symbols, first[text[starts] + 1], starts, run, text, best)
        out: dict[tuple[int, object], tuple[int, int, int]] = {}
        for (t, k), (edits, p, size) in best.items():
            key, value = (t, self.ids[k]), (edits, p - int(first[t]), size)
            if key not in out or value < out[key]:
                out[key] = value
        return [(*key, *value) for key, value in out.items()]

    def _windows(self, symbols, starts, stops, width) -> np.ndarray:
        at = starts[:, None] + np.arange(width)
        shown = symbols[np.minimum(at, len(symbols) - 1)]
        shown[at >= stops[:, None]] = self.absent
        return shown

    def _search(self, index: LengthIndex, symbols, stops, starts, run, text, best) -> None:
        candidates: set[tuple[int, int]] = set()
        for block in range(0, len(starts), 2048):
            part = slice(block, block + 2048)
            candidates.update((int(run[block + w]), k) for w, k in index.met(self._windows(symbols, starts[part], stops[part], index.n)))
        n, e = index.n, index.e
        need = max(1, n - e)
        for r, k in sorted(candidates):
            low, high = np.searchsorted(run, r, "left"), np.searchsorted(run, r, "right")
            item = self.sequences[k]
            for block in range(low, high, 2048):
                part = slice(block, min(high, block + 2048))
                shown = self._windows(symbols, starts[part], stops[part], n + e)
                close = np.flatnonzero(wide_matches(shown, item, e) >= need)
                if not len(close):
                    continue
                far = prefix_distances(shown[close], item)[:, need:]
                far[np.arange(need, n + e + 1) > (stops[part] - starts[part])[close][:, None]] = n + e + 1
                size = far.argmin(axis=1)  # the shortest of equals
                least = far[np.arange(len(close)), size]
                for i in np.flatnonzero(least <= e).tolist():
                    p = int(starts[part][close[i]])
                    key, value = (int(text[p]), k), (int(least[i]), p, need + int(size[i]))
                    if key not in best or value < best[key]:
                        best[key] = value


def runs_with(at: np.ndarray, need: int, span: int, text: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts p of which the places p to p + span - 1 of one text hold ``need`` of the sorted places ``at``, and the run of each:
    starts that follow each other in one text."""
    none = np.empty(0, np.int64)
    if len(at) < need:
        return none, none
    low, high = at[: len(at) - need + 1], at[need - 1 :]
    good = (high - low < span) & (text[low] == text[high])
    low, high = low[good], high[good]
    if not len(low):
        return none, none
    begin = np.maximum(first[text[low]], high - span + 1)
    new = np.ones(len(low), bool)
    new[1:] = (begin[1:] > low[:-1] + 1) | (text[low[1:]] != text[low[:-1]])
    head = np.flatnonzero(new)
    begin, size = begin[head], low[np.append(head[1:], len(low)) - 1] + 1 - begin[head]
    run = np.repeat(np.arange(len(head)), size)
    return np.arange(len(run)) + np.repeat(begin - np.cumsum(size) + size, size), run


def item_blocks(items: DataFrame, key: str, text: str, policy: LeakPolicy) -> Iterator[ItemIndex]:
    """Indexes over blocks of items of bounded size, streamed to the driver in the order of their ids."""
    ids: list = []
    sequences: list[np.ndarray] = []
    held = 0
    for row in items.where(items[key].isNotNull()).select(items[key].alias("id"), items[text].alias("text")).orderBy("id", "text").toLocalIterator():
        raw = (row.text or "").encode()
        symbols, _ = normal_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        if not len(symbols):
            continue
        if held and held + len(symbols) > policy.block_words:
            yield ItemIndex(ids, sequences, policy)
            ids, sequences, held = [], [], 0
        ids.append(row.id)
        sequences.append(symbols)
        held += len(symbols)
    yield ItemIndex(ids, sequences, policy)


def with_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", into: str = "leaks", policy: LeakPolicy | None = None) -> DataFrame:
    """docs with the array column ``into``: (item_id, edits, start_word, n_words) for each leaked item, by item id."""
    policy = policy or LeakPolicy()
    spark = docs.sparkSession
    kept = [x for x in docs.columns if x != into]
    row, found = "__row__", "__found__"
    out = docs.select(F.struct(*[docs[x] for x in docs.columns]).alias(row), F.array().cast(T.ArrayType(leak_type(items.schema[item_key].dataType))).alias(found))
    schema = out.schema
    for index in item_blocks(items, item_key, item_text, policy):
        out = out.mapInArrow(_scan(spark.sparkContext.broadcast(index), text), schema)
    return out.select(*[F.col(row)[x].alias(x) for x in kept], F.array_sort(found).alias(into))


def _scan(shared, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for i, j, buf, offsets in c.byte_chunks(pc.struct_field(batch.column(0), text), 1 << 20):
                symbols, first = normal_words(buf, offsets)
                leaks: dict[int, list] = defaultdict(list)
                for t, item, edits, start, n in index.find(symbols, first):
                    leaks[t].append({"item_id": item, "edits": edits, "start_word": start, "n_words": n})
                rows = batch.slice(i, j - i)
                old = rows.column(1)
                if leaks:
                    old = pa.array([(old[t].as_py() or []) + leaks.get(t, []) for t in range(j - i)], old.type)
                yield pa.RecordBatch.from_arrays([rows.column(0), old], names=rows.schema.names)

    return run


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row for each document and leaked item."""
    source = docs.select(docs[key].alias("id"), docs[text].alias("text"))
    found = with_leaks(source, items, into="leaks", **options)
    return found.select("id", F.explode("leaks").alias("leak")).select(F.col("id").alias(key), "leak.*")


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of docs that leak no item."""
    mark = "leaks"
    while mark in docs.columns:
        mark += "_"
    return with_leaks(docs, items, text=text, into=mark, **options).where(F.size(mark) == 0).drop(mark)
