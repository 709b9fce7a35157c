"""Quality rules: how much of a text repeats itself.

Words are runs without ASCII white space. For each n-gram length the characters of words inside n-grams that occurred
earlier in the same text are measured against the characters of all words; whole lines likewise. The n-grams are hashed
by rolling 64-bit hashes in numpy, a chunk of whole texts at a time.

Null texts have no words. Texts without words fail. A text longer than a chunk is a chunk of its own. Repeated rows
are judged each on its own, so alike. Output columns win over input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kinetrail.llm import common as c

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class RepetitionPolicy:
    """Limits beyond which a text is rejected."""

    min_words: int = 10
    window: int = 5
    max_repeat_percent: int = 20
    #: n-gram length -> largest share of word characters inside n-grams seen before in the text
    max_ngram_share: dict[int, float] = field(default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})
    max_dup_line_share: float = 0.30
    max_dup_line_chars: float = 0.20


def measure(buf: np.ndarray, offsets: np.ndarray, policy: RepetitionPolicy) -> dict[str, np.ndarray]:
    """All measures and verdicts of the texts in one buffer."""
    starts, ends, first = c.words(buf, offsets)
    owner = c.owners(first)
    points = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=points[1:])
    chars = points[ends] - points[starts]
    hasher = c.SpanHasher(buf)
    word = hasher(starts, ends)
    seed = c.mix(owner.astype(np.uint64) + np.uint64(1))
    out = {"n_words": np.diff(first), "word_chars": c.per_text(chars, first)}
    symbols = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_SYMBOL[buf], out=symbols[1:])
    out["n_symbols"] = symbols[offsets[1:]] - symbols[offsets[:-1]]

    line_start, line_end, line_first = c.lines(buf, offsets)
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_owner = c.owners(line_first)
    key = hasher(line_start, line_end) ^ c.mix(line_owner.astype(np.uint64) + np.uint64(1))
    later = np.zeros(len(key), bool)
    later[has_word] = c.twice(key[has_word])[1]
    out["n_dup_lines"] = c.per_text(later, line_first)
    n_lines = c.per_text(has_word, line_first)
    word_sums = np.concatenate([[0], np.cumsum(chars)])
    line_chars = word_sums[np.searchsorted(starts, line_end)] - word_sums[np.searchsorted(starts, line_start)]
    dup_line_chars = c.per_text(np.where(later, line_chars, 0), line_first)

    total = np.maximum(out["word_chars"], 1)
    good = (out["n_dup_lines"] <= policy.max_dup_line_share * np.maximum(n_lines, 1)) & (dup_line_chars <= policy.max_dup_line_chars * total)
    for n in sorted({policy.window, *policy.max_ngram_share}):
        grams = c.rolling(word, n)
        at = np.flatnonzero(c.window_rows(first, n, len(grams)))
        often, again = c.twice(grams[at] ^ seed[at])
        if n == policy.window:
            out["n_repeat_words"] = c.per_text(c.covered(at[often], n, len(word)), first)
        if n in policy.max_ngram_share:
            inside = c.per_text(np.where(c.covered(at[again], n, len(word)), chars, 0), first)
            share = out[f"dup_{n}gram_chars"] = inside
            good &= share <= policy.max_ngram_share[n] * total
    out["dup_line_chars"] = dup_line_chars
    out["base_failed"] = (out["n_words"] < policy.min_words) | (100 * out["n_repeat_words"] > policy.max_repeat_percent * out["n_words"])
    out["kept"] = ~out["base_failed"] & good
    return out


def assess(docs: DataFrame, text: str = "text", keep: tuple[str, ...] | None = None, policy: RepetitionPolicy | None = None) -> DataFrame:
    """docs' columns ``keep`` (all by default), the measures, ``base_failed`` and ``kept``; one row per row, without a shuffle."""
    policy = policy or RepetitionPolicy()
    counted = [*MEASURES, *(f"dup_{n}gram_chars" for n in sorted(policy.max_ngram_share)), "dup_line_chars"]
    made = [T.StructField(k, T.LongType()) for k in counted] + [T.StructField(k, T.BooleanType()) for k in ("base_failed", "kept")]
    names = {x.name for x in made}
    kept = [x for x in (docs.columns if keep is None else keep) if x not in names]
    source, body = c.carried(docs, kept, text)
    schema = T.StructType([docs.schema[x] for x in kept] + made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offsets in c.byte_chunks(body(batch)):
                found = measure(buf, offsets, policy)
                rows = batch.slice(i, j - i)
                columns = [rows.column(k) for k in kept]
                columns += [pa.array(found[x.name].astype(np.int64 if x.name in counted else bool)) for x in made]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *(x.name for x in made)])

    return source.mapInArrow(run, schema)


def accepted(docs: DataFrame, text: str = "text", policy: RepetitionPolicy | None = None) -> DataFrame:
    """The rows of docs that pass, with the columns of docs.

    Columns of docs that bear a measure's name keep their own values: the verdict travels beside the row as a whole."""
    from pyspark.sql import functions as F

    row = docs.select(F.struct(*[docs[x] for x in docs.columns]).alias("row"))
    return assess(row, f"row.{text}", ("row",), policy).where("kept").select("row.*")
