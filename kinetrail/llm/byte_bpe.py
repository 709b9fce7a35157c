"""Byte-level BPE by the tiktoken library and a local rank file.

Long texts are cut before white space that follows a letter or digit: no match of the pre-splitting pattern spans such a
place and none looks back across it, so the pieces encode as the whole text would. Decoding works on raw bytes, so ids
that end inside a character survive.

Null texts are empty and encode to no ids. Output columns win over input columns of the same name.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinetrail.llm import common as c

#: Longest piece in characters that is handed to the library at once, where the text has a safe place to cut.
PIECE = 1 << 15
_SAFE = re.compile(r"(?<=[A-Za-z0-9])[ \n]")


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str):
    """The library's encoder for a rank file; one per worker process."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding("local-ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Consecutive parts of text, cut only at safe places, about ``size`` characters each."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(encoder, text: str | None) -> list[int]:
    if not text:
        return []
    if len(text) <= PIECE:
        return encoder.encode_ordinary(text)
    ids: list[int] = []
    for part in pieces(text):
        ids += encoder.encode_ordinary(part)
    return ids


def default_vocabulary() -> tuple[str, str]:
    """Path of the rank file for many languages and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def encode(docs: DataFrame, text: str = "text", into: str = "ids", ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """docs with the array column ``into``. The rank file must be at ``ranks`` on every worker."""
    path, pat = (ranks, pattern) if ranks else default_vocabulary()

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = encoding(path, pat)
        for batch in batches:
            yield batch.map(lambda x: encode_text(encoder, x))

    return docs.withColumn(into, ids(F.coalesce(docs[text], F.lit(""))))


def decode(tokens: DataFrame, ids: str = "ids", into: str = "bytes", ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """tokens with the binary column ``into``: the bytes of the ids; null ids decode to no bytes."""
    path, pat = (ranks, pattern) if ranks else default_vocabulary()

    @F.pandas_udf(T.BinaryType())
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = encoding(path, pat)
        for batch in batches:
            yield batch.map(lambda x: b"" if x is None else encoder.decode_bytes(list(x)))

    return tokens.withColumn(into, raw(tokens[ids]))


def round_trip(docs: DataFrame, keep: tuple[str, ...], text: str = "text", ranks: str | None = None, pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """Columns ``keep``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, encoded and decoded in one pass; ``ids`` too if asked for.

    The made columns win over kept ones of those names. Repeated rows are encoded each; an empty table gives an empty table."""
    from hashlib import sha256

    made_names = ("n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else []))
    keep = tuple(x for x in keep if x not in made_names)

    path, pat = (ranks, pattern) if ranks else default_vocabulary()
    schema = T.StructType(
        [docs.schema[x] for x in keep] + [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
        + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    )
    source, body = c.carried(docs, list(keep), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(path, pat)
        numerals = [str(i) for i in range(encoder.max_token_value + 1)]
        for batch in batches:
            made: list[list] = [[], [], [], []]
            for value in body(batch):
                ids = encode_text(encoder, value.as_py())
                made[0].append(len(ids))
                made[1].append(sha256(",".join([numerals[i] for i in ids]).encode()).hexdigest())
                made[2].append(sha256(encoder.decode_bytes(ids)).hexdigest())
                if with_ids:
                    made[3].append(np.array(ids, np.int32))
            columns = [*(batch.column(k) for k in keep), pa.array(made[0], pa.int64()), pa.array(made[1], pa.string()), pa.array(made[2], pa.string())]
            if with_ids:
                cuts = np.concatenate([[0], np.cumsum(made[0])]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate([np.empty(0, np.int32), *made[3]]))))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)
