"""Supervised subword embeddings for text quality.

A text is the mean of learned vectors of its features: words, pairs of neighbouring words, and character 3- and 4-grams of its
bytes, hashed into ``buckets``. A softmax layer on that mean gives the probabilities of the two labels. Vectors and layer are trained together
by stochastic gradient descent in numpy on a sample of labelled rows of bounded size (``max_examples``), gathered as feature
counts; the labelled ids of the sample are those with the least hashes, so the sample is the same in every run. Scoring reads
every whole text once, without a shuffle: the folded model is one number a bucket.

Null and empty texts have no features and score what the layer's bias says. Rows whose label is null are not learned from;
a doc_id with several labels teaches each of them. Without any labelled row every score is 0.5. ``score`` and ``predicted``
win over input columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinetrail.llm import common as c


@dataclass(frozen=True)
class ClassifierPolicy:
    buckets: int = 1 << 17
    width: int = 8
    epochs: int = 12
    rate: float = 0.6
    #: bound of the training sample, in labelled rows
    max_examples: int = 6000
    seed: int = 20
    threshold: float = 0.3


_SLICES = 16


@dataclass(frozen=True)
class FoldedModel:
    """score = sigmoid(mean of weights over features + bias)."""

    weights: np.ndarray
    bias: float


def features(buf: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every feature."""
    starts, ends, first = c.words(buf, offsets)
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    word, owner = c.SpanHasher(buf)(starts, ends), c.owners(first)
    found, texts = [(word >> shift).astype(np.int64)], [owner]
    near = np.flatnonzero(owner[1:] == owner[:-1])
    # pairs of neighbours are hashed by their difference, so that every word that stands twice running is one feature
    found.append((c.mix((word[near + 1] ^ word[near]) + np.uint64(2)) >> shift).astype(np.int64))
    texts.append(owner[near])
    wide = buf.astype(np.uint64)
    lengths = np.diff(offsets)
    for n in (3, 4):
        m = len(buf) - n + 1
        if m <= 0:
            continue
        value = np.zeros(m, np.uint64)
        for k in range(n):
            value |= wide[k : k + m] << np.uint64(8 * k)
        at = np.flatnonzero(c.window_rows(offsets, n, m))
        key = (value[at] + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15)
        found.append((key >> shift).astype(np.int64))
        texts.append(np.repeat(np.arange(len(lengths)), np.maximum(lengths - n + 1, 0)))
    return np.concatenate(found), np.concatenate(texts)


def _counts(source: DataFrame, keep: list[str], text: str, buckets: int) -> DataFrame:
    schema = T.StructType([source.schema[x] for x in keep] + [T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("n", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offsets in c.byte_chunks(batch.column(text)):
                bucket, owner = features(buf, offsets, buckets)
                both, n = np.unique(owner * buckets + bucket, return_counts=True)
                cut = np.searchsorted(both, np.arange(j - i + 1) * buckets).astype(np.int32)
                at = pa.ListArray.from_arrays(pa.array(cut), pa.array((both % buckets).astype(np.int32)))
                rows = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(rows.column(k) for k in keep), at, pa.ListArray.from_arrays(pa.array(cut), pa.array(n.astype(np.float32)))], names=schema.names)

    return source.select(*keep, text).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, text: str = "text", key: str = "doc_id", label: str = "quality", policy: ClassifierPolicy | None = None) -> FoldedModel:
    """Learns from at most ``max_examples`` of the label rows that ``usable`` (a condition on labels) allows."""
    policy = policy or ClassifierPolicy()
    chosen = labels.where(usable & labels[label].isNotNull() & labels[key].isNotNull()).select(labels[key].alias("id"), labels[label].cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id", "y").limit(policy.max_examples)
    texts = docs.select(docs[key].alias("id"), docs[text].alias("text")).join(F.broadcast(chosen), "id")
    rows = c.staged(_counts(texts, ["id", "y"], "text", policy.buckets).withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(_SLICES))), "examples")
    examples: list[tuple[np.ndarray, np.ndarray, bool]] = []
    for k in range(_SLICES):  # the sample reaches the driver slice by slice, so that the JVM holds one at a time
        part = rows.where(F.col("slice") == k).orderBy(F.xxhash64("id"), "id", "y").limit(2 * policy.max_examples // _SLICES).select("y", "at", "n").toArrow()
        for at, n, y in zip(part["at"], part["n"], part["y"].to_pylist(), strict=True):
            if len(at):
                examples.append((np.array(at.values), np.array(n.values), y == 1))
        del part
    c.unstage(docs.sparkSession, rows)
    return train(examples, policy)


def train(examples: list[tuple[np.ndarray, np.ndarray, bool]], policy: ClassifierPolicy) -> FoldedModel:
    """Stochastic gradient descent over (buckets, counts, label is 1)."""
    random = np.random.default_rng(policy.seed)
    vectors = ((random.random((policy.buckets, policy.width)) - 0.5) / policy.width).astype(np.float32)
    layer = np.zeros((2, policy.width), np.float32)
    bias = np.zeros(2, np.float32)
    steps, step = max(1, policy.epochs * len(examples)), 0
    shares = [(at, (n / n.sum()).astype(np.float32), y) for at, n, y in examples]
    for _ in range(policy.epochs):
        for k in random.permutation(len(shares)):
            at, share, y = shares[k]
            rate = policy.rate * (1 - step / steps)
            step += 1
            mean = share @ vectors[at]
            logits = layer @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[int(y)] -= 1
            back = layer.T @ p
            layer -= rate * np.outer(p, mean)
            bias -= np.float32(0.1 * rate) * p
            # the mean spreads a gradient thinly over a text's features; each is moved as if it stood for 1/sqrt(n) of it
            vectors[at] -= (rate * np.sqrt(len(at))) * np.outer(share, back).astype(np.float32)
    return FoldedModel((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def score(docs: DataFrame, model: FoldedModel, text: str = "text", keep: tuple[str, ...] | None = None, policy: ClassifierPolicy | None = None) -> DataFrame:
    """docs' columns ``keep`` (all by default) with ``score`` and ``predicted``."""
    policy = policy or ClassifierPolicy()
    kept = [x for x in (docs.columns if keep is None else keep) if x not in ("score", "predicted")]
    source, body = c.carried(docs, kept, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[x] for x in kept] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    limit, buckets = policy.threshold, policy.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded = shared.value
        for batch in batches:
            for i, j, buf, offsets in c.byte_chunks(body(batch)):
                bucket, owner = features(buf, offsets, buckets)
                total = np.bincount(owner, weights=folded.weights[bucket], minlength=j - i)
                mean = total / np.maximum(np.bincount(owner, minlength=j - i), 1)
                p = 1 / (1 + np.exp(-np.clip(mean + folded.bias, -50, 50)))
                rows = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(rows.column(k) for k in kept), pa.array(p), pa.array((p >= limit).astype(np.int32))], names=schema.names)

    return source.mapInArrow(run, schema)
