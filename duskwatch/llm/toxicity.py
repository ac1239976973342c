"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams (operator 5)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm.common import CACHE_ENTRIES, MIX_1, MIX_2, mixed, no_gc, staged, table, worker_store

# Bound of the sample the classifier is fitted on: labelled rows, chosen by a hash of their doc_id.
MOST_TRAINING_ROWS = 20_000
THRESHOLD = 0.3


@dataclass(frozen=True)
class Ftrl:
    """Rates of the learner: per coordinate (alpha, beta), sparsity, shrinkage (l2).

    The l1 penalty is sparsity * sqrt(training rows), as the noise of a
    coordinate's gradient sum grows with that root.
    """

    alpha: float = 1.0
    beta: float = 1.0
    sparsity: float = 0.06
    l2: float = 0.1
    epochs: int = 2
    least_documents: int = 4  # rarer features are left out


class CleanHashes(dict):
    """word -> 8 bytes of the hash of the word without punctuation around it."""

    def __missing__(self, word: str) -> bytes:
        digest = xxhash.xxh64_intdigest(word.strip("\"'.,;:!?()[]{}|<>*_-`~#@/\\")).to_bytes(8, "little")
        if len(self) < CACHE_ENTRIES:
            self[word] = digest
        return digest


def features(text: str | None) -> np.ndarray:
    """32-bit hashes of the words, word pairs and pairs with one word between, repeats included."""
    words = (text or "").lower().split()
    cache = worker_store("clean_hashes", CleanHashes)
    h = np.frombuffer(b"".join(map(cache.__getitem__, words)), dtype="<u8")
    with np.errstate(over="ignore"):
        parts = [mixed(h + MIX_1)]
        if len(h) > 1:
            parts.append(mixed(h[:-1] * MIX_1 + h[1:]))
        if len(h) > 2:
            parts.append(mixed(h[:-2] * MIX_2 + h[2:] + MIX_1))
    return (np.concatenate(parts) >> np.uint64(32)).astype(np.uint32)


def fit_ftrl(rows: list[np.ndarray], labels: np.ndarray, rates: Ftrl) -> tuple[np.ndarray, np.ndarray, float]:
    """(sorted feature hashes, their weights, bias) of the model; only non-zero weights.  Empties ``rows``, to save memory."""
    flat = np.concatenate(rows)
    flat.sort()
    starts = np.flatnonzero(np.append(True, flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, np.int64)
    keys = flat[starts[np.diff(np.append(starts, len(flat))) >= rates.least_documents]]
    del flat, starts
    docs = []
    for i, row in enumerate(rows):  # place of each feature among the kept ones
        at = np.searchsorted(keys, row)
        docs.append(at[(at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == row)].astype(np.int32) if len(keys) else at[:0])
        rows[i] = None
    bias = len(keys)  # the last coordinate, without l1
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)
    l1 = rates.sparsity * np.sqrt(len(rows))

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -shrunk / ((rates.beta + np.sqrt(n[at])) / rates.alpha + rates.l2)

    def bias_weight() -> float:
        return -z[bias] / ((rates.beta + np.sqrt(n[bias])) / rates.alpha + rates.l2)

    for _ in range(rates.epochs):
        for at, y in zip(docs, labels, strict=True):
            w, wb = weights(at), bias_weight()
            g = 1 / (1 + np.exp(-np.clip(w.sum() + wb, -35, 35))) - y
            grown = np.sqrt(n[at] + g * g)
            z[at] += g - (grown - np.sqrt(n[at])) / rates.alpha * w
            n[at] += g * g
            z[bias] += g - (np.sqrt(n[bias] + g * g) - np.sqrt(n[bias])) / rates.alpha * wb
            n[bias] += g * g
    w = weights(np.arange(bias))
    return keys[w != 0], w[w != 0].astype(np.float32), float(bias_weight())


def train(docs: DataFrame, labels: DataFrame, rates: Ftrl = Ftrl(), most_rows: int = MOST_TRAINING_ROWS) -> tuple:
    """Model from ``labels`` (doc_id, label 0/1) and the texts of ``docs``.

    At most ``most_rows`` labelled documents, the least by a hash of doc_id,
    are used, so their ids can be broadcast and their features fit in the one
    task that learns; features are extracted in parallel.  Returns () if there
    is nothing to learn from.
    """
    sample = (
        labels.where("doc_id is not null and label is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with no_gc():
                found = [np.unique(features(t)) for t in batch.column("text").to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            flat = np.concatenate(found).view(np.int32) if found else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["doc_id", "label", "features"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ys = [], []
        for batch in batches:
            column = batch.column("features")
            flat, ends = column.values.to_numpy(zero_copy_only=False).view(np.uint32), column.offsets.to_numpy()
            rows += [flat[a:b].copy() for a, b in zip(ends, ends[1:], strict=False)]
            ys += batch.column("label").to_pylist()
        if rows:
            keys, weights, bias = fit_ftrl(rows, np.array(ys, dtype=np.float64), rates)
            model = [[keys.astype("<u4").tobytes()], [weights.astype("<f4").tobytes()], [bias]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(model[0], pa.binary()), pa.array(model[1], pa.binary()), pa.array(model[2], pa.float64())],
                names=["keys", "weights", "bias"],
            )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    model = staged(
        chosen.mapInArrow(extract, "doc_id long, label int, features array<int>")
        .repartition(1)
        .sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "features")
        .mapInArrow(learn, "keys binary, weights binary, bias double"),
        "toxicity-model",
    ).first()
    if model is None:
        return ()
    return np.frombuffer(model["keys"], "<u4"), np.frombuffer(model["weights"], "<f4"), model["bias"]


def scored(docs: DataFrame, model: tuple, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, score, predicted); the sparse weights are broadcast.

    The model has at most as many weights as its bounded sample has features; a
    few thousand after l1.  Without a model, all scores are 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weights, bias = shared.value or (np.zeros(0, np.uint32), np.zeros(0, np.float32), -np.inf)
        bits = np.zeros(1 << 16, dtype=bool)
        bits[keys >> 16] = True
        for batch in batches:
            out = np.zeros(batch.num_rows)
            with no_gc():
                for row, text in enumerate(batch.column("text").to_pylist()):
                    found = features(text)
                    found = np.unique(found[bits[found >> 16]])
                    at = np.searchsorted(keys, found)
                    at = at[np.append(keys, np.uint32(0))[at] == found] if len(keys) else at[:0]
                    at = at[at < len(keys)]
                    out[row] = weights[at].astype(np.float64).sum() + bias
            out = np.where(np.isneginf(out), 0, 1 / (1 + np.exp(-np.clip(out, -700, 700))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out), pa.array((out >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        score, "doc_id long, score double, predicted int"
    )


def is_held_out() -> Column:
    """Rows that nothing is learned from: crc32 of doc_id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Learns from the rows of ``labels`` (doc_id, toxic) that are not held out.
    Defined cases: null and empty texts are scored by the bias alone; labels
    without doc_id or toxic are left out, the larger of contradicting labels counts;
    repeated documents are scored each; extra columns are ignored.
    """
    known = labels.where(~is_held_out()).select("doc_id", F.col("toxic").alias("label"))
    return scored(docs, train(docs, known)).select("doc_id", is_held_out().alias("held_out"), "score", "predicted")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
