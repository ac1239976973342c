"""Quality classifier by positive-unlabelled learning with a non-negative risk (operator 13)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from struct import pack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm.common import CACHE_ENTRIES, no_gc, staged, table, worker_store

# Bounds of the samples the classifier is fitted on, chosen by a hash of doc_id: trusted positives, unlabelled texts.
MOST_POSITIVES, MOST_UNLABELLED = 10_000, 20_000
THRESHOLD = 0.3
# Places of hashed word shapes and pairs of them, and of binned measures behind them; a document has no more features.
SHAPES, BINS = 4096, 16
MEASURES = ("words", "distinct", "most frequent", "repeated next", "mean length", "symbols", "upper case", "digits", "lines", "repeated lines")
WIDTH = SHAPES + BINS * len(MEASURES)
# The prior where no label contradicts: of positives only, nothing can be counted.
DEFAULT_PRIOR = 0.5


@dataclass(frozen=True)
class NonNegative:
    """Rates of the learner; ``correction`` scales the step back when the negative risk falls below zero."""

    rate: float = 0.05
    l2: float = 1e-4
    epochs: int = 60
    least_steps: int = 1500  # a small sample is gone through more often
    batch: int = 512
    correction: float = 1.0
    seed: int = 7


FACTS = [("word", "<u8"), ("shape", "<u4"), ("size", "<u4"), ("letters", "<u4"), ("upper", "<u4"), ("digits", "<u4")]


class ShapeHashes(dict):
    """word -> packed FACTS of it; keeps at most CACHE_ENTRIES words."""

    def __missing__(self, word: str) -> bytes:
        shape, upper, letters, digits, last = [], 0, 0, 0, ""
        for c in word:
            if c.isalpha():
                letters += 1
                kind = "A" if c.isupper() else "a"
                upper += kind == "A"
            elif c.isdigit():
                digits, kind = digits + 1, "9"
            else:
                kind = c
            if kind != last:
                shape.append(kind)
            last = kind
        found = pack("<QIIIII", xxhash.xxh64_intdigest(word), xxhash.xxh32_intdigest("".join(shape)), len(word), letters, upper, digits)
        if len(self) < CACHE_ENTRIES:
            self[word] = found
        return found


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of a whole text: roots of the shares of word shapes and shape pairs, and binned measures."""
    text = text or ""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, known = len(words), worker_store("shape_hashes", ShapeHashes)
    facts = np.frombuffer(b"".join(map(known.__getitem__, words)), dtype=FACTS)
    shape, word = facts["shape"].astype(np.int64), facts["word"]
    pairs = (shape[:-1] * 31 + shape[1:] * 17 + 5) % 2147483647
    counts = np.bincount(np.concatenate([shape, pairs]) % SHAPES, minlength=SHAPES)
    at = np.flatnonzero(counts)
    values = np.sqrt(counts[at] / max(n, 1))

    size, letters, upper, digits = (int(facts[c].sum(dtype=np.int64)) for c in ("size", "letters", "upper", "digits"))
    size = max(size, 1)
    repeats = np.unique(word, return_counts=True)[1] if n else np.zeros(1, np.int64)
    next_same = int((word[1:] == word[:-1]).sum())
    shares = (
        np.log2(n + 1) / 16,
        len(repeats) / max(n, 1) ** 0.8,
        repeats.max() / max(n, 1),
        next_same / max(n - 1, 1),
        size / max(n, 1) / 20,
        (size - letters - digits) / size,
        upper / max(letters, 1),
        digits / size,
        np.log2(len(lines) + 1) / 12,
        1 - len(set(lines)) / max(len(lines), 1),
    )
    place = np.minimum((np.array(shares) * BINS).astype(np.int64), BINS - 1)
    measured = SHAPES + np.arange(len(MEASURES)) * BINS + place
    return np.append(at, measured).astype(np.int32), np.append(values, np.full(len(MEASURES), 0.5)).astype(np.float32)


class Rows:
    """Sparse rows side by side."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.ends = np.concatenate([[0], np.cumsum([len(a) for a, _ in rows])]).astype(np.int64)
        self.at = np.concatenate([a for a, _ in rows])
        self.value = np.concatenate([v for _, v in rows])

    def part(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = self.ends[chosen + 1] - self.ends[chosen]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        take = np.repeat(self.ends[chosen] - starts[:-1], sizes) + np.arange(starts[-1])
        return self.at[take], self.value[take], np.repeat(np.arange(len(chosen)), sizes)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(positives: list, unlabelled: list, prior: float, rates: NonNegative) -> np.ndarray:
    """Weights (the last is the bias) that minimise prior * R(P, +) + max(0, R(U, -) - prior * R(P, -)), logistic loss.

    Steps of Adam over batches of both samples.  Where a batch's negative risk is below zero the learner has
    begun to fit the sample, and steps the other way on that part alone.
    """
    p, u, rng = Rows(positives), Rows(unlabelled), np.random.default_rng(rates.seed)
    w, m, v, t = np.zeros(WIDTH + 1), np.zeros(WIDTH + 1), np.zeros(WIDTH + 1), 0
    per_epoch = max(1, -(-len(unlabelled) // rates.batch))
    share = max(1, -(-len(positives) // per_epoch))

    def outputs(part, n: int) -> np.ndarray:
        at, value, row = part
        return np.bincount(row, value * w[at], minlength=n) + w[-1]

    def back(part, slope: np.ndarray) -> np.ndarray:
        at, value, row = part
        return np.append(np.bincount(at, value * slope[row], minlength=WIDTH), slope.sum())

    for _ in range(max(rates.epochs, -(-rates.least_steps // per_epoch))):
        pi, ui = rng.permutation(len(positives)), rng.permutation(len(unlabelled))
        for k in range(per_epoch):
            own = pi[np.arange(k * share, (k + 1) * share) % len(pi)]
            other = ui[k * rates.batch : (k + 1) * rates.batch]
            pp, up = p.part(own), u.part(other)
            fp, fu = outputs(pp, len(own)), outputs(up, len(other))
            negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            g_negative = back(up, sigmoid(fu) / len(other)) - prior * back(pp, sigmoid(fp) / len(own))
            if negative >= 0:
                g = prior * back(pp, (sigmoid(fp) - 1) / len(own)) + g_negative
            else:
                g = -rates.correction * g_negative
            g[:-1] += rates.l2 * w[:-1]
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rates.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def is_held_out() -> Column:
    """Rows that nothing is learned from: crc32 of doc_id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rates: NonNegative = NonNegative(), most: tuple[int, int] = (MOST_POSITIVES, MOST_UNLABELLED)) -> np.ndarray | None:
    """Weights learned from texts of ``docs`` and ``labels`` (doc_id, label 0/1); None without a positive.

    Trusted positives are at most ``most[0]`` documents of label 1, the unlabelled texts at most
    ``most[1]`` of all rows, both the least by a hash of doc_id, so a document may be in both.  The class prior is the share
    of label 1 among all of ``labels``; labels of 0 serve for nothing else.  Samples are
    bounded in rows and a row in features, so they fit the one task that learns.
    """
    known = labels.where("doc_id is not null and label is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("label").cast("int").alias("label"))
    counted = known.agg(F.avg("label").alias("share"), F.count(F.lit(1)).alias("n")).first()
    if not counted["n"] or not counted["share"]:
        return None
    prior = min(counted["share"], 0.99) if counted["share"] < 1 else DEFAULT_PRIOR
    order = [F.xxhash64(F.lit(13), "doc_id"), F.col("doc_id")]
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    positives = known.where("label = 1").orderBy(*order).limit(most[0]).select("doc_id", F.lit(1).alias("positive"))
    unlabelled = rows.select("doc_id").distinct().orderBy(*order).limit(most[1]).select("doc_id", F.lit(0).alias("positive"))
    chosen = rows.join(F.broadcast(positives.union(unlabelled)), "doc_id").dropDuplicates(["doc_id", "positive"])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with no_gc():
                found = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("positive"), pa.array([a for a, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))],
                names=["doc_id", "positive", "at", "value"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: tuple[list, list] = ([], [])
        for batch in batches:
            ends = batch.column("at").offsets.to_numpy()
            at, value = (batch.column(c).values.to_numpy(zero_copy_only=False) for c in ("at", "value"))
            for positive, a, b in zip(batch.column("positive").to_pylist(), ends, ends[1:], strict=False):
                sides[positive].append((at[a:b].copy(), value[a:b].copy()))
        if all(sides):
            w = fit(sides[1], sides[0], prior, rates)
            yield pa.RecordBatch.from_arrays([pa.array([w.astype("<f8").tobytes()], pa.binary())], names=["weights"])

    model = staged(
        chosen.mapInArrow(extract, "doc_id long, positive int, at array<int>, value array<float>")
        .repartition(1)
        .sortWithinPartitions("positive", "doc_id")
        .mapInArrow(learn, "weights binary"),
        "quality-model",
    ).first()
    return np.frombuffer(model["weights"], "<f8") if model is not None else None


def scored(docs: DataFrame, weights: np.ndarray | None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, score, predicted); the weights (WIDTH numbers) are broadcast.  Without any, all scores are 1."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            out = np.ones(batch.num_rows)
            if w is not None:
                with no_gc():
                    for row, text in enumerate(batch.column("text").to_pylist()):
                        at, value = features(text)
                        out[row] = sigmoid(np.dot(w[at], value) + w[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out), pa.array((out >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; score is the chance of good quality.

    Learns from the rows of ``labels`` (doc_id, quality) and the texts of ``docs`` that are not held out.
    Defined cases: null and empty texts are scored by their measures alone; labels without doc_id or
    quality are left out, the smaller of contradicting labels counts; of repeated doc_ids one
    row is learned from and each is scored; with no positive label all scores are 1; extra columns are ignored.
    """
    known = labels.where(~is_held_out()).select("doc_id", F.col("quality").alias("label"))
    return scored(docs, train(docs.where(~is_held_out()), known)).select("doc_id", is_held_out().alias("held_out"), "score", "predicted")


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
