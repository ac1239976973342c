"""Best-fit packing of documents into sequences of a fixed number of tokens (operator 6)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm.common import table
from duskwatch.llm.tokens import END_ID, encoded_parts, encoder, tokenizer_source

SEQUENCE_TOKENS = 1024
OPEN_BINS = 2048
# Pieces that are put in descending order before they meet the bins.
LOOK_AHEAD = 8192


class Bins:
    """A bounded number of open bins; a bit of ``free`` tells whether a bin with that much space is open."""

    def __init__(self, size: int, most: int, first: int):
        self.size, self.most, self.next = size, most, first
        self.free, self.open = 0, 0
        self.by_space: list[list[int]] = [[] for _ in range(size + 1)]

    def _put(self, bin_id: int, space: int) -> None:
        self.by_space[space].append(bin_id)
        self.free |= 1 << space
        self.open += 1

    def _take(self, space: int) -> int:
        bin_id = self.by_space[space].pop()
        if not self.by_space[space]:
            self.free &= ~(1 << space)
        self.open -= 1
        return bin_id

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) in the open bin with the least sufficient space, or in a new one."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            bin_id = self._take(space)
        else:
            space, bin_id = self.size, self.next
            self.next += 1
        if space > length:
            self._put(bin_id, space - length)
            if self.open > self.most:  # the fullest closes
                self._take((self.free & -self.free).bit_length() - 1)
        return bin_id, self.size - space


def cut_pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document; ids are little-endian unsigned 32-bit integers.

    Only documents of more than ``size`` tokens are cut: the first piece takes
    the remainder, the others are full.  A null or empty text is one piece with
    the end id alone; repeated rows give pieces each; extra columns are ignored.
    """
    source = docs.sparkSession.sparkContext.broadcast(tokenizer_source(tokenizer))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, source.value)
        for batch, encoded in encoded_parts(batches, enc, end_id):
            rows = []
            for row, ids in enumerate(encoded):
                n, view = len(ids) // 4, memoryview(ids)
                begin, end = 0, n % size or size
                piece = 0
                while begin < n:
                    rows.append((row, piece, begin, end - begin, view[4 * begin : 4 * end]))
                    begin, end, piece = end, end + size, piece + 1
            index, piece, start, length, ids = zip(*rows, strict=True) if rows else ([],) * 5
            columns = [
                batch.column("doc_id").take(pa.array(index, pa.int32())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array([zlib.crc32(x) for x in ids], pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array([bytes(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS) -> DataFrame:
    """``pieces`` (length, ...) with sequence_id and offset: where each lies, without gaps from offset 0.

    Pieces are dealt out by a hash, so no key can load one task; adaptive
    execution joins small partitions, and the larger a partition, the fuller its
    sequences.  Each partition packs its stream by best fit into a bounded number of
    open bins.  The stream comes in runs of about LOOK_AHEAD pieces, the longest
    first in each run.  Lengths must lie between 1 and ``size``; all other columns pass
    through, and columns named sequence_id or offset are replaced.
    """
    kept = pieces.drop("sequence_id", "offset")
    deal = F.xxhash64(*[F.col(f"`{c}`") for c, t in kept.dtypes if not t.startswith("map")])
    dealt = kept.withColumn("__deal", deal).repartition("__deal")
    schema = ", ".join([*(f"`{n}` {t}" for n, t in kept.dtypes), "sequence_id long", "offset long"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(size, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for at in range(0, batch.num_rows, LOOK_AHEAD):
                part = batch.slice(at, LOOK_AHEAD)
                lengths = part.column("length").to_numpy(zero_copy_only=False)
                order = np.argsort(-lengths, kind="stable")
                part = part.take(pa.array(order))
                places = [bins.place(n) for n in lengths[order].tolist()]
                sequence, offset = zip(*places, strict=True) if places else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                    names=[*part.schema.names[:-1], "sequence_id", "offset"],
                )

    # The order within a partition must not depend on which task's rows arrive first.
    ties = [F.col(f"`{c}`") for c in ("doc_id", "piece") if c in kept.columns]
    return dealt.sortWithinPartitions("__deal", *ties).mapInArrow(pack, schema)


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``size`` tokens."""
    return pack_pieces(cut_pieces(docs, tokenizer, size, with_ids=with_ids), size)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
