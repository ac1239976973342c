"""Token ids by a public tokenizer, and their Parquet files (operator 2)."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm.common import no_gc, table, worker_store
from duskwatch.sources.checkpoint import shared_folder

END_ID = 2
# Word -> ids entries a Python worker keeps between tasks.
CACHE_WORDS = 400_000
# Texts made of other characters than these go to the tokenizer whole: for these, the classes of its
# patterns and lower-casing are the same in every version of Unicode.
OTHER = re.compile("[^\t\n\r\x20-\x7e¡-įı-ɏ‐-‧]")
# And for a tokenizer that lowers, those whose lower case is another such character.
LEAVING = "".join(c for c in map(chr, range(0x2028)) if not OTHER.search(c) and OTHER.search(c.lower()))
OTHER_LOWERED = re.compile(f"{OTHER.pattern}|[{LEAVING}]")
LETTER, NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
# Pre-tokens of the two vocabularies, restricted to the characters above.
BYTE_PRE_TOKEN = f"'(?:s|t|re|ve|m|ll|d)| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^\\s{LETTER}{NUMBER}]+|\\s+(?!\\S)|\\s+"
WORD_PRE_TOKEN = f"'(?:s|t|re|ve|m|ll|d)|[{LETTER}]+|[{NUMBER}]|[^\\s{LETTER}{NUMBER}]+"


class Encoder:
    """Ids of whole texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    Both vocabularies encode each pre-token by itself, so the ids of a word
    are asked from the tokenizer once and kept.  Texts with control strings or
    with characters outside a checked set are encoded whole, and so is every text
    of a tokenizer with other pre-tokens.
    """

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        spec = json.loads(source)
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        steps = [s["type"] for s in pre.get("pretokenizers", [])]
        self.control = [t["content"] for t in spec.get("added_tokens", [])]
        self.lower, self.pattern = False, None
        if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre["add_prefix_space"] and not norm:
            self.pattern = re.compile(BYTE_PRE_TOKEN)
            self.joined = re.compile(f" [{LETTER}]+")  # words that can be encoded side by side
            self.glue = ""
        elif steps == ["Split", "ByteLevel"] and [s["type"] for s in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            self.pattern, self.lower = re.compile(WORD_PRE_TOKEN), True
            self.joined, self.glue = re.compile(r"\S+"), " "
        self.words: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        side = [w for w in words if self.joined.fullmatch(w)]
        for w in set(words).difference(side):
            self.words[w] = self._whole(w)
        for i in range(0, len(side), 2000):
            part = side[i : i + 2000]
            e = self.tokenizer.encode(self.glue.join(part), add_special_tokens=False)
            ids, of = np.array(e.ids, dtype="<u4").tobytes(), np.array(e.word_ids, dtype=np.int64)
            cuts = (np.searchsorted(of, np.arange(len(part) + 1)) * 4).tolist()
            if len(of) and of[-1] != len(part) - 1:  # not one pre-token a word
                self.words.update((w, self._whole(w)) for w in part)
            else:
                self.words.update((w, ids[a:b]) for w, a, b in zip(part, cuts, cuts[1:], strict=False))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        plain, split = [], []
        other = OTHER_LOWERED if self.lower else OTHER
        for text in texts:
            whole = self.pattern is None or other.search(text) or any(c in text for c in self.control)
            plain.append(bool(whole))
            split.append([] if whole else self.pattern.findall(text.lower() if self.lower else text))
        self._learn(list(set().union(*split).difference(self.words)))
        get = self.words.__getitem__
        out = [self._whole(t) if p else b"".join(map(get, s)) for t, p, s in zip(texts, plain, split, strict=True)]
        if (over := len(self.words) - CACHE_WORDS) > 0:  # the newest are the rarest
            for w in list(islice(reversed(self.words), over)):
                del self.words[w]
        return out


def tokenizer_source(path: str) -> str:
    """The tokenizer's file, a few MB, read once on the driver and sent along with the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoder(path: str, source: str) -> Encoder:
    """The worker's encoder of a tokenizer file; it outlives the task."""
    return worker_store(f"encoder {path} {zlib.crc32(source.encode())}", lambda: Encoder(source))


def encoded_parts(batches: Iterator[pa.RecordBatch], enc: Encoder, end_id: int, rows: int = 500) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of the batches with the ids of their texts, the end id included."""
    end = np.array([end_id], dtype="<u4").tobytes()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            with no_gc():
                yield part, [ids + end for ids in enc.encode([t or "" for t in part.column("text").to_pylist()])]


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    encoding: str = "dictionary",
    row_group_bytes: int = 16 << 20,
    page_bytes: int = 64 << 10,
) -> None:
    """Write the token ids of ``docs`` (doc_id, text, ...) as Parquet, in ascending doc_id order over the files.

    Columns: doc_id, part (number of the file's task), part_start (ids before
    the document in its part), n_tokens, ids array<int>.  ``encoding`` is
    "dictionary" (two bytes an id for a vocabulary below 65,536) or "delta".
    Row groups and pages are small, and the writer adds column and offset
    indexes, so that a doc_id range reads its pages only and positions are
    read without the ids.

    The rows are range-partitioned by doc_id before they are encoded, so each
    task encodes and writes one range in a stream.  Defined cases: a null or
    empty text is the end id alone; null doc_ids come first; repeated rows
    are all written, equal ids ordered by text; extra columns are ignored.
    """
    source = docs.sparkSession.sparkContext.broadcast(tokenizer_source(tokenizer))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, before = encoder(tokenizer, source.value), TaskContext.get().partitionId(), 0
        for batch, ids in encoded_parts(batches, enc, end_id):
            n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            ends = np.concatenate([[0], np.cumsum(n)])
            flat = np.frombuffer(b"".join(ids), dtype="<u4").view("<i4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(n), part, dtype=np.int32)),
                    pa.array(before + ends[:-1]),
                    pa.array(n),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat)),
                ],
                names=["doc_id", "part", "part_start", "n_tokens", "ids"],
            )
            before += int(ends[-1])

    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(encode, TOKEN_SCHEMA)
        .write.option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("parquet.writer.version", "PARQUET_1_0" if encoding == "dictionary" else "PARQUET_2_0")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .parquet(path)
    )


TOKEN_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True, first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens[, ids]) from the files; start counts all ids before the document.

    A part's base is the sum of the parts before it: a running sum over one
    row a part, taken from the position columns alone.  A doc_id range is pushed down to
    the page indexes; without ids, only the position columns are read.
    """
    files = spark.read.schema(TOKEN_SCHEMA).parquet(path)
    parts = files.groupBy("part").agg(
        F.sum("n_tokens").alias("part_tokens"), F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("first")
    )
    base = spark.sql(
        "SELECT part, coalesce(sum(part_tokens) OVER (ORDER BY first, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base"
        " FROM {parts}",
        parts=parts,
    )
    rows = files
    if first_id is not None:
        rows = rows.where(F.col("doc_id") >= first_id)
    if last_id is not None:
        rows = rows.where(F.col("doc_id") <= last_id)
    keep = ["doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens"] + (["ids"] if with_ids else [])
    # One row for each task that wrote: far below any broadcast limit, a few MB for 100,000 tasks.
    return rows.join(F.broadcast(base), "part").select(*keep)


def with_crc32(tokens: DataFrame) -> DataFrame:
    """Replace the column ids by ids_crc32, that of the ids as little-endian unsigned 32-bit integers."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat, ends = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<i4"), ids.offsets.to_numpy()
            crcs = [zlib.crc32(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            rest = [c for c in batch.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(crcs, pa.int64())], names=[*rest, "ids_crc32"])

    fields = [f"{n} {t}" for n, t in tokens.dtypes if n != "ids"]
    return tokens.mapInArrow(crc, ", ".join([*fields, "ids_crc32 long"]))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = shared_folder(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return with_crc32(read_tokens(spark, path))
