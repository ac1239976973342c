"""Helpers shared by the operators: staged tables, worker-side word hashes, connected components."""

from __future__ import annotations

import contextlib
import gc
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duskwatch.sources.checkpoint import shared_folder

MIX_1 = np.uint64(0x9E3779B97F4A7C15)
MIX_2 = np.uint64(0xBF58476D1CE4E5B9)
MIX_3 = np.uint64(0x94D049BB133111EB)
# Words (or other small values) a Python worker keeps between tasks.
CACHE_ENTRIES = 200_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once as Parquet to the folder all executors share, and read back with its columns.

    The shuffle files behind it are of no more use then, so Spark removes them as the write ends.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def worker_store(name: str, make):
    """A value that lives as long as the Python worker, across tasks.

    Functions travel to the workers by value, so their globals are new for each
    task; a module entry is the place that stays.
    """
    home = sys.modules.setdefault("duskwatch_worker_store", types.ModuleType("duskwatch_worker_store"))
    if name not in home.__dict__:
        home.__dict__[name] = make()
    return home.__dict__[name]


@contextlib.contextmanager
def no_gc() -> Iterator[None]:
    """No garbage collection while large word lists come and go; they hold no cycles."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


class WordHashes(dict):
    """word -> 8 bytes of its 64-bit hash; keeps at most CACHE_ENTRIES words."""

    def __missing__(self, word):
        digest = xxhash.xxh64_intdigest(word).to_bytes(8, "little")
        if len(self) < CACHE_ENTRIES:
            self[word] = digest
        return digest


def word_hashes(words) -> np.ndarray:
    """64-bit hashes of an iterable of words (str or bytes), as one array."""
    cache = worker_store("word_hashes", WordHashes)
    return np.frombuffer(b"".join(map(cache.__getitem__, words)), dtype="<u8")


def mixed(values: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit value of each 64-bit value."""
    with np.errstate(over="ignore"):
        x = values ^ (values >> np.uint64(30))
        x = x * MIX_2
        x = x ^ (x >> np.uint64(27))
        x = x * MIX_3
        return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, text: str, most_chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of about so many bytes of text; a longer text is a part alone."""
    sizes = np.array([len(x) if x is not None else 0 for x in batch.column(text).to_pylist()], dtype=np.int64)
    if not len(sizes):
        return
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        base = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, base + most_chars, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the least node that can be reached.

    Alternates large-star and small-star steps until the edges no longer
    change, so the number of rounds grows with the logarithm of the longest
    path.  A step is a group minimum with map-side combining and a join; no
    neighbourhood is ever collected.  Each round is written to the shared
    folder, which cuts the lineage.
    """
    pair = staged(
        edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).where("a <> b").distinct(), "components"
    )

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = mark(pair)
    while True:
        both = pair.union(pair.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: neighbours above the node move to the node's minimum.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: the node and its neighbours below it move to their minimum.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        pair = staged(small.where("a <> b").distinct(), "components")
        now = mark(pair)
        if now == seen:
            break
        seen = now
    roots = pair.select(F.col("b").alias("node")).distinct()
    return pair.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def ranked(df: DataFrame, group: str, order: list, purpose: str) -> DataFrame:
    """``df`` written once with ``pos``: each row's place in its ``group`` (nulls are one group) by ``order``, from 0.

    Rows are dealt out in ranges of (group, order), so a group of any size is spread
    over ranges; equal rows are told apart by their place in the input.  Each
    range counts on its own; only its first group can have begun before it, so the
    driver sees a few numbers a range, not a group.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group), *order, F.col("__tie")]
    dealt = df.withColumn("__tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).drop("__tie")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, idx, head, last, begun = TaskContext.get().partitionId(), 0, 0, True, None, False
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = batch.column(group)
            code = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new = np.append(not begun or column[0].as_py() != last, code[1:] != code[:-1])
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, -1))
            places = np.where(start < 0, at + idx, at - start)
            changes = np.cumsum(new)
            heads = (changes <= (0 if begun else 1)) & head
            idx, head, last, begun = int(places[-1]) + 1, bool(heads[-1]), column[-1].as_py(), True
            extra = [pa.array(np.full(n, part), pa.int32()), pa.array(at + row), pa.array(places), pa.array(heads)]
            row += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "__part", "__row", "__idx", "__head"])

    schema = StructType([*df.schema.fields, *StructType.fromDDL("__part int, __row long, __idx long, __head boolean").fields])
    rows = staged(dealt.mapInArrow(count, schema), purpose)
    ends = (
        rows.groupBy("__part")
        .agg(
            F.min_by(F.struct(group), "__row").alias("first"),
            F.max_by(F.struct(group), "__row").alias("last"),
            (F.max_by("__idx", "__row") + 1).alias("n"),
        )
        .orderBy("__part")
        .collect()  # one row a range
    )
    before, carried, previous = {}, 0, None
    for e in ends:
        carried = carried if previous is not None and e["first"] == previous else 0
        before[e["__part"]] = carried
        carried = e["n"] + (carried if e["first"] == e["last"] else 0)
        previous = e["last"]
    offsets = spark.createDataFrame([(p, n) for p, n in before.items() if n], "__part int, __before long")
    pos = F.col("__idx") + F.when(F.col("__head"), F.coalesce("__before", F.lit(0))).otherwise(0)
    return rows.join(F.broadcast(offsets), "__part", "left").select(*df.columns, pos.cast("long").alias("pos"))


# crc32 in SQL, by the usual table of 256 entries that SQL makes itself.
CRC32_TABLE = """crc(tab) AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))
)"""


def crc32_sql(text: str) -> str:
    """SQL for the unsigned crc32 of an ASCII text expression; needs the table ``crc`` in scope."""
    return (
        f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT), "
        "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"
    )
