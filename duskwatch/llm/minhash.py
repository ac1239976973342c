"""Near-duplicate documents by banded MinHash, odd sketches and exact confirmation (operator 7)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duskwatch.llm.common import MIX_1, connected_components, mixed, no_gc, staged, table, word_hashes

BANDS, ROWS = 36, 5  # 1 - (1 - 0.8^5)^36: a pair at similarity 0.8 misses all bands once in 1.7 million
SKETCH_WORDS = 8  # 512 parity bits
# Parity bits in which two sketches of 180 samples may differ.  A pair at 0.8 differs in 63, with a
# deviation of 9, so it is past this bound about as rarely as it misses all bands.
MOST_DIFFERENT_BITS = 112
# Further sets of high degree that are tried in each bucket before all others are.
HUBS = 8
SEED = 20240611

# Parity bits of the whole set.  Two sets differ in at least as many shingles as these bits differ, so pairs
# that differ in more than the similarity allows are left out without loss, however close they are to it.
SET_WORDS = 32
SIGNATURE = "doc_id long, n_shingles long, digest binary, bands array<long>, sketch array<long>, parity array<long>"


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, other letters as they are."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles; fewer words make one shingle, none make none."""
    h = word_hashes(words)
    n = len(h)
    if not n:
        return h
    width = min(width, n)
    with np.errstate(over="ignore"):
        out = np.full(n - width + 1, np.uint64(width))
        for i in range(width):
            out = mixed(out * MIX_1 + h[i : n - width + 1 + i])
    return np.unique(out)


def signer(width: int):
    """Function that turns (doc_id, text) batches into SIGNATURE batches."""
    rng = np.random.default_rng(SEED)
    k = BANDS * ROWS
    flips = rng.integers(0, 2**32, k, dtype=np.uint32)[:, None]
    factors = (rng.integers(0, 2**31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
    index = mixed(np.arange(1, k + 1, dtype=np.uint64) * MIX_1)
    band = mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * MIX_1)

    def minima(shingles: np.ndarray) -> np.ndarray:
        low = np.full(k, np.uint32(0xFFFFFFFF))
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        for i in range(0, len(x), 1024):
            low = np.minimum(low, ((x[None, i : i + 1024] ^ flips) * factors).min(axis=1))
        return low

    def folded(positions: np.ndarray, words: int) -> np.ndarray:
        parity = np.bincount(positions.astype(np.int64), minlength=64 * words) & 1
        return np.packbits(parity.astype(np.uint8), bitorder="little").view("<i8")

    def signature(shingles: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        low = minima(shingles).astype(np.uint64)
        rows = low.reshape(BANDS, ROWS)
        key = band
        with np.errstate(over="ignore"):
            for r in range(ROWS):
                key = mixed(key * MIX_1 + rows[:, r])
            bits = mixed(low * MIX_1 + index) >> np.uint64(64 - 9)
        digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
        return digest, key.view(np.int64), folded(bits, SKETCH_WORDS), folded(shingles % np.uint64(64 * SET_WORDS), SET_WORDS)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sizes, digests, keys, sketches, parities = [], [], [], [], []
                none = np.zeros(0, np.int64)
                with no_gc():
                    for text in batch.column("text").to_pylist():
                        shingles = shingle_hashes(split_words(text), width)
                        sizes.append(len(shingles))
                        if len(shingles):
                            digest, key, sketch, parity = signature(shingles)
                        else:
                            digest, key, sketch, parity = None, none, none, none
                        digests.append(digest)
                        keys.append(key)
                        sketches.append(sketch)
                        parities.append(parity)

                def lists(parts: list[np.ndarray]) -> pa.Array:
                    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts)))

                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.binary()),
                        lists(keys),
                        lists(sketches),
                        lists(parities),
                    ],
                    names=["doc_id", "n_shingles", "digest", "bands", "sketch", "parity"],
                )

    return sign


def different_bits(a: Column, b: Column, words: int) -> Column:
    """Population count of the XOR of two parity bitmaps."""
    total = F.bit_count(a[0].bitwiseXOR(b[0]))
    for i in range(1, words):
        total = total + F.bit_count(a[i].bitwiseXOR(b[i]))
    return total


def confirmed(pairs: DataFrame, docs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """The candidate pairs (u, v) of set digests whose full shingle sets are alike enough.

    A set's text is that of the least document that has it.  A repeated
    doc_id may stand for several texts; the digest, computed again, says which
    one is meant.
    """
    wanted = pairs.select(F.col("u").alias("digest")).union(pairs.select(F.col("v").alias("digest"))).distinct()
    ids = sets.select("digest", "first_id").join(wanted, "digest")

    def matching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with no_gc():
                keep = [
                    hashlib.blake2b(shingle_hashes(split_words(t), width).tobytes(), digest_size=16).digest() == d
                    for d, t in zip(batch.column("digest").to_pylist(), batch.column("text").to_pylist(), strict=True)
                ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    texts = (
        docs.select(F.col("doc_id").cast("long").alias("first_id"), "text")
        .join(ids, "first_id")
        .select("digest", "text")
        .mapInArrow(matching, "digest binary, text string")
        .groupBy("digest")
        .agg(F.min("text").alias("text"))
    )

    def shingles(text: str | None) -> set:
        words = split_words(text)
        w = min(width, len(words))
        return set(zip(*(words[i:] for i in range(w)), strict=False))

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, a = None, set()
        for batch in batches:
            keep = []
            with no_gc():
                for u, tu, tv in zip(*(batch.column(c).to_pylist() for c in ("u", "tu", "tv")), strict=True):
                    if u != last:
                        last, a = u, shingles(tu)
                    b = shingles(tv)
                    both = len(a & b)
                    keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return (
        pairs.join(texts.select(F.col("digest").alias("u"), F.col("text").alias("tu")), "u")
        .join(texts.select(F.col("digest").alias("v"), F.col("text").alias("tv")), "v")
        .select("u", "v", "tu", "tv")
        .mapInArrow(alike, "u binary, v binary")
    )


def near_duplicates(docs: DataFrame, width: int = 2, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, ...).

    Two documents are linked if ``100 * intersection >= percent * union`` holds
    for their sets of ``width``-word shingles; component_id is the least doc_id
    reachable over links, kept marks that document.

    * Equal sets collapse to one node first, so exact copies, however many,
      cost one map-side combined group.
    * Candidates share one of 36 bands of five MinHash values.  In each bucket
      every set is first compared with the one that shares most bands with
      others (a star, linear in the bucket).  After linking, only sets outside the
      bucket's largest component are compared further: with HUBS more such
      sets, then with all sets of other components.  Pairs within a component
      need no link, so nothing is lost and no group is expanded into all pairs.
    * Before a pair's texts are fetched, its sizes, the parity bits of its odd
      sketches and those of its whole sets must be near enough; then the full sets decide.

    Defined cases: a null or blank text has no shingles and is linked with
    nothing; a null doc_id is returned with itself (null) as component and
    takes no part; repeated rows of one doc_id are returned each; other
    columns, whatever their names, are ignored.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = staged(narrow.mapInArrow(signer(width), SIGNATURE), "minhash-signatures")
    sets = staged(
        signed.where("n_shingles > 0 and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.first(F.struct("bands", "n_shingles", "sketch", "parity")).alias("s"))
        .select("digest", "first_id", "s.*"),
        "minhash-sets",
    )
    posts = sets.select("digest", F.explode("bands").alias("bucket"))
    full = posts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = staged(posts.join(full, "bucket"), "minhash-shared")
    # A text that others are copied from shares more bands with them than they do among each other.
    degrees = shared.groupBy("digest").agg(F.sum("n").alias("degree"))
    shared = staged(
        shared.join(degrees, "digest").join(sets.select("digest", "n_shingles", "sketch", "parity"), "digest"),
        "minhash-shared",
    )
    both = F.col("a.n_shingles") + F.col("b.n_shingles")
    common = F.floor((both * percent + (100 + percent - 1)) / (100 + percent))  # so many at least at this similarity
    near = (
        (F.least("a.n_shingles", "b.n_shingles") >= common)
        & (different_bits(F.col("a.sketch"), F.col("b.sketch"), SKETCH_WORDS) <= MOST_DIFFERENT_BITS)
        & (different_bits(F.col("a.parity"), F.col("b.parity"), SET_WORDS) <= both - 2 * common)
    )
    pair = (F.least("a.digest", "b.digest").alias("u"), F.greatest("a.digest", "b.digest").alias("v"))

    def components(links: DataFrame) -> DataFrame:
        return staged(connected_components(links), "minhash-parts")

    def open_rows(parts: DataFrame) -> DataFrame:
        """Rows of the buckets that hold several components, with whether they are outside the largest."""
        rows = shared.join(parts.withColumnRenamed("node", "digest"), "digest", "left").withColumn(
            "component", F.coalesce("component", "digest")
        )
        sizes = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("m"))
        largest = (
            sizes.groupBy("bucket")
            .agg(F.max(F.struct("m", "component"))["component"].alias("largest"), F.count(F.lit(1)).alias("parts"))
            .where("parts > 1")
        )
        few = (F.col("component") != F.col("largest")).alias("few")
        return staged(rows.join(largest, "bucket").select("bucket", "digest", "degree", "n_shingles", "sketch", "parity", "component", few), "minhash-open")

    def compared(candidates: DataFrame, tested: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        new = candidates.distinct()
        if tested is not None:
            new = new.join(tested, ["u", "v"], "left_anti")
        new = staged(new, "minhash-candidates")
        links = staged(confirmed(new, narrow, sets, width, percent), "minhash-links")
        return links, new if tested is None else tested.union(new)

    # Stars around the set of the highest degree in each bucket.
    order = F.struct("degree", "digest")
    heads = shared.groupBy("bucket").agg(F.max_by(F.struct("digest", "n_shingles", "sketch", "parity"), order).alias("h")).select("bucket", "h.*")
    star = heads.alias("a").join(shared.alias("b"), (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.digest") != F.col("b.digest")) & near)
    links, tested = compared(star.select(*pair), None)
    parts = components(links)

    # What the stars left apart, against a few more sets of high degree ...
    rows = open_rows(parts)
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("degree"), "digest"))
    hubs = rows.withColumn("rank", rank).where(F.col("rank") <= HUBS).drop("rank")
    apart = (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.component") != F.col("b.component")) & near
    more, tested = compared(hubs.alias("a").join(rows.where("few").alias("b"), apart).select(*pair), tested)
    links = links.union(more)
    parts = components(links)

    # ... and all that are still apart against every set of another component.
    rows = open_rows(parts)
    more, _ = compared(rows.alias("a").join(rows.where("few").alias("b"), apart).select(*pair), tested)
    joined = components(links.union(more))

    member = sets.select("digest", "first_id").join(joined.withColumnRenamed("node", "digest"), "digest", "left")
    member = member.withColumn("component", F.coalesce("component", "digest"))
    least = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    label = member.join(least, "component").select("digest", "component_id")
    known = signed.where("digest is not null and doc_id is not null").join(label, "digest")
    alone = signed.where("digest is null or doc_id is null").withColumn("component_id", F.col("doc_id"))
    return (
        known.select("doc_id", "n_shingles", "component_id")
        .union(alone.select("doc_id", "n_shingles", "component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
