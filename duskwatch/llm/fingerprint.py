"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests (operator 8)."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm.common import MIX_1, MIX_2, mixed, no_gc, table

# A paragraph ends with its line or sentence; a longer one is cut after so many characters.
PARAGRAPH = re.compile(r"[^\n.!?]{1,64}[.!?]*")
HASHES = 3
# The opening also counts in pieces of a few characters, so that very short texts can be alike in part.
OPENING, PIECE = 64, 4
# A fingerprint has half a cell to one cell a paragraph, and at least twelve; a failed peeling takes tables four times as large.
PARAGRAPHS_PER_THIRD, LEAST_THIRD, GROWTH = 6, 4, 4
# Bits of a cell's check in a fingerprint. The larger tables of a repeated comparison have all 64.
CHECK_BITS = 16
BUCKETS_PER_PARTITION = 4


def paragraph_keys(text: str) -> np.ndarray:
    """Distinct 64-bit digests of the paragraphs; the k-th repeat of one has a digest of its own."""
    parts = PARAGRAPH.findall(text)
    parts += [f"{i}\n{text[i : i + PIECE]}" for i in range(0, min(len(text), OPENING), PIECE)]
    h = np.frombuffer(b"".join([xxhash.xxh64_digest(p) for p in parts]), dtype=">u8").astype(np.uint64)
    if len(h) > 1:
        order = np.argsort(h, kind="stable")
        s = h[order]
        new = np.append(True, s[1:] != s[:-1])
        at = np.arange(len(s))
        repeat = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
        with np.errstate(over="ignore"):
            h = mixed(s + repeat * MIX_1)
    else:
        h = mixed(h)
    return h


def checks(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(keys * MIX_2 + MIX_1)


def third_of(paragraphs: np.ndarray) -> np.ndarray:
    """Cells in each third of a fingerprint: a power of two, at least a sixth of its paragraphs.

    Powers of two let a larger table be folded onto a smaller one, so any two fingerprints can be subtracted.
    """
    return (2 ** np.ceil(np.log2(np.maximum(paragraphs / PARAGRAPHS_PER_THIRD, LEAST_THIRD)))).astype(np.int64)


class Tables:
    """Sketches of several documents side by side, each of its own size.

    A cell holds the number of its keys (modulo 2^16), the XOR of the keys and the XOR of their checks.
    """

    def __init__(self, thirds: np.ndarray, check_bits: int = 64):
        self.thirds = np.asarray(thirds, dtype=np.int64)
        self.base = np.concatenate([[0], np.cumsum(HASHES * self.thirds)])
        self.shift = np.uint64(64 - check_bits)
        size = int(self.base[-1])
        self.count = np.zeros(size, dtype=np.int16)
        self.key = np.zeros(size, dtype=np.uint64)
        self.check = np.zeros(size, dtype=np.uint64)
        self.owner = np.repeat(np.arange(len(self.thirds)), HASHES * self.thirds)

    def add(self, doc: np.ndarray, keys: np.ndarray, sign) -> None:
        """Put keys into their documents' tables, or take them out with sign -1: one cell in each third."""
        third, start, check = self.thirds[doc], self.base[doc], checks(keys) >> self.shift
        sign = np.broadcast_to(np.asarray(sign, dtype=np.int16), keys.shape)
        for i in range(HASHES):
            with np.errstate(over="ignore"):
                place = mixed(keys + np.uint64(i + 1) * MIX_1).astype(np.int64) & (third - 1)
            at = start + i * third + place
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, keys)
            np.bitwise_xor.at(self.check, at, check)

    def folded(self, thirds: np.ndarray) -> Tables:
        """The same sketches in smaller tables."""
        out = Tables(thirds, 64 - int(self.shift))
        inside = np.arange(len(self.count)) - self.base[self.owner]
        which, place = inside // self.thirds[self.owner], inside % self.thirds[self.owner]
        to = out.thirds[self.owner]
        at = out.base[self.owner] + which * to + (place & (to - 1))
        np.add.at(out.count, at, self.count)
        np.bitwise_xor.at(out.key, at, self.key)
        np.bitwise_xor.at(out.check, at, self.check)
        return out

    def minus(self, other: Tables) -> Tables:
        """Cell by cell difference, each pair in the smaller of its two sizes; common keys vanish."""
        thirds = np.minimum(self.thirds, other.thirds)
        a, b = self.folded(thirds), other.folded(thirds)
        a.count -= b.count
        a.key ^= b.key
        a.check ^= b.check
        return a

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, key, sign) of the recovered keys, and whether the peeling emptied each document's table."""
        found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int16))]
        # A false pure cell (a check that agrees by chance) could be peeled to and fro: the rounds are bounded.
        for _ in range(2 * len(self.count) + 1):
            pure = np.flatnonzero(np.abs(self.count) == 1)
            pure = pure[self.check[pure] == checks(self.key[pure]) >> self.shift]
            if not len(pure):
                break
            doc, keys, sign = self.owner[pure], self.key[pure], self.count[pure]
            order = np.lexsort((keys, doc))
            doc, keys, sign = doc[order], keys[order], sign[order]
            new = np.append(True, (doc[1:] != doc[:-1]) | (keys[1:] != keys[:-1]))
            doc, keys, sign = doc[new], keys[new], sign[new]
            found.append((doc, keys, sign))
            self.add(doc, keys, -sign)
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        full = np.bincount(self.owner[left], minlength=len(self.thirds)) > 0
        doc, keys, sign = (np.concatenate(part) for part in zip(*found, strict=True))
        return doc, keys, sign, ~full


def sketches(lists: list[np.ndarray]) -> Tables:
    """The fingerprints of several key lists as tables."""
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    t = Tables(third_of(sizes), CHECK_BITS)
    t.add(np.repeat(np.arange(len(lists)), sizes), np.concatenate(lists), 1)
    return t


def differences(
    a: list[np.ndarray], b: list[np.ndarray], tables_a: Tables, tables_b: Tables
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Paragraph digests only in each text of ``a`` and only in its partner of ``b``, in ascending order.

    The fingerprints are subtracted and peeled.  Pairs whose peeling fails are sketched again in tables
    GROWTH times as large; a table of over twice as many cells as there are keys peels almost surely, so the
    rounds end.
    """
    none = np.zeros(0, dtype=np.uint64)
    out = [(none, none)] * len(a)
    todo, t = np.arange(len(a)), tables_a.minus(tables_b)
    while True:
        doc, keys, sign, done = t.peel()
        order = np.lexsort((keys, doc))
        doc, keys, sign = doc[order], keys[order], sign[order]
        cuts = np.searchsorted(doc, np.arange(len(todo) + 1))
        for i in np.flatnonzero(done):
            k, s = keys[cuts[i] : cuts[i + 1]], sign[cuts[i] : cuts[i + 1]]
            out[todo[i]] = (k[s > 0], k[s < 0])
        todo, thirds = todo[~done], t.thirds[~done] * GROWTH
        if not len(todo):
            return out
        t = Tables(thirds)
        for side, way in ((a, 1), (b, -1)):
            sizes = [len(side[i]) for i in todo]
            t.add(np.repeat(np.arange(len(todo)), sizes), np.concatenate([side[i] for i in todo]), way)


def likeness(differing: int, paragraphs: int) -> float:
    """2 common / all paragraphs of two texts; 1 if neither has any."""
    return 1 - differing / paragraphs if paragraphs else 1.0


CELL = np.dtype([("count", "<i2"), ("key", "<u8"), ("check", "<u2")])


def as_text(tables: Tables, sizes: list[int]) -> list[str]:
    """Each sketch as text: its number of paragraphs, a colon, and its cells in base64."""
    cells = np.empty(len(tables.count), dtype=CELL)
    cells["count"], cells["key"], cells["check"] = tables.count, tables.key, tables.check
    cuts = tables.base
    return [f"{n}:{base64.b64encode(cells[cuts[i] : cuts[i + 1]].tobytes()).decode()}" for i, n in enumerate(sizes)]


def from_text(fingerprint: str) -> tuple[int, Tables]:
    """(paragraphs, sketch) of a fingerprint."""
    n, cells = fingerprint.split(":")
    read = np.frombuffer(base64.b64decode(cells), dtype=CELL)
    t = Tables(np.array([len(read) // HASHES]), CHECK_BITS)
    t.count, t.key, t.check = read["count"].astype(np.int16), read["key"].astype(np.uint64), read["check"].astype(np.uint64)
    return int(n), t


def compare(one: str, other: str) -> float | None:
    """Likeness of two texts from their fingerprints alone; None where these are too small for the difference."""
    (m, a), (n, b) = from_text(one), from_text(other)
    doc, _, _, done = a.minus(b).peel()
    return likeness(len(doc), m + n) if done[0] else None


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the start of the following text, as long or all of it."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, lost array<long>, gained array<long>"


def fingerprints(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are; the columns of OUT.

    The next document by ascending doc_id is met by dealing the rows out in doc_id
    ranges, sorted within them; the first row of each range is also sent to the range
    before it.  Split points are quantiles of doc_id, as many as there
    are ranges.  A range is read as a stream, one shuffle of the texts in all.

    Likeness comes from subtracting the fingerprints and peeling out the differing
    paragraph digests; a failed peeling is repeated with larger tables of the same paragraphs.
    ``lost`` and ``gained`` are the digests (as signed 64-bit integers) that only the text and only the edited text has.

    Defined cases: null texts are empty; two empty texts are alike (1); a null doc_id comes first; rows of one doc_id are ordered
    by text; the only document is its own next; extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    n = BUCKETS_PER_PARTITION * (partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = F.coalesce("doc_id", F.lit(-(2**63)))
    cuts = rows.agg(F.percentile_approx(ids, [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    # Number of split points at or below the id, found in the sorted array.
    bucket = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<long>"), lambda c: c <= ids)) if len(cuts) < 64 else None
    if bucket is None:
        bucket = _bisected(ids, cuts)
    dealt = rows.withColumn("bucket", bucket.cast("int"))
    firsts = dealt.groupBy("bucket").agg(F.min(ids).alias("first_id")).orderBy("bucket").collect()  # one row a range
    if not firsts:
        return spark.createDataFrame([], OUT)
    order = [r["bucket"] for r in firsts]
    before = {r["first_id"]: order[i - 1] for i, r in enumerate(firsts)}  # the range that also gets this row
    heads = spark.createDataFrame([(i, b) for i, b in before.items()], "first_id long, earlier int")
    copies = dealt.withColumn("look_ahead", F.lit(False)).union(
        rows.join(F.broadcast(heads), ids == F.col("first_id")).select("doc_id", "text", F.col("earlier").alias("bucket"), F.lit(True))
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (bucket, doc_id, text, keys, is look-ahead)
        waiting: list[tuple] = []

        def done() -> pa.RecordBatch:
            ids, texts, keys, nexts, next_keys = zip(*waiting, strict=True)
            news = [edited(t, n) for t, n in zip(texts, nexts, strict=True)]
            new_keys = [paragraph_keys(t) for t in news]
            own, new, following = sketches(list(keys)), sketches(new_keys), sketches(list(next_keys))
            edits = differences(list(keys), new_keys, own, new)
            to_next = differences(list(keys), list(next_keys), own, following)
            near = [
                [likeness(len(x) + len(y), len(k) + len(o)) for (x, y), k, o in zip(pairs, keys, others, strict=True)]
                for pairs, others in ((edits, new_keys), (to_next, next_keys))
            ]
            columns = [
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in news]),
                pa.array(as_text(own, [len(k) for k in keys])),
                pa.array(as_text(new, [len(k) for k in new_keys])),
                pa.array(near[0], pa.float64()),
                pa.array(near[1], pa.float64()),
                *(pa.array([e[side].view(np.int64) for e in edits], pa.list_(pa.int64())) for side in (0, 1)),
            ]
            return pa.RecordBatch.from_arrays(columns, names=[c.split(" ")[0] for c in OUT.split(", ")])

        for batch in batches:
            with no_gc():
                for b, i, t, ahead in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "text", "look_ahead")), strict=True):
                    row = (b, i, t, paragraph_keys(t), ahead)
                    if held is not None and held[0] == b and not held[4]:
                        waiting.append((held[1], held[2], held[3], t, row[3]))
                    held = row
                    if len(waiting) >= 250:
                        yield done()
                        waiting = []
        if waiting:
            yield done()

    return (
        copies.repartition("bucket")
        .sortWithinPartitions("bucket", "look_ahead", "doc_id", "text")
        .mapInArrow(read, OUT)
    )


def _bisected(value, cuts: list[int]):
    """Number of sorted ``cuts`` at or below ``value``: first the block of cuts, then the place in it."""
    size = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[i : i + size] for i in range(0, len(cuts), size)]
    heads = F.array(*(F.lit(b[0]) for b in blocks)).cast("array<long>")
    which = F.size(F.filter(heads, lambda c: c <= value))
    tables = F.array(*(F.array(*map(F.lit, b)).cast("array<long>") for b in blocks))
    inside = F.size(F.filter(F.element_at(tables, which), lambda c: c <= value))
    return F.when(which == 0, 0).otherwise((which - 1) * size + inside)


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
