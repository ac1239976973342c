"""Near-duplicate lines by an exact set-similarity join (operator 4)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm.common import MIX_1, mixed, no_gc, ranked, staged, table

PERCENT = 80
# Token counts are kept by hash bucket, so what the driver broadcasts is 1 MB for any corpus.
COUNT_BUCKETS, COUNT_CHUNK = 1 << 20, 1 << 12
TASKS_PER_SUM = 256
# A token's lines are compared in blocks of at most about this many.
BLOCK_LINES = 50_000
# A line leaves a token's group with candidates of this weight; one whose parity is well within the bound is
# a match almost surely and weighs half of it, others weigh one.
ENOUGH, WELL_WITHIN = 24, 0.6
# Groups that lines left with nothing confirmed are read again; so many of them are broadcast, more are joined.
MOST_BROADCAST = 1_000_000
TOKEN_BITS = 44
LOW_TOKEN, LOW_36 = np.uint64((1 << 44) - 1), np.uint64((1 << 36) - 1)
# What str.split() leaves as words: white space there is Unicode's, and the four separators.
WORD = r"(?U)[^\s\x1c-\x1f\x85]"
# A posting packs 32 bits of its token, the tokens left from it on and the role; and its line's number and size.
MOST_SIZE = (1 << 24) - 1


# What str.split() takes as white space, as bytes of UTF-8: single ones, and the sequences of two and three.
SPACE = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
SPACES_2 = np.array([0xC285, 0xC2A0])
SPACES_3 = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])
# The first so many bytes of eight, as an integer; words beyond MOST_WORD_BYTES are hashed one by one.
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
MOST_WORD_BYTES = 256


def wide_spaces_out(data: np.ndarray) -> None:
    """Turns white space beyond ASCII into spaces, in place; ``data`` ends with spaces."""
    at = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    lead, second, third = (data[at + k].astype(np.int64) for k in range(3))
    two = at[np.isin(lead << 8 | second, SPACES_2)]
    three = at[np.isin(lead << 16 | second << 8 | third, SPACES_3)]
    for where, width in ((two, 2), (three, 3)):
        for k in range(width):
            data[where + k] = 32


def hashes_at(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words data[start:end], eight bytes at a time; eight bytes follow the last word."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    left = ends - starts
    h = left.astype(np.uint64) * MIX_1
    long = np.flatnonzero(left > MOST_WORD_BYTES)
    now, at = np.flatnonzero(left <= MOST_WORD_BYTES) if len(long) else slice(None), starts
    if len(long):
        at, left = starts[now], left[now]
    while len(at):
        h[now] = mixed(h[now] ^ (eight[at] & FIRST_BYTES[np.minimum(left, 8)]))
        more = np.flatnonzero(left > 8)
        now = more if isinstance(now, slice) else now[more]
        at, left = at[more] + 8, left[more] - 8
    for k in long.tolist():
        h[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]].tobytes())
    return h


def word_lines(texts: list[str | None], most_words: int = 150_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, line number, token hashes...) of the lines with words, in parts of about ``most_words`` words.

    Yields rows, line numbers and ``keys``: sorted distinct (line in part << 44 | token).  Texts are
    taken together, as bytes, up to some bytes a word; words are found and hashed for all of them at once.
    """
    most_words = min(most_words, 1 << 20)
    most_bytes = 8 * most_words
    pieces, total = [], 0  # (row, number of the first line, bytes)

    def parts():
        data = np.frombuffer(bytearray(b" " + b"\n".join(p for _, _, p in pieces) + b"\n" + b" " * 8), dtype=np.uint8)
        if (data >= 0x80).any():
            wide_spaces_out(data)
        space = SPACE[data]
        starts, ends = (np.flatnonzero(x) + 1 for x in (space[:-1] > space[1:], space[:-1] < space[1:]))
        breaks = np.flatnonzero(data == 10)
        upto = np.searchsorted(starts, breaks)
        sizes = np.diff(upto, prepend=0)
        lines = [p.count(b"\n") + 1 for _, _, p in pieces]
        rows = np.repeat([r for r, _, _ in pieces], lines)
        numbers = np.concatenate([np.arange(first, first + n) for (_, first, _), n in zip(pieces, lines, strict=True)])
        some = np.flatnonzero(sizes)
        begin, sizes, rows, numbers = (upto - sizes)[some], sizes[some], rows[some], numbers[some]
        part = begin // most_words
        cuts = [*np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist(), len(part)] if len(part) else []
        for i, j in zip(cuts, cuts[1:], strict=False):
            words = slice(begin[i], begin[j - 1] + sizes[j - 1])
            h = hashes_at(data, starts[words], ends[words]) >> np.uint64(64 - TOKEN_BITS)
            line = np.repeat(np.arange(j - i, dtype=np.uint64), sizes[i:j])
            keys = np.sort((line << np.uint64(TOKEN_BITS)) | h)
            yield rows[i:j], numbers[i:j], keys[np.append(True, keys[1:] != keys[:-1])]

    for row, text in enumerate(texts):
        data, at, first = (text or "").lower().encode(), 0, 0
        while at <= len(data):
            end = data.find(b"\n", at + most_bytes)
            piece = data[at:] if end < 0 else data[at:end]
            pieces.append((row, first, piece))
            total += len(piece)
            if total >= most_bytes:
                yield from parts()
                pieces, total = [], 0
            if end < 0:
                break
            at, first = end + 1, first + piece.count(b"\n") + 1
    if pieces:
        yield from parts()


def line_starts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and number of distinct tokens of each line in ``keys``."""
    line = keys >> np.uint64(TOKEN_BITS)
    starts = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
    return starts, np.diff(np.append(starts, len(keys)))


def line_keys(docs: DataFrame) -> DataFrame:
    """One row a line: doc_id, mark, line_no and the 128-bit key of its token set; and rows of token counts by bucket."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNT_BUCKETS, dtype=np.int64)
        fields = [("doc_id", pa.int64()), ("mark", pa.int64()), ("line_no", pa.int32()), ("key_1", pa.int64()), ("key_2", pa.int64()), ("chunk", pa.int32()), ("task", pa.int32()), ("counts", pa.binary())]
        schema = pa.schema(fields)
        for batch in batches:
            ids, marks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "mark"))
            with no_gc():
                for rows, numbers, keys in word_lines(batch.column("text").to_pylist()):
                    starts, _ = line_starts(keys)
                    token = keys & LOW_TOKEN
                    counts += np.bincount((token & np.uint64(COUNT_BUCKETS - 1)).astype(np.int64), minlength=COUNT_BUCKETS)
                    own = [pa.array(ids[rows]), pa.array(marks[rows]), pa.array(numbers, pa.int32()), *map(pa.array, set_keys(token, starts))]
                    yield pa.RecordBatch.from_arrays([*own, *(pa.nulls(len(rows), kind) for _, kind in fields[5:])], schema=schema)
        if counts.any():
            n = COUNT_BUCKETS // COUNT_CHUNK
            packed = [zlib.compress(c.tobytes(), 1) for c in counts.astype("<i8").reshape(n, COUNT_CHUNK)]
            sums = [pa.array(range(n), pa.int32()), pa.array([TaskContext.get().partitionId()] * n, pa.int32()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(n, kind) for _, kind in fields[:5]), *sums], schema=schema)

    return docs.mapInArrow(read, "doc_id long, mark long, line_no int, key_1 long, key_2 long, chunk int, task int, counts binary")


def set_keys(token: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each line's token set."""
    with np.errstate(over="ignore"):
        one = np.add.reduceat(mixed(token + MIX_1), starts)
        two = np.add.reduceat(mixed(token * MIX_1 + np.uint64(1)), starts)
    return one.view(np.int64), two.view(np.int64)


def rarity_codes(lines: DataFrame) -> np.ndarray:
    """A byte for each bucket of tokens that grows with the number of lines that have them.

    Tasks send their counts by chunk; they are added in two levels, so that no
    group holds more than TASKS_PER_SUM small chunks or one row for each such sum.
    """

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), "<i8") for c in frame["counts"])
        return pd.DataFrame({"chunk": frame["chunk"].iloc[:1], "counts": [zlib.compress(total.tobytes(), 1)]})

    def code(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), "<i8") for c in frame["counts"])
        codes = np.minimum(255, np.ceil(6 * np.log2(total + 1))).astype(np.uint8)
        return pd.DataFrame({"chunk": frame["chunk"].iloc[:1], "codes": [codes.tobytes()]})

    sums = (
        lines.where("chunk is not null")
        .select("chunk", "counts", (F.col("task") / TASKS_PER_SUM).cast("int").alias("level"))
        .groupBy("chunk", "level")
        .applyInPandas(add, "chunk int, counts binary")
        .groupBy("chunk")
        .applyInPandas(code, "chunk int, codes binary")
    )
    out = np.zeros(COUNT_BUCKETS, dtype=np.uint8)
    for row in sums.collect():  # 256 rows of 4 KB
        out[row["chunk"] * COUNT_CHUNK : (row["chunk"] + 1) * COUNT_CHUNK] = np.frombuffer(row["codes"], np.uint8)
    return out


# The code of a bucket that counts one line.
ALONE = 6


def prefixes(docs: DataFrame, codes: np.ndarray, percent: int, block_lines: int) -> DataFrame:
    """(key_1, key_2, size, parity, tokens): of each line the prefix tokens, rarest first, and what the filters need.

    Sets with at least ``percent`` similarity share a token among the first
    n - ceil(percent n) + 1 of the common order (rarity code, token).  Lines of a token whose
    bucket counts more than ``block_lines`` are dealt into square blocks: each line meets
    each block once as the later (role 1) and once as the earlier one (role 2).
    Of equal lines in one batch part, one stands for all.  Tokens whose
    bucket counts one line have no partner and are left out.  ``tokens`` packs 32
    bits of each token, the number of tokens from it on and the role.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codes)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_of = shared.value
        blocks_of = np.maximum(1, np.ceil((np.exp2(np.arange(256) / 6) - 1) / block_lines)).astype(np.int64)
        for batch in batches:
            with no_gc():
                for _, _, keys in word_lines(batch.column("text").to_pylist()):
                    starts, sizes = line_starts(keys)
                    token = keys & LOW_TOKEN
                    one, two = set_keys(token, starts)
                    parity = np.bitwise_xor.reduceat(np.uint64(1) << (mixed(token) >> np.uint64(58)), starts)
                    code = code_of[(token & np.uint64(COUNT_BUCKETS - 1)).astype(np.int64)].astype(np.uint64)
                    line = keys >> np.uint64(TOKEN_BITS)
                    ranked_tokens = np.sort((line << np.uint64(TOKEN_BITS)) | (code << np.uint64(36)) | (token & LOW_36))
                    of = (ranked_tokens >> np.uint64(TOKEN_BITS)).astype(np.int64)
                    place = np.arange(len(ranked_tokens)) - starts[of]
                    prefix = sizes - (sizes * percent + 99) // 100 + 1
                    first = np.zeros(len(starts), dtype=bool)
                    order = np.lexsort((two, one))
                    first[order] = np.append(True, (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]]))
                    keep = (place < prefix[of]) & first[of] & ((ranked_tokens & LOW_TOKEN) >> np.uint64(36) > ALONE)
                    of, place, tokens = of[keep], place[keep], ranked_tokens[keep] & LOW_TOKEN
                    role = np.full(len(of), 3, dtype=np.int64)
                    blocks = blocks_of[(tokens >> np.uint64(36)).astype(np.int64)]
                    if (blocks > 1).any():
                        of, place, tokens, role = in_blocks(of, place, tokens, blocks, one.view(np.uint64))
                        order = np.argsort(of, kind="stable")
                        of, place, tokens, role = of[order], place[order], tokens[order], role[order]
                    high = (mixed(tokens) >> np.uint64(32) << np.uint64(32)).view(np.int64)
                    begin = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, np.int64)
                    lines = of[begin]
                    packed = high | (np.minimum(sizes[of] - place, MOST_SIZE) << 2) | role
                    ends = np.append(begin, len(of)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(one[lines]),
                            pa.array(two[lines]),
                            pa.array(np.minimum(sizes[lines], MOST_SIZE)),
                            pa.array(parity[lines].view(np.int64)),
                            pa.ListArray.from_arrays(pa.array(ends), pa.array(packed)),
                        ],
                        names=["key_1", "key_2", "size", "parity", "tokens"],
                    )

    return docs.select("text").mapInArrow(read, "key_1 long, key_2 long, size long, parity long, tokens array<long>")


def postings(docs: DataFrame, classes: DataFrame, codes: np.ndarray, percent: int, block_lines: int) -> DataFrame:
    """(token, line, parity): a row for each line class and prefix token; ``line`` is the class's number and size.

    Written once by class, so that who reads it again does not split and hash the texts again.
    """
    numbered = prefixes(docs, codes, percent, block_lines).join(classes.select("key_1", "key_2", "c"), ["key_1", "key_2"])
    line = F.shiftleft("c", 24) + F.col("size")
    written = staged(numbered.select("tokens", line.alias("line"), "parity"), "line-prefixes")
    return written.select(F.explode("tokens").alias("token"), "line", "parity")


def in_blocks(of, place, ranked, blocks, key) -> tuple:
    """Postings with those of frequent tokens repeated for each block of later and earlier lines."""
    parts = [(of[blocks == 1], place[blocks == 1], ranked[blocks == 1], np.full((blocks == 1).sum(), 3, np.int64))]
    for n in np.unique(blocks[blocks > 1]).tolist():
        at = np.flatnonzero(blocks == n)
        own = (mixed(key[of[at]]) % np.uint64(n)).astype(np.uint64)
        for other in range(n):
            o = np.uint64(other)
            same = own == o
            with np.errstate(over="ignore"):
                later = mixed(ranked[at] * MIX_1 + own * np.uint64(n) + o)
                earlier = mixed(ranked[at] * MIX_1 + o * np.uint64(n) + own)
            parts.append((of[at], place[at], later, np.where(same, 3, 1).astype(np.int64)))
            parts.append((of[at][~same], place[at][~same], earlier[~same], np.full((~same).sum(), 2, np.int64)))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def first_matches(sorted_postings: DataFrame, percent: int, enough: int = ENOUGH) -> DataFrame:
    """Candidates (c, o, left) among line classes that share a prefix token; o is the earlier one.

    The input comes sorted by (token, line) within partitions.  All
    groups of a batch are compared at once, row against the row d before it,
    for d = 1, 2, ...; a line leaves with candidates of weight ``enough``, so a group of near copies
    costs time in proportion to its size.  ``left`` is the group (the token's 32 bits) if a line left it with rows to go, else null.

    Filters: the bits in which the parity bitmaps differ, a lower bound of the symmetric difference, sizes, and tokens left from
    the shared one on.
    """

    def compare(token: np.ndarray, line: np.ndarray, parity: np.ndarray) -> pa.RecordBatch:
        group = token >> 32
        fresh = np.append(True, (group[1:] != group[:-1]) | (line[1:] != line[:-1]) | ((token[1:] ^ token[:-1]) & 3 != 0))
        token, line, parity, group = token[fresh], line[fresh], parity[fresh].view(np.uint64), group[fresh]
        n = len(token)
        new = np.append(True, group[1:] != group[:-1])
        depth = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
        found, more = np.zeros(n, np.int32), np.zeros(n, bool)
        left, right = [], []
        number, size, rest, role = line >> 24, line & MOST_SIZE, (token & 0xFFFFFFFF) >> 2, token & 3
        # The other set has at most size / percent tokens; a size that is too large to note passes.
        widest = np.where(size < MOST_SIZE, (size * (100 - percent)) // percent, 64)
        active, d = np.flatnonzero((depth >= 1) & (role & 1 > 0)), 1
        while len(active):
            near = np.bitwise_count(parity[active] ^ parity[active - d]) <= widest[active]
            i = active[near]
            j = i - d
            both = size[i] + size[j]
            need = -(-both * percent // (100 + percent))  # common tokens at this similarity
            differ, bound = np.bitwise_count(parity[i] ^ parity[j]), both - 2 * need
            ok = (role[j] & 2 > 0) & (number[i] != number[j])
            fits = (np.minimum(rest[i], rest[j]) >= need) & (np.minimum(size[i], size[j]) >= need) & (differ <= bound)
            ok &= fits | (np.maximum(size[i], size[j]) >= MOST_SIZE)
            sure = differ[ok] <= WELL_WITHIN * bound[ok]
            i, j = i[ok], j[ok]
            left.append(i)
            right.append(j)
            found[i] += np.where(sure, enough // 2, 1)
            d += 1
            going = depth[active] >= d
            full = found[active] >= enough
            more[active[full & going]] = True
            active = active[~full & going]
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        return pa.RecordBatch.from_arrays([pa.array(number[i]), pa.array(number[j]), pa.array(group[i], mask=~more[i])], names=["c", "o", "left"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            c = [batch.column(x).to_numpy(zero_copy_only=False) for x in ("token", "line", "parity")]
            if not batch.num_rows:
                continue
            group = c[0] >> 32
            cut = int(np.searchsorted(group == group[-1], True))  # the last token may go on
            if held and (cut or held[-1][0][-1] >> 32 != group[-1]):
                yield compare(*(np.concatenate([h[k] for h in held] + [c[k][:cut]]) for k in range(3)))
                held = []
            elif cut:
                yield compare(*(x[:cut] for x in c))
            held.append(tuple(x[cut:] for x in c))
        if held:
            yield compare(*(np.concatenate([h[k] for h in held]) for k in range(3)))

    return sorted_postings.mapInArrow(read, "c long, o long, left long")


def line_texts(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(c, line): the texts of the line classes ``wanted`` (c), each from where it stands first."""
    places = classes.select("c", "first.*").join(wanted, "c").groupBy("doc_id", "mark")
    by_doc = places.agg(F.collect_list(F.struct("line_no", "c")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, lines = [], []
            for text, places in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                split = text.lower().split("\n")
                numbers += [p["c"] for p in places]
                lines += [split[p["line_no"]] for p in places]
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(lines, pa.string())], names=["c", "line"])

    found = docs.join(by_doc, ["doc_id", "mark"]).select("text", "wanted").mapInArrow(cut, "c long, line string")
    return found.dropDuplicates(["c"])  # rows may be repeated whole


def confirmed(pairs: DataFrame, lines: DataFrame, percent: int) -> DataFrame:
    """The numbers c of the candidate pairs (c, o) that are alike enough as word sets."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, b = [], None, set()
            with no_gc():
                for x, y in zip(batch.column("line").to_pylist(), batch.column("other").to_pylist(), strict=True):
                    if y != last:  # pairs come by their earlier line
                        last, b = y, set(y.split())
                    a = set(x.split())
                    both = len(a & b)
                    keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["c"]).filter(pa.array(keep, pa.bool_()))

    other = lines.withColumnsRenamed({"c": "o", "line": "other"})
    met = pairs.select("c", "o").join(lines, "c").join(other, "o").select("c", "line", "other")
    return met.mapInArrow(alike, "c long").distinct()


def repeated_classes(docs: DataFrame, classes: DataFrame, codes: np.ndarray, percent: int, block_lines: int) -> DataFrame:
    """(c) of the line classes that have an earlier class alike enough.

    A class is settled by its first confirmed candidate: the one it shares most prefix tokens with is
    tried first, then the others, and for those that are still open although they left a group early, all the rest of
    their groups.
    """
    posted = postings(docs, classes, codes, percent, block_lines)
    token = F.shiftright("token", 32)
    met = staged(first_matches(posted.repartition(token).sortWithinPartitions(token, "line"), percent), "line-matches")
    pairs = staged(met.groupBy("c", "o").agg(F.count(F.lit(1)).alias("votes")), "line-pairs")
    wanted = pairs.select("c").union(pairs.select(F.col("o").alias("c"))).distinct()
    lines = staged(line_texts(wanted, classes, docs), "line-texts")
    best = pairs.groupBy("c").agg(F.max_by("o", F.struct("votes", -F.col("o"))).alias("o"))
    settled = staged(confirmed(best, lines, percent), "line-near")
    others = pairs.join(settled, "c", "left_anti").join(best, ["c", "o"], "left_anti")
    settled = settled.union(staged(confirmed(others, lines, percent), "line-near"))

    left = staged(met.where("left is not null").select("c", F.col("left").alias("group")).distinct().join(settled, "c", "left_anti"), "line-left")
    groups = left.select("group").distinct()
    n = groups.count()
    if not n:
        return settled
    again = posted.withColumn("group", token).join(F.broadcast(groups) if n <= MOST_BROADCAST else groups, "group", "left_semi")
    parts = {"c": F.shiftright("line", 24), "size": F.col("line").bitwiseAND(MOST_SIZE), "rest": F.shiftright(F.col("token").bitwiseAND(0xFFFFFFFF), 2), "role": F.col("token").bitwiseAND(3)}
    every = staged(again.withColumns(parts).drop("token", "line").distinct(), "line-groups")
    x, y = every.where("role % 2 = 1").join(left, ["c", "group"], "left_semi").alias("x"), every.where("role >= 2").alias("y")
    both = F.col("x.size") + F.col("y.size")
    need = F.ceil(both * percent / (100 + percent) - 1e-9)
    fits = (
        (F.least("x.size", "y.size") >= need)
        & (F.least("x.rest", "y.rest") >= need)
        & (F.bit_count(F.col("x.parity").bitwiseXOR(F.col("y.parity"))) <= both - 2 * need)
    ) | (F.greatest("x.size", "y.size") >= MOST_SIZE)
    rest = x.join(y, (F.col("x.group") == F.col("y.group")) & (F.col("y.c") < F.col("x.c")) & fits).select("x.c", F.col("y.c").alias("o"))
    rest = staged(rest.distinct().join(pairs, ["c", "o"], "left_anti"), "line-rest")
    wanted = rest.select("c").union(rest.select(F.col("o").alias("c"))).distinct()
    return settled.union(confirmed(rest, staged(line_texts(wanted, classes, docs), "line-texts"), percent))


def kept_lines(docs: DataFrame, percent: int = PERCENT, block_lines: int = BLOCK_LINES) -> DataFrame:
    """(doc_id, mark, line_no) of every line with words that has no earlier match; ``docs`` has doc_id, mark and text.

    A line is its set of lower-cased words; two match if their Jaccard
    similarity is at least ``percent``; earlier is by (doc_id, mark, line_no).  Lines of equal sets are a class, which
    stands where its first line does; classes are numbered in that order.  Of a class only the first line can
    stay, so no class is ever gathered, and the join is between classes.
    """
    lines = staged(line_keys(docs), "line-keys")
    first = F.min(F.struct("doc_id", "mark", "line_no")).alias("first")
    groups = lines.where("chunk is null").groupBy("key_1", "key_2").agg(first).withColumn("all", F.lit(0))
    classes = ranked(groups, "all", [F.col("first")], "line-classes").select("key_1", "key_2", "first", F.col("pos").alias("c"))
    gone = repeated_classes(docs, classes, rarity_codes(lines), percent, block_lines)
    return classes.join(gone, "c", "left_anti").select("first.*")


def dedup_lines(docs: DataFrame, percent: int = PERCENT, block_lines: int = BLOCK_LINES) -> DataFrame:
    """``docs`` without the lines that have an earlier match, plus n_lines and n_removed.

    Blank lines never match and stay.  Defined cases: a null text stays null
    with no lines; an empty text has one blank line; rows with a null doc_id are
    returned as they are and take no part; texts of one doc_id are told apart and ordered by a hash of
    them (mark); rows of one doc_id and text count as one document and keep the same lines; columns named
    n_lines or n_removed are replaced.
    """
    rest = docs.drop("n_lines", "n_removed")
    key = F.col("doc_id").cast("long")
    known = docs.where("doc_id is not null and text is not null").select(key.alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    kept = kept_lines(known, percent, block_lines).groupBy("doc_id", "mark").agg(F.collect_list("line_no").alias("__kept"))
    kept = kept.withColumnsRenamed({"doc_id": "__doc_id", "mark": "__mark"})
    out = rest.join(kept, (key == F.col("__doc_id")) & (F.xxhash64("text") == F.col("__mark")), "left")
    takes_part = F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    lines = F.split("text", "\n", -1)

    def stays(line, i):
        return ~F.rlike(line, F.lit(WORD)) | F.array_contains(F.coalesce("__kept", F.array().cast("array<int>")), i)

    left = F.filter("__lines", stays)
    return (
        out.withColumn("__lines", lines)
        .withColumn("__left", F.when(takes_part, left).otherwise(F.col("__lines")))
        .withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size("__lines")))
        .withColumn("n_removed", F.when(F.col("text").isNull(), 0).otherwise(F.size("__lines") - F.size("__left")))
        .withColumn("text", F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.array_join("__left", "\n")))
        .select(*rest.columns, "n_lines", "n_removed")
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


# As the operator, for tables whose doc_id is set and unique: rarest tokens first, prefix and size filters, then the sets.
OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS line_no, string_split(text, chr(10))[i] AS line FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)
), sets AS (
  SELECT *, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(line), '\s+'), lambda w: w <> ''))) AS words FROM lines
), classes AS (
  SELECT words, len(words) AS n, min((doc_id, line_no)) AS first, row_number() OVER (ORDER BY min((doc_id, line_no))) AS c
  FROM sets WHERE len(words) > 0 GROUP BY words
), tokens AS (SELECT c, n, unnest(words) AS w FROM classes),
rarity AS (SELECT w, count(*) AS f FROM tokens GROUP BY w),
prefix AS (
  SELECT c, n, w FROM tokens JOIN rarity USING (w)
  QUALIFY row_number() OVER (PARTITION BY c ORDER BY f, w) <= n - (n * 80 + 99) // 100 + 1
), pairs AS (
  SELECT DISTINCT a.c, b.c AS o FROM prefix a JOIN prefix b ON a.w = b.w AND b.c < a.c AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), gone AS (
  SELECT DISTINCT p.c FROM pairs p JOIN classes a ON a.c = p.c JOIN classes b ON b.c = p.o
  WHERE 180 * len(list_intersect(a.words, b.words)) >= 80 * (a.n + b.n)
), kept AS (SELECT first FROM classes WHERE c NOT IN (SELECT c FROM gone)),
marked AS (
  SELECT s.*, len(s.words) = 0 OR k.first IS NOT NULL AS stays FROM sets s LEFT JOIN kept k ON k.first = (s.doc_id, s.line_no)
)
SELECT d.doc_id, coalesce(m.n, 0)::INTEGER AS n_lines, coalesce(m.gone, 0)::INTEGER AS n_removed, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(m.text, '') END AS text
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n, count_if(NOT stays) AS gone, string_agg(line, chr(10) ORDER BY line_no) FILTER (stays) AS text FROM marked GROUP BY doc_id
) m USING (doc_id)
"""
