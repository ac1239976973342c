"""Approximate nearest neighbours by NN-descent and greedy graph search (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duskwatch.llm.common import staged, table

DEGREE = 32  # neighbours kept for a node
SAMPLED = 32  # of them, and of those that name it, joined in a round
LEAF = 192  # nodes that are compared with each other at the start
TABLES = 4  # partitions of the nodes into such leaves
ROUNDS, LEAST_CHANGE = 6, 0.02
FIT_ROWS = 2_000  # bounded sample from which the split points of the leaves are taken
BEAM, PART_EXPANDED = 128, 4  # a round expands at most a fourth of a beam
ENTRIES = 32  # nodes of the greatest length, from which each query starts besides its own
# The beam widens until so much is found of the nearest of a few queries, which one pass over all rows tells.
RECALL, CHECKED, WIDER = 0.93, 64, 2
BLOCK_BYTES = 8 << 20  # of vectors that a task holds to score what queries ask for, about; at least two blocks
SEED = 20240612


@dataclass(frozen=True)
class Index:
    """vectors (node, v), members (node, vec_id: those with the node's very vector), graph (node, ids, scores).

    blocks: the vectors by block, which is the first ``bits`` bits of a node's number, as bytes (``packed``).
    """

    vectors: DataFrame
    members: DataFrame
    graph: DataFrame
    blocks: DataFrame
    bits: int


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of the rows with an id and a vector that is not null or zero and has only finite components."""
    v = F.col(vector)
    return vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )


def matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows of a list column as a matrix; all lists have one length."""
    n = len(lists)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def list_column(parts: list[np.ndarray], kind) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


GRAPH = "node long, ids array<long>, scores array<double>"
# Hits of compared groups that a task holds before it passes them on.
HELD_HITS = 500_000


def compare_group(groups: DataFrame, keep: int) -> DataFrame:
    """For each row's group of (node, v, worst, new), each node's ``keep`` best others in the group, as GRAPH rows.

    Only others nearer than the node's ``worst`` come out, and none where neither of the two is new.
    """

    def rows(nodes: list, counts: list, ids: list, scores: list) -> pa.RecordBatch:
        count = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        ends = pa.array(np.concatenate([[0], np.cumsum(count[count > 0])]).astype(np.int32))
        named = np.concatenate(nodes)[count > 0] if nodes else np.zeros(0, np.int64)
        flat = [np.concatenate(x) if x else np.zeros(0) for x in (ids, scores)]
        lists = [pa.ListArray.from_arrays(ends, pa.array(x, kind)) for x, kind in zip(flat, (pa.int64(), pa.float64()), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(named, pa.int64()), *lists], names=["node", "ids", "scores"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column("g")
            ends, values = group.offsets.to_numpy(), group.values
            node, v, worst = values.field("node").to_numpy(), matrix(values.field("v")), values.field("worst").to_numpy()
            old = ~values.field("new").to_numpy(zero_copy_only=False)
            found: tuple = ([], [], [], [])
            hits = 0
            for a, b in zip(ends, ends[1:], strict=False):
                if b - a < 2:
                    continue
                x, names = v[a:b].astype(np.float64), node[a:b]
                s = x @ x.T
                np.fill_diagonal(s, -np.inf)
                before = np.flatnonzero(old[a:b])
                if len(before):
                    s[np.ix_(before, before)] = -np.inf
                if b - a - 1 > keep:
                    best = np.argpartition(-s, keep - 1, axis=1)[:, :keep]
                    s = np.take_along_axis(s, best, axis=1)
                    row, place = np.nonzero(s > worst[a:b, None])
                    other = best[row, place]
                else:
                    row, place = np.nonzero(s > worst[a:b, None])
                    other = place
                for part, x in zip(found, (names, np.bincount(row, minlength=b - a), names[other], s[row, place]), strict=True):
                    part.append(x)
                hits += len(row)
                if hits > HELD_HITS:
                    yield rows(*found)
                    found, hits = ([], [], [], []), 0
            yield rows(*found)

    return groups.select("g").mapInArrow(compare, GRAPH)


def merged(rows: DataFrame, degree: int) -> DataFrame:
    """GRAPH rows with the best ``degree`` distinct neighbours of each node, which of them are new, and how many."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, scores, news = [], [], []
            lists = batch.column("found")
            ends, values = lists.offsets.to_numpy(), lists.values
            id_lists, score_lists, old = values.field("ids"), values.field("scores"), values.field("old").to_numpy(zero_copy_only=False)
            at = id_lists.offsets.to_numpy()
            all_ids, all_scores = id_lists.values.to_numpy(), score_lists.values.to_numpy()
            for a, b in zip(ends, ends[1:], strict=False):
                i, s, known = all_ids[at[a] : at[b]], all_scores[at[a] : at[b]], 0
                before = np.flatnonzero(old[a:b])
                if len(before):  # the list so far comes first, so the first of equal ids tells whether it is new
                    lo, hi = at[a + before[0]] - at[a], at[a + before[0] + 1] - at[a]
                    i, s, known = np.concatenate([i[lo:hi], i[:lo], i[hi:]]), np.concatenate([s[lo:hi], s[:lo], s[hi:]]), hi - lo
                distinct, first = np.unique(i, return_index=True)
                s = s[first]
                order = np.argsort(-s, kind="stable")[:degree]
                ids.append(distinct[order])
                scores.append(s[order])
                news.append(first[order] >= known)
            fresh = pa.array([int(x.sum()) for x in news], pa.int32())
            columns = [batch.column("node"), list_column(ids, pa.int64()), list_column(scores, pa.float64()), list_column(news, pa.bool_()), fresh]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "ids", "scores", "news", "fresh"])

    grouped = rows.groupBy("node").agg(F.collect_list(F.struct("ids", "scores", "old")).alias("found"))
    return grouped.mapInArrow(merge, GRAPH + ", news array<boolean>, fresh int")


def first_graph(vectors: DataFrame, n: int, degree: int) -> DataFrame:
    """Neighbours within random-projection leaves, several times; a leaf that is too large is split by a hash."""
    sample = np.array([r["v"] for r in vectors.orderBy(F.xxhash64("node")).limit(FIT_ROWS).select("v").collect()], dtype=np.float64)
    bits = max(0, int(np.ceil(np.log2(max(1, n / LEAF)))))
    rng = np.random.default_rng(SEED)
    planes = rng.standard_normal((TABLES, bits, sample.shape[1]))
    splits = np.median(np.einsum("nd,tbd->tbn", sample, planes), axis=2) if bits else np.zeros((TABLES, 0))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v")).astype(np.float64)
            for t in range(TABLES if bits else 1):
                above = (v @ planes[t].T > splits[t]) if len(v) else np.zeros((0, bits), bool)
                leaf = (above * (1 << np.arange(bits, dtype=np.int64))).sum(axis=1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(v), t, np.int32)), pa.array(leaf), *(batch.column(c) for c in ("node", "v"))],
                    names=["tree", "leaf", "node", "v"],
                )

    element = dict(vectors.dtypes)["v"]
    placed = vectors.mapInArrow(leaves, f"tree int, leaf long, node long, v {element}")
    sizes = placed.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / (2 * LEAF)).alias("parts"))
    dealt = placed.join(sizes, ["tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("node", "tree"), F.col("parts")))
    groups = dealt.groupBy("tree", "leaf", "part").agg(F.collect_list(F.struct("node", "v", F.lit(float("-inf")).alias("worst"), F.lit(True).alias("new"))).alias("g"))
    found = compare_group(groups, degree).withColumn("old", F.lit(False))
    alone = vectors.select("node", F.array().cast("array<long>").alias("ids"), F.array().cast("array<double>").alias("scores"), F.lit(False).alias("old"))
    return merged(found.union(alone), degree)


def descent(nodes: DataFrame, n: int, degree: int, rounds: int) -> DataFrame:
    """GRAPH rows of ``n`` nodes (node, v) whose vectors have one length.

    From the neighbours within random leaves, each round joins each node's neighbours with each other: the SAMPLED
    nearest it names, and as many of those that name it, newly found ones first, then by a hash.  Two that were there in the round
    before have met already.  It ends when few lists change.  A group is at
    most 2 * SAMPLED vectors, however many name a node; a popular node is met in parts, as the join
    is by a key that adaptive execution splits.  Only what is nearer than a node's list reaches so far goes on to be merged.
    """
    graph = staged(first_graph(nodes, n, degree), "ann-graph")
    for turn in range(rounds):
        named = graph.select(F.col("node").alias("of"), F.explode(F.slice(F.arrays_zip("ids", "news"), 1, SAMPLED)).alias("e"))
        named = named.select("of", F.col("e.ids").alias("nb"), F.col("e.news").alias("new"))
        # Of a node that many name, each task passes on no more than it may keep.
        pick = F.row_number().over(Window.partitionBy("nb").orderBy(F.desc("new"), F.xxhash64("of", "nb", F.lit(turn)), "of"))
        naming = named.withColumn("pick", pick).where(F.col("pick") <= SAMPLED).select(F.col("nb").alias("of"), F.col("of").alias("nb"), "new")
        worst = F.coalesce(F.get("scores", F.lit(degree - 1)), F.lit(float("-inf"))).alias("worst")
        known = nodes.join(graph.select("node", worst), "node").withColumnRenamed("node", "nb")
        held = named.union(naming).groupBy("of", "nb").agg(F.max("new").alias("new")).join(known, "nb")
        groups = held.groupBy("of").agg(F.collect_list(F.struct(F.col("nb").alias("node"), "v", "worst", "new")).alias("g"))
        found = compare_group(groups.where(F.exists("g", lambda e: e["new"])), 2 * SAMPLED).withColumn("old", F.lit(False))
        graph = staged(merged(found.union(graph.select("node", "ids", "scores", F.lit(True).alias("old"))), degree), "ann-graph")
        if graph.agg(F.sum("fresh")).first()[0] < LEAST_CHANGE * n * degree:
            break
    return graph.select("node", "ids", "scores")


def block_bits(spark: SparkSession, n: int, components: int) -> int:
    """Bits that number blocks of about BLOCK_BYTES, two to each core that there is, of 64 nodes or more."""
    most = max(2, min(2 * spark.sparkContext.defaultParallelism, n // 64), n * components * 4 // BLOCK_BYTES)
    return int(np.ceil(np.log2(most)))


BLOCKS = "block int, size int, names binary, vs binary"


def packed(vectors: DataFrame, bits: int) -> DataFrame:
    """BLOCKS rows: the numbers and vectors of some nodes of one block whose vectors have ``size`` components, as bytes."""
    kind = {"array<float>": "<f4"}.get(dict(vectors.dtypes)["v"], "<f8")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, block, v = batch.column("node").to_numpy(), batch.column("block").to_numpy(), batch.column("v")
            sizes = np.diff(v.offsets.to_numpy())
            out: tuple = ([], [], [], [])
            for b in np.unique(block):
                for d in np.unique(sizes[block == b]):
                    rows = np.flatnonzero((block == b) & (sizes == d))
                    values = matrix(v.take(pa.array(rows))).astype(kind)
                    for part, x in zip(out, (b, d, node[rows].astype("<i8").tobytes(), values.tobytes()), strict=True):
                        part.append(x)
            columns = [pa.array(x, t) for x, t in zip(out, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "size", "names", "vs"])

    wide = vectors.select("node", F.shiftright("node", 64 - bits).cast("int").alias("block"), "v" if kind == "<f4" else F.col("v").cast("array<double>"))
    return wide.repartition(1 << bits, "block").mapInArrow(pack, BLOCKS)


def build_index(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", degree: int = DEGREE, rounds: int = ROUNDS) -> Index:
    """Neighbour graph of all usable vectors, near by the inner product of the vectors themselves.

    Vectors of any lengths may occur; long ones are neighbours of many, and a search climbs to them as it should.
    Equal vectors are one node, of the least id.  Vectors with different numbers of components have no inner product
    and are indexed side by side, one graph for each number (read by the driver: a few).

    Defined cases: rows without id, and vectors that are null, zero or hold null or non-finite components
    take no part; rows that repeat an id with another vector are members of both nodes; no usable
    vector gives an empty index; other columns are ignored.
    """
    rows = usable(vectors, key, vector)
    grouped = staged(rows.groupBy("v").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")), "ann-nodes")
    # A node's number is a hash, so that nodes are dealt out evenly by it; of one id alone it is a permutation of the ids.
    # An id that has several vectors names its node by the first; others get numbers of their own.
    twice = F.row_number().over(Window.partitionBy("low").orderBy("v"))
    nodes = staged(grouped.withColumn("nth", twice).select(F.when(F.col("nth") == 1, F.xxhash64("low")).otherwise(F.xxhash64("low", "nth")).alias("node"), "v", "n"), "ann-vectors")
    members = staged(rows.join(nodes.select("v", "node"), "v").select("node", F.col("id").alias("vec_id")).distinct(), "ann-members")
    sizes = {r["d"]: r["n"] for r in nodes.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    nodes = nodes.select("node", "v")
    bits = block_bits(nodes.sparkSession, sum(sizes.values()), max(sizes, default=1))
    blocks = staged(packed(nodes, bits), "ann-blocks")
    if not sizes:
        return Index(nodes, members, nodes.sparkSession.createDataFrame([], GRAPH), blocks, bits)
    graphs = [descent(nodes.where(F.size("v") == d) if len(sizes) > 1 else nodes, n, degree, rounds) for d, n in sorted(sizes.items())]
    return Index(nodes, members, reduce(DataFrame.union, graphs), blocks, bits)


def nearest_by_all(index: Index, queries: DataFrame, k: int, most: int = CHECKED) -> DataFrame:
    """(query_id, node): the ``k`` nearest nodes of at most ``most`` of the queries, by a hash, compared with all nodes."""
    rows = queries.select("query_id", "q").orderBy(F.xxhash64("query_id"), "query_id").limit(most).collect()
    ids = np.array([r["query_id"] for r in rows], dtype=np.int64)
    by_size = {d: ([i for i, r in enumerate(rows) if len(r["q"]) == d]) for d in {len(r["q"]) for r in rows}}
    asked = {d: (ids[at], np.array([rows[i]["q"] for i in at], dtype=np.float64)) for d, at in by_size.items()}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        for batch in batches:
            node, size = batch.column("node").to_numpy(), np.diff(batch.column("v").offsets.to_numpy())
            for d, (_, q) in asked.items():
                mine = np.flatnonzero(size == d)
                if len(mine):
                    s = q @ matrix(batch.column("v").take(pa.array(mine))).astype(np.float64).T
                    old_n, old_s = best.get(d, (np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0))))
                    n, s = np.hstack([old_n, np.broadcast_to(node[mine], s.shape)]), np.hstack([old_s, s])
                    order = np.lexsort((n, -s), axis=1)[:, :k]
                    best[d] = np.take_along_axis(n, order, axis=1), np.take_along_axis(s, order, axis=1)
        for d, (n, s) in best.items():
            flat = [np.repeat(asked[d][0], n.shape[1]), n.ravel(), s.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in flat], names=["query_id", "node", "score"])

    rows = index.vectors.select("node", "v").mapInArrow(compare, "query_id long, node long, score double")
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "node"))
    return rows.withColumn("nth", order).where(F.col("nth") <= k).select("query_id", "node")


def search(index: Index, queries: DataFrame, k: int = 20, beam: int = BEAM, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query (query_id, q, own) its ``k`` nearest by inner product in double precision.

    ``own`` is the query's vec_id in the index, never returned, or null.  A query keeps
    its best ``beam`` nodes; each round expands the best ones not expanded yet, for all
    queries at once by joins with the graph and the vectors, until none is left.
    A query starts from its own node, if it is in the index, and from the ENTRIES nodes of the greatest length.
    How much that finds depends on the vectors, so it is measured: the nearest nodes of CHECKED queries are also taken
    by comparison with all.  Until their beams hold the share ``recall`` of them, these few start again with a beam WIDER times as wide
    and as many more entries, half of them the longest nodes and half by a hash; a beam as wide as the index holds all nodes.
    All queries then climb once, at the width found; a query's climb does not depend on the others.

    Defined cases: ties go to the smaller vec_id; fewer than ``k`` candidates are all returned if the
    search reaches them, as it does when there are no more than ENTRIES nodes; queries whose vector has another
    number of components than all nodes get no rows; no queries or an empty index: no rows.
    """
    placed = staged(queries, "ann-queries")
    nearest = staged(nearest_by_all(index, placed, k + 1), "ann-nearest")
    asked, n = nearest.count(), index.vectors.count()
    few = staged(placed.join(nearest.select("query_id").distinct(), "query_id", "left_semi"), "ann-checked")
    narrow, n_few, n_all = beam, few.count(), placed.count()
    while True:
        state = climbed(index, few, n_few, beam, narrow)
        held = F.array_contains(F.transform("beam", lambda e: e["node"]), F.col("node"))
        if beam >= n or nearest.join(state, "query_id").where(held).count() >= recall * asked:
            break
        beam *= WIDER
    if n_all > n_few:
        state = climbed(index, placed, n_all, beam, narrow)
    # The own id is all there is of some nodes; k others, and what is as near as the last of them, hold the result.
    own = placed.join(index.members.select(F.col("vec_id").alias("own"), "node"), "own").groupBy("query_id").agg(F.count(F.lit(1)).alias("mine"))
    last = F.element_at("beam", F.least(F.size("beam"), (k + F.coalesce("mine", F.lit(0))).cast("int")))["s"]
    best = state.join(own, "query_id", "left").select("query_id", "beam", last.alias("last"))
    found = best.select("query_id", F.explode(F.filter("beam", lambda e: e["s"] <= F.col("last"))).alias("e")).select("query_id", F.col("e.node").alias("node"), (-F.col("e.s")).alias("score"))
    # No query returns more of a node's members than k; those of the least ids come first.
    least = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    members = index.members.withColumn("rank", least).where(F.col("rank") <= k + 1).select("node", "vec_id")
    every = found.join(members, "node").join(placed.select("query_id", "own"), "query_id").where(~F.col("vec_id").eqNullSafe(F.col("own")))
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


# Nearest first, then by node: s is the negative score.
BEAM_TYPE, FOUND_TYPE = "array<struct<s:double,node:long,expanded:boolean>>", "array<struct<s:double,node:long>>"
# Beams of so many places in all are a bounded table: what they ask for goes to the graph by broadcast.
MOST_PLACES = 1 << 15


def products(q: np.ndarray, v: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Inner products in double precision of lists of ``sizes`` components that stand one after the other."""
    return np.add.reduceat(q * v, np.cumsum(sizes) - sizes, dtype=np.float64) if len(sizes) else np.zeros(0)


def scored_few(index: Index, asked: DataFrame) -> DataFrame:
    """As ``scored`` for a few queries: their rows are sent to the nodes, which are not dealt out."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, v = batch.column("q"), batch.column("v")
            s = products(*(x.flatten().to_numpy(zero_copy_only=False).astype(np.float64) for x in (q, v)), np.diff(q.offsets.to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("node"), pa.array(-s)], names=["query_id", "node", "s"])

    pairs = asked.select("query_id", F.explode("ids").alias("node"))
    met = index.vectors.select("node", "v").join(F.broadcast(pairs), "node").join(F.broadcast(asked.select("query_id", "q")), "query_id")
    rows = met.where(F.size("q") == F.size("v")).select("query_id", "node", "q", "v").mapInArrow(score, "query_id long, node long, s double")
    return rows.groupBy("query_id").agg(F.collect_list(F.struct("s", "node")).alias("found"))


def scored(index: Index, asked: DataFrame) -> DataFrame:
    """(query_id, found): of the nodes ``ids`` that a row of (query_id, q, last, ids) asks for, those with s <= last.

    A query's vector goes once to each block that holds some of the nodes; there a task scores them all, so no vector
    of a node is joined to a query that asks for it.
    """
    kind = {"array<float>": "<f4"}.get(dict(index.vectors.dtypes)["v"], "<f8")
    of_list = pa.list_(pa.struct([("s", pa.float64()), ("node", pa.int64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, tables = None, {}
        for batch in batches:
            blocks, sizes, last = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "size", "last"))
            names, vs, q, ids = (batch.column(c) for c in ("names", "vs", "q", "ids"))
            holds = names.is_valid().to_numpy(zero_copy_only=False)
            q_at, q_all = q.offsets.to_numpy(), q.values.to_numpy(zero_copy_only=False)
            at, all_ids = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
            rows, counts, s, nodes = [], [], [], []
            for r in range(batch.num_rows):
                if blocks[r] != here:  # a block's nodes come before what is asked of it
                    here, tables = blocks[r], {}
                if holds[r]:
                    part = np.frombuffer(names[r].as_buffer(), "<i8"), np.frombuffer(vs[r].as_buffer(), kind).reshape(-1, int(sizes[r]))
                    tables.setdefault(int(sizes[r]), []).append(part)
                    continue
                mine = q_all[q_at[r] : q_at[r + 1]].astype(np.float64)
                held = tables.get(len(mine))
                if held is None:
                    continue
                if isinstance(held, list):
                    known, v = (np.concatenate(x) for x in zip(*held, strict=True))
                    order = np.argsort(known)
                    held = tables[len(mine)] = known[order], v[order]
                known, v = held
                want = all_ids[at[r] : at[r + 1]]
                place = np.minimum(np.searchsorted(known, want), len(known) - 1)
                place = place[known[place] == want]
                far = -products(np.tile(mine, len(place)), v[place].astype(np.float64).ravel(), np.full(len(place), len(mine)))
                near = far <= last[r]
                if near.any():
                    rows.append(r)
                    s.append(far[near])
                    nodes.append(known[place[near]])
                    counts.append(len(s[-1]))
            ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            flat = [np.concatenate(x) if x else np.zeros(0) for x in (s, nodes)]
            pairs = pa.StructArray.from_arrays([pa.array(flat[0]), pa.array(flat[1], pa.int64())], fields=list(of_list.value_type))
            queries = batch.column("query_id").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([queries, pa.ListArray.from_arrays(ends, pairs)], names=["query_id", "found"])

    # The least numbers of the blocks are sorted in with the ids; a block's ids stand between its own and the next one's.
    half, shift = 1 << (index.bits - 1), 64 - index.bits
    marks = F.expr(f"transform(sequence({-half}, {half - 1}), k -> shiftleft(cast(k as bigint), {shift}))")
    every = asked.select("query_id", "q", "last", F.sort_array(F.concat(F.array_compact("ids"), marks)).alias("all"))
    by_block = every.select("*", F.explode(F.sequence(F.lit(-half), F.lit(half - 1))).alias("block"))
    begin = F.expr(f"cast(array_position(all, shiftleft(cast(block as bigint), {shift})) as int)")
    end = F.expr(f"cast(if(block = {half - 1}, size(all) + 1, array_position(all, shiftleft(cast(block + 1 as bigint), {shift}))) as int)")
    wanted = by_block.select("query_id", "q", "last", "block", "all", begin.alias("begin"), end.alias("end")).where("end > begin + 1")
    wanted = wanted.select("block", F.lit(None).cast("int").alias("size"), F.lit(None).cast("binary").alias("names"), F.lit(None).cast("binary").alias("vs"), "query_id", "q", "last", F.slice("all", F.col("begin") + 1, F.col("end") - F.col("begin") - 1).alias("ids"))
    kinds = dict(wanted.dtypes)
    blocks = index.blocks.select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in ("query_id", "q", "last", "ids")])
    dealt = blocks.union(wanted).repartition(1 << index.bits, "block").sortWithinPartitions("block", F.col("names").isNull())
    rows = dealt.mapInArrow(score, f"query_id long, found {FOUND_TYPE}")
    return rows.groupBy("query_id").agg(F.flatten(F.collect_list("found")).alias("found"))


def climbed(index: Index, placed: DataFrame, asked: int, beam: int, narrow: int) -> DataFrame:
    """(query_id, q, beam): the best ``beam`` nodes of each of the ``asked`` queries ``placed``, once each of them is expanded.

    A query's state is one row throughout, and it asks with one row for all it wants from a block of nodes
    (``scored``).  With a beam wider than ``narrow`` a query has more entries.
    """
    nodes, graph = index.vectors.select("node", "v"), index.graph.select("node", "ids")
    step = max(1, beam // PART_EXPANDED)
    little = asked * beam <= MOST_PLACES
    sent = F.broadcast if little else (lambda rows: rows)
    score = scored_few if little else scored

    def entries(most: int, *order) -> DataFrame:
        """Pairs of each query with the first ``most`` nodes of its number of components."""
        nth = F.row_number().over(Window.partitionBy(F.size("v")).orderBy(*order, "node"))
        first = nodes.withColumn("nth", nth).where(F.col("nth") <= most).select("node", F.size("v").alias("d"))
        return placed.join(F.broadcast(first), F.size("q") == F.col("d")).select("query_id", "node")

    def merged_beams(rows: DataFrame) -> DataFrame:
        """(query_id, q, beam) of (query_id, q, beam, found), with this round's front marked."""
        last = F.try_element_at(F.slice(F.filter("beam", lambda e: ~e["expanded"]), 1, step), F.lit(-1))
        before = (F.col("beam"), F.col("last.s"), F.col("last.node"))

        def mark(e):
            front = (e["s"] < before[1]) | ((e["s"] == before[1]) & (e["node"] <= before[2]))
            return F.struct(e["s"].alias("s"), e["node"].alias("node"), (e["expanded"] | F.coalesce(front, F.lit(False))).alias("expanded"))

        new = F.transform("found", lambda e: F.struct(e["s"].alias("s"), e["node"].alias("node"), F.lit(False).alias("expanded")))
        best = F.slice(F.sort_array(F.concat(F.transform(before[0], mark), new)), 1, beam)
        beams = rows.withColumn("last", last).select("query_id", "q", best.cast(BEAM_TYPE).alias("beam"))
        return staged(beams.withColumn("open", F.exists("beam", lambda e: ~e["expanded"])), "ann-beam")

    home = index.members.select(F.col("vec_id").alias("own"), "node")
    more = ENTRIES * beam // BEAM // 2
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    wanted = placed.join(home, "own").select("query_id", "node").union(entries(max(ENTRIES, more), F.desc(norm)))
    if beam > narrow:
        wanted = wanted.union(entries(more, F.xxhash64("node")))
    found = F.coalesce("found", F.array().cast(FOUND_TYPE)).alias("found")
    ids = wanted.groupBy("query_id").agg(F.collect_set("node").alias("ids"))
    first = score(index, ids.join(placed, "query_id").select("query_id", "q", F.lit(float("inf")).alias("last"), "ids"))
    state = merged_beams(placed.join(first, "query_id").select("query_id", "q", F.array().cast(BEAM_TYPE).alias("beam"), found))
    while True:
        front = F.slice(F.filter("beam", lambda e: ~e["expanded"]), 1, step)
        if state.where("open").isEmpty():
            return state
        steps = state.where("open").select("query_id", F.explode(F.transform(front, lambda e: e["node"])).alias("node"))
        lists = graph.join(sent(steps), "node").groupBy("query_id").agg(F.flatten(F.collect_list("ids")).alias("near"))
        # What is no nearer than the last of a full beam has no place in it.
        last = F.coalesce(F.get("beam", F.lit(beam - 1))["s"], F.lit(float("inf"))).alias("last")
        held = sent(state.select("query_id", "q", last, F.transform("beam", lambda e: e["node"]).alias("held")))
        near = lists.join(held, "query_id").select("query_id", "q", "last", F.array_except("near", "held").alias("ids"))
        state = merged_beams(state.join(sent(score(index, near)), "query_id", "left").select("query_id", "q", "beam", found))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    queries = usable(vectors).where("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("q"), F.col("id").alias("own"))
    queries = queries.distinct()  # a row may be repeated whole
    return search(build_index(vectors), queries)
