"""Merkle manifest of a dataset by butterfly exchange (operator 12)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duskwatch.llm.common import CRC32_TABLE, crc32_sql, ranked, staged, table

FANOUT = 3
# Levels of a block, the aligned part of a tree that one row holds: 3^6 = 729 leaves.
BLOCK_LEVELS = 6
# Parts of a source's blocks when they meet what all of them need.
SALTS = 32

PATH = "array<struct<before: binary, after: binary>>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the concatenated texts, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def field(value: Column) -> Column:
    """``-`` for null, else its length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    return digest(*(field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)))


def levels_of(leaves: list[str], height: int | None) -> list[list[str]]:
    """The nodes of each level from the leaves up: to ``height``, or until one remains."""
    levels = [leaves]
    while len(levels[-1]) > 1 if height is None else len(levels) <= height:
        low = levels[-1]
        levels.append([hashlib.sha256("".join(low[i : i + FANOUT]).encode()).hexdigest() for i in range(0, len(low), FANOUT)])
    return levels


def hexes(packed: bytes) -> list[str]:
    text = packed.hex()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def blocks_of(leaves: DataFrame, levels: int, purpose: str) -> DataFrame:
    """(grp, block, m, n, items, digests, node): aligned runs of FANOUT**levels leaves, one row each, staged.

    ``leaves`` has grp, pos, digest and item; m is the group's number of blocks, n the
    block's of leaves, node the root of the block's subtree.
    """
    span = FANOUT**levels
    gathered = (
        leaves.withColumn("block", F.expr(f"pos DIV {span}"))
        .groupBy("grp", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "item"))).alias("rows"))  # at most span rows
    )
    packed = gathered.select(
        "grp",
        "block",
        F.size("rows").alias("n"),
        F.col("rows.item").alias("items"),
        F.unhex(F.array_join(F.transform("rows", lambda r: F.hex(r["digest"])), "")).alias("digests"),
    )

    def root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = []
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("digests").to_pylist(), strict=True):
                alone = block == 0 and len(packed) // 32 < span  # of a group with more blocks, this one would be full
                nodes.append(bytes.fromhex(levels_of(hexes(packed), None if alone else levels)[-1][0]))
            yield batch.append_column("node", pa.array(nodes, pa.binary()))

    item = leaves.schema["item"].dataType.simpleString()
    return staged(packed.mapInArrow(root, f"grp string, block long, n int, items array<{item}>, digests binary, node binary"), purpose)


def salted(big: DataFrame, small: DataFrame, salt: Column) -> DataFrame:
    """Join on grp; ``small`` has one row a group and is repeated, so that a large group is met in parts."""
    copies = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("salt", F.pmod(salt, F.lit(SALTS)).cast("int")).join(copies, ["grp", "salt"]).drop("salt")


def exchanged(nodes: DataFrame, purpose: str) -> DataFrame:
    """(grp, block, path, node): for each block the siblings of its ancestors above the block, and the group's root.

    Butterfly: in round r the blocks that differ only in digit r (base FANOUT) of
    their number meet, swap the roots of the subtrees they belong to, and each
    hashes the common ancestor for itself.  After the last round every block has its whole path; nothing is sent down
    again.  A group is at most FANOUT rows.  The last subtree may have fewer blocks
    than its siblings: its blocks stand in for the missing ones in turn, so no block has
    more partners than it has missing neighbours to stand in for, and a round's rows at most double.
    """
    sizes = nodes.groupBy("grp").agg((F.max("block") + 1).alias("m"))
    state = salted(nodes, sizes, F.col("block")).withColumn("path", F.array().cast(PATH))
    state = staged(state.select("grp", "block", "m", "node", "path"), purpose)
    most = state.agg(F.max("m")).first()[0] or 0
    ready, span = [state.where("m = 1").drop("m")], 1
    state = state.where("m > 1")
    while span < most:
        tree = F.expr(f"block DIV {span}")
        low, digit = F.expr(f"block % {span}"), tree % FANOUT
        size = F.least(F.lit(span).cast("long"), F.col("m") - tree * span)
        slots = F.when((size < span) & (digit > 0), F.sequence(low, F.lit(span - 1).cast("long"), size)).otherwise(F.array(low))
        meeting = state.withColumns({"digit": digit.cast("int"), "low": low, "parent": F.expr(f"block DIV {span * FANOUT}"), "slot": F.explode(slots)})
        group = Window.partitionBy("grp", "parent", "slot")
        roots = {d: F.max(F.when(F.col("digit") == d, F.col("node"))).over(group) for d in range(FANOUT)}
        met = meeting.withColumns({f"n{d}": F.coalesce(c, F.lit(b"")) for d, c in roots.items()}).where("slot = low")
        own = F.col("digit")
        before = F.concat(*(F.when(F.lit(d) < own, F.col(f"n{d}")).otherwise(F.lit(b"")) for d in range(FANOUT)))
        after = F.concat(*(F.when(F.lit(d) > own, F.col(f"n{d}")).otherwise(F.lit(b"")) for d in range(FANOUT)))
        step = F.array(F.struct(before.alias("before"), after.alias("after")))
        above = met.select(
            "grp", "block", "m",
            digest(*(hexed(F.col(f"n{d}")) for d in range(FANOUT))).alias("node"),
            F.concat("path", step).cast(PATH).alias("path"),
        )
        span *= FANOUT
        state = staged(above, purpose)
        ready.append(state.where(F.col("m") <= span).drop("m"))
        state = state.where(F.col("m") > span)
    return reduce(DataFrame.union, [r.select("grp", "block", "path", "node") for r in ready])


def ascending(leaves: DataFrame, order: list[str], levels: int, purpose: str) -> tuple[DataFrame, DataFrame]:
    """Blocks and paths of one tree a group; ``leaves`` has grp, digest, item and the columns of ``order``."""
    placed = ranked(leaves, "grp", [F.col(c) for c in order], f"{purpose}-leaves").select("grp", "pos", "digest", "item")
    blocks = blocks_of(placed, levels, f"{purpose}-blocks")
    return blocks, exchanged(blocks.select("grp", "block", "node"), f"{purpose}-rounds")


def local_steps(leaves: list[str], block: int, path: list, levels: int) -> list[list[tuple[str, str]]]:
    """For each leaf of a block the siblings before and after its ancestors, up to the block's own root."""
    alone = block == 0 and not path and len(leaves) < FANOUT**levels
    nodes = levels_of(leaves, None if alone else levels)
    steps: list[list[tuple[str, str]]] = [[] for _ in leaves]
    for height, level in enumerate(nodes[:-1]):
        for leaf, own in enumerate(steps):
            i = leaf // FANOUT**height
            run = i // FANOUT * FANOUT
            own.append(("".join(level[run:i]), "".join(level[i + 1 : run + FANOUT])))
    return steps


def source_paths(blocks: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """(grp, top_path, root) of each source, from the tree over the sources' roots."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                leaves = hexes(row["digests"])
                own = [
                    [{"before": bytes.fromhex(b), "after": bytes.fromhex(a)} for b, a in steps] + row["path"]
                    for steps in local_steps(leaves, row["block"], row["path"], levels)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["items"]), pa.array(own, pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))), pa.array([row["node"]] * len(leaves))],
                    names=["grp", "top_path", "root"],
                )

    met = blocks.select("grp", "block", "items", "digests").join(paths, ["grp", "block"])
    return met.mapInArrow(read, f"grp string, top_path {PATH}, root binary")


OUT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def proved(blocks: DataFrame, levels: int) -> DataFrame:
    """The columns of OUT from rows of grp, block, items (doc_id, copy), digests, path, node, top_path and root."""

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in OUT.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                leaves, root = hexes(row["digests"]), row["root"].hex()
                upper = [(p["before"].hex(), p["after"].hex()) for p in row["path"] + row["top_path"]]
                out = []
                for leaf, item, steps in zip(leaves, row["items"], local_steps(leaves, row["block"], row["path"], levels), strict=True):
                    steps += upper
                    folded = item["copy"].hex() if item["copy"] is not None else leaf
                    for before, after in steps:
                        folded = sha(f"{before}{folded}{after}")
                    proof = sha("".join(f"{before}{after}" for before, after in steps))
                    out.append((item["doc_id"], leaf, row["node"].hex(), root, proof, folded, folded == root))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *map(pa.array, columns[1:])], names=names)

    return blocks.mapInArrow(read, OUT)


def manifest(docs: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """For every row its leaf, its source's root, the dataset's root, and its proof, checked against a tampered copy.

    A leaf hashes doc_id, source, lang, n_chars and text.  Leaves of a source ascend by doc_id (null first; equal
    ids by leaf); runs of three become their parent until one node remains.  The sources' roots,
    null first, then by bytes, form a tree of the same kind.  Rows whose decimal doc_id has an even crc32 are tampered
    with: the copy that is checked lacks the newlines of its text.  A text without any is unchanged and verifies.

    Both trees are cut into blocks of FANOUT**levels leaves that exchange their roots
    (``exchanged``); a block is one row, so a source of any size is spread over its blocks.

    Defined cases: nulls in any column are hashed as nulls; a null doc_id is not tampered
    with; equal rows are leaves of their own; an empty table gives no rows; those of the five
    columns that are missing count as null; other columns are ignored.
    """
    rows = docs.select(*(F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("doc_id", "source", "lang", "n_chars", "text")))
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    copy = F.when(tampered, leaf_digest(F.replace("text", F.lit("\n"), F.lit(""))))
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("grp"),
        doc_id,
        leaf_digest(F.col("text")).alias("digest"),
        F.struct(doc_id, copy.alias("copy")).alias("item"),
    )
    blocks, paths = ascending(leaves, ["doc_id", "digest"], levels, "merkle")
    sources = paths.where("block = 0").select(F.lit("").alias("grp"), F.col("node").alias("digest"), F.col("grp").alias("item"))
    tops = staged(source_paths(*ascending(sources, ["item"], levels, "merkle-top"), levels), "merkle-sources")
    met = blocks.select("grp", "block", "items", "digests").join(paths, ["grp", "block"])
    return proved(salted(met, tops, F.col("block")), levels)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """Nodes (grp, lvl, i, h) of a tree a group over ``leaves`` (grp, i, h)."""
    return f"""{name} AS (
  SELECT grp, 0 AS lvl, i, h FROM {leaves}
  UNION ALL
  SELECT grp, lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {name}) WHERE n > 1
  GROUP BY grp, lvl + 1, i // 3
), {name}_roots AS (SELECT grp, max_by(h, lvl) AS h, max(lvl) AS height FROM {name} GROUP BY grp),
{name}_steps AS (
  SELECT l.grp, l.i, list(s.step ORDER BY s.lvl) AS steps FROM {leaves} l JOIN {name}_roots r ON r.grp = l.grp
  JOIN LATERAL (
    SELECT n.lvl, coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i < p.own), '') || '|'
      || coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (n.i > p.own), '') AS step
    FROM (SELECT k AS lvl, l.i // (3 ** k)::BIGINT AS own FROM (SELECT unnest(range(r.height)) AS k)) p
    JOIN {name} n ON n.grp = l.grp AND n.lvl = p.lvl AND n.i // 3 = p.own // 3
    GROUP BY n.lvl, p.own
  ) s ON true GROUP BY l.grp, l.i
)"""


OP12_SQL = f"""
WITH RECURSIVE {CRC32_TABLE}, leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS grp, {_leaf_sql("text")} AS h,
    CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS copy
  FROM documents, crc
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM leaves
), {_tree_sql("tree", "placed")}, sources AS (
  SELECT '' AS grp, grp AS source, h, row_number() OVER (ORDER BY grp) - 1 AS i FROM tree_roots
), {_tree_sql("top", "sources")}, proofs AS (
  SELECT p.doc_id, p.h AS leaf, r.h AS subroot, t.h AS root, coalesce(p.copy, p.h) AS tested,
    coalesce(a.steps, []) || coalesce(b.steps, []) AS steps
  FROM placed p JOIN tree_roots r ON r.grp = p.grp JOIN sources s ON s.source = p.grp CROSS JOIN top_roots t
  LEFT JOIN tree_steps a ON a.grp = p.grp AND a.i = p.i LEFT JOIN top_steps b ON b.i = s.i
), folded AS (
  SELECT *, list_reduce([tested] || steps, lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root
  FROM proofs
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM folded
"""
