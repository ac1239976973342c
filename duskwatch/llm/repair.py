"""Repair of conversation structure by bidirectional Dijkstra over the edit lattice (operator 11)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm.common import CRC32_TABLE, crc32_sql, ranked, table

# Rows of a conversation that are searched at once; a longer one is searched in chunks and put together.
CHUNK_ROWS = 512

# What the rows kept so far end with: nothing, the system row, a user row, an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (EMPTY, ASSISTANT)  # a whole conversation is `(s?(ua)+)?`
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED_STAYS = 0, 2, 3, 2, 1
# A row's code: role initial (of INITIALS, 3: another) and 4 times its fault.
INITIALS, SOUND, BLANK, DUPLICATE, TRUNCATED = "sua", 0, 1, 2, 3


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows dropped, emptied, cut, repeated or given to the user by a hash of their place."""
    one = [F.coalesce(F.col(c).cast("long").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *one)) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return (
        conversations.where(kind != 0)
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.when(kind == 4, "user").otherwise(role).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def edges(codes: list[int], i: int, q: int) -> list[tuple[int, int, int, str]]:
    """(row, state, cost, initial) of each edit that leads on from state q before row i."""
    out = [(i, to, INSERT, "I") for sym, to in NEXT[q].items() if sym in ROLES]
    if i < len(codes):
        initial, fault = codes[i] & 3, codes[i] >> 2
        out.append((i + 1, q, DELETE, "D"))
        if fault not in (BLANK, DUPLICATE):
            extra = TRUNCATED_STAYS if fault == TRUNCATED else 0
            for sym, to in NEXT[q].items():
                if initial < 3 and INITIALS[initial] == sym:
                    out.append((i + 1, to, KEEP + extra, "K"))
                if sym in ROLES:
                    out.append((i + 1, to, REROLE + extra, "R"))
    return out


def backward_edges(codes: list[int], i: int, q: int) -> list[tuple[int, int, int, str]]:
    """(row, state, cost, initial) of each edit that leads to state q before row i."""
    found = []
    for j in (i, i - 1) if i else (i,):
        for p in range(4):
            found += [(j, p, cost, c) for at, to, cost, c in edges(codes, j, p) if (at, to) == (i, q)]
    return found


def cheapest(codes: list[int], entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
    """Least cost of the edits from state ``entry`` before the rows to one of ``exits`` after them, and their ASCII-least audit.

    Two searches, forwards from the entry and backwards from the exits, settle
    nodes by (cost, rows passed), so each keeps the least audit of its cost.  They go on until no
    path through unsettled nodes can cost as little as the best crossing; then
    every path of that cost has an edge from a node of the one to a node of the
    other, and the least of the joined audits is taken.  Of audits of one cost that end in
    one node none begins another, so the least parts make the least whole.
    """
    n = len(codes)
    labels: tuple[dict, dict] = ({(0, entry): (0, "")}, {(n, q): (0, "") for q in exits})
    heaps: tuple[list, list] = ([(0, 0, entry)], [(0, 0, q) for q in exits])
    settled: tuple[set, set] = (set(), set())
    best = None
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, passed, q = heappop(heaps[side])
        node = (n - passed if side else passed, q)
        if node in settled[side]:
            continue
        settled[side].add(node)
        audit = labels[side][node][1]
        if node in labels[1 - side]:
            total = cost + labels[1 - side][node][0]
            best = total if best is None else min(best, total)
        for i, p, step, c in (backward_edges if side else edges)(codes, *node):
            label = (cost + step, c + audit if side else audit + c)
            if (i, p) not in labels[side] or label < labels[side][i, p]:
                labels[side][i, p] = label
                heappush(heaps[side], (cost + step, n - i if side else i, p))
    if best is None:
        return None
    audits, behind = [], settled[1] | {(n, q) for q in exits}
    for node in settled[0]:
        cost, audit = labels[0][node]
        if node in behind and cost + labels[1][node][0] == best:
            audits.append(audit + labels[1][node][1])
        for i, p, step, c in edges(codes, *node):
            if (i, p) in behind and cost + step + labels[1][i, p][0] == best:
                audits.append(audit + c + labels[1][i, p][1])
    return best, min(audits)


SOLVED = "array<struct<entry: int, exit: int, cost: long, audit: string>>"
COUNTS = "blank long, duplicate long, truncated long, illegal long, first int, last int"


def solved(chunks: DataFrame, rows: int) -> DataFrame:
    """Each chunk (conv_id, chunk, codes) with its counts and the cheapest edits from each state to each state.

    A chunk 0 that isn't full is a whole conversation, and one search is enough: to any end, exit -1.
    """

    def illegal(x: int, y: int) -> bool:
        return INITIALS[x : x + 1] + INITIALS[y : y + 1] not in ("su", "ua", "au")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv_id, chunk, codes in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "chunk", "codes")), strict=True):
                faults, initials = [c >> 2 for c in codes], [c & 3 for c in codes]
                if chunk == 0 and len(codes) < rows:
                    found = [(0, -1, *cheapest(codes, EMPTY, ENDS))]
                else:
                    pairs = [(e, x) for e in range(4 if chunk else 1) for x in range(4)]
                    found = [(e, x, *r) for e, x in pairs if (r := cheapest(codes, e, (x,)))]
                counts = [faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
                wrong = sum(map(illegal, initials, initials[1:]))
                keys = ("entry", "exit", "cost", "audit")
                out.append((conv_id, chunk, *counts, wrong, initials[0], initials[-1], [dict(zip(keys, f, strict=True)) for f in found]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    steps = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    types = [*[pa.int64()] * 6, pa.int32(), pa.int32(), steps]
    names = ["conv_id", "chunk", *(c.split(" ")[0] for c in COUNTS.split(", ")), "solved"]
    return chunks.mapInArrow(read, f"conv_id long, chunk long, {COUNTS}, solved {SOLVED}")


class Conversation:
    """One conversation read as a stream: its solved chunks, then its rows; keeps the audit and one row."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.counts, self.last = conv_id, [0, 0, 0, 0], None
        self.best, self.whole = {EMPTY: (0, "")}, None
        self.audit, self.cost, self.at, self.state = None, 0, 0, EMPTY
        self.sha, self.begun = hashlib.sha256(), False
        self.turns, self.low, self.high = 0, None, None

    def chunk(self, row: dict) -> None:
        self.counts = [a + row[c] for a, c in zip(self.counts, ("blank", "duplicate", "truncated", "illegal"), strict=True)]
        if self.last is not None:
            pair = INITIALS[self.last : self.last + 1] + INITIALS[row["first"] : row["first"] + 1]
            self.counts[3] += pair not in ("su", "ua", "au")
        self.last = row["last"]
        onward: dict[int, tuple[int, str]] = {}
        for f in row["solved"]:
            if f["entry"] in self.best:
                cost, audit = self.best[f["entry"]]
                label = (cost + f["cost"], audit + f["audit"])
                onward[f["exit"]] = min(onward.get(f["exit"], label), label)
        self.best = onward

    def settle(self) -> None:
        if self.audit is None:
            self.cost, self.audit = min(self.best[q] for q in (-1, *ENDS) if q in self.best)

    def write(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.begun = True

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.place("", None)

    def place(self, text: str, role: str | None) -> None:
        """Write a row with its own role, or with the one that must follow."""
        sym = role[0] if role is not None else next(s for s in NEXT[self.state] if s in ROLES)
        self.state = NEXT[self.state][sym]
        self.write(ROLES[sym] if role is None else role, text)

    def row(self, turn: int | None, role: str, text: str) -> None:
        self.settle()
        self.inserts()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            self.place(text, role if edit == "K" else None)
        if turn is not None:  # rows come by turn
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def result(self) -> tuple:
        self.settle()
        self.inserts()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.counts, self.cost, self.audit, self.sha.hexdigest())


OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repaired(conversations: DataFrame, rows: int = CHUNK_ROWS) -> DataFrame:
    """The columns of OUT for each conv_id of ``conversations`` (conv_id, turn, role, text), whose rows are damaged first.

    Rows get their places by a range shuffle, repeats are found by a group minimum, and chunks of
    ``rows`` rows are searched on their own (``cheapest``): once for a conversation of one
    chunk, else from each state to each state, which are put together chunk by chunk.  The SHA-256 of the repaired
    conversation is sequential, so its rows pass one task as a sorted stream that holds a row and the audit.

    Defined cases: null roles and texts are one space; a null conv_id is a conversation, null turns come
    first; rows of one turn are ordered by role, then text; an empty role has no initial and can't
    be kept; no rows after damage: zeros, an empty audit, the hash of nothing; an
    empty table gives no rows; other columns are ignored.
    """
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    text = F.col("text")
    blank = ~F.rlike(text, F.lit(r"[^\x20\x09-\x0D]"))
    ending = F.expr("right(trim(TRAILING ' \\t\\n\\u000B\\f\\r' FROM text), 1)")
    marked = damaged(conversations).select(
        "conv_id", "turn", "role", "text",
        F.coalesce(F.expr("element_at(map('s', 0, 'u', 1, 'a', 2), substring(role, 1, 1))"), F.lit(3)).alias("initial"),
        F.when(blank, BLANK).when(~ending.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND).alias("fault"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
    )
    placed = ranked(marked, "conv_id", [F.col(c) for c in ("turn", "role", "text")], "conversation-rows")
    seen = (
        placed.groupBy(F.col("conv_id").alias("of"), F.col("digest").alias("same"))
        .agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    repeat = (F.col("fault") != BLANK) & (F.col("pos") > F.col("first"))
    codes = placed.join(seen, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")), "left").select(
        "conv_id",
        "pos",
        (F.col("initial") + 4 * F.when(repeat, DUPLICATE).otherwise(F.col("fault"))).cast("int").alias("code"),
    )
    chunks = (
        codes.withColumn("chunk", F.expr(f"pos DIV {rows}"))
        .groupBy("conv_id", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "code")))["code"].alias("codes"))  # at most ``rows`` numbers
    )
    found = solved(chunks, rows)
    stream = (
        every.withColumns({"step": F.lit(0), "pos": F.lit(0).cast("long")})
        .unionByName(found.withColumn("step", F.lit(1)).withColumnRenamed("chunk", "pos"), allowMissingColumns=True)
        .unionByName(placed.select("conv_id", F.lit(2).alias("step"), "pos", "turn", "role", "text"), allowMissingColumns=True)
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, now = [c.split(" ")[0] for c in OUT.split(", ")], None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["step"] == 0:
                    if now is not None:
                        out.append(now.result())
                    now = Conversation(row["conv_id"])
                elif row["step"] == 1:
                    now.chunk(row)
                else:
                    now.row(row["turn"], row["role"], row["text"])
            yield result(out, names)
        if now is not None:
            yield result([now.result()], names)

    def result(out: list[tuple], names: list[str]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 9
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 7 else pa.string()) for k, c in enumerate(columns)], names=names)

    return stream.repartition("conv_id").sortWithinPartitions("conv_id", "step", "pos").mapInArrow(read, OUT)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "conversations"))


def _label(state: str, cost: str, edit: str, line: str | None) -> str:
    """SQL: the label of ``state`` after one more edit; null stays null."""
    lines = f"list_append({state}.t, {line})" if line else f"{state}.t"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 't': {lines}}} END"


def _least(*labels: str) -> str:
    return f"list_sort([{', '.join(labels)}], 'ASC', 'NULLS LAST')[1]"


def _inserted() -> str:
    """SQL: labels v0 to v3 with rows inserted where that is cheaper; more than a user and an assistant row never is."""
    u, a = "'user:'", "'assistant:'"
    first = _least("v2", *(_label(f"v{q}", "2", "I", u) for q in (0, 1, 3)))
    return f"SELECT conv_id, i, v0, v1, v2, {_least('v3', _label('v2', '2', 'I', a))} AS v3 FROM (SELECT conv_id, i, v0, v1, {first} AS v2, v3 FROM x)"


def _after_row() -> str:
    """SQL: the labels after row r from those before it."""

    def to(q: int) -> str:
        labels = [_label(f"v{q}", "3", "D", None)]
        for p in range(4):
            for sym, at in NEXT[p].items():
                if at == q:
                    keep = _label(f"v{p}", "cut", "K", "role || ':' || text")
                    labels.append(f"CASE WHEN stays AND initial = '{sym}' THEN {keep} END")
                    if sym in ROLES:
                        labels.append(f"CASE WHEN stays THEN {_label(f'v{p}', '2 + cut', 'R', f"'{ROLES[sym]}:' || text")} END")
        return f"{_least(*labels)} AS v{q}"

    return ", ".join(to(q) for q in range(4))


OP11_SQL = f"""
WITH RECURSIVE {CRC32_TABLE}, kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations, crc
), hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) - 1 AS i FROM hurt
), faults AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS unended FROM numbered
), r AS (
  SELECT conv_id, turn, role, text, i, initial, blank, again AND NOT blank AS duplicate,
    unended AND NOT blank AND NOT again AS truncated, NOT blank AND NOT again AS stays,
    CASE WHEN unended AND NOT blank AND NOT again THEN 1 ELSE 0 END AS cut FROM faults
), x0 AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS v0 FROM conversations GROUP BY conv_id
), x AS (SELECT conv_id, i, v0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS v1, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS v2,
    NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]) AS v3 FROM x0
), lattice AS (
  {_inserted()}
  UNION ALL
  ({_inserted().replace("FROM x)", f'''FROM (
    SELECT conv_id, i + 1 AS i, {_after_row()} FROM (
      SELECT l.conv_id, l.i, l.v0, l.v1, l.v2, l.v3, r.role, r.text, r.stays, r.cut::BIGINT AS cut, r.initial
      FROM lattice l JOIN r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i)))''')})
), ended AS (
  SELECT conv_id, {_least("v0", "v3")} AS v FROM lattice QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), pairs AS (
  SELECT *, CASE WHEN i > 0 THEN lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') ELSE false END AS illegal FROM r
), counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate,
    count_if(truncated) AS truncated, count_if(illegal) AS illegal FROM pairs GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, v.c AS cost, v.a AS audit,
  sha256(array_to_string(v.t, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
