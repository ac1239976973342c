"""Merkle manifest, conversation repair and quality classifier against plain restatements and their SQL."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from compare import check, duck

from duskwatch.llm import merkle, quality, repair
from duskwatch.llm.common import ranked
from duskwatch.llm.registry import LLM_ORACLES, LLM_QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, source string, lang string, n_chars int, text string, grp string, pos int"


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_merkle_manifest"])
def test_sql(spark, name):
    assert check(spark, duck(SF), name, LLM_QUERIES[name], LLM_ORACLES[name], SF).startswith("ok")


def test_ranked_counts_across_ranges(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "", "hot", "hot", "hot", "z"]), rng.choice([None, 1, 2, 3])) for _ in range(500)]
    frame = spark.createDataFrame(rows, "g string, x int").repartition(7)
    got: dict = {}
    for r in ranked(frame, "g", [], "ranked-test").collect():
        got.setdefault(r["g"], []).append(r["pos"])
    assert {g: sorted(p) for g, p in got.items()} == {g: list(range(sum(r[0] == g for r in rows))) for g in got}
    got = sorted((str(r["g"]), r["pos"], r["x"] or 0) for r in ranked(frame, "g", ["x"], "ranked-test").collect())
    assert all(a[2] <= b[2] for a, b in zip(got, got[1:], strict=False) if a[0] == b[0])
    assert ranked(frame.limit(0), "g", ["x"], "ranked-test").count() == 0


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row: tuple, text: str | None) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def tree_of(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    out = []
    for level in levels[:-1]:
        run = i // 3 * 3
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
        i //= 3
    return out


def plain_manifest(rows: list[tuple]) -> list[str]:
    by: dict = {}
    for r in rows:
        by.setdefault(r[1], []).append((r, leaf_of(r, r[4])))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for own in by.values():
        own.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {s: tree_of([leaf for _, leaf in by[s]]) for s in sources}
    top = tree_of([trees[s][-1][0] for s in sources])
    out = []
    for j, s in enumerate(sources):
        for i, (r, leaf) in enumerate(by[s]):
            steps = siblings(trees[s], i) + siblings(top, j)
            folded = leaf
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                folded = leaf_of(r, r[4].replace("\n", ""))
            for before, after in steps:
                folded = sha(before + folded + after)
            root = top[-1][0]
            out.append(str((r[0], leaf, trees[s][-1][0], root, sha("".join(b + a for b, a in steps)), folded, folded == root)))
    return sorted(out)


@pytest.mark.parametrize("levels", [0, 1, 6])
def test_manifest(spark, levels):
    rng = random.Random(3)
    rows = [
        (i if i % 50 else None, rng.choice([None, "", "a", "b", "é", "z"]) if i % 3 else "hot", rng.choice(["en", None]), rng.choice([None, 5]), rng.choice([None, "", "x\ny", "é\n" * 3000, "q"]), "clash", 1)
        for i in range(200)
    ]
    rows += rows[:5]  # repeated rows
    rng.shuffle(rows)
    got = merkle.manifest(spark.createDataFrame(rows, DOCS).repartition(3), levels).collect()
    assert sorted(str(tuple(r)) for r in got) == plain_manifest(rows)
    assert {r["verified"] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 3, 4, 9, 28])
def test_manifest_sizes(spark, n):
    rows = [(i, "a", "x", 1, "t\n", None, 0) for i in range(n)]
    got = merkle.manifest(spark.createDataFrame(rows, DOCS), 1).collect()
    assert sorted(str(tuple(r)) for r in got) == (plain_manifest(rows) if rows else [])


def plain_cheapest(codes: list[int], entry: int, exits: tuple) -> tuple | None:
    """Backwards over the lattice, each node from all that follow it until nothing changes."""
    best = {(len(codes), q): (0, "") for q in exits}
    for i in range(len(codes), -1, -1):
        for _ in range(6):
            for q in range(4):
                for j, p, cost, c in repair.edges(codes, i, q):
                    if (j, p) in best:
                        label = (best[j, p][0] + cost, c + best[j, p][1])
                        best[i, q] = min(best.get((i, q), label), label)
    return best.get((0, entry))


def test_bidirectional_search_finds_the_least_audit():
    rng = random.Random(1)
    for _ in range(500):
        codes = [rng.choice([0, 1, 2, 3]) + 4 * rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(rng.randint(0, 9))]
        for entry in range(4):
            for exits in ((0, 3), (0,), (1,), (2,), (3,)):
                assert repair.cheapest(codes, entry, exits) == plain_cheapest(codes, entry, exits)


def plain_repair(rows: list[tuple]) -> dict:
    blank, out = " \t\n\x0b\x0c\r", {}
    for c in {r[0] for r in rows}:
        own = []
        for _, turn, role, text, *_ in (r for r in rows if r[0] == c):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 1:
                text = ""
            if kind == 2:
                text = text.translate(str.maketrans("", "", ".!?"))
            own += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        codes, seen = [], set()
        for _, role, text in own:
            fault = 1 if not text.strip(blank) else 2 if (role, text) in seen else 3 if text.strip(blank)[-1] not in ".!?" else 0
            seen.add((role, text))
            codes.append({"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + 4 * fault)
        cost, audit = plain_cheapest(codes, 0, (0, 3))
        turns = [t for t, *_ in own if t is not None]
        initials = [r[:1] for _, r, _ in own]
        lines, state, k = [], 0, 0
        for e in audit:
            if e != "I":
                _, role, text = own[k]
                k += 1
            if e == "D":
                continue
            new = e in "RI"
            sym = ("a" if state == 2 else "u") if new else role[0]
            state = repair.NEXT[state][sym]
            lines.append(f"{ {'u': 'user', 'a': 'assistant'}[sym] if new else role}:{'' if e == 'I' else text}")
        faults = [x >> 2 for x in codes]
        out[c] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in (1, 2, 3)),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit, sha("\n".join(lines)),
        )
    return out


def test_repair(spark):
    rng = random.Random(6)
    rows: list = []
    for c in [None, *range(1, 25)]:
        for t in range(rng.choice([1, 3, 6, 40])):
            text = rng.choice([None, "", " \n", "Yes.", "No!\n", "é and so on", "x" * 5000 + ".", f"t{t}.", f"q{t}?"])
            rows.append((c, rng.choice([t, t, t, None, t + 3]), rng.choice(["system", "user", "assistant", "user", "assistant", None, "", "tool"]), text, "x"))
    rows += rows[:9]  # repeated rows
    gone = next(i for i in range(100, 400) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "dropped", "x"))
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, code string").repartition(3)
    want = plain_repair(rows)
    assert want[gone] == (0, 0, 0, 0, 0, 0, "", sha(""))
    for chunk in (repair.CHUNK_ROWS, 5, 1):  # chunks put together equal one search
        got = {r["conv_id"]: tuple(r)[1:] for r in repair.repaired(frame, chunk).collect()}
        assert got == want
    assert repair.repaired(frame.limit(0)).count() == 0


def test_quality(spark):
    rng = random.Random(1)
    good, rows, labels = [f"word{i}" for i in range(300)], [], []
    for i in range(900):
        bad = i % 6 == 0
        words = [rng.choice(good) for _ in range(rng.randint(5, 120))]
        if bad:
            words = [w.upper() + "!!" for w in words] if i % 4 else [w + rng.choice(["$$$", "%%%"]) for w in words]
        rows.append((i, " ".join(words), "x"))
        if i % 2:
            continue
        labels.append((i, int(not bad), 1))
    labels += [(i, int(i % 6 > 0), 0) for i in range(1, 900, 2)]
    rows += [(1000, None, "x"), (1001, "", "x"), (None, "a b", "x"), (1000, "fine words", "x"), (1002, "word7 " * 50_000, "x")]
    labels += [(None, 1, 1), (3, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.quality(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    known = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 900]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in known)
    held = [r for r in known if r["held_out"]]
    assert len(held) > 100 and all(r["predicted"] == (r["doc_id"] % 6 > 0) for r in held)
    # Labels of 0 count towards the prior only, and held-out labels for nothing.
    changed = marks.where(~quality.is_held_out())
    again = {r["doc_id"]: r["score"] for r in quality.quality(docs, changed).collect() if r["doc_id"] is not None and r["doc_id"] < 900}
    assert again == {r["doc_id"]: r["score"] for r in known}
    assert quality.quality(docs.limit(0), marks).count() == 0
    assert {r["score"] for r in quality.quality(docs, marks.limit(0)).collect()} == {1.0}


def test_held_out_quality_of_the_tables(spark):
    sf = "/root/testdata/sf0.1"
    got = quality.op13_quality_classifier(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    kept = [r["predicted"] for r in got if r["quality"] == 1]
    gone = [1 - r["predicted"] for r in got if r["quality"] == 0]
    assert len(gone) > 100 and np.mean(kept) >= 0.99 and np.mean(gone) >= 0.9


def test_negative_risk_is_corrected():
    # With too high a prior the negative risk falls below zero, and the learner must not push all weights away.
    rng = np.random.default_rng(1)
    rows = [(np.array([int(k)], np.int32), np.ones(1, np.float32)) for k in rng.integers(0, 40, 400)]
    w = quality.fit(rows[:200], rows[200:], 0.95, quality.NonNegative())
    assert np.isfinite(w).all() and np.abs(w).max() < 20
