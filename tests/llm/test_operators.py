"""The operators against plain restatements, with nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from duskwatch.llm import chat, fingerprint, licences, linededup, minhash, mixing, neighbours, packing, tokens, toxicity
from duskwatch.llm.common import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars int"
WORDS = [f"w{i}" for i in range(400)]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus(seed: int = 5) -> list[tuple]:
    """Texts with copies, near copies, shared lines, blank, null and long ones."""
    rng = random.Random(seed)
    texts: list[str | None] = [None, "", " \n\t\n", "one", "One", "one two", "É é É é", "<|endoftext|> á İ 中文 don't DON'T 12 3.5\r\nx"]
    shared = sentence(rng, 20)
    for i in range(14):
        lines = [sentence(rng, rng.randint(1, 40)) for _ in range(rng.randint(1, 5))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), shared)
        base = "\n".join(lines)
        texts.append(base)
        if i % 4 == 0:
            texts.append(base)
        if i % 2 == 0:
            words = base.split(" ")
            for _ in range(3):
                near = list(words)
                for _ in range(max(1, len(near) // 15)):
                    near[rng.randrange(len(near))] = rng.choice(WORDS)
                texts.append(" ".join(near))
        if len(base.split()) > 60:  # one word of them changed: like in five-word shingles too
            words = base.split(" ")
            for _ in range(2):
                near = list(words)
                near[rng.randrange(len(near))] = rng.choice(WORDS)
                texts.append(" ".join(near))
    texts.append(sentence(rng, 6000))
    rng.shuffle(texts)
    return [(3 * i, t, "en", [None, "s1", "s2", "s2"][i % 4], 7) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text: str | None, width: int) -> set:
    words = (text or "").encode().lower().split()
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def groups_of(rows: list[tuple], width: int, percent: int) -> dict[int, int]:
    sets = {r[0]: shingles(r[1], width) for r in rows}
    root = {i: i for i in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, rows, width):
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs, width).collect()}
    want = groups_of(rows, width, 80)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert len(set(want.values())) < len(want) - 5
    assert all(r["kept"] == (i == want[i]) and r["n_shingles"] == len(shingles(dict((x[0], x[1]) for x in rows)[i], width)) for i, r in got.items())


def test_near_duplicates_odd_rows(spark, none):
    rows = [(None, "a b c", "x"), (4, "a b c", "x"), (4, "a b c", "x"), (9, "A  b\tc", "x"), (5, None, "x")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, component_id string")).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["component_id"], r["kept"]) for r in got if r["doc_id"] is not None) == [
        (4, 4, True), (4, 4, True), (5, 5, True), (9, 4, False),
    ]
    assert sum(r["doc_id"] is None and r["kept"] for r in got) == 1
    assert minhash.near_duplicates(none).count() == 0


def test_second_round_joins_what_stars_leave_apart(spark):
    # A chain: each text is like its neighbours only, so no star joins all.
    words = [f"c{i}" for i in range(300)]
    rows = [(i, " ".join(words[6 * i : 6 * i + 100])) for i in range(25)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = groups_of(rows, 2, 80)
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(set(want.values())) == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}


def all_earlier(rows: list[tuple], percent: int) -> dict[int, str | None]:
    seen: list[set] = []
    out = {}
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        keep = []
        for line in (text or "").split("\n"):
            words = set(line.lower().split())
            if not (words and any(100 * len(words & e) >= percent * len(words | e) for e in seen)):
                keep.append(line)
            if words:
                seen.append(words)
        out[i] = None if text is None else "\n".join(keep)
    return out


@pytest.mark.parametrize("block_lines", [50_000, 3])
def test_line_dedup(docs, rows, block_lines):
    got = {r["doc_id"]: r for r in linededup.dedup_lines(docs, block_lines=block_lines).collect()}
    want = all_earlier(rows, 80)
    assert {i: r["text"] for i, r in got.items()} == want
    assert sum(r["n_removed"] for r in got.values()) > 20
    assert set(docs.columns) <= set(next(iter(got.values())).asDict())


def test_line_dedup_defers_large_groups(spark):
    rng = random.Random(3)
    base = [f"k{i}" for i in range(40)]
    rows = []
    for i in range(60):  # variants of one line, some too far from most others
        words = list(base)
        for j in rng.sample(range(40), rng.randint(1, 9)):
            words[j] = f"x{i}_{j}"
        rows.append((i, " ".join(words)))
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == all_earlier(rows, 80) and "" in got.values()


@pytest.mark.parametrize("order", [1, -1])
def test_line_dedup_does_not_depend_on_the_order_of_rows(spark, order):
    # A near line stands between two copies, which come in either order and in one batch.
    words = [f"v{i}" for i in range(20)]
    copy, near = " ".join(words), " ".join([*words[:18], "y1", "y2"])
    rows = [(10, copy), (3, copy), (5, near), (7, " ".join([*words[:18], "z1", "z2"]))][::order]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert got == {3: copy, 5: "", 7: "", 10: ""} == all_earlier(rows, 80)


def test_line_dedup_tells_texts_of_one_id_apart(spark):
    rows = [(1, "a b c"), (2, "x y z"), (2, "a b c"), (2, "a b c"), (3, "q r s\nx y z"), (3, "q r s\nx y z"), (4, "q r s")]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, "a b c"), (2, ""), (2, ""), (2, "x y z"), (3, "q r s"), (3, "q r s"), (4, "")]


def test_line_dedup_settles_lines_that_left_a_group_early(spark, monkeypatch):
    # The last line passes the filters with many that fail, and matches one far from it in its groups.
    rng = random.Random(9)
    base = [f"k{i}" for i in range(30)]
    rows = [(0, " ".join([*base[:26], "m1", "m2", "m3", "m4"]))]
    for i in range(1, 90):
        rows.append((i, " ".join([*(w for w in base if w not in rng.sample(base, 7)), *(f"n{i}_{j}" for j in range(6))])))
    rows.append((99, " ".join([*base[:26], "m1", "m2", "o3", "o4"])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (linededup.MOST_BROADCAST, 0):
        monkeypatch.setattr(linededup, "MOST_BROADCAST", most)
        got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(frame).collect()}
        assert got == all_earlier(rows, 80) and got[99] == ""


def test_line_dedup_odd_rows(spark, none):
    rows = [(None, "a b", 1), (1, "a b\n\nc", 1), (2, None, 1), (3, "B A\n", 1)]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, n_lines int")).collect()
    assert {(r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in got} == {
        (None, "a b", 1, 0), (1, "a b\n\nc", 3, 0), (2, None, 0, 0), (3, "", 2, 1),
    }
    assert linededup.dedup_lines(none).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_tokenizer(rows, name):
    path = public_tokenizers.path(name)
    plain, own = Tokenizer.from_file(path), tokens.Encoder(tokens.tokenizer_source(path))
    texts = [t or "" for _, t, *_ in rows] + ["  a  b\n\n c's 'S ", "¼²x", "a\x1cb c", "ÀÉ ñandú", "x" * 3000]
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_knows_every_character_beside_a_letter(name):
    path = public_tokenizers.path(name)
    plain, own = Tokenizer.from_file(path), tokens.Encoder(tokens.tokenizer_source(path))
    allowed = [c for c in map(chr, range(0x2100)) if not tokens.OTHER.search(c)]
    texts = [f"{a}{c}{b}" for c in allowed for a, b in (("", "a"), ("z", ""), ("A", "B"), (" ", " "), ("1", "'s"))]
    assert len(tokens.LEAVING) > 10 and [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, docs, rows, scratch, encoding):
    path, name = f"{scratch}/tokens", public_tokenizers.path("word_bpe_49k.json")
    tokens.write_tokens(docs, path, name, encoding=encoding, row_group_bytes=1 << 16, page_bytes=1 << 10)
    plain = Tokenizer.from_file(name)
    want, at = {}, 0
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [tokens.END_ID]
        want[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    got = tokens.with_crc32(tokens.read_tokens(spark, path)).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want
    part = tokens.read_tokens(spark, path, with_ids=False, first_id=30, last_id=60)
    assert {r["doc_id"]: (r["start"], r["n_tokens"]) for r in part.collect()} == {i: w[:2] for i, w in want.items() if 30 <= i <= 60}
    plan = part._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[-1].split("\n")[0]
    encodings, indexed = set(), True
    for f in sorted(p for p in __import__("glob").glob(f"{path}/*.parquet")):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            column = meta.row_group(g).column(4)
            encodings |= set(column.encodings)
            indexed &= column.has_offset_index
    assert indexed and ("DELTA_BINARY_PACKED" in encodings if encoding == "delta" else {"RLE_DICTIONARY", "PLAIN_DICTIONARY"} & encodings)


def test_token_files_odd_rows(spark, none, scratch):
    name = public_tokenizers.path("word_bpe_49k.json")
    tokens.write_tokens(none, f"{scratch}/none", name)
    assert tokens.read_tokens(spark, f"{scratch}/none").count() == 0
    rows = [(None, "a b", 0), (2, None, 0), (2, "a", 0), (2, "a", 0)]
    tokens.write_tokens(spark.createDataFrame(rows, "doc_id long, text string, start int"), f"{scratch}/odd", name)
    got = [(r["doc_id"], r["start"], r["n_tokens"]) for r in tokens.read_tokens(spark, f"{scratch}/odd").collect()]
    assert sorted(got, key=lambda r: r[1]) == [(None, 0, 3), (2, 3, 1), (2, 4, 2), (2, 6, 2)]


def test_packing(docs, rows):
    name = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack_documents(docs, name, size=64, with_ids=True).toPandas()
    plain = Tokenizer.from_file(name)
    total = 0
    for i, t, *_ in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        own = got[got.doc_id == i].sort_values("piece")
        assert np.frombuffer(b"".join(own.ids), "<u4").tolist() == ids
        assert own.start.tolist() == np.concatenate([[0], np.cumsum(own.length)[:-1]]).tolist()
        assert (own.length[1:] == 64).all() and own.piece.tolist() == list(range(len(own)))
        assert len(ids) > 64 or len(own) == 1
        total += len(ids)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == np.concatenate([[0], np.cumsum(s.length)[:-1]]).tolist() and s.length.sum() <= 64
    assert got.sequence_id.nunique() < 1.2 * total / 64 + 4


def test_bins_close_the_fullest():
    bins = packing.Bins(10, 2, 0)
    assert bins.place(6) == (0, 0) and bins.place(5) == (1, 0)
    assert bins.place(4) == (0, 6)  # exactly full, no longer open
    assert bins.place(7) == (2, 0) and bins.place(8) == (3, 0)  # three open: bin 3 with 2 left closes
    assert bins.place(2) == (2, 7) and bins.place(5) == (1, 5)


def test_packing_odd_rows(spark, none):
    name = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.pack_documents(none, name).count() == 0
    rows = [(None, None, 1), (1, "", 1), (1, "", 1)]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string, offset int"), name).collect()
    assert sorted(r["offset"] for r in got) == [0, 1, 2] or len({r["sequence_id"] for r in got}) > 1
    assert all(r["length"] == 1 for r in got)


def test_toxicity(spark, none):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(1500):
        bad = i % 5 == 0
        words = sentence(rng, rng.randint(5, 80)).split()
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["vile!", "Nasty", "rotten."]))
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(bad), "x"))
    rows += [(2000, None, "en", "s", 1), (2001, "", "en", "s", 1), (None, "vile", "en", "s", 1), (2000, "fine", "en", "s", 1)]
    labels += [(None, 1, 1, "x"), (3, 1, None, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    got = toxicity.toxicity(docs, marks).collect()
    assert len(got) == len(rows)
    known = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 1500]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in known)
    held = [r for r in known if r["held_out"]]
    right = sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in held)
    assert right >= 0.95 * len(held) and len(held) > 100
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    # Labels of held-out rows teach nothing.
    flipped = marks.withColumn("toxic", F.when(toxicity.is_held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, flipped).collect() if r["doc_id"] is not None and r["doc_id"] < 1500}
    assert again == {r["doc_id"]: r["score"] for r in known}
    assert toxicity.toxicity(none, marks).count() == 0
    assert {r["score"] for r in toxicity.toxicity(docs, marks.limit(0)).collect()} == {0.0}


def poisson(u: float, rate: float) -> int:
    k, term = 0, np.exp(-rate)
    total = term
    while total < u:
        k += 1
        term *= rate / k
        total += term
    return k


def test_mixing(spark, docs, rows, none):
    weights = spark.createDataFrame([("s1", 3.0), ("s2", 1.0), (None, 0.5)], "source string, weight double")
    sizes: dict = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(t or "")
    rate = {s: 40 * sum(sizes.values()) * w / 4.5 / sizes[s] for s, w in (("s1", 3.0), ("s2", 1.0), (None, 0.5))}
    want = {}
    for i, _, _, s, _ in rows:
        pieces = max(1, int(np.ceil(rate[s] / mixing.MOST_RATE)))
        u = [int(hashlib.md5(f"{mixing.SEED}:{i}:{k}".encode()).hexdigest()[:13], 16) / 2**52 for k in range(pieces)]
        want[i] = sum(poisson(x, rate[s] / pieces) for x in u)
    for most in (5_000, 1):
        got = mixing.poisson_mix(docs.withColumn("copy", F.lit("x")), weights, budget=40.0 * sum(sizes.values()), broadcast_sources=most).collect()
        copies: dict = {}
        for r in got:
            copies.setdefault(r["doc_id"], []).append(r["copy"])
        assert {i: sorted(c) for i, c in copies.items()} == {i: list(range(1, n + 1)) for i, n in want.items() if n}
    assert mixing.poisson_mix(none).count() == 0
    blank = spark.createDataFrame([(1, None, None), (None, "", None)], "doc_id long, text string, source string")
    assert set(mixing.poisson_mix(blank).columns) == {"doc_id", "text", "source", "copy"}


def test_licences(docs, rows, spark, none):
    rng = random.Random(2)
    notice = licences.TEMPLATES[2][1]
    texts = [f"{sentence(rng, 30)}\n{notice}\n{sentence(rng, 9)}", "x\n\nReleased under\nthe MIT  license!\n\ny z", "All rights reserved.", "all rights", None, ""]
    got = licences.scan_licences(spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, dice int")).collect()
    assert [(r["licence"], r["n_licences"]) for r in sorted(got, key=lambda r: r["doc_id"])] == [
        ("Apache-2.0", 1), ("MIT", 1), ("Proprietary", 1), (None, 0), (None, 0), (None, 0),
    ]
    assert licences.scan_licences(none).count() == 0
    # Pruning by size changes nothing.
    matcher = licences.Matcher(licences.TEMPLATES, 80)
    for _ in range(300):
        name, t = rng.choice(licences.TEMPLATES)
        words = t.split()
        for _ in range(rng.randint(0, 3)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(WORDS))
        unit = licences.bigrams(" ".join(words[rng.randint(0, 2) :]))
        want = {n for n, x in licences.TEMPLATES if 2 * len(unit & licences.bigrams(x)) >= 0.8 * (len(unit) + len(licences.bigrams(x))) - 1e-9}
        assert {n for _, _, n in matcher.matches(unit)} == want


def test_licences_inside_longer_text():
    """Whole licences, wrapped ones, and notices inside a sentence or a paragraph."""
    rng = random.Random(3)
    matcher = licences.Matcher(licences.TEMPLATES, 80)
    whole = {name: text for name, text in licences.TEMPLATES}  # the last of a name is its longest
    for name, text in whole.items():
        words = text.split()
        wrapped = "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
        for around in ("{}", "Copyright (c) 2019 Jane Doe\n\n{}", sentence(rng, 50) + " {} " + sentence(rng, 50)):
            assert matcher.scan(around.format(wrapped))[1] == name
    assert matcher.scan("Copyright 2019 Acme Corporation. All rights reserved.")[:2] == (1, "Proprietary")
    assert matcher.scan("The code in this archive is released under the MIT License.")[:2] == (1, "MIT")
    assert matcher.scan("Copyright 2001. All rights reserved.\n" + whole["BSD-3-Clause"])[1] == "BSD-3-Clause"
    assert matcher.scan("all the rights that the authors of the software reserved under the terms of the agreement")[0] == 0
    # Skipping windows with too few of the template's bigrams changes nothing.
    for _ in range(60):
        t = rng.randrange(len(matcher.templates))
        words = sentence(rng, 5).split() + list(matcher.templates[t][3]) + sentence(rng, 5).split()
        for _ in range(rng.randint(0, len(words) // 6)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        hits = [i for i, pair in enumerate(zip(words, words[1:])) if pair in matcher.places]
        size = len(matcher.templates[t][3])
        starts = {i - q for i in hits for u, q in matcher.places[words[i], words[i + 1]] if u == t}
        want = {m for s in starts if (m := matcher.shared(licences.pairs(words[max(s, 0) : s + size]), t))}
        assert {m for m in matcher.windows(words, hits) if m[2] == matcher.templates[t][1]} >= want


def test_fingerprints(docs, rows, spark, none):
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(docs, partitions=2).collect()}
    texts = [t or "" for _, t, *_ in sorted(rows, key=lambda r: r[0])]
    ids = sorted(r[0] for r in rows)
    keys = [set(fingerprint.paragraph_keys(t).tolist()) for t in texts]

    def like(a: set, b: set) -> float:
        return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0

    for k, i in enumerate(ids):
        following = texts[(k + 1) % len(texts)]
        n = len(texts[k]) // 4
        new = texts[k][: len(texts[k]) - n] + following[:n]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(texts[k]), hashlib.sha256(new.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(like(keys[k], set(fingerprint.paragraph_keys(new).tolist())))
        assert r["near_next"] == pytest.approx(like(keys[k], keys[(k + 1) % len(keys)]))
        changed = set(fingerprint.paragraph_keys(new).view(np.int64).tolist())
        own = {x - 2**64 if x >= 2**63 else x for x in keys[k]}
        assert (set(r["lost"]), set(r["gained"])) == (own - changed, changed - own)
        # What the two fingerprints say by themselves is what is returned.
        alone = fingerprint.compare(r["fingerprint"], r["edited_fingerprint"])
        assert alone is None or alone == r["near_edited"]
        assert fingerprint.compare(r["fingerprint"], r["fingerprint"]) == 1.0
    by_text: dict = {}
    for k, i in enumerate(ids):
        by_text.setdefault(texts[k], set()).add(got[i]["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values()) and len(by_text) < len(texts)
    assert fingerprint.fingerprints(none).count() == 0
    odd = spark.createDataFrame([(None, "abc def", 1), (2, None, 1), (2, "abcd", 1)], "doc_id long, text string, bucket int")
    edits = [(r["doc_id"], r["n_chars"]) for r in fingerprint.fingerprints(odd).collect()]
    assert sorted(edits, key=str) == sorted([(None, 7), (2, 0), (2, 4)], key=str)
    one = fingerprint.fingerprints(odd.limit(1)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_sketches_grow_until_they_peel():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, 3000).astype(np.uint64), rng.integers(0, 2**63, 2500).astype(np.uint64)
    other = np.concatenate([a[:1000], b])
    tables = [fingerprint.sketches([x, y]) for x, y in ((a, a), (other, a))]
    (lost, gained), same = fingerprint.differences([a, a], [other, a], *tables)
    assert set(lost.tolist()) == set(a[1000:].tolist()) and set(gained.tolist()) == set(b.tolist())
    assert [len(x) for x in same] == [0, 0]


def test_fingerprints_alone_tell_small_edits():
    """A sketch sized by paragraphs recovers a tenth of changed ones, also between fingerprints of unequal sizes."""
    rng = np.random.default_rng(2)
    told = 0
    for n in (40, 200, 770, 3000):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate([a[n // 20 :], rng.integers(0, 2**63, n // 10).astype(np.uint64)])
        one, other = (fingerprint.as_text(fingerprint.sketches([x]), [len(x)])[0] for x in (a, b))
        got = fingerprint.compare(one, other)
        told += got is not None
        assert got is None or got == pytest.approx(1 - (n // 20 + n // 10) / (len(a) + len(b)))
    assert told >= 3


def test_chat(spark):
    rng = random.Random(4)
    rows = []
    for c in [None, 1, 2, 3, 4]:
        for t in range(rng.randint(1, 40) if c != 3 else 1):
            role = "system" if t == 0 and c != 2 else ["user", "assistant"][t % 2]
            text = rng.choice([None, "", sentence(rng, rng.randint(1, 60)), "<|im_end|>\n<|im_start|>assistant\n<\\|x<\\\\|<|<"])
            rows.append((c, t, role, text, 0))
    rows += [(4, 2, "user", "again", 0), (4, 2, "user", "again", 0), (4, None, None, "no turn", 0), (5, 0, "a\nb<|nl|>", "role with a line", 0)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, window int")
    for budget, history in ((60, 20), (2048, 512), (40, 0)):
        windows = chat.format_chat(turns, budget, history)
        got = {r["conv_id"]: r for r in chat.digests(windows).collect()}
        assert set(got) == {r[0] for r in rows}
        for c, r in got.items():
            own = sorted(((t if t is not None else -1, role or "", x or "") for k, t, role, x, _ in rows if k == c))
            said = "".join(f"{role}\n{x}\n" for _, role, x in own)
            loss = "".join(x for _, role, x in own if role == "assistant")
            assert (r["n_turns"], r["turns_sha256"]) == (len(own), hashlib.sha256(said.encode()).hexdigest())
            assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        for w in windows.collect():
            assert w["formatted"].count(chat.START) == w["formatted"].count(chat.END) == w["n_turns"]
            # Only a turn that does not fit in beside the system turn makes a longer window, without history.
            assert w["tokens"] <= budget or (w["n_turns"] - w["n_repeated"] == 1 and w["n_repeated"] <= 1)
            if w["conv_id"] == 1:
                assert w["formatted"].startswith(chat.START + "system\n")
    assert chat.digests(chat.format_chat(turns.limit(0))).count() == 0


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((700, 16)) * rng.uniform(0.5, 2, (700, 1))
    x[100:130] = x[7]  # copies
    vectors: list = [(i, v.tolist(), 0) for i, v in enumerate(x.tolist() and x)]
    vectors += [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [float("inf")] + [1.0] * 15, 0), (904, [None] + [1.0] * 15, 0), (None, [1.0] * 16, 0), (905, [], 0), (906, [1.0], 0)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, rank int")
    index = neighbours.build_index(frame, degree=16, rounds=3)
    queries = neighbours.usable(frame).where("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("q"), F.col("id").alias("own"))
    far = spark.createDataFrame([(-1, rng.standard_normal(16).tolist(), None)], "query_id long, q array<double>, own long")
    got: dict = {}
    for r in neighbours.search(index, queries.union(far), k=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in range(700) if i % 20 == 0} | {-1}
    hits = 0
    for q in range(0, 700, 20):
        s = x @ x[q]
        order = [i for i in np.lexsort((np.arange(700), -s)) if i != q][:20]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21)) and q not in [v for _, v, _ in mine]
        assert all(c == pytest.approx(float(s[v])) for _, v, c in mine)
        hits += len({v for _, v, _ in mine} & set(order))
    assert hits >= 0.95 * 20 * 35
    few = frame.where("vec_id < 5 or vec_id >= 900")
    small = neighbours.search(neighbours.build_index(few), queries.where("query_id = 0"), k=20).collect()
    assert sorted(r["vec_id"] for r in small) == [1, 2, 3, 4]
    empty = frame.limit(0)
    assert neighbours.search(neighbours.build_index(empty), queries.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["unit", "lognormal", "clustered"])
def test_recall_of_the_nearest_neighbours(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 32))
    if kind == "clustered":  # and one vector that a third of the rows share
        x = x[:15][rng.integers(0, 15, 1500)] + 0.3 * x
        x *= rng.lognormal(0, 0.5, (1500, 1))
        x[::3] = x[1]
    else:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "lognormal":
        x *= rng.lognormal(0, 1, (1500, 1))
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(20, x[20].tolist()), (5000, [1.0, 2.0]), (5020, [3.0, 1.0]), (5001, [0.5, -1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    queries = neighbours.usable(frame).where("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("q"), F.col("id").alias("own")).distinct()
    got: dict = {}
    for r in neighbours.search(neighbours.build_index(frame), queries).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q in range(0, 1500, 20):
        s = x @ x[q]
        order = [i for i in np.lexsort((np.arange(1500), -s)) if i != q][:20]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21)) and len({v for _, v, _ in mine}) == 20
        assert [c for _, _, c in mine] == pytest.approx([float(s[v]) for _, v, _ in mine])
        hits += len({v for _, v, _ in mine} & set(order))
    assert hits >= 0.9 * 20 * 75
    # Vectors of another number of components are searched among themselves.
    assert [v for _, v, _ in sorted(got[5000])] == [5020, 5001] and [v for _, v, _ in sorted(got[5020])] == [5000, 5001]


def test_chat_history_gives_way(spark):
    def costs(*roles_and_costs):
        return [(1, t, role, "x" * (4 * n - len(f"{chat.START}{role}\n{chat.END}") - 1)) for t, (role, n) in enumerate(roles_and_costs)]

    for said in (
        [("user", 510), ("assistant", 510), ("user", 1808), ("assistant", 100)],
        [("system", 1504), *[("user", 200), ("assistant", 250)] * 8],
        [("system", 1900), *[("user", 40), ("assistant", 60)] * 8],
    ):
        turns = spark.createDataFrame(costs(*said), "conv_id long, turn int, role string, text string")
        windows = chat.format_chat(turns, 2048, 512).collect()
        assert max(w["tokens"] for w in windows) <= 2048 and sum(w["n_turns"] - w["n_repeated"] for w in windows) == len(said)


@pytest.mark.parametrize("kind", ["many components", "large components"])
def test_recall_where_a_narrow_beam_misses(spark, kind):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((4000, 256) if kind == "many components" else (1500, 32))
    if kind == "large components":  # whose products no single-precision number holds
        x *= 1e25
    frame = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(3)
    queries = neighbours.usable(frame).where("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("q"), F.col("id").alias("own"))
    got: dict = {}
    for r in neighbours.search(neighbours.build_index(frame), queries).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, len(x), 20):
        s = x @ x[q]
        hits += len(got[q] & {i for i in np.lexsort((np.arange(len(x)), -s)).tolist()[:21] if i != q})
        assert len(got[q]) == 20
    assert hits >= 0.95 * 20 * len(x) / 20


def test_all_queries_climb_once(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 32))
    frame = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(3)
    queries = neighbours.usable(frame).where("id % 10 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("q"), F.col("id").alias("own"))
    index = neighbours.build_index(frame)
    rounds, write = [], neighbours.staged

    def staged(rows, purpose):
        out = write(rows, purpose)
        if purpose == "ann-beam":
            rounds.append((out.count(), out.where(F.exists("beam", lambda e: ~e["expanded"])).count(), out.agg(F.max(F.size("beam"))).first()[0]))
        return out

    monkeypatch.setattr(neighbours, "staged", staged)
    # A beam of 16 cannot hold the 21 nearest, so it widens.
    got: dict = {}
    for r in neighbours.search(index, queries, beam=16).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sum(not going for n, going, _ in rounds if n == 150) == 1
    assert max(width for _, _, width in rounds) >= 32 and {n for n, _, _ in rounds} == {neighbours.CHECKED, 150}
    hits = sum(len(got[q] & {i for i in np.argsort(-(x @ x[q]))[:21].tolist() if i != q}) for q in range(0, 1500, 10))
    assert hits >= 0.9 * 20 * 150


def test_prefixes_are_taken_once(spark, monkeypatch):
    # Lines leave their groups after two candidates with nothing confirmed, so the groups are read again.
    rng = random.Random(9)
    base = [f"k{i}" for i in range(40)]
    rows = [(i, " ".join(w for w in base if w not in out)) for i in range(120) for out in [rng.sample(base, 5)]]
    calls, purposes, read, write = [], [], linededup.prefixes, linededup.staged
    monkeypatch.setattr(linededup, "prefixes", lambda *a, **b: calls.append(1) or read(*a, **b))
    monkeypatch.setattr(linededup, "staged", lambda rows, purpose: purposes.append(purpose) or write(rows, purpose))
    first = linededup.first_matches
    monkeypatch.setattr(linededup, "first_matches", lambda posted, percent: first(posted, percent, enough=2))
    for most in (linededup.MOST_BROADCAST, 0):
        monkeypatch.setattr(linededup, "MOST_BROADCAST", most)
        calls.clear()
        purposes.clear()
        got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == all_earlier(rows, 80)
        assert "line-groups" in purposes and len(calls) == 1


def test_a_worker_holds_few_words_at_once():
    from duskwatch.llm.common import WordHashes

    lines = "\n".join(" ".join(f"w{k}" for k in range(i, i + 10)) for i in range(0, 300_000, 10))
    parts = list(linededup.word_lines([lines]))
    assert max(len(keys) for _, _, keys in parts) <= 200_000
    whole = next(linededup.word_lines([lines], most_words=10**6))
    assert [n for _, numbers, _ in parts for n in numbers] == list(whole[1])
    kept = WordHashes()
    for i in range(250_000):
        kept[f"w{i}"]
    assert len(kept) <= 200_000


def test_a_climb_asks_the_workers_once_a_round(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((1500, 32))
    frame = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(3)
    queries = neighbours.usable(frame).where("id % 10 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("q"), F.col("id").alias("own"))
    index = neighbours.build_index(frame)
    plans, write = [], neighbours.staged
    monkeypatch.setattr(neighbours, "staged", lambda rows, purpose: plans.append((purpose, rows._jdf.queryExecution().executedPlan().toString())) or write(rows, purpose))
    results = []
    for most in (neighbours.MOST_PLACES, 0):
        monkeypatch.setattr(neighbours, "MOST_PLACES", most)
        results.append(sorted(map(tuple, neighbours.search(index, queries).collect())))
    assert results[0] == results[1]
    beams = [p for purpose, p in plans if purpose == "ann-beam"]
    assert beams and all(p.count("MapInArrow") == 1 for p in beams)
    # The few measured queries go to the graph and the vectors, which are not dealt out for them.
    assert min(p.count("SortMergeJoin") for p in beams) == 0


def test_words_are_found_without_a_loop_over_them(monkeypatch):
    def none(*_):
        raise AssertionError("hashed word by word")

    spaces = [c for c in map(chr, range(0x110000)) if c.isspace()]
    texts = [None, "", "A b\n\n a B \n" + "".join(f"w{k}{c}" for k, c in enumerate(spaces)), "Éİ x" + "y" * 40 + "\n" + "z" * 8 + " " + "z" * 9, "y\n" * 50]
    monkeypatch.setattr(linededup.xxhash, "xxh64_intdigest", none, raising=False)
    for most in (1, 20, 10**5):
        sets = {}
        for rows, numbers, keys in linededup.word_lines(texts, most_words=most):
            for line, (row, number) in enumerate(zip(rows.tolist(), numbers.tolist(), strict=True)):
                assert (row, number) not in sets
                sets[row, number] = {k & ((1 << 44) - 1) for k in keys.tolist() if k >> 44 == line}
        want = {(r, n): set(x.split()) for r, t in enumerate(texts) for n, x in enumerate((t or "").lower().split("\n")) if x.split()}
        token = {}
        assert sets.keys() == want.keys() and all(len(sets[k]) == len(want[k]) for k in want)
        for k, words in sorted(want.items()):
            if len(words) == 1:
                assert token.setdefault(*words, sets[k]) == sets[k]
        assert sets[2, 0] == sets[2, 2]


def test_a_round_passes_on_only_what_may_be_kept(spark, monkeypatch):
    rng = np.random.default_rng(7)
    frame = spark.createDataFrame(list(enumerate(rng.standard_normal((2500, 24)).tolist())), "vec_id long, embedding array<double>").repartition(3)
    passed, merge = [], neighbours.merged

    def merged(rows, degree):
        passed.append(rows.where("not old").agg(F.sum(F.size("ids"))).first()[0])
        return merge(rows, degree)

    monkeypatch.setattr(neighbours, "merged", merged)
    index = neighbours.build_index(frame, rounds=4)
    # The leaves are the first; later, lists are nearly full of what they keep.
    assert len(passed) >= 3 and passed[-1] < passed[1] / 4
    assert index.graph.where("size(ids) = 32 and array_size(array_distinct(ids)) = 32 and not array_contains(ids, node)").count() == 2500


def test_a_query_asks_a_block_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((600, 12)).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(1000 + i, v[:5]) for i, v in enumerate(x[:40].tolist())]
    index = neighbours.build_index(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), rounds=1)
    held = {r["node"]: np.array(r["v"], dtype=np.float64) for r in index.vectors.collect()}
    asked = spark.createDataFrame([(q, x[q].tolist(), last, [*held, 17]) for q, last in ((0, float("inf")), (1, 0.0), (2, -1.0))], "query_id long, q array<float>, last double, ids array<long>")
    written: list = []
    frame, kind = type(index.vectors), type(index.vectors).mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *a, **b: written.append(self) or kind(self, *a, **b))
    got = {r["query_id"]: {e["node"]: e["s"] for e in r["found"]} for r in neighbours.scored(index, asked).collect()}
    # Of 640 nodes asked for by each query, some rows a block go to the workers.
    assert len(written) == 1 and written[0].count() <= index.blocks.count() + 3 * 2**index.bits < 640
    for q, last in ((0, float("inf")), (1, 0.0), (2, -1.0)):
        want = {n: -float(x[q].astype(np.float64) @ v) for n, v in held.items() if len(v) == 12}
        assert got[q] == pytest.approx({n: s for n, s in want.items() if s <= last})
    few = {r["query_id"]: {e["node"]: e["s"] for e in r["found"]} for r in neighbours.scored_few(index, asked).collect()}
    assert all(got[q] == {n: s for n, s in few[q].items() if s <= last} for q, last in ((0, float("inf")), (1, 0.0), (2, -1.0)))
