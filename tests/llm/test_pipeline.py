"""The pipeline's stages one by one: whole results, null and repeated ids, empty tables, clashing columns."""

import random

import pytest

import corpus_pipeline as cp

DOCS = "doc_id long, text string, lang string, source string, n_chars long, __row string, score string, pos string"
BAD = "vile nasty rotten"


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """A labels table, with the documents it marks."""
    rng = random.Random(2)
    path = str(tmp_path_factory.mktemp("sf"))
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*rng.choices(words, k=30), *([BAD] if i % 4 == 0 else []), *rng.choices(words, k=30)])) for i in range(400)]
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", "x", "x") for i, t in rows], DOCS).repartition(3)


def texts(df):
    return sorted((str(r["doc_id"]), r["text"] or "") for r in df.collect())


def test_toxicity_judges_each_row_by_its_text(spark, sf):
    path, rows = sf
    clean = " ".join(f"w{i}" for i in range(40))
    odd = [(None, f"{clean} {BAD} {BAD}"), (None, clean), (7001, clean), (7001, f"{BAD} {clean} {BAD}"), (7002, None), (7003, "")]
    docs = table(spark, rows + odd)
    kept = cp.drop_toxic(spark, docs, path)
    assert kept.columns == docs.columns
    left = texts(kept)
    assert [x for x in left if x[0] in ("None", "7001", "7002", "7003")] == sorted([("None", clean), ("7001", clean), ("7002", ""), ("7003", "")])
    assert {int(i) for i, _ in left if i != "None" and int(i) < 400} == {i for i in range(400) if i % 4}
    assert cp.drop_toxic(spark, docs.limit(0), path).count() == 0


def test_line_stage(spark, sf):
    rows = [(1, "a b c d\nq r s t"), (2, "q r s t"), (2, "m n o p"), (None, "a b c d"), (3, None), (4, ""), (5, "A B C D\nu v w x")]
    docs = table(spark, rows)
    kept = cp.drop_repeated_lines(spark, docs, sf[0])
    assert kept.columns == docs.columns
    assert texts(kept) == sorted([("1", "a b c d\nq r s t"), ("2", "m n o p"), ("None", "a b c d"), ("3", ""), ("4", ""), ("5", "u v w x")])
    assert {r["n_chars"] for r in kept.where("doc_id = 5").collect()} == {7}
    assert cp.drop_repeated_lines(spark, docs.limit(0), sf[0]).count() == 0


def test_near_duplicate_stage(spark, sf):
    a = " ".join(f"x{i}" for i in range(120))
    b = a.replace("x60 ", "y ")
    other = " ".join(f"z{i}" for i in range(120))
    plain = table(spark, [(3, a), (5, b), (9, other), (11, a), (12, None)])
    assert texts(cp.drop_near_duplicates(spark, plain, sf[0])) == sorted([("3", a), ("9", other), ("12", "")])
    odd = table(spark, [(None, b), (5, a), (5, other), (7, other), (8, None), (8, "")])
    kept = cp.drop_near_duplicates(spark, odd, sf[0])
    assert kept.columns == odd.columns
    assert texts(kept) == sorted([("None", b), ("5", other), ("8", ""), ("8", "")])
    assert cp.drop_near_duplicates(spark, odd.limit(0), sf[0]).count() == 0


def test_mixing_and_packing_stages(spark, sf):
    docs = table(spark, [(1, "one two"), (None, None), (2, ""), (2, "three four five")])
    mixed = cp.mix_sources(spark, docs, sf[0])
    assert mixed.columns == docs.columns and set(texts(mixed)) <= set(texts(docs))
    assert cp.mix_sources(spark, docs.limit(0), sf[0]).count() == 0
    packed = cp.pack(spark, docs, sf[0])
    assert packed.count() == 4 and cp.pack(spark, docs.limit(0), sf[0]).count() == 0
