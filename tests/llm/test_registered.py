"""Every registered query of the subpackage, and the pipeline, over small tables; against SQL where there is one."""

import pytest
from compare import check, duck

import __spark_entry__ as e
import corpus_pipeline
from duskwatch.llm.registry import LLM_ORACLES, LLM_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_names():
    numbers = sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES)
    assert numbers == list(range(1, 14)) and set(LLM_ORACLES) <= set(LLM_QUERIES)
    assert set(LLM_QUERIES) | {"pipeline"} <= set(e.queries())


@pytest.mark.parametrize("name", list(LLM_QUERIES))
def test_query(spark, con, name):
    if name in LLM_ORACLES:
        assert check(spark, con, name, LLM_QUERIES[name], LLM_ORACLES[name], SF).startswith("ok")
    else:
        assert LLM_QUERIES[name](spark, SF).count() > 0


def test_pipeline(spark):
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert len(got) and not got.duplicated(["sequence_id", "offset"]).any()
