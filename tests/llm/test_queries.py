import pytest
from compare import connect, differences

import __spark_entry__ as contract
from siltgauge.llm.queries import LLM_ORACLE, LLM_QUERIES


def test_all_are_registered():
    assert set(LLM_QUERIES) | {"pipeline"} <= set(contract.queries())
    assert {name.split("_")[0] for name in LLM_QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(LLM_ORACLE) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    rows, complaints = differences(spark, connect(sf_dir), sf_dir, LLM_QUERIES[name], LLM_ORACLE[name])
    assert complaints == [] and rows > 0


@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - set(LLM_ORACLE)))
def test_query_covers_its_table(spark, sf_dir, name):
    out = LLM_QUERIES[name](spark, sf_dir)
    kind = "page_id" if name == "op9_main_text" else "doc_id"
    given = spark.read.parquet(f"{sf_dir}/{'pages' if kind == 'page_id' else 'documents'}.parquet")
    ids = {r[0] for r in out.select(kind).collect()}
    every = {r[0] for r in given.select(kind).collect()}
    assert ids == every or name in ("op2_decontaminate", "op4_secrets") and ids and ids < every
