"""The registered queries against their SQL or brute force, and the pipeline."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import compare, duck  # noqa: E402
from tests.llm import brute  # noqa: E402
from wordmill.llm.queries import QUERIES, SQL  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_all_are_registered():
    names = set(E.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF)[0] == "OK"


def test_near_dedup_query(spark, con):
    rows = con.sql("select doc_id, text from documents").fetchall()
    component, size = brute.near_components(rows, 3, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_minhash_near_dedup"](spark, SF).collect()}
    assert got == {d: (size[d], component[d]) for d in component}


@pytest.mark.parametrize("name", ["op4_pii_pseudonyms", "op8_chat_format"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_pipeline(spark, con):
    """Each stage on what the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = [{r.doc_id: r.text for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            seen.append({r.doc_id: r.text for r in docs.collect()})
    raw, good, lines, near, mixed = seen
    assert good.items() <= raw.items() and len(good) > 0.7 * len(raw)
    from tests.llm.test_operators import drop_lines

    assert lines == {d: t for d, (_, _, t) in drop_lines(list(good.items())).items()}
    component, _ = brute.near_components(list(lines.items()), 5, 80)
    assert near == {d: lines[d] for d, c in component.items() if c == d}
    assert mixed.items() <= near.items()
    assert {r.doc_id for r in docs.collect()} == set(mixed)
