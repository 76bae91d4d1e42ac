"""Plan guards over the whole query catalog: no cross or nested-loop joins,
no Python evaluation on the default path, pruned and filtered scans."""

import os

import pytest

import __spark_entry__ as E
from wordmill.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def executed_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


# The cut of a cell depends on the cut before it, which no built-in expression
# follows: cells are cut in Arrow batches.
ARROW_QUERIES = {"chunk_blocks"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_python(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()
    python = ("ArrowEvalPython", "PythonUDF") if name not in ARROW_QUERIES else ()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", *python):
        assert bad not in plan, f"{name}: {bad}"


def formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_text_scan_reads_two_columns(spark):
    text = formatted(E.queries()["word_frequency"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert "partial_count" in text


def test_top_words_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in formatted(E.queries()["top_words"](spark, SF))


def test_selection_pushes_filter_into_events_scan(spark):
    text = formatted(E.queries()["select_date_range"](spark, SF))
    assert "PushedFilters" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_attempt_log_scan_pushes_event_type(spark):
    text = formatted(E.queries()["attempt_state"](spark, SF))
    assert "In(event_type, [error,purchase])" in text


def test_word_cloud_max_is_scalar_subquery(spark):
    text = formatted(E.queries()["word_cloud_weights"](spark, SF))
    assert "Subquery" in text and "Window" not in text


def _is_broadcast_hinted(df):
    return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()


def test_bounded_broadcast_checks_rows_and_bytes(spark):
    from wordmill.plans.physical import bounded_broadcast, broadcast_size

    narrow = spark.createDataFrame([(i, f"w{i}") for i in range(10)], "id bigint, word string")
    assert broadcast_size(narrow, 100) == (10, 10 * (16 + 8) + sum(len(f"w{i}") for i in range(10)))
    assert _is_broadcast_hinted(bounded_broadcast(narrow, max_rows=10))
    # One row too many, or a few rows too wide: no hint, Catalyst/AQE decide.
    assert not _is_broadcast_hinted(bounded_broadcast(narrow, max_rows=9))
    wide = spark.createDataFrame([(i, "x" * 10_000) for i in range(3)], "id bigint, text string")
    assert not _is_broadcast_hinted(bounded_broadcast(wide, max_rows=10, max_bytes=20_000))
    assert _is_broadcast_hinted(bounded_broadcast(wide, max_rows=10, max_bytes=40_000))


def test_checkpoint_dir_comes_from_the_session(spark):
    from wordmill.session import checkpoint_dir

    # The folder is the session's setting (Spark adds a per-application
    # subfolder under it); asking again never picks another one.
    first = checkpoint_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir")
    assert first.replace("file:", "").startswith(configured.replace("file:", "").rstrip("/"))
    assert checkpoint_dir(spark) == first


def test_selection_runs_regex_after_cheap_conditions(spark):
    # Conjuncts keep their order in the plan: the hash-set channel test must
    # come before the keyword regex over the description.
    text = formatted(E.queries()["select_all_conditions"](spark, SF))
    cond = next(line for line in text.splitlines() if "RLIKE" in line)
    assert cond.index(" IN (") < cond.index("RLIKE")
