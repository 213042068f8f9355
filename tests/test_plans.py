"""Plan checks: the shapes we rely on for scale."""

import pytest

from mailframe.plans import QUERIES
from tests.conftest import SF_SMALL

PYTHON_NODES = ("MapInPandas", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "PythonUDF")
PARSE_QUERIES = {"parse_round_trip", "error_rows", "mail_documents"}
# These run polls at call time; their result is a Parquet read of the store.
SKIP = {
    "store_after_stream", "store_after_split_snapshot", "folder_vanish_return", "poll_with_bodies", "late_older_snapshot", "store_after_replay",
    "mailbox_emptied", "store_after_renumbering", "store_after_recurring", "poll_mixed_accounts", "documents_of_index", "documents_of_accounts",
    "document_by_id", "poll_metrics",
}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_cartesian_and_python_only_in_parse(spark, name):
    plan = physical(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    has_python = any(n in plan for n in PYTHON_NODES)
    assert has_python == (name in PARSE_QUERIES), plan[:2000]


@pytest.mark.parametrize("name", ["new_messages", "flag_changes", "expunged_messages", "pop_new", "store_after_poll"])
def test_sync_plans_prune_payload_columns(spark, name):
    plan = physical(QUERIES[name](spark, SF_SMALL))
    for line in plan.splitlines():
        if "ReadSchema" in line and "events.parquet" in line:
            schema = line.split("ReadSchema:")[1]
            assert "props" not in schema and "value" not in schema, line


def test_match_runs_one_regex_without_token_arrays(spark):
    plan = physical(QUERIES["match"](spark, SF_SMALL))
    assert "RLIKE" in plan.upper() and "split(" not in plan


def test_numbering_has_no_whole_folder_window(spark):
    from mailframe.sources import fixtures as fx

    plan = physical(fx.pop_server(spark, SF_SMALL))
    # windows are keyed by (folder, uid bucket) and by folder over the bucket counts only
    assert "_bucket" in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_every_query_reads_the_given_tables(spark, name):
    plan = physical(QUERIES[name](spark, SF_SMALL))
    assert "FileScan parquet" in plan and SF_SMALL in plan
