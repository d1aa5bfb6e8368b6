"""Plan-level guards over every registered query (sf0.001)."""

import pytest

import __spark_entry__ as E

from conftest import plan_text

SF = "/root/testdata/sf0.001"
# keys whose build step writes files or tables (their read-back plans are plain scans)
IO_KEYS = {"ingest_csv", "ingest_config", "create_tables_catalog", "write_overwrite_roundtrip",
           "rename_table_roundtrip", "ingest_stream", "layered_pipeline", "layered_pipeline_audit"}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]


@pytest.mark.parametrize("key", sorted(k for k in E.queries() if k not in IO_KEYS))
def test_no_cross_join_no_python_in_plan(spark, key):
    plan = plan_text(E.queries()[key](spark, SF), mode="extended")
    for op in FORBIDDEN:
        assert op not in plan, f"{key}: {op} in plan"


def test_whole_table_scans_are_pruned(spark):
    """A query over two lineitem columns reads only those two columns."""
    plan = plan_text(E.queries()["dup_check_lineitem"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_linenumber)]" in plan
