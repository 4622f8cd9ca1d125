"""Streams' results are tables that executors write: nothing of them is held by the driver."""

from __future__ import annotations

import pytest

from parley import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["stream_classified", "stream_deduplicated", "stream_jobs", "stream_restart_groups", "stream_restart_state", "stream_sessions"])
def test_streams_leave_no_memory_table(spark, name):
    found = registry.queries()[name](spark, SF)
    assert "parquet" in found._jdf.queryExecution().optimizedPlan().toString().lower() or found.inputFiles()
    assert "MemoryPlan" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() > 0
