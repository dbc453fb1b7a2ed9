"""A sample of the registered queries against their check SQL; `check.py` runs all of them."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
from cellhours.plans.oracle import ORACLES
from cellhours.plans.registry import QUERIES
from check import same

duckdb = pytest.importorskip("duckdb")
SF_DIR = Path("/root/testdata/sf0.001")
SAMPLE = ["build_features", "snapshot_flatten", "slot_coverage", "health_transitions", "chrono_split"]

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no generated tables here")


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_check_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    ours = spark_entry.queries()[name](spark, str(SF_DIR)).toPandas()
    assert same(ours, con.execute(spark_entry.oracle_sql()[name]).df()) == ""


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry_has_the_feature_schema(spark):
    flagship = spark_entry.entry(spark)
    assert flagship.columns[:2] == ["h3_cell", "slot_start"]
    assert flagship.columns[-1] == "target_is_degraded"
    assert len(flagship.columns) == 36
