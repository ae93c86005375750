"""A cross-section of the registered queries against their SQL; ``python -m workload.check`` runs all."""

import duckdb
import pytest

from workload import catalogue
from workload.check import compare
from workload.inputs import BASE

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "m01_stage_health", "m02_stage_population", "m03_stage_education", "m04_stage_needs", "h_report", "b_report",
    "e_report", "f02_column_profile", "f09_uniqueness", "v17_plain_frame", "x05_agreement", "x14_join_strategies",
    "x15_unmatched", "j15_spatial_join", "s01_csv_scan", "k04_additive_columns", "r02_register_sources",
)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, db, name):
    status, _, _, note = compare(spark, db, FOLDER, name)
    assert status == "ok", note


def test_driver_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 1500
    # These names are left to the operators on text collections.
    assert not [q for q in catalogue.QUERIES if "pipeline" in q or q.startswith("op")]
