"""Every library query against its SQL, on the smallest tables."""

import pytest
from conftest import SF, oracle_rows, rows_of

from sparley import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert rows_of(queries.QUERIES[name](spark, SF)) == oracle_rows(queries.ORACLES[name])


def test_audit_runs_all_phases_and_finds_the_planted_faults(spark):
    found = queries.QUERIES["audit_report"](spark, "/root/testdata/sf0.01").collect()  # every fault is met there
    assert {r["phase"] for r in found} == set(range(1, 11)) and not any(r["check"].endswith("_error") for r in found)
    by = {r["check"]: r["severity"] for r in found if r["key"] is None}
    assert by["date_parse_rate"] == by["meeting_several_dates"] == "ISSUE" and by["other_speeches"] == "WARN" and by["meeting_several_term"] == "OK"


def test_investigation_shows_the_planted_change(spark):
    found = {(r["check"], r["key"]): r["value"] for r in queries.QUERIES["investigation"](spark, SF).collect()}
    assert found["role_change", "other > legislator"] > 0
    assert found["recount_new_n", None] == 0


def test_entry_point_works_without_the_llm_folders(tmp_path):
    import shutil
    import subprocess
    import sys

    from conftest import ROOT

    for name in ("sparley", "__spark_entry__.py"):
        source = ROOT / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "sparley" / "llm", ignore_errors=True)
    code = """
import __spark_entry__ as e
from pyspark.sql import SparkSession
assert 'dyads' in e.queries() and 'pipeline' not in e.queries() and not any(n.startswith('op') and n[2:3].isdigit() for n in e.oracle_sql())
spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()
assert e.entry(spark).count() > 0 and e.queries()['semi_join'](spark, '/root/testdata/sf0.001').count() > 0
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
