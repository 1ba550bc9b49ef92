"""Every registered query against its SQL, and the contract of the entry point."""

import subprocess
import sys

import pytest

import __spark_entry__ as entry
from tests.oracle import ROOT, connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    assert difference(entry.queries()[name](spark, SF), db, entry.oracle_sql()[name]) is None


def test_sql_checks_every_query_of_the_registry():
    import registry

    assert all(area.QUERIES.keys() == area.ORACLES.keys() for area in registry.AREAS)
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


AWAY = """
import sys
sys.path.insert(0, sys.argv[1])
from uttera.session import local_session
import __spark_entry__ as entry
spark = local_session(2)
print("rows", len(entry.queries()["infer_stage"](spark, sys.argv[2]).collect()))
"""


def test_python_stages_run_from_any_folder():
    done = subprocess.run([sys.executable, "-c", AWAY, str(ROOT), SF], cwd="/", capture_output=True, text=True, timeout=180)
    assert "rows 200" in done.stdout, done.stderr[-2000:]
