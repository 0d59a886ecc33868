import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from check import connect, differences
from newscov.registry.oracles import ORACLES
from newscov.registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WITHOUT_SQL = {
    "stratified_split", "detector_scores", "detector_report", "detector_confusion", "detector_loss", "category_scores", "category_metrics",
    "seeded_topics",
}

needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_every_query_has_sql_unless_it_cannot():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert not set(entry.oracle_sql()) - set(entry.queries())


def test_registry_needs_neither_session_nor_jars():
    code = "import glob; glob.glob = lambda *a, **k: []; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    env = os.environ | {"SPARK_HOME": "/nonexistent", "JAVA_HOME": "/nonexistent", "PATH": "/usr/bin:/bin"}
    root = Path(__file__).resolve().parents[1]
    said = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    assert int(said.stdout.split()[-2]) >= len(QUERIES)


@needs_data
def test_entry(spark):
    assert entry.entry(spark).columns == ["period", "total_articles", "articles_climat", "ratio"]
    assert entry.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITHOUT_SQL))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, connect(SF_DIR), SF_DIR, name) is None


@needs_data
@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql_runs(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0
