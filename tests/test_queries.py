"""Every query against DuckDB on the driver's smallest tables."""

from pathlib import Path

import pytest

import oracle
from kinetrace.plans import catalog

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    oracle.compare(spark, FOLDER, catalog.QUERIES[name], catalog.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    assert df.count() > 0 and df.schema == catalog.QUERIES[name](spark, FOLDER).schema


def test_entry_imports_without_the_training_data_operators(tmp_path):
    import subprocess
    import sys

    root = Path(__file__).resolve().parents[1]
    code = "import sys; sys.modules['kinetrace.llm'] = None; sys.path.insert(0, %r); import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q); e.oracle_sql()" % str(root)
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)
