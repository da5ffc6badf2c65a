import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences

QUERIES = entry.queries()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, connection, sf_dir, name):
    assert differences(spark, connection, sf_dir, name) is None


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(QUERIES)


def test_entry_gives_a_sorted_result(spark):
    result = entry.entry(spark)
    assert result.dtypes == [("eclassnumber", "int"), ("prediction", "int")]
    assert result.count() > 0


@pytest.mark.parametrize("package", ["public_tokenizers", "corpus_pipeline"])
def test_other_queries_stay_without_what_the_text_operators_need(package):
    code = f"""
import sys
sys.modules[{package!r}] = None
import __spark_entry__ as entry
names = set(entry.queries())
assert "predictions" in names and "pipeline" not in names and not any(n.startswith("op") for n in names), names
assert set(entry.oracle_sql()) <= names
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent)
