import pytest

from annospark import queries
from annospark.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(same, name):
    same(QUERIES[name], ORACLE_SQL[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry_imports_without_the_llm_folders():
    import subprocess
    import sys

    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['annospark.llm'] = None\n"
        "import __spark_entry__ as e; q = e.queries(); assert 'octree_counts' in q and not any(n.startswith('op') and n[2].isdigit() for n in q); print(len(q))"
    )
    from conftest import ROOT

    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr


def test_lines_of_orders_are_dealt_by_their_number(spark, sf, monkeypatch):
    """A task gathers as many lines in a large table as in a small one."""
    monkeypatch.setattr(queries, "TASK_ROWS", 100)
    n = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert queries.orders_of_parts(spark, sf).rdd.getNumPartitions() == -(-n // 100)
