import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false",
    }
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def same(spark, duck, sf):
    """Whether a query has the rows of its SQL, whatever their order."""

    def text(v):
        return repr(round(v, 6)) if isinstance(v, float) else v.hex() if isinstance(v, bytes | bytearray) else str(v)

    def rows(values, names):
        order = sorted(range(len(names)), key=lambda i: names[i])
        return [names[i] for i in order], sorted(tuple(text(r[i]) for i in order) for r in values)

    def compare(query, sql):
        df = query(spark, sf)
        want = duck.sql(sql)
        assert rows(df.collect(), df.columns) == rows(want.fetchall(), want.columns)

    return compare
