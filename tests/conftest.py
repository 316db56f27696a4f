import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "3g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip(f"no data at {DATA}")
    return DATA


def plain(v):
    """A value as text, the same from either engine."""
    if v is None or isinstance(v, float) and v != v:
        return "null"
    if isinstance(v, float):
        return repr(round(v, 5) + 0.0)
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "__index__"):
        return repr(round(float(int(v)), 5))
    return str(v)


@pytest.fixture(scope="session")
def same(spark, data):
    """Runs a query and its SQL over the smallest data and compares the rows."""
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")

    def check(query, sql):
        df = query(spark, data)
        cols = sorted(df.columns)
        got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
        cur = con.execute(sql)
        names = [x[0] for x in cur.description]
        assert sorted(names) == cols
        want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())
        assert got == want

    return check
