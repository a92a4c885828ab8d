"""The registered queries: their SQL on the smallest tables, their columns, and the library without its llm part."""

import glob
import os
import subprocess
import sys

import pytest

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

sys.path.insert(0, ROOT)
import __spark_entry__ as entry  # noqa: E402

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(value):
    import numpy as np
    import pandas as pd

    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, (float, np.floating)) and value != value):
        return None
    if isinstance(value, (float, np.floating)):
        return round(float(value), 6)
    if isinstance(value, np.bool_):
        return bool(value)
    return int(value) if isinstance(value, np.integer) else tuple(map(plain, value)) if isinstance(value, (list, np.ndarray)) else value


def rows(df):
    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None)), key=repr)


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, duck, name):
    got, want = QUERIES[name](spark, FOLDER).toPandas(), duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_names():
    assert set(ORACLE) <= set(QUERIES)


@needs_tables
def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_without_llm(tmp_path):
    """Nothing outside the llm package needs it."""
    subprocess.run(["cp", "-r", f"{ROOT}/corpusloom", f"{ROOT}/__spark_entry__.py", str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", f"{tmp_path}/corpusloom/llm"], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'p4_found' in q and not any(k.startswith('p1_') for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
