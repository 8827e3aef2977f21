"""Every core query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from cairn.plans import queries as core

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return v if isinstance(v, (bool, int, str)) else round(float(v), 6) if hasattr(v, "as_tuple") else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_query(spark, con, name):
    df = core.queries()[name](spark, SF)
    cur = con.execute(core.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    order = sorted(cols)
    want = sorted((tuple(plain(r[cols.index(c)]) for c in order) for r in cur.fetchall()), key=str)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=str)
    assert got == want


def test_entry_without_llm(tmp_path):
    """The entry module imports when the training-data operators are gone."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/cairn", tmp_path / "cairn", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[0] == str(len(core.queries()))
