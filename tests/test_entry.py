"""Every query of the list engine against its SQL, and the driver's entry points."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from listloom import queries as own

ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def db():
    from conftest import SF

    con = duckdb.connect()
    for t in ("pages", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(own.queries()))
def test_query(spark, sf_dir, db, name):
    df = own.queries()[name](spark, sf_dir)
    got = db.execute(own.oracle_sql()[name])
    names = [d[0] for d in got.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    expected = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in got.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == expected


def test_entry(spark, sf_dir):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_training_operators(tmp_path):
    """The rest works where the training operators and the pipeline have been taken away."""
    import shutil

    shutil.copytree(ROOT / "listloom", tmp_path / "listloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'merge_rules' in q and not any(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "HOME": "/root"})
