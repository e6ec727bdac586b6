import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from stratum.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_every_operator_is_registered():
    names = entry.queries()
    assert [n for n in range(1, 14) if not any(k.startswith(f"op{n}_") for k in names)] == []
    assert "pipeline" in names and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_entry_works_without_the_folders(tmp_path):
    """Without the subpackage and the pipeline the other queries are all there."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    os.symlink(f"{root}/__spark_entry__.py", tmp_path / "__spark_entry__.py")
    os.mkdir(tmp_path / "stratum")
    for f in os.listdir(f"{root}/stratum"):
        if f not in ("llm", "__pycache__"):
            os.symlink(f"{root}/stratum/{f}", tmp_path / "stratum" / f)
    code = ("import sys; sys.path.insert(0, '.'); import importlib.util as u\n"
            "src = open('__spark_entry__.py').read().replace('os.path.abspath(__file__)', repr(sys.argv[1] + '/x'))\n"
            "ns = {'__name__': 'e', '__file__': sys.argv[1] + '/x'}; exec(compile(src, 'e', 'exec'), ns)\n"
            "q = ns['queries'](); assert 'fact_sales' in q and 'pipeline' not in q and not any(k.startswith('op') for k in q)\n"
            "assert set(ns['oracle_sql']()) <= set(q)")
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path)], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
