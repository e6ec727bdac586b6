"""Driver contract: entry smoke run, and every registered query against its
DuckDB oracle on the smallest driver tables."""

import os
import re
import subprocess
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare, duck  # noqa: E402
from sf_dirs import SF_SMALL  # noqa: E402


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_id", "customer_id", "order_status", "total_order_value",
                          "customer_state", "delivery_time_days"]
    assert df.count() > 0


#: The optional operators have tests of their own.
CORE = sorted(n for n in entry.queries() if n != "pipeline" and not re.match(r"op\d+_", n))


def test_every_query_has_an_oracle():
    assert set(CORE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, SF_SMALL, con)
    assert ok, msg


def test_entry_without_the_optional_packages():
    """Where a package of the training-data operators is missing, all core queries are there."""
    code = ("import sys; sys.modules['public_tokenizers'] = None\n"
            "import __spark_entry__ as e\n"
            "assert sorted(e.queries()) == sys.argv[1].split(','), sorted(e.queries())")
    done = subprocess.run([sys.executable, "-c", code, ",".join(CORE)], capture_output=True, text=True, timeout=120,
                          cwd=os.path.dirname(os.path.abspath(entry.__file__)))
    assert done.returncode == 0, done.stderr[-2000:]
