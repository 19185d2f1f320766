"""Every registered query against its SQL: column names and types, and all rows."""

import math
import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = "/root/testdata/sf0.01"
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def rows_of(columns, rows):
    """Rows with columns in name order, as a sorted list that nulls do not upset."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1.5e-6)
    return a == b


def test_every_query_is_checked():
    """All but some of the optional ones, whose results SQL cannot express."""
    optional = {n for n in registered.queries() if re.match(r"op\d+_|pipeline$", n)}
    assert set(registered.queries()) - optional == set(registered.oracle_sql()) - optional


@pytest.mark.parametrize("name", list(registered.oracle_sql()))
def test_matches_sql(name, spark, duck):
    df = registered.queries()[name](spark, SF_DIR)
    found = rows_of(df.columns, df.collect())
    result = duck.execute(registered.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    wanted = rows_of(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert len(found) == len(wanted) > 0
    for left, right in zip(found, wanted):
        assert all(map(same, left, right)), (left, right)


def test_entry_runs(spark):
    df = registered.entry(spark)
    assert df.columns == ["prompt", "response"]
    assert df.count() == 142


def test_the_rest_works_without_the_optional_queries():
    program = (
        "import sys; sys.modules['pairloom.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), set(e.queries()) == set(e.oracle_sql()))\n"
    )
    root = Path(registered.__file__).resolve().parent
    done = subprocess.run([sys.executable, "-c", program], cwd=root, capture_output=True, text=True, check=True)
    plain = [n for n in registered.queries() if not re.match(r"op\d+_|pipeline$", n)]
    assert done.stdout.split() == [str(len(plain)), "True"]
