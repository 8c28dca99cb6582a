import os
import sys

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import llm_fixtures as fx  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return fx.awkward_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, fx.SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], fx.SCHEMA)


@pytest.fixture
def same_as_sql():
    def check(result, sql, **tables):
        con = duckdb.connect()
        for name, (data, columns) in tables.items():
            con.register(f"t_{name}", pd.DataFrame(data, columns=columns, dtype=object))
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM t_{name}")
        done = con.execute(sql)
        columns = [c[0] for c in done.description]
        names = sorted(columns)
        assert sorted(result.columns) == names
        want = [tuple(str(r[columns.index(n)]) for n in names) for r in done.fetchall()]
        assert sorted(tuple(str(r[n]) for n in names) for r in result.collect()) == sorted(want)
    return check
