import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from voltframe.session import build_session

    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="voltframe-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def connect(sf_dir):
        con = duckdb.connect()
        for t in ("events", "orders", "labels", "documents"):
            p = os.path.join(sf_dir, f"{t}.parquet")
            if os.path.exists(p):
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
        return con

    return connect
