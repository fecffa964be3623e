import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

from millrace.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(4, 4, **{"spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": str(shared / "warehouse")})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def rows(frame) -> list[str]:
    """Rows of a pandas frame with columns in order of name, as sorted text."""
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(map(repr, frame.itertuples(index=False, name=None)))
