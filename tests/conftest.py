import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from siftlake.session import build_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"
NOW = "2024-02-01T00:00:00Z"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """raw(rows): raw events from (event_id, source, payload) rows, in arrival order."""
    def build(rows, start=1_706_000_000):
        data = [
            (i, r[0], r[1], r[2], start + (r[3] if len(r) > 3 else i)) for i, r in enumerate(rows)
        ]
        df = spark.createDataFrame(data, "seq bigint, event_id string, source string, payload string, at bigint")
        return df.selectExpr("seq", "event_id", "source", "payload", "timestamp_seconds(at) AS received_at")

    return build
