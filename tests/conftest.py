from datetime import datetime, timedelta, timezone

import pytest

from kerbflow.session import build_session

T0 = datetime(2027, 3, 1, 4, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", 2, spark__ui__enabled="false", spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def observations(spark):
    """Rows of (station, minute, bikes, docks, status) as observations."""
    def make(rows):
        data = [(uid, (T0 + timedelta(minutes=m)).replace(tzinfo=timezone.utc), b, d, s) for uid, m, b, d, s in rows]
        return spark.createDataFrame(
            data, "station_uid string, source_updated_at timestamp, bikes_available int, docks_available int, service_status int")
    return make
