import pytest

from murmur.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "murmur-tests",
        master="local[8]",
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from murmur.sources.tables import TableStore

    return TableStore(spark, str(tmp_path / "store"))
