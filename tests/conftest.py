import pytest

from checks.compare import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A zone other than UTC, so that nothing can depend on the session's zone unnoticed.
    session = local_session(
        8,
        **{
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.session.timeZone": "America/New_York",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def shared(spark):
    """A fresh folder below the shared one."""
    from rolecall.sources import shared_dir

    return shared_dir(spark)
