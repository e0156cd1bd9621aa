import pytest

from docweft.session import get_spark


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests", master="local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    yield session
    session.stop()
