import pytest

from vitrine.runtime import session


@pytest.fixture(scope="session")
def spark():
    s = session("tests", 4, **{"spark.driver.memory": "3g", "spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()
