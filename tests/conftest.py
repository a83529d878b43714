import pytest

from lexstat.session import get_spark


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    s = get_spark("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g", "spark.checkpoint.dir": f"file://{shared}"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
