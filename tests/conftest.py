import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    from telarium.session import get_spark

    s = get_spark("tests", cpus=4, **{"spark.driver.memory": "3g", "spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()
