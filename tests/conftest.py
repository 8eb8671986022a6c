import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from assayloom.session import get_session

    s = get_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def save(tmp_path):
    """Write frames as the Parquet tables of a test directory; gives the directory."""

    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
