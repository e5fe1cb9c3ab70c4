import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import session

    spark = session("tests", master="local[4]", partitions=4, memory="4g")
    yield spark
    spark.stop()
