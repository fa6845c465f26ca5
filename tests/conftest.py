import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from tramline.session import session

    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tiny():
    path = DATA / "sf0.001"
    if not path.exists():
        pytest.skip("no test tables")
    return str(path)
