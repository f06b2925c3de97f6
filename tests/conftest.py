import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="quayside-test-")
    os.environ.setdefault("QUAYSIDE_LOCAL_CHECKPOINT_DIR", os.path.join(scratch, "ckpt"))
    from quayside.context import build_session
    s = build_session("local[4]", app="quayside-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": os.path.join(scratch, "wh")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="quayside-run-")
