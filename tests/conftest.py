import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tableworks.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tw-test-", dir="/tmp")
    session = local_session("*", 8, warehouse_dir=os.path.join(scratch, "warehouse"), driver_memory="4g")
    if not session.sparkContext.getCheckpointDir():  # spark.checkpoint.dir, where it is set
        session.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield session
    session.stop()


@pytest.fixture()
def fresh(request):
    """A table name unique to the test."""
    import uuid

    return lambda tag="t": f"t_{tag}_{uuid.uuid4().hex[:10]}"
