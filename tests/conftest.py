import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortalloc.session import build_session, configured_checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="cohortalloc-warehouse-")
    session = build_session(
        app="cohortalloc-tests", master="local[*]", shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": warehouse},
    )
    if not configured_checkpoint_dir(session):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortalloc-ckpt-"))
    yield session


@pytest.fixture(scope="session")
def alloc(spark):
    from cohortalloc.plans.catalog import allocation

    return allocation(spark, SF_SMALL)
