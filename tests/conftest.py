import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daybook.operators.catalog import create_database  # noqa: E402
from daybook.session import build_session, shared_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="daybook-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def db(spark):
    """A fresh database under the shared checkpoint folder."""
    name = f"t_{uuid.uuid4().hex[:12]}"
    create_database(spark, name, location=shared_dir(spark, name))
    return name


@pytest.fixture
def scratch(spark):
    return lambda tag="x": shared_dir(spark, tag)
