import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # The session's spark.checkpoint.dir is used when configured; only when
    # it is unset does get_session give the local test session a folder.
    s = get_session("local[4]", 8, app_name="tidewater-tests")
    yield s


def rows(df, *cols):
    """Sorted list of tuples for order-insensitive comparison."""
    cols = cols or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
