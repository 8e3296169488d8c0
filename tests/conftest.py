import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from viewer_insights.session import checkpoint_dir, drop_scratch, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="viewer-insights-tests")
    checkpoint_dir(s)
    yield s
    drop_scratch(s)
    s.stop()
