import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ratewise.session import checkpoint_dir, local_session
    s = local_session(4, shuffle_partitions=4, app="ratewise-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
