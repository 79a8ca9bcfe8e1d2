import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]


@pytest.fixture(scope="session")
def spark():
    from kestrel.session import checkpoint_dir, clear_scratch, get_session

    s = get_session("local[4]", app="kestrel-tests", shuffle_partitions=4,
                    conf={"spark.ui.showConsoleProgress": "false",
                          "spark.sql.session.timeZone": "UTC"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # sets a temp checkpoint folder only when none is configured
    yield s
    clear_scratch(s)
