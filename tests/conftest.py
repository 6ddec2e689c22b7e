import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lateline.session import LOCAL_JVM, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", 8, extra=LOCAL_JVM)
    yield s
