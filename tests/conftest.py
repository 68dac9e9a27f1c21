import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skytally import checkpoint_root, make_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = make_session(8, shuffle_partitions=8, app="skytally-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # sets a local checkpoint folder, as the session has none
    yield s
    s.stop()


def write_files(folder, files: dict[str, str]) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(text)
    return str(folder)
