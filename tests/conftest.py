import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

from minespark.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("tests", cpus=4, shuffle_partitions=4, shared=tmp_path_factory.mktemp("shared").as_uri())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
