import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from turnloom.session import get_session  # noqa: E402

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01")}


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", shuffle_partitions=4)
    yield s


def dialogue(spark, entries, conv="c"):
    """Turn rows from compact notation: ('U', text) user, ('C', text) model, other senders unknown."""
    rows = [(conv, i, s, t) for i, (s, t) in enumerate(entries)]
    return spark.createDataFrame(rows, "conv_id string, turn long, sender string, text string")
