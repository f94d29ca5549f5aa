from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tillhouse.session import local_session  # noqa: E402

CLASHING = "n_words long, kept string, host string, verdict string, n_tokens long, _m string"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, over several partitions."""

    def build(rows, parts=3, extra=""):
        frame = spark.createDataFrame(list(rows), "doc_id long, text string" + (", " + extra if extra else ""))
        return frame.repartition(parts)

    return build
