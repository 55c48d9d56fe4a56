import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from termflow.session import build_session
    s = build_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def docs_frame(spark, rows):
    """(doc_id, text) DataFrame from Python rows."""
    return spark.createDataFrame(rows, "doc_id string, text string")
