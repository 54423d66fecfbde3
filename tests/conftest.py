from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from treatment_lake.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))})
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from treatment_lake.session import scratch_path

    def make(name: str = "t") -> str:
        return scratch_path(spark, name)
    return make


def rows(df, *cols):
    """Sorted list of tuples (all columns, or the named ones)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
