import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quiver.session import local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="quiver-tests")
    yield s


def vec_df(spark, rows):
    """rows: list of (symbol, list[float])"""
    return spark.createDataFrame([(s, [float(x) for x in v]) for s, v in rows], "symbol string, v array<double>")


def greedy_reference(rows, t1):
    """Plain sequential greedy canopy in symbol order (the definition)."""
    import numpy as np

    centres, out = [], {}
    for sym, v in sorted(rows):
        x = np.asarray(v, dtype=float)
        hit = None
        for cs, cv in centres:
            if np.cumsum(np.abs(cv - x))[-1] / len(x) < t1:
                hit = cs
                break
        if hit is None:
            centres.append((sym, x))
            hit = sym
        out[sym] = hit
    return out
