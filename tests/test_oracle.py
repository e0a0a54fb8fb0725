"""Every registered query with oracle SQL gives the same rows on the smallest tables; the others run."""

import os

import pytest

from tests.check import compare
from tremorlake.queries import ORACLES, QUERIES, load_all

load_all()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, name):
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    ok, message = compare(spark, folder, name)
    assert ok, message


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(ORACLES) > 170


@pytest.mark.parametrize("name", ["moran_global_knn_runs", "moran_permutation_p", "interp_nearest_runs"])
def test_every_run_is_read(spark, folder, name):
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    assert {r["run_id"] for r in QUERIES[name](spark, folder).collect()} == {"run_0", "run_1"}
