"""Every registered query against its checking SQL on the small tables."""

import sys
from pathlib import Path

import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check_queries import compare, database  # noqa: E402

from assetlake.plans.catalog import CHECKS, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, SF)
    got = pd.DataFrame([tuple(r) for r in frame.collect()], columns=frame.columns)
    cursor = con.execute(CHECKS[name])
    expected = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description])
    assert compare(got, expected) == "ok"
