"""Every registered query against its SQL, value by value, and what its plan must not hold."""

import oracle
import pytest

from tillmark.plans.catalog import QUERIES
from tillmark.plans.oracles import ORACLES


UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    text = oracle.plan(frame)
    assert not [node for node in UNWANTED if node in text]
    assert oracle.differences(frame, duck, ORACLES[name]) == []
