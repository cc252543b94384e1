"""Every query that has SQL, compared with it on the smallest tables."""

import pytest
from check_queries import connect, difference

import __spark_entry__ as entry
from tillroll.plans.oracles import ORACLES
from tillroll.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"



@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, db, name):
    rows, problem = difference(spark, db, QUERIES[name], ORACLES.get(name), FOLDER)
    assert problem is None
    assert rows > 0 or name in ("rules_for_target", "basket_pairs")


def test_only_fits_lack_sql():
    fits = {"kmeans_segments", "elbow_curve", "bgnbd_fit", "gammagamma_fit", "customer_360"}
    assert set(QUERIES) - set(ORACLES) == fits and set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
