import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import local_session, ship_package

    session = local_session(8, "6g")
    ship_package(session)
    return session


@pytest.fixture(scope="session")
def tables(spark):
    from tillroll.plans.tables import Tables

    return Tables.of(spark, "/root/testdata/sf0.001")
