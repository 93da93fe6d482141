from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from hemotab.session import build_session

    warehouse = tempfile.mkdtemp(prefix="hemotab-warehouse-", dir="/tmp")
    s = build_session("local[*]", 8, app_name="hemotab-tests",
                      extra_conf={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_tables(spark):
    from hemotab.sources.fixtures import fixture_tables

    return fixture_tables(spark, SF_SMALL)


@pytest.fixture(scope="session")
def check_tables(spark):
    from hemotab.sources.fixtures import fixture_tables

    return fixture_tables(spark, SF_CHECK)
