"""Every registered query of the reference's operators against its SQL."""

import os

import pytest

from strandloom.plans import catalog

from .compare import of_spark, of_sql

SF = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, name):
    found = of_spark(catalog.QUERIES[name](spark, SF))
    assert found[1], "a query over the test tables has rows"
    if name in catalog.ORACLES:
        assert found == of_sql(catalog.ORACLES[name], SF)
