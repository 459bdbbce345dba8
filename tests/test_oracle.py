import os

import pytest

from gantry.plans import catalog
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_duckdb(spark, name):
    compare(spark, catalog.QUERIES[name], catalog.ORACLES[name], SF)
