"""Each registered query of the package gives what its SQL gives."""

import pytest
from conftest import SF, same

from lexmill.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    if name in catalog.ORACLES:
        same(df, duck.execute(catalog.ORACLES[name]))
    else:
        assert df.count() > 0
