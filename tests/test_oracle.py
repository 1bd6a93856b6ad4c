"""Every registered query of the library against its SQL."""

import compare
import pytest

from curbline.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(n for n, q in registry.QUERIES.items() if q.sql))
def test_matches_sql(spark, duck, name):
    q = registry.QUERIES[name]
    assert compare.differences(q.run(spark, SF), duck, q.sql) == ""
