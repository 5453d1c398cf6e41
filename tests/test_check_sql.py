"""Every registered query with check SQL gives the same rows in both engines."""

import __spark_entry__ as entry
import pytest

from dielens.plans.oracles import all_queries
from dielens.plans.queries import registered
from tests.compare import connect, differences
from tests.conftest import SF_SMALL

ORACLES = entry.oracle_sql()


def test_every_check_has_its_query():
    assert set(ORACLES) <= set(entry.queries())
    assert len(registered()) == 80 and len(all_queries()) == 62


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal(spark, name):
    rows = entry.queries()[name](spark, SF_SMALL).toPandas()
    assert len(rows) > 0
    assert differences(rows, connect(SF_SMALL).execute(ORACLES[name]).fetchdf()) == []
    spark.catalog.clearCache()


def test_entry(spark):
    assert entry.entry(spark).count() == 48


@pytest.mark.parametrize(
    "table, rows", [("raw", 6000), ("binned", 5615), ("clean", 5529)]
)
def test_anchors(spark, table, rows):
    from dielens.plans import queries
    from dielens.plans.dies import die_table

    frame = {"raw": die_table, "binned": queries.binned, "clean": queries.cleaned}[table](spark, SF_SMALL)
    assert frame.count() == rows
