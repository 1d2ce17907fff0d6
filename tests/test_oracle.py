"""Every query of the library against its SQL, and those without SQL for rows."""

import pytest
from compare import duck_rows, spark_rows

from corpusloom import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    columns, rows = spark_rows(queries.QUERIES[name](spark, SF))
    if name in queries.ORACLES:
        assert (columns, rows) == duck_rows(queries.ORACLES[name], SF)
    else:
        assert columns and rows


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
