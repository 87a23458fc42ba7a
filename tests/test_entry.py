import os

import pytest

DATA = "/root/testdata/sf0.001"


def test_registration():
    import __spark_entry__ as e

    queries, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 100


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_flagship(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
