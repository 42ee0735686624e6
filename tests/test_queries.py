import pytest
from oracle import assert_same

from tessera.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    assert_same(spark, QUERIES[name], SQL[name], "/root/testdata/sf0.001")


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
