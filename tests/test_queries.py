import pytest

from inkwell.plans import catalog
from tests.compare import SMALL, oracle, rows

SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_oracle(spark, name):
    assert rows(catalog.queries()[name](spark, str(SMALL))) == oracle(SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL)))
def test_query_without_oracle_has_rows(spark, name):
    assert catalog.queries()[name](spark, str(SMALL)).count() > 0


@pytest.mark.parametrize("name", ["split_exact_assignment", "split_writer_held_out", "image_degrade_noise"])
def test_result_does_not_depend_on_partitions(spark, name):
    want = rows(catalog.queries()[name](spark, str(SMALL)))
    try:
        for n in (1, 7):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            assert rows(catalog.queries()[name](spark, str(SMALL))) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
