import pytest
from duck import same

from inkwell.catalogue_of_queries import oracle_sql, queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_sql(spark, sf, name):
    same(spark, sf, queries()[name], oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_runs(spark, sf, name):
    assert queries()[name](spark, sf).count() > 0
