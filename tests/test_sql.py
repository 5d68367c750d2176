import pytest

from parcelkit.plans.sql import sql_select


def test_sql_select_guards(spark):
    assert sql_select(spark, "select 1 as x").first()["x"] == 1
    assert sql_select(spark, "SELECT :a AS x", {"a": 5}).first()["x"] == 5
    with pytest.raises(ValueError):
        sql_select(spark, "drop table t")
    with pytest.raises(ValueError):
        sql_select(spark, "select 1; select 2")
