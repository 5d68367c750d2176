"""View properties and plan shape on the sf0.001 tables."""
from pyspark.sql import functions as F

import __spark_entry__ as E
from parcelkit.catalog import RESIDENTIAL_CLASSES
from parcelkit.fixtures import AS_OF
from parcelkit.plans import views as V

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_row_per_account_no_fanout(spark):
    t = E._tables(spark, SF)
    n = t["real_acct"].count()
    pf = V.property_features_v2(t, AS_OF)
    assert pf.count() == n and pf.select("acct").distinct().count() == n
    rpa = V.residential_protest_analysis(t, AS_OF)
    base = t["real_acct"].where(F.col("state_class").isin(*RESIDENTIAL_CLASSES)).count()
    assert rpa.count() == base and rpa.select("acct").distinct().count() == base
    assert len(rpa.columns) == 72


def test_valid_ranges(spark):
    pf = V.property_features_v2(E._tables(spark, SF), AS_OF)
    bad = pf.where(~F.col("bedrooms_valid").between(1, 8) | ~F.col("full_baths_valid").between(0, 6)
                   | ~F.col("half_baths_valid").between(0, 4))
    assert bad.count() == 0
    # no fixtures -> bedrooms 0 -> anomaly TRUE but valid NULL
    zero = pf.where(F.col("bedrooms") == 0).select("bedrooms_anomaly", "bedrooms_valid").distinct().collect()
    assert all(r[0] is True and r[1] is None for r in zero)


def test_street_restriction_equals_filter(spark):
    t = E._tables(spark, SF)
    pred = (F.col("site_addr_3") == "77007") & (F.col("str") == "URGENT")
    full = V.residential_protest_analysis(t, AS_OF).where((F.col("zip_code") == "77007")
                                                           & (F.col("street_name") == "URGENT"))
    restricted = V.residential_protest_analysis(t, AS_OF, where=pred)
    cols = sorted(full.columns)
    assert sorted(map(tuple, full.select(cols).collect())) == sorted(map(tuple, restricted.select(cols).collect()))


def test_views_stay_in_the_jvm(spark):
    t = E._tables(spark, SF)
    for df in (V.property_features_v2(t, AS_OF), V.residential_protest_analysis(t, AS_OF)):
        plan = _plan(df)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan
