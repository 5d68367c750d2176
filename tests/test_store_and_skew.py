"""Bucketed store plans without shuffles; rollups stay exact when one account holds a third of the rows."""
import os
from decimal import Decimal

from pyspark.sql import functions as F

import __spark_entry__ as E
from parcelkit.fixtures import AS_OF
from parcelkit.operators import integrity as I
from parcelkit.operators import rollups as R
from parcelkit.plans import views as V
from parcelkit.plans.store import TableStore

SF = "/root/testdata/sf0.001"
NAMES = ["real_acct", "building_res", "fixtures", "extra_features", "arb_protest_real", "arb_hearings_real", "deeds",
         "jur_exempt", "land", "desc_r_01_state_class", "desc_r_15_land_usecode", "desc_r_20_school_district",
         "real_neighborhood_code"]


def test_flagship_over_bucketed_store_has_no_shuffle(spark, tmpdir_path):
    t = E._tables(spark, SF)
    store = TableStore(spark, os.path.join(tmpdir_path, "store"), "pk_test_store", 4)
    for n in NAMES:
        store.write(n, t[n])
    # a second application re-attaches the written tables with their bucket spec
    again = TableStore(spark, os.path.join(tmpdir_path, "store"), "pk_test_store2", 4)
    for n in NAMES:
        again.attach(n)
    for st in (store, again):
        df = V.residential_protest_analysis(st, AS_OF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan
        cols = sorted(df.columns)
        ref = V.residential_protest_analysis(t, AS_OF)
        assert sorted(map(tuple, df.select(cols).collect())) == sorted(map(tuple, ref.select(cols).collect()))


def _hot_buildings(spark):
    rows = [("HOT", str(i), f"{i % 7 * 100}.00", "Class A") for i in range(1, 3001)]
    rows += [(f"A{i % 2000:05d}", str(i // 2000 + 1), f"{i % 5 * 10}", None) for i in range(6000)]
    cols = "acct string, bld_num string, heat_ar string, structure_dscr string"
    df = spark.createDataFrame(rows, cols).withColumns(
        {c: F.lit(None).cast("string") for c in ("date_erected", "yr_remodel", "qa_cd", "dscr", "gross_ar", "eff_ar",
                                                  "im_sq_ft", "cama_replacement_cost", "accrued_depr_pct")})
    return rows, df.repartition(12)


def test_building_summary_with_hot_account(spark):
    rows, df = _hot_buildings(spark)
    got = {r["acct"]: r for r in R.building_summary(df).collect()}
    hot = got["HOT"]
    assert hot["building_count"] == 3000
    assert hot["total_heated_sqft"] == sum(Decimal(h) for a, _, h, _ in rows if a == "HOT")
    texts = hot["additional_buildings"].split("; ")
    assert len(texts) == 2999 and texts[0] == "Bldg 10: Class A (300.00 sqft)"   # text order of bld_num
    assert texts == sorted(texts, key=lambda s: s.split(":")[0][5:])
    assert got["A00001"]["building_count"] == 3 and got["A00001"]["additional_buildings"].count("Unknown") == 2


def test_building_summary_reads_its_table_once(spark, tmpdir_path):
    rows, df = _hot_buildings(spark)
    none = [(None, "1", "5", "B"), (None, "2", "5", "B"), ("N", None, "5", "B"), ("D", "2", "5", "B"), ("D", "2", "6", "B"), ("D", "1", "7", "B")]
    more = spark.createDataFrame(none, "acct string, bld_num string, heat_ar string, structure_dscr string")
    df.unionByName(more, allowMissingColumns=True).write.parquet(f"{tmpdir_path}/b")
    out = R.building_summary(spark.read.parquet(f"{tmpdir_path}/b"))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {r["acct"]: r["building_count"] for r in out.collect()}
    assert (got[None], got["N"], got["D"], got["HOT"], got["A00001"]) == (0, 0, 2, 3000, 3)


def test_keep_first_and_hearings_with_hot_key(spark):
    dup = spark.createDataFrame([("K", f"{i:05d}", f"v{i}") for i in range(3000)] +
                                [(f"k{i}", "00000", "w") for i in range(6000)], "acct string, ord string, v string")
    got = {r["acct"]: r["v"] for r in I.dedupe_keep_first(dup.repartition(12), ["acct"], order_cols=["ord"]).collect()}
    assert got["K"] == "v0" and len(got) == 6001
    hearings = spark.createDataFrame(
        [("H", str(1995 + i % 8), f"{i % 28 + 1:02d}/01/2000", str(1000 + i), str(900 + i)) for i in range(3000)],
        "acct string, Tax_Year string, Actual_Hearing_Date string, Initial_Appraised_Value string, "
        "Final_Appraised_Value string").withColumn("Real_Personal_Property", F.lit("R"))
    r = R.hearing_history(hearings.repartition(12), "2001-12-31").first()
    window = [i for i in range(3000) if 1995 + i % 8 >= 1996]
    assert r["hearing_count"] == len(window) and r["last_hearing_year"] == "2002"
    assert r["last_initial_appraised"] == max(1000 + i for i in window if 1995 + i % 8 == 2002)
    assert r["successful_protests"] == len(window)


def test_layout_is_explicit_and_attach_uses_the_written_count(spark, tmpdir_path):
    rows = [("HOT", str(i)) for i in range(3000)] + [(f"A{i:05d}", "1") for i in range(6000)]
    skewed = spark.createDataFrame(rows, "acct string, bld_num string")
    even = spark.createDataFrame([(f"A{i:05d}", "1") for i in range(9000)], "acct string, bld_num string")
    store = TableStore(spark, os.path.join(tmpdir_path, "s"), "pk_skew", 16)
    assert store.bucket_share(skewed) > 4 > store.bucket_share(even)
    store.write("skewed", skewed, bucketed=False)
    store.write("even", even)
    store.write("few", even.limit(5))
    again = TableStore(spark, os.path.join(tmpdir_path, "s"), "pk_skew2", 8)     # another count than the written one
    for n in ("skewed", "even", "few"):
        again.attach(n)
    grouped = lambda n: again[n].groupBy("acct").count()
    scan = lambda n: grouped(n)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in scan("even") and "Bucketed: true" in scan("few") and "Bucketed: true" not in scan("skewed")
    assert again["skewed"].count() == 9000
    assert grouped("even").count() == 9000 and again["even"].alias("a").join(again["even"].alias("b"), "acct").count() == 9000
    assert grouped("few").count() == 5
