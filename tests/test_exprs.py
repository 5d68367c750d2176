"""Scalar helpers: the source database's semantics, edge cases included."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from parcelkit.functions.exprs import (parse_mdy, pg_int, safe_num, safe_num_loss, string_agg_distinct, string_agg_ordered,
                                       years_before)


def test_safe_num_dirty_numbers(spark):
    cases = [("$1,234.50", Decimal("1234.5")), ("-5", Decimal("5")), ("1e5", Decimal("15")), ("1.2.3", None),
             (".", None), ("abc", None), ("", None), (None, None), ("  42 ", Decimal("42")),
             ("12345678901234567", Decimal("12345678901234567")), ("0.00005", Decimal("0.00005")),
             ("123456789012345678901", None), ("0.0000005", Decimal("0.000001"))]
    df = spark.createDataFrame([(c,) for c, _ in cases], "v string")
    got = [r[0] for r in df.select(safe_num("v")).collect()]
    assert [None if g is None else g.normalize() for g in got] == \
           [None if e is None else e.normalize() for _, e in cases]


def test_values_that_do_not_fit_are_marked(spark):
    cases = [("12345678901234567890", False), ("123456789012345678901", True), ("000000000000000000000000001", False),
             ("$0.1234560", False), ("0.1234561", True), ("1.2.3", False), ("abc", False), (".", False), (None, False)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "v string")
    assert [r[0] for r in df.select(safe_num_loss("v")).collect()] == [e for _, e in cases]


def test_parse_mdy(spark):
    df = spark.createDataFrame([("01/02/2023",), ("1/2/2024",), ("13/45/2020",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(parse_mdy("v")).collect()] == \
           [dt.date(2023, 1, 2), dt.date(2024, 1, 2), None, None, None]


def test_pg_int_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("2.5"),), (Decimal("3.4999"),), (Decimal("-2.5"),)], "v decimal(10,4)")
    assert [r[0] for r in df.select(pg_int("v")).collect()] == [3, 3, -3]


def test_years_before_leap_day(spark):
    assert spark.range(1).select(years_before("2024-02-29", 5)).first()[0] == dt.date(2019, 2, 28)


def test_string_aggs(spark):
    df = spark.createDataFrame([("a", "1", "z"), ("a", "2", "y"), ("a", "3", None), ("a", "1", "z"),
                                ("b", "1", None)], "k string, o string, v string")
    got = {r["k"]: (r["d"], r["o"]) for r in df.groupBy("k").agg(
        string_agg_distinct("v", ", ").alias("d"), string_agg_ordered("v", "o", "; ").alias("o")).collect()}
    assert got["a"] == ("y, z", "z; z; y")
    assert got["b"] == (None, None)


def test_concat_is_null_propagating(spark):
    assert spark.range(1).select(F.concat(F.lit("a"), F.lit(None).cast("string"))).first()[0] is None


def test_latest_date_text_or_chronological(spark):
    from parcelkit.operators.rollups import protest_history
    df = spark.createDataFrame([("1", "12/01/2020", "a"), ("1", "01/15/2024", "b"), ("1", "", "c")],
                               "acct string, protested_dt string, protested_by string")
    assert protest_history(df).first()["last_protest_date"] == "12/01/2020"          # text order (source)
    assert protest_history(df, chronological=True).first()["last_protest_date"] == "01/15/2024"


def test_text_numbers_order_like_texts(spark):
    from parcelkit.functions.exprs import number_text, text_number
    texts = ["", "0", "1999", "2000", "02/03/2001", "12/31/1999", "N/A", "Ünï", "ÿ", "~", "zzzzzzzzzzzzzz", "a", "a ", "ab", "\U0001F600", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text_number("t").alias("n"))
    rows = [(r.t, r.n, r.back) for r in df.select("*", number_text("n").alias("back")).collect()]
    assert all(t == back for t, _, back in rows)
    ranked = sorted((r for r in rows if r[0] is not None), key=lambda r: r[1])
    assert [r[0] for r in ranked] == sorted((t for t in texts if t is not None), key=lambda t: t.encode())
    assert [r[1] for r in rows if r[0] is None] == [None]


def test_hearings_and_priced_sales_are_hash_aggregates(spark):
    from parcelkit.operators.rollups import hearing_history, recent_sales_priced
    schema = "acct string, Tax_Year string, Actual_Hearing_Date string, Initial_Appraised_Value string, Final_Appraised_Value string"
    rows = [("1", "2000", "02/03/2000", "100.5", "90"), ("1", "2000", "12/01/1999", None, "95.25"), ("1", "1998", "x", "900", "800"),
            ("2", "1990", "01/01/1990", "5", "4"), ("3", "2001", None, "7", None), ("3", "N/A", "03/04/2001", "8", "9"), ("4", "1999", "", "0", "0"),
            ("5", "2001", "05/06/2001", "99999999999999999999", "1"), ("5", None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = {r.acct: r for r in hearing_history(df, "2001-12-31").collect()}
    assert set(got) == {"1", "3", "4", "5"}
    one = got["1"]
    assert (one.hearing_count, one.last_hearing_year, one.last_hearing_date) == (3, "2000", "x")
    assert (float(one.last_initial_appraised), float(one.last_final_appraised), one.successful_protests) == (100.5, 95.25, 2)
    # an account whose overall latest year is no year of the window has no latest values
    assert (got["3"].last_initial_appraised, got["3"].last_hearing_year, got["3"].hearing_count) == (None, "2001", 1)
    assert float(got["4"].last_initial_appraised) == 0 and got["5"].last_initial_appraised == 99999999999999999999
    deeds = spark.createDataFrame([("1", "01/02/2000", "5"), ("1", "03/04/2001", None), ("2", "03/04/2001", "7.5"), ("2", "03/04/2001", "0"),
                                   ("3", "3/4/2001", "0")], "acct string, dos string, sale_price string")
    sold = {r.acct: r.last_sale_price for r in recent_sales_priced(deeds, "2001-12-31").collect()}
    assert sold["1"] is None and float(sold["2"]) == 7.5 and float(sold["3"]) == 0
    for df in (hearing_history(df, "2001-12-31"), recent_sales_priced(deeds, "2001-12-31")):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()
