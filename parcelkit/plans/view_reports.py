"""Analytical queries over the views (feature statistics and protest targeting).

Street- and account-level reports pass their predicate into the view, so the
detail tables are restricted to the selected accounts before aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import asc, avg_round, desc, pg_int, street_match, years_before
from ..operators import rollups as R
from ..operators.percentile import grouped_percentile_cont
from ..session import ensure_checkpoint_dir
from . import views as V


def _street_pred(zip_code: str, street: str, suffix: str = "ST"):
    return street_match("site_addr_1", "str", street, "site_addr_3", zip_code, suffix)


def _protest_street(zip_code: str, street: str):
    """``zip_code = z AND (address ILIKE '%street%' OR street_name = street)`` on ``real_acct`` columns."""
    return (F.col("site_addr_3") == F.lit(zip_code)) & (F.col("site_addr_1").ilike(f"%{street}%")
                                                        | (F.col("str") == F.lit(street)))


def q_features_sample(tables, as_of, zip_code: str, street: str, limit: int = 50) -> DataFrame:
    """``property_features`` rows of one street, by street number."""
    pf = V.property_features(tables, as_of, where=_street_pred(zip_code, street))
    return pf.orderBy(asc("str_num"), asc("acct")).limit(limit)


def q_value_by_bedrooms(tables, as_of, zip_code: str, street: str) -> DataFrame:
    """Per bedroom count on one street: properties, average and exact median market value."""
    pf = V.property_features(tables, as_of, where=_street_pred(zip_code, street)).select("bedrooms", "tot_mkt_val_num")
    ensure_checkpoint_dir(pf.sparkSession)
    pf = pf.checkpoint()        # the view is evaluated once, for the averages and the medians
    agg = pf.groupBy("bedrooms").agg(F.count(F.lit(1)).alias("properties"),
                                      avg_round("tot_mkt_val_num", 0).alias("avg_market_value"))
    med = grouped_percentile_cont(pf, ["bedrooms"], "tot_mkt_val_num", 0.5, "median_market_value")
    return (agg.join(med, "bedrooms", "left")
            .select(pg_int("bedrooms").alias("bedrooms_int"), "properties", "avg_market_value", "median_market_value",
                    F.col("bedrooms").alias("_b"))
            .orderBy(asc("_b")).drop("_b").withColumnRenamed("bedrooms_int", "bedrooms"))


def q_value_by_quality(tables, as_of, zip_code: str, street: str) -> DataFrame:
    """Properties and average market value per building quality on one street."""
    pf = V.property_features(tables, as_of, where=_street_pred(zip_code, street))
    return (pf.groupBy("building_quality").agg(F.count(F.lit(1)).alias("properties"),
                                                avg_round("tot_mkt_val_num", 0).alias("avg_market_value"))
            .orderBy(desc("avg_market_value"), asc("building_quality")))


def q_value_by_pool(tables, as_of, zip_code: str, street: str) -> DataFrame:
    """Properties and average market value with and without a pool on one street."""
    pf = V.property_features(tables, as_of, where=_street_pred(zip_code, street))
    return (pf.groupBy("has_pool").agg(F.count(F.lit(1)).alias("properties"),
                                        avg_round("tot_mkt_val_num", 0).alias("avg_market_value"))
            .orderBy(desc("has_pool")))


def q_protest_profile(tables, as_of, acct: str) -> DataFrame:
    """The full protest-view row of one account."""
    return V.residential_protest_analysis(tables, as_of, where=F.col("acct") == F.lit(acct))


COMPS_COLUMNS = ("acct", "address", "neighborhood_name", "primary_year_built", "primary_heated_sqft", "bedrooms",
                 "full_baths", "primary_quality_code", "current_market_value", "market_value_per_sqft",
                 "last_sale_date", "last_sale_price", "total_protests", "successful_protests")


def q_comps(tables, as_of, neighborhood: str, sqft_lo=1800, sqft_hi=2200, year_lo=2000, year_hi=2010,
            bed_lo=3, bed_hi=4, target_sqft=2000) -> DataFrame:
    """Comparable residential properties in one neighbourhood from the protest view."""
    rpa = V.residential_protest_analysis(tables, as_of, where=F.col("Neighborhood_Code") == F.lit(neighborhood))
    sq = F.col("primary_heated_sqft")
    return (rpa.where(sq.between(sqft_lo, sqft_hi)
                      & F.col("primary_year_built").try_cast("int").between(year_lo, year_hi)
                      & F.col("bedrooms").between(bed_lo, bed_hi))
            .select(*COMPS_COLUMNS, F.abs(sq - F.lit(target_sqft)).alias("_d"))
            .orderBy(asc("_d"), asc("current_market_value"), asc("acct")).drop("_d"))


def q_success_in_neighborhood(tables, as_of, prefix: str) -> DataFrame:
    """Properties with at least one successful protest in neighbourhoods starting with ``prefix``."""
    # a prefix selects many accounts: the base table is filtered, the details are not semi-joined
    rpa = V.residential_protest_analysis(tables, as_of).where(F.col("neighborhood_code").like(f"{prefix}%"))
    return (rpa.where(F.col("successful_protests") > 0)
            .select("acct", "address", "current_market_value", "total_protests", "successful_protests",
                    "protest_success_rate", "avg_hearing_reduction", "last_hearing_reduction_pct")
            .orderBy(desc("protest_success_rate"), desc("successful_protests"), asc("acct")))


def q_over_assessment(tables, as_of, years: int = 2, pct: float = 20, price_col: str | None = None) -> DataFrame:
    """Recent sales whose market value rose more than ``pct`` % since the sale.

    Needs a deed price column (``price_col``); with the canonical deed file the
    price is NULL and the report is empty, as in the source.
    """
    sales = (lambda d: R.recent_sales_priced(d, as_of, 5, price_col)) if price_col else None
    rpa = V.residential_protest_analysis(tables, as_of, sales=sales)
    return (rpa.where((F.col("last_sale_date") >= years_before(as_of, years))
                      & (F.col("value_change_pct_since_sale") > pct))
            .select("acct", "address", "last_sale_date", "last_sale_price", "current_market_value",
                    "value_change_since_sale", "value_change_pct_since_sale", "market_value_per_sqft",
                    "primary_heated_sqft")
            .orderBy(desc("value_change_pct_since_sale"), asc("acct")))


def q_neighborhood_comparison(tables, as_of, prefix: str) -> DataFrame:
    """Per neighbourhood: size, averages, protests and protest success."""
    rpa = V.residential_protest_analysis(tables, as_of).where(F.col("neighborhood_code").like(f"{prefix}%"))
    return (rpa.groupBy("neighborhood_code", "neighborhood_name").agg(
        F.count(F.lit(1)).alias("property_count"),
        avg_round("current_market_value", 0).alias("avg_market_value"),
        avg_round("market_value_per_sqft", 2).alias("avg_value_per_sqft"),
        F.sum("total_protests").alias("total_neighborhood_protests"),
        avg_round(F.when(F.col("hearing_count") > 0, F.col("protest_success_rate")), 2).alias("avg_success_rate"),
        F.count_if(F.col("successful_protests") > 0).alias("properties_with_success"))
        .orderBy(desc("avg_success_rate"), desc("total_neighborhood_protests"), asc("neighborhood_code")))


def q_multi_building(tables, as_of) -> DataFrame:
    """Residential properties with more than one building."""
    rpa = V.residential_protest_analysis(tables, as_of)
    return (rpa.where(F.col("building_count") > 1)
            .select("acct", "address", "building_count", "primary_structure_type", "additional_buildings",
                    "total_heated_sqft", "current_market_value", "building_value", "building_value_per_sqft",
                    "total_protests", "last_hearing_reduction_pct")
            .orderBy(desc("building_count"), desc("current_market_value"), asc("acct")))


STREET_REPORT_COLUMNS = ("acct", "address", "owner_name", "current_market_value", "current_appraised_value",
                         "land_value", "building_value", "primary_year_built", "primary_heated_sqft", "bedrooms",
                         "full_baths", "primary_quality_desc", "market_value_per_sqft", "building_value_per_sqft",
                         "building_count", "additional_buildings", "has_pool", "total_protests",
                         "successful_protests", "protest_success_rate", "last_hearing_reduction_pct",
                         "last_sale_date", "sales_last_5yr", "has_homestead", "exemption_codes")


def q_street_protest_report(tables, as_of, zip_code: str, street: str) -> DataFrame:
    """Full protest report of one street, by street number."""
    rpa = V.residential_protest_analysis(tables, as_of, where=_protest_street(zip_code, street))
    return (rpa.select(*STREET_REPORT_COLUMNS, "street_number")
            .orderBy(asc("street_number"), asc("acct")).drop("street_number"))


def q_street_multi_building(tables, as_of, zip_code: str, street: str) -> DataFrame:
    """Multi-building properties of one street."""
    rpa = V.residential_protest_analysis(tables, as_of, where=_protest_street(zip_code, street))
    return (rpa.where(F.col("building_count") > 1)
            .select("acct", "address", "building_count", "primary_structure_type", "additional_buildings",
                    "total_heated_sqft", "current_market_value", "market_value_per_sqft")
            .orderBy(desc("building_count"), asc("acct")))


def q_street_protest_success(tables, as_of, zip_code: str, street: str) -> DataFrame:
    """One-row protest success summary of a street."""
    rpa = V.residential_protest_analysis(tables, as_of, where=_protest_street(zip_code, street))
    return rpa.agg(
        F.count(F.lit(1)).alias("total_properties"),
        F.count_if(F.col("total_protests") > 0).alias("properties_with_protests"),
        F.sum("total_protests").alias("total_protest_count"),
        F.sum("successful_protests").alias("total_successful"),
        avg_round(F.when(F.col("hearing_count") > 0, F.col("protest_success_rate")), 2).alias("avg_success_rate"),
        avg_round("last_hearing_reduction_pct", 2).alias("avg_reduction_pct"),
        F.min("current_market_value").alias("min_value"),
        F.max("current_market_value").alias("max_value"),
        avg_round("current_market_value", 0).alias("avg_value"),
        avg_round("market_value_per_sqft", 2).alias("avg_per_sqft"))


def decade_bucket(year_text):
    """Decade label of a year-built text; unparseable / missing years fall into ``'2010+'`` as in the source."""
    y = F.col(year_text).try_cast("int") if isinstance(year_text, str) else year_text
    return (F.when(y < 1980, "Pre-1980").when(y.between(1980, 1989), "1980s").when(y.between(1990, 1999), "1990s")
            .when(y.between(2000, 2009), "2000s").otherwise("2010+"))


def q_value_by_decade(tables, as_of, zip_code: str, street: str) -> DataFrame:
    """Count, average value, $/sqft and size per decade built on one street."""
    rpa = V.residential_protest_analysis(tables, as_of, where=_protest_street(zip_code, street))
    return (rpa.groupBy(decade_bucket("primary_year_built").alias("decade")).agg(
        F.count(F.lit(1)).alias("property_count"),
        avg_round("current_market_value", 0).alias("avg_value"),
        avg_round("market_value_per_sqft", 2).alias("avg_per_sqft"),
        avg_round("primary_heated_sqft", 0).alias("avg_sqft"))
        .orderBy(asc("decade")))


def q_homestead_analysis(tables, as_of, zip_code: str, street: str) -> DataFrame:
    """By homestead flag on one street: count, average value, properties with protests."""
    rpa = V.residential_protest_analysis(tables, as_of, where=_protest_street(zip_code, street))
    return rpa.groupBy("has_homestead").agg(
        F.count(F.lit(1)).alias("property_count"),
        avg_round("current_market_value", 0).alias("avg_value"),
        F.count_if(F.col("total_protests") > 0).alias("with_protests"))
