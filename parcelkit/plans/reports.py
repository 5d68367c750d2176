"""Analytical queries over the base tables (property search, comps, ownership,
exemptions, neighbourhood / market statistics, sales, protests, permits, streets).

Each is ``fn(tables, **params) -> DataFrame``. Where the source query named a
column the yearly files do not have, the evident intent is implemented (noted
per function). Aggregating reports aggregate the account table *before* joining
code lookups (pre-aggregation: the join sees one row per group, not per account).
Sorted reports sort with the source database's NULL placement and break ties by
key so that limits are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (asc, avg_round, desc, parse_mdy, safe_num, street_match,
                               string_agg_distinct, years_before)
from ..operators.percentile import grouped_percentile_cont
from ..operators.rollups import PRIMARY


def _col_or_null(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _primary_building(tables, *cols) -> DataFrame:
    return tables["building_res"].where(F.col("bld_num") == F.lit(PRIMARY)).select("acct", *cols)


def _lookup(dim: DataFrame, key: str, as_key: str, value: str, as_value: str) -> DataFrame:
    return dim.select(F.col(key).alias(as_key), F.col(value).alias(as_value))


def q_property_profile(tables, acct: str) -> DataFrame:
    """Basics of one account with the address concatenated."""
    ra = tables["real_acct"]
    return ra.where(F.col("acct") == F.lit(acct)).select(
        "acct", F.col("mailto").alias("owner_name"),
        F.concat(F.col("site_addr_1"), F.lit(" "), F.coalesce(F.col("site_addr_2"), F.lit(""))).alias("site_address"),
        "state_class", F.col("tot_mkt_val").alias("market_value"), F.col("tot_appr_val").alias("appraised_value"),
        "land_val", F.col("bld_val").alias("building_value"), "school_dist", "Neighborhood_Code")


def q_address_search(tables, pattern: str) -> DataFrame:
    """Accounts whose site address contains ``pattern`` (case-insensitive), by address."""
    ra = tables["real_acct"]
    return (ra.where(F.col("site_addr_1").ilike(f"%{pattern}%"))
            .select("acct", F.col("mailto").alias("owner"), "site_addr_1", "site_addr_2", "site_addr_3", "tot_mkt_val")
            .orderBy(asc("site_addr_1"), asc("acct")))


def q_comps_base(tables, neighborhood: str, sqft_lo=1800, sqft_hi=2200, year_lo=2000, year_hi=2010,
                 bed_lo=3, bed_hi=4, target_sqft=2000, bed_type="RMB", bath_type="RMF") -> DataFrame:
    """Comparable properties in a neighbourhood by heated area, year built and bedrooms.

    Primary building and its bedroom / bath fixture rows are left-joined with
    the constants applied to the right side first; accounts without a
    matching bedroom row drop out through the WHERE, as in the source. The
    year built is ``date_erected`` and fixture counts ``units`` (the source
    named absent columns). Fixture rows must be key-unique (cleaned).
    """
    ra = tables["real_acct"].where(F.col("Neighborhood_Code") == F.lit(neighborhood))
    br = _primary_building(tables, "date_erected", "heat_ar")
    fx = tables["fixtures"].where(F.col("bld_num") == F.lit(PRIMARY))
    bed = fx.where(F.col("type") == F.lit(bed_type)).select("acct", F.col("units").alias("bedrooms"))
    bath = fx.where(F.col("type") == F.lit(bath_type)).select("acct", F.col("units").alias("bathrooms"))
    heat = safe_num("heat_ar")
    j = (ra.join(br, "acct", "left").join(bed, "acct", "left").join(bath, "acct", "left")
         .where(heat.between(sqft_lo, sqft_hi)
                & F.col("date_erected").try_cast("int").between(year_lo, year_hi)
                & safe_num("bedrooms").between(bed_lo, bed_hi)))
    return (j.select("acct", "site_addr_1", F.col("Neighborhood_Code").alias("neighborhood_code"),
                     F.col("date_erected").alias("year_built"), F.col("heat_ar").alias("living_sqft"),
                     "bedrooms", "bathrooms", safe_num("land_ar").alias("lot_sqft"),
                     F.col("tot_mkt_val").alias("market_value"), F.col("tot_appr_val").alias("appraised_value"),
                     F.abs(heat - F.lit(target_sqft)).alias("_d"))
            .orderBy(asc("_d"), asc("market_value"), asc("acct")).drop("_d"))


def q_property_detail(tables, acct: str) -> DataFrame:
    """One property with primary building, building type and quality text, fixture list and land use.

    Building type joins on ``impr_tp``; land area is the account's
    ``land_ar`` and land units the land line's ``uts`` (names fixed from the source).
    """
    ra = tables["real_acct"].where(F.col("acct") == F.lit(acct))
    br = (_primary_building(tables, "bld_num", "date_erected", "yr_remodel", "gross_ar", "heat_ar", "impr_tp", "qa_cd")
          .join(_lookup(tables["desc_r_02_building_type_code"], "Type", "impr_tp", "Description", "building_type"),
                "impr_tp", "left")
          .join(_lookup(tables["desc_r_07_quality_code"], "Code", "qa_cd", "Description", "quality"), "qa_cd", "left"))
    fx = (tables["fixtures"].where(F.col("bld_num") == F.lit(PRIMARY))
          .groupBy("acct").agg(string_agg_distinct(F.concat(F.col("type"), F.lit(": "), F.col("units")), ", ")
                               .alias("fixtures")))
    land = (tables["land"].where(F.col("num") == F.lit(PRIMARY)).select("acct", "use_cd", F.col("uts").alias("land_units"))
            .join(_lookup(tables["desc_r_15_land_usecode"], "Code", "use_cd", "Description", "land_use"),
                  "use_cd", "left"))
    j = ra.join(br, "acct", "left").join(fx, "acct", "left").join(land, "acct", "left")
    return j.select("acct", F.col("mailto").alias("owner"), "site_addr_1", "bld_num",
                    F.col("date_erected").alias("yr_blt"), "yr_remodel", F.col("gross_ar").alias("building_area"),
                    F.col("heat_ar").alias("heated_area"), "building_type", "quality", "fixtures",
                    F.col("land_ar").alias("land_area"), "land_units", "land_use", "land_val", "bld_val", "tot_mkt_val")


def q_ownership_history(tables, acct: str) -> DataFrame:
    """Owners of an account, newest purchase first (by parsed date)."""
    oh = tables["ownership_history"]
    return (oh.where(F.col("acct") == F.lit(acct))
            .select("acct", F.col("name").alias("owner_name"), F.col("purchase_date").alias("deed_date"),
                    "site_address")
            .orderBy(desc(parse_mdy("deed_date")), asc("owner_name")))


def q_current_owners(tables, acct: str) -> DataFrame:
    """Current owners of an account with ownership percentages, by line number."""
    o = tables["owners"].where(F.col("acct") == F.lit(acct))
    ra = tables["real_acct"].select("acct", "site_addr_1")
    return (o.join(ra, "acct", "inner")
            .select("acct", "site_addr_1", F.col("name").alias("owner_name"), F.col("pct_own").alias("ownership_percent"),
                    _col_or_null(o, "aka").alias("owner_type"), "ln_num")
            .orderBy(asc("ln_num")).drop("ln_num"))


def q_exemptions_by_jurisdiction(tables, acct: str) -> DataFrame:
    """Exemptions of an account with jurisdiction name and exemption description."""
    je = tables["jur_exempt"].where(F.col("acct") == F.lit(acct))
    ra = tables["real_acct"].select("acct", "mailto", "site_addr_1")
    j = (je.join(ra, "acct", "inner")
         .join(_lookup(tables["desc_r_12_real_jurisdictions"], "Code", "tax_district", "Description", "jurisdiction"),
               "tax_district", "left")
         .join(tables["jur_exemption_dscr"].select("exempt_cat", F.col("exemption_dscr").alias("exemption_description")),
               "exempt_cat", "left"))
    return (j.select("acct", F.col("mailto").alias("owner"), "site_addr_1", "jurisdiction", "exempt_cat",
                     "exemption_description", F.col("exempt_val").alias("exemption_value"))
            .orderBy(asc("jurisdiction"), asc("exempt_cat")))


def q_values_by_jurisdiction(tables, acct: str, with_rate: bool = False) -> DataFrame:
    """Appraised and taxable value of an account per taxing jurisdiction.

    ``with_rate`` adds ``tax_rate``: the jurisdiction's current rate, from its rows without an exemption code (the
    greatest if it has several; NULL if it has none).
    """
    jv = tables["jur_value"].where(F.col("acct") == F.lit(acct))
    ra = tables["real_acct"].select("acct", "mailto")
    j = (jv.join(ra, "acct", "inner")
         .join(_lookup(tables["desc_r_12_real_jurisdictions"], "Code", "tax_district", "Description", "jurisdiction"),
               "tax_district", "left"))
    out = ["acct", F.col("mailto").alias("owner"), "jurisdiction", "tax_district", "appraised_val", "taxable_val"]
    if with_rate:
        rates = tables["jur_tax_dist_exempt_value_rate"]
        rates = (rates.where(F.nullif(F.col("exempt_cd"), F.lit("")).isNull())
                 .select(F.col("tax_dist").alias("tax_district"), safe_num("curr").alias("_rate"))
                 .groupBy("tax_district").agg(F.max("_rate").alias("tax_rate")))
        j = j.join(rates, "tax_district", "left")
        out.append("tax_rate")
    return j.select(*out).orderBy(asc("jurisdiction"), asc("tax_district"))


def q_neighborhood_stats(tables, prefix: str, state_class: str = "A1") -> DataFrame:
    """Per neighbourhood (code prefix, one state class): count, average, exact median, sizes, year range."""
    ra = tables["real_acct"].where(F.col("Neighborhood_Code").like(f"{prefix}%")
                                   & (F.col("state_class") == F.lit(state_class)))
    j = ra.select("acct", "Neighborhood_Code", "tot_mkt_val", "land_ar").join(
        _primary_building(tables, "heat_ar", "date_erected"), "acct", "left")
    stats = j.groupBy("Neighborhood_Code").agg(
        F.count(F.lit(1)).alias("property_count"),
        avg_round(safe_num("tot_mkt_val"), 0).alias("avg_market_value"),
        avg_round(safe_num("heat_ar"), 0).alias("avg_living_sqft"),
        avg_round(safe_num("land_ar"), 0).alias("avg_lot_sqft"),
        F.min("date_erected").alias("oldest_year_built"),
        F.max("date_erected").alias("newest_year_built"))
    med = grouped_percentile_cont(ra, ["Neighborhood_Code"], safe_num("tot_mkt_val"), 0.5, "median_market_value")
    nc = _lookup(tables["real_neighborhood_code"], "cd", "Neighborhood_Code", "dscr", "neighborhood_name")
    return (stats.join(med, "Neighborhood_Code", "left").join(nc, "Neighborhood_Code", "left")
            .select("Neighborhood_Code", "neighborhood_name", "property_count", "avg_market_value",
                    "median_market_value", "avg_living_sqft", "avg_lot_sqft", "oldest_year_built", "newest_year_built")
            .orderBy(asc("Neighborhood_Code"), asc("neighborhood_name")))


def q_market_area(tables, limit: int = 20) -> DataFrame:
    """Top market areas by distinct account count, with average and total value."""
    ra = tables["real_acct"]
    agg = ra.groupBy("Market_Area_1").agg(
        F.count_distinct("acct").alias("property_count"),
        avg_round(safe_num("tot_mkt_val"), 0).alias("avg_value"),
        F.sum(safe_num("tot_mkt_val")).alias("total_value"))
    ma = tables["desc_r_21_market_area"].select(F.col("MktArea").alias("Market_Area_1"),
                                                 F.col("Description").alias("market_area"))
    return (agg.join(ma, "Market_Area_1", "inner")
            .select(F.col("Market_Area_1").alias("market_area_cd"), "market_area", "property_count", "avg_value",
                    "total_value")
            .orderBy(desc("property_count"), asc("market_area_cd"), asc("market_area")).limit(limit))


def q_recent_sales_neighborhood(tables, neighborhood: str, as_of, years: int = 1) -> DataFrame:
    """Deeds of the last ``years`` in one neighbourhood, newest first."""
    ra = tables["real_acct"].where(F.col("Neighborhood_Code") == F.lit(neighborhood)).select(
        "acct", "site_addr_1", "tot_mkt_val")
    d = tables["deeds"].where(parse_mdy("dos") >= years_before(as_of, years))
    j = d.join(ra, "acct", "inner").join(_primary_building(tables, "heat_ar"), "acct", "left")
    return (j.select("acct", "site_addr_1", F.col("dos").alias("sale_date"), "deed_id", "clerk_yr", "clerk_id",
                     F.col("tot_mkt_val").alias("current_market_value"), F.col("heat_ar").alias("living_sqft"))
            .orderBy(desc(parse_mdy("sale_date")), asc("acct"), asc("deed_id")))


def q_protests_in_year(tables, year: int) -> DataFrame:
    """Protests whose parsed date falls in ``year``, newest (text order) first."""
    ap = tables["arb_protest_real"].where(F.year(parse_mdy("protested_dt")) == F.lit(int(year)))
    ra = tables["real_acct"].select("acct", "mailto", "site_addr_1")
    return (ap.join(ra, "acct", "inner")
            .select("acct", F.col("mailto").alias("owner"), "site_addr_1", "protested_by",
                    F.col("protested_dt").alias("protest_date"))
            .orderBy(desc("protest_date"), asc("acct")))


def q_hearing_results(tables, tax_year: str) -> DataFrame:
    """Hearings of one tax year with the value reduction and the conclusion text."""
    ah = tables["arb_hearings_real"].where((F.col("Tax_Year") == F.lit(str(tax_year)))
                                           & F.col("Final_Appraised_Value").isNotNull())
    ra = tables["real_acct"].select("acct", "mailto")
    j = (ah.join(ra, "acct", "inner")
         .join(_lookup(tables["desc_r_25_conclusion_code"], "Code", "Letter_Type", "Description", "conclusion"),
               "Letter_Type", "left"))
    return (j.select("acct", F.col("mailto").alias("owner"), F.col("Tax_Year").alias("tax_year"),
                     F.col("Actual_Hearing_Date").alias("actual_hearing_date"),
                     F.col("Initial_Appraised_Value").alias("initial_appraised_value"),
                     F.col("Final_Appraised_Value").alias("final_appraised_value"),
                     (safe_num("Initial_Appraised_Value") - safe_num("Final_Appraised_Value")).alias("value_reduction"),
                     "conclusion")
            .orderBy(desc("actual_hearing_date"), asc("acct")))


def q_recent_permits(tables, as_of, years: int = 2, limit: int = 100) -> DataFrame:
    """The ``limit`` newest permits of the last ``years`` with type and status text."""
    issued = parse_mdy("issue_date")
    p = tables["permits"].where(issued >= years_before(as_of, years))
    ra = tables["real_acct"].select("acct", "site_addr_1")
    j = (p.join(ra, "acct", "inner")
         .join(_lookup(tables["desc_r_19_permit_code"], "Code", "permit_type", "Description", "permit_description"),
               "permit_type", "left")
         .join(_lookup(tables["desc_r_18_permit_status"], "Code", "status", "Description", "status_text"),
               "status", "left"))
    return (j.select("acct", "site_addr_1", F.col("id").alias("permit_id"), "permit_type", "permit_description",
                     F.col("issue_date").alias("issued_date"), F.col("status_text").alias("status"))
            .orderBy(desc(parse_mdy("issued_date")), asc("acct"), asc("permit_id")).limit(limit))


def q_values_by_school_district(tables, classes=("A1", "A2", "A3")) -> DataFrame:
    """Residential count, total market and appraised value and average per school district."""
    ra = tables["real_acct"].where(F.col("state_class").isin(*classes))
    agg = ra.groupBy("school_dist").agg(
        F.count("acct").alias("property_count"),
        F.sum(safe_num("tot_mkt_val")).alias("total_market_value"),
        F.sum(safe_num("tot_appr_val")).alias("total_appraised_value"),
        avg_round(safe_num("tot_mkt_val"), 0).alias("avg_market_value"))
    sd = _lookup(tables["desc_r_20_school_district"], "Code", "school_dist", "Description", "school_district")
    return (agg.join(sd, "school_dist", "inner")
            .select(F.col("school_dist").alias("school_dist_cd"), "school_district", "property_count",
                    "total_market_value", "total_appraised_value", "avg_market_value")
            .orderBy(desc("total_market_value"), asc("school_dist_cd")))


def q_state_class_distribution(tables) -> DataFrame:
    """Count, total and average market value per state class (classes with a lookup row)."""
    ra = tables["real_acct"]
    agg = ra.groupBy("state_class").agg(
        F.count("acct").alias("property_count"),
        F.sum(safe_num("tot_mkt_val")).alias("total_value"),
        avg_round(safe_num("tot_mkt_val"), 0).alias("avg_value"))
    sc = _lookup(tables["desc_r_01_state_class"], "Code", "state_class", "Description", "property_type")
    return (agg.join(sc, "state_class", "inner")
            .select("state_class", "property_type", "property_count", "total_value", "avg_value")
            .orderBy(desc("property_count"), asc("state_class")))


def _street(tables, zip_code: str, street: str, suffix: str = "ST", loose: bool = False) -> DataFrame:
    ra = tables["real_acct"]
    cond = street_match("site_addr_1", "str", street, "site_addr_3", zip_code, suffix)
    if loose:
        cond = cond | ((F.col("site_addr_3") == F.lit(zip_code)) & F.upper(F.col("str")).ilike(f"%{street}%"))
    return ra.where(cond)


def q_street_list(tables, zip_code: str, street: str, suffix: str = "ST") -> DataFrame:
    """Properties on a street in a ZIP code (address, exact or partial street-name match)."""
    ra = _street(tables, zip_code, street, suffix, loose=True)
    return (ra.select("acct", "str_num",
                      F.concat(F.col("str"), F.coalesce(F.concat(F.lit(" "), F.col("str_sfx")), F.lit("")))
                      .alias("street_full"),
                      "str_unit", "site_addr_1", "site_addr_2", F.col("site_addr_3").alias("zip"),
                      F.col("mailto").alias("owner"), "tot_mkt_val", "str_sfx", "str")
            .orderBy(asc("str_num"), asc("str_sfx"), asc("str"), asc("acct")).drop("str_sfx", "str"))


def q_street_exact(tables, zip_code: str, street: str, suffixes=("ST", "ST.", "STREET")) -> DataFrame:
    """Exact street name with a street-type suffix in ``suffixes``."""
    ra = tables["real_acct"].where((F.col("site_addr_3") == F.lit(zip_code))
                                   & (F.upper(F.col("str")) == F.lit(street.upper()))
                                   & F.upper(F.coalesce(F.col("str_sfx"), F.lit(""))).isin(*suffixes))
    return (ra.select("acct", "str_num", "str", "str_sfx", "site_addr_1", "site_addr_2", "site_addr_3",
                      F.col("mailto").alias("owner"), "tot_mkt_val")
            .orderBy(asc("str_num"), asc("acct")))


def q_street_owners(tables, zip_code: str, street: str, suffix: str = "ST") -> DataFrame:
    """Owners of the properties on a street."""
    ra = _street(tables, zip_code, street, suffix).select("acct", "site_addr_1")
    o = tables["owners"]
    return (ra.join(o, "acct", "inner")
            .select("acct", "site_addr_1", F.col("name").alias("owner_name"),
                    F.col("pct_own").alias("ownership_percent"), "ln_num")
            .orderBy(asc("site_addr_1"), asc("ln_num"), asc("acct")).drop("ln_num"))


def q_street_summary(tables, zip_code: str, street: str, suffix: str = "ST") -> DataFrame:
    """Distinct properties, total and average market value on a street (one row)."""
    ra = _street(tables, zip_code, street, suffix)
    v = safe_num("tot_mkt_val")
    return ra.agg(F.count_distinct("acct").alias("property_count"),
                  F.sum(v).alias("total_market_value"),
                  F.avg(v).alias("avg_market_value"))


def q_street_deeds(tables, zip_code: str, street: str, suffix: str = "ST", limit: int = 100) -> DataFrame:
    """The ``limit`` newest deeds on a street; undated deeds sort as 01/01/1900."""
    ra = _street(tables, zip_code, street, suffix).select("acct", "site_addr_1")
    d = tables["deeds"]
    sale = F.coalesce(parse_mdy("dos"), F.lit("1900-01-01").cast("date"))
    return (d.join(ra, "acct", "inner")
            .select("acct", "site_addr_1", F.col("dos").alias("sale_date"), "deed_id", "clerk_yr", "clerk_id",
                    sale.alias("_d"))
            .orderBy(desc("_d"), asc("acct"), asc("deed_id"), asc("sale_date"), asc("clerk_yr"), asc("clerk_id"))
            .limit(limit).drop("_d"))
