"""The three analysis views, as lazy DataFrames.

``tables`` is any mapping ``name -> DataFrame`` of cleaned (key-enforced) tables.

Plan shape (check with ``explain("formatted")``): each detail table is scanned
once and aggregated once by ``acct``; the account table is filtered first and
then left-joined to those aggregates on ``acct`` — sort-merge joins that reuse
the aggregates' hash partitioning, or broadcast joins when AQE measures a side
under ``spark.sql.adaptive.autoBroadcastJoinThreshold``. Code lookups carry no
broadcast hint: Spark broadcasts them when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles them otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import RESIDENTIAL_CLASSES
from ..functions.exprs import NUM, pg_int, safe_num
from ..operators import rollups as R

def _zero():
    return F.lit(0).cast(NUM)


def _z(c):
    return F.coalesce(F.col(c), _zero())


DETAIL_TABLES = ("building_res", "owners", "fixtures", "extra_features", "permits", "deeds", "jur_value", "land",
                 "arb_protest_real", "arb_hearings_real", "jur_exempt")


class _Restricted:
    """Tables with every per-account detail table semi-joined to the selected accounts.

    Used when a report selects a few accounts (a street, a neighbourhood):
    detail rows are filtered before they are shuffled for aggregation, and
    AQE broadcasts the selected key set when it is small.
    """

    def __init__(self, tables, accts: DataFrame):
        self._t, self._a = tables, accts

    def __getitem__(self, name):
        df = self._t[name]
        return df.join(self._a, "acct", "left_semi") if name in DETAIL_TABLES else df


def _select_accounts(tables, where):
    ra = tables["real_acct"]
    if where is None:
        return tables, ra
    ra = ra.where(where)
    return _Restricted(tables, ra.select("acct")), ra


def _property_features_frame(tables, as_of, where=None) -> DataFrame:
    tables, ra = _select_accounts(tables, where)
    br1 = (tables["building_res"].where(F.col("bld_num") == F.lit(R.PRIMARY))
           .select("acct", "heat_ar", "im_sq_ft", "date_erected", "yr_remodel", "structure_dscr", "dscr", "qa_cd"))
    br1 = br1.select("acct", "date_erected", "yr_remodel", "structure_dscr", "dscr", "qa_cd",
                     safe_num("heat_ar").alias("_heat_ar"), safe_num("im_sq_ft").alias("_im_sq_ft"))
    pf = (ra.select("acct", "yr", "site_addr_1", "site_addr_2", "site_addr_3", "str_num", "str", "str_sfx",
                    "str_unit", *[safe_num(c).alias(f"_{c}") for c in ("tot_mkt_val", "tot_appr_val", "land_val",
                                                                         "land_ar", "bld_ar")])
          .join(br1, "acct", "left")
          .join(R.owners_agg(tables["owners"]), "acct", "left")
          .join(R.fixture_counts(tables["fixtures"]), "acct", "left")
          .join(R.extra_feature_summary(tables["extra_features"]), "acct", "left")
          .join(R.recent_event_counts(tables["permits"], "issue_date", as_of, 5, "permits_last_5yr"), "acct", "left")
          .join(R.recent_event_counts(tables["deeds"], "dos", as_of, 5, "sales_last_5yr"), "acct", "left")
          .join(R.jur_value_sum(tables["jur_value"]), "acct", "left"))
    return pf.select(
        "acct",
        F.col("yr").alias("tax_year"),
        "site_addr_1", "site_addr_2",
        F.col("site_addr_3").alias("zip"),
        "str_num",
        F.col("str").alias("street_name"),
        "str_sfx", "str_unit",
        F.coalesce(F.col("owners"), F.lit("")).alias("owners"),
        F.col("_tot_mkt_val").alias("tot_mkt_val_num"),
        F.col("_tot_appr_val").alias("tot_appr_val_num"),
        F.col("_land_val").alias("land_val_num"),
        F.col("_land_ar").alias("lot_sqft"),
        F.coalesce(F.col("_heat_ar"), F.col("_im_sq_ft"), F.col("_bld_ar")).alias("heated_area_sqft"),
        F.col("date_erected").alias("bld_date_erected"),
        F.col("yr_remodel").alias("bld_year_remodel"),
        F.col("structure_dscr").alias("building_type"),
        F.col("dscr").alias("building_description"),
        F.col("qa_cd").alias("building_quality"),
        _z("bedrooms").alias("bedrooms"),
        _z("full_baths").alias("full_baths"),
        _z("half_baths").alias("half_baths"),
        F.coalesce(F.col("extra_feature_count"), F.lit(0).cast("bigint")).alias("extra_feature_count"),
        F.coalesce(F.col("has_pool"), F.lit(False)).alias("has_pool"),
        F.coalesce(F.col("permits_last_5yr"), F.lit(0).cast("bigint")).alias("permits_last_5yr"),
        F.coalesce(F.col("sales_last_5yr"), F.lit(0).cast("bigint")).alias("sales_last_5yr"),
        F.coalesce(F.col("jur_appraised_val_sum"), _zero()).alias("jur_appraised_val_sum"),
        F.col("_bld_ar").alias("_bld_ar_num"),
    )


def property_features(tables, as_of, where=None) -> DataFrame:
    """One row per account: address, sanitised values, primary building, fixture and event aggregates.

    ``where`` (a predicate on ``real_acct`` columns) restricts the accounts early.
    """
    return _property_features_frame(tables, as_of, where).drop("_bld_ar_num")


def _feature_flags(bed, full, half, heated, bld_ar=None):
    """Validated counts and anomaly flags (shared by ``property_features_v2`` and the protest view)."""
    out = {
        "bedrooms_raw": bed,
        "bedrooms_valid": F.when(bed.between(1, 8), pg_int(bed)),
        "bedrooms_anomaly": (bed < 1) | (bed > 8),
        "bedrooms_suspect": (bed > 12) | (bed < 0) | ((bed == 0) & (F.coalesce(heated, _zero()) > 5000)),
        "bedrooms_capped": F.when(bed > 0, F.least(pg_int(bed), F.lit(8))),
        "full_baths_raw": full,
        "full_baths_valid": F.when(full.between(0, 6), pg_int(full)),
        "full_baths_anomaly": (full < 0) | (full > 6),
        "half_baths_raw": half,
        "half_baths_valid": F.when(half.between(0, 4), pg_int(half)),
        "half_baths_anomaly": (half < 0) | (half > 4),
    }
    if bld_ar is not None:
        h, b = F.coalesce(heated, _zero()), F.coalesce(bld_ar, _zero())
        out["heated_area_anomaly"] = (h == 0) & (h < b) & (b > 0)
    return out


def _v2_from(pf: DataFrame) -> DataFrame:
    flags = _feature_flags(F.col("bedrooms"), F.col("full_baths"), F.col("half_baths"),
                           F.col("heated_area_sqft"), F.col("_bld_ar_num"))
    flags["large_value_anomaly"] = F.abs(_z("tot_mkt_val_num") - _z("jur_appraised_val_sum")) > 1000000
    return pf.withColumns(flags).drop("_bld_ar_num")


def property_features_v2(tables, as_of, where=None) -> DataFrame:
    """``property_features`` plus validated counts and anomaly flags (no re-join of the account table)."""
    return _v2_from(_property_features_frame(tables, as_of, where))


def _lookup(dim: DataFrame, key: str, as_key: str, value: str, as_value: str) -> DataFrame:
    return dim.select(F.col(key).alias(as_key), F.col(value).alias(as_value))


def residential_protest_analysis(tables, as_of, sales=None, where=None) -> DataFrame:
    """Flagship view: residential accounts (A1–A4, B1–B4) with everything needed for a value protest.

    ``sales`` overrides the recent-sales aggregate: a function ``deeds -> DataFrame``
    (e.g. ``recent_sales_priced`` for a deed file that carries prices).
    ``where`` (a predicate on ``real_acct`` columns) restricts the accounts
    before the detail tables are aggregated. No ORDER BY: sort at the call site.
    """
    residential = F.col("state_class").isin(*RESIDENTIAL_CLASSES)
    # the class filter alone keeps most accounts: filter the base only and let the
    # left joins drop detail aggregates; a caller's predicate also restricts the details
    tables, ra = _select_accounts(tables, None if where is None else (residential & where))
    # parse the account's numeric texts once; everything below refers to these columns
    nums = ("tot_mkt_val", "tot_appr_val", "land_val", "bld_val", "x_features_val", "ag_val", "land_ar", "bld_ar")
    ra = ra.where(residential).select(
        "acct", "site_addr_1", "site_addr_2", "site_addr_3", "str_num", "str", "str_sfx", "mailto", "state_class",
        "Neighborhood_Code", "school_dist", *[safe_num(c).alias(f"_{c}") for c in nums])
    land1 = (tables["land"].where(F.col("num") == F.lit(R.PRIMARY)).select("acct", "use_cd")
             .join(_lookup(tables["desc_r_15_land_usecode"], "Code", "use_cd", "Description", "land_use_desc"),
                   "use_cd", "left")
             .select("acct", "land_use_desc"))
    bs = R.building_summary(tables["building_res"], internal=True)
    fx = R.fixture_counts(tables["fixtures"])
    ef = R.extra_feature_summary(tables["extra_features"])
    ph = R.protest_history(tables["arb_protest_real"])
    hh = R.hearing_history(tables["arb_hearings_real"], as_of)
    rs = sales(tables["deeds"]) if sales is not None else R.recent_sales(tables["deeds"], as_of)
    es = R.exemption_summary(tables["jur_exempt"])

    j = (ra.join(_lookup(tables["desc_r_01_state_class"], "Code", "state_class", "Description",
                         "property_type_desc"), "state_class", "left")
         .join(_lookup(tables["real_neighborhood_code"], "cd", "Neighborhood_Code", "dscr", "neighborhood_name"),
               "Neighborhood_Code", "left")
         .join(_lookup(tables["desc_r_20_school_district"], "Code", "school_dist", "Description",
                       "school_district_name"), "school_dist", "left")
         .join(land1, "acct", "left")
         .join(bs, "acct", "left")
         .join(fx, "acct", "left")
         .join(ef, "acct", "left")
         .join(ph, "acct", "left")
         .join(hh, "acct", "left")
         .join(rs, "acct", "left")
         .join(es, "acct", "left"))

    mkt, land_val, bld_val, land_ar = F.col("_tot_mkt_val"), F.col("_land_val"), F.col("_bld_val"), F.col("_land_ar")
    # primary building fields of property_features (NULL when the account has no building '1')
    heated = F.coalesce(F.col("primary_heated_sqft"), F.col("_primary_im_sq_ft"), F.col("_bld_ar"))
    flags = _feature_flags(_z("bedrooms"), _z("full_baths"), _z("half_baths"), heated)
    ths = F.col("total_heated_sqft")
    init, final = F.col("last_initial_appraised"), F.col("last_final_appraised")
    price = F.col("last_sale_price")
    return j.select(
        "acct",
        F.col("site_addr_1").alias("address"),
        F.col("site_addr_2").alias("address_line_2"),
        F.col("site_addr_3").alias("zip_code"),
        F.col("str_num").alias("street_number"),
        F.col("str").alias("street_name"),
        F.col("str_sfx").alias("street_suffix"),
        F.col("mailto").alias("owner_name"),
        "state_class", "property_type_desc",
        F.col("Neighborhood_Code").alias("neighborhood_code"),
        "neighborhood_name",
        mkt.alias("current_market_value"),
        F.col("_tot_appr_val").alias("current_appraised_value"),
        land_val.alias("land_value"),
        bld_val.alias("building_value"),
        F.col("_x_features_val").alias("extra_features_value"),
        F.col("_ag_val").alias("ag_value"),
        (mkt - F.coalesce(land_val, _zero())).alias("improvement_value"),
        land_ar.alias("lot_sqft"),
        "land_use_desc",
        "building_count", "primary_year_built", "primary_year_remodel", "primary_structure_type",
        "primary_quality_code", "primary_quality_desc", "primary_heated_sqft", "primary_gross_sqft",
        "primary_effective_sqft", "total_heated_sqft", "total_gross_sqft", "additional_buildings",
        "primary_replacement_cost", "total_replacement_cost", "primary_depreciation_pct",
        F.when(ths > 0, F.round(bld_val / ths, 2)).alias("building_value_per_sqft"),
        flags["bedrooms_valid"].alias("bedrooms"),
        flags["full_baths_valid"].alias("full_baths"),
        flags["half_baths_valid"].alias("half_baths"),
        F.coalesce(F.col("has_pool"), F.lit(False)).alias("has_pool"),
        F.coalesce(F.col("extra_feature_count"), F.lit(0).cast("bigint")).alias("extra_feature_count"),
        flags["bedrooms_suspect"].alias("bedrooms_suspect"),
        (flags["bedrooms_anomaly"] | flags["full_baths_anomaly"] | flags["half_baths_anomaly"])
        .alias("has_feature_anomaly"),
        "total_protests", "last_protest_date", "protest_agents",
        "hearing_count", "last_hearing_year", "last_hearing_date",
        "last_initial_appraised", "last_final_appraised",
        (init - final).alias("last_hearing_reduction"),
        F.when(init > 0, F.round((init - final) / init * 100, 2)).alias("last_hearing_reduction_pct"),
        F.col("avg_value_reduction").alias("avg_hearing_reduction"),
        "successful_protests",
        F.when(F.col("hearing_count") > 0,
               F.round(F.col("successful_protests").cast(NUM) / F.col("hearing_count") * 100, 2))
        .alias("protest_success_rate"),
        F.col("sale_count").alias("sales_last_5yr"),
        "last_sale_date", "last_sale_price",
        F.when(price > 0, mkt - price).alias("value_change_since_sale"),
        F.when(price > 0, F.round((mkt - price) / price * 100, 2)).alias("value_change_pct_since_sale"),
        "exemption_count", "total_exemption_value", "exemption_codes",
        "has_homestead", "has_over_65", "has_disabled_veteran",
        "school_dist", "school_district_name",
        F.when(ths > 0, F.round(mkt / ths, 2)).alias("market_value_per_sqft"),
        F.when(land_ar > 0, F.round(land_val / land_ar, 2)).alias("land_value_per_sqft"),
    )
