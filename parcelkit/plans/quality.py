"""Parameterised data-quality checks over the views.

Checks that need only a few view columns are planned from the aggregates they
need (e.g. bedrooms come from one ``fixtures`` aggregate), not from the whole
view: a left join on a unique key cannot be removed by the optimizer, so the
unused ones are simply not built. Row limits are the reports' own sample sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import NUM, asc, desc, pg_int, safe_num, street_match
from ..operators import rollups as R
from . import views as V


def _street_pred(zip_code: str, street: str, suffix: str = "ST"):
    return street_match("site_addr_1", "str", street, "site_addr_3", zip_code, suffix)


def dq_unparseable_market_value(tables, limit: int = 50) -> DataFrame:
    """Accounts with a market value text that does not survive ``safe_num`` (sample, by account)."""
    ra = tables["real_acct"]
    v = F.col("tot_mkt_val")
    return (ra.where(v.isNotNull() & (v != "") & safe_num(v).isNull())
            .select("acct", "site_addr_1", "tot_mkt_val", safe_num(v).alias("tot_mkt_val_num"))
            .orderBy(asc("acct")).limit(limit))


def dq_suspicious_bedrooms(tables, threshold: int = 10, limit: int = 50) -> DataFrame:
    """Accounts with more than ``threshold`` bedrooms, most first."""
    ra = tables["real_acct"].select("acct", "site_addr_1")
    fx = R.fixture_counts(tables["fixtures"]).select("acct", "bedrooms")
    return (ra.join(fx, "acct", "inner").where(pg_int("bedrooms") > threshold)
            .orderBy(desc("bedrooms"), asc("acct")).limit(limit))


def dq_zero_heated_area(tables, limit: int = 50) -> DataFrame:
    """Heated area 0 / missing while the account's building area is positive (sample, by account)."""
    ra = tables["real_acct"].select("acct", "site_addr_1", "bld_ar")
    br1 = (tables["building_res"].where(F.col("bld_num") == F.lit(R.PRIMARY))
           .select("acct", "heat_ar", "im_sq_ft"))
    heated = F.coalesce(safe_num("heat_ar"), safe_num("im_sq_ft"), safe_num("bld_ar"))
    zero = F.lit(0).cast(NUM)
    return (ra.join(br1, "acct", "left")
            .where((F.coalesce(heated, zero) == 0) & (F.coalesce(safe_num("bld_ar"), zero) > 0))
            .select("acct", "site_addr_1", heated.alias("heated_area_sqft"), "bld_ar")
            .orderBy(asc("acct")).limit(limit))


def dq_value_mismatch(tables, gap: int = 1000000, limit: int = 20) -> DataFrame:
    """Market value vs the sum of jurisdiction appraised values differing by more than ``gap``."""
    ra = tables["real_acct"].select("acct", "site_addr_1", safe_num("tot_mkt_val").alias("tot_mkt_val_num"))
    jv = R.jur_value_sum(tables["jur_value"])
    zero = F.lit(0).cast(NUM)
    j = ra.join(jv, "acct", "left").withColumn(
        "jur_appraised_val_sum", F.coalesce(F.col("jur_appraised_val_sum"), zero))
    return (j.where(F.abs(F.coalesce(F.col("tot_mkt_val_num"), zero) - F.col("jur_appraised_val_sum")) > gap)
            .select("acct", "site_addr_1", "tot_mkt_val_num", "jur_appraised_val_sum",
                    (F.col("tot_mkt_val_num") - F.col("jur_appraised_val_sum")).alias("diff"))
            .orderBy(desc("diff"), asc("acct")).limit(limit))


def dq_street_anomalies(tables, as_of, zip_code: str, street: str, limit: int = 100) -> DataFrame:
    """``property_features_v2`` rows of one street with any anomaly flag set."""
    v2 = V.property_features_v2(tables, as_of, where=_street_pred(zip_code, street))
    any_flag = (F.col("bedrooms_anomaly") | F.col("full_baths_anomaly") | F.col("half_baths_anomaly")
                | F.col("heated_area_anomaly") | F.col("large_value_anomaly"))
    return v2.where(any_flag).orderBy(asc("site_addr_1"), asc("acct")).limit(limit)


def dq_street_property_count(tables, zip_code: str, street: str) -> DataFrame:
    """Distinct accounts on one street (the source expects a known count)."""
    ra = tables["real_acct"].where(_street_pred(zip_code, street))
    return ra.agg(F.count_distinct("acct").alias("street_property_count"))


def dq_bedroom_columns(tables, as_of, zip_code: str, street: str, limit: int = 20) -> DataFrame:
    """Raw, capped and suspect bedroom columns for one street."""
    v2 = V.property_features_v2(tables, as_of, where=_street_pred(zip_code, street))
    return (v2.select("acct", "site_addr_1", "bedrooms", "bedrooms_capped", "bedrooms_suspect")
            .orderBy(asc("acct")).limit(limit))


def dq_anomaly_summary(tables, as_of) -> DataFrame:
    """Number of accounts with each anomaly flag set (all accounts)."""
    v2 = V.property_features_v2(tables, as_of)
    return v2.agg(*[F.count_if(F.col(f)).alias(f"{f}_count") for f in
                    ("bedrooms_anomaly", "full_baths_anomaly", "half_baths_anomaly", "heated_area_anomaly")])


def _protest_street(zip_code: str, street: str):
    return (F.col("site_addr_3") == F.lit(zip_code)) & (F.col("site_addr_1").ilike(f"%{street}%")
                                                        | (F.col("str") == F.lit(street)))


def dq_review_list(tables, as_of, zip_code: str, street: str) -> DataFrame:
    """Protest-view rows of one street with suspect bedrooms or a feature anomaly."""
    rpa = V.residential_protest_analysis(tables, as_of, where=_protest_street(zip_code, street))
    return (rpa.where(F.col("bedrooms_suspect") | F.col("has_feature_anomaly"))
            .select("acct", "address", "current_market_value", "bedrooms", "full_baths", "half_baths",
                    "primary_heated_sqft", "bedrooms_suspect", "has_feature_anomaly")
            .orderBy(asc("acct")))


def dq_view_row_count(tables, as_of) -> DataFrame:
    """Row count of the flagship view (the source's smoke test)."""
    rpa = V.residential_protest_analysis(tables, as_of)
    return rpa.agg(F.count(F.lit(1)).alias("view_row_count"))
