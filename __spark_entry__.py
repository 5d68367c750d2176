"""

``entry(spark)`` runs the flagship view on the sf0.001 test tables.
``queries()`` maps every implemented operator / view / check / report key
(SURVEY §2) to ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives the
independent DuckDB formulation of the same key.

Inputs: the reference's yearly files are not shipped, so each query reads the
driver's test tables and derives reference-shaped, all-text tables from them
(``parcelkit.fixtures``, one SQL text shared with the oracle). ``building_res``
and ``fixtures`` are key-cleaned with ``dedupe_keep_first`` before the views
(they hold duplicate keys); results are returned in the portable encoding
(decimals as DOUBLE, dates as ISO text).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelkit.catalog import foreign_keys, primary_key  # noqa: E402
from parcelkit.fixtures import AS_OF, DERIVED, PARAMS, Tables, write_text_drop, write_zip_drop  # noqa: E402
from parcelkit.functions.exprs import safe_num  # noqa: E402
from parcelkit.functions.portable import portable  # noqa: E402
from parcelkit.operators import integrity as I  # noqa: E402
from parcelkit.operators import rollups as R  # noqa: E402
from parcelkit.plans import quality as Q  # noqa: E402
from parcelkit.plans import reports as B  # noqa: E402
from parcelkit.plans import view_reports as VR  # noqa: E402
from parcelkit.plans import views as V  # noqa: E402
from parcelkit.plans.load import load_tables  # noqa: E402
from parcelkit.plans.sql import register, sql_select  # noqa: E402
from parcelkit.session import ensure_checkpoint_dir  # noqa: E402
from parcelkit.sources.codebook import column  # noqa: E402
from pyspark.sql import types as T  # noqa: E402
from parcelkit.sources.archives import archive_manifest, archive_scan, archive_table  # noqa: E402
from parcelkit.sources.pages import page_links  # noqa: E402
from parcelkit.sources.tsv import clean_cells, tsv_scan  # noqa: E402
from parcelkit.streaming.drops import stream_drops  # noqa: E402

P = PARAMS
FLAGSHIP_DIR = "/root/testdata/sf0.001"
LOADED = ("real_acct", "building_res", "jur_value", "arb_protest_real", "deeds")
SQL_SELECT_TEXT = ("SELECT ra.state_class, sc.Description AS property_type, COUNT(*) AS property_count "
                   "FROM real_acct ra LEFT JOIN desc_r_01_state_class sc ON ra.state_class = sc.Code "
                   "WHERE ra.site_addr_3 = :zip GROUP BY ra.state_class, sc.Description")


def _raw(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def _nonkey(df: DataFrame, table: str):
    pk = primary_key(table)
    return [c for c in df.columns if c not in pk]


def _clean(t: Tables) -> Tables:
    """Key-enforce the two derived tables that carry duplicate keys (keep-first by non-key columns)."""
    for name in ("building_res", "fixtures"):
        df = t[name]
        t = t.with_table(name, I.dedupe_keep_first(df, primary_key(name), order_cols=_nonkey(df, name)))
    return t


def _tables(spark: SparkSession, sf_dir: str) -> Tables:
    return _clean(_raw(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the residential protest-analysis view on the sf0.001 tables."""
    return portable(V.residential_protest_analysis(_tables(spark, FLAGSHIP_DIR), AS_OF))


class _Query:
    """A registered query: ``fn(tables)`` over raw or key-cleaned input tables."""

    def __init__(self, fn: Callable, clean: bool = True):
        self.fn, self.clean = fn, clean

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        t = _tables(spark, sf_dir) if self.clean else _raw(spark, sf_dir)
        return portable(self.fn(t))


def _q(fn: Callable, clean: bool = True) -> _Query:
    return _Query(fn, clean)


def query_functions() -> dict[str, _Query]:
    """The registered queries as table-mapping functions (``.fn(tables)``), e.g. to run over a TableStore."""
    return _queries()


def _queries() -> dict[str, _Query]:
    a, nb, pre, z, st = P["acct"], P["neighborhood"], P["neighborhood_prefix"], P["zip_code"], P["street"]
    br_cols = ["acct", "bld_num", "impr_tp", "date_erected", "yr_remodel", "structure_dscr", "qa_cd", "dscr", "heat_ar",
               "gross_ar", "eff_ar", "im_sq_ft", "cama_replacement_cost", "accrued_depr_pct"]
    sizes = {"acct": 13, "bld_num": 10, "impr_tp": 4, "date_erected": 4, "yr_remodel": 4, "structure_dscr": 50,
             "qa_cd": 2, "dscr": 50, "heat_ar": 10, "gross_ar": 10, "eff_ar": 10, "im_sq_ft": 10,
             "cama_replacement_cost": 12, "accrued_depr_pct": 9}
    profiled = [("real_acct", ("acct",)), ("building_res", ("acct", "bld_num")),
                ("fixtures", ("acct", "bld_num", "type")), ("jur_value", ("acct", "tax_district")),
                ("deeds", ("acct", "deed_id")), ("arb_protest_real", ("acct", "protested_dt")),
                ("jur_exempt", ("acct", "tax_district", "exempt_cat"))]
    keyed = [(t, primary_key(t)) for t in DERIVED if primary_key(t)]
    counted = DERIVED

    def key_profiles(t, which):
        from functools import reduce
        return reduce(DataFrame.unionByName, [I.key_profile(t[n], k, n) for n, k in which])

    def priced(t):
        return R.recent_sales_priced(t["deeds_priced"], AS_OF)

    def over(t):
        return VR.q_over_assessment(t.with_table("deeds", t["deeds_priced"]), AS_OF, price_col="sale_price")

    def state_class_sql(t):
        register(t, ["real_acct", "desc_r_01_state_class"])
        return sql_select(t["real_acct"].sparkSession, SQL_SELECT_TEXT, {"zip": z})

    def load_round_trip(t):
        """Write the drop as text (input construction), then run the loader over it."""
        import uuid
        spark = t["real_acct"].sparkSession
        base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/load-{uuid.uuid4().hex}"
        drop = t.with_table("real_acct", t["real_acct"].join(t["real_acct_not_p"], "acct", "left_semi"))
        cols = write_text_drop(drop, LOADED, f"{base}/drop")
        codebook = {n: T.StructType([column(c) for c in cs]) for n, cs in cols.items()}
        return load_tables(spark, f"{base}/drop", codebook, f"{base}/clean")

    def loaded_rows(t):
        """The rows that the loader keeps of a dirty drop: padded and blank cells, keys without a number, repeated keys,
        orphans. The rows of a key are written in the order of their cells (input construction), so the first of them is known."""
        import uuid
        from pyspark.sql import functions as F
        spark = t["building_res"].sparkSession
        base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/load-{uuid.uuid4().hex}"
        parents = t["real_acct"].join(t["real_acct_not_p"], "acct", "left_semi")
        dirty = t["building_res"].withColumn("bld_num", F.when(F.col("heat_ar") == "", "").otherwise(F.col("bld_num")))
        cols = write_text_drop({"real_acct": parents, "building_res": dirty}, ["real_acct", "building_res"], f"{base}/drop", sort=True)
        codebook = {n: T.StructType([column(c) for c in cs]) for n, cs in cols.items()}
        report = load_tables(spark, f"{base}/drop", codebook, f"{base}/clean")
        failed = [r["status"] for r in report.collect() if r["status"] != "ok"]
        if failed:
            raise RuntimeError(f"load failed: {failed}")
        return spark.read.parquet(f"{base}/clean/building_res")

    def drops_round_trip(t):
        """Two text drops of the account table (input construction); the second changes values of
        keys already loaded. The incremental loader must keep the first drop's rows."""
        import uuid
        from pyspark.sql import functions as F
        spark = t["real_acct"].sparkSession
        base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/drops-{uuid.uuid4().hex}"
        cols = write_text_drop(t, ["real_acct"], f"{base}/landing")["real_acct"]
        args = (spark, f"{base}/landing", "real_acct", cols, ["acct"], f"{base}/table", f"{base}/ckpt")
        stream_drops(*args).awaitTermination()
        changed = t["real_acct"].withColumn("tot_mkt_val", F.lit("changed"))
        write_text_drop({"drop2": changed}, ["drop2"], f"{base}/landing/real_acct")
        stream_drops(*args).awaitTermination()
        return spark.read.parquet(f"{base}/table")

    def zipped_owners(t):
        """The owners table written as ZIP archives (input construction), read back through the archive scan."""
        import uuid
        spark = t["owners"].sparkSession
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/zips-{uuid.uuid4().hex}"
        write_zip_drop(t, "owners", root)
        return archive_table(archive_scan(spark, root), "owners", t["owners"].columns)

    def zipped_manifest(t):
        """The manifest of the owners table written as ZIP archives (input construction)."""
        import uuid
        from pyspark.sql import functions as F
        spark = t["owners"].sparkSession
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/zips-{uuid.uuid4().hex}"
        write_zip_drop(t, "owners", root)
        return archive_manifest(archive_scan(spark, root, lines=False)).withColumn(
            "archive", F.element_at(F.split("archive", "/"), -1))

    def coverage(t):
        """Every foreign key of the catalogue between derived tables; accounts are held against a reduced parent."""
        from functools import reduce
        rows = [I.fk_coverage(t[child], t["real_acct_not_p" if parent == "real_acct" else parent], cols, parent_cols, child, parent)
                for child, cols, parent, parent_cols in foreign_keys(DERIVED)]
        return reduce(DataFrame.unionByName, rows)

    def scanned_owners(t):
        """The owners table written as a text drop (input construction), read back by the text scan."""
        import uuid
        spark = t["owners"].sparkSession
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/text-{uuid.uuid4().hex}"
        cols = write_text_drop(t, ["owners"], root)["owners"]
        return tsv_scan(spark, root, "owners", cols).drop(I.ORDER_COL)

    return {
        "tsv_scan": _q(scanned_owners, False),
        "archive_scan": _q(zipped_owners, False),
        "archive_manifest": _q(zipped_manifest, False),
        "stream_drops": _q(drops_round_trip, False),
        # sources / cleaning / integrity
        "dedupe_keep_first": _q(lambda t: I.dedupe_keep_first(t["building_res"].select(*br_cols),
                                                              ("acct", "bld_num"), order_cols=br_cols[2:]), False),
        "drop_null_keys": _q(lambda t: I.drop_null_keys(
            clean_cells(t["real_acct"].select("acct", "state_class", "tot_mkt_val")), ["acct", "tot_mkt_val"]), False),
        "reject_orphans": _q(lambda t: I.reject_orphans(t["building_res"].select("acct", "bld_num", "heat_ar"),
                                                        t["real_acct_not_p"]), False),
        "orphan_rows": _q(lambda t: I.orphan_rows(t["building_res"].select("acct", "bld_num", "heat_ar"),
                                                  t["real_acct_not_p"]), False),
        "key_profile": _q(lambda t: key_profiles(t, profiled), False),
        "key_profile_all": _q(lambda t: key_profiles(t, keyed), False),
        "fk_coverage": _q(lambda t: I.fk_coverage(t["building_res"], t["real_acct_not_p"], ("acct",), ("acct",),
                                                  "building_res", "real_acct"), False),
        "fk_coverage_all": _q(coverage, False),
        "table_counts": _q(lambda t: I.table_counts({n: t[n] for n in counted}), False),
        "length_overflow_report": _q(lambda t: I.length_overflow_report(t["building_res"], sizes, "building_res"),
                                     False),
        "clean_cells": _q(lambda t: clean_cells(t["deeds"]), False),
        "load_tables": _q(load_round_trip, False),
        "loaded_rows": _q(loaded_rows, False),
        "page_links": _q(lambda t: page_links(t["pages"], P["link_pattern"]), False),
        "sql_select": _q(state_class_sql, False),
        # scalar function
        "safe_num": _q(lambda t: t["real_acct"].select("acct", "tot_mkt_val",
                                                       safe_num("tot_mkt_val").alias("tot_mkt_val_num"),
                                                       safe_num("tot_appr_val").alias("tot_appr_val_num")), False),
        # per-account pre-aggregates
        "owners_agg": _q(lambda t: R.owners_agg(t["owners"])),
        "fixture_counts": _q(lambda t: R.fixture_counts(t["fixtures"])),
        "extra_feature_summary": _q(lambda t: R.extra_feature_summary(t["extra_features"])),
        "recent_event_counts": _q(lambda t: R.recent_event_counts(t["permits"], "issue_date", AS_OF, 5,
                                                                  "permits_last_5yr")),
        "jur_value_sum": _q(lambda t: R.jur_value_sum(t["jur_value"])),
        "building_summary": _q(lambda t: R.building_summary(t["building_res"])),
        "protest_history": _q(lambda t: R.protest_history(t["arb_protest_real"])),
        "hearing_history": _q(lambda t: R.hearing_history(t["arb_hearings_real"], AS_OF)),
        "recent_sales": _q(lambda t: R.recent_sales(t["deeds"], AS_OF)),
        "recent_sales_priced": _q(priced),
        "exemption_summary": _q(lambda t: R.exemption_summary(t["jur_exempt"])),
        # views
        "property_features": _q(lambda t: V.property_features(t, AS_OF)),
        "property_features_v2": _q(lambda t: V.property_features_v2(t, AS_OF)),
        "residential_protest_analysis": _q(lambda t: V.residential_protest_analysis(t, AS_OF)),
        # data-quality checks
        "dq_unparseable_market_value": _q(lambda t: Q.dq_unparseable_market_value(t)),
        "dq_suspicious_bedrooms": _q(lambda t: Q.dq_suspicious_bedrooms(t)),
        "dq_zero_heated_area": _q(lambda t: Q.dq_zero_heated_area(t)),
        "dq_value_mismatch": _q(lambda t: Q.dq_value_mismatch(t)),
        "dq_street_anomalies": _q(lambda t: Q.dq_street_anomalies(t, AS_OF, z, st)),
        "dq_street_property_count": _q(lambda t: Q.dq_street_property_count(t, z, st)),
        "dq_bedroom_columns": _q(lambda t: Q.dq_bedroom_columns(t, AS_OF, z, st)),
        "dq_anomaly_summary": _q(lambda t: Q.dq_anomaly_summary(t, AS_OF)),
        "dq_review_list": _q(lambda t: Q.dq_review_list(t, AS_OF, z, st)),
        "dq_view_row_count": _q(lambda t: Q.dq_view_row_count(t, AS_OF)),
        # analytical queries on base tables
        "q_property_profile": _q(lambda t: B.q_property_profile(t, a), False),
        "q_address_search": _q(lambda t: B.q_address_search(t, f"{st} ST"), False),
        "q_comps_base": _q(lambda t: B.q_comps_base(t, nb)),
        "q_property_detail": _q(lambda t: B.q_property_detail(t, a)),
        "q_ownership_history": _q(lambda t: B.q_ownership_history(t, a), False),
        "q_current_owners": _q(lambda t: B.q_current_owners(t, a), False),
        "q_exemptions_by_jurisdiction": _q(lambda t: B.q_exemptions_by_jurisdiction(t, a), False),
        "q_values_by_jurisdiction": _q(lambda t: B.q_values_by_jurisdiction(t, a), False),
        "q_values_by_jurisdiction_rated": _q(lambda t: B.q_values_by_jurisdiction(t, a, with_rate=True), False),
        "q_neighborhood_stats": _q(lambda t: B.q_neighborhood_stats(t, pre)),
        "q_market_area": _q(lambda t: B.q_market_area(t), False),
        "q_recent_sales_neighborhood": _q(lambda t: B.q_recent_sales_neighborhood(t, nb, AS_OF)),
        "q_protests_in_year": _q(lambda t: B.q_protests_in_year(t, P["protest_year"]), False),
        "q_hearing_results": _q(lambda t: B.q_hearing_results(t, P["hearing_year"]), False),
        "q_recent_permits": _q(lambda t: B.q_recent_permits(t, AS_OF), False),
        "q_values_by_school_district": _q(lambda t: B.q_values_by_school_district(t), False),
        "q_state_class_distribution": _q(lambda t: B.q_state_class_distribution(t), False),
        "q_street_list": _q(lambda t: B.q_street_list(t, z, st), False),
        "q_street_exact": _q(lambda t: B.q_street_exact(t, z, st), False),
        "q_street_owners": _q(lambda t: B.q_street_owners(t, z, st), False),
        "q_street_summary": _q(lambda t: B.q_street_summary(t, z, st), False),
        "q_street_deeds": _q(lambda t: B.q_street_deeds(t, z, st), False),
        # analytical queries on the views
        "q_features_sample": _q(lambda t: VR.q_features_sample(t, AS_OF, z, st)),
        "q_value_by_bedrooms": _q(lambda t: VR.q_value_by_bedrooms(t, AS_OF, z, st)),
        "q_value_by_quality": _q(lambda t: VR.q_value_by_quality(t, AS_OF, z, st)),
        "q_value_by_pool": _q(lambda t: VR.q_value_by_pool(t, AS_OF, z, st)),
        "q_protest_profile": _q(lambda t: VR.q_protest_profile(t, AS_OF, a)),
        "q_comps": _q(lambda t: VR.q_comps(t, AS_OF, nb)),
        "q_success_in_neighborhood": _q(lambda t: VR.q_success_in_neighborhood(t, AS_OF, pre)),
        "q_over_assessment": _q(over),
        "q_neighborhood_comparison": _q(lambda t: VR.q_neighborhood_comparison(t, AS_OF, pre)),
        "q_multi_building": _q(lambda t: VR.q_multi_building(t, AS_OF)),
        "q_street_protest_report": _q(lambda t: VR.q_street_protest_report(t, AS_OF, z, st)),
        "q_street_multi_building": _q(lambda t: VR.q_street_multi_building(t, AS_OF, z, st)),
        "q_street_protest_success": _q(lambda t: VR.q_street_protest_success(t, AS_OF, z, st)),
        "q_value_by_decade": _q(lambda t: VR.q_value_by_decade(t, AS_OF, z, st)),
        "q_homestead_analysis": _q(lambda t: VR.q_homestead_analysis(t, AS_OF, z, st)),
    }


def _corpus_queries() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators; none when that subpackage is not installed."""
    try:
        from parcelkit.llm.queries import ORACLES, QUERIES
    except ModuleNotFoundError as e:
        if (e.name or "").split(".")[0] not in ("parcelkit", "corpus_pipeline"):
            raise
        return {}, {}
    return QUERIES, ORACLES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """
    ``(spark, sf_dir) -> DataFrame``."""
    return {**_queries(), **_corpus_queries()[0]}


def oracle_sql() -> dict[str, str]:
    from oracle_sql import ORACLE
    return {**{k: v for k, v in ORACLE.items() if k in _queries()}, **_corpus_queries()[1]}
