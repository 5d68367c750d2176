"""Per-account pre-aggregates of the detail tables.

The source views compute these with correlated scalar subqueries, one index
probe per account per subquery. Here each detail table is aggregated once with
``groupBy("acct")``; the result is hash-partitioned on ``acct``, so the views
join them to the account table without another shuffle of the aggregate side.
Every aggregate used is partially aggregated map-side (sum, count, max,
bool_or, min_by/max over structs, collect_set), so an account holding a large
share of the rows is combined inside each task before the shuffle.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import NUM, number_text, parse_mdy, safe_num, string_agg_distinct, text_number, years_before

_ABOVE_PRICE = Decimal(10) ** (NUM.precision - NUM.scale + 1)   # more than any price and one
PRIMARY = "1"  # bld_num / land line of the primary building / land segment


def owners_agg(owners: DataFrame) -> DataFrame:
    """Distinct owner names per account joined by ``'; '`` (sorted), ``''`` when there are none."""
    return owners.groupBy("acct").agg(
        F.coalesce(string_agg_distinct("name", "; "), F.lit("")).alias("owners"))


def _units(units_col="units"):
    return F.coalesce(safe_num(units_col), F.lit(0).cast(NUM))


def fixture_counts(fixtures: DataFrame) -> DataFrame:
    """Bedrooms, full baths and half baths per account, summed over all buildings, in one pass."""
    def cond(text, code):
        return F.col("type_dscr").ilike(f"%{text}%") | F.col("type").ilike(code)
    # one narrow projection: each row's units are parsed once and routed to its room kind
    f = fixtures.select("acct", _units().alias("_u"), cond("Bedroom", "RMB").alias("_bed"),
                        cond("Full Bath", "RMF").alias("_full"), cond("Half Bath", "RMH").alias("_half"))
    return f.groupBy("acct").agg(
        F.sum(F.when(F.col("_bed"), F.col("_u"))).alias("bedrooms"),
        F.sum(F.when(F.col("_full"), F.col("_u"))).alias("full_baths"),
        F.sum(F.when(F.col("_half"), F.col("_u"))).alias("half_baths"),
    )


def extra_feature_summary(extra_features: DataFrame) -> DataFrame:
    """Extra-feature row count and whether any description mentions a pool."""
    pool = (F.col("dscr").ilike("%pool%") | F.col("l_dscr").ilike("%pool%") | F.col("s_dscr").ilike("%pool%"))
    return extra_features.groupBy("acct").agg(
        F.count(F.lit(1)).alias("extra_feature_count"),
        F.bool_or(pool).alias("has_pool"),
    )


def recent_event_counts(df: DataFrame, date_col: str, as_of, years: int = 5,
                        name: str = "event_count") -> DataFrame:
    """Rows per account whose ``MM/DD/YYYY`` date is on or after ``as_of - years``."""
    d = parse_mdy(date_col)
    return (df.where(d >= years_before(as_of, years))
              .groupBy("acct").agg(F.count(F.lit(1)).alias(name)))


def jur_value_sum(jur_value: DataFrame) -> DataFrame:
    """Sum of sanitised appraised values over all taxing jurisdictions of an account."""
    return (jur_value.select("acct", F.coalesce(safe_num("appraised_val"), F.lit(0).cast(NUM)).alias("_v"))
            .groupBy("acct").agg(F.sum("_v").alias("jur_appraised_val_sum")))


def building_summary(building_res: DataFrame, internal: bool = False) -> DataFrame:
    """Building count, primary-building pivots, totals and a text list of the other buildings.

    ``max(when(bld_num = '1', x))`` pivots the primary building in one
    aggregation over one scan. Only the number and text of the other buildings
    are gathered, and the buildings are counted from those: an account with
    primary rows alone gathers nothing. Rows without an account form a group of
    their own, with a building count of 0.
    With ``internal=True`` the primary building's raw heated and improvement
    area is kept (``_primary_im_sq_ft``) so the protest view needs no second
    scan of the building table.
    """
    # parse every numeric text once, in a narrow projection below the aggregate
    b = building_res.select(
        "acct", "bld_num", "date_erected", "yr_remodel", "structure_dscr", "qa_cd", "dscr", "heat_ar",
        *[safe_num(c).alias(f"_{c}") for c in ("heat_ar", "gross_ar", "eff_ar", "cama_replacement_cost",
                                                 "accrued_depr_pct", "im_sq_ft")],
        (F.col("bld_num") == F.lit(PRIMARY)).alias("_one"),
        F.concat(F.lit("Bldg "), F.col("bld_num"), F.lit(": "), F.coalesce(F.col("structure_dscr"), F.lit("Unknown")), F.lit(" ("),
                 F.coalesce(F.col("heat_ar"), F.lit("0")), F.lit(" sqft)")).alias("_text"))
    one = F.col("_one")

    def prim(c):
        return F.max(F.when(one, c))

    # the output lists every other building of the account; their texts are all that is gathered
    listed = F.collect_list(F.when(~one & F.col("_text").isNotNull(), F.struct(F.col("bld_num").alias("o"), F.col("_text").alias("v"))))
    aggs = [
        listed.alias("_bld"),
        F.bool_or(one).alias("_has_one"),
        prim(F.col("date_erected")).alias("primary_year_built"),
        prim(F.col("yr_remodel")).alias("primary_year_remodel"),
        prim(F.col("structure_dscr")).alias("primary_structure_type"),
        prim(F.col("qa_cd")).alias("primary_quality_code"),
        prim(F.col("dscr")).alias("primary_quality_desc"),
        prim(F.col("_heat_ar")).alias("primary_heated_sqft"),
        prim(F.col("_gross_ar")).alias("primary_gross_sqft"),
        prim(F.col("_eff_ar")).alias("primary_effective_sqft"),
        prim(F.col("_cama_replacement_cost")).alias("primary_replacement_cost"),
        prim(F.col("_accrued_depr_pct")).alias("primary_depreciation_pct"),
        F.sum("_heat_ar").alias("total_heated_sqft"),
        F.sum("_gross_ar").alias("total_gross_sqft"),
        F.sum("_cama_replacement_cost").alias("total_replacement_cost"),
    ]
    if internal:
        aggs += [prim(F.col("_im_sq_ft")).alias("_primary_im_sq_ft")]
    g = b.groupBy("acct").agg(*aggs)
    # an account's numbers are the primary one and those of the listed buildings; no account, no count
    others = F.size(F.array_distinct(F.transform("_bld", lambda x: x["o"])))
    counted = F.when(F.col("acct").isNotNull(), others + F.when(F.col("_has_one"), 1).otherwise(0)).otherwise(0)
    texts = F.transform(F.array_sort("_bld"), lambda x: x["v"])
    out = ["acct", counted.cast("bigint").alias("building_count")]
    out += [c for c in g.columns if c not in ("acct", "_bld", "_has_one", "_primary_im_sq_ft")]
    out += [F.when(F.size(texts) > 0, F.array_join(texts, "; ")).alias("additional_buildings")]
    if internal:
        out.append("_primary_im_sq_ft")
    return g.select(*out)


def _latest(text_col: str, chronological: bool, when=None):
    """Latest date text: by text order (the source compares ``MM/DD/YYYY`` strings), or by parsed date."""
    c = F.col(text_col) if when is None else F.when(when, F.col(text_col))
    if not chronological:
        return F.max(c)
    return F.max_by(c, F.struct(parse_mdy(text_col).alias("d"), F.col(text_col).alias("t")))


def protest_history(arb_protest_real: DataFrame, chronological: bool = False) -> DataFrame:
    """Distinct protest dates, latest date (text order as the source, or ``chronological``), agents list."""
    dt = F.col("protested_dt")
    # distinct protest dates per account are bounded by the calendar, so the distinct count
    # is taken from the partially aggregated set in the same pass (no extra distinct phase)
    return (arb_protest_real.where(dt.isNotNull() & (dt != ""))
            .groupBy("acct").agg(
                F.size(F.collect_set(dt)).cast("bigint").alias("total_protests"),
                _latest("protested_dt", chronological).alias("last_protest_date"),
                string_agg_distinct("protested_by", ", ").alias("protest_agents")))


def hearing_history(arb_hearings_real: DataFrame, as_of, years: int = 5, chronological: bool = False) -> DataFrame:
    """Hearings of the last ``years`` tax years per account.

    The latest year is the maximum over *all* of the account's hearings;
    initial and final values are independent maxima over that year's rows in
    the window. Done in one hash aggregation: every maximum is of a number of
    fixed width. Texts count as :func:`text_number` (by their first 14 bytes; a
    year has 4, a date 10), and a year of the window and a value are packed
    into one decimal, whose maximum is the latest year's greatest value; it
    holds if that year is the overall maximum, otherwise the value is NULL.
    ``last_hearing_date`` is the text maximum like the source unless
    ``chronological`` is set.
    """
    year = F.col("Tax_Year").try_cast("int")
    h = arb_hearings_real.select(
        "acct", text_number("Tax_Year").alias("_year"), year.alias("_number"), "Actual_Hearing_Date",
        safe_num("Initial_Appraised_Value").alias("_init"), safe_num("Final_Appraised_Value").alias("_final"),
        (year >= F.year(_as_of_col(as_of)) - F.lit(years)).alias("_in_win"))
    in_win = F.col("_in_win")
    init, final = F.col("_init"), F.col("_final")

    def w(x):
        return F.when(in_win, x)

    def top(value):
        above = F.col("_number").cast("decimal(10,0)") * F.lit(_ABOVE_PRICE)
        return F.max(w((above + F.coalesce(value + F.lit(1), F.lit(0)).cast("decimal(27,6)")).cast("decimal(38,6)")))

    def value_of(packed):
        """The packed value, if its year is the overall latest."""
        above = number_text("_max_year_all").try_cast("int").cast("decimal(10,0)") * F.lit(_ABOVE_PRICE)
        rest = F.col(packed) - above
        own = F.nullif(rest.cast("decimal(38,6)"), F.lit(0).cast("decimal(38,6)")) - F.lit(1)
        return F.when((rest >= 0) & (rest < F.lit(_ABOVE_PRICE)), own).cast(NUM)
    if chronological:
        last = _latest("Actual_Hearing_Date", True, in_win)
    else:
        last = F.max(w(text_number("Actual_Hearing_Date")))
    g = h.groupBy("acct").agg(
        F.count_if(in_win).alias("hearing_count"),
        F.max("_year").alias("_max_year_all"),
        F.max(w(F.col("_year"))).alias("_last_year"),
        last.alias("_last_date"),
        top(init).alias("_top_init"),
        top(final).alias("_top_final"),
        F.avg(w(init - final)).alias("_avg_red"),
        F.sum(w(F.when(final < init, 1).otherwise(0))).alias("successful_protests"),
    )
    return g.where(F.col("hearing_count") > 0).select(
        "acct", "hearing_count", number_text("_last_year").alias("last_hearing_year"),
        (F.col("_last_date") if chronological else number_text("_last_date")).alias("last_hearing_date"),
        value_of("_top_init").alias("last_initial_appraised"),
        value_of("_top_final").alias("last_final_appraised"),
        F.col("_avg_red").alias("avg_value_reduction"),
        F.col("successful_protests").cast("bigint").alias("successful_protests"),
    )


def _as_of_col(as_of):
    from ..functions.exprs import as_date_lit
    return as_date_lit(as_of)


def recent_sales(deeds: DataFrame, as_of, years: int = 5) -> DataFrame:
    """Deeds dated within ``years`` of ``as_of``: count and latest date; price is a typed NULL.

    The yearly deed file carries no price column, so ``last_sale_price`` is
    always NULL (see :func:`recent_sales_priced` for a file that has one).
    """
    d = parse_mdy("dos")
    return (deeds.where(d >= years_before(as_of, years))
            .groupBy("acct").agg(F.count(F.lit(1)).alias("sale_count"), F.max(d).alias("last_sale_date"))
            .withColumn("last_sale_price", F.lit(None).cast(NUM)))


def recent_sales_priced(deeds: DataFrame, as_of, years: int = 5, price_col: str = "sale_price") -> DataFrame:
    """Like :func:`recent_sales`, plus the (maximum) price recorded on the latest sale date.

    The latest date over all of an account's deeds always lies inside the
    window when the account has a recent deed, so the greatest (date, price)
    over the window rows gives it in the same pass. Both are packed into one
    number of fixed width, days above and the price below, so that the
    maximum stays a hash aggregate.
    """
    d = parse_mdy("dos")
    days = F.col("_days").cast("decimal(7,0)") * F.lit(_ABOVE_PRICE)
    # no price is 0, a price is one more than it is
    packed = (days + F.coalesce(F.col("_price") + F.lit(1), F.lit(0)).cast("decimal(27,6)")).cast("decimal(38,6)")
    return (deeds.where(d >= years_before(as_of, years))
            .select("acct", d.alias("_date"), F.datediff(d, F.lit("0001-01-01").cast("date")).alias("_days"),
                    safe_num(price_col).alias("_price"))
            .groupBy("acct").agg(
                F.count(F.lit(1)).alias("sale_count"),
                F.max("_date").alias("last_sale_date"),
                F.max("_days").alias("_days"),
                F.max(packed).alias("_last"))
            .select("acct", "sale_count", "last_sale_date",
                    F.nullif((F.col("_last") - days).cast("decimal(27,6)"), F.lit(0).cast("decimal(27,6)")).alias("_p"))
            .select("acct", "sale_count", "last_sale_date", (F.col("_p") - F.lit(1)).cast(NUM).alias("last_sale_price")))


def exemption_summary(jur_exempt: DataFrame) -> DataFrame:
    """Exemptions with a value: distinct categories, total value, code list, HS/OA/DV flags."""
    v = F.col("exempt_val")
    cat = F.col("exempt_cat")
    return (jur_exempt.where(v.isNotNull() & (v != ""))
            .select("acct", "exempt_cat", safe_num("exempt_val").alias("_v"))
            .groupBy("acct").agg(
                # exemption categories are a small code domain: count and list come from one set
                F.size(F.collect_set(cat)).cast("bigint").alias("exemption_count"),
                F.sum("_v").alias("total_exemption_value"),
                string_agg_distinct(cat, ", ").alias("exemption_codes"),
                F.bool_or(cat.like("HS%")).alias("has_homestead"),
                F.bool_or(cat.like("OA%")).alias("has_over_65"),
                F.bool_or(cat.like("DV%")).alias("has_disabled_veteran")))


__all__ = ["owners_agg", "fixture_counts", "extra_feature_summary", "recent_event_counts", "jur_value_sum",
           "building_summary", "protest_history", "hearing_history", "recent_sales", "recent_sales_priced",
           "exemption_summary"]
