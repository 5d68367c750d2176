"""Reference-shaped tables derived from the driver's test tables.

The yearly appraisal files are not shipped, so tests and registered queries
build all-text tables of the same *schema* from the TPC-H-like test tables.
These derivations only produce input rows; they do none of an operator's
work. The identical SQL text is used by Spark and by the DuckDB oracle.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

from .catalog import primary_key

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_MACROS = {
    "ACCT": "lpad(cast({0} as string), 13, '0')",
    "MDY": ("concat(lpad(cast(month({0}) as string),2,'0'),'/',lpad(cast(day({0}) as string),2,'0'),'/',"
            "cast(year({0}) as string))"),
    "MONEY": "cast(cast({0} as decimal(18,2)) as string)",
}

_RAW = {
    "real_acct": """
select ACCT(o_orderkey) as acct, cast(year(o_orderdate) as string) as yr, c_name as mailto,
 concat(cast(o_orderkey % 9999 as string), ' ', upper(substr(o_orderpriority,3)), ' ST') as site_addr_1, n_name as site_addr_2,
 concat('77', lpad(cast(c_nationkey as string),3,'0')) as site_addr_3, cast(o_orderkey % 9999 as string) as str_num,
 upper(substr(o_orderpriority,3)) as str, 'ST' as str_sfx, cast(null as string) as str_unit,
 case o_orderkey % 10 when 0 then 'B1' when 1 then 'B2' when 2 then 'A2' when 3 then 'C1' when 4 then 'F1' else 'A1' end as state_class,
 cast(n_regionkey as string) as school_dist, concat('12', lpad(cast(c_nationkey as string),2,'0'), '.50') as Neighborhood_Code,
 c_mktsegment as Market_Area_1,
 case when o_orderkey % 50 = 0 then '' when o_orderkey % 51 = 0 then 'N/A' else concat('$', cast(cast(o_totalprice as decimal(18,2)) * 4 as string)) end as tot_mkt_val,
 cast(cast(o_totalprice as decimal(18,2)) * 0.90 as string) as tot_appr_val, cast(cast(o_totalprice as decimal(18,2)) * 0.25 as string) as land_val, cast(cast(o_totalprice as decimal(18,2)) * 0.70 as string) as bld_val,
 cast(cast(o_totalprice as decimal(18,2)) * 0.05 as string) as x_features_val, '0' as ag_val, cast(o_orderkey % 7 * 1000 as string) as land_ar, cast(o_orderkey % 4 * 900 as string) as bld_ar
 from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "building_res": """
select ACCT(l_orderkey) as acct, cast(l_linenumber as string) as bld_num, cast(1000 + l_suppkey % 4 as string) as impr_tp, cast(1960 + l_partkey % 60 as string) as date_erected,
 case when l_suppkey % 3 = 0 then '0' else cast(1990 + l_suppkey % 30 as string) end as yr_remodel, concat('Class ', l_returnflag) as structure_dscr,
 substr(l_linestatus,1,1) as qa_cd, case when l_linestatus = 'O' then 'Average' else 'Good' end as dscr,
 case when l_quantity < 2 then '0' when l_quantity < 3 then '' else MONEY(l_quantity * 120) end as heat_ar, MONEY(l_quantity * 140) as gross_ar, MONEY(l_quantity * 130) as eff_ar,
 MONEY(l_quantity * 110) as im_sq_ft, MONEY(l_extendedprice) as cama_replacement_cost, MONEY(l_discount) as accrued_depr_pct
 from lineitem""",
    "fixtures": """
select ACCT(l_orderkey) as acct, cast(l_linenumber as string) as bld_num,
 case l_suppkey % 4 when 0 then 'RMB' when 1 then 'RMF' when 2 then 'RMH' else 'STY' end as type,
 case l_suppkey % 4 when 0 then 'Room:  Bedroom' when 1 then 'Room:  Full Bath' when 2 then 'Room:  Half Bath' else 'Story Height Index' end as type_dscr,
 cast(cast(l_quantity as bigint) % 6 as string) as units from lineitem""",
    "extra_features": """
select ACCT(l_orderkey) as acct, cast(l_linenumber as string) as bld_num, p_brand as cd, substr(p_type,1,10) as s_dscr,
 case when p_size > 45 then 'Gunite POOL' else p_name end as l_dscr, p_type as dscr from lineitem join part on l_partkey = p_partkey where l_returnflag = 'R'""",
    "owners": """
select ACCT(o_orderkey) as acct, '1' as ln_num, c_name as name, '100' as pct_own from orders join customer on o_custkey = c_custkey
 union all select ACCT(o_orderkey), '2', s_name, '50' from orders join supplier on o_orderkey % 100 = s_suppkey where o_orderstatus = 'P'""",
    "deeds": """
select ACCT(l_orderkey) as acct, case when l_partkey % 40 = 0 then '' else MDY(l_shipdate) end as dos, cast(year(l_shipdate) as string) as clerk_yr,
 concat('C', cast(l_suppkey as string)) as clerk_id, cast(l_partkey as string) as deed_id from lineitem where l_linestatus = 'F'""",
    "deeds_priced": """
select ACCT(l_orderkey) as acct, case when l_partkey % 40 = 0 then '' else MDY(l_shipdate) end as dos, cast(year(l_shipdate) as string) as clerk_yr,
 concat('C', cast(l_suppkey as string)) as clerk_id, cast(l_partkey as string) as deed_id, MONEY(l_extendedprice) as sale_price from lineitem where l_linestatus = 'F'""",
    "permits": """
select ACCT(l_orderkey) as acct, cast(l_partkey as string) as id, l_linestatus as status, cast(l_suppkey as string) as permit_type, MDY(l_shipdate) as issue_date from lineitem where l_linestatus = 'O'""",
    "jur_value": """
select ACCT(l_orderkey) as acct, lpad(cast(l_suppkey as string),3,'0') as tax_district, MONEY(l_extendedprice) as appraised_val, cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(18,2))) as string) as taxable_val from lineitem""",
    "jur_exempt": """
select ACCT(l_orderkey) as acct, lpad(cast(l_suppkey as string),3,'0') as tax_district,
 case l_linenumber % 4 when 0 then 'HS1' when 1 then 'OA2' when 2 then 'DV3' else 'XV' end as exempt_cat,
 case when l_quantity > 45 then '' else MONEY(l_quantity * 100) end as exempt_val from lineitem""",
    "arb_protest_real": """
select ACCT(cast(floor(event_id / 3) as bigint)) as acct, substr(event_type,1,6) as protested_by,
 concat(substr(MDY(ts),1,6), cast(year(ts) - cast(event_id % 3 as int) as string)) as protested_dt from events""",
    "arb_hearings_real": """
select ACCT(cast(floor(event_id / 4) as bigint)) as acct, cast(1992 + event_id % 11 as string) as Tax_Year, 'R' as Real_Personal_Property,
 case when event_id % 2 = 0 then 'I' else 'F' end as Hearing_Type, MDY(ts) as Actual_Hearing_Date, cast(user_id % 5 as string) as Letter_Type,
 cast(cast(value as decimal(18,2)) * 1000 as string) as Initial_Appraised_Value, cast(cast(value as decimal(18,2)) * (1000 - 50 * (event_id % 5)) as string) as Final_Appraised_Value from events""",
    "land": """
select ACCT(o_orderkey) as acct, '1' as num, cast(1000 + o_orderkey % 5 as string) as use_cd, cast(o_orderkey % 9 * 500 as string) as uts from orders
 union all select ACCT(o_orderkey), '2', '1000', '100' from orders where o_orderstatus = 'O'""",
    "ownership_history": """
select ACCT(l_orderkey) as acct, MDY(l_shipdate) as purchase_date, s_name as name, cast(null as string) as site_address from lineitem join supplier on l_suppkey = s_suppkey""",
    "desc_r_01_state_class": """
select * from (values ('A1','RES','Real, Residential, Single-Family'),('A2','RES','Real, Residential, Mobile Homes'),('B1','RES','Real, Residential, Multi-Family'),('B2','RES','Real, Residential, Two-Family'),('F1','COM','Real, Commercial')) t(Code,Dept,Description)""",
    "desc_r_15_land_usecode": """
select distinct cast(1000 + o_orderkey % 4 as string) as Code, concat('Use ', cast(o_orderkey % 4 as string)) as Description from orders""",
    "desc_r_20_school_district": """
select cast(r_regionkey as string) as Code, r_name as Description from region""",
    "desc_r_21_market_area": """
select distinct c_mktsegment as MktArea, concat('Area ', c_mktsegment) as Description from customer""",
    "desc_r_25_conclusion_code": """
select cast(r_regionkey as string) as Code, concat('Conclusion ', r_name) as Description from region""",
    "desc_r_12_real_jurisdictions": """
select lpad(cast(s_suppkey as string),3,'0') as Code, s_name as Description from supplier""",
    "real_neighborhood_code": """
select concat('12', lpad(cast(n_nationkey as string),2,'0'), '.50') as cd, cast(n_regionkey as string) as grp_cd, n_name as dscr from nation""",
    "desc_r_02_building_type_code": """
select distinct cast(1000 + s_suppkey % 3 as string) as Type, concat('Type ', cast(s_suppkey % 3 as string)) as Description from supplier""",
    "desc_r_07_quality_code": """
select * from (values ('F','Fair'),('O','Outstanding')) t(Code,Description)""",
    "desc_r_18_permit_status": """
select * from (values ('O','Open'),('F','Final')) t(Code,Description)""",
    "desc_r_19_permit_code": """
select cast(s_suppkey as string) as Code, concat('Permit ', s_name) as Description from supplier where s_suppkey % 5 <> 0""",
    "jur_exemption_dscr": """
select * from (values ('HS1','Homestead'),('OA2','Over 65'),('DV3','Disabled Veteran')) t(exempt_cat,exemption_dscr)""",
    "jur_tax_dist_exempt_value_rate": """
select 'R' as RP_TYPE, lpad(cast(s_suppkey as string),3,'0') as tax_dist, s_name as name, cast(null as string) as exempt_cd, cast(cast(s_suppkey % 9 as decimal(18,2)) * 0.10 as string) as prop, cast(cast(s_suppkey % 9 as decimal(18,2)) * 0.11 as string) as curr from supplier""",
    # parent restricted on purpose so the orphan operators have orphans to find
    "real_acct_not_p": """
select ACCT(o_orderkey) as acct from orders where o_orderstatus <> 'P'""",
}


def _expand(sql: str) -> str:
    """Expand ACCT(...), MDY(...), MONEY(...) macros (arguments may hold nested parentheses)."""
    out = sql
    for name, template in _MACROS.items():
        while True:
            m = re.search(rf"\b{name}\(", out)
            if not m:
                break
            depth, i = 1, m.end()
            while depth:
                depth += {"(": 1, ")": -1}.get(out[i], 0)
                i += 1
            arg = out[m.end():i - 1]
            out = out[:m.start()] + template.format(arg) + out[i:]
    return out


DERIVED_SQL: dict[str, str] = {k: _expand(v).strip() for k, v in _RAW.items()}
DERIVED = tuple(DERIVED_SQL)

# --- fixed values: default parameters of the registered queries ---------------
AS_OF = "2001-12-31"
PARAMS = {
    "as_of": AS_OF,
    "zip_code": "77007",
    "street": "URGENT",
    "neighborhood_prefix": "120",
    "neighborhood": "1211.50",
    "protest_year": 2024,
    "hearing_year": "2000",
    "acct": "0000000000042",
    "link_pattern": "/",
}


_DRIVER_CACHE: dict = {}


class Tables:
    """Lazy name -> DataFrame mapping over one test-data folder.

    Driver parquet tables are registered as temp views (the derivation SQL
    names them); derived tables are planned on first access and cached in
    this mapping as lazy DataFrames (nothing is computed here).
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def _driver(self, t: str) -> DataFrame:
        """The driver table ``t`` (read once per session and folder), registered as a temp view."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, t)
        df = _DRIVER_CACHE.get(key)
        if df is None:
            df = self.spark.read.parquet(os.path.join(self.sf_dir, f"{t}.parquet"))
            _DRIVER_CACHE[key] = df
        df.createOrReplaceTempView(t)
        return df

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in DERIVED_SQL:
                sql = DERIVED_SQL[name]
                for t in DRIVER_TABLES:
                    if re.search(rf"\b{t}\b", sql):
                        self._driver(t)
                self._frames[name] = self.spark.sql(sql)
            elif name in DRIVER_TABLES:
                self._frames[name] = self._driver(name)
            else:
                raise KeyError(name)
        return self._frames[name]

    def __contains__(self, name: str) -> bool:
        return name in DERIVED_SQL or name in DRIVER_TABLES

    def get(self, name: str, default=None):
        return self[name] if name in self else default

    def with_table(self, name: str, df: DataFrame) -> "Tables":
        """A copy of this mapping with ``name`` replaced (e.g. a de-duplicated table)."""
        other = Tables.__new__(Tables)
        other.spark, other.sf_dir = self.spark, self.sf_dir
        other._frames = dict(self._frames)
        other._frames[name] = df
        return other


def oracle_with(*names: str) -> str:
    """``WITH`` prefix defining the named derived tables for the DuckDB oracle."""
    return "WITH " + ",\n".join(f"{n} AS ({DERIVED_SQL[n]})" for n in names) + "\n"


DROP_ROWS = 1_000_000   # rows of a part file of write_text_drop: a compressed one is read by one task


def write_text_drop(tables, names, root: str, sort: bool = False) -> dict:
    """Write derived tables as a yearly text drop: one folder of tab-separated, gzipped part files per table.

    With ``sort`` the rows of a primary key are written by one task, in the order of their cells.

    Input construction only: every value is padded with a space on both sides
    (blank and NULL values are written as empty cells); the loader must undo it.
    Written by Spark, a part file per partition and ``DROP_ROWS`` rows. Returns ``table -> column names``.
    """
    from pyspark.sql import functions as F

    from .session import FREE_SHUFFLES, settings
    cols_by_table = {}
    for name in names:
        df = tables[name]
        cols = df.columns
        if sort:
            df = df.repartition(*primary_key(name)).sortWithinPartitions(*[F.coalesce(F.col(c), F.lit("")) for c in cols])
        padded = df.select(*[F.when(F.col(c).isNull() | (F.col(c) == ""), F.lit(""))
                             .otherwise(F.concat(F.lit(" "), F.col(c), F.lit(" "))).alias(c) for c in cols])
        with settings(padded.sparkSession, FREE_SHUFFLES):
            (padded.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "")
             .option("escape", "").option("emptyValue", "").option("nullValue", "").option("compression", "gzip")
             .option("maxRecordsPerFile", DROP_ROWS).csv(f"{root}/{name}"))
        cols_by_table[name] = cols
    return cols_by_table


ARCHIVE_ROWS = 5000     # rows of an archive that write_zip_drop aims at


def write_zip_drop(tables, name: str, root: str) -> None:
    """Write one derived table as ZIP archives of about ``ARCHIVE_ROWS`` rows (member ``<name>.txt`` with a header).

    Input construction only: rows are dealt by account number to as many archives as the table fills; each Spark task
    zips its own into the shared folder ``root`` (any file system Arrow can open). No rows pass through the driver.
    """
    import io
    import uuid
    import zipfile

    import pandas as pd
    from pyarrow import fs as pafs
    from pyspark.sql import functions as F

    from .session import qualified, ship_package
    df = tables[name]
    cols = df.columns
    ship_package(df.sparkSession)
    root = qualified(df.sparkSession, root)
    archives = max(1, -(-df.count() // ARCHIVE_ROWS))

    def write(key, pdf):
        lines = ["\t".join(cols)] + ["\t".join("" if v is None else str(v) for v in row)
                                     for row in pdf[cols].itertuples(index=False)]
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(f"{name}.txt", "\n".join(lines) + "\n")
        fs, folder = pafs.FileSystem.from_uri(root)
        fs.create_dir(folder, recursive=True)
        # published with a rename, so a retried task replaces its archive instead of adding a second one
        tmp, path = f"{folder}/.{uuid.uuid4().hex}.tmp", f"{folder}/{name}-{key[0]}.zip"
        with fs.open_output_stream(tmp, compression=None) as out:
            out.write(buf.getvalue())
        fs.move(tmp, path)
        return pd.DataFrame({"path": [path], "rows": [len(pdf)]})

    dealt = df.withColumn("_archive", F.col("acct").cast("long") % archives)
    (dealt.groupBy("_archive").applyInPandas(write, "path string, rows long")
     .write.format("noop").mode("overwrite").save())
