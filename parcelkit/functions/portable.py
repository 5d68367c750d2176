"""Portable result encoding for cross-engine comparison.

Library outputs keep exact types (DECIMAL money, DATE). When a result is
compared with another engine, exact decimals are sent as DOUBLE (the decimal
is rounded once, so both engines produce the same double) and dates as ISO
``yyyy-MM-dd`` text (engines disagree on how a DATE reaches Python). Averages
that the library leaves unrounded (more decimals than a value has) are rounded
to four here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exprs import NUM


def portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = (F.round(c, 4) if f.dataType.scale > NUM.scale else c).cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)
