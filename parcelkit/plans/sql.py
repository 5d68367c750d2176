"""Read-only SQL over the registered tables and views.

The source exposed one read-only ``SELECT`` endpoint; here the same two guards
(statement starts with ``SELECT``, no ``;``) sit in front of ``spark.sql``.
Views are registered as temp views, so Catalyst expands and optimizes them
together with the query text; parameters are bound with ``args``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# --- fixed values ----------------------------------------------------------------
SELECT_RE = re.compile(r"^\s*SELECT\b", re.IGNORECASE)


def register(tables, names=None, views: dict[str, DataFrame] | None = None) -> None:
    """Register tables (a mapping) and extra view DataFrames as temp views."""
    for name in names or []:
        tables[name].createOrReplaceTempView(name)
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)


def sql_select(spark: SparkSession, text: str, args: dict | None = None) -> DataFrame:
    """Run one read-only SELECT; raise ``ValueError`` for anything else."""
    statements = (text or "").split(";")
    if len(statements) > 1 or not SELECT_RE.match(statements[0]):
        raise ValueError(f"sql_select runs exactly one SELECT, without a semicolon; got {text!r:.80}")
    return spark.sql(text, args=args) if args else spark.sql(text)
