"""Scalar and aggregate Column helpers with the source database's semantics.

Everything here returns a ``pyspark.sql.Column`` built from built-in functions,
so it is inlined into whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Exact type for sanitised money / area values: 20 integer digits, 6 decimals. The widest that leaves quotients of two
# such values enough decimals to be rounded once; `safe_num_loss` marks what does not fit.
NUM = T.DecimalType(26, 6)

TEXT_BYTES = 14                         # of a text_number: two limbs of 7 bytes
_LIMB = Decimal(1 << 56)

# --- fixed values ------------------------------------------------------------
# safe_num keeps only these characters before the numeric cast
SAFE_NUM_KEEP = r"[^0-9.]"
# dates in the yearly files are written month/day/year (one or two digits)
MDY_PATTERN = "M/d/yyyy"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_num(col) -> Column:
    """Text -> exact decimal: keep only digits and dots, blank -> NULL.

    Mirrors the source ``safe_num``: the minus sign is dropped (``-5`` -> 5),
    exponents collapse (``1e5`` -> 15). Inputs that are still not a number
    (``1.2.3``, ``.``) become NULL instead of failing the whole query, and so
    do values with more than 20 integer digits; decimals past the sixth are
    rounded. :func:`safe_num_loss` marks both.
    """
    digits = F.regexp_replace(_c(col), SAFE_NUM_KEEP, "")
    return F.nullif(digits, F.lit("")).try_cast(NUM)


def safe_num_loss(col) -> Column:
    """Whether a cell is a number that ``safe_num`` cannot hold exactly (too many integer digits or decimals)."""
    digits = F.regexp_replace(_c(col), SAFE_NUM_KEEP, "")
    number = digits.rlike(r"^[0-9]*[.]?[0-9]*$") & digits.rlike("[0-9]")
    whole = F.length(F.regexp_extract(digits, r"^0*([0-9]*)", 1)) > NUM.precision - NUM.scale
    return F.coalesce(number & (whole | digits.rlike(f"[.][0-9]{{{NUM.scale}}}[0-9]*[1-9]")), F.lit(False))


def parse_mdy(col) -> Column:
    """Parse ``MM/DD/YYYY`` (leading zeros optional) text to DATE; bad or blank -> NULL."""
    return F.try_to_date(F.nullif(_c(col), F.lit("")), MDY_PATTERN)


def pg_int(col) -> Column:
    """numeric -> int rounding half away from zero (Spark's plain cast truncates)."""
    return F.round(_c(col), 0).cast("int")


def years_before(as_of, years: int) -> Column:
    """``as_of - INTERVAL 'n years'`` as a DATE column (29 Feb maps to 28 Feb)."""
    return F.add_months(as_date_lit(as_of), -12 * int(years))


def as_date_lit(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of).cast("date")


def text_number(col) -> Column:
    """A number of fixed width that orders texts as their UTF-8 bytes do, by their first ``TEXT_BYTES`` bytes.

    A maximum of such numbers is a hash aggregate, a maximum of texts is not. :func:`number_text` gives the text back;
    a longer one counts, and comes back, as its first bytes. Texts hold no NUL (the loader deletes them).
    """
    digits = F.rpad(F.substring(F.hex(_c(col)), 1, 2 * TEXT_BYTES), 2 * TEXT_BYTES, "0")
    high, low = (F.conv(F.substring(digits, at, TEXT_BYTES), 16, 10).cast("decimal(17,0)") for at in (1, 1 + TEXT_BYTES))
    return (high * F.lit(_LIMB) + low).cast("decimal(38,0)")


def number_text(col) -> Column:
    """The text of a :func:`text_number`."""
    high = F.floor(_c(col) / F.lit(_LIMB)).cast("decimal(17,0)")
    low = (_c(col) - high * F.lit(_LIMB)).cast("decimal(17,0)")
    digits = F.concat(*[F.lpad(F.hex(x.cast("long")), TEXT_BYTES, "0") for x in (high, low)])
    return F.rtrim(F.decode(F.unhex(digits), "UTF-8"), F.lit("\0"))


def string_agg_distinct(col, sep: str) -> Column:
    """``STRING_AGG(DISTINCT x, sep)`` with a deterministic (sorted) order; empty group -> NULL.

    ``collect_set`` is partially aggregated map-side, so the per-group buffer
    holds the distinct values only.
    """
    s = F.array_sort(F.collect_set(_c(col)))
    return F.when(F.size(s) > 0, F.array_join(s, sep))


def string_agg_ordered(value, order, sep: str) -> Column:
    """``STRING_AGG(value, sep)`` ordered by ``order`` then value; NULL values skipped; empty -> NULL."""
    v = _c(value)
    items = F.array_sort(F.collect_list(F.when(v.isNotNull(), F.struct(_c(order).alias("o"), v.alias("v")))))
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, lambda x: x["v"]), sep))


def avg_round(col, digits: int) -> Column:
    """``ROUND(AVG(x), n)`` computed exactly on decimals, returned as DOUBLE."""
    return F.round(F.avg(_c(col).cast(T.DecimalType(32, 6))), digits).cast("double")


def asc(col) -> Column:
    """ORDER BY x ASC with the source database's NULL placement (NULLs last)."""
    return _c(col).asc_nulls_last()


def desc(col) -> Column:
    """ORDER BY x DESC with the source database's NULL placement (NULLs first)."""
    return _c(col).desc_nulls_first()


def street_match(addr_col, street_col, street: str, zip_col=None, zip_code: str | None = None,
                 suffix: str = "ST") -> Column:
    """``addr ILIKE '%<street> <suffix>%' OR UPPER(street) = <street>`` (optionally AND zip)."""
    cond = _c(addr_col).ilike(f"%{street} {suffix}%") | (F.upper(_c(street_col)) == F.lit(street.upper()))
    if zip_col is not None:
        cond = (_c(zip_col) == F.lit(zip_code)) & cond
    return cond
