"""Cleaning expressions for loosely typed CRM / finance exports.

Every function maps Column(s) to a Column built from JVM-side built-ins, so it
stays inside whole-stage codegen and can be used on any table: the caller
passes the column.  ANSI mode is assumed (malformed text raises instead of
silently turning into null), the same contract as the warehouse casts the
models were specified against.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from funnelworks.functions._col import as_col

# Sentinel texts that mean "no date" in the raw exports.
NO_DATE_TEXTS = ("", "0001-01-01")
# Characters removed from a stringified list "['a', 'b']".
LIST_NOISE_PATTERN = r"[\[\]' ]"
# Characters kept when reading a European-formatted amount.
EURO_KEEP_PATTERN = r"[^0-9,]"


def blank_to_null(col: Column | str) -> Column:
    """Trimmed text, with an empty result turned into null."""
    return F.nullif(F.trim(as_col(col)), F.lit(""))


def is_blank(col: Column | str) -> Column:
    """True for null, empty or whitespace-only text (never null itself)."""
    return F.coalesce(F.trim(as_col(col)), F.lit("")) == F.lit("")


def fix_millennium_date(col: Column | str) -> Column:
    """Repair dates exported with a two-digit century ("0024-03-05").

    Null, '' and '0001-01-01' become null; otherwise the first two characters
    of the text are overwritten with "20" and the result is cast to a date.
    The overwrite is blind: "1999-03-05" becomes 2099-03-05.
    """
    text = as_col(col).cast("string")
    return F.when(~text.isin(*NO_DATE_TEXTS), F.overlay(text, F.lit("20"), 1, 2).cast("date"))


def clean_timestamp(col: Column | str) -> Column:
    """Trimmed text → timestamp without zone; blank → null."""
    return F.nullif(F.trim(as_col(col).cast("string")), F.lit("")).cast("timestamp_ntz")


def clean_category_list(col: Column | str) -> Column:
    """"['Uber Eats', 'DoorDash']" → "UberEats,DoorDash"; empty lists → null.

    Brackets, single quotes and every space are removed, so the separator of
    the result is a bare comma.
    """
    return F.nullif(F.regexp_replace(F.trim(as_col(col)), LIST_NOISE_PATTERN, ""), F.lit(""))


def parse_european_numeric(col: Column | str, precision: int = 12, scale: int = 2) -> Column:
    """"US$\\t55\\u00a0779,40" → 55779.40 as decimal(precision, scale).

    Null or blank text gives null.  Everything except digits and the comma is
    dropped (currency, tab, NBSP, dots, minus) and the comma becomes the
    decimal point; text with two commas raises under ANSI.
    """
    c = as_col(col)
    digits = F.replace(F.regexp_replace(F.trim(c), EURO_KEEP_PATTERN, ""), F.lit(","), F.lit("."))
    return F.when(~is_blank(c), digits.cast(f"decimal({precision},{scale})"))


def month_label_to_date(col: Column | str) -> Column:
    """"Jan-24" → 2024-01-01."""
    return F.to_date(F.concat(F.lit("01-"), as_col(col)), "dd-MMM-yy")


def normalize_value(col: Column | str, mapping: dict[str, str]) -> Column:
    """Replace listed dirty spellings, pass everything else through."""
    c = as_col(col)
    out = None
    for dirty, clean in mapping.items():
        out = F.when(c == dirty, F.lit(clean)) if out is None else out.when(c == dirty, F.lit(clean))
    return c if out is None else out.otherwise(c)


def equals_flag(col: Column | str, value) -> Column:
    """col = value as a two-valued flag (null input → false)."""
    return F.coalesce(as_col(col) == F.lit(value), F.lit(False))


def in_list_flag(col: Column | str, values: Iterable) -> Column:
    """col IN values as a two-valued flag (null input → false)."""
    return F.coalesce(as_col(col).isin(*list(values)), F.lit(False))


def not_in_list_flag(col: Column | str, values: Iterable) -> Column:
    """col NOT IN values as a two-valued flag (null input → false)."""
    return F.coalesce(~as_col(col).isin(*list(values)), F.lit(False))


def null_safe_sum(*cols: Column | str) -> Column:
    """Sum of the columns with nulls counted as zero."""
    total = None
    for c in cols:
        term = F.coalesce(as_col(c), F.lit(0))
        total = term if total is None else total + term
    return total
