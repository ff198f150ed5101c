"""Deterministic surrogate keys: md5 over the '-'-joined text of the key
columns, with nulls replaced by a fixed placeholder so that (null, 'a') and
('', 'a') hash differently.  Same text in, same key out, in any engine that
implements md5 over UTF-8 text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from funnelworks.functions._col import as_col

# Separator and null placeholder of the key text (the values
# used by the common warehouse key macro, so keys stay comparable).
KEY_SEPARATOR = "-"
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(NULL_PLACEHOLDER)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
