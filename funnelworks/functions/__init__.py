"""Column expressions (pure, JVM-side built-ins only)."""

from funnelworks.functions.arithmetic import (  # noqa: F401
    activity_density,
    days_between,
    exact_ratio,
    hours_between,
    list_count,
    ltv_estimate,
    safe_divide,
)
from funnelworks.functions.cleaning import (  # noqa: F401
    blank_to_null,
    clean_category_list,
    clean_timestamp,
    equals_flag,
    fix_millennium_date,
    in_list_flag,
    is_blank,
    month_label_to_date,
    normalize_value,
    not_in_list_flag,
    null_safe_sum,
    parse_european_numeric,
)
from funnelworks.functions.dates import cohort_month, derive_channel, has_cohort_anchor, month_trunc  # noqa: F401
from funnelworks.functions.keys import surrogate_key  # noqa: F401
from funnelworks.functions.scoring import conversion_tier, recency_bucket, speed_bucket  # noqa: F401
