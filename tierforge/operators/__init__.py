from tierforge.operators.dedupe import dedupe_latest
from tierforge.operators.features import (
    days_between,
    delay_features,
    flag,
    month_bucket,
    on_time_label,
)
from tierforge.operators.lookup import join_preaggregated, left_lookup, translate
from tierforge.operators.profile import (
    distinct_counts,
    frequencies,
    profile_table,
    row_count,
    share_where,
    summarize,
)
from tierforge.operators.quality import (
    Rule,
    apply_rules,
    check_fk,
    fk_orphans,
    null_counts,
    require_not_null,
    require_pattern,
    require_range,
)
from tierforge.operators.reports import average, non_null_count, rollup_report, top_n, total
from tierforge.operators.text_ops import fill_text, has_text, map_values, standardize_text
from tierforge.operators.typing_ops import (
    blank_to_null,
    cast_columns,
    cast_report,
    default_if_blank,
    parse_timestamps,
)

__all__ = [
    "Rule",
    "apply_rules",
    "average",
    "blank_to_null",
    "cast_columns",
    "cast_report",
    "check_fk",
    "days_between",
    "dedupe_latest",
    "default_if_blank",
    "delay_features",
    "distinct_counts",
    "fill_text",
    "fk_orphans",
    "flag",
    "frequencies",
    "has_text",
    "join_preaggregated",
    "left_lookup",
    "map_values",
    "month_bucket",
    "non_null_count",
    "null_counts",
    "on_time_label",
    "parse_timestamps",
    "profile_table",
    "require_not_null",
    "require_pattern",
    "require_range",
    "rollup_report",
    "row_count",
    "share_where",
    "standardize_text",
    "summarize",
    "top_n",
    "total",
    "translate",
]
