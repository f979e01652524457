from seasonlab.operators.columns import (
    conditional_override,
    conditional_swap,
    drop_non_numeric,
    fill_from,
    map_values,
)
from seasonlab.operators.groups import (
    add_total,
    blend_means,
    group_sum,
    pivot_values,
    r2,
    share_percent,
    weighted_mean,
)
from seasonlab.operators.joins import (
    drop_bad_groups,
    except_keys,
    full_join,
    join_indicator,
    join_to_groups,
    prior_period,
    union_missing,
)
from seasonlab.operators.quality import (
    check_same_columns,
    count_violations,
    fd_violations,
    key_violations,
    null_counts,
    one_hot_violations,
    short_span_keys,
)
from seasonlab.operators.ranking import best_per_key, nth_best, number_groups, number_rows, top_n
from seasonlab.operators.rules import apply_rules

__all__ = [
    "add_total",
    "apply_rules",
    "best_per_key",
    "blend_means",
    "check_same_columns",
    "conditional_override",
    "conditional_swap",
    "count_violations",
    "drop_bad_groups",
    "drop_non_numeric",
    "except_keys",
    "fd_violations",
    "full_join",
    "fill_from",
    "group_sum",
    "join_indicator",
    "join_to_groups",
    "key_violations",
    "map_values",
    "nth_best",
    "null_counts",
    "number_groups",
    "number_rows",
    "one_hot_violations",
    "pivot_values",
    "prior_period",
    "r2",
    "share_percent",
    "short_span_keys",
    "top_n",
    "union_missing",
    "weighted_mean",
]
