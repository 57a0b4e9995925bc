"""DataFrame-to-DataFrame operators."""

from millrace.operators.aggregate import (
    best_of,
    conditional_means,
    distinct_counts,
    group_avg,
    group_mean_all_rows,
    group_rate,
    mode_by_group,
    row_count,
    top_group,
    value_counts,
    word_count,
)
from millrace.operators.chain import DropUnusual, Fence, Fill, Scale, chain, plan_levels
from millrace.operators.codes import category_codes
from millrace.operators.derive import (
    label_encode,
    log1p,
    minmax_apply,
    minmax_fit,
    pairwise,
    perturb,
    ratio,
    round_columns,
    sqrt_log,
    squares,
    standardize,
    string_index,
)
from millrace.operators.lookup import (
    impute_bernoulli,
    join_reference,
    mean_of_rates,
    range_lookup,
    rates_by_group,
    scale_rates,
)
from millrace.operators.missing import (
    Repair,
    binary_flag,
    clean_binary,
    impute,
    impute_from_votes,
    in_range,
    missing_profile,
    repair,
    replace_invalid,
    replace_out_of_range,
    row_sum,
    valid_code,
)
from millrace.operators.order_statistics import dense_codes, quantiles, running_total
from millrace.operators.outliers import (
    iqr_to_null,
    narrow_booleans,
    zscore_filter,
    zscore_filter_sequential,
)
from millrace.operators.profile import (
    binned_counts,
    box_stats,
    describe,
    mean_ci,
    pair_stats,
    qq_line,
    qq_points,
    qq_rows,
)
from millrace.operators.project import (
    apply_columns,
    cast_where,
    combine_columns,
    conditional,
    copy_column,
    drop_columns,
    drop_flagged,
    drop_missing,
    features_and_label,
    filter_between,
    filter_contains,
    filter_equal,
    filter_not_null,
    first_n,
    null_column,
    preview,
    rename,
    replace_columns,
    select_columns,
    trim_strings,
)
from millrace.operators.sampling import (
    kfold,
    random_split,
    sample,
    split_column,
    stratified_column,
    stratified_split,
)
from millrace.operators.setops import dedup_first, distinct_values, union_all
from millrace.operators.summary import exact_quantiles, merge, sketched_quantiles, summarise

__all__ = [name for name in dir() if not name.startswith("_")]
