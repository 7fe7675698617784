from tidefeed.operators.aggregate import (
    column_mean,
    column_sum,
    group_sum,
    group_sum_island,
    group_sum_text,
    mean_alert,
    split_keys,
)
from tidefeed.operators.analyses import (
    alert_rows,
    alert_summary,
    linreg,
    pearson,
    stats,
    stats_by,
)
from tidefeed.operators.clean import (
    clean,
    clean_observed,
    drop_duplicate_rows,
    drop_sparse_columns,
    drop_sparse_rows,
)
from tidefeed.operators.merge import lookup_join, merge_three
from tidefeed.operators.routing import (
    allow_list,
    by_origin,
    check_union,
    listed_fields,
    filled_numbers,
    origin_of,
    split_union,
    union_fault,
    write_by_origin,
)
from tidefeed.operators.table import (
    Split,
    add_column,
    align_column,
    aligned,
    age_filter,
    append_rows,
    drop_keys,
    fitting_rows,
    keep_rows,
    remove_column,
    require_columns,
    require_numeric,
    split,
    threshold_flag,
    typed_rows,
)
from tidefeed.operators.validate import Rule, check_rows, learn_rules, valid_cell, validate

__all__ = [name for name in dir() if not name.startswith("_")]
