from colfit.operators.curves import class_scores, confusion, curve_areas, threshold_curve
from colfit.operators.prep import (
    get_col_by_index,
    min_max_norm_cols,
    spread_vector,
    transform_cols,
    z_norm_cols,
)
from colfit.operators.rowindex import select_rows, split, with_row_index
from colfit.operators.softmax import softmax, softmax_columns, softmax_group_jacobian, softmax_jacobian

__all__ = [
    "class_scores",
    "confusion",
    "curve_areas",
    "get_col_by_index",
    "min_max_norm_cols",
    "select_rows",
    "softmax",
    "softmax_columns",
    "softmax_group_jacobian",
    "softmax_jacobian",
    "split",
    "spread_vector",
    "threshold_curve",
    "transform_cols",
    "with_row_index",
    "z_norm_cols",
]
