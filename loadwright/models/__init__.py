from loadwright.models.classify import (
    forest_fit, logit_fit, logit_predict, tree_nodes,
)
from loadwright.models.ols import (
    linear_predictor, ols_fit, ols_fit_stats, ols_predict, ols_summary_rows, regression_line,
    regression_points,
)

__all__ = [
    "forest_fit", "logit_fit", "logit_predict", "tree_nodes", "linear_predictor", "ols_fit",
    "ols_fit_stats", "ols_predict", "ols_summary_rows", "regression_line", "regression_points",
]
