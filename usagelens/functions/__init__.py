from usagelens.functions.columns import lenient_double, lenient_int, numeric_columns, resolve
from usagelens.functions.dates import day_of, day_range
from usagelens.functions.scores import correlation, f1_score, hard_auc, r_squared

__all__ = [
    "correlation",
    "day_of",
    "day_range",
    "f1_score",
    "hard_auc",
    "lenient_double",
    "lenient_int",
    "numeric_columns",
    "r_squared",
    "resolve",
]
