"""Column-level building blocks: indicator flags and the feature registry."""

from daybook.functions.features import (
    CORRECTED_FEATURES,
    FEATURES,
    Feature,
    select_features,
)
from daybook.functions.flags import (
    FLAG_COLUMNS,
    code_flag,
    flag_columns,
    flag_sql,
    json_answers,
    one_hot,
)

__all__ = [
    "CORRECTED_FEATURES",
    "FEATURES",
    "FLAG_COLUMNS",
    "Feature",
    "code_flag",
    "flag_columns",
    "flag_sql",
    "json_answers",
    "one_hot",
    "select_features",
]
