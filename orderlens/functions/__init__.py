"""Scalar column functions."""

from orderlens.functions.scalar import (  # noqa: F401
    DAY_NAMES_ES,
    MONTH_NAMES_ES,
    NA_TOKEN,
    all_finite_nonneg,
    argmax_index,
    clamp,
    clean_text,
    day_name,
    index_to_label,
    month_name,
    quarter,
    to_json_record,
    to_numeric,
    to_numeric_typed,
    to_timestamp_lenient,
    truncate_to_int,
    uri_tail,
    weekday_monday0,
    with_na_token,
)
