"""Column expressions shared by batch and streaming jobs."""

from rillflow.functions.columns import (
    age_years,
    compute_once,
    copy_fields,
    day_from_text,
    day_of_millis,
    hour_from_text,
    hour_of_millis,
    join_values,
    op_code,
    previous_day,
    reversed_key,
    salted_key,
    seconds_to_time,
    split_at,
)
from rillflow.functions.text import (
    analysed,
    contains_all,
    contains_any,
    contains_phrase,
    highlight,
    match_score,
    query_tokens,
    words,
)

__all__ = [
    "age_years", "analysed", "compute_once", "contains_all", "contains_any",
    "contains_phrase", "copy_fields", "day_from_text", "day_of_millis", "highlight",
    "hour_from_text", "hour_of_millis", "join_values", "match_score", "op_code",
    "previous_day", "query_tokens", "reversed_key", "salted_key",
    "seconds_to_time", "split_at", "words",
]
