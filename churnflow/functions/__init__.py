from churnflow.functions.columns import (
    EPOCH,
    as_date,
    date_literal,
    fail_when,
    latest_date,
    normalized_text,
    parse_day_month_year,
    split_bucket,
    timestamp_literal,
    whole_id,
)

__all__ = [
    "EPOCH",
    "as_date",
    "date_literal",
    "fail_when",
    "latest_date",
    "normalized_text",
    "parse_day_month_year",
    "split_bucket",
    "timestamp_literal",
    "whole_id",
]
