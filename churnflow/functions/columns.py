"""Column expressions shared by the operators. All are built-in functions, so they stay in the JVM."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

# Stands for "never": the date given to customers without any recorded activity.
EPOCH = date(1970, 1, 1)


def normalized_text(text: Column) -> Column:
    """Upper case without surrounding spaces. An empty string stays empty; it does not become NULL."""
    return F.upper(F.trim(text))


def parse_day_month_year(text: Column) -> Column:
    """``14/1/2023`` or ``14/01/2023`` to a date. Bad text raises under ANSI mode, the default."""
    return F.to_date(text, "d/M/yyyy")


def whole_id(number: Column) -> Column:
    """Decimal id to bigint, rounding half away from zero (a bare cast would truncate)."""
    return F.round(number).cast("bigint")


def as_date(day: date | str) -> date:
    return date.fromisoformat(day) if isinstance(day, str) else day


def date_literal(day: date | str) -> Column:
    return F.lit(as_date(day))


def timestamp_literal(moment: datetime) -> Column:
    """A fixed instant. A datetime without a zone is read as UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.lit(moment.isoformat()).cast("timestamp")


def latest_date(*days: Column) -> Column:
    """The latest of several dates, with a missing one counted as 1970-01-01; never NULL."""
    floor = date_literal(EPOCH)
    return F.greatest(*(F.coalesce(day, floor) for day in days))


def fail_when(broken: Column, message: Column, value: Column, kind: DataType) -> Column:
    """``value``, or an error carrying ``message`` for a row where ``broken`` holds."""
    return F.when(broken, F.raise_error(message).cast(kind)).otherwise(value)


def split_bucket(*key: Column, buckets: int = 100) -> Column:
    """A bucket, 0..99 by default, from the row's key alone, so it never depends on partitioning or row order."""
    digest = F.md5(F.concat_ws("|", *(part.cast("string") for part in key)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets
