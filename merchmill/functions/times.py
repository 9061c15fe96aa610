"""Times of the shop are wall-clock times without a zone (TIMESTAMP_NTZ), so a day never shifts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def timestamp_or(text: Column, default: datetime | None, pattern: str | None = None) -> Column:
    """Parse a wall-clock time; anything unreadable or missing becomes ``default`` (NULL if None)."""
    if pattern is None:
        parsed = text.try_cast("timestamp_ntz")
    else:
        parsed = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    return parsed if default is None else F.coalesce(parsed, F.lit(f"{default:%Y-%m-%d %H:%M:%S.%f}").cast("timestamp_ntz"))


def day_of(moment: Column) -> Column:
    return F.to_date(moment)
