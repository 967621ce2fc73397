"""Display-time labels for chat messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chat_time_label(ts: Column, as_of: Column, tz: str = "UTC") -> Column:
    """"Today at h:mm AM/PM" when ``ts`` falls on the ``as_of`` date in
    ``tz``, else "M/D/YYYY" (calendar month, not zero-based).  ``ts`` is a
    UTC wall-clock timestamp (TIMESTAMP or TIMESTAMP_NTZ)."""
    local = F.from_utc_timestamp(ts.cast("timestamp"), tz)
    return (F.when(F.to_date(local) == as_of,
                   F.concat(F.lit("Today at "), F.date_format(local, "h:mm a")))
            .otherwise(F.date_format(local, "M/d/yyyy")))
