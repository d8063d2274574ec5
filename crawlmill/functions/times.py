"""Explicit times: no operator reads the clock."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(moment: datetime) -> Column:
    """A time without time zone as a literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


# Some thousand years: what is added stays within the times that a timestamp can hold.
_LONGEST = 100_000_000_000


def plus_seconds(moment: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", F.least(seconds.cast("long"), F.lit(_LONGEST)), moment)
