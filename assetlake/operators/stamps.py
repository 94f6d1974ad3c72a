"""Run time stamps: always a parameter, so a run can be repeated."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_stamp(run_ts: datetime | str) -> Column:
    """Literal of the run time as a wall-clock timestamp."""
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def run_day(run_ts: datetime | date | str) -> str:
    """The run's calendar day as ``yyyy-MM-dd``."""
    return str(run_ts)[:10]
