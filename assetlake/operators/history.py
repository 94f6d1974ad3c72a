"""Date-driven selections and history snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_of
from .merge import distinct_keys
from .stamps import run_day

# Fixed value: file record types left out of every history.
IGNORED_TYPES = ["IMAGE"]


def slice_of(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows of the named waves; prunes partitions when the table is split by the column."""
    return df.filter(F.col(column).isin(list(values)))


def on_day(column: str, day: str) -> Column:
    """``DATE(column) = day`` as a half-open range on the bare column, so it is pushed down."""
    start = date.fromisoformat(day)
    end = start + timedelta(days=1)
    return (F.col(column) >= F.lit(str(start)).cast("timestamp_ntz")) & (
        F.col(column) < F.lit(str(end)).cast("timestamp_ntz")
    )


def current_batch(df: DataFrame, run_ts, column: str = "Dt_updated") -> DataFrame:
    """Rows written on the day of the run."""
    return df.filter(on_day(column, run_day(run_ts)))


def history_window(
    df: DataFrame,
    run_ts,
    column: str = "updated_time_brazil",
    type_column: str = "type",
    days_back: int = 3,
    ignored: Sequence[str] = tuple(IGNORED_TYPES),
) -> DataFrame:
    """Rows of the look-back days whose type is known and not ignored."""
    since = date.fromisoformat(run_day(run_ts)) - timedelta(days=days_back)
    return df.filter(
        (F.col(column) >= F.lit(str(since)).cast("timestamp_ntz"))
        & ~F.col(type_column).isin(list(ignored))
    )


def _on_newest_day(df: DataFrame, column: str) -> Column:
    """Rows of the newest day, as a lower bound on the bare column."""
    newest = df.agg(F.max(day_of(F.col(column))).cast("timestamp_ntz")).scalar()
    return F.col(column) >= newest


def latest_batch(
    tasks: DataFrame, key: str = "name", column: str = "Dt_Updated", keys_unique: bool = False
) -> DataFrame:
    """Every row of any key that was updated on the newest day of the table.

    ``keys_unique`` says that no key has two rows, so these are the rows of that day themselves
    and nothing is joined.
    """
    if keys_unique:
        return tasks.filter(_on_newest_day(tasks, column) & F.col(key).isNotNull())
    fresh = distinct_keys(tasks.filter(_on_newest_day(tasks, column)), [key])
    return tasks.join(fresh, key, "left_semi").select(*tasks.columns)


def snapshot_history(
    rows: DataFrame,
    records: DataFrame,
    keys: Sequence[str] = ("CodOnda", "CodProcess"),
    column: str = "updated_time_brazil",
    type_column: str = "type",
    ignored: Sequence[str] = tuple(IGNORED_TYPES),
    rows_unique: bool = False,
) -> DataFrame:
    """Distinct rows whose keys have a record, of a kept type, on the newest record day.

    ``rows_unique`` says that the rows hold a key of their own, which saves the shuffle
    of whole rows for DISTINCT.
    """
    current = records.filter(
        _on_newest_day(records, column) & ~F.col(type_column).isin(list(ignored))
    )
    fresh = distinct_keys(current, keys)
    kept = rows.join(fresh, list(keys), "left_semi").select(*rows.columns)
    return kept if rows_unique else kept.distinct()
