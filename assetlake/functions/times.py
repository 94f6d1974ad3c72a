"""Timestamps as wall-clock values, independent of the session time zone.

Columns come in pairs: the UTC value and its UTC-3 twin.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default for unusable times, and the "never" date of task-flow exports.
DEFAULT_TIMESTAMP = "1990-01-01 00:00:00"
NEVER = "1900-01-01T00:00:00Z"

_ISO = (
    r"^\d{4}(-\d{2}-\d{2}|\d{4})"
    r"([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?([+-]\d{2}(:?\d{2})?)?)?Z?$"
)
_COMPACT_DATE = r"^(\d{4})(\d{2})(\d{2})"
_OFFSET = r"[T ].*([+-])(\d{2}):?(\d{2})?$"
_OFFSET_END = r"([T ].*)[+-]\d{2}(:?\d{2})?$"
_PLAIN = r"^\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}:\d{1,2})?$"


def brazil_time(utc: Column) -> Column:
    """The UTC-3 twin of a UTC wall-clock timestamp."""
    return utc - F.expr("INTERVAL 3 HOURS")


def day_of(timestamp: Column) -> Column:
    """Calendar day of a timestamp."""
    return F.to_date(timestamp)


def ts_from_millis(millis: Column) -> Column:
    """UTC wall-clock timestamp of epoch milliseconds."""
    origin = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return F.timestamp_add("MILLISECOND", millis, origin)


def ts_from_iso(text: Column, default: str | None = None, offset_rule: str = "utc") -> Column:
    """Timestamp of ISO text in whole seconds; ``default`` (or NULL) when unusable.

    ``offset_rule='utc'`` moves a value with an offset to UTC, ``'drop'`` keeps its
    wall clock.
    """
    iso = F.when(text.rlike(_ISO), F.regexp_replace(text, r"[.,]\d+|Z$", ""))
    clock = F.regexp_replace(iso, _OFFSET_END, "$1")
    value = F.regexp_replace(clock, _COMPACT_DATE, "$1-$2-$3").try_cast("timestamp_ntz")
    if offset_rule == "utc":
        sign = F.when(F.regexp_extract(iso, _OFFSET, 1) == "-", 1).otherwise(-1)
        hours = F.regexp_extract(iso, _OFFSET, 2).try_cast("int")
        minutes = F.coalesce(F.regexp_extract(iso, _OFFSET, 3).try_cast("int"), F.lit(0))
        moved = F.timestamp_add("MINUTE", sign * (hours * 60 + minutes), value)
        value = F.when(iso.rlike(_OFFSET), moved).otherwise(value)
    if default is None:
        return value
    return F.coalesce(value, F.lit(default).cast("timestamp_ntz"))


def ts_from_xml(text: Column) -> Column:
    """Timestamp of ``yyyy-MM-ddTHH:mm:ss[Z]`` or ``yyyy-MM-dd``; NULL for anything else."""
    bare = F.translate(F.regexp_replace(F.nullif(text, F.lit(NEVER)), "Z$", ""), "T", " ")
    return F.when(bare.rlike(_PLAIN), bare).try_cast("timestamp_ntz")
