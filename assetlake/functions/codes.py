"""Wave and process codes carried in object names, ids and asset names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wave codes accepted in package lists, and the object types kept.
VALID_WAVES = ["653", "673", "674", "684", "702"]
PACKAGE_TYPES = ["MTT", "TASKFLOW", "DTEMPLATE"]


def codes_by_digits(name: Column) -> tuple[Column, Column]:
    """First and second block of digits anywhere in the name."""
    blocks = F.regexp_extract_all(name, F.lit(r"(\d+)"), F.lit(1))
    return F.get(blocks, F.lit(0)), F.get(blocks, F.lit(1))


def codes_by_position(name: Column) -> tuple[Column, Column]:
    """Fourth and fifth ``_``-separated part of the name; NULLs for an empty name."""
    parts = F.split(name, "_")
    return F.get(parts, F.lit(3)), F.get(parts, F.lit(4))


def codes_by_type(
    name: Column, object_type: Column, valid_waves: list[str] = VALID_WAVES
) -> tuple[Column, Column]:
    """Integer codes by object type: parts 2 and 3 for task flows, 4 and 5 otherwise.

    A wave outside ``valid_waves`` or a process that is not a number makes both 0; an
    absent or empty process is 0.
    """
    parts = F.split(name, "_")
    first = F.when(object_type == "TASKFLOW", F.lit(1)).otherwise(F.lit(3))
    wave, process = F.get(parts, first), F.get(parts, first + 1)
    process_text = F.when(F.coalesce(process, F.lit("")) == "", F.lit("0")).otherwise(
        F.regexp_replace(process, r"^\s+|\s+$", "")
    )
    process_number = F.when(process_text.rlike(r"^[+-]?[0-9]+$"), process_text.try_cast("int"))
    good = F.coalesce(wave.isin(valid_waves), F.lit(False)) & process_number.isNotNull()
    zero = F.lit(0)
    return (
        F.when(good, wave.try_cast("int")).otherwise(zero),
        F.when(good, process_number).otherwise(zero),
    )


def strip_at(identifier: Column) -> Column:
    """The id without its leading ``@`` (only the first one)."""
    return F.regexp_replace(identifier, "^@", "")


def federated_id(identifier: Column) -> Column:
    """``saas:@`` in front of a non-empty id; empty and NULL stay."""
    return F.when(identifier != "", F.concat(F.lit("saas:@"), identifier)).otherwise(identifier)


def asset_name(path: Column, suffix: str) -> Column:
    """File name of a path without the archive suffix."""
    name = F.substring_index(F.translate(path, "\\", "/"), "/", -1)
    return F.replace(name, F.lit(suffix), F.lit(""))
