"""Table maintenance: keyed upsert, insert-ignore, slice replacement, cascade delete.

Rows of one key are reduced with ``max_by`` / ``min_by`` aggregates rather than a window:
the partial aggregate leaves at most one row per key and map task before the shuffle, so
a key that holds a large share of the batch never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import Table

_KEY, _LAST, _FIRST, _HASH = "_key", "_last", "_first", "_hash"


def _key(keys: Sequence[str]) -> Column:
    # Keys are compared as one struct: NULL parts are equal to each other, and grouping
    # and joining share one hash partitioning.
    return F.struct(*[F.col(k) for k in keys]).alias(_KEY)


def _arrival(order_cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order_cols])


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The last row of every key by ``order_cols``; NULLs of that row are kept."""
    others = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(
        F.max_by(F.struct(*others), _arrival(order_cols)).alias(_LAST)
    )
    return last.select(*keys, f"{_LAST}.*").select(*df.columns)


def collapse_batch(
    updates: DataFrame,
    keys: Sequence[str],
    insert_only: Sequence[str],
    order_cols: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """One row per key: insert-only columns of the first arrival, the others of the last."""
    if not keys:
        return updates.select(*columns)
    return _collapsed(updates, keys, insert_only, order_cols, columns).select(
        *_flat(keys, insert_only, columns)
    )


def _collapsed(updates, keys, insert_only, order_cols, columns) -> DataFrame:
    moving = [c for c in columns if c not in keys and c not in insert_only]
    aggregates = []
    if moving:
        aggregates.append(F.max_by(F.struct(*moving), _arrival(order_cols)).alias(_LAST))
    if insert_only:
        aggregates.append(F.min_by(F.struct(*insert_only), _arrival(order_cols)).alias(_FIRST))
    grouped = updates.groupBy(_key(keys))
    return grouped.agg(*aggregates) if aggregates else updates.select(_key(keys)).distinct()


def _flat(keys, insert_only, columns) -> list[Column]:
    def source(name: str) -> str:
        if name in keys:
            return _KEY
        return _FIRST if name in insert_only else _LAST

    return [F.col(source(c))[c].alias(c) for c in columns]


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    insert_only: Sequence[str] = (),
) -> DataFrame:
    """Target after inserting ``updates``, a key that is already there being updated.

    ``order_cols`` give the order of arrival inside the batch.  The target holds a key at
    most once; the result does too.
    """
    columns = target.columns
    batch = _collapsed(updates, keys, insert_only, order_cols, columns)
    return _merged(target, batch, keys, insert_only)


def _merged(target: DataFrame, batch: DataFrame, keys, insert_only, how: str = "full_outer") -> DataFrame:
    old = target.withColumn(_KEY, _key(keys)).withColumn("_present", F.lit(True))
    joined = old.join(batch, _KEY, how)
    is_old = F.col("_present").isNotNull()
    has_last = _LAST in batch.columns

    def pick(name: str) -> Column:
        if name in keys:
            return F.col(_KEY)[name].alias(name)
        if name in insert_only:
            return F.when(is_old, F.col(name)).otherwise(F.col(_FIRST)[name]).alias(name)
        updated = F.col(_LAST).isNotNull() if has_last else F.lit(False)
        return F.when(updated, F.col(_LAST)[name]).otherwise(F.col(name)).alias(name)

    return joined.select(*[pick(c) for c in target.columns])


def collapsed(updates: DataFrame, table: Table, order_cols: Sequence[str]) -> DataFrame:
    """A batch as one row per key: ``_key`` and the structs of its last and first values."""
    return _collapsed(updates, table.keys, table.insert_only, order_cols, table.columns)


def merged(target: DataFrame, batch: DataFrame, table: Table) -> DataFrame:
    """Target after inserting a collapsed batch, by one full join."""
    return _merged(target.select(*table.columns), batch, table.keys, table.insert_only)


def key_hash(table: Table) -> Column:
    """A number of a row's key: equal keys have equal numbers, different keys hardly ever."""
    return F.xxhash64(*[F.col(k) for k in table.keys]).alias(_HASH)


def repeated_hashes(rows: DataFrame, table: Table) -> DataFrame:
    """The key hashes of more than one row; only numbers are shuffled."""
    counted = rows.groupBy(key_hash(table)).agg(F.count("*").alias("_n"))
    return counted.filter(F.col("_n") > 1).select(_HASH)


def _split(rows: DataFrame, repeated: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """Rows whose key hash is their own, and the others."""
    hashed = rows.withColumn(_HASH, key_hash(table))
    return hashed.join(repeated, _HASH, "left_anti").drop(_HASH), hashed.join(repeated, _HASH, "left_semi").drop(_HASH)


def single_rows(rows: DataFrame, repeated: DataFrame, table: Table, order_cols: Sequence[str]) -> DataFrame:
    """:func:`collapse_batch` that reduces only the rows of repeated keys; the others pass as they are."""
    lone, others = _split(rows, repeated, table)
    reduced = collapse_batch(others, table.keys, table.insert_only, order_cols, table.columns)
    return lone.select(*table.columns).unionByName(reduced)


def collapsed_apart(rows: DataFrame, repeated: DataFrame, table: Table, order_cols: Sequence[str]) -> DataFrame:
    """:func:`collapsed` that reduces only the rows of repeated keys."""
    lone, others = _split(rows, repeated, table)
    return as_collapsed(lone, table).unionByName(collapsed(others, table, order_cols))


def as_collapsed(rows: DataFrame, table: Table) -> DataFrame:
    """Rows that hold each key once, in the form of :func:`collapsed`."""
    moving = [c for c in table.columns if c not in table.keys and c not in table.insert_only]
    parts = {_LAST: moving, _FIRST: list(table.insert_only)}
    return rows.select(_key(table.keys), *[F.struct(*names).alias(part) for part, names in parts.items() if names])


def lost_keys(target: DataFrame, batch: DataFrame, table: Table) -> DataFrame:
    """The keys of the target that a collapsed batch does not hold."""
    return target.select(_key(table.keys)).join(batch.select(_KEY), _KEY, "left_anti")


def replaced(target: DataFrame, batch: DataFrame, lost: DataFrame, table: Table) -> DataFrame:
    """The rows of :func:`merged`, from the target's keys that the batch does not hold.

    With few of these the target itself is not shuffled, only its keys and insert-only columns.
    """
    target = target.select(*table.columns)
    named = [*table.keys, *table.insert_only]
    slim = target.select(
        *[F.col(f.name) if f.name in named else F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema]
    )
    new = _merged(slim, batch, table.keys, table.insert_only, "right_outer")
    kept = target.withColumn(_KEY, _key(table.keys)).join(lost, _KEY, "left_semi").drop(_KEY)
    return new.unionByName(kept)


def held_keys(target: DataFrame, batch: DataFrame, table: Table) -> DataFrame:
    """The keys of a collapsed batch that the target holds."""
    return target.select(_key(table.keys)).join(batch.select(_KEY), _KEY, "left_semi")


def updated(target: DataFrame, batch: DataFrame, held: DataFrame, table: Table) -> DataFrame:
    """The rows of :func:`merged`, from the batch's keys that the target holds.

    The target meets the batch in a left join only, so with a small batch it is not shuffled.
    """
    old = _merged(target.select(*table.columns), batch, table.keys, table.insert_only, "left")
    fresh = batch.join(held, _KEY, "left_anti")
    return old.unionByName(fresh.select(*_flat(table.keys, table.insert_only, table.columns)))


def upsert_table(
    target: DataFrame, updates: DataFrame, table: Table, order_cols: Sequence[str]
) -> DataFrame:
    """:func:`upsert` by the keys and insert-only columns of a table."""
    return upsert(target.select(*table.columns), updates, table.keys, order_cols, table.insert_only)


def fresh_rows(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str] | None = None,
) -> DataFrame:
    """The updates whose key the target does not hold, one row per key.

    The first row of equal keys by ``order_cols`` is taken; without an order any of them,
    which is enough where the key is the whole row.
    """
    columns = target.columns
    others = [c for c in columns if c not in keys]
    if order_cols is None or not others:
        batch = updates.select(*columns).dropDuplicates(list(keys)).withColumn(_KEY, _key(keys))
    else:
        first = F.min_by(F.struct(*others), _arrival(order_cols)).alias(_FIRST)
        batch = updates.groupBy(_key(keys)).agg(first).select(_KEY, f"{_KEY}.*", f"{_FIRST}.*")
    return batch.join(target.select(_key(keys)), _KEY, "left_anti").select(*columns)


def insert_ignore(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Target plus the updates whose key is new."""
    return target.unionByName(fresh_rows(target, updates, keys, order_cols))


def replace_slice(
    target: DataFrame, rows: DataFrame, column: str, values: Sequence[str]
) -> DataFrame:
    """Target without the slices named by ``values``, plus the new rows."""
    kept = target.filter(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))
    return kept.unionByName(rows.select(*target.columns))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key of a frame once, for the small side of a semi or anti join.

    Grouping by a struct leaves the keys in a partitioning of their own, so the join
    shuffles them again by the plain keys.  Adaptive execution splits a hot key of the
    big side only when both sides of the join come straight from a shuffle.
    """
    return df.select(_key(keys)).distinct().select(f"{_KEY}.*")


def doomed_keys(parent: DataFrame, predicate: Column, key: str) -> DataFrame:
    """Keys of the parent rows that match, each once."""
    return distinct_keys(parent.filter(predicate), [key])


def without_keys(df: DataFrame, doomed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the doomed ones; rows without a key stay."""
    return df.join(doomed, key, "left_anti").select(*df.columns)


def cascade_delete(
    tables: dict[str, DataFrame], parent: str, predicate: Column, key: str
) -> dict[str, DataFrame]:
    """Every table without the rows that belong to the matching parent rows."""
    doomed = doomed_keys(tables[parent], predicate, key)
    return {name: without_keys(df, doomed, key) for name, df in tables.items()}
