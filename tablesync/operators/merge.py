"""Apply resolved operations to a table: append, keyed upsert, keyed delete, order-safe upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tablesync.functions.encode import op_code
from tablesync.functions.types import column
from tablesync.operators.resolve import last_event_per_key, route
from tablesync.spec import DELETE, UPSERT, StreamSpec, free_name


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Keep every row, duplicates included; a column one side lacks is NULL there."""
    return target.unionByName(batch, allowMissingColumns=True)


def delete_by_key(
    target: DataFrame, deletes: DataFrame, keys: Sequence[str], salt: int = 0, unique: bool = False
) -> DataFrame:
    """Rows of ``target`` whose key is not among ``deletes``. A NULL key matches nothing.

    The keys are made distinct before the shuffle, unless they are known to be
    ``unique``, so a key that is deleted very often weighs no more than others. AQE
    splits a skewed target side of an anti-join. Where a target without a unique key
    is known to have a hot one, ``salt`` spreads its rows over that many groups; only
    the key list is repeated.
    """
    wanted = deletes.select(*(column(k) for k in keys))
    if not unique:
        wanted = wanted.distinct()
    if salt < 2:
        return target.join(wanted, list(keys), "left_anti")
    name = free_name("_salt", target.columns)
    # A hash of the row, not a random number, so that a retried task sends rows to the same place.
    spread = F.pmod(F.xxhash64(*(column(c) for c in target.columns)), F.lit(salt)).cast("int")
    copies = wanted.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return target.withColumn(name, spread).join(copies, [*keys, name], "left_anti").drop(name)


def upsert(target: DataFrame, upserts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert rows, replacing those of the same key. ``upserts`` has one row per key."""
    return append(delete_by_key(target, upserts, keys, unique=True), upserts)


def merge(target: DataFrame, resolved: DataFrame, keys: Sequence[str], op: str = "__op") -> DataFrame:
    """Upserts and deletes of one batch as one result.

    All touched keys leave the target in one anti-join, then the upserts come in.
    Fits a batch that is small against its target: AQE then broadcasts the keys.
    """
    upserts, _ = route(resolved, op)
    return append(delete_by_key(target, resolved, keys, unique=True), upserts)


def merge_events(target: DataFrame, events: DataFrame, spec: StreamSpec) -> DataFrame:
    """Collapse a batch and merge it in one shuffle, for a batch of about the target's size.

    Stored rows rank below every event, so the latest event of a key wins and a key
    without events keeps its row. Both sides are aggregated before the shuffle.
    """
    rank = free_name("_rank", [*target.columns, *events.columns])
    op = free_name("_op", [*target.columns, *events.columns])
    stored = target.withColumn(rank, F.lit(0)).withColumn(op, F.lit(UPSERT))
    arrived = events.withColumn(rank, F.lit(1)).withColumn(op, op_code(spec))
    latest = last_event_per_key(append(stored, arrived), spec.keys, [rank, *spec.order_by])
    return latest.filter(F.col(op) == UPSERT).drop(rank, op).select(*(column(c) for c in target.columns))


def order_safe_upsert(stored: DataFrame, events: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep, per key, the row with the greatest order; an equal order lets the new row win.

    Both sides carry the operation code as a column, so a delete stays as a tombstone
    and a late, older upsert cannot revive the key. Read with ``live``.
    """
    rank = free_name("_rank", [*stored.columns, *events.columns])
    both = append(stored.withColumn(rank, F.lit(0)), events.withColumn(rank, F.lit(1)))
    return last_event_per_key(both, keys, [*order_by, rank]).drop(rank)


def live(stored: DataFrame, op: str = "__op") -> DataFrame:
    """Rows that are not tombstones."""
    return stored.filter(column(op) == UPSERT).drop(op)


def replay(copy: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A copy of a table after the changes (``_version``, ``_change`` and the row) that merges made to it since.

    Of several changes of a key the last one counts, so any number of versions is one merge.
    """
    version, kind, op = "_version", "_change", free_name("_op", changes.columns)
    final = changes.filter(F.col(kind) != "update_before").withColumn(op, F.when(F.col(kind) == "delete", DELETE).otherwise(UPSERT))
    latest = last_event_per_key(final.drop(kind), keys, [version])
    return merge(copy, latest.drop(version), keys, op)


def soft_live(df: DataFrame, spec: StreamSpec) -> DataFrame:
    """Rows of a soft-delete table that are not marked as deleted."""
    return df.filter(column(spec.names.deleted_at).isNull())


def cursor_increment(df: DataFrame, cursor: str, last_seen) -> DataFrame:
    """Rows past the last seen cursor value; all rows if there is none yet."""
    return df if last_seen is None else df.filter(column(cursor) > F.lit(last_seen))
