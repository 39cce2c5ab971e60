"""From events to operations: last event per key, then upserts and deletes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tablesync.functions.encode import op_code
from tablesync.functions.types import column
from tablesync.spec import DELETE, UPSERT, StreamSpec, free_name

UNORDERABLE = (T.MapType, T.VariantType)


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type)
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    return not isinstance(data_type, UNORDERABLE)


def last_event_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], count: str | None = None
) -> DataFrame:
    """The latest row of every key by ``order_by``; ``count`` adds how many rows the key had.

    The aggregation runs partially before the shuffle, so a hot key sends at most
    one row per map task. With the order columns first, the greatest struct is the
    latest row, and the other columns break ties the same way on every run.
    """
    rest = [c for c in df.columns if c not in order_by and c not in keys]
    order = [column(c) for c in order_by]
    packed = F.struct(*order, *(column(c) for c in rest))
    if all(_orderable(df.schema[c].dataType) for c in rest):
        latest = F.max(packed)
    else:
        latest = F.max_by(packed, F.struct(*order, *(column(c) for c in rest if _orderable(df.schema[c].dataType))))
    row = free_name("_row", df.columns)
    counted = [F.count(F.lit(1)).alias(count)] if count else []
    picked = df.groupBy(*(column(k) for k in keys)).agg(latest.alias(row), *counted)
    # Keys come from the grouping, so a reader of the keys alone gets a plain DISTINCT.
    columns = [column(c) if c in keys else F.col(row)[c].alias(c) for c in df.columns]
    return picked.select(*columns, *([count] if count else []))


def tied_keys(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], count: str = "n_tied") -> DataFrame:
    """Keys whose latest order value is shared by several rows, that value, and how many rows have it.

    For these the order does not say which row is the last one. Rows are counted per key and
    order before they are shuffled, and the greatest order is taken from these counts, so a
    hot key sends at most one row per map task and order value, and in the end one per task.
    """
    order = [column(c) for c in order_by]
    counted = df.groupBy(*(column(k) for k in keys), *(column(c) for c in order_by if c not in keys)).agg(F.count(F.lit(1)).alias(count))
    latest = free_name("_latest", [*df.columns, count])
    found = counted.groupBy(*(column(k) for k in keys)).agg(F.max(F.struct(*order, column(count))).alias(latest))
    shown = [F.col(latest)[c].alias(c) for c in order_by if c not in keys]
    return found.filter(F.col(latest)[count] > 1).select(*(column(k) for k in keys), *shown, F.col(latest)[count].alias(count))


def check_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error if the order leaves open which row of a key is the last one."""
    tied = tied_keys(df, keys, order_by).limit(3).collect()
    if tied:
        raise ValueError(f"{', '.join(order_by)} ties at the last row of keys such as {[tuple(r)[: len(keys)] for r in tied]}")
    return df


def last_event_window(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Same rows as ``last_event_per_key``, by ``row_number``.

    Spark limits each group to one row before the shuffle, so hot keys stay small here too.
    """
    rest = [c for c in df.columns if c not in order_by and _orderable(df.schema[c].dataType)]
    window = Window.partitionBy(*(column(k) for k in keys)).orderBy(*(column(c).desc() for c in [*order_by, *rest]))
    rank = free_name("_rank", df.columns)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def with_op(df: DataFrame, spec: StreamSpec, name: str | None = None) -> DataFrame:
    """Add the operation code under the spec's op name, or ``name``."""
    return df.withColumn(name or spec.names.op, op_code(spec))


def resolve(df: DataFrame, spec: StreamSpec, op: str | None = None) -> DataFrame:
    """Final operations of a batch: one row per key with its code; no collapse without a key."""
    if spec.is_dedup:
        df = last_event_per_key(df, spec.keys, spec.order_by)
    return with_op(df, spec, op)


def route(resolved: DataFrame, op: str = "__op") -> tuple[DataFrame, DataFrame]:
    """Disjoint (upserts, deletes) of rows that carry an operation code."""
    code = column(op)
    return resolved.filter(code == UPSERT).drop(op), resolved.filter(code == DELETE).drop(op)


def null_key(keys: Sequence[str]) -> Column:
    """True where any key column is NULL."""
    return reduce(lambda a, b: a | b, (column(k).isNull() for k in keys))


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; a row whose key is NULL fails the job when it is read."""
    if not keys:
        return df
    checked = F.when(null_key(keys), F.raise_error(F.lit(f"NULL in key columns {list(keys)}"))).otherwise(F.lit(True))
    return df.filter(checked)
