"""Full change history of every key, with the time each version was replaced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tablesync.functions.types import column
from tablesync.operators.batches import part_of, range_sorted, row_in_part
from tablesync.spec import free_name


def change_history(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], valid_from: str, valid_to: str = "valid_to"
) -> DataFrame:
    """Every event kept; ``valid_to`` is ``valid_from`` of the key's next event, NULL for the last.

    A window over the key alone would put a hot key into one task. Here rows are
    sorted over all tasks by key and order, so a hot key spreads over many slices,
    and the window groups by slice and key. A key's last row in a slice takes its
    next event from the following slice's first row, if that is the same key: one
    row per slice, whatever the data size.
    """
    place, slice_id, head, following = (free_name(n, df.columns) for n in ("_place", "_slice", "_head", "_following"))
    later, found = free_name("_later", df.columns), free_name("_found", df.columns)
    sliced = range_sorted(df, [*keys, *order_by], place).withColumn(slice_id, part_of(place))

    own_key = F.struct(*(column(k).alias(f"k{i}") for i, k in enumerate(keys)))
    heads = sliced.filter(row_in_part(place) == 0).select(
        slice_id, F.struct(own_key.alias("key"), column(valid_from).alias("value")).alias(head)
    )
    followers = heads.select(slice_id, F.lead(head).over(Window.orderBy(slice_id)).alias(following))

    window = Window.partitionBy(slice_id, *(column(k) for k in keys)).orderBy(place)
    nexts = sliced.withColumn(later, F.lead(column(valid_from)).over(window)).withColumn(
        found, F.lead(F.lit(True)).over(window)
    )
    until = F.when(F.col(found), F.col(later)).when(
        F.col(following)["key"].eqNullSafe(own_key), F.col(following)["value"]
    )
    return nexts.join(F.broadcast(followers), slice_id).select(
        *(column(c) for c in df.columns), until.alias(valid_to)
    )
