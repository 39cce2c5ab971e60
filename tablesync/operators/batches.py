"""Cut a stream into load batches and give each batch a content label."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablesync.functions.compress import compress
from tablesync.functions.types import column, quote_identifier
from tablesync.session import work_dir
from tablesync.spec import MAX_RECORDS_PER_BATCH, free_name

# monotonically_increasing_id keeps the partition in the upper bits and the row in the lower 33.
ROW_BITS = 33


def range_sorted(df: DataFrame, order_by: Sequence[str], place: str) -> DataFrame:
    """Rows range-partitioned and sorted by ``order_by``, with ``place`` = partition and row in it.

    Ranges are taken over all order columns and last over the input position, so
    neither a hot value nor any number of equal rows ends up in one task, and equal
    rows keep their input order. The rows are checkpointed, which fixes the partitions
    even if executors are lost later.
    """
    work_dir(df.sparkSession)
    tie = free_name("_tie", [*df.columns, place])
    order = [*(column(c) for c in order_by), F.col(tie)]
    return (
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop(tie)
        .withColumn(place, F.monotonically_increasing_id())
        .checkpoint()
    )


def part_of(place: str) -> Column:
    return F.shiftright(F.col(place), ROW_BITS)


def row_in_part(place: str) -> Column:
    return F.col(place).bitwiseAND(F.lit((1 << ROW_BITS) - 1))


def with_row_index(df: DataFrame, order_by: Sequence[str], name: str = "row_index") -> DataFrame:
    """Number all rows from 0 in ``order_by`` order, without a single-task window.

    Rows are sorted over all tasks; each partition's first index is a running sum over
    one row per partition.
    """
    place, part, start = (free_name(n, df.columns) for n in ("_place", "_part", "_start"))
    placed = range_sorted(df, order_by, place).withColumn(part, part_of(place))
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias(start))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # One row per shuffle partition: small whatever the data size, so broadcasting is safe.
    starts = sizes.select(part, F.coalesce(F.sum(start).over(before), F.lit(0)).alias(start))
    return (
        placed.join(F.broadcast(starts), part)
        .withColumn(name, F.col(start) + row_in_part(place))
        .drop(place, part, start)
    )


def assign_batches(
    df: DataFrame,
    order_by: Sequence[str],
    max_records: int = MAX_RECORDS_PER_BATCH,
    batch: str = "batch_id",
    position: str | None = None,
    max_bytes: int | None = None,
    size: Column | None = None,
) -> DataFrame:
    """Cut rows in ``order_by`` order into consecutive batches of at most ``max_records``.

    ``position`` adds each row's place: within its batch, or within all rows if bytes
    count too. ``max_bytes`` also starts a new batch at every multiple of that many
    bytes, counted by ``size`` per row, so a batch exceeds it by less than one row;
    batch numbers then keep their order but may leave gaps.
    """
    if max_records < 1 or (max_bytes is not None and max_bytes < 1):
        raise ValueError("max_records and max_bytes must be at least 1")
    index = free_name("_index", df.columns)
    if max_bytes is None:
        numbered = with_row_index(df, order_by, index).withColumn(batch, F.expr(f"{index} div {max_records}"))
        place = F.col(index) % max_records
    else:
        if size is None:
            raise ValueError("max_bytes needs size")
        offset, length = free_name("_offset", df.columns), free_name("_length", df.columns)
        numbered = _with_offsets(df.withColumn(length, size.cast("long")), order_by, index, length, offset)
        # Both quotients never fall along the order, so their sum changes where either does.
        numbered = numbered.withColumn(
            batch, F.expr(f"{index} div {max_records} + {offset} div {max_bytes}")
        ).drop(offset, length)
        place = F.col(index)
    if position:
        numbered = numbered.withColumn(position, place.cast("int" if max_bytes is None else "long"))
    return numbered.drop(index)


def _with_offsets(df: DataFrame, order_by: Sequence[str], index: str, length: str, offset: str) -> DataFrame:
    """Row index, and bytes of all rows before, both in ``order_by`` order."""
    place, part, rows, size = (free_name(n, df.columns) for n in ("_place", "_part", "_rows", "_size"))
    placed = range_sorted(df, order_by, place).withColumn(part, part_of(place))
    # A window group is one sorted partition.
    within = Window.partitionBy(part).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(part).agg(F.count(F.lit(1)).alias(rows), F.sum(length).alias(size))
    starts = totals.select(part, *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in (rows, size)))
    running = placed.withColumn(offset, F.coalesce(F.sum(length).over(within), F.lit(0)))
    return (
        running.join(F.broadcast(starts), part)
        .withColumn(index, F.col(rows) + row_in_part(place))
        .withColumn(offset, F.col(size) + F.col(offset))
        .drop(place, part, rows, size)
    )


def assign_greedy(
    df: DataFrame,
    order_by: Sequence[str],
    max_records: int,
    max_bytes: int,
    size: Column,
    batch: str = "batch_id",
    position: str | None = None,
    block_rows: int = 1 << 16,
) -> DataFrame:
    """Cut rows in ``order_by`` order so that every batch is the longest that fits both bounds.

    A row larger than ``max_bytes`` is a batch of its own; a null size counts 0. ``position``
    adds each row's place in all rows. An empty table gives an empty result.

    Each row gets a pointer: where the next batch starts if one starts here. Pointers are
    followed within blocks of ``block_rows`` rows first, which leaves for each row where
    its chain enters a later block. Only rows that some chain enters are kept, and doubling
    their pointers finds those that the chain from the first row enters, in as many joins
    as the number of blocks has binary digits.
    """
    if min(max_records, max_bytes, block_rows) < 1:
        raise ValueError("max_records, max_bytes and block_rows must be at least 1")
    index, offset, length = (free_name(n, [*df.columns, batch]) for n in ("_index", "_offset", "_length"))
    sized = df.withColumn(length, F.coalesce(size.cast("long"), F.lit(0)))
    numbered = _with_offsets(sized, order_by, index, length, offset)
    narrow = numbered.select(F.col(index).alias("at"), F.col(offset).alias("start"), (F.col(offset) + F.col(length)).alias("end"))
    step = _successors(narrow, max_records, max_bytes).withColumn("block", F.expr(f"at div {block_rows}")).checkpoint()
    exits = step.groupBy("block").applyInPandas(_exits, "at long, leaves long")
    entered = _entered(exits.checkpoint()).withColumn("block", F.expr(f"at div {block_rows}"))
    marked = step.groupBy("block").cogroup(entered.groupBy("block")).applyInPandas(_marked, "block long, at long, nth long").checkpoint()
    starts = marked.groupBy("block").agg(F.max("nth").alias("n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per block of many rows goes through this window.
    starts = starts.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    cut = marked.join(starts, "block").select(F.col("at").alias(index), (F.col("before") + F.col("nth") - 1).alias(batch))
    rest = [column(c) for c in df.columns if c not in (batch, position)]
    place = [F.col(index).alias(position)] if position else []
    return numbered.drop(batch).join(cut, index).select(*rest, *place, column(batch))


def _successors(rows: DataFrame, max_records: int, max_bytes: int) -> DataFrame:
    """For each row, as ``next``, the first row that no longer fits a batch that starts there."""
    # Rows by their ends and questions by the last end that fits, in one order: a running count tells how many rows end in time.
    ends = rows.select(F.col("end").alias("value"), F.lit(0).alias("asks"), F.lit(None).cast("long").alias("at"), F.lit(1).cast("long").alias("row"))
    asked = rows.select((F.col("start") + max_bytes).alias("value"), F.lit(1).alias("asks"), "at", F.lit(0).cast("long").alias("row"))
    counted = _with_offsets(ends.unionByName(asked), ["value", "asks"], "number", "row", "fits").filter("asks = 1")
    return counted.select("at", F.least(F.col("at") + max_records, F.greatest(F.col("at") + 1, F.col("fits"))).alias("next"))


def _exits(block: pd.DataFrame) -> pd.DataFrame:
    """Where the chain of each row of a block leaves it."""
    block = block.sort_values("at")
    at, following = block["at"].to_numpy(), block["next"].to_numpy()
    inside = following <= at[-1]
    last = np.where(inside, following - at[0], np.arange(len(at)))
    while not (last[last] == last).all():
        last = last[last]
    return pd.DataFrame({"at": at, "leaves": following[last]})


def _entered(exits: DataFrame) -> DataFrame:
    """Rows, as ``at``, at which the chain from row 0 enters a block."""
    first = exits.sparkSession.range(1).select(F.col("id").alias("at"))
    entries = exits.select(F.col("leaves").alias("at")).unionByName(first).distinct()
    jumps = exits.join(entries, "at", "left_semi").checkpoint()
    found = first
    while not jumps.isEmpty():
        more = found.join(jumps, "at").select(F.col("leaves").alias("at"))
        found = found.unionByName(more).distinct().checkpoint()
        onward = jumps.select(F.col("at").alias("leaves"), F.col("leaves").alias("further"))
        jumps = jumps.join(onward, "leaves").select("at", F.col("further").alias("leaves")).checkpoint()
    return found


def _marked(block: pd.DataFrame, entered: pd.DataFrame) -> pd.DataFrame:
    """How many batches have started in a block up to each of its rows."""
    block = block.sort_values("at")
    at, following = block["at"].to_numpy(), block["next"].to_numpy()
    starts = np.zeros(len(at), dtype="int64")
    # The chain's end, one past the last row, may fall in the last block too.
    row = int(entered["at"].min() - at[0]) if len(entered) and len(at) else len(at)
    while row < len(at):
        starts[row] = 1
        row = int(following[row] - at[0])
    return pd.DataFrame({"block": block["block"].to_numpy(), "at": at, "nth": np.cumsum(starts)})


def label_prefix(table: str, prefix: str = "tablesync-") -> str:
    """Readable start of a label: the prefix and up to 48 characters of the table name."""
    return f"{prefix}{table[:48]}-"


def batch_labels(
    lines: DataFrame,
    table: str,
    batch: str = "batch_id",
    line: str = "line",
    order_by: Sequence[str] = (),
    prefix: str = "tablesync-",
    digest: str = "body",
) -> DataFrame:
    """One row per batch: its id, label and row count.

    ``digest="body"`` hashes the whole batch text, rows in ``order_by`` order (or
    sorted by their text) and ended by newlines. A group is one batch, which
    ``assign_batches`` bounds by rows, and for wide rows by bytes. ``digest="rows"``
    hashes every row first and then the sorted row hashes: 64 bytes per row however
    long the rows are.
    """
    if digest == "rows":
        lines, order_by = lines.select(column(batch), F.sha2(column(line), 256).alias(line)), ()
    elif digest != "body":
        raise ValueError(f"unknown digest {digest!r}")
    body = F.concat(F.array_join(_in_order(line, order_by), "\n"), F.lit("\n"))
    return lines.groupBy(column(batch).alias(batch)).agg(
        _label(table, prefix, body).alias("label"),
        F.count(F.lit(1)).alias("row_count"),
    )


def tree_labels(
    lines: DataFrame,
    table: str,
    position: str,
    batch: str = "batch_id",
    line: str = "line",
    prefix: str = "tablesync-",
    chunk_rows: int = 256,
) -> DataFrame:
    """One row per batch: its id, label and row count, by a tree of digests, so that no task holds a batch.

    Each row is hashed, then each stretch of ``chunk_rows`` positions by its rows' digests
    in order, then each batch by those of its stretches.
    """
    part, digest = "_chunk", "_digest"
    leaves = lines.select(
        column(batch).alias("_batch"), F.expr(f"{quote_identifier(position)} div {chunk_rows}").alias(part), column(position).alias("_at"), F.sha2(column(line), 256).alias(digest)
    )
    chunks = leaves.groupBy("_batch", part).agg(F.sha2(F.expr(f"listagg({digest}) WITHIN GROUP (ORDER BY _at)"), 256).alias(digest), F.count(F.lit(1)).alias("_rows"))
    found = chunks.groupBy("_batch").agg(F.expr(f"listagg({digest}) WITHIN GROUP (ORDER BY {part})").alias("_body"), F.sum("_rows").alias("row_count"))
    return found.select(F.col("_batch").alias(batch), _label(table, prefix, F.col("_body")).alias("label"), "row_count")


def batch_bodies(
    lines: DataFrame,
    table: str,
    layout: str,
    compression: str = "none",
    batch: str = "batch_id",
    line: str = "line",
    order_by: Sequence[str] = (),
    prefix: str = "tablesync-",
) -> DataFrame:
    """One row per batch: its id, label, row count and whole request body as bytes.

    A CSV body is its lines, each ended by a newline; a JSON body is one array. The
    label is taken before compression, so it does not depend on how a body is packed.
    """
    if layout not in ("csv", "json"):
        raise ValueError(f"unknown layout {layout!r}")
    if compression != "none" and layout != "json":
        raise ValueError(f"compression {compression!r} is for JSON, not for {layout}")
    ordered = _in_order(line, order_by)
    if layout == "csv":
        text = F.concat(F.array_join(ordered, "\n"), F.lit("\n"))
    else:
        text = F.concat(F.lit("["), F.array_join(ordered, ","), F.lit("]"))
    bodies = lines.groupBy(column(batch).alias(batch)).agg(text.alias("body"), F.count(F.lit(1)).alias("row_count"))
    packed = compress(F.col("body").cast("binary"), compression)
    return bodies.select(batch, _label(table, prefix, F.col("body")).alias("label"), "row_count", packed.alias("body"))


def _in_order(line: str, order_by: Sequence[str]) -> Column:
    """Lines of a group as an array in order; a batch holds a bounded number of rows."""
    items = F.struct(*(column(c).alias(f"o{i}") for i, c in enumerate(order_by)), column(line).alias("text"))
    return F.transform(F.array_sort(F.collect_list(items)), lambda item: item["text"])


def _label(table: str, prefix: str, body: Column) -> Column:
    return F.concat(F.lit(label_prefix(table, prefix)), F.sha2(body, 256))
