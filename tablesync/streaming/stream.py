"""Structured Streaming: micro-batches appended to files or merged into a stored table."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from tablesync.functions.types import column
from tablesync.operators.intake import intake
from tablesync.sources.records import as_columns, found_fields, parsed, rejected_spec, split, stored_fields, widened
from tablesync.sources.store import TableStore
from tablesync.spec import StreamSpec


def stream_append(records: DataFrame, path: str, checkpoint: str, available_now: bool = True, **options: str) -> StreamingQuery:
    """Append every record to parquet files, exactly once by the file sink's own log."""
    writer = (
        records.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .options(**options)
    )
    return _started(writer, available_now, path)


def stream_sync(
    records: DataFrame,
    store: TableStore,
    spec: StreamSpec,
    checkpoint: str,
    order_safe: bool = False,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Apply each micro-batch to the stream's table; the table itself is the keyed state.

    A micro-batch that runs again after a failure is skipped, because its number is
    published together with its data, under the id that the checkpoint folder holds: a
    new checkpoint starts over. Batches win in the order they run; with
    ``order_safe`` the greatest ``order_by`` wins whatever the batch order, and deletes
    stay as tombstones. ``prepare`` turns raw records into shaped ones; by default
    they are taken in as they are.
    """
    if not store.table_exists(*store.target(spec)):
        store.create_table(spec, tombstones=order_safe)
    elif order_safe and not store.is_order_safe(spec):
        raise ValueError("the table keeps no tombstones, so late batches could win; create it with tombstones=True")
    store.ensure(spec)
    shaped = prepare or (lambda df: intake(df, spec))

    def apply(batch: DataFrame, batch_id: int) -> None:
        query_id = json.loads(store.files.read_text(f"{checkpoint.rstrip('/')}/metadata"))["id"]
        store.load(spec, shaped(batch), progress=(query_id, batch_id))

    writer = records.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _started(writer, available_now)


def stream_texts(
    texts: DataFrame,
    text: str,
    store: TableStore,
    spec: StreamSpec,
    checkpoint: str,
    raw_id: Callable[[DataFrame], DataFrame],
    order_safe: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    """Apply records that come as JSON text, and let the table grow with the fields they have.

    Every micro-batch is searched for fields the table lacks; they are added before the
    batch is merged, so that a field that appears in a running stream is a column from there on.
    Whole numbers become decimals when others appear. Fields that stop coming stay, as NULL. Records that can't be
    read go to a table beside, under the batch's number. ``raw_id`` adds the envelope columns to the parsed records.
    """
    if not store.table_exists(*store.target(spec)):
        store.create_table(spec, tombstones=order_safe)
    elif order_safe and not store.is_order_safe(spec):
        raise ValueError("the table keeps no tombstones, so late batches could win; create it with tombstones=True")
    store.ensure(rejected_spec(spec))

    def apply(batch: DataFrame, batch_id: int) -> None:
        progress = (json.loads(store.files.read_text(f"{checkpoint.rstrip('/')}/metadata"))["id"], batch_id)
        # Read for the fields, then for the rows.
        records = raw_id(split(parsed(batch, text), spec.keys)).persist()
        try:
            wide = widened(stored_fields(store, spec), found_fields(records.filter("reason IS NULL")))
            store.ensure(wide)
            envelope = [wide.names.raw_id, wide.names.extracted_at]
            aside = rejected_spec(spec)
            bad = records.filter("reason IS NOT NULL").select(*(column(c) for c in envelope), column(text).alias("text"), "reason")
            store.load(aside, intake(bad, aside), progress=progress)
            good = as_columns(records.filter("reason IS NULL"), wide.fields, envelope)
            store.load(wide, intake(good, wide), progress=progress)
        finally:
            records.unpersist()

    writer = texts.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _started(writer, available_now)


def _started(writer, available_now: bool, *target: str) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(*target)
