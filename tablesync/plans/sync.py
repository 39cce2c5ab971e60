"""Sync modes, composed from the operators: as one DataFrame, and on stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tablesync.functions.types import column
from tablesync.operators.intake import intake
from tablesync.operators.merge import append, merge, merge_events
from tablesync.operators.resolve import require_keys, resolve, route
from tablesync.operators.schema import describe
from tablesync.sources.store import LoadResult, TableStore, content_label
from tablesync.spec import StreamSpec, SyncMode, free_name


def result_of(target: DataFrame | None, batch: DataFrame, spec: StreamSpec, large_batch: bool = False) -> DataFrame:
    """The table after one batch, as a lazy DataFrame; ``target=None`` is an empty table.

    ``large_batch`` picks the plan for a batch of about the target's size.
    """
    refresh = truncates(spec) or spec.mode is SyncMode.OVERWRITE
    if not spec.is_dedup:
        return batch if target is None or refresh else append(target, batch)
    batch = require_keys(batch, spec.keys)
    op = free_name(spec.names.op, batch.columns)
    if target is None or refresh:
        upserts, _ = route(resolve(batch, spec, op), op)
        return upserts
    if large_batch:
        return merge_events(target, batch, spec)
    return merge(target, resolve(batch, spec, op), spec.keys, op)


def truncates(spec: StreamSpec) -> bool:
    """Whether this sync replaces all older generations.

    Minimum generation 0 keeps everything, the current generation drops all others,
    and anything between is refused.
    """
    if spec.minimum_generation_id == 0:
        return False
    if spec.minimum_generation_id == spec.generation_id:
        return True
    raise ValueError(
        f"cannot refresh partly: current generation {spec.generation_id}, minimum generation {spec.minimum_generation_id}"
    )


def replaces(store: TableStore, spec: StreamSpec) -> bool:
    """Whether the next batch belongs to a refresh whose rows aren't in the table yet.

    Generation 0 stands for a source that doesn't number its refreshes: each of them replaces.
    """
    if truncates(spec):
        return not store.refreshed(spec)
    return spec.mode is SyncMode.OVERWRITE and (spec.generation_id == 0 or not store.refreshed(spec))


def sync(
    store: TableStore,
    spec: StreamSpec,
    records: DataFrame,
    raw_id: Column | None = None,
    extracted_at: Column | None = None,
    label: str | None = None,
    on_error: str = "fail",
    complete: bool = True,
) -> LoadResult:
    """Take in records and bring the stream's table up to date.

    Creates the table or evolves its columns first. ``label="content"`` names the
    batch by its rows, so that the same batch is applied once however often it is sent.

    A refresh is staged beside the table, which readers see unchanged until its last
    batch. Batches that are not the last have ``complete=False``; a batch sent again is
    skipped by its label before and after the refresh is put in place. Batches of the
    same generation that come later still are loaded like any other.
    """
    batch = intake(records, spec, raw_id, extracted_at)
    if label == "content":
        if raw_id is None and spec.names.extracted_at not in records.columns and extracted_at is None:
            raise ValueError("a content label needs extracted_at in the records: a clock value differs on each retry")
        label = content_label(batch, store.target(spec)[1])
    if replaces(store, spec):
        result = store.load(store.stage(spec, on_error), batch, label=label)
        if complete:
            store.promote(spec)
        return result
    store.ensure(spec, on_error)
    return store.load(spec, batch, label=label)


def final_layout(df: DataFrame, spec: StreamSpec) -> DataFrame:
    """Columns in table order: key columns first."""
    return df.select(*(column(c.name) for c in describe(spec).columns))
