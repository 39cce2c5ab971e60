"""The flush of a run: cut into batches, labelled, written and published, and continued where a run stopped."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablesync.functions.encode import csv_line
from tablesync.functions.types import column
from tablesync.operators.batches import assign_batches, tree_labels
from tablesync.operators.intake import intake
from tablesync.operators.ledger import LABEL_EXISTS, SUCCESS, load_accounting, load_outcomes, pending, require_loaded
from tablesync.operators.resolve import with_op
from tablesync.session import new_work_path
from tablesync.sources.store import TableStore
from tablesync.spec import MAX_RECORDS_PER_BATCH, StreamSpec, free_name

#: Batches that are written by one job and published together.
COMMIT_BATCHES = 1000


def flush(
    store: TableStore,
    spec: StreamSpec,
    records: DataFrame,
    order_by: Sequence[str],
    raw_id: Column | None = None,
    extracted_at: Column | None = None,
    max_records: int = MAX_RECORDS_PER_BATCH,
    commit_batches: int = COMMIT_BATCHES,
    most_commits: int | None = None,
) -> DataFrame:
    """Load records in batches and return what became of each: ``batch_id``, ``label``, counts, ``status`` and ``outcome``.

    Records are cut in ``order_by`` order into batches, and each batch is labelled by its
    content. Batches whose label the table's ledger holds are not loaded again, nor
    is the second of two equal batches. The others are written ``commit_batches`` at a time,
    one job for all of them, and become visible together with their ledger rows. So a run that ended
    half-way is simply started again with the same records: what it has published is skipped.
    ``most_commits`` ends a run early on purpose; batches it has not come to have no status.
    """
    store.ensure(spec)
    table = store.target(spec)
    rows, plan = _planned(store, spec, intake(records, spec, raw_id, extracted_at), order_by, max_records)
    for number, _ in enumerate(_commits(store, spec, rows, plan, commit_batches, most_commits)):
        if most_commits is not None and number + 1 >= most_commits:
            break
    loaded = store.known_labels(*table).withColumn("present", F.lit(True))
    status = F.when(F.col("known"), LABEL_EXISTS).when(F.col("present"), SUCCESS)
    outcomes = plan.join(loaded, "label", "left").withColumn("status", status)
    done = load_outcomes(outcomes.filter(F.col("status").isNotNull()) if most_commits is not None else outcomes)
    return require_loaded(done, describe=("label",)).select("batch_id", "label", "buffered", "upserts", "deletes", "status", "outcome")


def _planned(store: TableStore, spec: StreamSpec, batch: DataFrame, order_by: Sequence[str], max_records: int) -> tuple[DataFrame, DataFrame]:
    """The rows with the batch each belongs to, sorted by it, and one row for each batch. Both are written, so all commits see the same."""
    number, position = (free_name(n, batch.columns) for n in ("_batch", "_position"))
    path = new_work_path(store.spark, "flush")
    # Files cover narrow ranges of batches, so a commit reads only its own.
    cut = assign_batches(batch, order_by, max_records, batch=number, position=position)
    cut.write.parquet(f"{path}/rows")
    cut = store.spark.read.schema(cut.schema).parquet(f"{path}/rows")
    lines = cut.select(column(number).alias("batch_id"), column(position).alias("position"), csv_line(cut.select(*batch.columns)).alias("line"))
    labels = tree_labels(lines, store.target(spec)[1], "position").drop("row_count")
    op = free_name(spec.names.op, cut.columns)
    accounts = load_accounting(with_op(cut, spec, op), [number], op).withColumnRenamed(number, "batch_id")
    plan = labels.join(accounts, "batch_id")
    new = pending(plan, store.known_labels(*store.target(spec)))
    # Of equal batches of one run the first is loaded.
    first = new.groupBy("label").agg(F.min("batch_id").alias("batch_id")).withColumn("first", F.lit(True))
    plan = plan.join(first, ["label", "batch_id"], "left").withColumn("known", F.col("first").isNull()).drop("first")
    plan.write.parquet(f"{path}/plan")
    return cut.withColumnRenamed(number, "batch_id"), store.spark.read.schema(plan.schema).parquet(f"{path}/plan")


def _commits(
    store: TableStore, spec: StreamSpec, rows: DataFrame, plan: DataFrame, commit_batches: int, most_commits: int | None
) -> Iterator[Sequence[Mapping]]:
    """Load the batches that are not known, a bounded number at a time."""
    last = -1
    while most_commits != 0:
        chosen = plan.filter(~F.col("known") & (F.col("batch_id") > last)).orderBy("batch_id").limit(commit_batches).collect()
        if not chosen:
            return
        ids = [r["batch_id"] for r in chosen]
        within = rows.filter(F.col("batch_id").between(ids[0], ids[-1]))
        if len(ids) <= ids[-1] - ids[0]:
            # Known batches lie between.
            within = within.join(F.broadcast(store.spark.createDataFrame([(i,) for i in ids], "batch_id long")), "batch_id", "left_semi")
        loads = [{"label": r["label"], "status": SUCCESS, "buffered": r["buffered"], "upserts": r["upserts"], "deletes": r["deletes"]} for r in chosen]
        store.load_batches(spec, within.select(*(column(c) for c in spec.final_columns)), loads)
        yield loads
        last = ids[-1]
