"""Load ledger: outcome of each load, row accounting, and skipping loads already made."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablesync.functions.types import column
from tablesync.spec import DELETE, UPSERT

# Load statuses that do not mean failure.
SUCCESS = "Success"
PUBLISH_TIMEOUT = "Publish Timeout"  # committed, not visible yet
LABEL_EXISTS = "Label Already Exists"  # same batch was loaded before


def outcome(status: Column) -> Column:
    """``loaded``, ``already_loaded`` or ``failed``; filtered rows alone do not fail a load."""
    return (
        F.when(status.isin(SUCCESS, PUBLISH_TIMEOUT), "loaded")
        .when(status == LABEL_EXISTS, "already_loaded")
        .otherwise("failed")
    )


def load_outcomes(loads: DataFrame, status: str = "status") -> DataFrame:
    """Add the outcome of each load."""
    return loads.withColumn("outcome", outcome(column(status)))


def require_loaded(loads: DataFrame, status: str = "status", describe: Sequence[str] = ("label", "message")) -> DataFrame:
    """The same loads; a failed one stops the job with its status and ``describe`` columns."""
    shown = [F.concat(F.lit(f" {c}="), F.coalesce(column(c).cast("string"), F.lit("NULL"))) for c in describe]
    message = F.concat(F.lit("load failed: status="), F.coalesce(column(status), F.lit("NULL")), *shown)
    checked = F.when(outcome(column(status)) == "failed", F.raise_error(message)).otherwise(F.lit(True))
    return loads.filter(checked)


def load_accounting(rows: DataFrame, by: Sequence[str], op: str = "__op", rejected: Column | None = None) -> DataFrame:
    """Per load: rows buffered, loaded and filtered, upserts and deletes."""
    bad = F.lit(False) if rejected is None else F.coalesce(rejected, F.lit(False))
    return rows.groupBy(*(column(c) for c in by)).agg(
        F.count(F.lit(1)).alias("buffered"),
        F.count_if(~bad).alias("loaded"),
        F.count_if(bad).alias("filtered"),
        F.count_if(~bad & (column(op) == UPSERT)).alias("upserts"),
        F.count_if(~bad & (column(op) == DELETE)).alias("deletes"),
    )


def pending(batches: DataFrame, ledger: DataFrame, label: str = "label") -> DataFrame:
    """Batches whose label the ledger does not hold, so that a replay loads nothing twice."""
    return batches.join(ledger.select(column(label)), label, "left_anti")


def initial_status(spark: SparkSession, tables: Mapping[str, DataFrame | None], generation: str) -> DataFrame:
    """One row per table: exists, row count, highest generation; 0 for empty and missing tables.

    Each table is one aggregate without grouping, so only one row per map task is
    exchanged. A missing table is given as None.
    """
    parts = []
    for name, table in tables.items():
        if table is None:
            part = spark.range(1).select(F.lit(0).cast("long").alias("row_count"), F.lit(0).cast("long").alias("generation_id"))
        else:
            highest = F.max(column(generation)) if generation in table.columns else F.lit(None)
            part = table.agg(
                F.count(F.lit(1)).alias("row_count"), F.coalesce(highest, F.lit(0)).cast("long").alias("generation_id")
            )
        parts.append(
            part.select(
                F.lit(name).alias("table_name"), F.lit(table is not None).alias("table_exists"), "row_count", "generation_id"
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def max_generation(table: DataFrame | None, generation: str) -> DataFrame | int:
    """Highest generation id as a one-row DataFrame; 0 for an empty table, plain 0 for a missing one."""
    if table is None:
        return 0
    return table.agg(F.coalesce(F.max(column(generation)), F.lit(0)).cast("long").alias("generation_id"))
