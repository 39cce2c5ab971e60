"""Sinks: encoded CSV or JSON text files, parquet, and JDBC with text parameters."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame

from tablesync.functions.encode import bind_strings, column_manifest, encode, op_code
from tablesync.functions.types import column
from tablesync.operators.schema import conform, describe
from tablesync.sources.files import SharedFiles
from tablesync.spec import DELETE, StreamSpec

# Body compressions a caller may ask for.
COMPRESSIONS = ("none", "gzip", "zstd")

MANIFEST = "_columns.json"


def choose_layout(load_as_sql: bool = False, load_as_json: bool = False) -> str:
    """Sink format: SQL if set, else JSON if set, else CSV."""
    return "jdbc" if load_as_sql else "json" if load_as_json else "csv"


def check_compression(layout: str, compression: str) -> str:
    """The compression to write with. Only JSON bodies may be compressed."""
    if compression not in COMPRESSIONS:
        raise ValueError(f"unsupported compression {compression!r}; one of {COMPRESSIONS}")
    if compression != "none" and layout not in ("json", "parquet"):
        raise ValueError(f"compression {compression!r} is for JSON, not for {layout}")
    if compression == "zstd" and layout == "json":
        raise ValueError("Spark's text writer has no zstd codec; use gzip, batch_bodies() with zstd, or the parquet sink")
    return compression


def write_encoded(df: DataFrame, spec: StreamSpec, path: str, layout: str, compression: str = "none") -> None:
    """Write records as encoded text rows, with their column manifest beside them.

    JSON is written one object per line, so there is no outer array to strip.
    """
    compression = check_compression(layout, compression)
    encode(df, spec, layout).write.option("compression", compression).text(path)
    manifest = {**column_manifest(spec, layout), "compression": compression}
    SharedFiles(df.sparkSession).create_text(f"{path.rstrip('/')}/{MANIFEST}", json.dumps(manifest))


def write_parquet(df: DataFrame, spec: StreamSpec, path: str, compression: str = "zstd") -> None:
    """Append records as typed parquet rows in record column order."""
    shaped = df.select(*(column(name) for name in spec.final_columns))
    shaped.write.option("compression", check_compression("parquet", compression)).mode("append").parquet(path)


def typed_from_strings(bound: DataFrame, spec: StreamSpec) -> DataFrame:
    """Text parameters cast to the stream's column types, as a target would on insert."""
    return conform(bound, describe(spec).schema)


def write_jdbc(df: DataFrame, spec: StreamSpec, url: str, table: str, batch_size: int = 10_000, **properties: str) -> None:
    """Append records to an RDBMS table, every value bound as text or NULL.

    An append can't delete, so a batch with rows to delete is refused; route such a
    stream first and apply its deletes in the database.
    """
    if spec.cdc_delete and not spec.soft_delete and not df.filter(op_code(spec) == DELETE).isEmpty():
        raise ValueError("the batch holds deletes, which a JDBC append would insert as rows")
    shaped = df.select(*(column(name) for name in spec.final_columns))
    bind_strings(shaped, spec.fields).write.option("batchsize", batch_size).jdbc(
        url, table, mode="append", properties=properties
    )


def write(df: DataFrame, spec: StreamSpec, path: str, layout: str = "csv", **options) -> None:
    """Write records with the chosen sink: ``csv``, ``json``, ``parquet`` or ``jdbc`` (path = URL)."""
    if layout in ("csv", "json"):
        write_encoded(df, spec, path, layout, **options)
    elif layout == "parquet":
        write_parquet(df, spec, path, **options)
    elif layout == "jdbc":
        write_jdbc(df, spec, path, **options)
    else:
        raise ValueError(f"unknown sink {layout!r}")
