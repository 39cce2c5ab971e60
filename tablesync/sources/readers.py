"""Record sources. The schema is always given, never inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

FORMATS = ("parquet", "orc", "json", "csv", "text")


def read_records(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A batch of records from files."""
    return _reader(spark.read, schema, fmt, options).load(path)


def stream_records(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Records from a folder (or glob) as a stream; ``maxFilesPerTrigger`` bounds a micro-batch."""
    return _reader(spark.readStream, schema, fmt, options).load(path)


def read_encoded(spark: SparkSession, path: str, schema: T.StructType | str, layout: str) -> DataFrame:
    """Rows written by the CSV or JSON sink, typed by ``schema``.

    In CSV the null marker reads as NULL even where it was an enclosed string; JSON
    keeps such a string.
    """
    if layout == "csv":
        return read_records(
            spark, path, schema, "csv", nullValue="\\N", quote='"', escape='"', multiLine="true", emptyValue=""
        )
    if layout == "json":
        return read_records(spark, path, schema, "json")
    raise ValueError(f"unknown layout {layout!r}")


def _reader(reader, schema, fmt: str, options: dict[str, str]):
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; one of {FORMATS}")
    return reader.format(fmt).schema(schema).options(**options)
