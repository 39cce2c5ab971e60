"""What the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

#: White space of all contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have, so that extra columns never clash with working ones."""
    taken = {c.lower() for c in df.columns}
    name, n = stem, 0
    while name.lower() in taken:
        n += 1
        name = f"{stem}_{n}"
    return name


def col(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def word_array(text: Column) -> Column:
    """The words of a text; null gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    return df.mapInArrow(function, schema)


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` as a table in the shared working folder: cuts lineage and survives lost executors."""
    from tablesync.session import new_work_path

    spark = df.sparkSession
    path = new_work_path(spark, f"llm-{label}-{uuid.uuid4().hex[:8]}")
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
