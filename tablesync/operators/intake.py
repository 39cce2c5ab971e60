"""Shape incoming records: renames, missing fields, envelope, column order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablesync.functions.types import column, spark_type
from tablesync.functions.validate import validate
from tablesync.spec import EMPTY_META, StreamSpec


def shape(
    df: DataFrame,
    spec: StreamSpec,
    raw_id: Column | None = None,
    extracted_at: Column | None = None,
) -> DataFrame:
    """Records in final column order: the four envelope columns, then every declared field.

    A field the input lacks is NULL; a column that is no field is dropped. Envelope
    columns are taken from the input if present. A raw id must come from the input or
    from ``raw_id``: one made up here would change when a lost task runs again.
    """
    if spec.renames:
        df = df.withColumnsRenamed(dict(spec.renames))
    names = spec.names
    present = set(df.columns)
    if names.raw_id not in present and raw_id is None:
        raise ValueError(f"records have no column {names.raw_id!r}; pass raw_id")
    envelope = {
        names.raw_id: raw_id,
        names.extracted_at: F.current_timestamp() if extracted_at is None else extracted_at,
        names.meta: F.lit(EMPTY_META),
        names.generation_id: F.lit(spec.generation_id).cast("long"),
    }
    shaped = []
    for name, default in envelope.items():
        value = column(name) if name in present else default
        if name == names.raw_id:
            value = value.cast("string")
        elif name == names.generation_id:
            value = value.cast("long")
        shaped.append(value.alias(name))
    for item in spec.fields:
        missing = F.lit(None).cast(spark_type(item.kind, spec.enable_json))
        shaped.append((column(item.name) if item.name in present else missing).alias(item.name))
    return df.select(*shaped)


def intake(
    df: DataFrame,
    spec: StreamSpec,
    raw_id: Column | None = None,
    extracted_at: Column | None = None,
    on_unreadable: str = "null",
    cast: bool = True,
) -> DataFrame:
    """``shape``, then type and range-check every field.

    ``cast=False`` leaves values as they came, so that an encoder writes numbers with all
    the digits of their text; what doesn't fit is nulled all the same.
    """
    shaped = shape(df, spec, raw_id, extracted_at)
    checked = validate(shaped, spec.fields, spec.names, spec.enable_json, on_unreadable=on_unreadable, cast=cast)
    return checked.select(*(column(c) for c in spec.final_columns))
