"""Row encoders: CSV line, JSON line, and text parameters, one built-in expression per cell."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablesync.functions.types import column, kind_of
from tablesync.spec import DELETE, UPSERT, Field, StreamSpec, check_op_column

# Fixed values of the CSV layout.
SEPARATOR = ","
ENCLOSE = '"'
NULL_MARKER = "\\N"

NESTED = (T.StructType, T.MapType, T.ArrayType, T.VariantType)


def seconds_text(value: Column, source: T.DataType) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with the fraction cut; instants are shown in UTC.

    Works on the local timestamp's own text, so the session time zone has no influence.
    """
    if isinstance(source, T.TimestampType):
        span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.unix_seconds(value).cast("decimal(18,6)"))
        value = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + span
    return F.substring_index(value.cast("string"), ".", 1)


def json_text(value: Column, source: T.DataType) -> Column:
    """JSON text of a nested value; text is taken to be JSON already."""
    if isinstance(source, (T.StructType, T.MapType, T.ArrayType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    if isinstance(source, T.VariantType):
        return F.to_json(value)
    return value.cast("string")


def plain_text(value: Column, source: T.DataType, kind: str) -> Column:
    """Unquoted text of a value, NULL for NULL. Number text keeps the scale it came with."""
    if isinstance(source, NESTED):
        return json_text(value, source)
    if isinstance(source, T.BooleanType):
        return F.when(value, "1").when(~value, "0")
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return seconds_text(value, source)
    if isinstance(source, (T.DoubleType, T.FloatType)) and kind == "number":
        return value.try_cast("decimal(38,9)").cast("string")
    return value.cast("string")


def csv_cell(value: Column, source: T.DataType, kind: str) -> Column:
    """One CSV cell: only strings and nested values are enclosed, NULL is ``\\N``."""
    text = plain_text(value, source, kind)
    if kind in ("string", "array", "object", "union", "unknown"):
        text = F.concat(F.lit(ENCLOSE), F.replace(text, F.lit(ENCLOSE), F.lit(ENCLOSE * 2)), F.lit(ENCLOSE))
    return F.coalesce(text, F.lit(NULL_MARKER))


def json_cell(value: Column, source: T.DataType, kind: str) -> Column:
    """One JSON member value: booleans stay native, everything else is text."""
    return value if isinstance(source, T.BooleanType) else plain_text(value, source, kind)


def op_code(spec: StreamSpec) -> Column:
    """Operation code of a record: 1 for a delete to apply, else 0."""
    if not spec.cdc_delete or spec.soft_delete:
        return F.lit(UPSERT)
    return F.when(column(spec.names.deleted_at).isNotNull(), DELETE).otherwise(UPSERT)


def _cells(df: DataFrame, fields: Sequence[Field] | None) -> list[tuple[str, Column, T.DataType, str]]:
    kinds = {f.name: f.kind for f in fields or ()}
    return [
        (item.name, column(item.name), item.dataType, kinds.get(item.name, kind_of(item.dataType)))
        for item in df.schema
    ]


def csv_line(df: DataFrame, fields: Sequence[Field] | None = None, op: Column | None = None) -> Column:
    """All columns of ``df`` in order as one CSV line, without its newline."""
    cells = [csv_cell(value, source, kind) for _, value, source, kind in _cells(df, fields)]
    if op is not None:
        cells.append(op.cast("string"))
    # NULL is already rendered, so concat_ws drops nothing.
    return F.concat_ws(SEPARATOR, *cells)


def json_line(
    df: DataFrame, fields: Sequence[Field] | None = None, op: Column | None = None, op_name: str = "__op"
) -> Column:
    """All columns of ``df`` in order as one JSON object text with explicit nulls."""
    members = [json_cell(value, source, kind).alias(name) for name, value, source, kind in _cells(df, fields)]
    if op is not None:
        members.append(op.cast("int").alias(op_name))
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})


def bind_strings(df: DataFrame, fields: Sequence[Field] | None = None) -> DataFrame:
    """Every value as text or NULL, ready to be bound as a statement parameter."""
    return df.select(*(plain_text(value, source, kind).alias(name) for name, value, source, kind in _cells(df, fields)))


def encode(df: DataFrame, spec: StreamSpec, layout: str, line: str = "line") -> DataFrame:
    """Records of a stream as one text column ``line`` in ``csv`` or ``json`` layout."""
    check_op_column(spec)
    shaped = df.select(*(column(name) for name in spec.final_columns))
    op = op_code(spec) if spec.cdc_delete else None
    if layout == "csv":
        return shaped.select(csv_line(shaped, spec.fields, op).alias(line))
    if layout == "json":
        return shaped.select(json_line(shaped, spec.fields, op, spec.names.op).alias(line))
    raise ValueError(f"unknown layout {layout!r}")


def column_manifest(spec: StreamSpec, layout: str) -> dict[str, Any]:
    """What a reader of encoded rows must know: layout and ordered columns."""
    columns = [*spec.final_columns, *([spec.names.op] if spec.cdc_delete else [])]
    if layout == "csv":
        return {"format": "CSV", "column_separator": SEPARATOR, "enclose": ENCLOSE, "columns": columns}
    if layout == "json":
        return {"format": "JSON", "strip_outer_array": False, "columns": columns}
    raise ValueError(f"unknown layout {layout!r}")
