"""Table layout and schema evolution: describe, discover, compare, rewrite."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from enum import Enum

from pyspark.sql import DataFrame, functions as F, types as T

from tablesync.functions.types import catalog_type, column, safe_cast, spark_type, target_type
from tablesync.spec import MetaNames, StreamSpec


class KeyModel(str, Enum):
    PRIMARY = "primary"  # one row per key
    DUPLICATE = "duplicate"  # every row kept


@dataclass(frozen=True)
class TableColumn:
    name: str
    data_type: T.DataType
    nullable: bool

    @property
    def type_name(self) -> str:
        return catalog_type(self.data_type)


@dataclass(frozen=True)
class ColumnType:
    type_name: str
    nullable: bool


@dataclass(frozen=True)
class Layout:
    """Resolved table: columns with the keys first and non-null, key columns, key model."""

    columns: tuple[TableColumn, ...]
    keys: tuple[str, ...]
    model: KeyModel

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.data_type, c.nullable) for c in self.columns])


@dataclass(frozen=True)
class Changeset:
    """How to get from the actual columns to the desired ones."""

    add: Mapping[str, ColumnType]
    drop: Mapping[str, ColumnType]
    change: Mapping[str, tuple[ColumnType, ColumnType]]
    retain: Mapping[str, ColumnType]

    @property
    def is_noop(self) -> bool:
        return not (self.add or self.drop or self.change)


def envelope_columns(names: MetaNames) -> list[TableColumn]:
    kinds = ("string", "timestamp_tz", "string", "integer")
    return [TableColumn(name, spark_type(kind), False) for name, kind in zip(names.envelope, kinds)]


def arrange(columns: Iterable[TableColumn], keys: Iterable[str], model: KeyModel) -> Layout:
    """Keys first, in key order and NOT NULL, then the other columns in their order."""
    columns, keys = list(columns), tuple(keys)
    if not keys:
        raise ValueError("a table needs at least one key column")
    by_name = {c.name: c for c in columns}
    unknown = [k for k in keys if k not in by_name]
    if unknown:
        raise ValueError(f"key columns {unknown} are not columns of the table")
    first = [replace(by_name[k], nullable=False) for k in keys]
    return Layout((*first, *(c for c in columns if c.name not in keys)), keys, model)


def describe(spec: StreamSpec) -> Layout:
    """Table layout of a stream: dedup streams are keyed on their primary key, others on the raw id."""
    user = [TableColumn(f.name, spark_type(f.kind, spec.enable_json), f.nullable) for f in spec.final_fields]
    model = KeyModel.PRIMARY if spec.is_dedup else KeyModel.DUPLICATE
    return arrange([*envelope_columns(spec.names), *user], spec.keys or (spec.names.raw_id,), model)


def discover(schema: T.StructType, names: MetaNames | None = None) -> dict[str, ColumnType]:
    """User columns of an existing table by canonical type, envelope left out."""
    skipped = set((names or MetaNames()).envelope)
    return {f.name: ColumnType(catalog_type(f.dataType), f.nullable) for f in schema if f.name not in skipped}


def desired(spec: StreamSpec) -> dict[str, ColumnType]:
    """User columns the stream wants."""
    return {f.name: ColumnType(target_type(f.kind, spec.enable_json), f.nullable) for f in spec.final_fields}


def diff(actual: Mapping[str, ColumnType], wanted: Mapping[str, ColumnType]) -> Changeset:
    """Match columns by name: to add, to drop, to change, to keep."""
    return Changeset(
        add={n: t for n, t in wanted.items() if n not in actual},
        drop={n: t for n, t in actual.items() if n not in wanted},
        change={n: (actual[n], t) for n, t in wanted.items() if n in actual and actual[n] != t},
        retain={n: t for n, t in wanted.items() if actual.get(n) == t},
    )


def evolved_layout(current: Layout, spec: StreamSpec, change: Changeset) -> Layout:
    """Layout after ``change``.

    Added columns are nullable, as old rows have no value for them. A changed column
    that was nullable and is no key stays nullable, as old rows may hold NULL.
    Dropping a key column, or changing the key, is refused.
    """
    lost = [k for k in current.keys if k in change.drop]
    if lost:
        raise ValueError(f"cannot drop key columns {lost}; refresh the table instead")
    target = describe(spec)
    if target.keys != current.keys or target.model is not current.model:
        raise ValueError(f"key {current.keys} cannot become {target.keys}; refresh the table instead")
    old = {c.name: c for c in current.columns}
    columns = []
    for item in target.columns:
        if item.name in change.add:
            item = replace(item, nullable=True)
        elif item.name in change.change:
            before, _ = change.change[item.name]
            if before.nullable and item.name not in target.keys:
                item = replace(item, nullable=True)
        elif item.name in old:
            item = old[item.name]
        columns.append(item)
    return replace(target, columns=tuple(columns))


def evolve(df: DataFrame, layout: Layout, change: Changeset, on_error: str = "fail") -> DataFrame:
    """Rows of the old table in the new layout, as one projection.

    Changed columns are cast: a value that does not fit stops the job and leaves the
    old table as it is, or becomes NULL with ``on_error="null"``.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error is 'fail' or 'null'")
    projected = []
    for item in layout.columns:
        if item.name in change.add:
            value = F.lit(None).cast(item.data_type)
        elif item.name in change.change:
            value = _cast(df, item, on_error)
        else:
            value = column(item.name)
        projected.append(value.alias(item.name))
    return df.select(*projected)


def _cast(df: DataFrame, item: TableColumn, on_error: str):
    source = df.schema[item.name].dataType
    value = column(item.name)
    if source == item.data_type:
        return value
    if isinstance(item.data_type, T.VariantType):
        text = value.cast("string")
        return F.try_parse_json(text) if on_error == "null" else F.parse_json(text)
    if isinstance(source, T.VariantType):
        return F.to_json(value).cast(item.data_type)
    cast = safe_cast(value, source, item.data_type)
    if on_error == "null":
        return cast
    # Raises whether or not the session is in ANSI mode.
    message = F.concat(F.lit(f"column {item.name}: cannot cast "), value.cast("string"))
    return F.when(value.isNotNull() & cast.isNull(), F.raise_error(message)).otherwise(cast)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; absent ones are NULL."""
    present = set(df.columns)
    return df.select(
        *(
            (
                column(f.name)
                if f.name in present and df.schema[f.name].dataType == f.dataType
                else column(f.name).cast(f.dataType)
                if f.name in present
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema
        )
    )
