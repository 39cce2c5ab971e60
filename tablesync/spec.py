"""What a stream is: names, fields, key, sync mode, generations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from enum import Enum

# Logical field kinds a source may declare.
KINDS = (
    "boolean",
    "integer",
    "number",
    "date",
    "timestamp_tz",
    "timestamp_ntz",
    "time_tz",
    "time_ntz",
    "string",
    "array",
    "union",
    "unknown",
    "object",
)

# Operation codes.
UPSERT = 0
DELETE = 1

# Fixed value: meta text of a record without changes.
EMPTY_META = '{"changes":[]}'

# Fixed value: most records that form one load batch.
MAX_RECORDS_PER_BATCH = 50_000


class SyncMode(str, Enum):
    """How incoming records change the target table."""

    OVERWRITE = "overwrite"
    APPEND = "append"
    DEDUP = "dedup"


@dataclass(frozen=True)
class MetaNames:
    """Names of the envelope columns; set them to whatever existing tables use."""

    raw_id: str = "_raw_id"
    extracted_at: str = "_extracted_at"
    meta: str = "_meta"
    generation_id: str = "_generation_id"
    deleted_at: str = "_deleted_at"
    op: str = "__op"

    @property
    def envelope(self) -> tuple[str, str, str, str]:
        return (self.raw_id, self.extracted_at, self.meta, self.generation_id)


@dataclass(frozen=True)
class Field:
    """One user column: final name, logical kind, nullability."""

    name: str
    kind: str
    nullable: bool = True

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r} for column {self.name!r}")


@dataclass(frozen=True)
class StreamSpec:
    """A named sequence of records and how it lands in its table.

    ``order_by`` gives the arrival order; it is required for dedup streams, as
    DataFrames carry no order. List the columns from most to least significant
    and make the tuple unique per key (for example log position, then raw id).
    """

    name: str
    fields: tuple[Field, ...]
    mode: SyncMode = SyncMode.APPEND
    namespace: str | None = None
    primary_key: tuple[tuple[str, ...], ...] = ()
    order_by: tuple[str, ...] = ()
    soft_delete: bool = False
    enable_json: bool = False
    generation_id: int = 0
    minimum_generation_id: int = 0
    renames: Mapping[str, str] = field(default_factory=dict)
    names: MetaNames = field(default_factory=MetaNames)

    def __post_init__(self) -> None:
        object.__setattr__(self, "mode", SyncMode(self.mode))
        object.__setattr__(self, "fields", tuple(self.fields))
        object.__setattr__(self, "order_by", tuple(self.order_by))
        object.__setattr__(self, "primary_key", tuple(as_path(p) for p in self.primary_key))
        seen = [f.name for f in self.fields]
        if len(set(seen)) != len(seen):
            raise ValueError(f"stream {self.name!r} declares a column twice")
        clash = set(seen) & set(self.names.envelope)
        if clash:
            raise ValueError(f"stream {self.name!r} uses envelope column names: {sorted(clash)}")
        if self.is_dedup:
            if not self.primary_key:
                raise ValueError(f"dedup stream {self.name!r} needs a primary key")
            if not self.order_by:
                raise ValueError(f"dedup stream {self.name!r} needs order_by")
            unknown = [c for c in self.order_by if c not in self.final_columns]
            if unknown:
                raise ValueError(f"order columns {unknown} are not columns of stream {self.name!r}")
            missing = [k for k in self.keys if k not in seen]
            if missing:
                raise ValueError(f"key columns {missing} are not columns of stream {self.name!r}")

    @property
    def is_dedup(self) -> bool:
        return self.mode is SyncMode.DEDUP

    @property
    def keys(self) -> tuple[str, ...]:
        """Key column names. A nested key path is refused."""
        for path in self.primary_key:
            if len(path) != 1:
                raise ValueError(f"nested key {'.'.join(path)!r} is not supported")
        return tuple(path[0] for path in self.primary_key) if self.is_dedup else ()

    @property
    def cdc_delete(self) -> bool:
        """Deletes apply only to dedup streams that carry the tombstone column."""
        return self.is_dedup and any(f.name == self.names.deleted_at for f in self.fields)

    @property
    def final_fields(self) -> tuple[Field, ...]:
        """Declared fields with key columns forced non-null."""
        keys = set(self.keys)
        return tuple(replace(f, nullable=f.nullable and f.name not in keys) for f in self.fields)

    @property
    def final_columns(self) -> list[str]:
        """Record column order: envelope first, then user columns."""
        return [*self.names.envelope, *(f.name for f in self.fields)]

    def target(self, default_namespace: str | None = None) -> tuple[str, str]:
        """``(namespace, table)``; names are kept as they are."""
        return (self.namespace or (default_namespace or "").strip() or "default", self.name)


def as_path(key: str | Iterable[str]) -> tuple[str, ...]:
    return (key,) if isinstance(key, str) else tuple(key)


def op_column_collides(cdc_delete: bool, sql_sink: bool, columns: Iterable[str], op: str = "__op") -> bool:
    """True if a user column takes the name the operation column needs.

    The SQL sink applies inserts and deletes as such and adds no operation column.
    """
    return cdc_delete and not sql_sink and op in set(columns)


def check_op_column(spec: StreamSpec, sql_sink: bool = False) -> None:
    if op_column_collides(spec.cdc_delete, sql_sink, (f.name for f in spec.fields), spec.names.op):
        raise ValueError(
            f"stream {spec.name!r} has a column named {spec.names.op!r}, which is reserved for the "
            "operation code; rename it at the source"
        )


def free_name(wanted: str, taken: Iterable[str]) -> str:
    """``wanted``, with underscores added until no column of ``taken`` has that name."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted
