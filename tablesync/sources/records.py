"""Records that come as JSON text: parsed, their fields found, and those that can't be read set aside."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from tablesync.functions.types import column, kind_of
from tablesync.operators.intake import intake
from tablesync.sources.store import LoadResult, TableStore
from tablesync.spec import Field, StreamSpec, free_name

# Why a record is set aside.
NOT_JSON, NOT_OBJECT, NO_KEY = "not JSON", "not an object", "no key"

#: Kinds of the value types found in records; what differs between records is text.
FOUND_KINDS = {"BOOLEAN": "boolean", "BIGINT": "integer", "DOUBLE": "number", "FLOAT": "number", "STRING": "string", "DATE": "date", "VARIANT": "string"}


class TooManyRejected(Exception):
    """A load was given up because too large a share of its records can't be read."""


def parsed(texts: DataFrame, text: str, record: str = "record", reason: str = "reason") -> DataFrame:
    """Add the record as a map from field to value, and why there is none."""
    value = free_name("_value", texts.columns)
    read = texts.withColumn(value, F.try_parse_json(column(text)))
    shape = F.schema_of_variant(F.col(value))
    is_object = shape.startswith("OBJECT<")
    why = F.when(F.col(value).isNull(), NOT_JSON).when(~is_object, NOT_OBJECT)
    # The cast is made for objects only; it fails for others.
    return read.withColumn(record, F.when(is_object, F.col(value)).cast("map<string,variant>")).withColumn(reason, why).drop(value)


def found_fields(records: DataFrame, record: str = "record") -> list[Field]:
    """The fields that the records have, by name. One row for each name reaches the driver; fields that are null throughout have no kind yet."""
    entries = records.filter(column(record).isNotNull()).select(F.explode(column(record)).alias("name", "value"))
    kinds = entries.groupBy("name").agg(F.schema_of_variant_agg("value").alias("kind")).orderBy("name").collect()
    return [Field(r["name"], _kind(r["kind"])) for r in kinds if r["kind"] != "VOID"]


def _kind(found: str) -> str:
    if found.startswith("OBJECT<"):
        return "object"
    if found.startswith("ARRAY<"):
        return "array"
    if found.startswith("DECIMAL"):
        return "number"
    return FOUND_KINDS.get(found, "string")


def widened(spec: StreamSpec, found: Sequence[Field]) -> StreamSpec:
    """The stream with the fields found. Declared kinds stay, but for whole numbers among which others were found; nothing is dropped."""
    kinds = {f.name: f.kind for f in found}
    clash = {*spec.names.envelope}
    fields = [replace(f, kind="number") if f.kind == "integer" and kinds.get(f.name) == "number" and f.name not in spec.keys else f for f in spec.fields]
    known = {f.name.lower() for f in spec.fields}
    new = [f for f in found if f.name.lower() not in known and f.name not in clash]
    return replace(spec, fields=(*fields, *new))


def stored_fields(store: TableStore, spec: StreamSpec) -> StreamSpec:
    """The stream with the columns that its table has beyond those declared, as a stream that starts anew finds them."""
    target = store.target(spec)
    if not store.table_exists(*target):
        return spec
    schema = store.read(*target).schema
    kinds = {name: kind_of(schema[name].dataType) for name in store.schema(*target)}
    known = {f.name for f in spec.fields}
    fields = [replace(f, kind=kinds[f.name]) if f.kind == "integer" and kinds.get(f.name) == "number" else f for f in spec.fields]
    return replace(spec, fields=(*fields, *(Field(n, k) for n, k in kinds.items() if n not in known)))


def as_columns(records: DataFrame, fields: Sequence[Field], keep: Sequence[str] = (), record: str = "record") -> DataFrame:
    """``keep`` and every field as text, numbers with the digits they came with; ``intake`` types them."""
    return records.select(*(column(c) for c in keep), *(field_text(column(record), f.name).alias(f.name) for f in fields if f.name not in keep))


def field_text(record: Column, name: str) -> Column:
    return F.try_variant_get(F.try_element_at(record, F.lit(name)), "$", "string")


def split(records: DataFrame, keys: Sequence[str], record: str = "record", reason: str = "reason") -> DataFrame:
    """Also give records without a key a reason."""
    if not keys:
        return records
    missing = F.lit(False)
    for key in keys:
        missing = missing | field_text(column(record), key).isNull()
    return records.withColumn(reason, F.coalesce(column(reason), F.when(missing, NO_KEY)))


REJECTED = (Field("text", "string"), Field("reason", "string"))


def rejected_spec(spec: StreamSpec) -> StreamSpec:
    """Where the records of a stream go that can't be read."""
    return StreamSpec(f"{spec.name}.rejected", REJECTED, namespace=spec.namespace, names=spec.names, generation_id=spec.generation_id)


def load_texts(
    store: TableStore,
    spec: StreamSpec,
    texts: DataFrame,
    text: str,
    raw_id: str,
    extracted_at: str,
    label: str,
    most_rejected: float = 1.0,
) -> tuple[LoadResult, int]:
    """Load records given as JSON text (with columns ``raw_id`` and ``extracted_at``): the load, and how many were set aside.

    Records that can't be read, and those without a key, go to a table beside the stream's, with their text
    and the reason. A larger share of them than ``most_rejected`` gives the whole load up
    before anything is published. Both tables know the load by its label.
    """
    names = spec.names
    envelope = {names.raw_id: column(raw_id).cast("string"), names.extracted_at: column(extracted_at)}
    # Parsed once, for the count and both loads.
    read = split(parsed(texts, text), spec.keys)
    read = read.select("*", *(v.alias(n) for n, v in envelope.items() if n not in read.columns)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        totals = read.agg(F.count(F.lit(1)).alias("rows"), F.count("reason").alias("rejected")).first()
        if totals["rejected"] > most_rejected * totals["rows"]:
            raise TooManyRejected(f"{totals['rejected']} of {totals['rows']} records of load {label!r} can't be read")
        good = as_columns(read.filter("reason IS NULL"), spec.fields, [names.raw_id, names.extracted_at])
        bad = read.filter("reason IS NOT NULL").select(column(names.raw_id), column(names.extracted_at), column(text).alias("text"), "reason")
        aside = rejected_spec(spec)
        store.ensure(spec)
        store.ensure(aside)
        # Rejects first: a run that ends between the two loads is made up for by the next one, by label.
        store.load(aside, intake(bad, aside), label=label)
        return store.load(spec, intake(good, spec), label=label), totals["rejected"]
    finally:
        read.unpersist()
