"""Range checks: a value its target column cannot hold becomes NULL, with a logged reason.

A rule is a function of columns that is true for bad values, so callers can add
their own per logical kind. All rules are built-in expressions.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablesync.functions.types import INTEGER_TEXT, SPARK_TYPES, column, kind_of, to_kind
from tablesync.spec import EMPTY_META, Field, MetaNames, free_name

# Reason and change codes written to the meta column.
SIZE_LIMIT = "DESTINATION_FIELD_SIZE_LIMITATION"
TYPECAST = "DESTINATION_TYPECAST_ERROR"
NULLED = "NULLED"

# 0000-01-01 and 9999-12-31, in days and in seconds from 1970-01-01 UTC.
FIRST_DAY, LAST_DAY = -719528, 2932896
FIRST_SECOND, LAST_SECOND = -62167219200, 253402300799

NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

CHANGE = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("change", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)

# (value, value as its target type or NULL, source type) -> true if bad; None if it cannot be.
Rule = Callable[[Column, Column, T.DataType], Column | None]


def _is_text(source: T.DataType) -> bool:
    return isinstance(source, (T.StringType, T.CharType, T.VarcharType))


def bad_integer(value: Column, typed: Column, source: T.DataType) -> Column | None:
    """An integer outside signed 64 bits."""
    if isinstance(source, T.IntegralType):
        return None
    overflow = value.isNotNull() & typed.isNull()
    return overflow & value.rlike(INTEGER_TEXT) if _is_text(source) else overflow


def bad_number(value: Column, typed: Column, source: T.DataType) -> Column | None:
    """A number that DECIMAL(38, 9) cannot hold, also if only rounding makes it too large."""
    if isinstance(source, T.IntegralType) or source == T.DecimalType(38, 9):
        return None
    overflow = value.isNotNull() & typed.isNull()
    return overflow & value.rlike(NUMBER_TEXT) if _is_text(source) else overflow


def bad_date(value: Column, typed: Column, source: T.DataType) -> Column:
    """A date outside years 0000 to 9999."""
    return ~F.unix_date(typed).between(FIRST_DAY, LAST_DAY)


def bad_timestamp_tz(value: Column, typed: Column, source: T.DataType) -> Column:
    """An instant outside years 0000 to 9999 in UTC, by whole seconds."""
    return ~F.unix_seconds(typed).between(FIRST_SECOND, LAST_SECOND)


def bad_timestamp_ntz(value: Column, typed: Column, source: T.DataType) -> Column:
    """A local timestamp outside years 0000 to 9999; its date decides, so no time zone matters."""
    return bad_date(value, typed.cast("date"), source)


RULES: dict[str, tuple[Rule, ...]] = {
    "integer": (bad_integer,),
    "number": (bad_number,),
    "date": (bad_date,),
    "timestamp_tz": (bad_timestamp_tz,),
    "timestamp_ntz": (bad_timestamp_ntz,),
}


def violation(
    value: Column, typed: Column, source: T.DataType, kind: str, rules: Mapping[str, Sequence[Rule]] = RULES
) -> Column | None:
    """Reason why ``value`` cannot be stored as ``kind``, NULL if it can; None if it always can."""
    reason = None
    fraction = kind == "integer" and isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType))
    if (_is_text(source) and kind in SPARK_TYPES) or fraction:
        reason = F.when(value.isNotNull() & typed.isNull(), TYPECAST)
    checks = [check for rule in rules.get(kind, ()) if (check := rule(value, typed, source)) is not None]
    if checks:
        bad = F.when(reduce(lambda a, b: a | b, checks), SIZE_LIMIT)
        reason = bad if reason is None else F.coalesce(bad, reason)
    return F.when(value != F.floor(value), TYPECAST).otherwise(reason) if fraction else reason


def validate(
    df: DataFrame,
    fields: Sequence[Field],
    names: MetaNames | None = None,
    enable_json: bool = False,
    rules: Mapping[str, Sequence[Rule]] = RULES,
    on_unreadable: str = "null",
    cast: bool = True,
) -> DataFrame:
    """Type every field, null what does not fit, and log the changes in the meta column.

    Columns that are not fields pass through; the meta column comes last.
    ``on_unreadable="fail"`` raises for text that is no value of its kind at all;
    out-of-range values are always nulled. ``cast=False`` only nulls, so that an
    encoder still sees number text with the scale it came with.
    """
    names = names or MetaNames()
    kinds = {f.name: f.kind for f in fields}
    reserved = set(df.columns)
    typed_names: dict[str, str] = {}
    reason_names: dict[str, str] = {}
    typed_columns: list[Column] = []
    reason_columns: list[Column] = []
    # One projection casts, the next one judges, the last one decides: Spark keeps them
    # apart where a result is used more than once, so nothing is parsed twice.
    for index, item in enumerate(df.schema):
        if item.name not in kinds:
            continue
        kind, value = kinds[item.name], column(item.name)
        typed_name = free_name(f"_typed{index}", reserved)
        typed_columns.append(to_kind(value, item.dataType, kind, enable_json).alias(typed_name))
        typed_names[item.name] = typed_name
        reason = violation(value, F.col(typed_name), item.dataType, kind, rules)
        if reason is not None:
            if on_unreadable == "fail":
                message = F.concat(F.lit(f"column {item.name}: cannot read as {kind}: "), value.cast("string"))
                reason = F.when(reason == TYPECAST, F.raise_error(message)).otherwise(reason)
            reason_names[item.name] = free_name(f"_reason{index}", reserved)
            reason_columns.append(reason.alias(reason_names[item.name]))
    judged = df.select("*", *typed_columns).select("*", *reason_columns)
    projected = []
    for item in df.schema:
        if item.name == names.meta:
            continue
        value = column(item.name)
        if item.name in kinds and cast:
            value = F.col(typed_names[item.name])
        if item.name in reason_names:
            value = F.when(F.col(reason_names[item.name]).isNull(), value)
        projected.append(value.alias(item.name))
    entries = F.concat_ws(
        ",", *(F.when(F.col(r).isNotNull(), _entry(name, F.col(r))) for name, r in reason_names.items())
    )
    meta = column(names.meta) if names.meta in df.columns else F.lit(EMPTY_META)
    text = free_name("_entries", reserved)
    return judged.select(*projected, meta.alias(names.meta), entries.alias(text)).withColumn(
        names.meta, append_changes(column(names.meta), F.col(text))
    ).drop(text)


def _entry(name: str, reason: Column) -> Column:
    head = f'{{"field":{json.dumps(name, ensure_ascii=False)},"change":"{NULLED}","reason":"'
    return F.concat(F.lit(head), reason, F.lit('"}'))


def append_changes(meta: Column, entries: Column) -> Column:
    """Add entries, as JSON text without brackets, to the ``changes`` list of a meta JSON text.

    The meta text is parsed only where there is something to add; its other keys stay.
    Meta that is no JSON object is replaced by one that holds the new entries.
    """
    others = F.map_filter(F.from_json(meta, "map<string,variant>"), lambda key, _: key != "changes")
    prefix = F.when(F.size(others) > 0, F.concat(_trim_ends(F.to_json(others)), F.lit(",")))
    old_text = F.get_json_object(meta, "$.changes")
    old_entries = F.when(old_text.startswith("[") & (old_text != "[]"), F.concat(_trim_ends(old_text), F.lit(",")))
    merged = F.concat(
        F.lit("{"),
        F.coalesce(prefix, F.lit("")),
        F.lit('"changes":['),
        F.coalesce(old_entries, F.lit("")),
        entries,
        F.lit("]}"),
    )
    appended = F.concat(meta.substr(F.lit(1), F.length(meta) - 2), entries, F.lit("]}"))
    only_new = F.concat(F.lit('{"changes":['), entries, F.lit("]}"))
    return (
        F.when(entries == "", F.coalesce(meta, F.lit(EMPTY_META)))
        .when(meta.isNull() | (meta == EMPTY_META), only_new)
        # The usual case with other keys: an empty list at the end, where no parsing is needed.
        .when(meta.startswith("{") & meta.endswith(',"changes":[]}'), appended)
        .otherwise(merged)
    )


def _trim_ends(text: Column) -> Column:
    """Text without its first and last character."""
    return text.substr(F.lit(2), F.length(text) - 2)


def changes(df: DataFrame, names: MetaNames | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per logged change: ``keep`` columns, then field, change, reason."""
    names = names or MetaNames()
    parsed = F.from_json(column(names.meta), T.StructType([T.StructField("changes", T.ArrayType(CHANGE))]))
    return df.select(*keep, F.inline(parsed["changes"]))


def validation_report(df: DataFrame, names: MetaNames | None = None) -> DataFrame:
    """How many values were nulled, per column and reason."""
    return changes(df, names).groupBy("field", "reason").agg(F.count(F.lit(1)).alias("nullified"))
