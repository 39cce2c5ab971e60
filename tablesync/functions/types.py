"""Logical kinds, target type names and Spark types."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Target type literals.
BOOLEAN = "BOOLEAN"
BIGINT = "BIGINT"
DECIMAL = "DECIMAL(38, 9)"
DATE = "DATE"
DATETIME = "DATETIME"
STRING = "STRING"
JSON = "JSON"

# Catalog spellings of each target type, lower case, without length.
CATALOG_SPELLINGS = {
    BOOLEAN: ("boolean",),
    BIGINT: ("bigint",),
    DECIMAL: ("decimal", "decimalv2", "decimalv3", "decimal32", "decimal64", "decimal128"),
    DATE: ("date",),
    DATETIME: ("datetime",),
    STRING: ("varchar", "char", "string"),
    JSON: ("json",),
}

SCALAR_TARGETS = {
    "boolean": BOOLEAN,
    "integer": BIGINT,
    "number": DECIMAL,
    "date": DATE,
    "timestamp_tz": DATETIME,
    "timestamp_ntz": DATETIME,
}

SPARK_TYPES: dict[str, T.DataType] = {
    "boolean": T.BooleanType(),
    "integer": T.LongType(),
    "number": T.DecimalType(38, 9),
    "date": T.DateType(),
    "timestamp_tz": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def target_type(kind: str, enable_json: bool = False) -> str:
    """Target type literal of a logical kind."""
    if kind == "object" and enable_json:
        return JSON
    return SCALAR_TARGETS.get(kind, STRING)


def spark_type(kind: str, enable_json: bool = False) -> T.DataType:
    """Spark type that holds a logical kind."""
    if kind == "object" and enable_json:
        return T.VariantType()
    return SPARK_TYPES.get(kind, T.StringType())


def kind_of(data_type: T.DataType) -> str:
    """Logical kind of a Spark column, for columns without a declared one."""
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.IntegralType):
        return "integer"
    if isinstance(data_type, (T.DecimalType, T.DoubleType, T.FloatType)):
        return "number"
    if isinstance(data_type, T.DateType):
        return "date"
    if isinstance(data_type, T.TimestampNTZType):
        return "timestamp_ntz"
    if isinstance(data_type, T.TimestampType):
        return "timestamp_tz"
    if isinstance(data_type, T.ArrayType):
        return "array"
    if isinstance(data_type, (T.StructType, T.MapType, T.VariantType)):
        return "object"
    return "string"


def catalog_type(data_type: T.DataType) -> str:
    """Target type literal of a Spark column found in a table."""
    if isinstance(data_type, T.VariantType):
        return JSON
    kind = kind_of(data_type)
    return STRING if kind == "object" else target_type(kind)


def canonical_type(type_name: str) -> str:
    """Canonical target type of a catalog spelling: length dropped, synonyms merged."""
    bare = type_name.split("(", 1)[0].strip().lower()
    for canonical, spellings in CATALOG_SPELLINGS.items():
        if bare in spellings:
            return canonical
    return type_name.upper()


def canonical_type_column(type_name: Column) -> Column:
    """``canonical_type`` as a column expression, for catalogs read as tables."""
    bare = F.lower(F.trim(F.substring_index(type_name, "(", 1)))
    result = F.upper(type_name)
    for canonical, spellings in CATALOG_SPELLINGS.items():
        result = F.when(bare.isin(*spellings), canonical).otherwise(result)
    return result


def quote_identifier(name: str) -> str:
    """``name`` in backticks, inner backticks doubled."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """A column by its exact name, whatever characters the name has."""
    return F.col(quote_identifier(name))


# Texts Spark reads as booleans.
TRUE_TEXTS = ("t", "true", "y", "yes", "1")
FALSE_TEXTS = ("f", "false", "n", "no", "0")

INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def safe_cast(value: Column, source: T.DataType, wanted: T.DataType) -> Column:
    """``try_cast``, by cheaper means where a failing one throws inside Spark for every bad row.

    A thrown and caught exception costs more than the rest of the row's work, so a
    column full of bad values would be many times slower than one full of good ones.
    """
    if source == wanted:
        return value
    text = isinstance(source, T.StringType)
    if text and isinstance(wanted, T.LongType):
        number = F.when(value.rlike(INTEGER_TEXT), value.try_cast("decimal(38,0)"))
        return F.when(number.between(F.lit(LONG_MIN).cast("decimal(38,0)"), F.lit(LONG_MAX).cast("decimal(38,0)")),
                      number.cast("bigint"))
    if text and isinstance(wanted, T.BooleanType):
        word = F.lower(F.trim(value))
        return F.when(word.isin(*TRUE_TEXTS), True).when(word.isin(*FALSE_TEXTS), False)
    if isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType)) and isinstance(wanted, T.LongType):
        # A fraction does not fit; it is not cut off unseen.
        return F.when(value == F.floor(value), value.try_cast(wanted))
    if isinstance(source, (T.DoubleType, T.FloatType)) and isinstance(wanted, T.DecimalType):
        limit = float(10 ** (wanted.precision - wanted.scale))
        return F.when(F.abs(value) < limit, value.try_cast(wanted))
    return value.try_cast(wanted)


def to_kind(value: Column, source: T.DataType, kind: str, enable_json: bool = False) -> Column:
    """Cast to the type of ``kind``; a value that does not fit becomes NULL.

    Nested values become JSON text, or VARIANT for objects if ``enable_json``.
    """
    if isinstance(source, (T.StructType, T.MapType, T.ArrayType)):
        text = F.to_json(value, {"ignoreNullFields": "false"})
    elif isinstance(source, T.VariantType):
        if kind == "object" and enable_json:
            return value
        text = F.to_json(value)
    else:
        wanted = spark_type(kind, enable_json)
        if isinstance(wanted, T.VariantType):
            return F.try_parse_json(value.cast("string"))
        return safe_cast(value, source, wanted)
    return F.try_parse_json(text) if kind == "object" and enable_json else text
