"""Validation, encoding, types and schema logic on small inputs."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from tablesync import Field, MetaNames, StreamSpec, SyncMode
from tablesync.functions import types as kinds
from tablesync.functions.encode import bind_strings, column_manifest, csv_line, encode, json_line, op_code
from tablesync.functions.validate import SIZE_LIMIT, TYPECAST, validate, validation_report
from tablesync.operators.intake import intake, shape
from tablesync.operators.schema import (
    ColumnType, KeyModel, TableColumn, arrange, describe, desired, diff, discover, evolve, evolved_layout,
)
from tablesync.sources.readers import read_encoded, read_records
from tablesync.sources.sinks import check_compression, choose_layout, typed_from_strings, write, write_encoded
from tablesync.spec import check_op_column, op_column_collides


def check(spark, kind, expression):
    """(is kept, reason) of one value given as SQL."""
    df = spark.sql(f"SELECT {expression} AS v")
    row = validate(df, [Field("v", kind)]).select(F.col("v").isNotNull(), "_meta").first()
    found = json.loads(row[1])["changes"]
    return row[0], found[0]["reason"] if found else None


@pytest.mark.parametrize(
    "kind, value, reason",
    [
        ("integer", "'0'", None),
        ("integer", "'9223372036854775807'", None),
        ("integer", "'-9223372036854775808'", None),
        ("integer", "'9223372036854775808'", SIZE_LIMIT),
        ("integer", "'-9223372036854775809'", SIZE_LIMIT),
        ("integer", f"'{'7' * 40}'", SIZE_LIMIT),
        ("integer", "9223372036854775808BD", SIZE_LIMIT),
        ("integer", "'seven'", TYPECAST),
        ("integer", "'12.5'", TYPECAST),
        ("integer", "' +7 '", None),
        ("boolean", "'Yes'", None),
        ("boolean", "'maybe'", TYPECAST),
        ("number", "double('nan')", SIZE_LIMIT),
        ("number", "-12.25D", None),
        ("number", "'123.456'", None),
        ("number", "'1e28'", None),
        ("number", "'-1e28'", None),
        ("number", "'1e29'", SIZE_LIMIT),
        ("number", "'-1e29'", SIZE_LIMIT),
        ("number", "'1E40'", SIZE_LIMIT),
        ("number", "'99999999999999999999999999999.9999999999'", SIZE_LIMIT),
        ("number", "'0.12345678901234567890'", None),
        ("number", "1e40D", SIZE_LIMIT),
        ("number", "'--1'", TYPECAST),
        ("date", "'2026-06-25'", None),
        ("date", "'9999-12-31'", None),
        ("date", "'0000-01-01'", None),
        ("date", "'+10000-01-01'", SIZE_LIMIT),
        ("date", "'-0001-12-31'", SIZE_LIMIT),
        ("date", "date_from_unix_date(2932897)", SIZE_LIMIT),
        ("timestamp_tz", "'2026-06-25 12:00:00+09:00'", None),
        ("timestamp_tz", "timestamp_seconds(253402300799)", None),
        ("timestamp_tz", "timestamp_seconds(253402300800)", SIZE_LIMIT),
        ("timestamp_tz", "timestamp_seconds(-62167219200)", None),
        ("timestamp_tz", "timestamp_millis(-62167219200001)", SIZE_LIMIT),
        ("timestamp_ntz", "'2026-06-25 12:00:00'", None),
        ("timestamp_ntz", "timestamp_ntz'9999-12-31 23:59:59.999999'", None),
        ("timestamp_ntz", "timestamp_ntz'9999-12-31 23:59:59' + interval 1 second", SIZE_LIMIT),
        ("string", "'anything'", None),
        ("boolean", "true", None),
    ],
)
def test_value_ranges(spark, kind, value, reason):
    assert check(spark, kind, value) == (reason is None, reason)


def test_null_is_no_change(spark):
    for kind in ("integer", "number", "date", "timestamp_tz", "string"):
        assert check(spark, kind, "cast(null as string)") == (False, None)


def test_changes_join_existing_meta(spark):
    df = spark.createDataFrame(
        [
            ('{"sync_id":"5","n":1,"changes":[{"field":"z","change":"NULLED","reason":"R"}]}', "9" * 30, "1e30"),
            (None, "9" * 30, "1"),
            ('{"a":{"b":2}}', "1", "1"),
            ("[1]", "9" * 30, "1"),
            ('{"b":{"changes":[]}}', "9" * 30, "1"),
            ('{"c":"x","changes":[]}', "9" * 30, "1"),
        ],
        "_meta string, i string, n string",
    )
    rows = validate(df, [Field("i", "integer"), Field("n", "number")])
    assert rows.columns[-1] == "_meta"
    metas = [json.loads(r["_meta"]) for r in rows.collect()]
    assert metas[0]["sync_id"] == "5" and metas[0]["n"] == 1
    assert [c["field"] for c in metas[0]["changes"]] == ["z", "i", "n"]
    assert [c["field"] for c in metas[1]["changes"]] == ["i"]
    assert metas[2] == {"a": {"b": 2}}
    assert [c["field"] for c in metas[3]["changes"]] == ["i"]
    assert metas[4]["b"] == {"changes": []} and [c["field"] for c in metas[4]["changes"]] == ["i"]
    assert metas[5]["c"] == "x" and [c["field"] for c in metas[5]["changes"]] == ["i"]
    report = {tuple(r) for r in validation_report(rows).collect()}
    assert report == {("z", "R", 1), ("i", SIZE_LIMIT, 5), ("n", SIZE_LIMIT, 1)}


def test_unreadable_text_can_fail_and_rules_can_be_added(spark):
    df = spark.createDataFrame([("x",)], "v string")
    with pytest.raises(Exception, match="cannot read as integer"):
        validate(df, [Field("v", "integer")], on_unreadable="fail").collect()
    rules = {"string": (lambda value, typed, source: F.length(value) > 3,)}
    kept = validate(spark.createDataFrame([("abc",), ("abcd",)], "v string"), [Field("v", "string")], rules=rules)
    assert [r["v"] for r in kept.collect()] == ["abc", None]


CSV_FIELDS = (Field("id", "integer"), Field("name", "string"), Field("_deleted_at", "string"))


def cdc_spec(**changes):
    settings = dict(name="orders", fields=CSV_FIELDS, mode=SyncMode.DEDUP, primary_key=("id",), order_by=("_raw_id",))
    return StreamSpec(**{**settings, **changes})


def csv_of(spark, values, schema, op=None):
    df = spark.createDataFrame([values], schema)
    return df.select(csv_line(df, None, op)).first()[0]


@pytest.mark.parametrize(
    "values, soft, expected",
    [
        (("rid-1", 7, "alice", "2026-01-01T00:00:00Z"), False, '"rid-1",7,"alice","2026-01-01T00:00:00Z",1'),
        (("rid-2", 8, "bob", None), False, '"rid-2",8,"bob",\\N,0'),
        (("rid-9", 42, "erin", "2026-01-01T00:00:00Z"), True, '"rid-9",42,"erin","2026-01-01T00:00:00Z",0'),
    ],
)
def test_csv_operation_cell(spark, values, soft, expected):
    op = op_code(cdc_spec(soft_delete=soft))
    assert csv_of(spark, values, "_raw_id string, id long, name string, _deleted_at string", op) == expected


def test_csv_cells(spark):
    df = spark.sql(
        """SELECT 'she said "hi", ok' AS s, named_struct('k', 'v', 'n', cast(null as int)) AS o, array(1, 2) AS a,
                  true AS t, false AS f, date'2026-01-02' AS d, cast(null as string) AS z, '' AS e,
                  to_timestamp('2026-06-24T10:53:44.987+09:00') AS tz, timestamp_ntz'2026-06-24 08:00:01.5' AS ntz,
                  12345.678901234567890BD AS n, '\\\\N' AS marker"""
    )
    line = df.select(csv_line(df)).first()[0]
    assert line == (
        '"she said ""hi"", ok","{""k"":""v"",""n"":null}","[1,2]",1,0,2026-01-02,\\N,"",'
        '2026-06-24 01:53:44,2026-06-24 08:00:01,12345.678901234567890,"\\N"'
    )


def test_csv_times_are_bare_and_numbers_keep_their_scale(spark):
    fields = [Field("t", "time_tz"), Field("n", "number"), Field("i", "integer"), Field("u", "union")]
    df = spark.createDataFrame([("10:53:44+09:00", "1.500", "9" * 30, "x")], "t string, n string, i string, u string")
    kept = validate(df, fields, cast=False).drop("_meta")
    assert kept.select(csv_line(kept, fields)).first()[0] == '10:53:44+09:00,1.500,\\N,"x"'


def test_timestamps_ignore_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_seconds(1782265999) AS tz, timestamp_ntz'2024-03-10 02:30:00' AS ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        line = df.select(csv_line(df)).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert line == "2026-06-24 01:53:19,2024-03-10 02:30:00"


def test_json_line(spark):
    df = spark.createDataFrame(
        [("rid", 2**63 - 1, "\\N", "12345.678901234567890", None, True)],
        "_raw_id string, id long, name string, amount string, _deleted_at string, b boolean",
    )
    row = json.loads(df.select(json_line(df, None, F.lit(1))).first()[0])
    assert row == {
        "_raw_id": "rid", "id": "9223372036854775807", "name": "\\N", "amount": "12345.678901234567890",
        "_deleted_at": None, "b": True, "__op": 1,
    }
    nested = spark.sql("SELECT named_struct('k', 1) AS o, array('x') AS a")
    assert json.loads(nested.select(json_line(nested)).first()[0]) == {"o": '{"k":1}', "a": '["x"]'}


def test_bound_strings_return_to_their_types(spark):
    spec = StreamSpec("t", (Field("i", "integer"), Field("b", "boolean"), Field("n", "number"), Field("t", "timestamp_ntz")))
    shaped = intake(
        spark.sql("SELECT 'r' AS _raw_id, 9223372036854775807 AS i, true AS b, '1.50' AS n, timestamp_ntz'2024-01-01 01:02:03.5' AS t"),
        spec, extracted_at=F.lit("2024-01-01 00:00:00").cast("timestamp"),
    )
    bound = bind_strings(shaped, spec.fields)
    assert {f.dataType for f in bound.schema} == {T.StringType()}
    row = bound.first()
    assert (row["i"], row["b"], row["n"], row["t"]) == ("9223372036854775807", "1", "1.500000000", "2024-01-01 01:02:03")
    typed = typed_from_strings(bound, spec).first()
    assert typed["i"] == 2**63 - 1 and typed["b"] is True and str(typed["n"]) == "1.500000000"


@pytest.mark.parametrize("layout", ["csv", "json"])
def test_encoded_files_read_back(spark, tmp_path, layout):
    spec = cdc_spec()
    rows = [("r1", 1, 'a "b",\nc', None), ("r2", 2, "\\N", "t"), ("r3", 3, "", None)]
    df = intake(
        spark.createDataFrame(rows, "_raw_id string, id long, name string, _deleted_at string"), spec,
        extracted_at=F.lit("2024-01-01 00:00:00").cast("timestamp"),
    )
    path = str(tmp_path / layout)
    write_encoded(df, spec, path, layout, "gzip" if layout == "json" else "none")
    manifest = json.loads((tmp_path / layout / "_columns.json").read_text())
    assert manifest["columns"] == [*spec.final_columns, "__op"]
    schema = ", ".join(f"`{c}` string" for c in manifest["columns"])
    back = {r["_raw_id"]: r for r in read_encoded(spark, path, schema, layout).collect()}
    assert back["r1"]["name"] == 'a "b",\nc' and back["r1"]["_deleted_at"] is None
    assert [back[f"r{i}"]["__op"] for i in (1, 2, 3)] == ["0", "1", "0"]
    # The marker text is NULL after a CSV trip only.
    assert back["r2"]["name"] == (None if layout == "csv" else "\\N")
    assert back["r3"]["name"] == ""


def test_sink_choice_and_compression(spark, tmp_path):
    assert [choose_layout(True, True), choose_layout(False, True), choose_layout()] == ["jdbc", "json", "csv"]
    assert check_compression("json", "gzip") == "gzip" and check_compression("parquet", "zstd") == "zstd"
    for layout, name in (("csv", "gzip"), ("json", "zstd"), ("json", "lzma")):
        with pytest.raises(ValueError):
            check_compression(layout, name)
    spec = StreamSpec("t", (Field("text", "string"),))
    df = shape(spark.createDataFrame([("r", "x" * 2000)], "_raw_id string, text string"), spec)
    for name in ("none", "gzip"):
        write(df, spec, str(tmp_path / name), "json", compression=name)
    size = {n: sum(p.stat().st_size for p in (tmp_path / n).glob("part-*")) for n in ("none", "gzip")}
    assert size["gzip"] < size["none"]
    texts = [spark.read.text(str(tmp_path / n)).first()[0] for n in ("none", "gzip")]
    assert json.loads(texts[0])["text"] == json.loads(texts[1])["text"] == "x" * 2000
    write(df, spec, str(tmp_path / "p"), "parquet")
    assert read_records(spark, str(tmp_path / "p"), df.schema).count() == 1
    with pytest.raises(ValueError):
        write(df, spec, str(tmp_path / "q"), "xml")


def test_jdbc_sink_binds_text(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    seen = {}

    def fake(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, mode=mode, properties=properties)

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake)
    spec = StreamSpec("t", (Field("i", "integer"),))
    df = intake(spark.createDataFrame([("r", 1)], "_raw_id string, i long"), spec)
    write(df, spec, "jdbc:x", "jdbc", table="db.t", user="u")
    assert seen == {"url": "jdbc:x", "table": "db.t", "mode": "append", "properties": {"user": "u"}}
    fields = (Field("i", "integer"), Field("_deleted_at", "timestamp_tz"))
    gone = StreamSpec("t", fields, mode=SyncMode.DEDUP, primary_key=("i",), order_by=("i",), names=MetaNames(deleted_at="_deleted_at"))
    rows = spark.sql("select 'r' as _raw_id, 1L as i, timestamp '2024-01-01 00:00:00' as _deleted_at")
    with pytest.raises(ValueError, match="deletes"):
        write(intake(rows, gone), gone, "jdbc:x", "jdbc", table="db.t")


def test_intake_fills_renames_and_orders(spark):
    spec = StreamSpec("t", (Field("id", "integer"), Field("late", "number"), Field("new", "string")), renames={"old": "new"}, generation_id=4)
    df = spark.createDataFrame([("r", "x", 1, "extra")], "_raw_id string, old string, id long, other string")
    out = intake(df, spec)
    assert out.columns == ["_raw_id", "_extracted_at", "_meta", "_generation_id", "id", "late", "new"]
    row = out.first()
    assert (row["_meta"], row["_generation_id"], row["late"], row["new"]) == ('{"changes":[]}', 4, None, "x")
    with pytest.raises(ValueError, match="raw_id"):
        intake(df.drop("_raw_id"), spec)


def test_type_names(spark):
    names = ["varchar(1048576)", "decimal(38,9)", "DECIMAL128(10, 2)", "bigint", "char", "datetime", "json", "largeint", "boolean ", "date"]
    expected = ["STRING", "DECIMAL(38, 9)", "DECIMAL(38, 9)", "BIGINT", "STRING", "DATETIME", "JSON", "LARGEINT", "BOOLEAN", "DATE"]
    assert [kinds.canonical_type(n) for n in names] == expected
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(kinds.canonical_type_column(F.col("n"))).collect()] == expected
    assert kinds.quote_identifier("a`b") == "`a``b`"
    assert kinds.target_type("object", True) == "JSON" and kinds.target_type("object") == "STRING"
    assert kinds.spark_type("object", True) == T.VariantType()
    for kind in ("time_tz", "time_ntz", "array", "union", "unknown"):
        assert kinds.target_type(kind) == "STRING"
    with pytest.raises(ValueError):
        Field("x", "money")


def test_layout_puts_keys_first():
    spec = StreamSpec(
        "t", (Field("name", "string"), Field("region", "string"), Field("id", "integer")), SyncMode.DEDUP,
        primary_key=("id", "region"), order_by=("name",),
    )
    layout = describe(spec)
    assert [c.name for c in layout.columns] == ["id", "region", *spec.names.envelope, "name"]
    assert [c.nullable for c in layout.columns] == [False] * 6 + [True]
    assert layout.model is KeyModel.PRIMARY
    append = describe(StreamSpec("t", (Field("id", "integer"),)))
    assert append.keys == ("_raw_id",) and append.model is KeyModel.DUPLICATE
    for keys in ((), ("nope",)):
        with pytest.raises(ValueError):
            arrange([TableColumn("id", T.LongType(), True)], keys, KeyModel.PRIMARY)


def test_schema_diff_and_rebuild(spark):
    old = StreamSpec("t", (Field("id", "integer"), Field("code", "string"), Field("amount", "integer"), Field("gone", "string")),
                     SyncMode.DEDUP, primary_key=("id",), order_by=("amount",))
    new = StreamSpec("t", (Field("id", "integer"), Field("code", "integer", False), Field("amount", "number"), Field("note", "string", False)),
                     SyncMode.DEDUP, primary_key=("id",), order_by=("amount",))
    actual = discover(describe(old).schema, MetaNames())
    assert diff(actual, desired(old)).is_noop
    change = diff(actual, desired(new))
    assert (set(change.add), set(change.drop), set(change.change), set(change.retain)) == (
        {"note"}, {"gone"}, {"code", "amount"}, {"id"})
    assert change.change["code"] == (ColumnType("STRING", True), ColumnType("BIGINT", False))
    layout = evolved_layout(describe(old), new, change)
    nullable = {c.name: c.nullable for c in layout.columns}
    assert nullable["id"] is False and nullable["code"] and nullable["note"]
    rows = spark.sql(
        "SELECT 1L AS id, 'r' AS _raw_id, timestamp'2024-01-01' AS _extracted_at, '{}' AS _meta, 0L AS _generation_id, "
        "'7' AS code, 9007199254740993L AS amount, 'x' AS gone")
    row = evolve(rows, layout, change).first()
    assert (row["code"], str(row["amount"]), row["note"]) == (7, "9007199254740993.000000000", None)
    assert "gone" not in row.asDict()


def test_reserved_operation_column():
    columns = ["id", "__op"]
    assert [op_column_collides(True, False, columns), op_column_collides(True, True, columns),
            op_column_collides(False, False, columns), op_column_collides(True, False, ["id"])] == [True, False, False, False]
    clash = cdc_spec(fields=(*CSV_FIELDS, Field("__op", "string")))
    for soft in (False, True):
        with pytest.raises(ValueError, match="reserved"):
            check_op_column(cdc_spec(fields=(*CSV_FIELDS, Field("__op", "string")), soft_delete=soft))
    check_op_column(clash, sql_sink=True)


def test_spec_checks():
    assert cdc_spec().cdc_delete and not cdc_spec(fields=CSV_FIELDS[:2]).cdc_delete
    assert not StreamSpec("t", CSV_FIELDS).cdc_delete
    assert cdc_spec().target(" ") == ("default", "orders") and cdc_spec(namespace="n").target("d") == ("n", "orders")
    assert [f.nullable for f in cdc_spec().final_fields] == [False, True, True]
    with pytest.raises(ValueError, match="nested"):
        cdc_spec(primary_key=(("a", "b"),))
    for bad in (dict(primary_key=()), dict(order_by=()), dict(order_by=("nope",)), dict(primary_key=("nope",)),
                dict(fields=(*CSV_FIELDS, Field("id", "string"))), dict(fields=(*CSV_FIELDS, Field("_meta", "string")))):
        with pytest.raises(ValueError):
            cdc_spec(**bad)


def test_encode_needs_declared_order(spark):
    spec = cdc_spec(fields=CSV_FIELDS[:2])
    df = shape(spark.createDataFrame([(1, "dan", "rid-4")], "id long, name string, _raw_id string"), spec,
               extracted_at=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert encode(df, spec, "csv").first()[0] == '"rid-4",2024-01-01 00:00:00,"{""changes"":[]}",0,1,"dan"'
    assert column_manifest(spec, "csv")["columns"] == spec.final_columns
    with pytest.raises(ValueError):
        encode(df, spec, "xml")
