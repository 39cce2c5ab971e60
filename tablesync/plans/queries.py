"""Every operator as a query over the given tables.

``events`` serves as a change log (key ``user_id``, order ``ts, event_id``, delete
on type ``error``), ``orders`` and ``customer`` as dimension streams, ``lineitem``
for composite keys, ``documents`` for text that needs quoting.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.functions.compress import decompress
from tablesync.functions.encode import bind_strings, csv_line, encode, json_line, op_code
from tablesync.functions.types import to_kind
from tablesync.functions.validate import validate, validation_report
from tablesync.operators import batches, ledger, merge, resolve, schema
from tablesync.operators.history import change_history as history
from tablesync.operators.intake import intake
from tablesync.plans.flush import flush
from tablesync.plans.sync import result_of, sync
from tablesync.session import new_work_path
from tablesync.sources.readers import stream_records
from tablesync.sources.records import field_text, load_texts
from tablesync.sources.store import TableStore
from tablesync.spec import Field, MetaNames, StreamSpec, SyncMode
from tablesync.streaming.stream import stream_append as start_append, stream_sync, stream_texts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NAMES = MetaNames("raw_id", "extracted_at", "meta", "generation_id", "deleted_at", "op")

ACTIVITY = StreamSpec(
    name="activity",
    fields=(
        Field("user_id", "integer"),
        Field("event_id", "integer"),
        Field("ts", "timestamp_ntz"),
        Field("event_type", "string"),
        Field("value", "number"),
        Field("props", "object"),
        Field("deleted_at", "timestamp_ntz"),
    ),
    mode=SyncMode.DEDUP,
    primary_key=("user_id",),
    order_by=("ts", "event_id"),
    namespace="demo",
    names=NAMES,
)
ACTIVITY_LOG = replace(ACTIVITY, mode=SyncMode.APPEND, primary_key=(), order_by=())

CUSTOMER_ORDERS = StreamSpec(
    name="customer_orders",
    fields=(
        Field("o_custkey", "integer"),
        Field("o_orderkey", "integer"),
        Field("o_orderstatus", "string"),
        Field("o_totalprice", "number"),
        Field("o_orderdate", "timestamp_ntz"),
        Field("o_orderpriority", "string"),
    ),
    mode=SyncMode.DEDUP,
    primary_key=("o_custkey",),
    order_by=("o_orderdate", "o_orderkey"),
    namespace="demo",
    names=NAMES,
)
ORDERS = replace(CUSTOMER_ORDERS, name="orders", mode=SyncMode.APPEND, primary_key=(), order_by=())

HALF = "2024-01-16 00:00:00"
BATCH_ROWS = 1000
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the tombstone of a change feed: errors are deletes."""
    return with_tombstone(table(spark, sf_dir, "events"))


def with_tombstone(events: DataFrame) -> DataFrame:
    return events.withColumn("deleted_at", F.when(F.col("event_type") == "error", F.col("ts")))


def before(df: DataFrame) -> DataFrame:
    return df.filter(F.col("ts") < F.lit(HALF).cast("timestamp_ntz"))


def after(df: DataFrame) -> DataFrame:
    return df.filter(F.col("ts") >= F.lit(HALF).cast("timestamp_ntz"))


def enveloped(spark: SparkSession, sf_dir: str, spec: StreamSpec = ACTIVITY, generation=None) -> DataFrame:
    """Events taken in as records: raw id from the event id, extraction time from the event time."""
    log = change_log(spark, sf_dir).withColumn(
        "generation_id", F.dayofmonth("ts").cast("long") if generation is None else F.lit(generation).cast("long")
    )
    return intake(log, spec, raw_id=F.col("event_id").cast("string"), extracted_at=utc(F.col("ts")))


def utc(ntz):
    """A local timestamp as the instant it names in UTC, whatever the session time zone."""
    span = ntz - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros((span.cast("interval second").cast("decimal(18,6)") * 1_000_000).cast("long"))


def new_store(spark: SparkSession, label: str) -> TableStore:
    return TableStore(spark, new_work_path(spark, label), NAMES, "demo")


# Sync modes


@query
def cdc_hard_delete(spark, sf_dir):
    return result_of(None, change_log(spark, sf_dir), ACTIVITY).drop("deleted_at")


@query
def cdc_soft_delete(spark, sf_dir):
    return result_of(None, change_log(spark, sf_dir), replace(ACTIVITY, soft_delete=True))


@query
def soft_delete_live_rows(spark, sf_dir):
    spec = replace(ACTIVITY, soft_delete=True)
    return merge.soft_live(result_of(None, change_log(spark, sf_dir), spec), spec).drop("deleted_at")


@query
def dedup_upsert(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    target = result_of(None, orders.filter(F.col("o_orderdate") < cut), CUSTOMER_ORDERS)
    return result_of(target, orders.filter(F.col("o_orderdate") >= cut), CUSTOMER_ORDERS)


@query
def append_keep_all(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    again = events.filter(F.col("event_type") == "purchase")
    return result_of(events, again, ACTIVITY_LOG)


@query
def full_refresh_overwrite(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    spec = replace(ORDERS, mode=SyncMode.OVERWRITE)
    store = new_store(spark, "overwrite")
    raw_id, stamp = F.col("o_orderkey").cast("string"), utc(F.col("o_orderdate"))
    sync(store, spec, orders, raw_id, stamp)
    second = orders.withColumn("o_orderstatus", F.lower("o_orderstatus")).withColumn(
        "o_totalprice", F.col("o_totalprice").cast("decimal(38,9)") + 1
    )
    sync(store, spec, second, raw_id, stamp)
    return order_text(store.read("demo", "orders"))


def order_text(orders: DataFrame) -> DataFrame:
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("string").alias("o_totalprice"),
        "o_orderdate", "o_orderpriority",
    )


@query
def generation_refresh(spark, sf_dir):
    store = new_store(spark, "refresh")
    log, raw_id, stamp = change_log(spark, sf_dir), F.col("event_id").cast("string"), utc(F.col("ts"))
    sync(store, replace(ACTIVITY_LOG, generation_id=1), log, raw_id, stamp)
    sync(store, replace(ACTIVITY_LOG, generation_id=2, minimum_generation_id=2), log, raw_id, stamp)
    return store.read("demo", "activity").select("raw_id", "generation_id", "user_id", "event_type", "props")


@query
def change_history(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return history(events, ["user_id"], ["ts", "event_id"], "ts")


@query
def cdc_sync_stored(spark, sf_dir):
    """Two change batches through the stored table, the first one replayed."""
    store = new_store(spark, "cdc")
    log, raw_id, stamp = change_log(spark, sf_dir), F.col("event_id").cast("string"), utc(F.col("ts"))
    for batch in (before(log), before(log), after(log)):
        sync(store, ACTIVITY, batch, raw_id, stamp, label="content")
    return store.read("demo", "activity").select("user_id", "raw_id", "event_id", "ts", "event_type", "props")


# Resolving and merging


@query
def last_event_per_key(spark, sf_dir):
    return resolve.last_event_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


@query
def last_event_window(spark, sf_dir):
    return resolve.last_event_window(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


@query
def last_event_composite_key(spark, sf_dir):
    return resolve.last_event_per_key(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
    )


@query
def order_ties(spark, sf_dir):
    """Events whose time alone does not tell which of a user and type is the last one, if it is kept to the hour."""
    events = table(spark, sf_dir, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return resolve.tied_keys(events, ["user_id", "event_type"], ["hour"])


@query
def op_code_per_record(spark, sf_dir):
    log = change_log(spark, sf_dir)
    return log.select(
        "event_id", op_code(ACTIVITY).alias("hard_op"), op_code(replace(ACTIVITY, soft_delete=True)).alias("soft_op")
    )


@query
def route_operations(spark, sf_dir):
    upserts, deletes = resolve.route(resolve.resolve(change_log(spark, sf_dir), ACTIVITY), "op")
    return routed(upserts, deletes)


@query
def route_without_key(spark, sf_dir):
    upserts, deletes = resolve.route(resolve.with_op(change_log(spark, sf_dir), ACTIVITY), "op")
    return routed(upserts, deletes)


def routed(upserts: DataFrame, deletes: DataFrame) -> DataFrame:
    return upserts.select("user_id", "event_id", F.lit("upsert").alias("route")).unionByName(
        deletes.select("user_id", "event_id", F.lit("delete").alias("route"))
    )


@query
def upsert_by_key(spark, sf_dir):
    """Orders, replaced by what their line items say where there are any."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem")
    update = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_linestatus").alias("o_orderstatus"),
        F.max("l_extendedprice").alias("o_totalprice"),
        F.max("l_shipdate").alias("o_orderdate"),
    )
    return merge.upsert(orders, update, ["o_orderkey"])


@query
def merge_upsert_delete(spark, sf_dir):
    log = change_log(spark, sf_dir)
    target = result_of(None, before(log), ACTIVITY)
    return result_of(target, after(log), ACTIVITY).drop("deleted_at")


@query
def merge_large_batch(spark, sf_dir):
    log = change_log(spark, sf_dir)
    target = result_of(None, before(log), ACTIVITY)
    return result_of(target, after(log), ACTIVITY, large_batch=True).drop("deleted_at")


@query
def delete_by_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    returned = lines.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber")
    return merge.delete_by_key(lines, returned, ["l_orderkey", "l_linenumber"])


@query
def delete_by_key_salted(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    returned = lines.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber")
    return merge.delete_by_key(lines, returned, ["l_orderkey", "l_linenumber"], salt=8)


@query
def order_safe_upsert(spark, sf_dir):
    """The later half arrives first; the older half must not undo it."""
    log = resolve.with_op(change_log(spark, sf_dir), ACTIVITY)
    keys, order = ["user_id"], ["ts", "event_id"]
    stored = resolve.last_event_per_key(after(log), keys, order)
    return merge.live(merge.order_safe_upsert(stored, before(log), keys, order), "op").drop("deleted_at")


@query
def cursor_increment(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return merge.cursor_increment(events, "ts", F.lit(HALF).cast("timestamp_ntz"))


# Validation and typing


@query
def validate_bigint(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = F.concat(F.col("o_orderkey").cast("string"), F.lit("0" * 16))
    return checked(orders.select("o_orderkey", text.alias("v")), "integer", F.col("v").cast("string"))


@query
def validate_decimal(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long").cast("string")
    return checked(orders.select("o_orderkey", F.concat(cents, F.lit("0" * 22)).alias("v")), "number", F.col("v").cast("string"))


@query
def validate_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    # Order dates moved so that some fall past the last valid day.
    return checked(orders.select("o_orderkey", moved(F.col("o_orderdate"), 252_534_758_400).cast("date").alias("v")), "date",
                   F.unix_date("v").cast("string"))


@query
def validate_timestamp(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    later = moved(F.col("o_orderdate"), 252_534_758_400)
    both = validate(
        orders.select("o_orderkey", later.alias("local"), utc(later).alias("instant")),
        [Field("local", "timestamp_ntz"), Field("instant", "timestamp_tz")], NAMES,
    )
    return both.select(
        "o_orderkey",
        F.unix_seconds(utc(F.col("local"))).cast("string").alias("local_seconds"),
        F.unix_seconds("instant").cast("string").alias("instant_seconds"),
        "meta",
    )


def moved(ntz, seconds: int):
    return ntz + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds).cast("decimal(18,6)"))


def checked(df: DataFrame, kind: str, shown) -> DataFrame:
    return validate(df, [Field("v", kind)], NAMES).select("o_orderkey", shown.alias("kept"), "meta")


def doubtful_orders(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long").cast("string")
    return orders.select(
        "o_orderkey",
        F.concat(F.col("o_orderkey").cast("string"), F.lit("0" * 16)).alias("big_key"),
        F.concat(cents, F.lit("0" * 22)).alias("big_price"),
        F.lit('{"sync":1,"changes":[]}').alias("meta"),
    )


DOUBTFUL = [Field("big_key", "integer"), Field("big_price", "number")]


@query
def validation_changes(spark, sf_dir):
    return validate(doubtful_orders(spark, sf_dir), DOUBTFUL, NAMES).select(
        "o_orderkey", F.col("big_key").cast("string").alias("big_key"), F.col("big_price").cast("string").alias("big_price"), "meta"
    )


@query
def validation_report_per_column(spark, sf_dir):
    return validation_report(validate(doubtful_orders(spark, sf_dir), DOUBTFUL, NAMES), NAMES)


@query
def type_cast(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    kinds = {
        "l_orderkey": "integer", "l_linenumber": "integer", "l_quantity": "number", "l_extendedprice": "number",
        "l_discount": "number", "l_returnflag": "string", "l_shipdate": "date",
    }
    typed = lines.select(*(to_kind(F.col(c), lines.schema[c].dataType, kind).alias(c) for c, kind in kinds.items()))
    return typed.select(*(F.col(c).cast("string").alias(c) for c in typed.columns))


@query
def missing_fields(spark, sf_dir):
    """Line items from a source that stopped sending tax and status, after full ones."""
    lines = table(spark, sf_dir, "lineitem")
    kept = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_linestatus"]
    return merge.append(lines.select(*kept), lines.select(*kept[:5]))


@query
def object_as_variant(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    spec = replace(ACTIVITY_LOG, enable_json=True)
    taken = intake(events, spec, raw_id=F.col("event_id").cast("string"))
    return taken.select("event_id", F.variant_get("props", "$.k", "int").alias("k"), F.to_json("props").alias("props"))


@query
def envelope_intake(spark, sf_dir):
    log = change_log(spark, sf_dir).withColumnsRenamed({"event_type": "eventType"})
    spec = replace(ACTIVITY_LOG, renames={"eventType": "event_type"}, generation_id=7)
    taken = intake(log, spec, raw_id=F.col("event_id").cast("string"), extracted_at=utc(F.col("ts")))
    return taken.select(
        "raw_id", F.unix_micros("extracted_at").alias("extracted_micros"), "meta", "generation_id", "user_id",
        "event_id", "ts", "event_type", F.col("value").cast("string").alias("value"), "props",
    )


# Encoding


@query
def csv_encode(spark, sf_dir):
    return encode(enveloped(spark, sf_dir), ACTIVITY, "csv")


@query
def csv_encode_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", csv_line(documents).alias("line"))


@query
def json_encode(spark, sf_dir):
    return encode(enveloped(spark, sf_dir), ACTIVITY, "json")


@query
def sql_bind_strings(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    typed = lines.select(
        *(F.col(c).cast("decimal(38,9)").alias(c) if lines.schema[c].dataType.typeName() == "double" else c for c in lines.columns)
    )
    return bind_strings(typed)


# Batches and ledger


def event_batches(spark, sf_dir, *columns: str) -> DataFrame:
    """The needed columns of the change log, cut into batches."""
    log = change_log(spark, sf_dir).select("event_id", *columns)
    return batches.assign_batches(log, ["event_id"], BATCH_ROWS, position="position")


@query
def batch_assign(spark, sf_dir):
    return event_batches(spark, sf_dir).select("event_id", "batch_id", "position")


def labelled(cut: DataFrame) -> DataFrame:
    body = cut.select("event_id", "user_id", "event_type", "props")
    lines = cut.select("batch_id", "position", csv_line(body).alias("line"))
    return batches.batch_labels(lines, "activity", order_by=["position"])


@query
def batch_labels(spark, sf_dir):
    return labelled(event_batches(spark, sf_dir, "user_id", "event_type", "props"))


@query
def batch_labels_by_row_digest(spark, sf_dir):
    """Labels for very long rows: whole documents, hashed row by row first."""
    documents = table(spark, sf_dir, "documents")
    cut = batches.assign_batches(documents, ["doc_id"], BATCH_ROWS)
    lines = cut.select("batch_id", csv_line(cut.select(*documents.columns)).alias("line"))
    return batches.batch_labels(lines, "documents", digest="rows")


@query
def batch_assign_by_bytes(spark, sf_dir):
    """Documents cut by number and by text bytes, as their sizes differ widely."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("bytes"))
    return batches.assign_batches(
        documents, ["doc_id"], 200, position="position", max_bytes=100_000, size=F.col("bytes")
    )


@query
def batch_assign_greedy(spark, sf_dir):
    """Documents cut so that every batch is the longest that fits its rows and its bytes."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("bytes"))
    return batches.assign_greedy(documents, ["doc_id"], 200, 100_000, F.col("bytes"), position="position")


@query
def batch_bodies(spark, sf_dir):
    """JSON array bodies packed with zstd, unpacked again for comparison."""
    cut = batches.assign_batches(enveloped(spark, sf_dir), ["event_id"], BATCH_ROWS, position="position")
    records = cut.select(*ACTIVITY.final_columns)
    lines = cut.select("batch_id", "position", json_line(records, ACTIVITY.fields, op_code(ACTIVITY), NAMES.op).alias("line"))
    bodies = batches.batch_bodies(lines, "activity", "json", "zstd", order_by=["position"])
    text = decompress(F.col("body"), "zstd").cast("string")
    return bodies.select(
        "batch_id", "label", "row_count", text.alias("text"), (F.length("body") < F.octet_length(text)).alias("is_smaller")
    )


@query
def ledger_dedup(spark, sf_dir):
    """All batches are sent again; those that end before the cut are in the ledger."""
    cut = event_batches(spark, sf_dir, "user_id", "event_type", "props", "ts")
    # One row per batch, used twice.
    labels = labelled(cut).checkpoint()
    ends = cut.groupBy("batch_id").agg(F.max("ts").alias("ts"))
    return ledger.pending(labels, labels.join(before(ends), "batch_id", "left_semi"))


def accounted(spark, sf_dir) -> DataFrame:
    rows = resolve.with_op(event_batches(spark, sf_dir, "value", "deleted_at"), ACTIVITY)
    return ledger.load_accounting(rows, ["batch_id"], "op", rejected=F.col("value") < 1)


@query
def load_accounting(spark, sf_dir):
    return accounted(spark, sf_dir)


@query
def load_outcomes(spark, sf_dir):
    """What a run found of each batch, half of which the run before had loaded."""
    return flushed(spark, sf_dir)[1].select("batch_id", "status", "outcome")


# Table state


def with_generation(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.dayofmonth("ts").cast("long").alias("generation_id"))


@query
def count_rows(spark, sf_dir):
    found = {name: table(spark, sf_dir, name) for name in TABLES}
    return ledger.initial_status(spark, found, "generation_id").select("table_name", "row_count")


@query
def max_generation(spark, sf_dir):
    return ledger.max_generation(with_generation(spark, sf_dir), "generation_id")


@query
def initial_status(spark, sf_dir):
    found = {
        "events": with_generation(spark, sf_dir),
        "orders": table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("long").alias("generation_id")),
        "customer": table(spark, sf_dir, "customer"),
        "no_events": with_generation(spark, sf_dir).filter(F.col("generation_id") > 31),
        "not_there": None,
    }
    return ledger.initial_status(spark, found, "generation_id")


@query
def copy_table(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    fields = (Field("c_custkey", "integer"), Field("c_name", "string"), Field("c_nationkey", "integer"), Field("c_mktsegment", "string"))
    source = StreamSpec("customer", fields, namespace="demo", names=NAMES)
    target = replace(source, name="customer_copy", fields=fields[:3])
    store = new_store(spark, "copy")
    sync(store, source, customer, F.col("c_custkey").cast("string"))
    store.create_table(target)
    store.copy_table(("demo", "customer"), ("demo", "customer_copy"), [f.name for f in target.fields])
    return store.read("demo", "customer_copy").select("raw_id", "generation_id", "c_custkey", "c_name", "c_nationkey")


def evolved(orders: DataFrame, fields: tuple[Field, ...], on_error: str = "fail") -> DataFrame:
    """Discovered columns against wanted ones, then one projection."""
    current = schema.describe(ORDERS)
    rows = schema.conform(orders.withColumn("raw_id", F.col("o_orderkey").cast("string")), current.schema)
    wanted = replace(ORDERS, fields=fields)
    change = schema.diff(schema.discover(rows.schema, NAMES), schema.desired(wanted))
    layout = schema.evolved_layout(current, wanted, change)
    return schema.evolve(rows, layout, change, on_error).drop("extracted_at", "meta", "generation_id")


@query
def evolve_add_drop(spark, sf_dir):
    kept = tuple(f for f in ORDERS.fields if f.name not in ("o_orderpriority", "o_totalprice"))
    return evolved(table(spark, sf_dir, "orders"), (*kept, Field("o_comment", "string", nullable=False)))


@query
def evolve_retype(spark, sf_dir):
    kinds = {"o_custkey": "number", "o_orderdate": "string", "o_orderpriority": "integer"}
    fields = tuple(replace(f, kind=kinds.get(f.name, f.kind)) for f in ORDERS.fields if f.name != "o_totalprice")
    rows = evolved(table(spark, sf_dir, "orders"), (*fields, Field("o_note", "number")), "null")
    return rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns))


@query
def evolve_stored(spark, sf_dir):
    """A stored table gains, loses and retypes columns between two loads."""
    orders = table(spark, sf_dir, "orders")
    store = new_store(spark, "evolve")
    raw_id, stamp = F.col("o_orderkey").cast("string"), utc(F.col("o_orderdate"))
    sync(store, ORDERS, orders, raw_id, stamp)
    fields = tuple(replace(f, kind="number") if f.name == "o_custkey" else f for f in ORDERS.fields if f.name != "o_orderpriority")
    wider = replace(ORDERS, fields=(*fields, Field("o_year", "integer")))
    sync(store, wider, orders.withColumn("o_year", F.year("o_orderdate")), raw_id, stamp)
    rows = store.read("demo", "orders").groupBy("o_custkey", "o_year").agg(F.count(F.lit(1)).alias("orders"))
    return rows.select(*(F.col(c).cast("string").alias(c) for c in ("o_custkey", "o_year")), "orders")


# Streaming


def event_stream(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return stream_records(spark, f"{sf_dir}/events.parquet*", events.schema, maxFilesPerTrigger="64")


@query
def stream_append(spark, sf_dir):
    path = new_work_path(spark, "stream-append")
    events = event_stream(spark, sf_dir)
    start_append(events, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{path}/rows")


@query
def stream_upsert(spark, sf_dir):
    store = new_store(spark, "stream-upsert")

    def prepare(batch: DataFrame) -> DataFrame:
        return intake(with_tombstone(batch), ACTIVITY, F.col("event_id").cast("string"), utc(F.col("ts")))

    stream_sync(
        event_stream(spark, sf_dir), store, ACTIVITY, f"{store.root}/checkpoint", order_safe=True, prepare=prepare
    ).awaitTermination()
    return store.read("demo", "activity").select("user_id", "event_id", "ts", "event_type", "props")


@query
def stream_growing_schema(spark, sf_dir):
    """Events as JSON text in eight files, one for each micro-batch; a field appears in the later ones only."""
    path = new_work_path(spark, "stream-texts")
    events = table(spark, sf_dir, "events").withColumn("_file", F.pmod("event_id", F.lit(8)))
    late = F.when(F.col("_file") >= 4, F.concat(F.lit(',"channel":'), F.to_json(F.struct(F.col("event_type").alias("name"), F.col("_file").alias("n")))))
    known = F.to_json(F.struct("user_id", "event_id", "ts", "event_type", "value", "props", F.when(F.col("event_type") == "error", F.col("ts")).alias("deleted_at")), {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    text = F.concat(known.substr(F.lit(1), F.length(known) - 1), F.coalesce(late, F.lit("")), F.lit("}"))
    # Broken ones among them are set aside.
    texts = events.select(F.when(F.col("event_id") % 97 == 0, F.lit("{broken")).otherwise(text).alias("value"), "_file")
    for number in range(8):
        texts.filter(F.col("_file") == number).select("value").coalesce(1).write.mode("append").text(f"{path}/texts")
    store = new_store(spark, "stream-texts-table")

    def envelope(records: DataFrame) -> DataFrame:
        number = field_text(F.col("record"), "event_id")
        return records.select("*", F.coalesce(number, F.sha2("value", 256)).alias("raw_id"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("extracted_at"))

    stream = stream_records(spark, f"{path}/texts", "value string", "text", maxFilesPerTrigger="1")
    stream_texts(stream, "value", store, ACTIVITY, f"{path}/checkpoint", envelope, order_safe=True).awaitTermination()
    rows = store.read("demo", "activity")
    named = rows.select("user_id", "event_id", "ts", "event_type", F.col("value").cast("string").alias("value"), "props", "raw_id", "channel")
    aside = store.read("demo", "activity.rejected").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return named.unionByName(aside.select(F.col("reason").alias("event_type"), F.col("n").alias("event_id")), allowMissingColumns=True)


# Refreshing, flushing, keeping history and changes


@query
def staged_refresh(spark, sf_dir):
    """A refresh in three batches, one of them sent twice, by a job that starts anew: readers see the old rows until its end."""
    store = new_store(spark, "staged")
    log, raw_id, stamp = change_log(spark, sf_dir), F.col("event_id").cast("string"), utc(F.col("ts"))
    sync(store, replace(ACTIVITY_LOG, generation_id=1), log, raw_id, stamp)
    spec = replace(ACTIVITY_LOG, generation_id=2, minimum_generation_id=2)
    shouted = log.withColumn("event_type", F.upper("event_type"))
    parts = [shouted.filter(F.col("event_id") % 3 == number) for number in range(3)]
    sync(store, spec, parts[0], raw_id, stamp, label="content", complete=False)
    again = TableStore(spark, store.root, NAMES, "demo")
    for part in (parts[0], parts[1]):
        sync(again, spec, part, raw_id, stamp, label="content", complete=False)
    during = again.read("demo", "activity")
    sync(again, spec, parts[2], raw_id, stamp, label="content")
    sync(again, spec, parts[1], raw_id, stamp, label="content")
    columns = ["generation_id", "raw_id", "user_id", "event_type", "props"]
    after = again.read("demo", "activity").select(F.lit("after").alias("seen"), *columns)
    return during.select(F.lit("during").alias("seen"), *columns).unionByName(after)


def flushed(spark, sf_dir) -> tuple[TableStore, DataFrame]:
    """Events flushed by a run that ends half-way and by one that goes on."""
    store = new_store(spark, "flush")
    log, raw_id, stamp = change_log(spark, sf_dir), F.col("event_id").cast("string"), utc(F.col("ts"))
    half = max(1, log.count() // BATCH_ROWS // 2)
    settings = {"raw_id": raw_id, "extracted_at": stamp, "max_records": BATCH_ROWS, "commit_batches": half}
    flush(store, ACTIVITY_LOG, log, ["event_id"], **settings, most_commits=1)
    return store, flush(store, ACTIVITY_LOG, log, ["event_id"], **settings)


@query
def batch_flush(spark, sf_dir):
    """Outcome of every batch in the second run, beside the rows that the table has of it."""
    store, outcomes = flushed(spark, sf_dir)
    rows = store.read("demo", "activity").select(F.col("event_id"))
    stored = batches.assign_batches(rows, ["event_id"], BATCH_ROWS).groupBy("batch_id").agg(F.count(F.lit(1)).alias("stored"), F.min("event_id").alias("first_event"))
    return outcomes.join(stored, "batch_id", "full")


@query
def batch_tree_labels(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    cut = batches.assign_batches(documents, ["doc_id"], BATCH_ROWS, position="position")
    lines = cut.select("batch_id", "position", csv_line(cut.select(*documents.columns)).alias("line"))
    return batches.tree_labels(lines, "documents", "position", chunk_rows=64)


@query
def history_stored(spark, sf_dir):
    """The change history kept by a stored table, to which events come in four ordered batches."""
    store = new_store(spark, "history")
    spec = replace(ACTIVITY, fields=tuple(f for f in ACTIVITY.fields if f.name != "deleted_at"))
    store.create_history(spec, "ts")
    events = table(spark, sf_dir, "events")
    week = F.least(F.expr("dayofmonth(ts) div 8"), F.lit(3))
    for number in range(4):
        sync(store, spec, events.filter(week == number), F.col("event_id").cast("string"), utc(F.col("ts")), label=f"week-{number}")
    rows = store.read("demo", "activity")
    return rows.select("event_id", "user_id", "ts", "event_type", F.col("value").cast("string").alias("value"), "props", "valid_to")


@query
def merge_changelog(spark, sf_dir):
    """What the second of two merges changed, and a copy made of the changes of both."""
    store = new_store(spark, "changelog")
    store.create_table(ACTIVITY, changelog=True)
    log, raw_id, stamp = change_log(spark, sf_dir), F.col("event_id").cast("string"), utc(F.col("ts"))
    first = sync(store, ACTIVITY, before(log), raw_id, stamp)
    sync(store, ACTIVITY, after(log), raw_id, stamp)
    changes = store.changes("demo", "activity")
    copy = merge.replay(store.read("demo", "activity").limit(0), changes, ACTIVITY.keys)
    columns = ["user_id", "event_id", "ts", "event_type", "props"]
    second = changes.filter(F.col("_version") > first.version).select(F.col("_change").alias("change"), *columns)
    return second.unionByName(copy.select(F.lit("copy").alias("change"), *columns))


TALK = StreamSpec(
    name="talk",
    fields=(Field("conv_id", "integer"), Field("turn", "integer"), Field("role", "string"), Field("text", "string")),
    mode=SyncMode.DEDUP,
    primary_key=("conv_id", "turn"),
    order_by=("conv_id", "turn"),
    namespace="demo",
    names=NAMES,
)


@query
def quarantine(spark, sf_dir):
    """Conversations as JSON text, some of it broken, no object or without a key: what is loaded and what is set aside."""
    rows = table(spark, sf_dir, "conversations")
    whole = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    text = (
        F.when(F.col("conv_id") % 11 == 3, whole.substr(F.lit(1), F.length(whole) - 1))
        .when(F.col("conv_id") % 11 == 5, F.to_json(F.array("role", "text")))
        .when((F.col("conv_id") % 11 == 7) & (F.col("turn") == 0), F.to_json(F.struct("conv_id", "role", "text")))
        .otherwise(whole)
    )
    texts = rows.select(F.concat_ws("-", "conv_id", "turn").alias("id"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("at"), text.alias("body"))
    store = new_store(spark, "quarantine")
    load_texts(store, TALK, texts, "body", "id", "at", label="talk-1", most_rejected=0.5)
    load_texts(store, TALK, texts, "body", "id", "at", label="talk-1", most_rejected=0.5)
    good = store.read("demo", "talk").select("raw_id", "conv_id", "turn", "role", "text", F.lit("loaded").alias("reason"))
    return good.unionByName(store.read("demo", "talk.rejected").select("raw_id", "text", "reason"), allowMissingColumns=True)


@query
def json_encode_number_text(spark, sf_dir):
    """Numbers that come as text keep all their digits up to the encoder."""
    lines = table(spark, sf_dir, "lineitem")
    spec = StreamSpec("lines", (Field("l_orderkey", "integer"), Field("price", "number")), names=NAMES)
    price = F.concat(F.round(F.col("l_extendedprice") * 100).cast("long").cast("string"), F.lit("."), F.lpad(F.col("l_partkey").cast("string"), 15, "0"))
    taken = intake(lines.withColumn("price", price), spec, F.concat_ws("-", "l_orderkey", "l_linenumber"), F.lit("2024-01-01 00:00:00").cast("timestamp"), cast=False)
    return encode(taken, spec, "json")
