"""Tables on disk: create, load, swap, evolve, replay, drop."""

import pytest

from tablesync import Field, StreamSpec, SyncMode, TableStore
from tablesync.operators.schema import KeyModel
from tablesync.plans.sync import result_of, sync
from tablesync.sources.store import WriteConflict, content_label
from pyspark.sql import functions as F

FIELDS = (Field("id", "integer"), Field("name", "string"), Field("seq", "integer"), Field("_deleted_at", "string"))


def spec(**changes):
    settings = dict(
        name="people", fields=FIELDS, mode=SyncMode.DEDUP, primary_key=("id",), order_by=("seq",), namespace="db"
    )
    return StreamSpec(**{**settings, **changes})


def records(spark, rows):
    """rows: (id, name, seq, deleted_at)"""
    df = spark.createDataFrame(rows, "id long, name string, seq long, _deleted_at string")
    return df.select(
        F.concat(F.lit("r"), F.col("seq").cast("string")).alias("_raw_id"),
        F.lit("2026-01-01 00:00:00").cast("timestamp").alias("_extracted_at"),
        *df.columns,
    )


def state(store, *columns):
    return sorted(tuple(r) for r in store.read("db", "people").select(*(columns or ("id", "name"))).collect())


@pytest.fixture
def store(spark, root):
    return TableStore(spark, root, buckets=4)


def test_cdc_batches_upsert_and_delete(spark, store):
    first = sync(store, spec(), records(spark, [(1, "a", 1, None), (2, "b", 2, None), (1, "a2", 3, None)]))
    assert (first.upserts, first.deletes) == (2, 0)
    second = sync(store, spec(), records(spark, [(2, "b", 4, "t"), (3, "c", 5, None), (9, "x", 6, "t")]))
    assert (second.upserts, second.deletes) == (1, 2)
    assert state(store) == [(1, "a2"), (3, "c")]


def test_untouched_buckets_are_not_rewritten(spark, store):
    sync(store, spec(), records(spark, [(i, "a", i, None) for i in range(40)]))
    before = set(store._snapshot("db", "people").parts)
    sync(store, spec(), records(spark, [(7, "b", 100, None)]))
    after = set(store._snapshot("db", "people").parts)
    assert len(before) == 4 and len(before & after) == 3
    assert store.count("db", "people") == 40


def test_both_merge_plans_agree(spark, store, monkeypatch):
    import tablesync.sources.store as module

    rows = [(i, "a", i, None) for i in range(50)]
    batch = [(i, "b", 100 + i, "t" if i % 3 == 0 else None) for i in range(25, 75)]
    sync(store, spec(), records(spark, rows))
    sync(store, spec(), records(spark, batch))
    small = state(store)
    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    sync(store, spec(generation_id=1, minimum_generation_id=1), records(spark, rows))
    sync(store, spec(), records(spark, batch))
    assert state(store) == small
    assert len(small) == 25 + sum(1 for i in range(25, 75) if i % 3)


def test_soft_delete_keeps_the_row(spark, store):
    s = spec(soft_delete=True)
    sync(store, s, records(spark, [(1, "a", 1, None)]))
    sync(store, s, records(spark, [(1, "a", 2, "t")]))
    assert state(store, "id", "_deleted_at") == [(1, "t")]


def test_append_keeps_duplicates(spark, store):
    s = spec(mode=SyncMode.APPEND, primary_key=(), order_by=())
    rows = records(spark, [(1, "a", 1, None), (1, "a", 1, "t")])
    sync(store, s, rows)
    sync(store, s, rows)
    assert store.count("db", "people") == 4
    assert store._snapshot("db", "people").layout.model is KeyModel.DUPLICATE


def test_overwrite_replaces_everything(spark, store):
    s = spec(mode=SyncMode.OVERWRITE, primary_key=(), order_by=())
    sync(store, s, records(spark, [(1, "a", 1, None)]))
    sync(store, s, records(spark, [(2, "b", 2, None), (2, "b", 2, None)]))
    assert state(store) == [(2, "b"), (2, "b")]


def test_generation_refresh(spark, store):
    s = spec(mode=SyncMode.APPEND, primary_key=(), order_by=(), generation_id=3)
    sync(store, s, records(spark, [(1, "a", 1, None)]))
    assert store.generation_id("db", "people") == 3
    with pytest.raises(ValueError, match="partly"):
        sync(store, spec(generation_id=4, minimum_generation_id=2), records(spark, []))
    assert state(store) == [(1, "a")]
    sync(store, spec(mode=SyncMode.APPEND, primary_key=(), order_by=(), generation_id=4, minimum_generation_id=4),
         records(spark, [(2, "b", 1, None)]))
    assert state(store, "id", "_generation_id") == [(2, 4)]


def test_content_label_makes_replay_harmless(spark, store):
    s = spec(mode=SyncMode.APPEND, primary_key=(), order_by=())
    rows = records(spark, [(1, "a", 1, None), (2, "b", 2, None)])
    assert sync(store, s, rows, label="content").status == "Success"
    assert sync(store, s, rows.orderBy(F.desc("id")), label="content").status == "Label Already Exists"
    assert sync(store, s, records(spark, [(2, "b", 2, None)]), label="content").status == "Success"
    assert store.count("db", "people") == 3
    loads = store.ledger("db", "people").orderBy("version").collect()
    assert [r["buffered"] for r in loads] == [2, 1]
    assert all(r["label"].startswith("tablesync-people-") for r in loads)


def test_content_label_is_cut_and_ignores_row_order(spark):
    rows = records(spark, [(1, "a", 1, None), (2, "b", 2, None)])
    table = "t" * 60
    label = content_label(rows, table)
    assert label.startswith("tablesync-" + "t" * 48 + "-") and len(label) == 10 + 48 + 1 + 64
    assert content_label(rows.orderBy(F.desc("id")), table) == label
    assert content_label(rows.withColumn("name", F.lit("z")), table) != label


def test_empty_batch_publishes_nothing(spark, store):
    sync(store, spec(), records(spark, [(1, "a", 1, None)]))
    version = store._version("db", "people")
    assert sync(store, spec(), records(spark, [])).version is None
    assert store._version("db", "people") == version
    s = spec(name="log", mode=SyncMode.APPEND, primary_key=(), order_by=())
    assert sync(store, s, records(spark, [])).version is None
    assert store.count("db", "log") == 0


def test_failed_load_leaves_the_table_as_it_was(spark, store):
    sync(store, spec(), records(spark, [(1, "a", 1, None)]))
    with pytest.raises(Exception, match="NULL in key columns"):
        sync(store, spec(), records(spark, [(1, "b", 2, None), (None, "c", 3, None)]))
    assert state(store) == [(1, "a")]


def test_second_writer_fails(spark, store):
    sync(store, spec(), records(spark, [(1, "a", 1, None)]))
    snapshot = store._snapshot("db", "people")
    with pytest.raises(WriteConflict):
        store._publish("db", "people", snapshot)
    left = store.files.names(store._log("db", "people"))
    manifests = [n for n in left if n.endswith(".json")]
    assert len(left) == 2 * len(manifests) and not any(n.endswith(".tmp") for n in left)


def test_swap_and_drop(spark, store):
    s = spec(mode=SyncMode.APPEND, primary_key=(), order_by=())
    sync(store, s, records(spark, [(1, "old", 1, None)]))
    staged = spec(name="people_staging", mode=SyncMode.APPEND, primary_key=(), order_by=())
    sync(store, staged, records(spark, [(2, "new", 2, None)]))
    store.replace_by(("db", "people_staging"), ("db", "people"))
    assert state(store) == [(2, "new")]
    assert not store.table_exists("db", "people_staging")
    store.drop_table("db", "people")
    assert not store.table_exists("db", "people") and store.count("db", "people") is None
    assert store.generation_id("db", "people") == 0
    store.drop_table("db", "people")


def test_add_drop_and_return_of_a_column(spark, store):
    s = spec(mode=SyncMode.APPEND, primary_key=(), order_by=())
    sync(store, s, records(spark, [(1, "a", 1, None)]))
    parts = dict(store._snapshot("db", "people").parts)
    without_name = tuple(f for f in FIELDS if f.name != "name")
    s2 = spec(mode=SyncMode.APPEND, primary_key=(), order_by=(), fields=(*without_name, Field("note", "string", False)))
    store.ensure(s2)
    assert store._snapshot("db", "people").parts == parts  # no rows rewritten
    assert state(store, "id", "note") == [(1, None)]
    assert store.schema("db", "people")["note"].nullable
    version = store._version("db", "people")
    store.ensure(s2)
    assert store._version("db", "people") == version
    store.ensure(s)  # name returns: old values must not
    assert state(store) == [(1, None)]


def test_retype_rewrites_and_failure_keeps_old_rows(spark, store):
    sync(store, spec(), records(spark, [(1, "12", 1, None), (2, "x", 2, None)]))
    retyped = tuple(Field("name", "integer") if f.name == "name" else f for f in FIELDS)
    with pytest.raises(Exception, match="cannot cast"):
        store.ensure(spec(fields=retyped))
    assert state(store) == [(1, "12"), (2, "x")]
    store.ensure(spec(fields=retyped), on_error="null")
    assert [r["name"] for r in store.read("db", "people").orderBy("id").collect()] == [12, None]
    wider = tuple(Field("id", "number") if f.name == "id" else f for f in retyped)
    store.ensure(spec(fields=wider))
    sync(store, spec(fields=wider), records(spark, [(1, "13", 3, None)]))
    assert sorted(int(r["name"] or 0) for r in store.read("db", "people").collect()) == [0, 13]


def test_dropping_a_key_column_fails(spark, store):
    sync(store, spec(), records(spark, [(1, "a", 1, None)]))
    other = tuple(f for f in FIELDS if f.name != "id")
    with pytest.raises(ValueError, match="key columns"):
        store.ensure(spec(fields=other, primary_key=("name",)))
    assert state(store) == [(1, "a")]


def test_preflight_leaves_nothing(spark, store):
    store.preflight("db")
    assert [n for n in store.files.names(f"{store.root}/db") if store.table_exists("db", n)] == []


def test_namespaces_and_status(spark, store):
    assert not store.namespace_exists("db")
    rows = store.setup([spec(), spec(name="other", namespace="n 2")]).collect()
    assert store.namespace_exists("db") and store.namespace_exists("n 2")
    assert {(r["table_name"], r["table_exists"], r["row_count"]) for r in rows} == {
        ("db.people", False, 0),
        ("n 2.other", False, 0),
    }
    sync(store, spec(generation_id=2), records(spark, [(1, "a", 1, None)]))
    row = store.status([("db", "people")]).first()
    assert (row["table_exists"], row["row_count"], row["generation_id"]) == (True, 1, 2)


def test_create_table_keeps_or_replaces(spark, store):
    sync(store, spec(), records(spark, [(1, "a", 1, None)]))
    store.create_table(spec())
    assert store.count("db", "people") == 1
    store.create_table(spec(), replace_existing=True)
    assert store.count("db", "people") == 0


def test_copy_table(spark, store):
    s = spec(mode=SyncMode.APPEND, primary_key=(), order_by=())
    sync(store, s, records(spark, [(1, "a", 1, None)]))
    store.create_table(spec(name="copy", mode=SyncMode.APPEND, primary_key=(), order_by=()))
    store.copy_table(("db", "people"), ("db", "copy"), ["id", "name"])
    assert [(r["_raw_id"], r["id"], r["seq"]) for r in store.read("db", "copy").collect()] == [("r1", 1, None)]


def test_vacuum_keeps_live_rows(spark, store):
    for seq in range(4):
        sync(store, spec(), records(spark, [(1, f"v{seq}", seq, None)]))
    assert store.vacuum("db", "people", keep_versions=1)
    assert state(store) == [(1, "v3")]
    assert store.vacuum("db", "people", keep_versions=1) is not None


def test_odd_names(spark, store):
    fields = (Field("a.b`c", "integer"), Field("seq", "integer"))
    s = StreamSpec("t/1 x", fields, SyncMode.DEDUP, "db", ("a.b`c",), ("seq",))
    df = spark.createDataFrame([("r", 1, 1), ("r", 1, 2)], "_raw_id string, `a.b``c` long, seq long")
    sync(store, s, df)
    sync(store, s, df)
    assert [tuple(r) for r in store.read("db", "t/1 x").select("seq").collect()] == [(2,)]


def test_deferred_merges_read_the_same_and_fold(spark, root):
    at_once = TableStore(spark, root + "-a", buckets=4)
    deferred = TableStore(spark, root + "-b", buckets=4, fold_after=2)
    batches = [
        [(i, "a", i, None) for i in range(20)],
        [(1, "b", 30, None), (2, "b", 31, "t"), (50, "new", 32, None)],
        [(1, "c", 40, "t"), (2, "c", 41, None), (3, "c", 42, None), (3, "d", 43, None)],
        [(4, "e", 50, "t"), (1, "e", 51, None)],
    ]
    waiting = []
    for batch in batches:
        results = [sync(store, spec(), records(spark, batch)) for store in (at_once, deferred)]
        assert [(r.buffered, r.upserts, r.deletes) for r in results[:1]] == [(r.buffered, r.upserts, r.deletes) for r in results[1:]]
        assert state(deferred) == state(at_once)
        assert deferred.count("db", "people") == at_once.count("db", "people")
        waiting.append(len(deferred._snapshot("db", "people").deltas))
    assert waiting == [1, 2, 0, 1]
    assert sync(deferred, spec(), records(spark, [])).version is None
    deferred.fold("db", "people")
    assert not deferred._snapshot("db", "people").deltas and state(deferred) == state(at_once)


def test_deferred_merges_survive_evolution_swap_and_vacuum(spark, root):
    store = TableStore(spark, root, buckets=2, fold_after=5)
    sync(store, spec(), records(spark, [(1, "1", 1, None), (2, "2", 2, None)]))
    sync(store, spec(), records(spark, [(2, "2", 3, "t")]))
    store.replace_by(("db", "people"), ("db", "moved"))
    store.replace_by(("db", "moved"), ("db", "people"))
    assert state(store) == [(1, "1")]
    retyped = tuple(Field("name", "integer") if f.name == "name" else f for f in FIELDS)
    store.ensure(spec(fields=retyped))
    store.vacuum("db", "people", keep_versions=1)
    assert state(store) == [(1, 1)]
    sync(store, spec(fields=retyped), records(spark, [(9, "9", 9, None)]))
    store.drop_table("db", "people")
    assert not store.table_exists("db", "people")


def test_rebucket_keeps_rows(spark, store):
    sync(store, spec(), records(spark, [(i, "a", i, None) for i in range(30)]))
    before = state(store)
    store.rebucket("db", "people", 7)
    assert store._snapshot("db", "people").buckets == 7 and state(store) == before
    assert max(store._snapshot("db", "people").parts.values()) > 3
    sync(store, spec(), records(spark, [(3, "b", 99, None)]))
    assert len(state(store)) == 30 and (3, "b") in state(store)


def test_counts_are_of_events_and_operations(spark, store):
    done = sync(store, spec(), records(spark, [(1, "a", 1, None), (1, "b", 2, None), (2, "c", 3, "t")]))
    assert (done.buffered, done.upserts, done.deletes) == (3, 1, 1)


def test_a_column_named_like_the_operation_survives(spark, store):
    fields = (*FIELDS, Field("__op", "string"))
    rows = records(spark, [(1, "a", 1, None), (1, "b", 2, None), (2, "c", 3, "t")]).withColumn("__op", F.lit("mine"))
    sync(store, spec(fields=fields), rows)
    sync(store, spec(fields=fields), rows.filter("id = 1"))
    assert state(store, "id", "__op") == [(1, "mine")]
    sync(store, spec(fields=fields, generation_id=1, minimum_generation_id=1), rows)
    assert state(store, "id", "__op") == [(1, "mine")]
    assert result_of(None, rows, spec(fields=fields)).select("__op").first()[0] == "mine"
    with pytest.raises(ValueError, match="tombstones"):
        store.create_table(spec(fields=fields), replace_existing=True, tombstones=True)


def test_records_without_raw_id_are_refused(spark, store):
    s = spec(mode=SyncMode.APPEND, primary_key=(), order_by=())
    with pytest.raises(Exception, match="NULL in key columns"):
        sync(store, s, records(spark, [(1, "a", 1, None)]).withColumn("_raw_id", F.lit(None).cast("string")))
    assert store.count("db", "people") == 0


def _event_spec(**changes):
    from tablesync.spec import Field, StreamSpec, SyncMode

    base = {"name": "e", "namespace": "n", "mode": SyncMode.DEDUP, "fields": (Field("id", "integer"), Field("pos", "integer"), Field("ts", "timestamp_ntz")), "primary_key": ("id",), "order_by": ("pos",)}
    return StreamSpec(**{**base, **changes})


def _events(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, pos long, ts string").selectExpr("id", "pos", "cast(ts as timestamp_ntz) as ts")


def test_content_label_sees_fractions_of_a_second(spark, root):
    from tablesync.sources.store import content_label

    one, other = _events(spark, (1, 1, "2024-01-01 10:00:00.100")), _events(spark, (1, 1, "2024-01-01 10:00:00.900"))
    two = _events(spark, (1, 1, "2024-01-01 10:00:00.100"), (2, 1, None))
    assert content_label(one, "t") != content_label(other, "t") == content_label(other, "t")
    assert content_label(two, "t") == content_label(two.orderBy("id", ascending=False).repartition(2), "t")


def test_labels_end_with_the_rows_they_brought(spark, root):
    from tablesync.operators.intake import intake
    from tablesync.sources.store import TableStore

    store, spec = TableStore(spark, root), _event_spec()
    store.create_table(spec)
    batch = intake(_events(spark, (1, 1, None)), spec, F.lit('r'), F.lit('2024-01-01').cast('timestamp'))
    assert store.load(spec, batch, label="L").upserts == 1 and store.load(spec, batch, label="L").upserts == 0
    store.create_table(spec, replace_existing=True)
    assert store.load(spec, batch, label="L").upserts == 1 and store.read("n", "e").count() == 1


def test_refresh_in_several_batches_and_kept_settings(spark, root):
    from tablesync.plans.sync import sync
    from tablesync.sources.store import TableStore

    store = TableStore(spark, root, buckets=3)
    first, second = (_event_spec(generation_id=g, minimum_generation_id=g) for g in (2, 3))
    sync(store, first, _events(spark, (1, 1, None)), F.lit('r'), F.lit('2024-01-01').cast('timestamp'))
    store.rebucket("n", "e", 5)
    sync(TableStore(spark, root), first, _events(spark, (2, 1, None)), F.lit('r'), F.lit('2024-01-01').cast('timestamp'))
    assert sorted(r.id for r in store.read("n", "e").collect()) == [1, 2]
    sync(store, second, _events(spark, (3, 1, None)), F.lit('r'), F.lit('2024-01-01').cast('timestamp'))
    assert [r.id for r in store.read("n", "e").collect()] == [3]
    assert store._snapshot("n", "e").buckets == 5


def test_load_refuses_fields_the_table_lacks(spark, root):
    from tablesync.operators.intake import intake
    from tablesync.sources.store import TableStore
    from tablesync.spec import Field

    store, spec = TableStore(spark, root), _event_spec()
    store.create_table(spec)
    wider = _event_spec(fields=(*spec.fields, Field("extra", "string")))
    with pytest.raises(ValueError, match="extra"):
        store.load(wider, intake(_events(spark, (1, 1, None)), wider, F.lit('r'), F.lit('2024-01-01').cast('timestamp')))


def test_fractions_are_logged_not_cut(spark):
    from tablesync.functions.validate import validate
    from tablesync.spec import Field

    df = spark.sql("select * from values (1.75D), (2.0D), (null) as t(a)")
    got = validate(df, [Field("a", "integer")]).collect()
    assert [r.a for r in got] == [None, 2, None] and "TYPECAST" in str(got[0][-1])


def reads(action):
    """What the action returned, and the folders of the store that it read."""
    plans, get = [], TableStore._rows

    def watched(self, snapshot, parts):
        plans.append(list(parts))
        return get(self, snapshot, plans[-1])

    TableStore._rows = watched
    try:
        return action(), plans
    finally:
        TableStore._rows = get


@pytest.mark.parametrize("mode", [SyncMode.APPEND, SyncMode.DEDUP])
def test_writes_count_in_their_own_pass(spark, store, mode):
    people = spec(mode=mode) if mode is SyncMode.DEDUP else spec(mode=mode, primary_key=(), order_by=())
    batch = records(spark, [(1, "a", 1, None), (2, "b", 2, None), (2, "c", 3, None)])
    done, read = reads(lambda: store.overwrite(people, batch))
    expected = 3 if mode is SyncMode.APPEND else 2
    assert (done.buffered, done.upserts, done.deletes) == (expected, expected, 0) and read == []
    assert store.count("db", "people") == expected
    empty = records(spark, [])
    done, read = reads(lambda: store.overwrite(people, empty))
    assert (done.buffered, done.upserts, done.deletes) == (0, 0, 0) and read == []
    if mode is SyncMode.APPEND:
        done, read = reads(lambda: store.load(people, batch))
        assert (done.buffered, read) == (3, [])
        assert store.load(people, empty).version is None and store.count("db", "people") == 3


def test_overwrite_counts_kept_tombstones_and_deferred_events(spark, root):
    safe = TableStore(spark, root, buckets=4)
    safe.create_table(spec(), tombstones=True)
    batch = records(spark, [(1, "a", 1, None), (2, "b", 2, "2026-01-01"), (3, "c", 3, None)])
    done, read = reads(lambda: safe.overwrite(spec(), batch))
    assert (done.buffered, done.upserts, done.deletes) == (3, 2, 1) and read == []
    assert state(safe, "id") == [(1,), (3,)]
    later = TableStore(spark, root, buckets=4, fold_after=5)
    later.create_table(spec(name="waiting"))
    events = records(spark, [(1, "a", 1, None), (1, "b", 2, None), (2, "c", 3, "2026-01-01")])
    done = later.load(spec(name="waiting"), events)
    assert (done.buffered, done.upserts, done.deletes) == (3, 1, 1)
    assert later.load(spec(name="waiting"), events.limit(0)).buffered == 0
