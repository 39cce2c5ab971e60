"""Staged refresh, flush with resume, stored history, changelogs, records as JSON text."""

import pytest
from pyspark.sql import functions as F

from tablesync import Field, StreamSpec, SyncMode, TableStore
from tablesync.operators.batches import assign_batches, tree_labels
from tablesync.operators.history import change_history
from tablesync.operators.merge import replay
from tablesync.plans.flush import flush
from tablesync.plans.sync import sync
from tablesync.sources.records import TooManyRejected, as_columns, found_fields, load_texts, parsed, widened
from tablesync.streaming.stream import stream_texts

FIELDS = (Field("id", "integer"), Field("name", "string"), Field("seq", "integer"))
LOG = StreamSpec("people", FIELDS, namespace="db")
KEYED = StreamSpec("people", (*FIELDS, Field("_deleted_at", "string")), SyncMode.DEDUP, "db", ("id",), ("seq",))


def records(spark, rows):
    df = spark.createDataFrame([(*r, None)[:4] for r in rows], "id long, name string, seq long, _deleted_at string")
    return df.select(F.concat(F.lit("r"), F.col("seq")).alias("_raw_id"), F.lit("2026-01-01 00:00:00").cast("timestamp").alias("_extracted_at"), *df.columns)


def state(store, *columns):
    return sorted(tuple(r) for r in store.read("db", "people").select(*(columns or ("id", "name"))).collect())


@pytest.fixture
def store(spark, root):
    return TableStore(spark, root, buckets=4)


def refresh(spec, generation):
    return StreamSpec(**{**spec.__dict__, "generation_id": generation, "minimum_generation_id": generation})


@pytest.mark.parametrize("spec", [LOG, KEYED])
def test_refresh_is_seen_at_its_end_and_once(spark, store, spec):
    sync(store, spec, records(spark, [(1, "old", 1), (2, "old", 2)]))
    first, second = records(spark, [(1, "new", 3)]), records(spark, [(3, "new", 4)])
    spec = refresh(spec, 2)
    sync(store, spec, first, label="content", complete=False)
    again = TableStore(spark, store.root, buckets=4)
    assert sync(again, spec, first, label="content", complete=False).status == "Label Already Exists"
    assert state(store) == [(1, "old"), (2, "old")]
    sync(again, spec, second, label="content")
    assert state(store) == [(1, "new"), (3, "new")]
    # Both batches are known to the table that took over.
    for batch in (first, second):
        assert sync(again, spec, batch, label="content").status == "Label Already Exists"
    assert sync(again, spec, records(spark, [(4, "late", 5)]), label="content").upserts == 1
    assert state(store) == [(1, "new"), (3, "new"), (4, "late")] and store.generation_id("db", "people") == 2


def test_one_batch_refresh_sent_twice_is_stored_once(spark, store):
    spec = refresh(LOG, 2)
    for _ in range(2):
        sync(store, spec, records(spark, [(1, "a", 1)]), label="content")
    assert state(store) == [(1, "a")]


def test_overwrite_in_several_batches_of_a_generation(spark, store):
    spec = StreamSpec("people", FIELDS, SyncMode.OVERWRITE, "db", generation_id=3)
    sync(store, StreamSpec("people", FIELDS, SyncMode.OVERWRITE, "db", generation_id=2), records(spark, [(9, "old", 1)]))
    sync(store, spec, records(spark, [(1, "a", 1)]))
    sync(store, spec, records(spark, [(2, "b", 2)]))
    assert state(store) == [(1, "a"), (2, "b")]
    plain = StreamSpec("people", FIELDS, SyncMode.OVERWRITE, "db")
    for row in ((3, "c", 3), (4, "d", 4)):
        sync(store, plain, records(spark, [row]))
    assert state(store) == [(4, "d")]


def test_refresh_by_an_empty_batch_and_after_a_lost_removal(spark, store, monkeypatch):
    spec = StreamSpec("people", FIELDS, SyncMode.OVERWRITE, "db")
    sync(store, spec, records(spark, [(1, "a", 1)]))
    monkeypatch.setattr(TableStore, "_forget", lambda *_: None)
    sync(store, spec, records(spark, [(2, "b", 2)]))
    monkeypatch.undo()
    sync(store, spec, records(spark, [(3, "c", 3)]))
    assert state(store) == [(3, "c")]
    sync(store, spec, records(spark, []))
    assert state(store) == []
    with pytest.raises(LookupError):
        store.promote(refresh(LOG, 8))


def parquet_files(root):
    import pathlib

    return list(pathlib.Path(root).rglob("*.parquet"))


def test_drop_leaves_no_rows(spark, store, root):
    for i in range(3):
        sync(store, KEYED, records(spark, [(1, "a", i), (2, "b", i)]))
    sync(store, refresh(KEYED, 2), records(spark, [(5, "x", 9)]))
    assert state(store) == [(5, "x")] and parquet_files(root)
    store.drop_table("db", "people")
    assert not parquet_files(root)


def test_deferral_survives_an_unchanged_layout(spark, root):
    store = TableStore(spark, root, buckets=2, fold_after=50)
    sync(store, KEYED, records(spark, [(1, "a", 1)]))
    strict = StreamSpec(**{**KEYED.__dict__, "fields": (*KEYED.fields, Field("extra", "string", nullable=False))})
    for i in range(3):
        sync(store, strict, records(spark, [(i, "b", 2 + i)]))
    assert len(store._snapshot("db", "people").deltas) >= 3


# Flush


def people(spark, n):
    return records(spark, [(i, f"n{i % 7}", i) for i in range(n)])


def test_flush_goes_on_after_a_crash(spark, store, monkeypatch):
    rows = people(spark, 95)
    real, calls = TableStore.load_batches, []

    def failing(self, *args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(self, *args)

    monkeypatch.setattr(TableStore, "load_batches", failing)
    with pytest.raises(RuntimeError):
        flush(store, LOG, rows, ["seq"], max_records=10, commit_batches=4)
    assert store.count("db", "people") == 40
    monkeypatch.undo()
    done = flush(store, LOG, rows, ["seq"], max_records=10, commit_batches=4).orderBy("batch_id").collect()
    assert [r.outcome for r in done] == ["already_loaded"] * 4 + ["loaded"] * 6
    assert [r.buffered for r in done] == [10] * 9 + [5]
    assert state(store, "id") == [(i,) for i in range(95)]
    assert store.ledger("db", "people").groupBy("label").count().agg(F.max("count")).first()[0] == 1
    assert {r.outcome for r in flush(store, LOG, rows, ["seq"], max_records=10).collect()} == {"already_loaded"}


def test_flush_with_known_batches_between_and_equal_ones(spark, store):
    flush(store, LOG, people(spark, 30), ["seq"], max_records=10)
    store.drop_table("db", "people")
    flush(store, LOG, people(spark, 30).filter("id >= 10 and id < 20"), ["seq"], max_records=10)
    done = flush(store, LOG, people(spark, 30), ["seq"], max_records=10).orderBy("batch_id").collect()
    assert [r.outcome for r in done] == ["loaded", "already_loaded", "loaded"] and store.count("db", "people") == 30
    twice = records(spark, [(1, "same", 1)] * 20)
    done = flush(store, LOG, twice, ["seq"], max_records=10).collect()
    assert sorted(r.outcome for r in done) == ["already_loaded", "loaded"] and store.count("db", "people") == 40


def test_keyed_flush_equals_sync(spark, store, root):
    rows = records(spark, [(i % 9, f"n{i}", i, "t" if i % 5 == 0 else None) for i in range(60)])
    flush(store, KEYED, rows, ["seq"], max_records=7, commit_batches=3)
    other = TableStore(spark, root + "-other", buckets=3)
    sync(other, KEYED, rows)
    assert state(store, "id", "name", "seq") == state(other, "id", "name", "seq")


def test_flush_of_nothing(spark, store):
    assert flush(store, LOG, people(spark, 0), ["seq"]).collect() == [] and store.count("db", "people") == 0


def test_tree_labels_know_order_and_batch(spark):
    rows = people(spark, 50)
    cut = assign_batches(rows, ["seq"], 20, position="position")
    lines = cut.select("batch_id", "position", "name", F.col("name").alias("line"))
    found = {r.batch_id: r for r in tree_labels(lines, "t", "position", chunk_rows=8).collect()}
    same = {r.batch_id: r for r in tree_labels(lines.repartition(7), "t", "position", chunk_rows=8).collect()}
    assert found == same and [found[i].row_count for i in range(3)] == [20, 20, 10]
    turned = lines.withColumn("position", 19 - F.col("position")).filter("batch_id = 0")
    assert tree_labels(turned, "t", "position", chunk_rows=8).first().label != found[0].label
    plan = tree_labels(lines, "t", "position")._jdf.queryExecution().toString()
    assert "collect_list" not in plan


# History and changes


def test_history_in_batches_equals_history_at_once(spark, store):
    rows = [(i % 6 if i % 3 else 0, f"n{i}", i) for i in range(60)]
    store.create_history(KEYED, "seq")
    for at in range(0, 60, 15):
        result = sync(store, KEYED, records(spark, rows[at : at + 15]), label=f"b{at}")
        assert result.buffered == 15
        assert sync(store, KEYED, records(spark, rows[at : at + 15]), label=f"b{at}").status == "Label Already Exists"
    wanted = change_history(records(spark, rows), ["id"], ["seq"], "seq")
    got = {(r.id, r.seq): r.valid_to for r in store.read("db", "people").collect()}
    assert got == {(r.id, r.seq): r.valid_to for r in wanted.collect()} and len(got) == 60


def test_history_reads_and_rewrites_touched_buckets_only(spark, store):
    store.create_history(KEYED, "seq")
    sync(store, KEYED, records(spark, [(i, "a", i) for i in range(40)]))
    before = store._snapshot("db", "people").parts
    sync(store, KEYED, records(spark, [(7, "b", 100)]))
    after = store._snapshot("db", "people").parts
    assert len(before) == 4 and len(set(before) & set(after)) == 3 and list(after.values()).count(None) == 1


def test_history_refuses_late_events_and_survives_new_columns(spark, store):
    store.create_history(KEYED, "seq")
    sync(store, KEYED, records(spark, [(1, "a", 5)]))
    with pytest.raises(Exception, match="older than what is stored"):
        sync(store, KEYED, records(spark, [(1, "b", 4)]))
    wider = StreamSpec(**{**KEYED.__dict__, "fields": (*KEYED.fields, Field("city", "string"))})
    sync(store, wider, records(spark, [(1, "c", 6)]).withColumn("city", F.lit("x")))
    assert {(r.seq, r.city, r.valid_to) for r in store.read("db", "people").collect()} == {(5, None, 6), (6, "x", None)}
    with pytest.raises(ValueError):
        store.rebucket("db", "people", 2)


def test_changes_replayed_make_the_table(spark, store):
    store.create_table(KEYED, changelog=True)
    batches = [
        [(i, "a", i) for i in range(20)],
        [(3, "b", 30), (4, None, 31, "t"), (50, "new", 32), (60, "gone at once", 33, "t")],
        [(4, "back", 40), (3, None, 41, "t"), (50, "newer", 42)],
    ]
    versions, states = [], []
    for rows in batches:
        versions.append(sync(store, KEYED, records(spark, rows)).version)
        states.append(state(store, "id", "name", "seq"))
    kinds = {(r._version, r._change, r.id) for r in store.changes("db", "people", versions[0]).collect()}
    assert kinds == {
        (versions[1], "update_before", 3), (versions[1], "update_after", 3), (versions[1], "delete", 4), (versions[1], "insert", 50),
        (versions[2], "insert", 4), (versions[2], "delete", 3), (versions[2], "update_before", 50), (versions[2], "update_after", 50),
    }
    assert len(store._snapshot("db", "people").parts) <= 4
    empty = store.read("db", "people").limit(0)
    for at, wanted in zip(versions, states):
        copy = replay(empty, store.changes("db", "people", upto=at), ["id"])
        assert sorted(tuple(r) for r in copy.select("id", "name", "seq").collect()) == wanted
    with pytest.raises(ValueError):
        store.create_table(StreamSpec("other", FIELDS, namespace="db"), changelog=True)


# Records as text


def texts(spark, rows):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(rows)], "number string, body string").withColumn("at", F.lit("2026-01-01 00:00:00").cast("timestamp"))


ROWS = ['{"id": 1, "name": "a", "seq": 1.50}', "{broken", "[1]", '{"name": "no key", "seq": 3}', None, "", "null", '{"id": 2, "name": {"first": "b"}, "seq": 123456789012345678901}']


def test_fields_are_found(spark):
    read = parsed(texts(spark, ROWS), "body")
    found = {f.name: f.kind for f in found_fields(read)}
    assert found == {"id": "integer", "name": "string", "seq": "number"}
    wide = widened(StreamSpec("x", (Field("seq", "integer"),)), found_fields(read))
    assert {f.name: f.kind for f in wide.fields} == found
    values = {r.id: (r.name, r.seq) for r in as_columns(read.filter("reason IS NULL"), wide.fields).collect()}
    assert values["1"] == ("a", "1.5") and values["2"] == ('{"first":"b"}', "123456789012345678901")
    assert found_fields(read.filter("false")) == []


def test_rejects_are_kept_with_their_reason(spark, store):
    spec = StreamSpec("people", FIELDS, SyncMode.DEDUP, "db", ("id",), ("seq",))
    result, rejected = load_texts(store, spec, texts(spark, ROWS), "body", "number", "at", "one")
    assert (result.upserts, rejected) == (2, 6)
    reasons = {(r._raw_id, r.reason) for r in store.read("db", "people.rejected").collect()}
    assert reasons == {("1", "not JSON"), ("2", "not an object"), ("3", "no key"), ("4", "not JSON"), ("5", "not JSON"), ("6", "not an object")}
    load_texts(store, spec, texts(spark, ROWS), "body", "number", "at", "one")
    assert store.count("db", "people.rejected") == 6 and store.count("db", "people") == 2


def test_too_many_rejects_give_the_load_up(spark, store):
    with pytest.raises(TooManyRejected):
        load_texts(store, LOG, texts(spark, ROWS), "body", "number", "at", "one", most_rejected=0.2)
    assert store.count("db", "people") is None


def test_stream_goes_on_with_columns_found_before(spark, store, tmp_path):
    spec = StreamSpec("people", FIELDS, SyncMode.DEDUP, "db", ("id",), ("seq",))

    def run(rows):
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(str(tmp_path / "in"))
        stream = spark.readStream.schema("value string").format("text").load(str(tmp_path / "in"))

        def envelope(df):
            return df.select("*", F.sha2("value", 256).alias("_raw_id"), F.lit("2026-01-01 00:00:00").cast("timestamp").alias("_extracted_at"))

        stream_texts(stream, "value", store, spec, str(tmp_path / "checkpoint"), envelope).awaitTermination()

    run(['{"id": 1, "name": "a", "seq": 1, "score": 5}', "{"])
    run(['{"id": 2, "name": "b", "seq": 2, "score": 2.5, "tags": ["x"], "nothing": null}'])
    run(['{"id": 1, "name": "c", "seq": 3}'])
    rows = {r.id: r for r in store.read("db", "people").collect()}
    assert (rows[1].name, rows[1].score, rows[1].tags) == ("c", None, None)
    assert float(rows[2].score) == 2.5 and rows[2].tags == '["x"]' and "nothing" not in rows[2]
    assert store.count("db", "people.rejected") == 1
