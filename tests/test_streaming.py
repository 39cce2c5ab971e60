"""Micro-batches: same answer as one batch, replays and late data included."""

import json

import pytest
from pyspark.sql import functions as F

from tablesync import Field, StreamSpec, SyncMode, TableStore
from tablesync.operators.intake import intake
from tablesync.sources.readers import stream_records
from tablesync.streaming.stream import stream_append, stream_sync

FIELDS = (Field("id", "integer"), Field("name", "string"), Field("seq", "integer"), Field("_deleted_at", "string"))
SPEC = StreamSpec("people", FIELDS, SyncMode.DEDUP, "db", ("id",), ("seq",))
SCHEMA = "_raw_id string, id long, name string, seq long, _deleted_at string"

FILES = [
    [(1, "a", 1, None), (2, "b", 2, None)],
    [(1, "a2", 3, None), (2, None, 4, "t")],
    [(3, "c", 5, None), (2, "b2", 6, None), (3, None, 7, "t")],
]


def put(folder, number, rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"_raw_id": f"r{r[2]}", "id": r[0], "name": r[1], "seq": r[2], "_deleted_at": r[3]}) for r in rows]
    (folder / f"{number}.json").write_text("\n".join(lines) + "\n")


def source(spark, folder):
    return stream_records(spark, str(folder), SCHEMA, "json", maxFilesPerTrigger="1")


def state(store):
    return sorted((r["id"], r["name"]) for r in store.read("db", "people").collect())


@pytest.mark.parametrize("fold_after", [0, 1, 5])
@pytest.mark.parametrize("order_safe, order", [(False, (0, 1, 2)), (True, (2, 0, 1)), (True, (1, 2, 0))])
def test_stream_equals_batch(spark, tmp_path, order_safe, order, fold_after):
    store = TableStore(spark, str(tmp_path / "store"), buckets=3, fold_after=fold_after)
    for number in order:
        put(tmp_path / "in", number, FILES[number])
        stream_sync(source(spark, tmp_path / "in"), store, SPEC, str(tmp_path / "check"), order_safe=order_safe).awaitTermination()
    assert state(store) == [(1, "a2"), (2, "b2")]
    if order_safe:
        assert store.schema("db", "people").keys() == {f.name for f in FIELDS}


def test_large_order_safe_plan_agrees(spark, tmp_path, monkeypatch):
    import tablesync.sources.store as module

    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    test_stream_equals_batch(spark, tmp_path, True, (2, 0, 1), 0)


def test_batch_published_before_a_crash_is_not_applied_twice(spark, tmp_path):
    log_spec = StreamSpec("people", FIELDS, SyncMode.APPEND, "db")
    store = TableStore(spark, str(tmp_path / "store"))
    put(tmp_path / "in", 0, FILES[0])

    class Crashing(TableStore):
        def load(self, *args, **options):
            super().load(*args, **options)
            raise RuntimeError("lost after publishing")

    crashing = Crashing(spark, store.root)
    with pytest.raises(Exception, match="lost after publishing"):
        stream_sync(source(spark, tmp_path / "in"), crashing, log_spec, str(tmp_path / "check")).awaitTermination()
    assert store.count("db", "people") == 2
    put(tmp_path / "in", 1, FILES[1])
    stream_sync(source(spark, tmp_path / "in"), store, log_spec, str(tmp_path / "check")).awaitTermination()
    assert store.count("db", "people") == 4


def test_prepare_shapes_raw_records(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    put(tmp_path / "in", 0, FILES[0])

    def prepare(batch):
        return intake(batch.withColumn("name", F.upper("name")), SPEC)

    stream_sync(source(spark, tmp_path / "in"), store, SPEC, str(tmp_path / "check"), prepare=prepare).awaitTermination()
    assert state(store) == [(1, "A"), (2, "B")]


def test_append_counts_add_up_over_restarts(spark, tmp_path):
    out = str(tmp_path / "out")
    for number, rows in enumerate(FILES):
        put(tmp_path / "in", number, rows)
        stream_append(source(spark, tmp_path / "in"), out, str(tmp_path / "check")).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == sum(map(len, FILES)) and rows.select("seq").distinct().count() == 7


def test_new_checkpoint_reads_everything_again(spark, tmp_path):
    log_spec = StreamSpec("people", FIELDS, SyncMode.APPEND, "db")
    store = TableStore(spark, str(tmp_path / "store"))
    put(tmp_path / "in", 0, FILES[0])
    for check in ("one", "one", "two"):
        stream_sync(source(spark, tmp_path / "in"), store, log_spec, str(tmp_path / check)).awaitTermination()
    assert store.count("db", "people") == 4
