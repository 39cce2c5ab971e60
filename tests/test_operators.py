"""Resolving, merging, batching and history against brute force."""

import random
from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tablesync import Field, StreamSpec, SyncMode
from tablesync.functions.compress import decompress
from tablesync.operators import batches, ledger, merge, resolve
from tablesync.operators.history import change_history
from tablesync.operators.intake import shape
from tablesync.plans.sync import final_layout, result_of

FIELDS = (Field("id", "integer"), Field("name", "string"), Field("seq", "integer"), Field("_deleted_at", "string"))
SPEC = StreamSpec("t", FIELDS, SyncMode.DEDUP, primary_key=("id",), order_by=("seq",))
SCHEMA = "id long, name string, seq long, _deleted_at string"


def log(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def replay(rows):
    """State after a log, one event after the other."""
    state = {}
    for row in sorted(rows, key=lambda r: r[2]):
        if row[3] is None:
            state[row[0]] = row
        else:
            state.pop(row[0], None)
    return sorted(state.values())


def rows_of(df):
    return sorted(tuple(r) for r in df.select("id", "name", "seq", "_deleted_at").collect())


@pytest.mark.parametrize(
    "events, upserts, deletes",
    [
        ([(5, None, 1, "t"), (5, "revived", 2, None)], ["revived"], 0),
        ([(5, "doomed", 1, None), (5, None, 2, "t")], [], 1),
        ([(1, "a", 1, None), (2, None, 2, "t"), (3, "c", 3, None)], ["a", "c"], 1),
    ],
)
def test_event_order_decides(spark, events, upserts, deletes):
    up, down = resolve.route(resolve.resolve(log(spark, events), SPEC))
    assert sorted(r["name"] for r in up.collect()) == upserts and down.count() == deletes


def test_append_streams_are_not_collapsed(spark):
    spec = StreamSpec("t", FIELDS)
    up, down = resolve.route(resolve.resolve(log(spark, [(1, "a", 1, None), (1, "b", 2, "t")]), spec))
    assert up.count() == 2 and down.count() == 0


def test_last_event_variants_agree_also_with_unorderable_columns(spark):
    events = log(spark, [(i % 7, f"n{i}", i, None) for i in range(100)])
    expected = rows_of(resolve.last_event_window(events, ["id"], ["seq"]))
    assert rows_of(resolve.last_event_per_key(events, ["id"], ["seq"])) == expected
    with_map = events.withColumn("m", F.create_map(F.lit("k"), F.col("seq"))).withColumn("v", F.parse_json(F.lit("1")))
    assert rows_of(resolve.last_event_per_key(with_map, ["id"], ["seq"])) == expected
    assert resolve.last_event_per_key(with_map, ["id"], ["seq"]).columns == with_map.columns


event = st.tuples(st.integers(0, 4), st.sampled_from("abc"), st.booleans())


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=25), st.integers(1, 4), st.randoms(use_true_random=False))
def test_batches_in_order_equal_one_batch(spark, events, cuts, rng):
    rows = [(key, name, seq, "t" if gone else None) for seq, (key, name, gone) in enumerate(events)]
    expected = replay(rows)
    shuffled = rows[:]
    rng.shuffle(shuffled)
    assert rows_of(result_of(None, log(spark, shuffled), SPEC)) == expected
    size = -(-len(rows) // cuts)
    small = large = None
    for start in range(0, len(rows), size):
        batch = log(spark, rows[start : start + size], 1)
        small = result_of(small, batch, SPEC)
        large = result_of(large, batch, SPEC, large_batch=True)
    assert rows_of(small) == expected and rows_of(large) == expected
    stored = log(spark, [], 1).withColumn("__op", F.lit(0))
    order = list(range(0, len(rows), size))
    rng.shuffle(order)
    for start in order:
        batch = resolve.with_op(log(spark, rows[start : start + size], 1), SPEC)
        stored = merge.order_safe_upsert(stored, batch, ["id"], ["seq"])
    assert rows_of(merge.live(stored)) == expected


def test_equal_order_lets_the_new_row_win(spark):
    old = log(spark, [(1, "z-old", 1, None)]).withColumn("__op", F.lit(0))
    new = log(spark, [(1, "a-new", 1, None)]).withColumn("__op", F.lit(0))
    assert [r["name"] for r in merge.order_safe_upsert(old, new, ["id"], ["seq"]).collect()] == ["a-new"]


def test_replaying_a_batch_changes_nothing(spark):
    rows = [(1, "a", 1, None), (2, "b", 2, None), (2, "b", 3, "t")]
    once = result_of(None, log(spark, rows), SPEC)
    assert rows_of(result_of(once, log(spark, rows), SPEC)) == rows_of(once)


def test_delete_by_composite_key(spark):
    target = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (None, "x")], "a int, b string")
    deletes = spark.createDataFrame([(1, "x"), (1, "x"), (None, "x")], "a int, b string")
    expected = [("None", "x"), ("1", "y"), ("2", "x")]
    for salt in (0, 5):
        rows = merge.delete_by_key(target, deletes, ["a", "b"], salt=salt).collect()
        assert sorted((str(r["a"]), r["b"]) for r in rows) == sorted(expected)


def test_salted_delete_with_a_hot_key(spark):
    target = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    deletes = spark.createDataFrame([(0,)] * 50 + [(1500,)], "k long")
    assert merge.delete_by_key(target, deletes, ["k"], salt=8).count() == 1999
    assert merge.delete_by_key(target, spark.createDataFrame([(7,)], "k long"), ["k"], salt=8).count() == 3000


def test_null_keys_are_refused(spark):
    with pytest.raises(Exception, match="NULL in key columns"):
        result_of(None, log(spark, [(None, "a", 1, None)]), SPEC).collect()


def test_soft_delete_and_live_rows(spark):
    soft = StreamSpec("t", FIELDS, SyncMode.DEDUP, primary_key=("id",), order_by=("seq",), soft_delete=True)
    state = result_of(None, log(spark, [(1, "a", 1, None), (1, "a", 2, "t"), (2, "b", 3, None)]), soft)
    assert rows_of(state) == [(1, "a", 2, "t"), (2, "b", 3, None)]
    assert rows_of(merge.soft_live(state, soft)) == [(2, "b", 3, None)]


@pytest.mark.parametrize("hot", [False, True])
def test_history_matches_brute_force(spark, hot):
    rng = random.Random(3)
    rows = [((0 if hot and i % 3 else rng.randrange(40)), f"n{i}", i, None) for i in range(900)]
    rng.shuffle(rows)
    got = change_history(log(spark, rows, 5), ["id"], ["seq"], "seq").collect()
    expected = set()
    for _, group in groupby(sorted(rows, key=lambda r: (r[0], r[2])), key=lambda r: r[0]):
        group = list(group)
        for row, after in zip(group, [*group[1:], None]):
            expected.add((row[0], row[2], after[2] if after else None))
    assert len(got) == len(rows)
    assert {(r["id"], r["seq"], r["valid_to"]) for r in got} == expected


def test_history_keeps_null_ends_and_null_values(spark):
    rows = [(1, "a", 1, None), (1, "b", 2, "x"), (1, "c", 3, None), (None, "d", 4, None), (None, "e", 5, "y")]
    got = {r["seq"]: r["valid_to"] for r in change_history(log(spark, rows, 4), ["id"], ["seq"], "_deleted_at").collect()}
    assert got == {1: "x", 2: None, 3: None, 4: "y", 5: None}


def test_row_index_is_exact_with_ties_and_hot_values(spark):
    rows = [(0 if i % 3 else i, f"n{i:04d}", i, None) for i in range(1000)]
    numbered = batches.with_row_index(log(spark, rows, 7), ["id", "name"])
    expected = {r[1]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[0], r[1])))}
    assert {r["name"]: r["row_index"] for r in numbered.collect()} == expected


def test_equal_rows_spread_over_tasks(spark):
    same = spark.range(0, 4000, 1, 4).select(F.lit(1).alias("k"), F.lit("v").alias("v"))
    sizes = batches.range_sorted(same, ["k"], "p").groupBy(batches.part_of("p").alias("part")).count().collect()
    assert sum(r["count"] for r in sizes) == 4000 and max(r["count"] for r in sizes) < 2000
    index = batches.with_row_index(same, ["k"]).agg(F.countDistinct("row_index"), F.max("row_index")).first()
    assert tuple(index) == (4000, 3999)
    history = change_history(same.withColumn("t", F.lit(1)), ["k"], ["t"], "v")
    assert history.filter("valid_to is null").count() == 1


def test_batches_hold_at_most_the_limit(spark):
    cut = batches.assign_batches(log(spark, [(i, "n", i, None) for i in range(25)]), ["seq"], 10, position="p")
    sizes = {r["batch_id"]: r["count"] for r in cut.groupBy("batch_id").count().collect()}
    assert sizes == {0: 10, 1: 10, 2: 5}
    assert {(r["seq"], r["batch_id"], r["p"]) for r in cut.collect()} == {(i, i // 10, i % 10) for i in range(25)}
    with pytest.raises(ValueError):
        batches.assign_batches(cut, ["seq"], 0)


def test_batches_are_bounded_by_bytes_too(spark):
    rng = random.Random(5)
    rows = [(i, "x" * rng.choice([1, 5, 300]), i, None) for i in range(200)]
    cut = batches.assign_batches(log(spark, rows), ["seq"], 20, position="p", max_bytes=500, size=F.length("name"))
    found = sorted((r["p"], r["batch_id"], len(r["name"])) for r in cut.collect())
    assert [p for p, _, _ in found] == list(range(200)) and [b for _, b, _ in found] == sorted(b for _, b, _ in found)
    for _, group in groupby(found, key=lambda r: r[1]):
        sizes = [size for _, _, size in group]
        assert len(sizes) <= 20 and sum(sizes) - sizes[-1] < 500
    for bad in (dict(max_bytes=0, size=F.lit(1)), dict(max_bytes=5)):
        with pytest.raises(ValueError):
            batches.assign_batches(cut, ["seq"], 20, **bad)


def test_labels_follow_content(spark):
    def labels(lines, **options):
        df = spark.createDataFrame(lines, "batch_id long, n int, line string").repartition(3)
        return {r["batch_id"]: r["label"] for r in batches.batch_labels(df, "t" * 60, **options).collect()}

    lines = [(0, 1, "a"), (0, 2, "b"), (1, 1, "b"), (1, 2, "a"), (2, 1, "a"), (2, 2, "c")]
    ordered = labels(lines, order_by=["n"])
    assert ordered == labels(lines[::-1], order_by=["n"]) and len(set(ordered.values())) == 3
    for digest in ("body", "rows"):
        free = labels(lines, digest=digest)
        assert free[0] == free[1] != free[2]
        assert free[0].startswith("tablesync-" + "t" * 48 + "-") and len(free[0]) == 10 + 48 + 1 + 64
    import hashlib

    assert ordered[0].endswith(hashlib.sha256(b"a\nb\n").hexdigest())
    with pytest.raises(ValueError):
        labels(lines, digest="md5")


@pytest.mark.parametrize("layout, packed", [("csv", "none"), ("json", "none"), ("json", "gzip"), ("json", "zstd")])
def test_bodies_come_back_whole(spark, layout, packed):
    import hashlib

    lines = [(0, i, f'{{"n":"{"x" * 50}{i:03d}"}}') for i in range(100)]
    df = spark.createDataFrame(lines, "batch_id long, n int, line string").repartition(4)
    row = (
        batches.batch_bodies(df, "t", layout, packed, order_by=["n"])
        .select("label", "row_count", "body", decompress(F.col("body"), packed).alias("raw"))
        .first()
    )
    texts = [text for _, _, text in lines]
    body = ("".join(t + "\n" for t in texts) if layout == "csv" else "[" + ",".join(texts) + "]").encode()
    assert bytes(row["raw"]) == body and row["row_count"] == 100
    assert row["label"] == "tablesync-t-" + hashlib.sha256(body).hexdigest()
    assert (len(row["body"]) < len(body)) == (packed != "none")


@pytest.mark.parametrize("packed", ["gzip", "zstd"])
def test_bodies_are_packed_a_few_rows_at_a_time(spark, packed):
    """A row is a whole body: an Arrow batch of up to 10,000 of them grows a worker with the table."""
    from tablesync.functions.compress import compress

    df = spark.createDataFrame([(i, ("x" * i).encode()) for i in range(50)] + [(50, None)], "n int, body binary")
    out = df.select("n", "body", decompress(compress(F.col("body"), packed), packed).alias("back"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    assert all(row["back"] == row["body"] for row in out.collect())


def test_body_options_are_checked(spark):
    df = spark.createDataFrame([(0, "a")], "batch_id long, line string")
    for layout, packed in (("csv", "gzip"), ("json", "lzma"), ("xml", "none")):
        with pytest.raises(ValueError):
            batches.batch_bodies(df, "t", layout, packed)


def test_load_outcomes(spark):
    loads = spark.createDataFrame(
        [("Success", "l1", None), ("Publish Timeout", "l2", None), ("Label Already Exists", "l3", None), ("Fail", "l4", "too many"), (None, "l5", None)],
        "status string, label string, message string",
    )
    got = {r["label"]: r["outcome"] for r in ledger.load_outcomes(loads).collect()}
    assert got == {"l1": "loaded", "l2": "loaded", "l3": "already_loaded", "l4": "failed", "l5": "failed"}
    with pytest.raises(Exception, match="status=Fail label=l4 message=too many"):
        ledger.require_loaded(loads.filter("label = 'l4'")).collect()
    assert ledger.require_loaded(loads.filter("label < 'l4'")).count() == 3


def test_accounting_and_pending(spark):
    rows = spark.createDataFrame([(1, 0, False), (1, 1, False), (1, 0, True), (2, 0, None)], "b int, __op int, bad boolean")
    got = {r["b"]: tuple(r)[1:] for r in ledger.load_accounting(rows, ["b"], rejected=F.col("bad")).collect()}
    assert got == {1: (3, 2, 1, 1, 1), 2: (1, 1, 0, 1, 0)}
    sent = spark.createDataFrame([("a",), ("b",)], "label string")
    assert [r["label"] for r in ledger.pending(sent, sent.filter("label = 'a'")).collect()] == ["b"]


def test_shape_and_table_layout_order(spark):
    shaped = shape(log(spark, [(1, "a", 1, None)]), SPEC, raw_id=F.lit("r"))
    assert shaped.columns == SPEC.final_columns
    assert final_layout(shaped, SPEC).columns[0] == "id"


def test_cursor(spark):
    df = log(spark, [(i, "n", i, None) for i in range(5)])
    assert merge.cursor_increment(df, "seq", 2).count() == 2 and merge.cursor_increment(df, "seq", None).count() == 5


def greedy(sizes, most, most_bytes):
    """Batch of each row, row by row."""
    out, rows, held = [], 0, 0
    for size in sizes:
        if not out or rows == most or held + size > most_bytes:
            out.append(out[-1] + 1 if out else 0)
            rows, held = 0, 0
        else:
            out.append(out[-1])
        rows, held = rows + 1, held + size
    return out


@pytest.mark.parametrize("most,most_bytes,block", [(7, 60, 5), (3, 10_000, 16), (1000, 25, 1), (50, 90, 64)])
def test_greedy_batches_are_the_longest_that_fit(spark, most, most_bytes, block):
    made = random.Random(most)
    # Empty rows, rows without a size, and some larger than a batch.
    sizes = [made.choice([0, None, 1, 5, 9, 30, 100]) for _ in range(150)]
    rows = [(i, n, "x", -1) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "id long, n long, _index string, batch_id int").repartition(4)
    got = batches.assign_greedy(df, ["id"], most, most_bytes, F.col("n"), position="place", block_rows=block).orderBy("id").collect()
    assert [r.place for r in got] == list(range(len(sizes))) and {r["_index"] for r in got} == {"x"}
    assert [r.batch_id for r in got] == greedy([n or 0 for n in sizes], most, most_bytes)


def test_greedy_batches_of_nothing(spark):
    df = spark.createDataFrame([], "id long, n long")
    assert batches.assign_greedy(df, ["id"], 2, 2, F.col("n")).collect() == []
    with pytest.raises(ValueError):
        batches.assign_greedy(df, ["id"], 0, 2, F.col("n"))


def test_tied_keys(spark):
    rows = [(1, "a", 5), (1, "b", 5), (1, "c", 4), (2, "d", 1), (2, "e", 1), (2, "f", 2), (3, "g", None), (3, "h", None), (None, "i", 1), (None, "j", 1)]
    df = spark.createDataFrame(rows, "id int, name string, seq int")
    assert {tuple(r) for r in resolve.tied_keys(df, ["id"], ["seq"]).collect()} == {(1, 5, 2), (3, None, 2), (None, 1, 2)}
    assert resolve.tied_keys(df, ["id"], ["seq", "name"]).count() == 0
    assert resolve.check_order(df, ["id"], ["seq", "name"]) is df
    with pytest.raises(ValueError, match="ties"):
        resolve.check_order(df, ["id"], ["seq"])
