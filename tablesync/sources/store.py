"""Tables as immutable parquet folders plus one small manifest per version.

Spark's built-in catalog has no MERGE, DELETE, swap or column retype for parquet.
Here every change is one ordinary Spark write to a fresh folder, followed by one
new manifest file that names the table's live folders. Publishing that manifest is
the swap, the transaction and the ledger entry at once: before it readers see the
old table, after it the new one, and a failed job leaves only an unused folder.

Keyed tables are split by a hash of the key; a merge reads and rewrites only the
parts its keys fall into. Only part numbers, counts and labels reach the driver.
One writer per table at a time; a second one fails when it publishes.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from tablesync.functions.types import column
from tablesync.operators.batches import label_prefix
from tablesync.operators.history import change_history
from tablesync.operators.ledger import LABEL_EXISTS, SUCCESS, initial_status
from tablesync.operators.merge import merge, order_safe_upsert
from tablesync.operators.resolve import last_event_per_key, require_keys, with_op
from tablesync.operators.schema import (
    Changeset,
    ColumnType,
    KeyModel,
    Layout,
    TableColumn,
    conform,
    describe,
    desired,
    diff,
    discover,
    evolve,
    evolved_layout,
)
from tablesync.sources.files import FileExists, SharedFiles
from tablesync.spec import DELETE, UPSERT, MetaNames, StreamSpec, free_name

# Keys of a batch up to this measured size are broadcast; above it both sides are shuffled.
BROADCAST_BYTES = 32 * 1024 * 1024

LEDGER = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("buffered", T.LongType()),
        T.StructField("upserts", T.LongType()),
        T.StructField("deletes", T.LongType()),
    ]
)

# Changes of a merge: rows that came in, rows before and after an update, rows that went.
INSERT, BEFORE, AFTER, REMOVED = "insert", "update_before", "update_after", "delete"

# Bucket of rows that no later merge reads: changes, and closed rows of a history.
ASIDE = -1


class WriteConflict(Exception):
    """Another writer published a version of the table first."""


@dataclass(frozen=True)
class LoadResult:
    """What one load did. ``version`` is None if nothing was published."""

    status: str
    buffered: int = 0
    upserts: int = 0
    deletes: int = 0
    version: int | None = None


@dataclass(frozen=True)
class Snapshot:
    """One published version of a table. ``parts`` maps a folder to its bucket, or to None."""

    version: int
    layout: Layout
    buckets: int
    tombstones: bool
    parts: Mapping[str, int | None] = field(default_factory=dict)
    progress: Mapping[str, int] = field(default_factory=dict)
    retired: tuple[str, ...] = ()
    # Operations not merged yet: folder to the version that brought it.
    deltas: Mapping[str, int] = field(default_factory=dict)
    # With tombstones: the columns whose greatest value wins.
    order_by: tuple[str, ...] = ()
    # Loads before this version belong to rows that are gone; their labels count no more.
    since: int = 0
    # The generation that the last refresh brought.
    generation: int | None = None
    # The state of the shadow table that the last refresh was staged in.
    origin: str | None = None
    # Whether merges keep what they changed, and the folders of these changes by version.
    changelog: bool = False
    changes: Mapping[str, int] = field(default_factory=dict)
    # A table that keeps every version of a row: the columns from and until which it is valid.
    history: tuple[str, str] | None = None
    # Name of the file that this was read from.
    state: str | None = None


class TableStore:
    """Namespaces and tables under one root folder that all executors share.

    ``buckets`` is the number of parts of a new keyed table; size it so that one part
    holds a few hundred megabytes, and use ``rebucket`` when the table has outgrown it.
    ``fold_after`` lets that many batches wait before they are merged: a load then
    writes only its own rows, readers merge what waits, and a table whose batches touch
    all parts is rewritten once for many batches instead of once for each.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        names: MetaNames | None = None,
        default_namespace: str | None = None,
        buckets: int | None = None,
        fold_after: int = 0,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.names = names or MetaNames()
        self.default_namespace = default_namespace
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.fold_after = fold_after
        self.files = SharedFiles(spark)

    # Namespaces and tables

    def create_namespace(self, namespace: str) -> None:
        self.files.make_folder(f"{self.root}/{_safe(namespace)}")

    def namespace_exists(self, namespace: str) -> bool:
        return self.files.exists(f"{self.root}/{_safe(namespace)}")

    def table_exists(self, namespace: str, table: str) -> bool:
        return self._version(namespace, table) is not None

    def setup(self, specs: Iterable[StreamSpec]) -> DataFrame:
        """Create all namespaces the streams need and report the state of their tables."""
        specs = list(specs)
        for namespace in sorted({self.target(spec)[0] for spec in specs}):
            self.create_namespace(namespace)
        return self.status([self.target(spec) for spec in specs])

    def target(self, spec: StreamSpec) -> tuple[str, str]:
        return spec.target(self.default_namespace)

    def create_table(
        self, spec: StreamSpec, replace_existing: bool = False, tombstones: bool = False, changelog: bool = False, buckets: int | None = None
    ) -> None:
        """Create the table of a stream; an existing one stays unless it is to be replaced.

        With ``changelog`` every merge keeps the rows it inserted, updated and deleted; see ``changes``.
        """
        namespace, table = self.target(spec)
        current = self._snapshot(namespace, table)
        if current is not None and not replace_existing:
            return
        self.create_namespace(namespace)
        version = 0 if current is None else current.version + 1
        layout = describe(spec)
        if tombstones:
            if not spec.is_dedup or spec.names.op in layout.schema.names:
                raise ValueError(f"tombstones need a dedup stream without a column {spec.names.op!r}")
            layout = _with_op_column(layout, spec)
        if changelog and (tombstones or not spec.is_dedup):
            raise ValueError("a changelog needs a dedup stream without tombstones")
        order_by = spec.order_by if tombstones else ()
        new = Snapshot(version, layout, buckets or self.buckets, tombstones, order_by=order_by, since=version, changelog=changelog)
        self._publish(namespace, table, new)

    def create_history(self, spec: StreamSpec, valid_from: str, valid_to: str = "valid_to") -> None:
        """Create a table that keeps every version of a row, and until when it was valid; an existing one stays."""
        namespace, table = self.target(spec)
        if self.table_exists(namespace, table):
            return
        layout = describe(spec)
        if not spec.is_dedup or valid_to in layout.schema.names:
            raise ValueError(f"a history needs a dedup stream without a column {valid_to!r}")
        until = TableColumn(valid_to, layout.schema[valid_from].dataType, True)
        self.create_namespace(namespace)
        layout = replace(layout, columns=(*layout.columns, until))
        self._publish(namespace, table, Snapshot(0, layout, self.buckets, False, order_by=spec.order_by, history=(valid_from, valid_to)))

    def drop_table(self, namespace: str, table: str) -> None:
        """Remove a table and the folders of all its versions, if it exists."""
        if self._snapshot(namespace, table) is None:
            return
        folders = self._folders(namespace, table)
        self.files.delete(self._log(namespace, table))
        for part in folders:
            self.files.delete(f"{self.root}/{part}")

    def _folders(self, namespace: str, table: str) -> set[str]:
        """The folders of all versions of a table."""
        found: set[str] = set()
        for version in self._versions(namespace, table):
            found.update(_all_parts(self._load_snapshot(namespace, table, version)))
        return found

    def replace_by(self, source: tuple[str, str], target: tuple[str, str]) -> None:
        """Give the target the source's content and layout in one step, then drop the source.

        The folders change owner without being copied.
        """
        incoming = self._require(*source)
        current = self._snapshot(*target)
        self.create_namespace(target[0])
        self._publish(*target, replace(incoming, version=0 if current is None else current.version + 1))
        self._forget(source, incoming)

    def _forget(self, source: tuple[str, str], handed_over: Snapshot) -> None:
        """Delete a table whose content another one has now."""
        unused = self._folders(*source) - _all_parts(handed_over)
        self.files.delete(self._log(*source))
        for part in unused:
            self.files.delete(f"{self.root}/{part}")

    # Refreshing

    def shadow(self, spec: StreamSpec) -> StreamSpec:
        """The stream as it lands in the shadow table of its coming generation."""
        namespace, table = self.target(spec)
        return replace(spec, name=f"{table}.generation-{spec.generation_id}", namespace=namespace, minimum_generation_id=0)

    def stage(self, spec: StreamSpec, on_error: str = "fail") -> StreamSpec:
        """The shadow of the stream's table, to load the batches of a refresh into; created by the first batch.

        Readers of the table see nothing of it until ``promote``. It is found by its name,
        so that a job that starts anew goes on where the last one stopped.
        """
        shadow = self.shadow(spec)
        target, staged = self._snapshot(*self.target(spec)), self._snapshot(*self.target(shadow))
        if staged is not None and target is not None and target.origin == staged.state:
            # It was handed over already; only the removal of its log was lost.
            self._forget(self.target(shadow), staged)
            staged = None
        if staged is None:
            settings = {} if target is None else {"buckets": target.buckets}
            if target is not None and spec.is_dedup:
                settings |= {"tombstones": target.tombstones, "changelog": target.changelog}
            self.create_table(shadow, **settings)
        else:
            self.ensure(shadow, on_error)
        return shadow

    def promote(self, spec: StreamSpec) -> None:
        """Put the staged refresh in the table's place, in one step, with the labels of its loads.

        Nothing happens if that was done before.
        """
        source, target = self.target(self.shadow(spec)), self.target(spec)
        current, staged = self._snapshot(*target), self._snapshot(*source)
        if staged is None:
            if current is not None and current.generation == spec.generation_id:
                return
            raise LookupError(f"no refresh of {'.'.join(target)} is staged")
        if current is None or current.origin != staged.state:
            # One row for each batch of this refresh.
            loads = [r.asDict() for r in self.ledger(*source).drop("version").collect()]
            version = 0 if current is None else current.version + 1
            # The progress of the table's streams outlives its rows.
            progress = {**(current.progress if current else {}), **staged.progress}
            new = replace(staged, version=version, since=version, generation=spec.generation_id, progress=progress, origin=staged.state)
            self._publish(*target, new, {"loads": loads})
        self._forget(source, staged)

    def copy_table(self, source: tuple[str, str], target: tuple[str, str], columns: Sequence[str]) -> LoadResult:
        """Append the envelope and the given user columns of one table to another."""
        rows = self.read(*source).select(*(column(c) for c in [*self.names.envelope, *columns]))
        snapshot = self._require(*target)
        if snapshot.layout.model is not KeyModel.DUPLICATE:
            raise ValueError("copy into a keyed table through load()")
        return self._append(*target, snapshot, rows, None, None)

    # Reading

    def read(self, namespace: str, table: str) -> DataFrame:
        """Current rows: waiting operations applied, tombstones left out."""
        snapshot = self._require(namespace, table)
        rows = self._rows(snapshot, snapshot.parts)
        if snapshot.deltas:
            op, keys, waiting = self._op(snapshot), snapshot.layout.keys, self._waiting(snapshot, self._op(snapshot))
            rows = (
                _newest(rows, waiting, keys, snapshot.order_by)
                if snapshot.tombstones
                else merge(rows, waiting, keys, op)
            )
        if snapshot.tombstones:
            rows = rows.filter(column(self.names.op) == UPSERT).drop(self.names.op)
        return rows

    def count(self, namespace: str, table: str) -> int | None:
        """Row count, or None for a missing table."""
        return self.read(namespace, table).count() if self.table_exists(namespace, table) else None

    def generation_id(self, namespace: str, table: str) -> int:
        """Highest generation; 0 for a missing or empty table."""
        if not self.table_exists(namespace, table):
            return 0
        highest = self.read(namespace, table).agg(F.max(column(self.names.generation_id))).first()[0]
        return highest or 0

    def status(self, tables: Iterable[tuple[str, str]]) -> DataFrame:
        """Existence, row count and generation of every table, as one job."""
        found = {
            f"{namespace}.{table}": self.read(namespace, table) if self.table_exists(namespace, table) else None
            for namespace, table in tables
        }
        return initial_status(self.spark, found, self.names.generation_id)

    def schema(self, namespace: str, table: str) -> dict[str, ColumnType]:
        """User columns by canonical type."""
        snapshot = self._require(namespace, table)
        columns = discover(snapshot.layout.schema, self.names)
        for name in self._own_columns(snapshot):
            columns.pop(name)
        return columns

    def _own_columns(self, snapshot: Snapshot) -> list[str]:
        """Columns that the table has besides those of its stream."""
        return [self.names.op] * snapshot.tombstones + ([snapshot.history[1]] if snapshot.history else [])

    def ledger(self, namespace: str, table: str) -> DataFrame:
        """One row per published load. It becomes visible together with the load's data."""
        log = self._log(namespace, table)
        load = T.StructType([f for f in LEDGER if f.name != "version"])
        published = T.StructType([*LEDGER, T.StructField("loads", T.ArrayType(load))])
        entries = self.spark.read.schema(published).json(f"{log}/*.json")
        single = entries.filter(F.col("status").isNotNull()).drop("loads")
        # Several loads can be published as one.
        return single.unionByName(entries.select("version", F.explode("loads").alias("load")).select("version", "load.*"))

    # Evolving

    def ensure(self, spec: StreamSpec, on_error: str = "fail") -> Changeset | None:
        """Create the table, or bring its columns to what the stream declares."""
        namespace, table = self.target(spec)
        if not self.table_exists(namespace, table):
            self.create_table(spec)
            return None
        change = diff(self.schema(namespace, table), desired(spec))
        self.apply(spec, change, on_error)
        return change

    def apply(self, spec: StreamSpec, change: Changeset, on_error: str = "fail") -> None:
        """Carry out a changeset.

        Adding and dropping columns only publishes a new layout: parquet files without
        a column read as NULL. A retype, and the return of a name dropped before,
        rewrites the rows; the old table stays in place until that has succeeded.
        """
        if change.is_noop:
            return
        namespace, table = self.target(spec)
        old = self._require(namespace, table)
        own = self._own_columns(old)
        layout = evolved_layout(_without(old.layout, own), spec, change)
        layout = replace(layout, columns=(*layout.columns, *(c for c in old.layout.columns if c.name in own)))
        types_change = any(before.type_name != after.type_name for before, after in change.change.values())
        rewrites = types_change or set(change.add) & set(old.retired)
        if layout == old.layout and not rewrites:
            return
        if rewrites and old.history:
            raise ValueError("a history can't be retyped; create a new one")
        # What waits has the old layout.
        self.fold(namespace, table)
        old = self._require(namespace, table)
        retired = tuple(sorted({*old.retired, *change.drop} - set(change.add)))
        new = replace(old, version=old.version + 1, layout=layout, retired=retired)
        if rewrites:
            rows = evolve(self._rows(old, old.parts), layout, change, on_error)
            parts = self._write(namespace, table, rows, new)
            new = replace(new, parts=parts, retired=())
        self._publish(namespace, table, new)

    def rebucket(self, namespace: str, table: str, buckets: int) -> None:
        """Split a keyed table into another number of parts, in one shuffle."""
        self.fold(namespace, table)
        old = self._require(namespace, table)
        if old.layout.model is not KeyModel.PRIMARY or old.history:
            raise ValueError("only keyed tables without history can be split anew")
        new = replace(old, version=old.version + 1, buckets=buckets)
        parts = self._write(namespace, table, self._rows(old, old.parts), new)
        self._publish(namespace, table, replace(new, parts=parts))

    # Loading

    def load(
        self,
        spec: StreamSpec,
        batch: DataFrame,
        label: str | None = None,
        progress: tuple[str, int] | None = None,
    ) -> LoadResult:
        """Apply one batch of shaped records: append it, or merge it by key.

        ``label`` names the batch and ``progress`` is a stream's (query, batch number);
        a batch that was applied before is skipped. An empty batch publishes nothing.
        """
        namespace, table = self.target(spec)
        snapshot = self._require(namespace, table)
        if progress and snapshot.progress.get(progress[0], -1) >= progress[1]:
            return LoadResult(LABEL_EXISTS)
        if label and not self.known_labels(namespace, table).filter(F.col("label") == label).isEmpty():
            return LoadResult(LABEL_EXISTS)
        return self._load(namespace, table, snapshot, spec, batch, label, progress)

    def load_batches(self, spec: StreamSpec, rows: DataFrame, loads: Sequence[Mapping]) -> LoadResult:
        """Apply the rows of several batches together; ``loads`` has a ledger row (label, status, counts) for each.

        All of them become visible in one step. The caller leaves out batches whose label is known.
        """
        namespace, table = self.target(spec)
        return self._load(namespace, table, self._require(namespace, table), spec, rows, None, None, loads)

    def known_labels(self, namespace: str, table: str) -> DataFrame:
        """Labels of the loads whose rows the table still stands for, one row each."""
        since = self._require(namespace, table).since
        loads = self.ledger(namespace, table).filter(F.col("label").isNotNull() & (F.col("version") >= since))
        return loads.select("label").distinct()

    def _load(self, namespace, table, snapshot, spec, batch, label, progress, loads=None) -> LoadResult:
        absent = sorted({f.name for f in spec.fields} - set(snapshot.layout.schema.names))
        if absent:
            raise ValueError(f"the table has no columns for {', '.join(absent)}; call ensure first")
        if snapshot.history:
            return self._extend(namespace, table, snapshot, batch, label, progress, loads)
        if snapshot.layout.model is KeyModel.PRIMARY:
            return self._merge(namespace, table, snapshot, spec, batch, label, progress, loads)
        return self._append(namespace, table, snapshot, batch, label, progress, loads)

    def overwrite(self, spec: StreamSpec, batch: DataFrame, label: str | None = None) -> LoadResult:
        """Replace the whole table, layout included, by a batch; also by an empty one."""
        namespace, table = self.target(spec)
        current = self._snapshot(namespace, table)
        self.create_namespace(namespace)
        layout = describe(spec)
        version = 0 if current is None else current.version + 1
        generation = spec.generation_id
        if current is None:
            fresh = Snapshot(version, layout, self.buckets, False, since=version, generation=generation)
        else:
            # Settings of the table and the progress of its streams outlive its rows.
            kept = current.tombstones and layout.model is KeyModel.PRIMARY
            layout = _with_op_column(layout, spec) if kept else layout
            fresh = replace(
                current, version=version, layout=layout, tombstones=kept, parts={}, retired=(), deltas={},
                order_by=spec.order_by if kept else (), since=version, generation=generation, changes={}, history=None,
                changelog=current.changelog and layout.model is KeyModel.PRIMARY,
            )
        rows = batch
        if layout.model is KeyModel.PRIMARY:
            rows = last_event_per_key(require_keys(batch, layout.keys), layout.keys, spec.order_by)
            op = self._op(fresh) if fresh.tombstones else free_name(spec.names.op, rows.columns)
            rows = with_op(rows, spec, op)
            rows = rows if fresh.tombstones else rows.filter(column(op) == UPSERT).drop(op)
        deleted = column(op) != UPSERT if fresh.tombstones else F.lit(False)
        seen = Observation()
        counted = [F.count(F.lit(1)).alias("rows"), F.count_if(deleted).alias("deletes")]
        fresh = replace(fresh, parts=self._write(namespace, table, conform(rows, layout.schema), fresh, seen, counted))
        loaded, deletes = seen.get["rows"], seen.get["deletes"]
        counts = {"buffered": loaded, "upserts": loaded - deletes, "deletes": deletes}
        self._publish(namespace, table, fresh, {"label": label, "status": SUCCESS, **counts})
        return LoadResult(SUCCESS, loaded, loaded - deletes, deletes, version)

    def refreshed(self, spec: StreamSpec) -> bool:
        """Whether the table holds rows of the stream's current refresh already."""
        snapshot = self._snapshot(*self.target(spec))
        return snapshot is not None and snapshot.generation == spec.generation_id

    def is_order_safe(self, spec: StreamSpec) -> bool:
        return self._require(*self.target(spec)).tombstones

    def _append(self, namespace, table, snapshot, batch, label, progress, loads=None) -> LoadResult:
        part = self._new_part(namespace, table)
        checked = require_keys(batch, snapshot.layout.keys)
        seen = Observation()
        conform(checked, snapshot.layout.schema).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.root}/{part}")
        loaded = seen.get["rows"]
        if loaded == 0:
            self.files.delete(f"{self.root}/{part}")
            return LoadResult(SUCCESS)
        new = replace(snapshot, version=snapshot.version + 1, parts={**snapshot.parts, part: None})
        return self._finish(namespace, table, new, LoadResult(SUCCESS, loaded, loaded), label, progress, loads)

    def _merge(self, namespace, table, snapshot, spec, batch, label, progress, loads=None) -> LoadResult:
        keys, op = snapshot.layout.keys, self._op(snapshot)
        events = free_name("_events", [*batch.columns, op])
        latest = last_event_per_key(require_keys(batch, keys), keys, spec.order_by, count=events)
        operations = conform(with_op(latest, spec, op), _operations(snapshot, op).add(events, T.LongType()))
        if self.fold_after and not snapshot.changelog:
            return self._defer(namespace, table, snapshot, operations, op, events, label, progress, loads)
        parts, changed, done = self._rewrite(namespace, table, snapshot, operations, op, events)
        if done.buffered == 0:
            return done
        version = snapshot.version + 1
        new = replace(snapshot, version=version, parts=parts, changes={**snapshot.changes, **dict.fromkeys(changed, version)})
        return self._finish(namespace, table, new, done, label, progress, loads)

    def changes(self, namespace: str, table: str, after: int = -1, upto: int | None = None) -> DataFrame:
        """What merges changed, from the version after ``after`` on: ``_version``, ``_change`` and the row.

        ``replay`` brings a copy up to date with it.
        """
        snapshot = self._require(namespace, table)
        if not snapshot.changelog:
            raise ValueError(f"{namespace}.{table} keeps no changes; create it with changelog=True")
        schema = T.StructType([*snapshot.layout.schema, T.StructField(_change_column(snapshot), T.StringType())])
        wanted = {p: v for p, v in snapshot.changes.items() if v > after and (upto is None or v <= upto)}
        found = self.spark.createDataFrame([], schema).withColumn("_version", F.lit(0).cast("long"))
        for part, version in wanted.items():
            rows = self.spark.read.schema(schema).parquet(f"{self.root}/{part}")
            found = found.unionByName(rows.withColumn("_version", F.lit(version).cast("long")))
        return found.select("_version", column(_change_column(snapshot)).alias("_change"), *(column(c) for c in snapshot.layout.schema.names))

    def _extend(self, namespace, table, snapshot, batch, label, progress, loads=None) -> LoadResult:
        """Add a batch to a history: the last row of each key it touches is closed, its own last ones stay open.

        Open rows are kept by bucket, closed ones aside, so a batch reads and rewrites only the open
        rows of the buckets it touches. Its events must come after those stored of their keys.
        """
        keys, (valid_from, valid_to) = snapshot.layout.keys, snapshot.history
        shape = T.StructType([f for f in snapshot.layout.schema if f.name != valid_to])
        bucket, rank, stamp, until = (free_name(n, snapshot.layout.schema.names) for n in ("bucket", "_rank", "_stamp", "_until"))
        arrived = self._bucketed(conform(require_keys(batch, keys), shape), snapshot, bucket).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = {r[bucket]: r["count"] for r in arrived.groupBy(bucket).count().collect()}  # one row per bucket
            if not counts:
                return LoadResult(SUCCESS)
            touched = [part for part, number in snapshot.parts.items() if number in counts]
            stored = self._bucketed(self._rows(snapshot, touched).select(*(column(c) for c in shape.names)), snapshot, bucket)
            both = stored.withColumn(rank, F.lit(0)).unionByName(arrived.withColumn(rank, F.lit(1)))
            both = both.withColumn(stamp, F.struct(F.col(rank).alias("rank"), column(valid_from).alias("at")))
            timed = change_history(both, keys, [*snapshot.order_by, rank], stamp, until)
            following = F.col(until)
            late = F.raise_error(F.lit(f"an event of {namespace}.{table} is older than what is stored of its key"))
            number = F.when(following.isNull(), F.col(bucket)).when(following["rank"] == 0, late.cast("int")).otherwise(F.lit(ASIDE))
            rows = timed.select(*(column(c) for c in shape.names), following["at"].alias(valid_to), number.alias(bucket))
            # Open rows go to the task of their bucket, closed ones anywhere.
            anywhere = F.pmod(F.xxhash64(*(column(c) for c in [*keys, *snapshot.order_by])), F.lit(snapshot.buckets)).cast("int")
            spread = rows.repartitionById(snapshot.buckets, F.when(F.col(bucket) >= 0, F.col(bucket)).otherwise(anywhere))
            written = self._write_bucketed(namespace, table, spread, bucket)
        finally:
            arrived.unpersist()
        kept = {part: n for part, n in snapshot.parts.items() if part not in touched}
        parts = {**kept, **{part: None if n == ASIDE else n for part, n in written.items()}}
        total = sum(counts.values())
        new = replace(snapshot, version=snapshot.version + 1, parts=parts)
        return self._finish(namespace, table, new, LoadResult(SUCCESS, total, total), label, progress, loads)

    def _defer(self, namespace, table, snapshot, operations, op, events, label, progress, loads=None) -> LoadResult:
        """Publish the batch's operations as they are; merge all waiting ones when there are enough."""
        part = self._new_part(namespace, table)
        seen = Observation()
        operations.observe(seen, *_counts(op, events)).write.parquet(f"{self.root}/{part}")
        counts = seen.get
        if not counts["buffered"]:
            self.files.delete(f"{self.root}/{part}")
            return LoadResult(SUCCESS)
        done = LoadResult(SUCCESS, counts["buffered"], counts["upserts"], counts["deletes"])
        version = snapshot.version + 1
        new = replace(snapshot, version=version, deltas={**snapshot.deltas, part: version})
        if len(new.deltas) > self.fold_after:
            new = self._folded(namespace, table, new)
        return self._finish(namespace, table, new, done, label, progress, loads)

    def fold(self, namespace: str, table: str) -> None:
        """Merge all waiting operations into the table's folders."""
        snapshot = self._require(namespace, table)
        if snapshot.deltas:
            new = self._folded(namespace, table, replace(snapshot, version=snapshot.version + 1))
            self._publish(namespace, table, new)

    def _folded(self, namespace, table, snapshot: Snapshot) -> Snapshot:
        op = self._op(snapshot)
        waiting = self._waiting(snapshot, op)
        events = free_name("_events", waiting.columns)
        operations = waiting.withColumn(events, F.lit(1).cast("long"))
        parts, _, _ = self._rewrite(namespace, table, snapshot, operations, op, events)
        return replace(snapshot, parts=parts, deltas={})

    def _waiting(self, snapshot: Snapshot, op: str) -> DataFrame:
        """The latest waiting operation of every key; later batches win, or the greater order."""
        schema = _operations(snapshot, op)
        rank = free_name("_rank", schema.names)
        waiting = None
        for part, version in snapshot.deltas.items():
            rows = self.spark.read.schema(schema).parquet(f"{self.root}/{part}").withColumn(rank, F.lit(version))
            waiting = rows if waiting is None else waiting.unionByName(rows)
        return last_event_per_key(waiting, snapshot.layout.keys, [*snapshot.order_by, rank]).drop(rank)

    def _rewrite(self, namespace, table, snapshot, operations, op, events):
        """Merge operations, one per key, into the buckets they touch: (new parts, folders of changes, what was done)."""
        keys, bucket = snapshot.layout.keys, free_name("bucket", operations.columns)
        resolved = self._bucketed(operations, snapshot, bucket).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            key_bytes = F.octet_length(F.concat_ws("", *(column(k).cast("string") for k in keys))) + 32
            stats = (
                resolved.groupBy(bucket)
                .agg(*_counts(op, events), F.sum(key_bytes).alias("key_bytes"))
                .collect()  # one row per bucket
            )
            touched = {r[bucket] for r in stats}
            old_parts = [part for part, number in snapshot.parts.items() if number in touched]
            stored = self._bucketed(self._rows(snapshot, old_parts), snapshot, bucket) if old_parts else None
            small = sum(r["key_bytes"] for r in stats) <= BROADCAST_BYTES
            plan = _order_safe if snapshot.tombstones else _merged
            written = {}
            if touched:
                if snapshot.changelog:
                    stored = self._bucketed(self._rows(snapshot, []), snapshot, bucket) if stored is None else stored
                    rows = _merged_with_changes(stored, resolved.drop(events), keys, op, bucket, snapshot.buckets, _change_column(snapshot))
                else:
                    rows = plan(stored, resolved.drop(events), keys, snapshot.order_by, op, bucket, small, snapshot.buckets)
                written = self._write_bucketed(namespace, table, rows, bucket)
            changed = [part for part, number in written.items() if number == ASIDE]
            kept = {part: number for part, number in snapshot.parts.items() if number not in touched}
            kept |= {part: number for part, number in written.items() if number != ASIDE}
            total = {name: sum(r[name] for r in stats) for name in ("buffered", "upserts", "deletes")}
            return kept, changed, LoadResult(SUCCESS, **total)
        finally:
            resolved.unpersist()

    def _op(self, snapshot: Snapshot) -> str:
        """Name of the operation column: a column of its own in a table with tombstones."""
        return self.names.op if snapshot.tombstones else free_name(self.names.op, snapshot.layout.schema.names)

    def _finish(self, namespace, table, new, result, label, progress, loads=None) -> LoadResult:
        if progress:
            new = replace(new, progress={**new.progress, progress[0]: progress[1]})
        entry = {
            "label": label,
            "status": result.status,
            "buffered": result.buffered,
            "upserts": result.upserts,
            "deletes": result.deletes,
        }
        entry = entry if loads is None else {"loads": [dict(load) for load in loads]}
        self._publish(namespace, table, new, entry)
        return replace(result, version=new.version)

    # Checking and cleaning

    def preflight(self, namespace: str | None = None) -> None:
        """Create a throw-away table, write one row, read it back, and drop it in any case."""
        from tablesync.spec import Field

        spec = StreamSpec(
            f"_check_{uuid.uuid4().hex}",
            (Field("id", "integer"),),
            namespace=namespace or self.default_namespace,
            names=self.names,
        )
        target = self.target(spec)
        values = [F.lit("check"), F.current_timestamp(), F.lit("{}"), F.lit(0).cast("long"), F.lit(1).cast("long")]
        row = self.spark.range(1).select(*(v.alias(c) for v, c in zip(values, spec.final_columns)))
        try:
            self.create_table(spec)
            self.load(spec, row)
            found = [r["id"] for r in self.read(*target).select("id").take(2)]
            if found != [1]:
                raise RuntimeError(f"wrote one row to {'.'.join(target)} but read back {found}")
        finally:
            self.drop_table(*target)

    def vacuum(self, namespace: str, table: str, keep_versions: int = 10) -> list[str]:
        """Delete folders that none of the last ``keep_versions`` versions uses; returns them.

        Keep enough versions for the longest-running reader.
        """
        current = self._require(namespace, table).version
        first_kept = max(0, current - keep_versions + 1)
        kept, old = set(), set()
        for version in self._versions(namespace, table):
            (kept if version >= first_kept else old).update(_all_parts(self._load_snapshot(namespace, table, version)))
        unused = sorted(old - kept)
        for part in unused:
            self.files.delete(f"{self.root}/{part}")
        return unused

    # Folders and manifests

    def _folder(self, namespace: str, table: str) -> str:
        return f"{_safe(namespace)}/{_safe(table)}"

    def _log(self, namespace: str, table: str) -> str:
        return f"{self.root}/{self._folder(namespace, table)}/log"

    def _new_part(self, namespace: str, table: str) -> str:
        return f"{self._folder(namespace, table)}/data-{uuid.uuid4().hex}"

    def _versions(self, namespace: str, table: str) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.files.names(self._log(namespace, table)) if n.endswith(".json"))

    def _version(self, namespace: str, table: str) -> int | None:
        found = self._versions(namespace, table)
        return found[-1] if found else None

    def _snapshot(self, namespace: str, table: str) -> Snapshot | None:
        version = self._version(namespace, table)
        return None if version is None else self._load_snapshot(namespace, table, version)

    def _require(self, namespace: str, table: str) -> Snapshot:
        snapshot = self._snapshot(namespace, table)
        if snapshot is None:
            raise LookupError(f"no table {namespace}.{table}")
        return snapshot

    def _load_snapshot(self, namespace: str, table: str, version: int) -> Snapshot:
        log = self._log(namespace, table)
        entry = json.loads(self.files.read_text(f"{log}/{version:012d}.json"))
        raw = json.loads(self.files.read_text(f"{log}/{entry['state']}"))
        schema = T.StructType.fromJson(raw["schema"])
        layout = Layout(
            tuple(TableColumn(f.name, f.dataType, f.nullable) for f in schema),
            tuple(raw["keys"]),
            KeyModel(raw["model"]),
        )
        return Snapshot(
            version,
            layout,
            raw["buckets"],
            raw["tombstones"],
            raw["parts"],
            raw["progress"],
            tuple(raw["retired"]),
            raw["deltas"],
            tuple(raw["order_by"]),
            raw.get("since", 0),
            raw.get("generation"),
            raw.get("origin"),
            raw.get("changelog", False),
            raw.get("changes", {}),
            tuple(raw["history"]) if raw.get("history") else None,
            entry["state"],
        )

    def _publish(self, namespace: str, table: str, snapshot: Snapshot, entry: Mapping | None = None) -> None:
        """Write the new state, then make it current by one small file that only one writer can create."""
        state = {
            "schema": snapshot.layout.schema.jsonValue(),
            "keys": list(snapshot.layout.keys),
            "model": snapshot.layout.model.value,
            "buckets": snapshot.buckets,
            "tombstones": snapshot.tombstones,
            "parts": dict(snapshot.parts),
            "progress": dict(snapshot.progress),
            "retired": list(snapshot.retired),
            "deltas": dict(snapshot.deltas),
            "order_by": list(snapshot.order_by),
            "since": snapshot.since,
            "generation": snapshot.generation,
            "origin": snapshot.origin,
            "changelog": snapshot.changelog,
            "changes": dict(snapshot.changes),
            "history": snapshot.history,
        }
        log = self._log(namespace, table)
        self.files.make_folder(log)
        name = f"state-{uuid.uuid4().hex}"
        self.files.create_text(f"{log}/{name}", json.dumps(state))
        manifest = {"version": snapshot.version, "state": name, **(entry or {})}
        try:
            self.files.create_text(f"{log}/{snapshot.version:012d}.json", json.dumps(manifest))
        except FileExists:
            self.files.delete(f"{log}/{name}")
            raise WriteConflict(f"{namespace}.{table} version {snapshot.version}") from None

    def _rows(self, snapshot: Snapshot, parts: Iterable[str]) -> DataFrame:
        paths = [f"{self.root}/{part}" for part in parts]
        schema = snapshot.layout.schema
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _bucketed(self, df: DataFrame, snapshot: Snapshot, name: str) -> DataFrame:
        number = F.pmod(F.xxhash64(*(column(k) for k in snapshot.layout.keys)), F.lit(snapshot.buckets))
        return df.withColumn(name, number.cast("int"))

    def _write(self, namespace, table, rows: DataFrame, snapshot: Snapshot, seen: Observation | None = None, counted: Sequence[Column] = ()) -> dict[str, int | None]:
        """Write rows into new folders. ``seen`` gets the aggregates ``counted`` of them in the same pass.

        They are taken in the stage that writes, whose tasks count once even if they run again.
        """
        if snapshot.layout.model is KeyModel.PRIMARY:
            bucket = free_name("bucket", rows.columns)
            spread = self._bucketed(rows, snapshot, bucket).repartitionById(snapshot.buckets, F.col(bucket))
            return self._write_bucketed(namespace, table, spread.observe(seen, *counted) if seen else spread, bucket)
        part = self._new_part(namespace, table)
        rows = rows.observe(seen, *counted) if seen else rows
        rows.write.parquet(f"{self.root}/{part}")
        return {part: None}

    def _write_bucketed(self, namespace: str, table: str, rows: DataFrame, bucket: str) -> dict[str, int | None]:
        part = self._new_part(namespace, table)
        rows.write.partitionBy(bucket).parquet(f"{self.root}/{part}")
        found = [n for n in self.files.names(f"{self.root}/{part}") if n.startswith(f"{bucket}=")]
        return {f"{part}/{name}": int(name.split("=", 1)[1]) for name in found}


def _safe(name: str) -> str:
    """A folder name for any namespace or table name."""
    return re.sub(r"[^A-Za-z0-9_.-]", lambda found: f"~{ord(found[0]):x}~", name)


def _with_op_column(layout: Layout, spec: StreamSpec) -> Layout:
    return replace(layout, columns=(*layout.columns, TableColumn(spec.names.op, T.IntegerType(), False)))


def _without(layout: Layout, names: Sequence[str]) -> Layout:
    return replace(layout, columns=tuple(c for c in layout.columns if c.name not in names))


def _all_parts(snapshot: Snapshot) -> set[str]:
    return {*snapshot.parts, *snapshot.deltas, *snapshot.changes}


def _change_column(snapshot: Snapshot) -> str:
    return free_name("_change", snapshot.layout.schema.names)


def _operations(snapshot: Snapshot, op: str) -> T.StructType:
    """Columns of the table and the operation code."""
    return T.StructType([*(f for f in snapshot.layout.schema if f.name != op), T.StructField(op, T.IntegerType())])


def _counts(op: str, events: str) -> list:
    return [
        F.coalesce(F.sum(events), F.lit(0)).alias("buffered"),
        F.count_if(column(op) == UPSERT).alias("upserts"),
        F.count_if(column(op) == DELETE).alias("deletes"),
    ]


def _spread(rows: DataFrame, buckets: int, bucket: str) -> DataFrame:
    """One task for each bucket, whatever the session's number of shuffle partitions."""
    return rows.repartitionById(buckets, F.col(bucket))


def _merged(stored: DataFrame | None, resolved: DataFrame, keys, _, op: str, bucket: str, small: bool, buckets: int) -> DataFrame:
    """Rows of the touched buckets after the batch, laid out by bucket for writing."""
    upserts = resolved.filter(column(op) == UPSERT).drop(op)
    if stored is None:
        return _spread(upserts, buckets, bucket)
    if small:
        # The stored rows stay where they are; only the batch moves.
        touched = F.broadcast(resolved.select(*(column(k) for k in keys)))
        return stored.join(touched, list(keys), "left_anti").unionByName(_spread(upserts, buckets, bucket))
    # One shuffle by bucket serves the comparison by key and the write.
    rank = free_name("_rank", resolved.columns)
    both = stored.withColumn(op, F.lit(UPSERT)).withColumn(rank, F.lit(0)).unionByName(resolved.withColumn(rank, F.lit(1)))
    newest = Window.partitionBy(bucket, *(column(k) for k in keys)).orderBy(F.col(rank).desc())
    place = free_name("_place", both.columns)
    return (
        _spread(both, buckets, bucket)
        .withColumn(place, F.row_number().over(newest))
        .filter((F.col(place) == 1) & (column(op) == UPSERT))
        .drop(place, rank, op)
    )


def _merged_with_changes(stored: DataFrame, resolved: DataFrame, keys, op: str, bucket: str, buckets: int, change: str) -> DataFrame:
    """Rows of the touched buckets after the batch, and beside them, in the bucket ``ASIDE``, what it changed.

    One shuffle by bucket brings the stored row of a key and its operation together.
    """
    rank, old, ops, made = (free_name(n, [*resolved.columns, change]) for n in ("_rank", "_old", "_ops", "_made"))
    names = [c for c in stored.columns if c != bucket]
    both = stored.withColumn(op, F.lit(UPSERT)).withColumn(rank, F.lit(0)).unionByName(resolved.withColumn(rank, F.lit(1)))
    row = F.struct(*(column(c) for c in names))
    key = Window.partitionBy(bucket, *(column(k) for k in keys)).orderBy(rank)
    paired = _spread(both, buckets, bucket).withColumn(old, F.lag(row).over(key)).withColumn(ops, F.lead(F.lit(True)).over(key))

    def out(kept, kind: str | None, at) -> Column:
        return F.struct(at.alias("bucket"), F.lit(kind).cast("string").alias("change"), kept.alias("row"))

    here, aside, before = F.col(bucket), F.lit(ASIDE), F.col(old)
    none = F.array().cast(T.ArrayType(T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("change", T.StringType()), T.StructField("row", both.select(row.alias("r")).schema["r"].dataType)])))
    untouched = (F.col(rank) == 0) & F.col(ops).isNull()
    arrived, deletes = F.col(rank) == 1, column(op) == DELETE
    found = (
        F.when(untouched, F.array(out(row, None, here)))
        .when(arrived & ~deletes & before.isNull(), F.array(out(row, None, here), out(row, INSERT, aside)))
        .when(arrived & ~deletes, F.array(out(row, None, here), out(before, BEFORE, aside), out(row, AFTER, aside)))
        .when(arrived & before.isNotNull(), F.array(out(before, REMOVED, aside)))
        .otherwise(none)
    )
    each = paired.select(F.explode(found).alias(made))
    fields = [F.col(made)["row"][c].alias(c) for c in names]
    return each.select(*fields, F.col(made)["change"].alias(change), F.col(made)["bucket"].alias(bucket))


def _order_safe(stored: DataFrame | None, resolved: DataFrame, keys, order_by, op: str, bucket: str, small: bool, buckets: int) -> DataFrame:
    """Newest row per key by ``order_by``, deletes kept as tombstones."""
    if stored is None:
        return _spread(resolved, buckets, bucket)
    if small:
        return _newest(stored, resolved, keys, order_by, bucket, buckets)
    rank, place = free_name("_rank", resolved.columns), free_name("_place", resolved.columns)
    both = stored.withColumn(rank, F.lit(0)).unionByName(resolved.withColumn(rank, F.lit(1)))
    newest = Window.partitionBy(bucket, *(column(k) for k in keys)).orderBy(
        *(column(c).desc() for c in order_by), F.col(rank).desc()
    )
    return _spread(both, buckets, bucket).withColumn(place, F.row_number().over(newest)).filter(F.col(place) == 1).drop(place, rank)


def _newest(stored: DataFrame, resolved: DataFrame, keys, order_by, bucket: str | None = None, buckets: int = 0) -> DataFrame:
    """Only stored rows of the operations' keys are compared; the others stay where they are.

    ``bucket`` is given if the keys are known to be few: then they are broadcast.
    """
    touched = resolved.select(*(column(k) for k in keys))
    if bucket:
        touched = F.broadcast(touched)
    others = stored.join(touched, list(keys), "left_anti")
    compared = order_safe_upsert(stored.join(touched, list(keys), "left_semi"), resolved, keys, order_by)
    return others.unionByName(_spread(compared, buckets, bucket) if bucket else compared)


def content_label(batch: DataFrame, table: str, prefix: str = "tablesync-") -> str:
    """Label of a batch of any size: same rows, same label, in whatever order they come.

    Each row's SHA-256 is spread into three numbers that are summed over all rows, so
    the work is one partial aggregation and no group holds the batch.
    """
    # Typed values in full: text made for a load would cut timestamps to seconds.
    ordered = F.struct(*(column(c) for c in sorted(batch.columns)))
    precise = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    digest = batch.select(F.sha2(F.to_json(ordered, precise), 256).alias("digest"))
    # The wide decimal leaves room for sums over any number of rows.
    pieces = [F.sum(F.xxhash64("digest", F.lit(i)).cast("decimal(28,0)")).alias(f"s{i}") for i in range(3)]
    sums = digest.agg(F.count(F.lit(1)).alias("n"), *pieces)
    body = F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in sums.columns))
    return sums.select(F.concat(F.lit(label_prefix(table, prefix)), F.sha2(body, 256))).first()[0]
