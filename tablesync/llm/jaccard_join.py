"""Documents linked by the Jaccard similarity of their word shingles, by universe-partition pigeonhole.

Two sets of the wanted similarity differ in at most H shingles, H set by the smaller one.
Shingles are hashed into segments, whose number is set by a band of sizes. As far as the
first U > H segments go, two such sets agree in U - H of them, so a key for each of the
first U segments finds every pair. Sets are matched in their own band and, as the smaller
one, in the next.

A segment with a unit of two admits one missing shingle: it gives the key of its shingles
and those of its one-deletion neighbourhood, and counts twice. Each band takes the
allocation of units that costs the fewest keys. Empty segments give no key. Two sets that
lack units through empty segments, and small ones, are matched by single shingles instead.

A set of more units than H shares several keys with any set it is linked with. So, with
all keys in one order, it may do without the last ones, as many as it can spare, and still
meets each of those sets at the first key they share. The order is by the number of sets
that share a key: what passages make common goes first, and sets with nothing but a
passage in common seldom meet.

Candidates are verified by exact intersection. First each set is compared with the one
that leads most of its keys; what these links join need not be compared again, and keys
within one component are left out of that order. Then pairs of sets that meet at a key and
are still in different components are compared, until no such pair is left untested. So
components are exact, and a group of copies costs as many comparisons as it has members.

Defined results: null texts, and texts without words, have no shingles and are linked with
nothing. Texts with fewer words than a shingle count as one. Documents of equal sets are
one set, of any number. Repeated rows and ids are members like others, rows without an id
take the component of their set. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tablesync.llm.common import fresh, materialize

#: Sets up to this size are matched by shingles alone.
SMALL = 12

#: Units beyond those that must agree, in parts of them.
SLACK = 1.0

#: The last two bits of a key name its kind: segments of an even band, of an odd one, or a single shingle.
KINDS = 3
SHINGLE = 2

#: Documents for each bucket of keys, about, and keys that are filed or sorted at once.
BUCKET_DOCUMENTS = 4096
FILED_KEYS = 300_000
BUCKET_KEYS = 1_000_000

#: Set ids up to this number are broadcast (8 bytes each).
BROADCAST_IDS = 1_000_000

#: Keys of more sets than this are compared in blocks of about so many sets.
SHARED_BY_MANY = 64
BLOCK_SETS = 512

#: Keys of a set that go with it to tell pairs that several tasks have; more of them only save work.
FIRST_KEYS = 8

#: Rounds in which components are compared through one set of each, before all pairs that are left.
STAR_ROUNDS = 2

REMEMBERED = 400_000


@dataclass(frozen=True)
class Similarity:
    """``part / 100`` of the union must be shared by sets of ``words``-word shingles."""

    words: int = 5
    part: int = 75

    def linked(self, shared: int, a: int, b: int) -> bool:
        return 100 * shared >= self.part * (a + b - shared)

    def larger(self, size: int) -> int:
        """The largest set that a set of this size can be linked with."""
        return 100 * size // self.part

    def apart(self, size: int) -> int:
        """The most shingles in which a set of this size differs from a larger or equal one linked with it."""
        return int(_apart(size, self))


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """Each 64-bit number spread over all bits."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of words met in one task; a reused worker keeps none of them for later tasks and stages."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, words: int, hashes: WordHashes | None = None) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes. Bytes fold and split just ASCII, as the words are defined."""
    found = text.encode().lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map((WordHashes() if hashes is None else hashes).__getitem__, found), np.uint64, len(found))
    n = max(1, len(h) - words + 1)
    total = np.full(n, len(h) if len(h) < words else words, np.uint64)
    for i in range(min(words, len(h))):
        total += h[i : i + n] * _odd(i)
    return np.unique(mixed(total, 100))


@cache
def _odd(i: int) -> np.uint64:
    """A multiplier for the word at each place."""
    return mixed(np.array([i + 1], np.uint64), 3)[0] | np.uint64(1)


def sketch(hashes: np.ndarray) -> bytes:
    """Bits that each shingle flips one of, at least two for each shingle. The bits in which two sketches differ are at most the shingles in which their sets differ."""
    bits = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    return np.packbits(np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ; the longer one is folded."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def set_id(hashes: np.ndarray) -> int:
    return int(np.add.reduce(mixed(hashes, 7)).astype(np.int64))


@cache
def band_edges(part: int) -> list[int]:
    """The least size in each band; a linked larger set is in the same band or the next."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(100 * edges[-1] // part + 1)
    return edges


@dataclass(frozen=True)
class Allocation:
    """``double`` segments of two units, each three times as wide as one of the ``single`` segments of one unit."""

    double: int
    single: int

    @property
    def width(self) -> int:
        return 3 * self.double + self.single


@cache
def allocation(band: int, similarity: Similarity) -> Allocation:
    """The allocation of units over segments that gives a set of the band the fewest keys, its expected empty segments made up for."""
    edges = band_edges(similarity.part)
    size = edges[band + 1] - 1
    needed = math.ceil((similarity.apart(size) + 1) * (1 + SLACK))
    best, least = Allocation(0, needed), math.inf
    for double in sorted({0, needed // 8, needed // 4, needed // 2}):
        single = max(0, needed - 2 * double)
        plan = Allocation(double, single)
        each = size / plan.width
        # Keys of a set, and what its empty segments leave uncovered, at the price of single shingles.
        keys = double * (1 + 3 * each) + single * (1 - math.exp(-each))
        units = 2 * double * (1 - math.exp(-3 * each) * (1 + 3 * each)) + double * 3 * each * math.exp(-3 * each) + single * (1 - math.exp(-each))
        short = similarity.apart(size) + 1 - units
        cost = keys + (size / 4 if short > 0 else 0)
        if cost < least:
            best, least = plan, cost
    return best


def _used(size: int | np.ndarray, plan: Allocation, similarity: Similarity):
    """How many single and double segments a set of this size uses; a larger set uses those of a smaller one and more."""
    wanted = np.ceil((_apart(size, similarity) + 1) * (1 + SLACK)).astype(np.int64)
    singles = np.minimum(plan.single, wanted)
    return singles, np.minimum(plan.double, -(-(wanted - singles) // 2))


def _apart(size: int | np.ndarray, similarity: Similarity):
    return (size + 100 * size // similarity.part) * (100 - similarity.part) // (100 + similarity.part)


def segment_keys(dealt: np.ndarray, band: int, similarity: Similarity, least: int) -> tuple[np.ndarray, int]:
    """The keys of a set in a band, and the units it can spare there towards any linked set of size ``least`` up to its own.

    ``dealt`` are its shingles with their halves swapped, sorted. Towards a smaller set only the segments count that the smaller one uses.
    """
    plan = allocation(band, similarity)
    size = len(dealt)
    singles, doubles = _used(size, plan, similarity)
    # The half that deals shingles to segments is the one they are sorted by, so segments come in order.
    segment = ((dealt >> np.uint64(32)) * np.uint64(plan.width) >> np.uint64(32)).astype(np.int64)
    if plan.double:
        segment = np.where(segment < plan.single, segment, plan.single + (segment - plan.single) // 3)
    use = segment < singles
    if doubles:
        use |= (segment >= plan.single) & (segment < plan.single + doubles)
    segment, tokens = segment[use], dealt[use]
    if not len(segment):
        return np.zeros(0, np.uint64), -1
    starts = np.concatenate([[0], np.flatnonzero(segment[1:] != segment[:-1]) + 1])
    held, count = segment[starts], np.diff(starts, append=len(segment))
    sums = np.add.reduceat(tokens, starts)
    keys = [mixed(sums + held.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 3000 + band)]
    double = held >= plan.single
    units = np.where(double, np.minimum(count, 2), 1)
    if double.any():
        each = np.repeat(np.arange(len(starts)), count)
        near = double[each] & (count[each] > 1)
        rest = sums[each[near]] - tokens[near]
        keys.append(mixed(rest + held[each[near]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 3000 + band))
    sizes = np.arange(least, size + 1)
    s, d = _used(sizes, plan, similarity)
    upto = np.concatenate([[0], np.cumsum(units)])
    have = upto[np.searchsorted(held, s)]
    if doubles:
        have = have + upto[np.searchsorted(held, plan.single + d)] - upto[np.searchsorted(held, plan.single)]
    return np.concatenate(keys), max(-1, int((have - _apart(sizes, similarity) - 1).min()))


def all_keys(hashes: np.ndarray, similarity: Similarity) -> tuple[np.ndarray, list[int]]:
    """All keys of a set, and for each kind how many it can do without; -1 where only sets that can spare keys surely meet it."""
    n = len(hashes)
    keys, spare = [np.zeros(0, np.uint64)], [-1] * KINDS
    if similarity.apart(n) < 1 and similarity.larger(n) <= n:
        return keys[0], spare  # linked with none but equal sets
    smallest, short = -(-n * similarity.part // 100), n <= similarity.larger(SMALL)
    if n > SMALL:
        edges = band_edges(similarity.part)
        band = bisect_right(edges, n) - 1
        dealt = np.sort((hashes << np.uint64(32)) | (hashes >> np.uint64(32)))
        for b in [band, band + 1] if similarity.larger(n) >= edges[band + 1] else [band]:
            found, spare[b % 2] = segment_keys(dealt, b, similarity, smallest if b == band else n)
            keys.append(_of_kind(found, b % 2))
            short |= spare[b % 2] < 0
    if short:
        # Sets that a small one, or one that lacks units, can be linked with meet it here.
        keys.append(_of_kind(mixed(hashes, 5000), SHINGLE))
        spare[SHINGLE] = smallest - 1
    return np.concatenate(keys), spare


def _of_kind(keys: np.ndarray, kind: int) -> np.ndarray:
    return (keys & ~np.uint64(3)) | np.uint64(kind)


SPARE = [f"spare{kind}" for kind in range(KINDS)]
_DOCUMENT = "doc_id long, n long, sketch binary, " + ", ".join(f"{c} int" for c in SPARE)
ROWS = f"bucket int, set long, sets binary, counts binary, keys binary, {_DOCUMENT}"
SHARED = f"key long, set long, leader long, {_DOCUMENT}"


def _rows(schema: str, **columns) -> pa.RecordBatch:
    """A batch of the schema; columns not given are null."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    size = len(next(iter(columns.values())))
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.array(columns[n], kinds[k]) if n in columns else pa.nulls(size, kinds[k]) for n, k in fields]
    return pa.record_batch(arrays, names=[n for n, _ in fields])


def _file(similarity: Similarity, buckets: int):
    """A row for each document, and rows of a bucket, some sets, and for each the number of its keys there and those keys, as 32-bit numbers."""

    def dealt(sets: list[int], keys: list[np.ndarray]) -> pa.RecordBatch:
        each = np.repeat(np.arange(len(sets)), [len(k) for k in keys])
        packed = np.concatenate(keys)
        home = (packed >> np.uint64(32)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
        order = np.argsort(home, kind="stable")
        home, each, low = home[order], each[order], packed[order].astype("<u4")
        own = np.array(sets, "<i8")
        runs = np.concatenate([[0], np.flatnonzero((home[1:] != home[:-1]) | (each[1:] != each[:-1])) + 1])
        counts, holders = np.diff(runs, append=len(home)).astype("<u4"), own[each[runs]]
        first = np.concatenate([[0], np.flatnonzero(np.diff(home[runs].astype(np.int64))) + 1, [len(runs)]])
        spans = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
        ends = np.append(runs, len(home))
        return _rows(
            ROWS,
            bucket=[int(home[runs[a]]) for a, _ in spans],
            sets=[holders[a:b].tobytes() for a, b in spans],
            counts=[counts[a:b].tobytes() for a, b in spans],
            keys=[low[ends[a] : ends[b]].tobytes() for a, b in spans],
        )

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            member: list[tuple] = []
            sets, keys, size, done = [], [], 0, {}
            for text in batch.column("text"):
                found = shingles(text.as_py(), similarity.words, hashes)
                if not len(found):
                    member.append((None, 0, None, *[None] * KINDS))
                    continue
                own = set_id(found)
                if own in done:
                    member.append(done[own])
                    continue
                k, spare = all_keys(found, similarity)
                home = (k >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                packed = np.unique((home << np.uint64(32)) | (k & np.uint64(0xFFFFFFFF)))
                # Keys that fall together are one key less to share.
                spare = [max(0, s - len(k) + len(packed)) if s > 0 else s for s in spare]
                done[own] = (own, len(found), sketch(found), *spare)
                member.append(done[own])
                if len(packed):
                    sets.append(own)
                    keys.append(packed)
                    size += len(packed)
                if size > FILED_KEYS:
                    yield dealt(sets, keys)
                    sets, keys, size = [], [], 0
            if member:
                names = ["set", "n", "sketch", *SPARE]
                yield _rows(ROWS, **dict(zip(names, zip(*member, strict=True), strict=True)), doc_id=batch.column("doc_id"))
            if sets:
                yield dealt(sets, keys)

    return file


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of documents, and of each key that several sets have: the key, a set, and the set that leads it.

    Keys are sorted a chunk at a time. Of former chunks only the leader of each key is kept,
    so a key may have any number of sets; buckets bound the number of keys.
    """
    known = {}  # by bucket: sorted keys with their leaders

    def settle(bucket: int, keys: np.ndarray, sets: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        names, place = np.unique(sets, return_inverse=True)
        both = np.unique((keys.astype(np.uint64) << np.uint64(32)) | np.repeat(place.astype(np.uint64), counts))
        keys, sets = (both >> np.uint64(32)).astype(np.uint32), names[(both & np.uint64(0xFFFFFFFF)).astype(np.int64)]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        count = np.diff(starts, append=len(keys))
        own, leaders = keys[starts], sets[starts]
        old_keys, old_leaders = known.get(bucket, (np.zeros(0, np.uint32), np.zeros(0, np.int64)))
        at = np.minimum(np.searchsorted(old_keys, own), max(len(old_keys) - 1, 0))
        old = old_keys[at] == own if len(old_keys) else np.zeros(len(own), bool)
        new = ~old
        leaders = np.where(old, old_leaders[at] if len(old_keys) else leaders, leaders)
        # A copy of the leader alone makes no key shared.
        old &= (count > 1) | (sets[starts] != leaders)
        several = np.repeat(old | (count > 1), count)
        out_keys, out_sets, out_leaders = keys[several], sets[several], np.repeat(leaders, count)[several]
        out_keys, out_sets, out_leaders = (np.concatenate(x) for x in ((out_keys, own[old]), (out_sets, leaders[old]), (out_leaders, leaders[old])))
        new_keys, new_leaders = np.concatenate([old_keys, own[new]]), np.concatenate([old_leaders, leaders[new]])
        order = np.argsort(new_keys, kind="stable")
        known[bucket] = new_keys[order], new_leaders[order]
        return _rows(SHARED, key=(np.int64(bucket) << 32) | out_keys.astype(np.int64), set=out_sets, leader=out_leaders)

    held: dict[int, list[tuple[bytes, bytes, bytes]]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for bucket, rows in held.items():
            sets, counts, keys = (np.frombuffer(b"".join(part), kind) for part, kind in zip(zip(*rows, strict=True), ("<i8", "<u4", "<u4"), strict=True))
            yield settle(bucket, keys, sets, counts)
        held.clear()

    for batch in batches:
        document = batch.filter(batch.column("bucket").is_null())
        yield _rows(SHARED, **{c: document.column(c) for c in ("set", "doc_id", "n", "sketch", *SPARE)})
        batch = batch.filter(batch.column("bucket").is_valid())
        for bucket, sets, counts, keys in zip(*(batch.column(c).to_pylist() for c in ("bucket", "sets", "counts", "keys")), strict=True):
            held.setdefault(bucket, []).append((sets, counts, keys))
            size += len(keys) // 4
        if size > BUCKET_KEYS:
            yield from flush()
            size = 0
    yield from flush()


def _arrays(similarity: Similarity):
    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [shingles(text.as_py(), similarity.words, hashes) for text in batch.column("text")]
            yield pa.record_batch({"set": pa.array([set_id(f) for f in found], pa.int64()), "hashes": pa.array([f.astype("<u8").tobytes() for f in found], pa.binary())})

    return arrays


def _likely(similarity: Similarity):
    """Keeps the pairs whose sizes and sketches allow a link."""

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "x", "y")), strict=True):
                most = (n + m) * (100 - similarity.part) // (100 + similarity.part)
                keep.append(max(n, m) <= similarity.larger(min(n, m)) and differing(x, y) <= most)
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(keep, pa.bool_()))

    return likely


def _verify(similarity: Similarity):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                a, b = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                small, large = (a, b) if len(a) <= len(b) else (b, a)
                shared = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                keep.append(similarity.linked(shared, len(a), len(b)))
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(keep, pa.bool_()))

    return verify


def components(edges: DataFrame) -> DataFrame:
    """``set`` and ``comp``, the smallest set it is joined with, for all ends of ``edges`` (``a``, ``b``).

    Each round hands every set the smallest label among its neighbours' and then the label of its label, until nothing changes.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).withColumnRenamed("a", "set"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("set", "b"), "b").groupBy("a").agg(F.min("comp").alias("near")).withColumnRenamed("a", "set")
        moved = labels.join(near, "set").select("set", "comp", F.least("comp", "near").alias("to"))
        jump = labels.select(F.col("set").alias("to"), F.col("comp").alias("further"))
        moved = materialize(moved.join(jump, "to").select("set", F.least("to", "further").alias("to"), (F.least("to", "further") < F.col("comp")).alias("moved")), "labels")
        labels = moved.select("set", F.col("to").alias("comp"))
        if moved.where("moved").isEmpty():
            return labels


class Checker:
    """Tells which pairs of sets are linked. Shingles are fetched once for each set that a likely pair has."""

    def __init__(self, docs: DataFrame, sets: DataFrame, similarity: Similarity):
        self.docs, self.sets, self.similarity = docs, sets, similarity
        self.arrays: DataFrame | None = None

    def fetch(self, likely: DataFrame) -> DataFrame:
        asked = likely.select(F.col("a").alias("set")).unionByName(likely.select(F.col("b").alias("set"))).distinct()
        if self.arrays is not None:
            asked = asked.join(self.arrays.select("set"), "set", "left_anti")
        wanted = materialize(asked.join(self.sets.select("set", F.col("doc_id").alias("_id")), "set"), "wanted")
        count = wanted.count()
        if count:
            wanted = F.broadcast(wanted) if count <= BROADCAST_IDS else wanted
            chosen = self.docs.join(wanted, self.docs["doc_id"].eqNullSafe(wanted["_id"]), "left_semi")
            new = chosen.select("text").mapInArrow(_arrays(self.similarity), "set long, hashes binary")
            new = materialize(new.dropDuplicates(["set"]), "arrays")
            self.arrays = new if self.arrays is None else self.arrays.unionByName(new)
        return self.arrays

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (``a``, ``b``) that are linked."""
        x = self.sets.select(F.col("set").alias("a"), "n", F.col("sketch").alias("x"))
        y = self.sets.select(F.col("set").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
        likely = pairs.join(x, "a").join(y, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(_likely(self.similarity), "a long, b long")
        likely = materialize(likely, "likely")
        if likely.isEmpty():
            return likely
        arrays = self.fetch(likely)
        x, y = arrays.select(F.col("set").alias("a"), F.col("hashes").alias("x")), arrays.select(F.col("set").alias("b"), F.col("hashes").alias("y"))
        return materialize(likely.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify(self.similarity), "a long, b long"), "links")


def linked_sets(docs: DataFrame, sets: DataFrame, shared: DataFrame, similarity: Similarity) -> DataFrame:
    """``set`` and ``comp`` for all sets that are linked with another."""
    checker = Checker(docs, sets, similarity)
    # Each set with the leader of most of its keys.
    pair = shared.where("set <> leader").groupBy("set", "leader").agg(F.count(F.lit(1)).alias("n"))
    best = pair.groupBy("set").agg(F.max(F.struct("n", (-F.col("leader")).alias("to"))).alias("m")).select(F.col("set").alias("b"), (-F.col("m.to")).alias("a"))
    tested = materialize(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    links = checker.linked(tested)
    comps = components(links)
    rows, turn = _needed(_open(shared.select("key", "set"), comps), sets), 0
    while True:
        found = materialize(_new(_all_pairs(rows, sets, similarity) if turn >= STAR_ROUNDS else _star_pairs(rows), tested), "pairs")
        if found.isEmpty():
            if turn >= STAR_ROUNDS:
                return comps
            turn = STAR_ROUNDS
            continue
        tested = tested.unionByName(found)
        fresh = checker.linked(found)
        if not fresh.isEmpty():
            links = links.unionByName(fresh)
            comps = components(links)
        if turn >= STAR_ROUNDS:
            return comps
        rows, turn = materialize(_open(rows.drop("comp", "sharers"), comps), "open-keys"), turn + 1


def _open(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """``rows`` with the component of each set and the number of rows of its key, at keys whose sets are in several components.

    Other keys no longer matter, and joining components never adds one.
    """
    known = F.broadcast(comps) if comps.count() <= BROADCAST_IDS else comps
    labelled = rows.join(known, "set", "left").withColumn("comp", F.coalesce("comp", "set"))
    groups = labelled.groupBy("key").agg(F.count(F.lit(1)).alias("sharers"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    return labelled.join(groups.select("key", "sharers"), "key")


def _needed(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The keys at which a set must be compared: of each kind all but the most shared ones that it can spare."""
    kind = F.col("key").bitwiseAND(F.lit(3))
    spare = F.when(kind == 0, F.col("spare0")).when(kind == 1, F.col("spare1")).otherwise(F.col("spare2"))
    rows = rows.join(sets.select("set", F.col("n").alias("size"), *SPARE), "set").withColumn("kind", kind)
    # Equal keys of a set, from several chunks, rank alike.
    rank = F.dense_rank().over(Window.partitionBy("set", "kind").orderBy(F.desc("sharers"), "key"))
    ranked = rows.select("key", "set", "comp", "sharers", "size", spare.alias("spare"), rank.alias("rank"))
    kept = ranked.where("rank > spare").select("key", "set", "comp", "size", (F.col("spare") < 0).alias("short"))
    return materialize(kept, "needed-keys")


def _new(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")


def _star_pairs(rows: DataFrame) -> DataFrame:
    """One set of each component at each key, with that of the key's first component."""
    each = rows.groupBy("key", "comp").agg(F.min("set").alias("set"))
    first = each.groupBy("key").agg(F.min(F.struct("comp", "set")).alias("f"))
    return each.join(first, "key").where("comp <> f.comp").select(F.col("set").alias("a"), F.col("f.set").alias("b"))


def _once(rows: DataFrame) -> DataFrame:
    """One key of each group of sets. A passage gives as many keys as it has shingles, and all of them have the same sets."""
    own = [F.sum(F.xxhash64("set", "short", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(2)]
    groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *own)
    return rows.join(groups.groupBy("n", "s0", "s1").agg(F.min("key").alias("key")).select("key"), "key")


def _all_pairs(rows: DataFrame, sets: DataFrame, similarity: Similarity) -> DataFrame:
    """The pairs across components that share a key. Sizes too far apart rule a link out before a pair is made; two sets that both lack units meet at single shingles.

    The sets of a key that many have are dealt into blocks, and each two blocks are compared by their sketches in a task of
    their own. Only pairs that may be linked leave it, so the rows made follow the links and not the square of the group.
    """
    rows = materialize(_once(rows), "groups")
    blocks = F.ceil(F.col("n") / BLOCK_SETS).cast("int")
    groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARED_BY_MANY).select("key", blocks.alias("blocks"))
    few = rows.join(groups, "key", "left_anti")
    left = few.select("key", F.col("set").alias("a"), F.col("comp").alias("ca"), F.col("size").alias("na"), F.col("short").alias("sa"))
    right = few.select("key", F.col("set").alias("b"), F.col("comp").alias("cb"), F.col("size").alias("nb"), F.col("short").alias("sb"))
    fits = 100 * F.least("na", "nb") >= similarity.part * F.greatest("na", "nb")
    pairs = left.join(right, "key").where((F.col("ca") < F.col("cb")) & fits & ~(F.col("sa") & F.col("sb"))).select("a", "b")
    many = rows.join(groups, "key").join(sets.select("set", "sketch"), "set").withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    # Sets that are alike share many keys; by the first keys of both a task sees that another one has the pair.
    first = many.where("not short").groupBy("set").agg(F.slice(F.array_sort(F.collect_set("key")), 1, FIRST_KEYS).alias("first"))
    many = many.join(first, "set", "left").withColumn("first", F.coalesce("first", F.array().cast("array<bigint>")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = many.select("key", "set", "comp", "size", "short", "sketch", "first", "block", other.alias("other"))
    cells = met.select(F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "key", "block", "set", "comp", "size", "short", "sketch", "first")
    cell = ["key", "low", "high"]
    return pairs.unionByName(cells.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(_block_pairs(similarity), "a long, b long"))


def _block_pairs(similarity: Similarity):
    """The pairs of a cell's two blocks, or within its one block, that may be linked."""

    def pairs(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        key, low, high = rows[0][:3]
        classes: dict[int, list[tuple]] = {}
        for row in rows:
            classes.setdefault(len(row[8]), []).append(row)
        # Linked sets differ by a third in size at most, so their sketches are of one length or of two next ones.
        sides = {}
        for length, own in classes.items():
            words = np.frombuffer(b"".join(r[8] for r in own), "<u8").reshape(len(own), -1)
            sides[length] = (np.array([r[3:8] for r in own], np.int64), words, [frozenset(k for k in r[9] if k < key) for r in own])
        for length, (x, words, firsts) in sides.items():
            for longer in (length, 2 * length):
                if longer not in sides:
                    continue
                y, others, other_firsts = sides[longer]
                if longer > length:
                    others = others[:, : words.shape[1]] ^ others[:, words.shape[1] :]
                for i, (block, own, comp, size, short) in enumerate(x):
                    ok = (y[:, 2] != comp) & (100 * np.minimum(y[:, 3], size) >= similarity.part * np.maximum(y[:, 3], size)) & ~((y[:, 4] == 1) & bool(short))
                    if low != high:
                        ok &= y[:, 0] != block
                    if longer == length:
                        ok[: i + 1] = False
                    at = np.flatnonzero(ok)
                    if len(at):
                        apart = np.bitwise_count(others[at] ^ words[i]).sum(1, dtype=np.int64)
                        at = at[apart <= (y[at, 3] + size) * (100 - similarity.part) // (100 + similarity.part)]
                        yield from ((own, y[j, 1]) for j in at.tolist() if firsts[i].isdisjoint(other_firsts[j]))

    def of_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(rows: list[tuple]) -> pa.RecordBatch:
            found = list(pairs(rows))
            return pa.record_batch({n: pa.array([f[i] for f in found], pa.int64()) for i, n in enumerate("ab")})

        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "low", "high", "block", "set", "comp", "size", "short", "sketch", "first")), strict=True):
                if rows and rows[0][:3] != row[:3]:
                    yield told(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield told(rows)

    return of_cells


def classes(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row of ``docs`` (``doc_id``, ``text``)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.count() // BUCKET_DOCUMENTS + 1)
    filed = docs.mapInArrow(_file(similarity, buckets), ROWS)
    home = F.coalesce("bucket", F.pmod(F.hash("set", "doc_id"), F.lit(buckets)))
    filed = materialize(filed.repartitionById(buckets, home).mapInArrow(_shared, SHARED), "shared-keys")
    members = filed.where("key is null")
    firsts = members.where("set is not null").groupBy("set").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("n", "sketch", *SPARE)))
    firsts = materialize(firsts, "sets")
    comps = linked_sets(docs, firsts, filed.where("key is not null").select("key", "set", "leader"), similarity)
    sets = firsts.select("set", F.col("doc_id").alias("least")).join(comps, "set", "left").withColumn("comp", F.coalesce("comp", "set"))
    roots = sets.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = sets.join(roots, "comp").select("set", "component_id")
    out = members.join(named, "set", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """The rows of ``docs`` that stand for their component: those of its smallest id, equal texts of one id once.

    Rows without words stand for themselves; of rows without an id, those whose component has no id at all stay.
    """
    found = materialize(classes(docs.select("doc_id", "text"), similarity).where(F.col("doc_id").eqNullSafe(F.col("component_id"))), "classes")
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    ids = materialize(ids, "representatives")
    repeated = not ids.where("rows > 1").isEmpty()
    own = fresh(docs, "_id")
    ids = ids.select(F.col("doc_id").alias(own))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    kept = docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(F.col(own)), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"]) if repeated else kept
