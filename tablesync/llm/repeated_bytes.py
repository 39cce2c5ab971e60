"""Removal of byte strings that occur before, by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every window of ``LENGTH`` bytes that also starts earlier is removed. Equal windows must
meet in one task, yet windows are as many as bytes. So each window is filed under its
anchor, the byte group of least hash in it: equal windows have equal anchors, and the
windows of one anchor stand side by side in a context of the text. Contexts that are
equal as a whole are settled by their hashes; only where one anchor has several different
contexts are the bytes fetched and compared.

The contexts of an anchor are joined into one text, and from its Burrows-Wheeler transform
intervals of suffixes are expanded breadth first by one byte to the left. The boundaries
that an interval meets first at depth d have a common prefix of d; those still unmet at
``LENGTH`` separate suffixes that share a window. Of such suffixes all but the first in
the corpus are removed. Anchors with very many different contexts are settled by
window, as a reduction that never holds a group.

Defined results: null and empty texts have no bytes. Texts shorter than a window lose
nothing. Rows equal in id and text are one document and get equal results. Rows of one
id with other texts are ordered by place first. Rows without an id come first. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from tablesync.llm.common import materialize

LENGTH = 100

#: Bytes in an anchor; a window holds LENGTH - GRAM + 1 of them.
GRAM = 24
SPAN = LENGTH - GRAM + 1

#: Bytes worked on at once; a longer text is worked on in pieces of so many windows. A worker holds some 200 bytes for each.
BLOCK = 1 << 18

#: Bytes of contexts that share a transform, about, and that are sent on at once.
TEXT = 1 << 19

#: Contexts of one anchor from which on its windows are settled one by one.
MANY = 5_000

_PLACE = np.uint64((1 << 22) - 1)
_BASE = 0xD6E8FEB86659FD93
MASK = (1 << 64) - 1


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of bytes, and powers of the base and of its inverse."""
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.random.default_rng(9).integers(1, 1 << 63, 256).astype(np.uint64), np.cumprod(up), np.cumprod(down)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hashes of any stretch of some bytes."""

    def __init__(self, data: np.ndarray):
        values, self.up, down = _powers(BLOCK + 4 * LENGTH)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[data] * down[: len(data)])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.up[start])


def contexts(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """The contexts of texts laid end to end: first window, number of windows, hash of the anchor, hash of the context."""
    n = len(data)
    if n < LENGTH:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    hashes = Hashes(data)
    at = np.arange(n - GRAM + 1)
    grams = hashes.of(at, at + GRAM)
    # The hash above the place: the least is the leftmost of equal ones.
    low = (grams & ~_PLACE) | at.astype(np.uint64)
    reach = 1
    while 2 * reach <= SPAN:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    low = np.minimum(low[: n - LENGTH + 1], low[SPAN - reach : SPAN - reach + n - LENGTH + 1])
    anchor = (low & _PLACE).astype(np.int64)
    start = np.arange(n - LENGTH + 1)
    text = np.searchsorted(ends, start, side="right")
    ok = start + LENGTH <= ends[np.minimum(text, len(ends) - 1)]
    start, anchor = start[ok], anchor[ok]
    if not len(start):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
    first = np.flatnonzero(new)
    windows = np.diff(first, append=len(start))
    s, p = start[first], anchor[first]
    whole = hashes.of(s, s + windows + LENGTH - 1)
    return s, windows, grams[p], _mix(whole + (p - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + windows.astype(np.uint64))


def pieces(texts: Iterable[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts in groups of bounded size: number of the text, place of the piece, bytes. Pieces of a long text overlap by a window less a byte."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), BLOCK):
            piece = text[at : at + BLOCK + LENGTH - 1]
            if group and size + len(piece) > BLOCK:
                yield group
                group, size = [], 0
            group.append((i, at, piece))
            size += len(piece)
    if group:
        yield group


ROWS = "anchor long, context long, id long, mark long, place long, done boolean"
_ORDER = ("anchor", "context", "id", "mark", "place")


def _file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contexts of each document; of equal ones in a group of texts only the first is still open."""
    for batch in batches:
        ids, marks = batch.column("id").to_numpy(zero_copy_only=False), batch.column("mark").to_numpy(zero_copy_only=False)
        # Bytes are taken out of the batch one text at a time.
        for group in pieces(t.as_py().encode() for t in batch.column("text")):
            sizes = np.array([len(p) for _, _, p in group])
            ends = np.cumsum(sizes)
            start, windows, anchor, context = contexts(np.frombuffer(b"".join(p for _, _, p in group), np.uint8), ends)
            text = np.searchsorted(ends, start, side="right")
            document = np.array([i for i, _, _ in group])[text]
            inside = start - (ends - sizes)[text] + np.array([at for _, at, _ in group])[text]
            rows = np.stack([anchor.view(np.int64), context.view(np.int64), ids[document], marks[document], (inside << 8) | windows], 1)
            rows = rows[np.lexsort(rows.T[::-1])]
            same, again = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
            same[1:] = (rows[1:, :2] == rows[:-1, :2]).all(1)
            again[1:] = (rows[1:] == rows[:-1]).all(1)  # an equal row
            yield _batch(rows[~again], same[~again])


def _batch(rows: np.ndarray, done: bool | np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({n: rows[:, i] for i, n in enumerate(_ORDER)} | {"done": np.full(len(rows), done)})


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor, context, id, mark and place. Closes all but the first of equal contexts, and drops contexts that are alone at their anchor.

    One row is held back between batches: whether its anchor has another context shows later.
    """
    held, multiple = None, False
    last = None

    for whole in batches:
        done = whole.column("done")
        yield whole.filter(done)
        batch = whole.filter(pa.compute.invert(done))
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in _ORDER], 1)
        before = np.concatenate([rows[:1] if last is None else last, rows[:-1]])
        same = (rows[:, 0] == before[:, 0]) & (rows[:, 1] == before[:, 1])
        equal = (rows == before).all(1)
        if last is None:
            same[0] = equal[0] = False
        last = rows[-1:]
        yield _batch(rows[same & ~equal], True)
        firsts = rows[~same]
        if not len(firsts):
            continue
        line = firsts if held is None else np.concatenate([held, firsts])
        joined = line[1:, 0] == line[:-1, 0]
        several = np.concatenate([[multiple], joined]) | np.concatenate([joined, [False]])
        yield _batch(line[:-1][several[:-1]], False)
        held, multiple = line[-1:], bool(several[-1])
    if held is not None and multiple:
        yield _batch(held, False)


FETCHED = "anchor long, id long, mark long, place long, bytes binary"
_FETCHED = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("mark", pa.int64()), ("place", pa.int64()), ("bytes", pa.binary())])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts that are asked for in each document."""
    for batch in batches:
        out: list[tuple] = []
        size = 0
        for i in range(batch.num_rows):
            asked = batch.column("asked")[i].values
            if not len(asked):
                continue
            data, own, mark = batch.column("text")[i].as_py().encode(), batch.column("id")[i].as_py(), batch.column("mark")[i].as_py()
            for anchor, place in zip(asked.field("anchor").to_pylist(), asked.field("place").to_pylist(), strict=True):
                found = data[place >> 8 : (place >> 8) + (place & 255) + LENGTH - 1]
                out.append((anchor, own, mark, place, found))
                size += len(found)
                if size > TEXT:
                    yield _columns(out, _FETCHED)
                    out, size = [], 0
        if out:
            yield _columns(out, _FETCHED)


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of at least their first ``depth`` symbols, by doubling from eight symbols on. Symbols are bytes."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    known = 8
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if known >= depth or rank[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[: n - known] = rank[known:] + 1
        key = rank * (n + 1) + after
        known *= 2


def unmet_boundaries(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix in order whether it shares ``depth`` symbols with the one before.

    Breadth-first expansion over the transform: an interval of suffixes that start with w is extended
    to those that start with cw. The end of the new interval, if no shorter string has met it, is a
    boundary of common prefix ``len(w)``; only then is the interval expanded further.
    """
    n = len(text)
    before = text[order - 1]  # the transform; the symbol before the first is the last
    by_symbol = np.argsort(before, kind="stable")
    step = np.empty(n, np.int64)
    step[by_symbol] = np.arange(n)
    following, preceding = np.full(n, n), np.full(n, -1)
    equal = before[by_symbol[1:]] == before[by_symbol[:-1]]
    following[by_symbol[:-1][equal]] = by_symbol[1:][equal]
    preceding[by_symbol[1:][equal]] = by_symbol[:-1][equal]
    met = np.zeros(n + 1, bool)
    met[0] = met[n] = True
    left, right = np.array([0]), np.array([n])
    for level in range(depth):
        width = right - left
        owner = np.repeat(np.arange(len(left)), width)
        at = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + left[owner]
        # The first and the last of each symbol in an interval bound the new interval of that symbol.
        starts, stops = np.sort(step[at[preceding[at] < left[owner]]]), np.sort(step[at[following[at] >= right[owner]]] + 1)
        new = ~met[stops] if level else np.ones(len(stops), bool)
        met[stops] = True
        left, right = starts[new], stops[new]
        if not len(left):
            break
    return ~met[:-1]


def repeats(rows: list[tuple[int, int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of contexts (id, mark, place, bytes) that equal an earlier window: id, mark and start in the document."""
    sizes = np.array([len(r[-1]) for r in rows])
    text = np.frombuffer(b"\xff".join(r[-1] for r in rows) + b"\xff", np.uint8)  # a byte that no UTF-8 text holds
    first = np.cumsum(sizes + 1) - sizes - 1
    order = suffix_order(text, LENGTH + 1)
    shared = unmet_boundaries(text, order, LENGTH)
    run = np.cumsum(~shared)
    context = np.searchsorted(first, order, side="right") - 1
    whole = order - first[context] + LENGTH <= sizes[context]
    order, run, context = order[whole], run[whole], context[whole]
    ids, marks, places = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    own, start, mark = ids[context], (places >> 8)[context] + order - first[context], marks[context]
    sort = np.lexsort((mark, start, own, run))
    again = np.concatenate([[False], run[sort][1:] == run[sort][:-1]])
    chosen = sort[again]
    return own[chosen], mark[chosen], start[chosen]


SPANS = "id long, mark long, start long, stop long"


def _spans(own: np.ndarray, mark: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Removed windows as maximal stretches."""
    order = np.lexsort((start, mark, own))
    own, mark, start = own[order], mark[order], start[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (mark[1:] != mark[:-1]) | (start[1:] > start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(own)]]) - 1
    return pa.record_batch({"id": own[first], "mark": mark[first], "start": start[first], "stop": start[last] + LENGTH})


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor, as many whole anchors together as fit in a text."""
    rows, size, anchor = [], 0, None
    for batch in batches:
        for a, own, mark, place, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "id", "mark", "place", "bytes")), strict=True):
            if a != anchor and size > TEXT:
                yield _spans(*repeats(rows))
                rows, size = [], 0
            anchor = a
            rows.append((own, mark, place, data))
            size += len(data)
    if rows:
        yield _spans(*repeats(rows))


_WINDOWS = pa.schema([("w", pa.binary()), ("id", pa.int64()), ("mark", pa.int64()), ("start", pa.int64())])


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of the contexts by itself, as a digest."""
    for batch in batches:
        out: list[tuple] = []
        for own, mark, place, data in zip(*(batch.column(c).to_pylist() for c in ("id", "mark", "place", "bytes")), strict=True):
            for i in range(len(data) - LENGTH + 1):
                out.append((hashlib.blake2b(data[i : i + LENGTH], digest_size=16).digest(), own, mark, (place >> 8) + i))
            if len(out) > 50_000:
                yield _columns(out, _WINDOWS)
                out = []
        if out:
            yield _columns(out, _WINDOWS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text."""
    for batch in batches:
        kept, spans, total = [], [], []
        for text, found in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True):
            data = text.as_py().encode()
            parts, at, n = [], 0, 0
            stop = -1
            for span in sorted((s["start"], s["stop"]) for s in found or ()):
                if span[0] > stop:
                    n += 1
                    parts.append(data[at : span[0]])
                    stop = span[1]
                stop = max(stop, span[1])
                at = stop
            parts.append(data[at:])
            kept.append(b"".join(parts))
            spans.append(n)
            total.append(len(data))
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_bytes": pa.array(total, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept": pa.array(kept, pa.binary())})


def without_repeats(docs: DataFrame, many: int = MANY) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_spans`` and ``kept`` (the bytes left) of each row of ``docs`` (``doc_id``, ``text``)."""
    body = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"))
    docs = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64("text").alias("mark"))
    filed = docs.where(F.octet_length("text") >= LENGTH).select("id", "mark", "text").mapInArrow(_file, ROWS)
    # What a task has settled already is spread by its own hash, not by its anchor.
    filed = filed.repartition(F.when(F.col("done"), F.xxhash64("id", "place")).otherwise(F.col("anchor")))
    settled = materialize(filed.sortWithinPartitions("done", *_ORDER).mapInArrow(_settle, ROWS), "contexts")
    asked = settled.where("not done")
    place = F.col("place")
    start = F.shiftright(place, 8)
    whole = settled.where("done").select("id", "mark", start.alias("start"), (start + place.bitwiseAND(F.lit(255).cast("long")) + (LENGTH - 1)).alias("stop"))
    by_document = asked.groupBy("id", "mark").agg(F.collect_list(F.struct("anchor", "place")).alias("asked"))
    with_text = docs.select("id", "mark", "text").join(by_document, ["id", "mark"]).select("id", "mark", "text", "asked").mapInArrow(_fetch, FETCHED)
    crowded = materialize(asked.groupBy("anchor").count().where(F.col("count") > many).select("anchor"), "crowded")
    spans = whole
    if crowded.isEmpty():
        few = with_text
    else:
        with_text = materialize(with_text, "context-bytes")
        few = with_text.join(crowded, "anchor", "left_anti")
        windows = with_text.join(crowded, "anchor", "left_semi").mapInArrow(_single, "w binary, id long, mark long, start long")
        windows = materialize(windows.distinct(), "windows")
        first = windows.groupBy("w").agg(F.min(F.struct("id", "start", "mark")).alias("first"))
        again = windows.join(first, "w").where(F.struct("id", "start", "mark") > F.col("first"))
        spans = spans.unionByName(again.select("id", "mark", "start", (F.col("start") + LENGTH).alias("stop")))
    compared = few.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare, SPANS)
    spans = spans.unionByName(compared).groupBy("id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    out = docs.join(spans, ["id", "mark"], "left").select("doc_id", "text", "spans")
    return out.mapInArrow(_cut, "doc_id long, n_bytes long, n_spans long, kept binary")
