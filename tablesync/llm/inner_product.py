"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are grouped by length (norm) into bands, and bands into cells of bounded
size. Each query first gets a threshold: its k-th best score among the longest vectors,
a set of fixed size. A band whose longest vector cannot reach the threshold is not
visited at all. Inside a cell the threshold turns into a cosine for each query: a high
one is met by few directions, so coordinates prune (a candidate must agree with the
query in its strongest coordinates); a low one leaves only lengths to prune by. What
survives is verified with exact integer products.

Queries stream through the cells, so a task holds one cell of candidates and one batch
of queries, whatever the size of the input and however equal the vectors are.

Defined results: rows whose id or vector is null, or whose vector holds a null or a
component that is not finite, take no part. Vectors of unequal length compare as if
filled up with zeros. Equal rows count once; rows with one id but other vectors are all
candidates and queries of their own. Ties go to the smaller id. Fewer candidates than
k give fewer ranks. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F

from tablesync.llm.common import materialize

#: Candidates in a cell, about.
CELL_ROWS = 16_384

#: Longest vectors that give every query its threshold.
SEED_ROWS = 2_048

#: Bands for each doubling of the norm.
BANDS = 4

#: Queries scored together.
BLOCK = 256

#: From this cosine on coordinates prune; they use so many of a query's strongest ones.
COSINE = 0.6
FOCUS = 3


def whole_vectors(df: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id``, ``v`` as whole numbers floor(scale * x), and the squared norm ``n2``; only valid rows, equal ones once."""
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = df.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    v = good.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v")).distinct()
    # As doubles, since a square may pass 64 bits where all products fit.
    return v.withColumn("n2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))


def _matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def _exact(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer products; through doubles where these are exact, as they are far faster."""
    width = max(queries.shape[1], 1)
    if not len(queries) or not len(candidates) or float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * width < 2**52:
        return np.rint(queries.astype(float) @ candidates.astype(float).T).astype(np.int64)
    return queries @ candidates.T


class Cell:
    """Candidates of one norm band, longest first."""

    def __init__(self, ids: list[int], vectors: list[np.ndarray]):
        self.width = max((len(v) for v in vectors), default=0)
        m = _matrix(vectors, self.width)
        norms = np.sqrt((m.astype(float) ** 2).sum(1))
        order = np.argsort(-norms, kind="stable")
        self.ids, self.m, self.norms = np.array(ids, np.int64)[order], m[order], norms[order]
        self.unit = self.m / np.maximum(self.norms, 1e-300)[:, None]

    def survivors(self, q: np.ndarray, least: float) -> np.ndarray:
        """Places of the candidates that may score ``least`` or more with ``q``."""
        length = np.sqrt((q.astype(float) ** 2).sum())
        if least == -np.inf:
            return np.arange(len(self.ids))
        if length == 0 or not len(self.ids):
            return np.arange(len(self.ids)) if least <= 0 else np.arange(0)
        slack = 1 - 1e-9
        if least <= 0:
            return np.arange(len(self.ids))
        # Longer ones come first, so length cuts a prefix.
        near = np.arange(np.searchsorted(-self.norms, -(least / length) * slack, side="right"))
        if not len(near):
            return near
        cosine = least / (length * self.norms[0]) * slack
        if cosine < COSINE:
            return near
        # With c = cosine and a the query's own coordinate, the candidate's lies in a*c -/+ sqrt((1 - a^2)(1 - c^2)),
        # or beyond, on the side of a, where c is below a.
        direction = q[: self.width] / length
        keep = np.ones(len(near), bool)
        for f in np.argsort(-np.abs(direction), kind="stable")[:FOCUS]:
            a = direction[f]
            reach = np.sqrt(max(0.0, 1 - a * a) * max(0.0, 1 - cosine * cosine))
            low = a * cosine - reach if -a < cosine else -1.0
            high = a * cosine + reach if a < cosine else 1.0
            keep &= (self.unit[near, f] >= low - 1e-9) & (self.unit[near, f] <= high + 1e-9)
        return near[keep]

    def best(self, ids: np.ndarray, queries: list[np.ndarray], least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each query its k best here, as query number, candidate id and score."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        q = _matrix([v[: self.width] for v in queries], self.width)
        # The whole query bounds a score, also where it is longer than the candidates.
        alive = [self.survivors(row, bound) for row, bound in zip(q, least, strict=True)]
        dense = [i for i, a in enumerate(alive) if len(a) * 2 > len(self.ids)]
        scores = dict(zip(dense, _exact(q[dense], self.m), strict=True)) if dense else {}
        for i, places in enumerate(alive):
            s = scores[i][places] if i in scores else _exact(q[i : i + 1], self.m[places])[0]
            fits = (self.ids[places] != ids[i]) & (s >= least[i])
            places, s = places[fits], s[fits]
            if len(s) > k:
                few = s >= -np.partition(-s, k - 1)[k - 1]
                places, s = places[few], s[few]
            top = np.lexsort((self.ids[places], -s))[:k]
            out.append((np.full(len(top), i), self.ids[places][top], s[top]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3  # type: ignore[return-value]


def _vectors(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    return np.split(flat, ends[:-1]) if len(ends) else []


RESULT = "query_id long, q long, vec_id long, score long"


def _visit(k: int):
    """Rows come sorted by cell, candidates before queries."""

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell_of, cell, ids, vectors = None, None, [], []
        for batch in batches:
            cells, roles = batch.column("cell").to_pylist(), batch.column("role").to_numpy(zero_copy_only=False)
            own, found = batch.column("id").to_numpy(zero_copy_only=False), _vectors(batch.column("v"))
            least, numbers = batch.column("least").to_numpy(zero_copy_only=False), batch.column("q").to_numpy(zero_copy_only=False)
            at = 0
            while at < len(cells):
                end = at
                while end < len(cells) and end - at < BLOCK and cells[end] == cells[at] and roles[end] == roles[at]:
                    end += 1
                if cells[at] != cell_of:
                    cell_of, cell, ids, vectors = cells[at], None, [], []
                if roles[at] == 0:
                    ids += own[at:end].tolist()
                    vectors += found[at:end]
                elif ids:
                    cell = cell or Cell(ids, vectors)
                    i, candidate, score = cell.best(own[at:end], found[at:end], least[at:end], k)
                    yield pa.record_batch({"query_id": own[at:end][i], "q": numbers[at:end][i], "vec_id": candidate, "score": score})
                at = end

    return visited


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best of ``vectors`` for each of ``queries``, both from ``whole_vectors``."""
    spark = vectors.sparkSession
    band = F.when(F.col("n2") > 0, F.floor(F.log2("n2") / 2 * BANDS)).otherwise(-1).cast("int")
    vectors = materialize(vectors.withColumn("band", band), "vectors")
    q = materialize(queries.select(F.col("vec_id").alias("id"), "v", "n2", F.xxhash64("v").alias("q")), "queries")
    row = lambda cell, role, least: [F.lit(role).alias("role"), cell.alias("cell"), "id", "v", least.alias("least"), "q"]
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # First look: every query at the longest vectors, in cells of queries instead of candidates.
    seeds = vectors.orderBy(F.desc("n2"), "vec_id").limit(SEED_ROWS).select(F.col("vec_id").alias("id"), "v", F.lit(0).cast("long").alias("q"))
    groups = F.sequence(F.lit(0), F.lit(parts - 1))
    none = F.lit(float("-inf"))
    first = seeds.select("*", F.explode(groups).alias("g")).select(*row(F.col("g"), 0, none))
    asked = q.withColumn("g", F.pmod(F.xxhash64("id", "q"), F.lit(parts)).cast("int")).select(*row(F.col("g"), 1, none))
    seen = first.unionByName(asked).repartition(parts, "cell").sortWithinPartitions("cell", "role").mapInArrow(_visit(k), RESULT)
    kth = _ranked(seen, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), "q", F.col("score").cast("double").alias("least"))
    q = materialize(q.join(kth, ["id", "q"], "left").withColumn("least", F.coalesce("least", none)), "thresholds")
    # One row for each band: few, as bands grow with the logarithm of the norm.
    bands = vectors.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.max("n2").alias("top")).withColumn("cells", F.ceil(F.col("n") / CELL_ROWS).cast("int"))
    held = vectors.join(F.broadcast(bands.select("band", "cells")), "band")
    cell = lambda c: F.concat_ws(":", F.col("band").cast("string"), c.cast("string"))
    held = held.select(F.col("vec_id").alias("id"), "v", F.lit(0).cast("long").alias("q"), "band", F.pmod(F.xxhash64("vec_id"), F.col("cells")).alias("c"))
    # That table, of a few dozen rows, becomes a constant.
    every = F.array(*(F.struct(F.lit(r.band).alias("band"), F.lit(r.top).alias("top"), F.lit(r.cells).alias("cells")) for r in bands.collect()))
    # Norms are multiplied as doubles: the product of two squared ones may pass 64 bits.
    reach = lambda b: F.sqrt("n2") * F.sqrt(b["top"]) * (1 + 1e-9) >= F.col("least")
    every = every.cast("array<struct<band: int, top: double, cells: int>>")
    visits = q.select("id", "v", "q", "least", F.explode(F.filter(every, reach)).alias("b"))
    visits = visits.select("id", "v", "q", "least", F.col("b.band").alias("band"), F.explode(F.sequence(F.lit(0), F.col("b.cells") - 1)).alias("c"))
    both = held.select(*row(cell(F.col("c")), 0, none)).unionByName(visits.select(*row(cell(F.col("c")), 1, F.col("least"))))
    scored = both.repartition("cell").sortWithinPartitions("cell", "role").mapInArrow(_visit(k), RESULT)
    return _ranked(scored, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
