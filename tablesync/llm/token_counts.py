"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut where no piece of the vocabulary can cross, which loses nothing. Each
segment is a linked list of symbols; a heap gives the adjacent pair of lowest rank,
leftmost first, and merging it links its neighbours. The count is the number of
symbols at the start minus the merges; no identifiers are made. Symbols that the
vocabulary lacks count one token for each of their bytes.

Defined results: null and empty texts have 0 tokens; texts are never cut short.
Rows are independent, so repeated rows, empty tables and extra columns need no care;
the count is a column expression.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

#: Fixed value: how the vocabulary writes a blank.
BLANK = "▁"

#: Counts of segments that a worker remembers; beyond it the memory starts anew.
REMEMBERED = 300_000


@dataclass(frozen=True)
class PieceTable:
    """Pieces of a vocabulary with the rank at which a merge makes them, equal for equal scores."""

    ranks: dict[str, int]
    segments: str

    @classmethod
    def load(cls, path: str) -> PieceTable:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        levels = {score: n for n, score in enumerate(sorted({model.get_score(i) for i in ids}, reverse=True))}
        return cls.of({model.id_to_piece(i): levels[model.get_score(i)] for i in ids})

    @classmethod
    def of(cls, ranks: dict[str, int]) -> PieceTable:
        """Segments start at a run of blanks if no piece holds a blank after another symbol; line ends stand alone if no piece joins them."""
        joined = [p for p in ranks if len(p) > 1]
        if any(BLANK in p.lstrip(BLANK) for p in joined):
            return cls(ranks, r"(?s).+")
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in joined))
        body = f"[^{BLANK}{alone}]"
        return cls(ranks, f"{BLANK}+{body}*|{body}+" + (f"|[{alone}]" if alone else ""))


def merged_length(segment: str, ranks: dict[str, int]) -> int:
    """Number of tokens of one segment."""
    left_over = sum(len(c.encode()) - 1 for c in segment if c not in ranks)
    n = len(segment)
    if n == 1:
        return 1 + left_over
    parts: list[str | None] = list(segment)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(ranks[pair], i, i + 1, 2) for i in range(n - 1) if (pair := segment[i : i + 2]) in ranks]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, j, size = heapq.heappop(heap)
        left = parts[i]
        if left is None or after[i] != j or len(left) + len(parts[j]) != size:
            continue  # one of the two has been merged since
        merged = parts[i] = left + parts[j]
        parts[j] = None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (rank := ranks.get(merged + parts[k])) is not None:
                heapq.heappush(heap, (rank, i, k, size + len(parts[k])))
        h = before[i]
        if h >= 0 and (rank := ranks.get(parts[h] + merged)) is not None:
            heapq.heappush(heap, (rank, h, i, len(parts[h]) + size))
        merges += 1
    return n - merges + left_over


class Counts(dict):
    """Tokens of each segment met so far; long segments are not remembered."""

    def __init__(self, ranks: dict[str, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, segment: str) -> int:
        n = merged_length(segment, self.ranks)
        if len(segment) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[segment] = n
        return n


def count_text(text: str | None, counts: Counts, segments: re.Pattern) -> int:
    if not text:
        return 0
    return sum(map(counts.__getitem__, segments.findall(BLANK + text.replace(" ", BLANK))))


#: What a worker has learned, by the broadcast it came with.
_LEARNED: dict[int, tuple[Counts, re.Pattern]] = {}


def token_count(spark: SparkSession, text: Column, pieces: PieceTable) -> Column:
    """The number of tokens of ``text``. The vocabulary, of fixed size, is broadcast."""
    shared = spark.sparkContext.broadcast((pieces.ranks, pieces.segments))
    number = shared._jbroadcast.id()

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if number not in _LEARNED:
            ranks, pattern = shared.value
            _LEARNED[number] = Counts(ranks), re.compile(pattern)
        counts, segments = _LEARNED[number]
        for batch in batches:
            yield pa.array([count_text(t.as_py(), counts, segments) for t in batch], pa.int64())

    return counted(text)
