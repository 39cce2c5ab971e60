"""Languages of texts by a string kernel: presence of blended n-grams, Nyström landmarks, ridge regression one against the rest.

Two texts are as alike as the distinct n-grams of letters, of all lengths in ``ORDERS``, that both have,
divided by the geometric mean of how many each has. A few labelled texts are landmarks. The kernel
of any text with the landmarks, times the inverse root of the kernel among the landmarks, is the text's
place in a space in which products come near the kernel. There each language gets a ridge regression
of +1 for its own texts and -1 for all others. N-grams that no landmark has are left out of the
kernel throughout: they are common to no text and landmark.

Texts are scored in batches: a matrix of the n-grams present, times that of the landmarks, gives the batch's
kernel, and that times the weights its scores. The best one, moved to 0 to 1, is the answer's score.

Defined results: texts that are null or have no letter are ``und`` with score 0. Texts without a known n-gram get
the language of most labelled rows and score 0. Without labelled rows all texts are ``und``. Ties
go to the first language in code point order. Any run of other characters counts as one space; texts are
read whole, a piece at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tablesync.llm.common import materialize

ORDERS = (2, 3, 4)

#: Landmarks and training rows of all languages together, and at least one of each language.
LANDMARKS = 128
TRAIN_DOCUMENTS = 3000

#: Landmarks are texts of so many characters, where a language has any.
LANDMARK_CHARACTERS = (400, 4000)

#: Weight of the ridge, for each training row.
RIDGE = 1e-3

#: Entries in a matrix of n-grams present (4 bytes each), and characters of a text read at once.
CELLS = 6_000_000
PIECE = 1 << 20

UNKNOWN = "und"

_SPACE = 32


@cache
def folded() -> np.ndarray:
    """For each code point its letter in lower case, or a space."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for c in range(0x110000):
        letter = chr(c)
        if letter.isalpha():
            lower = letter.lower()
            table[c] = ord(lower) if len(lower) == 1 else c
    return table


def pieces(text: str) -> Iterator[np.ndarray]:
    """The letters of a text, other stretches as one space; pieces overlap by an n-gram less a letter."""
    table, held = folded(), np.array([_SPACE], np.uint32)
    for at in range(0, len(text), PIECE):
        codes = table[np.frombuffer(text[at : at + PIECE].encode("utf-32-le", "surrogatepass"), "<u4")]
        if at + PIECE >= len(text):
            codes = np.append(codes, np.uint32(_SPACE))
        before = np.concatenate([held[-1:], codes[:-1]])
        codes = codes[(codes != _SPACE) | (before != _SPACE)]
        whole = np.concatenate([held, codes])
        yield whole
        held = whole[-(max(ORDERS) - 1) :]


def grams(codes: np.ndarray) -> np.ndarray:
    """All n-grams of some letters as 64-bit hashes."""
    found, h = [np.zeros(0, np.uint64)], codes.astype(np.uint64)
    for order in range(1, max(ORDERS) + 1):
        if order > 1:
            if len(codes) < order:
                break
            h = h[:-1] * np.uint64(0xD6E8FEB86659FD93) + codes[order - 1 :]
        if order in ORDERS:
            found.append((h + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15))
    return np.concatenate(found)


class Vocabulary:
    """Places of known n-grams. A table by hash holds them; those whose slot is taken go to a next table."""

    def __init__(self, known: np.ndarray):
        self.known = known
        bits = max(10, int(len(known)).bit_length() + 4)
        self.shift, self.tables = np.uint64(64 - bits), []
        left = np.arange(len(known))
        while len(left):
            slot = self._slot(known[left], len(self.tables))
            table = np.full(1 << bits, -1, np.int32)
            _, first = np.unique(slot, return_index=True)
            table[slot[first]] = left[first]
            self.tables.append(table)
            left = np.delete(left, first)

    def _slot(self, found: np.ndarray, level: int) -> np.ndarray:
        return (found * np.uint64(0xBF58476D1CE4E5B9 + 2 * level)) >> self.shift

    def places(self, found: np.ndarray) -> np.ndarray:
        """The places of those of the n-grams that are known."""
        out = []
        for level, table in enumerate(self.tables):
            place = table[self._slot(found, level)]
            taken = place >= 0
            place, found = place[taken], found[taken]
            same = self.known[place] == found
            out.append(place[same])
            found = found[~same]
            if not len(found):
                break
        return np.concatenate(out) if out else np.zeros(0, np.int32)


@dataclass
class Model:
    """``known``: hashes of the landmarks' n-grams; ``present``: which landmark has which, as bits; ``weights``: landmarks by languages."""

    known: np.ndarray
    present: np.ndarray
    landmarks: int
    languages: list[str]
    weights: np.ndarray | None
    usual: str

    def kernels(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Kernel of a batch of texts with the landmarks, whether each has letters, and whether it has known n-grams."""
        if not hasattr(self, "_vocabulary"):
            self._vocabulary = Vocabulary(self.known)
            matrix = np.unpackbits(self.present, axis=1, count=self.landmarks).astype(np.float32)
            # The length of a landmark is divided out beforehand.
            self._matrix = matrix / np.sqrt(np.maximum(matrix.sum(0), 1))
        height = max(1, min(256, CELLS // max(1, len(self.known))))
        for at in range(0, len(texts), height):
            group = texts[at : at + height]
            x = np.zeros((len(group), len(self.known)), np.float32)
            letters = np.zeros(len(group), bool)
            for i, text in enumerate(group):
                for codes in pieces(text or ""):
                    letters[i] |= bool((codes != _SPACE).any())
                    x[i, self._vocabulary.places(grams(codes))] = 1
            size = x.sum(1)
            yield (x @ self._matrix) / np.sqrt(np.maximum(size, 1))[:, None], letters, size > 0

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        if self.weights is None:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        for kernel, letters, known in self.kernels(texts):
            values = kernel @ self.weights
            best = values.argmax(1)
            score = np.clip((values[np.arange(len(best)), best] + 1) / 2, 0, 1)
            for b, s, has, k in zip(best, score, letters, known, strict=True):
                names.append(self.languages[b] if has and k else self.usual if has else UNKNOWN)
                scores.append(float(s) if has and k else 0.0)
        return names, scores


def landmark_model(texts: list[str], languages: list[str], usual: str) -> Model:
    """A model without weights: the n-grams of the landmarks."""
    own = [np.unique(np.concatenate([np.zeros(0, np.uint64), *(grams(codes) for codes in pieces(t))])) for t in texts]
    known = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
    matrix = np.zeros((len(known), len(texts)), np.uint8)
    for i, x in enumerate(own):
        matrix[np.searchsorted(known, x), i] = 1
    return Model(known, np.packbits(matrix, axis=1), len(texts), languages, None, usual)


def fit(model: Model, landmarks: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of the landmarks. ``landmarks``: the kernel among them; ``rows``: the kernel of training texts with them; ``labels``: their languages."""
    values, vectors = np.linalg.eigh(landmarks.astype(np.float64))
    keep = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, keep] / np.sqrt(values[keep])
    places = rows.astype(np.float64) @ root
    wanted = np.where(labels[:, None] == np.arange(len(model.languages)), 1.0, -1.0)
    ridge = places.T @ places + RIDGE * len(rows) * np.eye(places.shape[1])
    return (root @ np.linalg.solve(ridge, places.T @ wanted)).astype(np.float32)


def train_on(labelled: DataFrame) -> Model:
    """A model of the rows of ``labelled`` (``doc_id``, ``text``, ``lang``), of which it takes a bounded number, chosen by hash, and reads each whole."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts, key=lambda x: [ord(c) for c in x])
    if not languages:
        return Model(np.zeros(0, np.uint64), np.zeros((0, 0), np.uint8), 0, [], None, UNKNOWN)
    usual = max(languages, key=lambda x: counts[x])
    each, marks = max(1, TRAIN_DOCUMENTS // len(languages)), max(1, LANDMARKS // len(languages))
    draw = F.xxhash64("doc_id", "text")
    least, most = LANDMARK_CHARACTERS
    odd = ~F.length("text").between(least, most)
    # The choice is made on hashes; only chosen texts move.
    drawn = materialize(rows.select("lang", draw.alias("draw"), odd.alias("odd")).dropDuplicates(["lang", "draw"]), "language-draw")
    for_training = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    for_landmarks = F.row_number().over(Window.partitionBy("lang").orderBy("odd", "draw"))
    training = drawn.select("lang", "draw", for_training.alias("place")).where(F.col("place") <= each).select("lang", "draw", F.lit(False).alias("landmark"))
    chosen = drawn.select("lang", "draw", for_landmarks.alias("place")).where(F.col("place") <= marks).select("lang", "draw", F.lit(True).alias("landmark"))
    picked = rows.select("lang", draw.alias("draw"), "text").join(F.broadcast(training.unionByName(chosen)), ["lang", "draw"])
    picked = materialize(picked, "language-sample").dropDuplicates(["lang", "draw", "landmark"])
    texts = [r["text"] for r in picked.where("landmark").orderBy("lang", "draw").select("text").collect()]
    model = landmark_model(texts, languages, usual)
    among = np.concatenate([k for k, _, _ in model.kernels(texts)])
    found = picked.where("not landmark").select("lang", "draw", "text").mapInArrow(_kernel_rows(model), "lang string, draw long, kernel binary").orderBy("lang", "draw").collect()
    if not found:
        return model
    number = {name: i for i, name in enumerate(languages)}
    kernel = np.stack([np.frombuffer(r["kernel"], "<f4") for r in found])
    model.weights = fit(model, among, kernel, np.array([number[r["lang"]] for r in found]))
    return model


def _kernel_rows(model: Model):
    model = replace(model)  # without the matrix

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [k.astype("<f4").tobytes() for kernel, _, _ in model.kernels(batch.column("text").to_pylist()) for k in kernel]
            yield pa.record_batch({"lang": batch.column("lang"), "draw": batch.column("draw"), "kernel": pa.array(found, pa.binary())})

    return rows


ANSWER = StructType([StructField("lang", StringType()), StructField("score", DoubleType())])


def language(spark: SparkSession, text: Column, model: Model) -> Column:
    """Language and score of each text, as a struct."""
    # The kernel matrix is made again in each worker; what is sent are hashes and bits.
    sent = spark.sparkContext.broadcast(replace(model))

    @F.arrow_udf(ANSWER)
    def answer(texts: pa.Array) -> pa.Array:
        names, scores = sent.value.predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return answer(text)
