"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are measures of its own text and of the lines
beside it; a chain of weights between neighbouring labels ties them together. The
forward-backward pass gives each line's marginal, and a document's quality is the mean
of these weighted by line length, put on the scale of probabilities by a logistic curve.

The model is trained here, on a bounded sample of labelled documents; each line of it
carries the label of its document. Scoring covers all lines of all documents.

Defined results: a null or empty text counts as one empty line and gets a score like any
other. Labels that are null or neither 0 nor 1 are ignored; a document labelled both ways
counts as bad. Without labelled documents of both kinds all texts get the share of good
ones among those there are, with one of each added. An empty table gives no scores. Repeated
rows get equal scores; the score is a column expression, so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablesync.llm.quality_rules import STOP_WORDS

#: Labelled documents in the training sample. Those of more lines or characters are not drawn; drawn ones train as a whole.
#: So what the driver gathers is bounded. Scores are given to texts of any length.
TRAIN_DOCUMENTS = 3000
TRAIN_LINES = 500
TRAIN_CHARACTERS = 40_000

#: Documents whose chains are walked together, and lines they have when padded to the longest.
CHUNK = 512
PADDED_LINES = 60_000

_STOP = frozenset(STOP_WORDS)
_UPPER = bytes(c for c in range(256) if chr(c).isupper())
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>@^~=+_\\/{}[]"
_MARKS = b"!?;:"
_STOPS = b".,"

OWN = 12
FEATURES = 3 * OWN + 1


def lines_of(text: str | None) -> list[str]:
    return [x for x in (text or "").split("\n") if not x.isspace() and x] or [""]


def measures(lines: list[str]) -> np.ndarray:
    """The measures of each line by itself."""
    out = np.zeros((len(lines), OWN))
    seen: set[str] = set()
    for row, line in zip(out, lines, strict=True):
        raw = line.encode("latin-1", "replace")
        n = max(1, len(raw))
        words = line.split()
        k = max(1, len(words))
        row[0] = np.log1p(len(words))
        row[1] = n / k / 10
        for j, kind in enumerate((_UPPER, _DIGITS, _SYMBOLS, _MARKS, _STOPS), 2):
            row[j] = (len(raw) - len(raw.translate(None, kind))) / n
        row[7] = len([w for w in words if w in _STOP]) / k
        row[8] = 1 - len(set(words)) / k
        row[9] = line in seen
        row[10] = len(words) < 4
        row[11] = row[8] * row[0]
        seen.add(line)
    return out


def with_neighbours(own: np.ndarray) -> np.ndarray:
    """Each line's measures, those of the lines before and after it (zeros at the ends), and a constant."""
    out = np.zeros((len(own), FEATURES))
    out[:, :OWN] = own
    out[1:, OWN : 2 * OWN] = own[:-1]
    out[:-1, 2 * OWN : 3 * OWN] = own[1:]
    out[:, -1] = 1
    return out


def grouped(sizes: np.ndarray) -> list[np.ndarray]:
    """Chains by size, in groups that are walked together: no more padded lines than a bound, or one long chain alone."""
    order, out, start = np.argsort(sizes, kind="stable"), [], 0
    for at in range(1, len(order) + 1):
        if at == len(order) or at - start >= CHUNK or (at + 1 - start) * sizes[order[at]] > PADDED_LINES:
            out.append(order[start:at])
            start = at
    return out


def chains(scores: list[np.ndarray], transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over several chains at once: marginals, expected transitions and log partition of each.

    ``scores`` has two columns, bad and good, for each line. Chains are padded to the longest.
    """
    sizes = np.array([len(s) for s in scores])
    longest = sizes.max()
    e = np.zeros((len(scores), longest, 2))
    for i, s in enumerate(scores):
        e[i, : len(s)] = s
    top = e.max(2, keepdims=True)
    p, t = np.exp(e - top), np.exp(transition)
    inside = np.arange(longest)[None] < sizes[:, None]
    forward, backward, scale = np.zeros_like(p), np.ones_like(p), np.ones((len(scores), longest))
    for k in range(longest):
        f = p[:, k] if k == 0 else (forward[:, k - 1] @ t) * p[:, k]
        scale[:, k] = np.where(inside[:, k], f.sum(1), 1)
        forward[:, k] = np.where(inside[:, k, None], f / f.sum(1, keepdims=True), forward[:, k - 1] if k else 0)
    pairs = np.zeros((len(scores), 2, 2))
    for k in range(longest - 2, -1, -1):
        ahead = p[:, k + 1] * backward[:, k + 1] / scale[:, k + 1, None]
        on = inside[:, k + 1]
        backward[:, k] = np.where(on[:, None], ahead @ t.T, 1)
        pairs += np.where(on[:, None, None], forward[:, k, :, None] * t * ahead[:, None, :], 0)
    marginal = forward * backward
    marginal /= marginal.sum(2, keepdims=True)
    return marginal, pairs, (np.log(scale) + np.where(inside, top[:, :, 0], 0)).sum(1)


@dataclass(frozen=True)
class LineModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    transition: np.ndarray
    slope: float
    shift: float

    def emissions(self, own: np.ndarray) -> np.ndarray:
        return with_neighbours((own - self.mean) / self.spread) @ self.weights.T

    def raw(self, texts: list[list[str]], owns: list[np.ndarray]) -> np.ndarray:
        """The length-weighted mean of the marginals of each document."""
        out = np.zeros(len(texts))
        for part in grouped(np.array([len(lines) for lines in texts], np.int64)):
            marginal, _, _ = chains([self.emissions(owns[i]) for i in part], self.transition)
            for i, m in zip(part, marginal, strict=True):
                size = np.array([max(1, len(line)) for line in texts[i]])
                out[i] = (m[: len(size), 1] * size).sum() / size.sum()
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        lines = [lines_of(t) for t in texts]
        return _curve(self.raw(lines, [measures(x) for x in lines]), self.slope, self.shift)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _curve(p: np.ndarray, slope: float, shift: float) -> np.ndarray:
    return 1 / (1 + np.exp(-(slope * _logit(p) + shift)))


def train(texts: list[str | None], labels: list[int], steps: int = 150, rate: float = 0.1, decay: float = 1e-3) -> LineModel:
    """Maximum likelihood with weight decay, each document counting once; then the logistic curve on the documents' means."""
    if len(set(labels)) < 2:
        good = (sum(labels) + 1) / (len(labels) + 2)
        return LineModel(np.zeros(OWN), np.ones(OWN), np.zeros((2, FEATURES)), np.zeros((2, 2)), 0.0, float(np.log(good / (1 - good))))
    lines = [lines_of(t) for t in texts]
    owns = [measures(x) for x in lines]
    every = np.concatenate(owns)
    mean, spread = every.mean(0), every.std(0) + 1e-6
    rows = [with_neighbours((o - mean) / spread) for o in owns]
    flat = np.concatenate(rows)
    sizes = np.array([len(r) for r in rows])
    document = np.repeat(np.arange(len(rows)), sizes)
    place = np.concatenate([np.arange(n) for n in sizes])
    y = np.array(labels)
    truth = np.eye(2)[y[document]]
    once = 1 / sizes / len(rows)
    theta = np.zeros(2 * FEATURES + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    real_pairs = np.zeros((2, 2))
    for label in (0, 1):
        real_pairs[label, label] = ((sizes - 1) * once)[y == label].sum()
    groups = grouped(sizes)
    starts = np.cumsum(sizes) - sizes
    for step in range(1, steps + 1):
        weights, transition = theta[: 2 * FEATURES].reshape(2, FEATURES), theta[2 * FEATURES :].reshape(2, 2)
        e = flat @ weights.T
        marginal, pairs = np.zeros_like(e), np.zeros((2, 2))
        for group in groups:
            m, p, _ = chains([e[starts[i] : starts[i] + sizes[i]] for i in group], transition)
            for n, i in enumerate(group):
                marginal[starts[i] : starts[i] + sizes[i]] = m[n, : sizes[i]]
            pairs += (p * once[group, None, None]).sum(0)
        gradient = np.concatenate([(((truth - marginal) * once[document, None]).T @ flat).ravel(), (real_pairs - pairs).ravel()]) - decay * theta
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        theta = theta + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    model = LineModel(mean, spread, theta[: 2 * FEATURES].reshape(2, FEATURES), theta[2 * FEATURES :].reshape(2, 2), 1.0, 0.0)
    x = np.stack([_logit(model.raw(lines, owns)), np.ones(len(lines))], 1)
    fit = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ fit))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        fit = fit + np.linalg.solve(hessian, x.T @ (y - p) - 1e-2 * (fit - [1.0, 0.0]))
    return LineModel(model.mean, model.spread, model.weights, model.transition, float(max(fit[0], 0.05)), float(fit[1]))


def train_on(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCUMENTS) -> LineModel:
    """Trains on at most ``limit`` documents (``doc_id``, ``text``) with a label (``doc_id``, ``quality``), chosen by a hash of their ids."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    body = F.coalesce(F.col("text"), F.lit(""))
    short = docs.select("doc_id", body.alias("text")).where((F.length("text") <= TRAIN_CHARACTERS) & (F.size(F.split("text", "\n", -1)) <= TRAIN_LINES))
    # Ids alone meet; of rows of one id one is drawn.
    chosen = known.join(short.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # The whole sample has ``limit`` ids, so it is broadcast.
    rows = short.join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("text", "quality")).alias("r")).select("doc_id", "r.*").orderBy("doc_id").collect()
    return train([r.text for r in rows], [int(r.quality) for r in rows])


def quality_score(docs: DataFrame, text: Column, model: LineModel) -> Column:
    """The score of ``text``. The model, of fixed size, goes with the tasks."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for at in range(0, len(batch), CHUNK):
                out.append(model.score(batch[at : at + CHUNK].to_pylist()))
            yield pa.array(np.concatenate(out) if out else [], pa.float64())

    return scored(text)
