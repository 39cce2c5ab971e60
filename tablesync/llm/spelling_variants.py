"""Words one edit apart, by a frontier of states that walks a trie as a table, level by level.

The trie of all words is a table of nodes (a prefix, the letters that go on from it, whether it
is a word). A state (word, position, node, edits) says that the word's first ``position`` letters
lead to the node with that many edits. Each level joins the states with the nodes of one depth
and makes those of the next: a state without an edit goes on along its word, or takes the one
edit; a state with an edit only goes on along its word. A state with one edit at the end of its word,
at a node that is a word, is a pair of neighbours.

Neighbours are so both ways, and each pair is walked from one of its words: from the longer one, which
leaves a letter out, or of two of equal length from that of the smaller letter, which replaces it by a greater one.
The edit is always put where word and node first differ, and only in the second half of a word: a
second trie of the reversed words, walked in the same joins, finds the other pairs. So states hardly fan
out, and walks start in the middle of each word on a path that is known to exist.

Words of more than ``LEVELS`` letters would need as many joins. Pairs with one of them are found by
the hashes of their strings with one letter left out, and compared in full.

Defined results: null texts have no words, rows without an id count with an empty one, repeated rows
count each. Without documents, or without words that occur twice, there are no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablesync.llm.common import materialize

LETTERS = "A-Za-zÀ-ÿ"

#: Words are results of at least so many letters and occurrences.
LEAST_LETTERS = 7
LEAST_COUNT = 2

#: One run in so many, by a checksum, loses a letter before it is counted.
MISSPELT = 31

#: A word's form occurs at least so many times as often.
RATIO = 10

#: Levels that are walked; pairs with a longer word are found by hashes.
LEVELS = 64

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of the runs of letters in ``docs`` (``doc_id``, ``text``), some of them misspelt by rule."""
    # Shorter runs can't give words.
    runs = F.regexp_extract_all("text", F.lit(f"([{LETTERS}]{{{LEAST_LETTERS},}})"), F.lit(1))
    lowered = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    lowered = lowered.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    summed = lowered.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"), F.length("run").alias("letters"))
    at = (F.col("h") % F.col("letters")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.col("letters")))
    words = summed.select(F.when(F.col("h") % MISSPELT == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def both_ways(words: DataFrame) -> DataFrame:
    """Each word as it is and reversed, and its ``start``: one of both walks meets the place of any edit, as the starts add up to the word's length."""
    half = F.length("word") / 2
    forward = words.select(F.lit(False).alias("reversed"), "word", F.floor(half).cast("int").alias("start"))
    return forward.unionByName(words.select(F.lit(True).alias("reversed"), F.reverse("word").alias("word"), F.ceil(half).cast("int").alias("start")))


def trie_nodes(words: DataFrame) -> DataFrame:
    """The nodes of both tries from the middle of a word on: ``reversed``, ``depth``, ``node``, ``onward`` (letters) and ``whole``."""
    steps = both_ways(words).select("reversed", "word", F.explode(F.sequence("start", F.length("word"))).alias("depth"))
    prefix = F.col("word").substr(F.lit(1), F.col("depth"))
    letter = F.col("word").substr(F.col("depth") + 1, F.lit(1))
    steps = steps.select("reversed", "depth", prefix.alias("node"), letter.alias("letter"))
    # Letters are few, so each node's are a short array.
    onward = F.collect_set(F.when(F.col("letter") != "", F.col("letter")))
    return steps.groupBy("reversed", "depth", "node").agg(onward.alias("onward"), F.max(F.col("letter") == "").alias("whole"))


def _letter(at: Column) -> Column:
    return F.col("word").substr(at + 1, F.lit(1))


def _state(position: Column, node: Column, edits: int | Column, found: bool) -> Column:
    return F.struct(position.alias("position"), node.alias("node"), F.lit(edits).cast("int").alias("edits"), F.lit(found).alias("found"))


def _next(states: DataFrame, nodes: DataFrame) -> DataFrame:
    """States one level deeper, and the pairs that end here."""
    position, node, edits = F.col("position"), F.col("node"), F.col("edits")
    here, after, length = _letter(position), _letter(position + 1), F.length("word")
    none = F.array().cast("array<struct<position:int,node:string,edits:int,found:boolean>>")

    def only(condition: Column, *found: Column) -> Column:
        return F.when(condition, F.array(*found)).otherwise(none)

    greater = F.filter("onward", lambda c: c > here)
    fresh = F.concat(
        only(position < length, _state(position + 1, F.concat(node, here), 0, False)),
        F.when(position < length, F.transform(greater, lambda c: _state(position + 1, F.concat(node, c), 1, False))).otherwise(none),
        only((position + 1 < length) & (after != here) & F.array_contains("onward", after), _state(position + 2, F.concat(node, after), 1, False)),
        only((position + 1 == length) & F.col("whole"), _state(length, node, 1, True)),
    )
    going = F.concat(
        only((position < length) & F.array_contains("onward", here), _state(position + 1, F.concat(node, here), 1, False)),
        only((position == length) & F.col("whole"), _state(length, node, 1, True)),
    )
    joined = states.join(nodes, ["reversed", "node"])
    made = joined.select("reversed", "word", F.explode(F.when(edits == 0, fresh).otherwise(going)).alias("s"))
    return made.select("reversed", "word", "s.position", "s.node", "s.edits", "s.found")


def short_pairs(words: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``word`` and ``near`` of all pairs one edit apart among words of at most ``levels`` letters."""
    words = words.where(F.length("word") <= levels)
    first, last = words.agg(F.min(F.length("word")), F.max(F.length("word"))).first()
    if first is None:
        return words.select("word", F.col("word").alias("near"))
    nodes = materialize(trie_nodes(words), "trie", ["depth"])
    starts = both_ways(words).select(
        "reversed", "word", F.col("start").alias("position"), F.col("word").substr(F.lit(1), F.col("start")).alias("node"), F.lit(0).alias("edits"), F.lit(False).alias("found")
    )
    found, states = None, None
    for depth in range(first // 2, last + 1):
        beginning = starts.where(F.col("position") == depth)
        states = beginning if states is None else states.unionByName(beginning)
        made = materialize(_next(states, nodes.where(F.col("depth") == depth).drop("depth")), f"states-{depth}")
        pairs = made.where("found").select("reversed", "word", "node")
        found = pairs if found is None else found.unionByName(pairs)
        states = made.where("not found")
    turned = [F.when(F.col("reversed"), F.reverse(c)).otherwise(F.col(c)).alias(name) for c, name in (("word", "word"), ("node", "near"))]
    pairs = materialize(found.select(*turned).distinct(), "pairs")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))


def _left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of each word and of it with each letter left out."""
    base = 0x9E3779B97F4A7C15 | 1
    for batch in batches:
        for own, word in zip(batch.column("id").to_pylist(), batch.column("word"), strict=True):
            codes = np.frombuffer(word.as_py().encode("utf-32-le"), "<u4").astype(np.uint64)
            powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(codes), base, np.uint64))])
            # Letter i counts with the power i; those after a gap move down by one.
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers[: len(codes)])])
            moved = np.concatenate([np.zeros(2, np.uint64), np.cumsum(codes[1:] * powers[: len(codes) - 1])])
            out = sums[:-1] + moved[-1] - moved[1:]
            hashes = np.unique(out)
            yield pa.record_batch({"id": np.full(len(hashes) + 1, own), "letters": np.array([len(codes)] + [len(codes) - 1] * len(hashes)), "h": np.concatenate([sums[-1:], hashes]).view(np.int64)})


def long_pairs(words: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``word`` and ``near`` of all pairs one edit apart of which one has more than ``levels`` letters.

    Strings that are equal but for one place share a hash; there are no more of these than letters.
    """
    wide = words.where(F.length("word") >= levels).select("word", F.xxhash64("word").alias("id"))
    hashes = materialize(wide.select("id", "word").mapInArrow(_left_out, "id long, letters long, h long"), "left-out")
    pairs = hashes.join(hashes.withColumnRenamed("id", "other"), ["letters", "h"]).where("id <> other").select("id", "other").distinct()
    named = pairs.join(wide, "id").join(wide.select(F.col("id").alias("other"), F.col("word").alias("near")), "other")
    more = F.greatest(F.length("word"), F.length("near")) > levels
    return named.where(more & (F.levenshtein("word", "near", 1) == 1)).select("word", "near")


def neighbours(words: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``word`` and ``near`` of all pairs of ``words`` (``word``) that differ by one letter put in, left out or replaced."""
    found = short_pairs(words.select("word"), levels)
    if words.where(F.length("word") > levels).isEmpty():
        return found
    return found.unionByName(long_pairs(words.select("word"), levels))


def variants(words: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of ``words`` (``word``, ``n``), each word once."""
    words = materialize(words.select("word", "n"), "words")
    near = neighbours(words, levels).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # The most frequent first, then the first in code point order.
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= RATIO * F.col("n")
    formed = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")
    )
    formed = materialize(formed, "forms")
    roots = formed.where("form is not null").select("word", F.col("form").alias("root"))
    # Each form is RATIO times as frequent, so chains are short; each round doubles the steps taken.
    most = words.agg(F.max("n")).first()[0] or 1
    steps = int(math.log(max(most, 1), RATIO)) + 1
    for _ in range(steps.bit_length()):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = materialize(roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    out = formed.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
