"""BPE encoding and decoding with a lexicon of frequent words.

The frequent words of the corpus, counted over all documents, are merged once and
compiled into a minimal acyclic transducer: equal suffixes share their states, and
the outputs along a word's path add up to its number, which leads to its ids.
Workers memory-map it and walk it for all new words of a batch together. Words that
it lacks are merged exactly, so the lexicon decides speed and never the result.

Defined results: null and empty texts have no ids and decode to an empty text. The
strings of added tokens inside texts become those tokens. Texts are never cut.
Rows are independent, so ties, repeated rows and extra columns need no care.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import struct
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablesync.llm.common import col, materialize

#: Words in the lexicon, at most; this bounds its file and what the driver gathers.
LEXICON_WORDS = 100_000

#: Words that a worker remembers beside the lexicon; beyond it the memory starts anew.
REMEMBERED = 400_000

#: Texts whose new words walk the lexicon together.
CHUNK = 64

END = "</w>"

#: Words of up to so many bytes are merged without a heap.
SHORT_WORD = 48
NO_RANK = 1 << 62


def byte_symbols() -> list[str]:
    """The printable symbol that stands for each byte: itself if it is printable, else the next free one from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


BYTES = byte_symbols()
BYTE_OF = {symbol: b for b, symbol in enumerate(BYTES)}


@dataclass(frozen=True)
class WordBpe:
    """A vocabulary of words with ends: lower case, white space dropped."""

    vocab: dict[str, int]
    ranks: dict[tuple[str, str], int]
    added: dict[str, int]
    pattern: str
    outer: dict

    @classmethod
    def load(cls, path: str) -> WordBpe:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        pattern = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        added = {t["content"]: t["id"] for t in data["added_tokens"]}
        return cls(model["vocab"], {tuple(pair): n for n, pair in enumerate(model["merges"])}, added, pattern, {k: v for k, v in data.items() if k != "model"})

    def tokens(self) -> list[str]:
        """The token of each id."""
        out = [""] * (max(*self.vocab.values(), *self.added.values()) + 1)
        for token, number in [*self.vocab.items(), *self.added.items()]:
            out[number] = token
        return out

    def merge(self, word: str) -> list[int]:
        """The ids of one word: the adjacent pair of lowest rank, leftmost first, merged until none is left.

        Short words keep the rank of each pair in a list and renew the two beside a merge; long ones take the heap.
        """
        parts = [BYTES[b] for b in word.encode()]
        if len(parts) > SHORT_WORD:
            return self.merge_long(parts)
        parts[-1] += END
        rank = self.ranks.get
        ranks = [rank(pair, NO_RANK) for pair in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == NO_RANK:
                break
            at = ranks.index(best)
            merged = parts[at] = parts[at] + parts.pop(at + 1)
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank((merged, parts[at + 1]), NO_RANK)
            if at:
                ranks[at - 1] = rank((parts[at - 1], merged), NO_RANK)
        vocab = self.vocab
        return [vocab[p] for p in parts]

    def merge_long(self, parts: list[str | None]) -> list[int]:
        """The ids of one word from its byte symbols: a heap over a linked list of symbols gives the adjacent pair of lowest rank, leftmost first."""
        parts[-1] += END
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        rank = self.ranks.get
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue  # one of the two has been merged since
            merged = parts[i] = left + right
            parts[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank((merged, parts[k]))) is not None:
                    heapq.heappush(heap, (r, i, merged, parts[k]))
            h = before[i]
            if h >= 0 and (r := rank((parts[h], merged))) is not None:
                heapq.heappush(heap, (r, h, parts[h], merged))
        return [self.vocab[p] for p in parts if p is not None]

    def surface(self) -> str:
        """The vocabulary's own normalizer and splitter, without its words."""
        return json.dumps(self.outer | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []})


#: Characters on which this library's and Python's tables of letters surely agree; other texts go through the vocabulary's own splitter.
COMMON = regex.compile("[\x00-\u024f\u0370-\u0373\u0386-\u03ff\u0400-\u0482\u048a-\u052f\u2010-\u2027\u20ac]*")


class Splitter:
    """Words of a text: composed, in lower case, cut by the vocabulary's pattern; added tokens stand apart."""

    def __init__(self, bpe: WordBpe):
        self.words = regex.compile(bpe.pattern).findall
        self.added, self.surface, self.own = bpe.added, bpe.surface(), None
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in bpe.added) + ")").split if bpe.added else None

    def plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.words(text.lower())
        if COMMON.fullmatch(text):
            # Letters are lowered one by one, so a sigma at the end of a word is like any other.
            return self.words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        if self.own is None:
            from tokenizers import Tokenizer

            self.own = Tokenizer.from_str(self.surface)
        pieces = self.own.pre_tokenizer.pre_tokenize_str(self.own.normalizer.normalize_str(text))
        return [bytes(map(BYTE_OF.__getitem__, piece)).decode() for piece, _ in pieces]

    def __call__(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.cut is None:
            return self.plain(text)
        out: list[str] = []
        for part in self.cut(text):
            out += [part] if part in self.added else self.plain(part)
        return out


def minimal_automaton(words: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Edges of the smallest acyclic automaton of sorted distinct words.

    Gives the sorted keys ``256 * state + byte``, the target and the output of each edge, and the
    start state; final states are marked by the lowest bit of a target. The outputs on a word's
    path, and 1 for each final state passed before its end, add up to its number.
    """
    register: dict[tuple, int] = {}
    counts: list[int] = []  # words that start at each state
    finished: list[tuple] = []

    def settle(final: bool, edges: list[tuple[int, int]]) -> int:
        key = (final, tuple(edges))
        if key not in register:
            register[key] = len(finished)
            finished.append(key)
            counts.append(final + sum(counts[t] for _, t in edges))
        return register[key]

    path: list[tuple[bool, list[tuple[int, int]], int]] = [(False, [], -1)]  # final, settled edges, byte of the edge still open
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, edges, _ = path.pop()
            state = settle(final, edges)
            above_final, above, byte = path[-1]
            path[-1] = (above_final, [*above, (byte, state)], -1)

    for word in words:
        common = os.path.commonprefix([last, word])
        close(len(common))
        for byte in word[len(common) :]:
            final, edges, _ = path[-1]
            path[-1] = (final, edges, byte)
            path.append((False, [], -1))
        path[-1] = (True, path[-1][1], -1)
        last = word
    close(0)
    start = settle(path[0][0], path[0][1])
    keys, targets, outputs = [], [], []
    for state, (final, edges) in enumerate(finished):
        before = int(final)
        for byte, target in edges:
            keys.append(256 * state + byte)
            targets.append(2 * target + finished[target][0])
            outputs.append(before)
            before += counts[target]
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return np.array(keys, np.int64)[order], np.array(targets, np.int64)[order], np.array(outputs, np.int64)[order], start


class Lexicon:
    """The transducer in a memory-mapped file: a header of sizes, then edge keys, targets, outputs, places of ids, ids."""

    @staticmethod
    def compile(ids_of: dict[bytes, list[int]]) -> bytes:
        words = sorted(ids_of)
        keys, targets, outputs, start = minimal_automaton(words)
        places = np.cumsum([0] + [len(ids_of[w]) for w in words]).astype(np.int64)
        ids = np.array([i for w in words for i in ids_of[w]], np.int64)
        sizes = np.array([len(keys), len(places), len(ids), start], np.int64)
        return b"".join(part.tobytes() for part in (sizes, keys, targets, outputs, places, ids))

    def __init__(self, compiled: bytes):
        with tempfile.TemporaryFile() as file:  # has no name, so it goes with its last user
            file.write(compiled)
            file.flush()
            data = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), np.int64)
        edges, places, ids, self.start = (int(x) for x in data[:4])
        cuts = np.cumsum([4, edges, edges, edges, places, ids])
        self.keys, self.targets, self.outputs, self.places, self.ids = (data[a:b] for a, b in zip(cuts, cuts[1:], strict=False))

    def find(self, words: list[bytes]) -> list[np.ndarray | None]:
        """The ids of each word, or none: all words walk one edge at a time together."""
        if not words or not len(self.keys):
            return [None] * len(words)
        sizes = np.array([len(w) for w in words])
        letters = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(sizes) - sizes
        state = np.full(len(words), self.start, np.int64)
        number, final = np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        alive = np.flatnonzero(sizes > 0)
        lost = sizes == 0
        step = 0
        while len(alive):
            key = 256 * state[alive] + letters[first[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            lost[alive[~hit]] = True
            alive, at = alive[hit], at[hit]
            number[alive] += self.outputs[at]
            state[alive], final[alive] = self.targets[at] >> 1, (self.targets[at] & 1).astype(bool)
            step += 1
            alive = alive[sizes[alive] > step]
        return [self.ids[self.places[n] : self.places[n + 1]] if ok else None for n, ok in zip(number.tolist(), (final & ~lost).tolist(), strict=True)]


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    """Ids and decoded tokens of words, for one worker."""

    def __init__(self, bpe: WordBpe, lexicon: Lexicon | None):
        self.bpe, self.lexicon, self.split = bpe, lexicon, Splitter(bpe)
        self.tokens = np.array(bpe.tokens(), object)
        self.known: dict[str, bytes] = {t: pack([i]) for t, i in bpe.added.items()}

    def learn(self, words: set[str]) -> None:
        """Makes the ids of these words known."""
        if len(self.known) > REMEMBERED:
            self.known = {t: self.known[t] for t in self.bpe.added}
        new = [w for w in words if w not in self.known]
        found = self.lexicon.find([w.encode() for w in new]) if self.lexicon else [None] * len(new)
        for word, ids in zip(new, found, strict=True):
            self.known[word] = pack(self.bpe.merge(word)) if ids is None else ids.astype("<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out = []
        for at in range(0, len(texts), CHUNK):
            split = [self.split(text) for text in texts[at : at + CHUNK]]
            self.learn(set().union(*split))
            out += [b"".join(map(self.known.__getitem__, words)) for words in split]
        return out

    def decode(self, packed: list[bytes]) -> list[str]:
        """The tokens of packed ids, joined as the vocabulary's own library joins them: by one blank."""
        return [" ".join(self.tokens[np.frombuffer(p, "<u4")]) for p in packed]


#: The codec of a worker, by the broadcast it came with.
_CODECS: dict[int, Codec] = {}


def frequent_words(df: DataFrame, bpe: WordBpe, text: str = "text", limit: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words of all texts: as many whole counts as fit in ``limit``. Words are counted in their task before they are shuffled."""
    shared = df.sparkSession.sparkContext.broadcast(bpe)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter(shared.value)
        counts: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0):
                counts.update(split(value.as_py()))
            if len(counts) > REMEMBERED:
                yield pa.record_batch({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})
                counts.clear()
        yield pa.record_batch({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})

    words = df.select(col(text).cast("string")).mapInArrow(counted, "word string, n long")
    words = materialize(words.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1 and length(word) <= 64"), "words")
    # How many words have each count is a short table; it tells the least count whose words all fit.
    times = words.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    fits = times.withColumn("upto", F.sum("words").over(Window.orderBy(F.desc("n")))).where(F.col("upto") <= limit)
    least = fits.agg(F.min("n")).first()[0]
    return [] if least is None else [row.word for row in words.where(F.col("n") >= least).select("word").collect()]


def compile_lexicon(bpe: WordBpe, words: list[str]) -> bytes:
    return Lexicon.compile({w.encode(): bpe.merge(w) for w in words if w not in bpe.added})


def codec_column(spark: SparkSession, text: Column, bpe: WordBpe, lexicon: bytes | None) -> Column:
    """A struct of ``ids``, packed as little-endian unsigned 32-bit integers, and ``decoded``, the text decoded from those ids.

    The lexicon is broadcast: its size is bounded by its number of words, not by the corpus.
    """
    shared = spark.sparkContext.broadcast((bpe, lexicon))
    key = shared._jbroadcast.id()

    @F.arrow_udf("struct<ids: binary, decoded: string>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if key not in _CODECS:
            _CODECS.clear()
            vocabulary, compiled = shared.value
            _CODECS[key] = Codec(vocabulary, Lexicon(compiled) if compiled else None)
        codec = _CODECS[key]
        for batch in batches:
            ids = codec.encode(batch.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(codec.decode(ids), pa.string())], ["ids", "decoded"])

    return coded(text)


def corpus_codec(df: DataFrame, path: str, text: str = "text", lexicon_words: int = LEXICON_WORDS) -> Column:
    """The codec column of ``df``'s text, with a lexicon of its own frequent words."""
    bpe = WordBpe.load(path)
    lexicon = compile_lexicon(bpe, frequent_words(df, bpe, text, lexicon_words))
    return codec_column(df.sparkSession, col(text).cast("string"), bpe, lexicon)
