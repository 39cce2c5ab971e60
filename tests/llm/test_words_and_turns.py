"""Languages, conversation tries and spelling variants against brute force, on small inputs with every odd row."""

import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest

from tablesync.llm import conversation_trie, language_kernel, queries, spelling_variants

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


# Conversations


def brute_trie(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0, role, digest), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in turns.items()}
    full = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = tuple(own.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + x[h:])
    members = collections.defaultdict(list)
    for c, s in full.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = set()
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if full[c] == p)))
        up = min(members[p[:-1]]) if p else None
        out.add((min(m), len(p), up, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


SCHEMA = "conv_id long, turn long, role string, text string, ids string, `odd.name` double"


def conversations(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 4 * n), n):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 12])):
            rows.append((c, turn, rng.choice(["user", "bot", None]), rng.choice(["a", "é", "long text", "", None])))
    rows += [(c, t, "user", "the same") for c in range(1000, 1030) for t in range(10)]  # a hot conversation
    rows += [(2000, t, "user", f"deep {t}") for t in range(300)]
    rows += [(7, None, "user", "without a number"), (7, None, None, "another"), (8, 1, "user", "twice"), (8, 1, "user", "twice"), (None, 1, "user", "nobody's")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "turns", "most"), [(1, 200_000, 50_000), (1, 25, 7), (2, 1, 1)])
def test_trie(spark, seed, turns, most):
    rows = conversations(seed)
    found = conversation_trie.trie(spark.createDataFrame([(*r, "x", 1.0) for r in rows], SCHEMA), turns, most)
    got = [tuple(r) for r in found.collect()]
    wanted = brute_trie(rows)
    assert len(got) == len(set(got)) == len(wanted) and set(got) == wanted


def test_trie_without_border_broadcast(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BROADCAST_NODES", 0)
    rows = conversations(3, 20)
    found = conversation_trie.trie(spark.createDataFrame([(*r, "x", 1.0) for r in rows], SCHEMA), 10, 4)
    assert {tuple(r) for r in found.collect()} == brute_trie(rows)


def test_trie_of_no_conversations(spark):
    assert conversation_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert conversation_trie.trie(spark.createDataFrame([(None, 1, "user", "x", "y", 1.0)], SCHEMA)).count() == 0


def test_trees_are_balanced():
    assert sorted(conversation_trie.medians(100)) == list(range(100)) and next(conversation_trie.medians(100)) == 50
    tree = conversation_trie.TernaryTree()
    for i in conversation_trie.medians(1000):
        tree.insert([i], [1])
    deepest = {}
    for node in range(1, 1001):
        for child in (tree.lower[node], tree.higher[node]):
            deepest[child] = deepest.get(node, 0) + 1
    assert max(v for k, v in deepest.items() if k >= 0) < 10


# Words


def brute_counts(rows):
    found = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(spelling_variants.UPPER, spelling_variants.LOWER))
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in found.items() if n >= 2 and len(w) >= 7}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    x = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), len(a))
    return a[x + 1 :] == b[x + 1 :] if len(a) == len(b) else a[x:] == b[x + 1 :]


def brute_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def misspelt(rng, word):
    at = rng.randrange(len(word) + 1)
    letter = rng.choice("abéz")
    return rng.choice([word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :], word[:at] + word[at + 1 :]])


def vocabulary(seed, longest):
    rng = random.Random(seed)
    found = {"aaaaaaa": 500, "aaaaaaaa": 5, "aaaaaaaaa": 50, "abababab": 3, "babababa": 3, "ababababa": 30}
    for _ in range(12):
        word = "".join(rng.choice("abcdeéß") for _ in range(min(longest, rng.choice([7, 7, 8, 9, 12, 30, 40]))))
        found[word] = rng.choice([2000, 300, 20])
        for _ in range(6):
            other = misspelt(rng, word)
            if len(other) >= 7:
                found[other] = rng.choice([2, 3, 15, 150])
                again = misspelt(rng, other)
                if len(again) >= 7:
                    found[again] = 2
    return found


@pytest.mark.parametrize(("seed", "levels", "longest"), [(1, 64, 13), (2, 9, 40)])
def test_variants(spark, seed, levels, longest):
    counts = vocabulary(seed, longest)
    found = spelling_variants.variants(spark.createDataFrame([(w, n, 1.0) for w, n in counts.items()], "word string, n long, near double"), levels)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(counts) and set(got) == brute_variants(counts)


def test_word_counts(spark):
    rng = random.Random(4)
    words = ["Wandering", "wandering", "ÉCLATANTE", "short", "x" * 3000, "über-größere", "naïvement2naïvement", "Straßenbahn"]
    rows = [(i % 40 if i % 9 else None, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 30])))) for i in range(80)] + [(5, None), (5, "")]
    docs = spark.createDataFrame([(*r, "x", 2.0) for r in rows], "doc_id long, text string, word string, n double")
    assert {r.word: r.n for r in spelling_variants.word_counts(docs).collect()} == brute_counts(rows)


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "one two")], "doc_id long, text string")
    for rows in (docs, docs.where("false")):
        assert spelling_variants.variants(spelling_variants.word_counts(rows)).collect() == []


# Languages


def texts(seed, n=60):
    rng = random.Random(seed)
    parts = {"aa": ["the", "tion", "ing", "er", "and "], "bb": ["sch", "ung", "ei", "ück", "der "], "cc": ["ção", "ão", "lh", "que ", "os "]}
    return [(i, "".join(rng.choice(parts[lang]) for _ in range(rng.choice([20, 200]))), lang) for i, lang in enumerate(rng.choice(list(parts)) for _ in range(n))]


def test_languages(spark):
    learnt = texts(1) + [(900, None, "aa"), (901, "!!", "bb"), (902, "the thing", None)]
    schema = "doc_id long, text string, lang string, score double"
    model = language_kernel.train_on(spark.createDataFrame([(*r, 1.0) for r in learnt], schema))
    odd = [(800, None, None), (801, "", None), (802, "123 ... 4", None), (803, "漢字仮名", None), (804, "the er " * 300_000, "aa")]
    asked = spark.createDataFrame([(*r, 1.0) for r in texts(2) + odd], schema)
    got = {r.doc_id: r for r in asked.select("doc_id", "lang", language_kernel.language(spark, asked.text, model).alias("a")).collect()}
    for row in got.values():
        assert 0 <= row.a.score <= 1
        assert row.a.lang == row.lang if row.lang else row.a.lang in ("und", "aa", "bb", "cc")
    assert [got[i].a.lang for i in (800, 801, 802)] == ["und"] * 3
    assert got[803].a.lang == model.usual and got[803].a.score == 0


def test_languages_without_labels(spark):
    schema = "doc_id long, text string, lang string"
    model = language_kernel.train_on(spark.createDataFrame([(1, "some text", None)], schema))
    asked = spark.createDataFrame([(1, "some text", None)], schema)
    assert asked.select(language_kernel.language(spark, asked.text, model).alias("a")).first().a.lang == "und"
    assert asked.where("false").select(language_kernel.language(spark, asked.text, model).alias("a")).count() == 0


def spectrum(text):
    letters = re.sub(" +", " ", " " + "".join(c.lower() if c.isalpha() else " " for c in text) + " ")
    return {letters[i : i + n] for n in language_kernel.ORDERS for i in range(len(letters) - n + 1)}


def test_kernel_by_brute_force(monkeypatch):
    monkeypatch.setattr(language_kernel, "PIECE", 50)
    marks = [t for _, t, _ in texts(5, 8)]
    asked = [t for _, t, _ in texts(6, 8)] + ["A b  C,,d", "x" * 120]
    model = language_kernel.landmark_model(marks, ["aa"], "aa")
    known = set().union(*map(spectrum, marks))
    for got, x in zip(np.concatenate([k for k, _, _ in model.kernels(asked)]), asked, strict=True):
        a = spectrum(x) & known
        assert np.allclose(got, [len(a & spectrum(m)) / (max(1, len(a)) * len(spectrum(m))) ** 0.5 for m in marks], atol=1e-5)


@needs_tables
def test_held_out_languages(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = [r for r in queries.QUERIES["op11_language_kernel"](spark, SF).collect() if r.held_out]
    assert len(found) > 20 and np.mean([truth[r.doc_id] == r.lang_pred for r in found]) > 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
