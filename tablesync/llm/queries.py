"""The numbered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.llm import (
    bpe_codec,
    conversation_trie,
    html_text,
    inner_product,
    jaccard_join,
    language_kernel,
    line_crf,
    mixing,
    quality_rules,
    repeated_bytes,
    spelling_variants,
    surrogates,
    token_counts,
)
from tablesync.llm.common import col, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Texts with more tokens than this are over the limit.
TOKEN_LIMIT = 4096

#: Scores from here on are predicted good.
GOOD = 0.7

#: Key of the surrogates in these queries; a real run passes one of its own.
PII_SECRET = "change me"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    pieces = token_counts.PieceTable.load(public_tokenizers.path("piece_bpe_32k.model"))
    counted = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        token_counts.token_count(spark, F.col("text"), pieces).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", html_text.extract(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    sizes = mixing.sizes_of(table(spark, sf_dir, "documents"))
    sources, cuts = mixing.cut_points(sizes)
    return mixing.take(sizes, sources, cuts).select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the text decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_codec.corpus_codec(docs, public_tokenizers.path("word_bpe_49k.json"))
    coded_docs = docs.select("doc_id", coded.alias("coded"))
    return coded_docs.select(
        "doc_id",
        (F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("coded.decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query
def op5_inner_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every fiftieth vector with all others."""
    vectors = inner_product.whole_vectors(table(spark, sf_dir, "embeddings"))
    return inner_product.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


ORACLES["op5_inner_product"] = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([a[1] * a[2] FOR a IN list_zip(q.v, c.v)])::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in place of personal data and secrets."""
    docs = table(spark, sf_dir, "documents")
    return surrogates.pseudonymize(docs, PII_SECRET, count="n_entities")


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    judged, holder = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *(col(holder)[n].alias(n) for n in names))


@query
def op8_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; one in four of the labels, by a checksum of the id, is never trained on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = line_crf.train_on(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), line_crf.quality_score(docs, F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


@query
def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the strings that occur before."""
    left = repeated_bytes.without_repeats(table(spark, sf_dir, "documents"))
    removed = (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed")
    return left.select("doc_id", "n_bytes", removed, "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by their five-word shingles."""
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


def _quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_STOP = quality_rules.STOP_WORDS + [w.capitalize() for w in quality_rules.STOP_WORDS]
ORACLES["op7_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)
), cov AS (
  SELECT doc_id, count(DISTINCT j) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1)
  GROUP BY doc_id
), s AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda x: x IN ({_quoted(_STOP)}))) AS n_stop, len(lines) AS n_lines,
         length(regexp_replace(body, '[^\p{{Lu}}]+', '', 'g')) AS n_caps
  FROM d LEFT JOIN cov USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND 1000 * n_symbols <= 20 * word_chars
         AND 10 * word_chars BETWEEN 20 * n_words AND 150 * n_words
         AND 1000 * n_stop >= 30 * n_words
         AND 100 * n_dup_lines <= 40 * n_lines
         AND 100 * n_caps <= 40 * word_chars AS kept
FROM s"""


@query
def op11_language_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; one in three, by a checksum of the id, is never learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = language_kernel.train_on(docs.where(remainder != 1))
    answered = docs.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), language_kernel.language(spark, F.col("text"), model).alias("a"))
    return answered.select("doc_id", "held_out", F.col("a.lang").alias("lang_pred"), F.col("a.score").alias("score"))


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their neighbours and forms."""
    counts = spelling_variants.word_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return spelling_variants.variants(counts)


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text of code points below 2048, bit by bit. Fixed value: the polynomial 0xEDB88320."""
    codes = f"flatten([CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [192 + (ord(x) >> 6), 128 + (ord(x) & 63)] END FOR x IN string_split({text}, '')])"
    eight = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {eight}), 4294967295)"


ORACLES["op12_conversation_trie"] = f"""
WITH t AS (
  SELECT conv_id::BIGINT AS conv_id, strlen(coalesce(text, '')) AS bytes, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS part, pos, bytes, k FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, pos, bytes, k FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h
), p AS (
  SELECT conv_id, row_number() OVER w AS d, bytes, string_agg(k, '') OVER w AS key FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), g AS (
  SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM p GROUP BY key, d
), kids AS (
  SELECT left(key, 32 * (d - 1)) AS key, count(*) AS n FROM g WHERE d > 0 GROUP BY 1
), sub AS (
  SELECT left(g.key, 32 * i) AS key, sum((kids.n IS NULL)::BIGINT) AS leaves, sum((n_convs - 1) * bytes) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS i FROM g) AS g LEFT JOIN kids ON kids.key = g.key GROUP BY 1
), e AS (
  SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, arg_max(key, d) AS key FROM p GROUP BY conv_id) GROUP BY key
)
SELECT g.conv_id, g.d::BIGINT AS depth, up.conv_id AS parent_conv_id, g.n_convs::BIGINT AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
       sub.leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM g JOIN sub ON sub.key = g.key LEFT JOIN kids ON kids.key = g.key LEFT JOIN e ON e.key = g.key
LEFT JOIN g AS up ON up.key = left(g.key, 32 * (g.d - 1)) AND g.d > 0"""

ORACLES["op13_spelling_variants"] = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')) AS run FROM documents
), hashed AS (
  SELECT run, k, {_crc32("id || ':' || run")} AS h
  FROM (SELECT id, run, count(*) AS k FROM (SELECT id, translate(run, '{spelling_variants.UPPER}', '{spelling_variants.LOWER}') AS run FROM runs) GROUP BY id, run)
), w AS (
  SELECT word, sum(k)::BIGINT AS n
  FROM (SELECT k, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), cut AS (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)
), near AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT w.word, cut.word FROM w JOIN cut ON cut.rest = w.word
  UNION SELECT cut.word, w.word FROM w JOIN cut ON cut.rest = w.word
), best AS (
  SELECT near.word, count(*) AS n_near, arg_min(struct_pack(form := near, form_n := v.n), struct_pack(a := -v.n, b := near)) AS best
  FROM near JOIN w AS v ON v.word = near.near GROUP BY near.word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.form_n >= 10 * w.n THEN best.form END AS form,
         CASE WHEN best.form_n >= 10 * w.n THEN best.form_n END AS form_n
  FROM w LEFT JOIN best ON best.word = w.word
), steps AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT steps.word, formed.form FROM steps JOIN formed ON formed.word = steps.root WHERE formed.form IS NOT NULL
)
SELECT formed.word, formed.form, steps.root, formed.n, formed.n_near::BIGINT AS n_near, formed.form_n
FROM formed JOIN steps ON steps.word = formed.word JOIN formed AS last ON last.word = steps.root AND last.form IS NULL"""
