"""Quality rules: a table of thresholds compiled into one projection.

Text statistics are built-in expressions on arrays inside each row, so a document
of any length costs no shuffle, and no two documents meet in a task.

Defined results: a null or empty text has no words, so all counts are 0 and it is
rejected. Repeated rows are judged each for itself. An empty table gives an empty
result. Extra columns pass through ``apply_rules``; working columns never clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tablesync.llm.common import GAP, SPACES, col, fresh

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: Very common words of the supported languages.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on not he this are or from at an which a "
    "de la le et les des en un du une que est pour qui dans par sur au pas avec "
    "der die und den von zu das mit sich ist im dem nicht ein eine als auch auf für es "
    "el los se del las con una su al lo como más pero sus"
).split()


@dataclass(frozen=True)
class Rule:
    """``scale * statistic`` must lie between ``least * over`` and ``most * over``; a missing bound always holds.

    Ratios are compared as products of whole numbers, so no rounding decides.
    """

    name: str
    statistic: str
    over: str | None = None
    scale: int = 1
    least: int | None = None
    most: int | None = None

    def holds(self, statistics: dict[str, Column]) -> Column:
        value = statistics[self.statistic] * self.scale
        unit = statistics[self.over] if self.over else F.lit(1)
        parts = [value >= unit * self.least] if self.least is not None else []
        parts += [value <= unit * self.most] if self.most is not None else []
        out = F.lit(True)
        for part in parts:
            out = out & part
        return out


#: What every document must satisfy at least.
BASE = (
    Rule("enough words", "n_words", least=50),
    Rule("few repeated words", "n_repeat_words", over="n_words", scale=100, most=50),
)

#: The verdict beyond the base rules, in per mille or per cent of the statistic named in ``over``.
RULES = (
    Rule("few symbols", "n_symbols", over="word_chars", scale=1000, most=20),
    Rule("word length", "word_chars", over="n_words", scale=10, least=20, most=150),
    Rule("stop words", "n_stop_words", over="n_words", scale=1000, least=30),
    Rule("few repeated lines", "n_dup_lines", over="n_lines", scale=100, most=40),
    Rule("few shouted letters", "n_capitals", over="word_chars", scale=100, most=40),
)

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines", "n_capitals")


#: Bits of a packed window that hold its place; the rest hold its hash. A string of 2 GB has fewer words than this.
PLACE_BITS = 28


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once. A column would be put in place of its name, even inside loops, where a filter is pushed down."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(w: Column) -> Column:
    """Words in windows of three that occur again among the words ``w``.

    Each window becomes one long, its hash above its place, and the longs are sorted.
    Only windows that share a hash with a neighbour are compared as text; those found
    equal are repeated, and the words they cover are counted once each.
    """
    at = lambda i: (F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    pack = lambda i: F.shiftleft(F.xxhash64(*at(i)), PLACE_BITS).bitwiseOR(i.cast("long"))
    hash_of = lambda x: F.shiftright(x, PLACE_BITS)
    place = F.lit((1 << PLACE_BITS) - 1).cast("long")
    none = F.array().cast("array<int>")

    def likely(p: Column) -> Column:
        beside = lambda x, k: (hash_of(F.get(p, k - 1)) == hash_of(x)) | (hash_of(F.get(p, k + 1)) == hash_of(x))
        return F.transform(F.filter(p, beside), lambda x: x.bitwiseAND(place).cast("int"))

    def equal(t: Column) -> Column:
        kept = F.filter(t, lambda x, k: (F.get(t, k - 1)["g"] == x["g"]) | (F.get(t, k + 1)["g"] == x["g"]))
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    def covered(s: Column) -> Column:
        return F.aggregate(F.transform(s, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(s, k + 1) - i, F.lit(3)))), F.lit(0), lambda a, x: a + x)

    starts = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(none)
    tagged = lambda c: F.sort_array(F.transform(c, lambda i: F.struct(F.concat_ws(" ", *at(i)).alias("g"), i.alias("i"))))
    count = lambda c: F.when(F.size(c) == 0, 0).otherwise(_let(_let(tagged(c), equal), covered))
    return _let(_let(F.sort_array(F.transform(starts, pack)), likely), count)


def text_statistics(df: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``df`` with one struct column of statistics, and that column's name."""
    body = F.coalesce(col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.length(F.ltrim(x, F.lit(SPACES))) > 0)
    long = lambda **counts: F.struct(*(c.cast("long").alias(n) for n, c in counts.items()))
    of_words = lambda w: long(
        n_words=F.size(w),
        word_chars=F.length(F.array_join(w, "")),
        n_repeat_words=_repeat_words(w),
        n_stop_words=F.size(F.filter(w, lambda x: x.isin(STOP_WORDS + [x.capitalize() for x in STOP_WORDS]))),
    )
    of_lines = lambda x: long(n_dup_lines=F.size(x) - F.size(F.array_distinct(x)), n_lines=F.size(x))
    of_text = long(
        n_symbols=F.regexp_count(body, F.lit("[" + SYMBOLS.replace("&", "\\&") + "]")),
        n_capitals=F.length(F.regexp_replace(body, r"[^\p{Lu}]+", "")),
    )
    holder = fresh(df, "_stats")
    parts = F.struct(_let(words, of_words).alias("w"), _let(lines, of_lines).alias("l"), of_text.alias("t"))
    where = {n: part for part, names in (("w", ("n_words", "word_chars", "n_repeat_words", "n_stop_words")), ("l", ("n_dup_lines", "n_lines")), ("t", ("n_symbols", "n_capitals"))) for n in names}
    return df.withColumn(holder, _let(parts, lambda x: F.struct(*(x[where[n]][n].alias(n) for n in STATISTICS)))), holder


def verdict(statistics: dict[str, Column], rules: tuple[Rule, ...]) -> Column:
    out = F.lit(True)
    for rule in rules:
        out = out & rule.holds(statistics)
    return out


def judge(df: DataFrame, text: str = "text", base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """``df`` with one struct column: all statistics, ``base_failed`` and ``kept``; and that column's name."""
    out, holder = text_statistics(df, text)

    def judged(x: Column) -> Column:
        parts = {n: x[n] for n in STATISTICS}
        failed = ~verdict(parts, base)
        return F.struct(*(c.alias(n) for n, c in parts.items()), failed.alias("base_failed"), (~failed & verdict(parts, rules)).alias("kept"))

    return out.withColumn(holder, _let(col(holder), judged)), holder


def apply_rules(df: DataFrame, text: str = "text", base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text passes all rules, columns unchanged."""
    out, holder = judge(df, text, base, rules)
    return out.where(col(holder)["kept"]).select(*(col(c) for c in df.columns))
