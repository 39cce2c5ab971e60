"""Surrogates for personal data and secrets, in built-in expressions only.

One pattern finds the entities of a text. Each gets a replacement drawn from a keyed
digest of its kind and its value: digits stay digits, letters stay letters of their case
and script, punctuation and prefixes stay, card numbers keep their check digit, given
names keep their gender. As the value alone decides, all mentions of an entity agree,
in one document and across documents, and the parts of a name agree one by one.

Two values could draw the same surrogate, or one that is itself a real value. All
distinct values of the corpus are checked for that, by shuffles of values alone; those
that lose draw again until every value has a surrogate of its own: later draws are longer
with each round, so that the space grows until all fit, and a secret without letters or
digits is drawn from both. Only these few
carry a number of the draw: as a literal map while they are few, else by a join.

Defined results: null texts stay null, empty ones empty, texts without entities are
returned unchanged. Rows are independent, repeated rows get equal texts. An empty table
gives an empty result. Extra columns pass through; working columns never clash.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tablesync.llm.common import col, fresh, materialize

#: From this draw on surrogates grow with each draw: words and secrets soon, numbers only if their format has no room.
GROWS = 2
GROWS_NUMBER = 12

#: Values that drew again are held as a literal map up to this number.
LITERAL_DRAWS = 500

#: Titles by gender, and given names by gender, in the scripts supported.
TITLES_M = ["Mr", "Herr", "Monsieur", "Señor", "Don", "Господин"]
TITLES_F = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Doña", "Госпожа"]
TITLES_ANY = ["Dr", "Prof", "Доктор"]
GIVEN_M = (
    "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Peter Paul Mark George Edward Hans Karl Jürgen Klaus Stefan "
    "Wolfgang Pierre Jean Jacques Michel Philippe François Carlos José Juan Luis Miguel Pedro Antonio Иван Пётр Сергей Дмитрий Алексей"
).split()
GIVEN_F = (
    "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Emily Laura Alice Anna Maria Ursula Monika Petra Sabine "
    "Claudia Marie Nathalie Isabelle Sophie Camille Carmen Ana Lucía Isabel Pilar Sofía Elena Анна Мария Ольга Елена Наталья"
).split()

#: Syllables of invented names, by script, and their endings by gender; families take any syllable.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke la le li lo ma me mi mo na ne no ra re ri ro sa se ta te vi".split(),
    "cyrillic": "ба бе бо да де до фа фе га го ка ке ла ле ли ло ма ме ми мо на не но ра ре ри ро са се та те ви".split(),
}
ENDINGS = {
    "latin": {"given_m": "n r s l".split(), "given_f": "na ra sa la".split(), "family": "nd rk lm rt".split()},
    "cyrillic": {"given_m": "н р с л".split(), "given_f": "на ра са ла".split(), "family": "нд рк лм рт".split()},
}

LOWER, UPPER, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "abcdef"
LOWER_CYRILLIC, UPPER_CYRILLIC = "абвгдежзиклмнопрстуфхцчшщыэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЫЭЮЯ"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: A name, and all further ones with initials and particles among them; possessive, so that no number of names needs a deep stack.
PARTICLES = ["de", "del", "della", "di", "da", "dos", "la", "le", "van", "von", "der", "den", "zu"]
_NAME = r"(?:Mc|Mac|[ODL]['\u2019])?\p{Lu}\p{Ll}++(?:-\p{Lu}\p{Ll}++)?(?!\p{L})"
_FIRST = r"(?:\p{Lu}\.(?: |(?=\p{Lu})))*+"
_FURTHER = rf"(?: (?:\p{{Lu}}\. ?)*+(?:(?:{'|'.join(PARTICLES)}) ){{0,3}}{_NAME})"
_SECRET_NAMES = r"(?:password|passwd|pwd|token|secret|api[_-]?key|apikey|access[_-]?key|auth)"

#: The kinds in the order in which they are tried where a token starts.
PATTERNS = {
    # A whole run before the @ at any length, where the run starts; inside a run, at most what a mailbox name may have. Domains have at most 127 labels.
    "email": r"(?:(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++|[A-Za-z0-9._%+-]{1,64}+)@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){0,125}\.[A-Za-z]{2,}",
    "ip": rf"{_OCTET}(?:\.{_OCTET}){{3}}(?![\d])(?!\.\d)",
    "key": r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])",
    "secret": rf"(?i:{_SECRET_NAMES})[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?[^\s\"',;]{{6,}}+",
    "phone": r"(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)|\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"[3-6]\d{3}(?:([ -]?)\d{4}\1\d{4}\1\d{1,7}|[ -]?\d{6}[ -]?\d{5})(?!\d)",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": rf"(?=\p{{Lu}})(?:(?:{'|'.join(TITLES_M + TITLES_F + TITLES_ANY)})\.? {_FIRST}(?:(?:{'|'.join(PARTICLES)}) ){{0,3}}{_NAME}{_FURTHER}*+|(?:{'|'.join(GIVEN_M + GIVEN_F)}){_FURTHER}{_FURTHER}*+)(?!\p{{L}})",
}
#: Group references inside one alternative stay right as only the card pattern has a group.
ENTITY = r"(?<![\p{L}\p{N}])(?:" + "|".join(PATTERNS.values()) + ")"
_KINDS = {k: "^(?:" + p + ")$" for k, p in PATTERNS.items()}
_BEFORE_SECRET = rf"^(?i:{_SECRET_NAMES})[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?"

UNIT = "struct<kind: string, value: string>"


def matches(text: Column) -> Column:
    """What looks like an entity in a text, in order; most texts have nothing of the kind and are searched once."""
    return F.when(F.rlike(text, F.lit(ENTITY)), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))


def kind_of(m: Column) -> Column:
    out = None
    for kind, pattern in _KINDS.items():
        hit = F.rlike(m, F.lit(pattern))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out


def _names(parts: Column, unit: Callable[[Column, Column], Column]) -> Column:
    """The units of each part of a person's name."""
    title = F.regexp_replace(F.get(parts, F.lit(0)), r"\.$", "")
    titled = title.isin(TITLES_M + TITLES_F + TITLES_ANY)
    stays = lambda x: x.rlike(r"^\p{Lu}\.$") | x.isin(PARTICLES)
    given = F.ltrim(F.get(F.filter(parts, lambda x, i: ~((titled & (i == 0)) | stays(F.ltrim(x)))), F.lit(0)))
    male = F.when(title.isin(TITLES_M), True).when(title.isin(TITLES_F), False).otherwise(given.isin(GIVEN_M))
    whole = F.struct(titled.alias("titled"), F.when(male, "given_m").otherwise("given_f").alias("person"), F.size(parts).alias("n"))

    def part(of: Column, x: Column, i: Column) -> Column:
        word = F.ltrim(x)
        kind = (
            F.when((of["titled"] & (i == 0)) | stays(word), F.lit(None))
            .when(i == of["n"] - 1, "family")
            .when(word.isin(GIVEN_M), "given_m")
            .when(word.isin(GIVEN_F), "given_f")
            .otherwise(of["person"])
        )
        return F.array(unit(F.lit(None), F.when(x.startswith(" "), " ").otherwise("")), unit(kind, word))

    return F.get(F.transform(F.array(whole), lambda of: F.transform(parts, lambda x, i: part(of, x, i))), F.lit(0))


def units(m: Column) -> Column:
    """The parts of a match. What stays has no kind: titles, names of secrets, digits that are no card number.

    A person's name gives one unit for each name, however many, with the gender that the name itself, the
    title or the first given name tell; the last is the family's. Titles, initials and particles stay.
    """
    kind = kind_of(m)
    unit = lambda k, v: F.struct(k.cast("string").alias("kind"), v.alias("value"))
    stays = lambda v: unit(F.lit(None), v)
    # A part keeps the space before it, which initials that follow each other at once don't have.
    parts = F.regexp_extract_all(m, F.lit(r" ?(?:\p{Lu}\.|[^ ]+)"), F.lit(0))
    # Bound by a loop variable, so that the parts are found once, not once for each part.
    names = F.get(F.transform(F.array(parts), lambda found: F.flatten(_names(found, unit))), F.lit(0))
    prefix = F.regexp_extract(m, _BEFORE_SECRET, 0)
    secret = F.substring(m, F.length(prefix) + 1, F.length(m))
    secret_kind = F.when(F.rlike(secret, F.lit("^[0-9a-f]+$")), "hexkey").otherwise("secret")
    return (
        F.when(kind == "name", names)
        .when(kind == "secret", F.array(stays(prefix), unit(secret_kind, secret)))
        .when((kind == "card") & (_luhn(m) != 0), F.array(stays(m)))
        .otherwise(F.array(unit(kind, m)))
        .cast(f"array<{UNIT}>")
    )


def _norm(kind: Column, value: Column) -> Column:
    """What makes two mentions the same entity."""
    return F.when(kind == "email", F.lower(value)).when(kind.isin("phone", "card", "iban"), F.regexp_replace(value, r"[ .()-]", "")).otherwise(value)


def _pick(alphabet: str, v: Column) -> Column:
    return F.substring(F.lit(alphabet), v % len(alphabet) + 1, F.lit(1))


def _choose(words: list[str], v: Column) -> Column:
    return F.element_at(F.array(*(F.lit(w) for w in words)), v % len(words) + 1)


def _byte(digest: Column, i: Column) -> Column:
    """Byte ``i`` of a digest in hexadecimal, going round; from the second round on it is moved by the round."""
    return F.conv(F.substring(digest, 2 * F.pmod(i, F.lit(64)) + 1, F.lit(2)), 16, 10).cast("int") + F.floor(i / 64).cast("int")


def _spread(value: Column, kind: Column, digest: Column) -> Column:
    """Each letter and digit of ``value`` replaced within its class; what the kind fixes stays."""
    fixed = (
        F.when(kind == "phone", F.length(F.regexp_extract(value, r"^\+\d{1,3}", 0)) * F.rlike(value, F.lit(r"^\+\d{1,3}[ .(-]")).cast("int"))
        .when(kind == "key", 4).when(kind == "iban", 2).when(kind == "card", 1).otherwise(0)
    )

    def one(c: Column, at: Column) -> Column:
        i = at + 1
        # Marks between digits don't count, so that mentions in other formats agree. Secrets and addresses, of any length, have one format.
        place = F.when(kind.isin("secret", "hexkey", "email"), i).otherwise(F.length(F.regexp_replace(F.substring(value, F.lit(1), i), r"[ .()-]", "")))
        v = _byte(digest, place)
        start = (kind == "phone") & ~F.rlike(F.substring(value, i - 1, F.lit(1)), F.lit(r"\d"))
        return (
            F.when(i <= fixed, c)
            .when(F.rlike(c, F.lit(r"\d")), F.when(start & (i > 1), _pick("23456789", v)).otherwise(_pick(DIGITS, v)))
            .when((kind == "hexkey") & F.rlike(c, F.lit("[a-f]")), _pick(HEX, v))
            .when(F.rlike(c, F.lit(r"[\p{Lu}&&\p{IsCyrillic}]")), _pick(UPPER_CYRILLIC, v))
            .when(F.rlike(c, F.lit(r"[\p{Ll}&&\p{IsCyrillic}]")), _pick(LOWER_CYRILLIC, v))
            .when(F.rlike(c, F.lit(r"\p{Lu}")), _pick(UPPER, v))
            .when(F.rlike(c, F.lit(r"\p{L}")), _pick(LOWER, v))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn(number: Column, last: int | None = None) -> Column:
    """The Luhn sum of a card number modulo 10, which is 0 if it is valid; ``last`` stands for the last digit."""
    digits = F.regexp_replace(number, r"[^\d]", "")
    n = F.length(digits)
    doubled = lambda d: F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)
    digit = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    ending = digit(n) if last is None else F.lit(last)
    return F.aggregate(F.sequence(F.lit(1), n - 1), ending, lambda a, i: a + F.when((n - i) % 2 == 1, doubled(digit(i))).otherwise(digit(i))) % 10


def _with_check_digit(number: Column) -> Column:
    """The last digit set so that the Luhn sum is a multiple of 10."""
    return F.concat(F.substring(number, F.lit(1), F.length(number) - 1), F.pmod(10 - _luhn(number, 0), F.lit(10)).cast("string"))


def surrogate(kind: Column, value: Column, draw: Column, secret: str) -> Column:
    """The replacement of one unit for the given number of its draw."""
    seed = F.concat_ws("\x1f", F.lit(secret), kind, _norm(kind, value), draw.cast("string"))
    digest = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("+")), 256))
    bound = F.struct(digest.alias("digest"), draw.cast("int").alias("draw"))
    # Bound by a loop variable, as the digest of a value is not to be made again for each of its characters.
    return F.get(F.transform(F.array(bound), lambda b: _surrogate(kind, value, b["digest"], b["draw"])), F.lit(0))


def _grown(digest: Column, n: Column, one: Callable[[Column], Column]) -> Column:
    """``n`` further pieces, each made from a byte of a digest of its own; none if ``n`` is not positive."""
    piece = lambda i: one(F.conv(F.substring(F.sha2(F.concat(digest, i.cast("string")), 256), 1, 2), 16, 10).cast("int"))
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), piece), "")).otherwise("")


def _surrogate(kind: Column, value: Column, digest: Column, draw: Column) -> Column:
    words, numbers = draw - (GROWS - 1), draw - (GROWS_NUMBER - 1)
    byte = lambda i: _byte(digest, F.lit(i))
    local = _spread(F.substring_index(F.lower(value), "@", 1), kind, digest)
    label = F.when(words > 0, F.concat(_grown(digest, words, lambda v: _choose(SYLLABLES["latin"], v)), F.lit("."))).otherwise("")
    mail = F.concat(local, F.lit("@"), label, _choose(["example.com", "example.net", "example.org"], byte(63)))
    # Addresses of four numbers can't be longer; those of the longer kind for documentation have 6 bytes to draw.
    hextet = lambda v: F.concat(F.lit(":"), F.lower(F.hex(v)))
    four = F.concat_ws(".", (byte(0) % 223 + 1).cast("string"), *(byte(i).cast("string") for i in (1, 2, 3)))
    address = F.when(numbers > 0, F.concat(F.lit("2001:db8"), _grown(digest, F.lit(6), hextet))).otherwise(four)
    cyrillic = F.rlike(value, F.lit(r"\p{IsCyrillic}"))

    def invented(script: str) -> Column:
        ends = F.when(kind == "given_m", _choose(ENDINGS[script]["given_m"], byte(4))).when(kind == "given_f", _choose(ENDINGS[script]["given_f"], byte(4)))
        more = _grown(digest, words, lambda v: _choose(SYLLABLES[script], v))
        return F.initcap(F.concat(*(_choose(SYLLABLES[script], byte(i)) for i in (0, 1, 2)), more, ends.otherwise(_choose(ENDINGS[script]["family"], byte(4)))))

    name = F.when(cyrillic, invented("cyrillic")).otherwise(invented("latin"))
    letter = lambda v: _pick(LOWER + DIGITS, v)
    blank = ~F.rlike(value, F.lit(r"[\d\p{L}]"))
    longer = (
        F.when(kind == "hexkey", _grown(digest, words, lambda v: _pick(HEX + DIGITS, v)))
        .when(kind == "secret", _grown(digest, words, letter))
        .when(kind == "key", _grown(digest, numbers, lambda v: _pick(UPPER + DIGITS, v)))
        .otherwise(_grown(digest, numbers, lambda v: _pick(DIGITS, v)))
    )
    kept = F.when((kind == "secret") & blank, _grown(digest, F.length(value), letter)).otherwise(_spread(value, kind, digest))
    spread = F.concat(kept, longer)
    return (
        F.when(kind.isNull(), value)
        .when(kind == "email", mail)
        .when(kind == "ip", address)
        .when(kind == "card", _with_check_digit(spread))
        .when(kind.isin("given_m", "given_f", "family"), name)
        .otherwise(spread)
    )


def entity_values(df: DataFrame, text: str = "text") -> DataFrame:
    """The distinct values of the corpus: ``kind``, ``norm`` and one ``value`` for each, reduced before they are shuffled."""
    found = df.select(F.explode(matches(col(text))).alias("m")).select(F.explode(units(F.col("m"))).alias("u")).where("u.kind is not null")
    return found.select("u.kind", _norm(F.col("u.kind"), F.col("u.value")).alias("norm"), "u.value").groupBy("kind", "norm").agg(F.min("value").alias("value"))


def redrawn(values: DataFrame, secret: str) -> DataFrame:
    """``kind``, ``norm`` and ``draw`` of the values whose first draw does not count.

    In each round those without a surrogate draw. A draw counts if no value drew it
    before, no smaller value drew it in this round, and it is no real value.
    """
    values = materialize(values, "entities")
    spark = values.sparkSession
    real = values.select("kind", F.col("norm").alias("drawn"))
    pending, settled, late = values, None, None
    for draw in itertools.count():
        made = surrogate(F.col("kind"), F.col("value"), F.lit(draw), secret)
        tried = pending.withColumn("drawn", _norm(F.col("kind"), made))
        first = tried.groupBy("kind", "drawn").agg(F.min("norm").alias("norm")).join(real, ["kind", "drawn"], "left_anti")
        if settled is not None:
            first = first.join(settled, ["kind", "drawn"], "left_anti")
        first = materialize(first, "surrogates")
        done = first.select("kind", "drawn")
        settled = done if settled is None else settled.unionByName(done)
        if draw:
            own = first.select("kind", "norm", F.lit(draw).alias("draw"))
            late = own if late is None else late.unionByName(own)
        pending = materialize(pending.join(first.select("kind", "norm"), ["kind", "norm"], "left_anti"), "undecided")
        if pending.isEmpty():
            return late if late is not None else spark.createDataFrame([], "kind string, norm string, draw int")


def _search(df: DataFrame, text: str) -> tuple[DataFrame, str, str]:
    """``df`` with a column of the units of each match and one of the gaps between matches, both null if there are none; and their names."""
    found, gaps = fresh(df, "_found"), fresh(df, "_gaps")
    out = df.withColumn(found, matches(col(text)))
    out = out.withColumn(gaps, F.when(col(found).isNotNull(), F.split(col(text), ENTITY, -1))).withColumn(found, F.transform(col(found), units))
    return out, found, gaps


def pseudonymize(df: DataFrame, secret: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``df`` with surrogates in its text; ``count`` names a further column for the number of entities."""
    late = redrawn(entity_values(df, text), secret)
    few = late.limit(LITERAL_DRAWS + 1).collect()
    spread, found, gaps = _search(df, text)
    key = lambda u: F.concat_ws("\x1f", u["kind"], _norm(u["kind"], u["value"]))
    if len(few) <= LITERAL_DRAWS:
        pairs = [x for row in few for x in (F.lit(f"{row.kind}\x1f{row.norm}"), F.lit(row.draw))]
        draws = F.create_map(*pairs) if pairs else None
        draw = lambda u: F.coalesce(draws[key(u)], F.lit(0)) if pairs else F.lit(0)
    else:
        # The draws that a document needs come to it by its row number, which the written table fixes.
        row, draws_name = fresh(df, "_row"), fresh(df, "_draws")
        spread = materialize(spread.withColumn(row, F.monotonically_increasing_id()), "entity-rows")
        asked = spread.select(row, F.explode(F.flatten(col(found))).alias("u")).where("u.kind is not null")
        asked = asked.select(row, "u.kind", _norm(F.col("u.kind"), F.col("u.value")).alias("norm")).distinct().join(late, ["kind", "norm"])
        per_row = asked.groupBy(row).agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "kind", "norm"), "draw"))).alias(draws_name))
        spread = spread.join(per_row, row, "left")
        draw = lambda u: F.coalesce(F.try_element_at(col(draws_name), key(u)), F.lit(0))
    made = lambda u: surrogate(u["kind"], u["value"], draw(u), secret)
    pieces = F.transform(col(found), lambda us, i: F.concat(F.get(col(gaps), i), F.array_join(F.transform(us, made), "")))
    changed = F.when(col(found).isNull(), col(text)).otherwise(F.concat(F.array_join(pieces, ""), F.get(col(gaps), F.size(col(found)))))
    kept = [changed.alias(c) if c == text else col(c) for c in df.columns]
    # A person counts once, whatever the number of names.
    real = F.size(F.filter(col(found), lambda us: F.exists(us, lambda u: u["kind"].isNotNull())))
    return spread.select(*kept, *([F.when(col(found).isNull(), 0).otherwise(real).cast("long").alias(count)] if count else []))
