"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets share the wanted words over sources by weight, capped by what each source
can give. Words come in equal blocks; the highest quotients (target over 1, 3, 5, ...)
give each source its number of blocks, and then each shard of a source its quota.
Inside a shard the documents stand in a seeded order, and its blocks are taken from
the start of that order, all of them again before any a third time.

Quotients are never listed: every party starts at its rounded share, and only the few
seats near that boundary compete for what rounding left over. A shard holds a bounded
number of words, so a source of any size spreads over many tasks. What selection
needs is one cut point for each shard; documents are matched with it, not sorted whole.

Defined results: a null text has size 0 and takes 0 words. A null source is a source of
its own and comes last. Rows that agree in id, source and size share evenly what falls
to them. An empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablesync.llm.common import GAP, WORD, col, fresh, materialize

#: Words in a block.
BLOCK_WORDS = 32

#: Words in a shard, about; each document also counts for a few, so that empty ones spread too.
SHARD_WORDS = 1 << 22
DOCUMENT_WORDS = 64


@dataclass(frozen=True)
class Mix:
    """``weights`` go round the sources in order of their names; ``share`` is the wanted part of all words, ``most`` the most uses of a word."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: int = 2
    block: int = BLOCK_WORDS
    seed: int = 20


def words_in(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(totals: DataFrame, mix: Mix) -> DataFrame:
    """Adds ``target`` to a table of one row for each ``source`` with its ``source_size``.

    Sources are filled in order of what they can hold for their weight. Those before the
    first that can hold its share are full; the rest divide what is left by weight.
    """
    names, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    number = F.row_number().over(names)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in mix.weights)), (number - 1) % len(mix.weights) + 1)
    held = totals.withColumn("weight", weight).withColumn("held", F.col("source_size") * float(mix.most))
    held = held.withColumn("wanted", F.sum("source_size").over(everything) * mix.share)
    order = Window.orderBy(F.col("held") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = held.withColumn("level", (F.col("wanted") - before) / rest)
    full = F.col("held") <= F.col("level") * F.col("weight")
    level = level.withColumn("full", full).withColumn("n", F.row_number().over(order))
    first_open = F.min(F.when(~F.col("full"), F.struct("n", "level"))).over(everything)["level"]
    return level.select("source", "source_size", "documents", F.when(F.col("full"), F.col("held")).otherwise(first_open * F.col("weight")).alias("target"))


def sainte_lague(parties: DataFrame, votes: str, seats: str, within: list[str], order: list[Column]) -> DataFrame:
    """Adds ``won``: the seats of each party by highest quotients, ties by ``order``; ``seats`` is the number to win in each group ``within``."""
    group = Window.partitionBy(*(col(c) for c in within))
    p = parties.withColumn("_all", F.sum(votes).over(group)).withColumn("_n", F.count(F.lit(1)).over(group))
    share = F.when(F.col("_all") > 0, col(votes) * col(seats) / F.col("_all")).otherwise(0.0)
    p = p.withColumn("_share", share).withColumn("_base", F.floor(F.col("_share") + 0.5).cast("long"))
    p = p.withColumn("_left", F.when(F.col("_all") > 0, col(seats) - F.sum("_base").over(group)).otherwise(0))
    # Rounding leaves at most half a seat for each party; this many candidates cover it wherever the boundary falls.
    near = F.ceil(F.col("_share") * 1.5 * F.col("_n") / F.greatest(col(seats), F.lit(1))) + 1
    many = F.when(F.col("_left") > 0, near).when(F.col("_left") < 0, F.least(near, F.col("_base"))).otherwise(0)
    steps = F.when(many > 0, F.sequence(F.lit(0).cast("long"), many - 1)).otherwise(F.array().cast("array<bigint>"))
    p = p.withColumn("_step", F.explode_outer(steps))
    seat = F.when(F.col("_left") > 0, F.col("_base") + F.col("_step")).otherwise(F.col("_base") - 1 - F.col("_step"))
    quotient = col(votes) / (2 * seat + 1)
    signed = F.when(F.col("_left") > 0, -quotient).otherwise(quotient)  # gained from the highest down, given up from the lowest up
    best = Window.partitionBy(*(col(c) for c in within)).orderBy(F.col("_step").isNull(), signed, *order)
    p = p.withColumn("_hit", (F.col("_step").isNotNull() & (F.row_number().over(best) <= F.abs(F.col("_left")))).cast("long"))
    kept = parties.columns
    out = p.groupBy(*(col(c) for c in kept), "_base", "_left").agg(F.sum("_hit").alias("_hits"))
    return out.select(*(col(c) for c in kept), (F.col("_base") + F.signum("_left").cast("long") * F.col("_hits")).alias("won"))


def _keyed(sizes: DataFrame, sources: DataFrame, mix: Mix) -> DataFrame:
    """Adds what the source has, the shard, and the place in the shard's order."""
    s = sources.withColumnRenamed("source", "_source")
    out = sizes.join(s, sizes["source"].eqNullSafe(s["_source"])).drop("_source")
    deal = F.pmod(F.xxhash64(F.lit(mix.seed), "doc_id", "size"), F.col("shards"))
    return out.withColumn("shard", deal).withColumn("place", F.xxhash64(F.lit(mix.seed + 1), "doc_id", "size"))


def cut_points(sizes: DataFrame, mix: Mix = Mix()) -> tuple[DataFrame, DataFrame]:
    """The sources with their targets, and for each shard how often it is taken whole and where its last blocks end.

    ``sizes`` has ``doc_id``, ``source`` and ``size``.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    sources = targets(totals, mix)
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / mix.block).cast("long")
    sources = sainte_lague(sources.withColumn("seats", blocks), "target", "seats", [], [F.col("source").asc_nulls_last()])
    load = F.col("source_size") + F.col("documents") * DOCUMENT_WORDS
    sources = materialize(sources.select("source", "source_size", "target", F.col("won").alias("blocks"), F.ceil(load / SHARD_WORDS).alias("shards")), "mix-sources")
    # One row for each kind of equal rows, already where its shard is.
    keyed = _keyed(sizes, sources, mix).repartition("source", "shard")
    rows = keyed.groupBy("source", "shard", "blocks", "place", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))
    shard = Window.partitionBy("source", "shard")
    upto = F.sum(F.col("size") * F.col("copies")).over(shard.orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("upto", upto)
    rows = materialize(rows, "mix-order")
    shards = rows.groupBy("source", "shard", "blocks").agg(F.max("upto").alias("words"))
    shards = sainte_lague(shards, "words", "blocks", ["source"], [F.col("shard")])
    n = F.ceil(F.col("words") / mix.block)
    won = F.least("won", n * mix.most)
    passes = F.when(n > 0, F.floor(won / n)).otherwise(0)
    shards = shards.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), passes.alias("passes"), F.least("words", (won - passes * n) * mix.block).alias("part"))
    # The rows whose words hold the last one of the part; a shard without a part has none.
    whole = F.col("size") * F.col("copies")
    holds = (F.col("upto") >= F.col("part")) & (F.col("upto") - whole < F.col("part"))
    last = rows.join(shards, rows["source"].eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")) & holds, "right")
    end = F.when(F.col("place").isNotNull(), F.struct("place", "doc_id", "size"))
    share = F.floor((F.col("part") - F.col("upto") + whole) / F.col("copies"))
    return sources, materialize(last.select("_source", "_shard", "passes", end.alias("end"), share.alias("share")), "mix-cuts")


def take(sized: DataFrame, sources: DataFrame, cuts: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``taken`` to rows with ``doc_id``, ``source`` and ``size``."""
    keyed = _keyed(sized, sources, mix)
    both = keyed.join(cuts, keyed["source"].eqNullSafe(cuts["_source"]) & (keyed["shard"] == cuts["_shard"]))
    own = F.struct("place", "doc_id", "size")
    extra = F.when(own < F.col("end"), F.col("size")).when(own == F.col("end"), F.col("share")).otherwise(0)
    taken = F.col("passes") * F.col("size") + extra
    return both.select(*(col(x) for x in sized.columns), "source_size", "target", taken.cast("long").alias("taken"))


def sizes_of(df: DataFrame) -> DataFrame:
    """``doc_id``, ``source`` and ``size`` of documents, as a working table: later steps don't read the texts again."""
    return materialize(df.select("doc_id", "source", words_in(F.col("text")).alias("size")), "mix-sizes")


def mixed_documents(df: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself, with the columns of ``df``: each document as often as the mix takes it whole, and the first words of the few that are cut.

    ``df`` has ``doc_id``, ``source``, ``text`` and, if it counts them, ``n_chars``.
    """
    sources, cuts = cut_points(sizes_of(df), mix)
    row, text = fresh(df, "_row"), fresh(df, "_copy")
    sized = df.select(F.struct(*(col(c) for c in df.columns)).alias(row), "doc_id", "source", words_in(F.col("text")).alias("size"))
    taken = take(sized, sources, cuts, mix).where("taken > 0")
    body = col(row)["text"]
    words = F.filter(F.split(body, GAP), lambda w: w != "")
    part = F.col("taken") % F.col("size")
    cut = F.when(part > 0, F.array(F.array_join(F.slice(words, F.lit(1), F.greatest(part, F.lit(1)).cast("int")), " "))).otherwise(F.array().cast("array<string>"))
    copies = F.concat(F.array_repeat(body, F.floor(F.col("taken") / F.col("size")).cast("int")), cut)
    out = taken.select(row, F.explode(copies).alias(text))
    changed = {"text": col(text), "n_chars": F.length(col(text)).cast(dict(df.dtypes).get("n_chars", "long"))}
    return out.select(*(changed[c].alias(c) if c in changed else col(row)[c].alias(c) for c in df.columns))
