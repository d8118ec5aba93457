"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only.

A source's copy rate is its target over its size; every document is taken floor(rate) times, and once more with the
fractional part as probability. Those probabilities are paired: a duel moves word mass from one document to the other,
in a random direction that keeps each one's expected probability, until one of them is 0 or 1. The other goes on to the
next duel. As mass is moved, not counts, a source's taken words never leave its target by more than the one document
that is left over.

Documents meet in blocks: about `block` of them, drawn by a hash of the id and the text within their source, so rows that
share an id, or have none, spread out by their texts, and a source with a third
of all rows is many blocks. A block leaves one undecided document; those meet in blocks again, a level with 1/block as
many rows each time, until a source has one left, which a last draw decides. All draws are hashes of the ids and the
seed, so reruns agree.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; documents of size 0 are
taken floor(rate) times and need no duel; a source whose sizes are all 0 has target 0; repeated rows are rows of
their own; an empty table gives an empty result; further columns do not matter, as only id, source and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tractloom.llm.common import settle

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BLOCK = 128
LARGE = 25
BROADCAST_SOURCES = 10_000


def n_words(text: Column) -> Column:
    """Number of maximal runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target: the whole shared by weight, no target above `most` times its source's size.

    The share a unit of weight gets, u, solves sum(least(most * size, u * weight)) = total. In order of size over
    weight the capped sources come first, so u follows from running sums over the sources; the table has one row for
    each source. Where `most` is at least 1 the total can always be placed.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # A rank over all sources needs them in one order: a table of one row each, never of documents.
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    s = by_source.withColumn("weight", F.element_at(listed, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    up = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    everything = Window.partitionBy()
    s = (
        s.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("before", F.coalesce(F.sum("source_size").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("u", (F.col("total") - most * F.col("before")) / F.col("weight_left"))
        .withColumn("free", F.col("u") * F.col("weight") <= most * F.col("source_size"))
        .withColumn("level", F.min(F.when(F.col("free"), F.struct(F.col("source_size") / F.col("weight"), "u"))).over(everything)["u"])
    )
    target = F.least((most * F.col("source_size")).cast("double"), F.coalesce(F.col("level"), F.lit(float("inf"))) * F.col("weight"))
    return s.select("source", "source_size", target.alias("target"))


def draw(*parts: Column | int) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*[F.lit(p) if isinstance(p, int) else p for p in parts]), F.lit(1 << 30)) / float(1 << 30)


def duels(members: Column, seed: int, level: int) -> Column:
    """Fold a block: an array of (size, tie, id, p) to (left, done), done holding the decided ones."""

    def duel(state: Column, new: Column) -> Column:
        left = state["left"]
        # Mass moves from one to the other; the bounds of a move are where either gets to 0 or 1.
        up = F.least((1 - left["p"]) * left["size"], new["p"] * new["size"])  # to the one left over
        down = F.least(left["p"] * left["size"], (1 - new["p"]) * new["size"])
        gains = draw(left["tie"], new["tie"], seed, level) * (up + down) < down
        move = F.when(gains, up).otherwise(-down)
        left_p, new_p = left["p"] + move / left["size"], new["p"] - move / new["size"]

        def near(p: Column) -> Column:
            return (p < 1e-9) | (p > 1 - 1e-9)

        def put(row: Column, p: Column) -> Column:
            return F.struct(row["size"].alias("size"), row["tie"].alias("tie"), row["id"].alias("id"), F.when(p < 1e-9, 0.0).when(p > 1 - 1e-9, 1.0).otherwise(p).alias("p"))

        stays, goes = put(left, left_p), put(new, new_p)
        first = F.when(left["size"].isNull(), new).when(near(left_p), goes).otherwise(stays)
        other = F.when(left["size"].isNull(), left).when(near(left_p), stays).otherwise(goes)
        return F.struct(first.alias("left"), F.concat(state["done"], F.when(other["size"].isNull(), F.array().cast(DONE)).otherwise(F.array(other))).alias("done"))

    nobody = F.lit(None).cast(ROW)
    return F.aggregate(members, F.struct(nobody.alias("left"), F.array().cast(DONE).alias("done")), duel)


ROW = "struct<size:double,tie:bigint,id:string,p:double>"
DONE = f"array<{ROW}>"


def decided(met: DataFrame) -> DataFrame:
    return met.select("source", F.explode("r.done").alias("d")).unionByName(met.where(~F.col("undecided") & F.col("r.left.size").isNotNull()).select("source", F.col("r.left").alias("d")))


def last_draw(met: DataFrame, seed: int) -> DataFrame:
    left = F.col("r.left")
    p = F.when(draw(left["tie"], seed, 99) < left["p"], 1.0).otherwise(0.0)
    return met.where("undecided").select("source", F.struct(left["size"].alias("size"), left["tie"].alias("tie"), left["id"].alias("id"), p.alias("p")).alias("d"))


def meet(rows: DataFrame, by: list, seed: int, level: int) -> DataFrame:
    """One row for each block: source, what `duels` leaves, and whether a document is undecided."""
    members = F.reverse(F.array_sort(F.collect_list(F.struct("size", "tie", "id", "p")))).cast(DONE)
    met = rows.groupBy("source", "n_open", *by).agg(members.alias("m")).select("source", "n_open", duels(F.col("m"), seed, level).alias("r"))
    return met.withColumn("undecided", F.coalesce((F.col("r.left.p") > 0) & (F.col("r.left.p") < 1), F.lit(False)))


def round_copies(rows: DataFrame, most: int, seed: int, block: int) -> DataFrame:
    """source and d (size, tie, id, p as 0 or 1) for rows (source, n_open, size, tie, id, p), 0 < p < 1 and size > 0.

    most: the rows of the largest source, which sets the number of levels.
    """
    out, level = None, 0
    while True:
        # The number of blocks follows the source's own rows, so small sources are not dealt thin.
        own = F.greatest(F.ceil(F.col("n_open") / float(block ** (level + 1))), F.lit(1))
        met = settle(meet(rows.withColumn("__block", F.pmod(F.xxhash64("tie", F.lit(seed + level)), own)), ["__block"], seed, level))
        out = decided(met) if out is None else out.unionByName(decided(met))
        most = -(-most // block)
        if most <= 1:
            return out.unionByName(last_draw(met, seed))
        rows, level = met.where("undecided").select("source", "n_open", "r.left.*"), level + 1


def mix(
    docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = WEIGHTS,
    most_copies: int = MOST_COPIES, block: int = BLOCK, seed: int = 42,
) -> DataFrame:
    """One row for each row of docs: doc_id, source, size, source_size, target, copies.

    Documents above 1/LARGE of their source, fewer than LARGE then, are decided first, and what they take more or less
    than their share changes the probability of all others; else a small source would end one such document off.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    sizes = settle(docs.select(F.col(doc_id).cast("string").alias("id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), F.xxhash64(text).alias("of_text")))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most_copies)))).otherwise(0.0)
    rates = settle(source_targets(sizes, weights, most_copies).withColumn("base", F.floor(rate + 1e-9).cast("long")).withColumn("p", F.greatest(rate - F.col("base"), F.lit(0.0))))
    few = rates.count() <= BROADCAST_SOURCES

    def attach(rows: DataFrame, by: DataFrame, how: str = "inner") -> DataFrame:
        by = by.withColumnRenamed("source", "__source")
        return rows.join(F.broadcast(by) if few else by, F.col("source").eqNullSafe(F.col("__source")), how).drop("__source")

    def ready(rows: DataFrame) -> DataFrame:
        return rows.select("source", "n_open", F.col("size").cast("double").alias("size"), F.xxhash64("id", "of_text", F.lit(seed)).alias("tie"), "id", "p")

    planned = attach(sizes, rates).withColumn("large", F.col("size") * LARGE > F.col("source_size"))
    is_open = (F.col("p") > 1e-9) & (F.col("p") < 1 - 1e-9) & (F.col("size") > 0)
    first = meet(ready(planned.where(is_open & F.col("large")).withColumn("n_open", F.lit(1))), [], seed, -1)
    first = settle(decided(first).unionByName(last_draw(first, seed)))
    taken = first.groupBy("source").agg(F.sum(F.col("d.size") * F.col("d.p")).alias("taken"))
    mass = planned.where(is_open).groupBy("source").agg(
        F.sum("size").alias("mass"), F.sum(F.when(~F.col("large"), F.col("size"))).alias("rest"), F.count(F.when(~F.col("large"), 1)).alias("n_open")
    )
    rest = attach(attach(rates, mass), taken, "left").select(
        "source", "n_open", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("p") * F.col("mass") - F.coalesce("taken", F.lit(0.0))) / F.col("rest"))).alias("p_rest")
    )
    rest = settle(rest.where("n_open > 0"))
    small = attach(planned.where(is_open & ~F.col("large")), rest)
    sure = (F.col("p_rest") <= 1e-9) | (F.col("p_rest") >= 1 - 1e-9)
    plain = planned.where(~is_open).select("id", "source", "size", F.when(F.col("p") > 0.5, 1).otherwise(0).alias("extra"))
    plain = plain.unionByName(small.where(sure).select("id", "source", "size", F.round("p_rest").cast("int").alias("extra")))
    done = first
    most = rest.where(~sure).agg(F.max("n_open")).first()[0]
    if most:
        done = done.unionByName(round_copies(ready(small.where(~sure).withColumn("p", F.col("p_rest"))), most, seed, block))
    made = plain.unionByName(done.select("d.id", "source", F.col("d.size").cast("long").alias("size"), F.col("d.p").cast("int").alias("extra")))
    made = attach(made, rates.select("source", "source_size", "target", "base"))
    return made.select(F.col("id").cast(id_type).alias("doc_id"), "source", "size", "source_size", "target", (F.col("base") + F.col("extra")).alias("copies"))
