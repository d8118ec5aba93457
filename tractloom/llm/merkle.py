"""A Merkle manifest of a dataset: every row a leaf, a tree for each source, a tree over the sources, a proof for each row.

Nodes are labelled by nested intervals: the ranks of the leaves they cover, lo to hi, within their tree. A node of level k
that covers the rank r lies in bucket r div fan^k, so a parent and its children meet in an equi-join on tree and bucket,
checked by containment of their intervals. Downwards, from the roots to the leaves, each level takes over its parent's
ancestors: the siblings of a node are the intervals of its parent that are not its own. A level has a third of the rows of
the one below, so all joins together move one and a half times the leaves, and no group has more than `fan` rows.

Digests are lowercase hex of sha256 over the concatenated inputs; a leaf's inputs are its fields in order, `-` for null, else the
number of UTF-8 bytes, a colon and the value. In a tree the leaves ascend by id; while there are several nodes,
every `fan` consecutive ones, and the fewer ones left at the end, become the digest of theirs. A source with one row has
its leaf as subroot. Sources ascend too, null first, bytewise.

Defined cases: null ids come first in their source; rows of one source that share an id are ordered by leaf, and equal leaves by
nothing, which changes no node and leaves each copy one of the copies' proofs; no siblings have the digest of nothing; an empty table
gives an empty result; fields that docs lacks raise; further columns come along only if named in `keep`, which may
not name a column that is made here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractloom.llm.common import settle
from tractloom.llm.ordering import placed

FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BROADCAST_SOURCES = 100_000


def digest(said: Column) -> Column:
    return F.sha2(said.cast("binary"), 256)


def field_text(value: Column) -> Column:
    """`-`, or byte count, colon and value, which no other value can be read as."""
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return digest(F.concat(*[field_text(v) for v in values]))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf leads to by a proof: an array, from below to above, of the digests left and right of its own."""
    return F.aggregate(proof, leaf, lambda own, step: digest(F.concat(step["left"], own, step["right"])))


def proof_digest(proof: Column) -> Column:
    return digest(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""))


NODE = ["tree", "n", "lo", "hi", "digest"]


def grow(leaves: DataFrame, largest: int, fan: int) -> list[DataFrame]:
    """The levels of all trees from the leaves (tree, n leaves, lo = hi, digest) up; upper nodes also have `kids`, their
    children's intervals and digests. Level k holds the trees of more than fan^(k-1) leaves; those of at most fan^k have
    their root there."""
    levels, k = [leaves], 0
    while fan**k < largest:
        open_ = levels[-1].where(F.col("n") > fan**k)
        bucket = F.expr(f"lo div {fan ** (k + 1)}L")
        met = open_.groupBy("tree", "n", bucket.alias("bucket")).agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
        joined = digest(F.array_join(F.transform("kids", lambda c: c["digest"]), ""))
        levels.append(settle(met.select("tree", "n", F.element_at("kids", 1)["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"), joined.alias("digest"), "kids")))
        k += 1
    return levels


def roots(levels: list[DataFrame], fan: int) -> DataFrame:
    """tree and the digest of its root."""
    found = None
    for k, level in enumerate(levels):
        top = level.where(F.col("n") <= fan**k).select("tree", "digest")
        found = top if found is None else found.unionByName(top)
    return found


def ancestors(levels: list[DataFrame], above: DataFrame | None, few: bool, fan: int) -> DataFrame:
    """The leaves with `proof`. above: tree and the proof that goes on from its root, none for the last tree."""
    nothing = F.array().cast("array<struct<left:string,right:string>>")

    def topped(rows: DataFrame) -> DataFrame:
        if above is None:
            return rows.withColumn("proof", nothing)
        return rows.join(F.broadcast(above) if few else above, "tree")

    done = None
    for k in range(len(levels) - 1, -1, -1):
        own = levels[k].drop("kids") if k == 0 else levels[k]
        found = topped(own.where(F.col("n") <= fan**k))
        if done is not None:
            span = fan ** (k + 1)
            parent = done.select("tree", F.expr(f"lo div {span}L").alias("bucket"), F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), F.col("kids").alias("__kids"), F.col("proof").alias("__proof"))
            inside = own.where(F.col("n") > fan**k).withColumn("bucket", F.expr(f"lo div {span}L")).join(parent, ["tree", "bucket"])
            inside = inside.where((F.col("__lo") <= F.col("lo")) & (F.col("hi") <= F.col("__hi")))

            def side(of) -> Column:
                return F.array_join(F.transform(F.filter("__kids", of), lambda c: c["digest"]), "")

            step = F.struct(side(lambda c: c["hi"] < F.col("lo")).alias("left"), side(lambda c: c["lo"] > F.col("hi")).alias("right"))
            inside = inside.withColumn("proof", F.concat(F.array(step), F.col("__proof")))
            found = found.unionByName(inside.select(*found.columns))
        done = settle(found) if k else found
    return done


def manifest(
    docs: DataFrame, *, fields: tuple[str, ...] = FIELDS, doc_id: str = "doc_id", source: str = "source", fan: int = FAN, keep: tuple[str, ...] = (),
) -> DataFrame:
    """A row for each row of docs: doc_id, source, leaf_rank, leaf, subroot, root, proof and the columns of `keep`.

    proof is an array, from the leaf's level up through its subroot to the root, of the digests left and right of the
    row's own node in its run; `fold` leads from a leaf by its proof to the root.
    """
    if fan < 2:
        raise ValueError("a node has two children at least")
    if clash := {"doc_id", "source", "leaf_rank", "leaf", "subroot", "root", "proof"} & set(keep):
        raise ValueError(f"keep names columns that are made here: {sorted(clash)}")
    kept = [F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), leaf_digest([F.col(f) for f in fields]).alias("digest"), *kept)
    order = settle(placed(rows, ["source", "doc_id", "digest"], rank="__rank"))
    sizes = order.groupBy("source").agg(F.min("__rank").alias("__first"), F.count("*").alias("n"))
    trees = settle(placed(sizes, ["source"], rank="tree"))
    count, largest = trees.agg(F.count("*"), F.max("n")).first()
    if not count:
        return order.select("doc_id", "source", F.col("__rank").alias("leaf_rank"), F.col("digest").alias("leaf"), *[F.lit(None).cast(t).alias(c) for c, t in (("subroot", "string"), ("root", "string"), ("proof", "array<struct<left:string,right:string>>"))], *[F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)])
    few = count <= BROADCAST_SOURCES
    named = trees.withColumnRenamed("source", "__source")
    leaves = order.join(F.broadcast(named) if few else named, F.col("source").eqNullSafe(F.col("__source"))).withColumn("lo", F.col("__rank") - F.col("__first"))
    leaves = settle(leaves.select("tree", "n", "lo", F.col("lo").alias("hi"), "digest", "doc_id", "source", *[f"__keep{i}" for i in range(len(keep))]))
    levels = grow(leaves, largest, fan)
    subroots = settle(roots(levels, fan))
    tops = grow(subroots.select(F.lit(0).cast("bigint").alias("tree"), F.lit(count).cast("bigint").alias("n"), F.col("tree").alias("lo"), F.col("tree").alias("hi"), "digest"), count, fan)
    root = roots(tops, fan).first()["digest"]
    above = ancestors(tops, None, few, fan).select(F.col("lo").alias("tree"), F.col("digest").alias("subroot"), "proof")
    above = settle(above)
    proven = ancestors(levels, above.select("tree", "proof"), few, fan)
    out = proven.join(F.broadcast(above.select("tree", "subroot")) if few else above.select("tree", "subroot"), "tree")
    return out.select("doc_id", "source", F.col("lo").alias("leaf_rank"), F.col("digest").alias("leaf"), "subroot", F.lit(root).alias("root"), "proof", *[F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)])
