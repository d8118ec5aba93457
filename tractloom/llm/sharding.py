"""Shards along a Hilbert curve over several metadata columns, so that a filter on any of them skips most shards.

Each dimension is quantised into 2^bits bins of about equal numbers of rows; the bins of a row are a cell of a grid, and
the curve visits all cells so that neighbours on it are neighbours in the grid. Rows are ordered by their cell's place on
the curve, equal texts of a cell next to each other, and the order is cut into runs, one a shard. A shard then spans a
narrow range of every dimension, which `zone_map` states and `shards_for` uses.

Laws of the cut: `rows`, counts differ by one at most; `bytes`, every shard starts at the first row whose preceding bytes
reach its share of all bytes, so sizes differ by one document at most on either side.

Defined cases: a null dimension has the lowest bin; a null text has no bytes, size 8 and the crc32 of nothing, 0; rows
equal in curve place, text and id may be told apart by nothing, so which of them comes first is open, but what is said of
them as a group is the same in every run; fewer rows than shards leave shards empty; an empty table gives an empty
result; further columns come along only if named in `keep`, which may not name a column that is made here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tractloom.llm.ordering import placed

SHARDS = 24
BITS = 8
ROW_OVERHEAD = 8
STEPS = 32  # number bins per doubling of a numeric dimension before they are joined into bins of equal rows
BROADCAST_VALUES = 100_000
LAWS = ("rows", "bytes")


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells (rows x dimensions, values below 2^bits).

    The published way by transposed coordinates (J. Skilling, 2004): from the coarsest bit to the finest, what is left of
    the coordinates is reflected or its axes swapped, as the curve is turned within each orthant; a Gray code follows.
    """
    x = cells.astype(np.uint64).copy()
    dims = x.shape[1]
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        low = np.uint64((1 << level) - 1)
        for axis in range(dims):
            upper = (x[:, axis] >> np.uint64(level)) & one == one
            x[upper, 0] ^= low
            swapped = np.where(upper, np.uint64(0), (x[:, 0] ^ x[:, axis]) & low)
            x[:, 0] ^= swapped
            x[:, axis] ^= swapped
    for axis in range(1, dims):
        x[:, axis] ^= x[:, axis - 1]
    flips = np.zeros(len(x), np.uint64)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where((x[:, -1] >> np.uint64(level)) & one == one, np.uint64((1 << level) - 1), np.uint64(0))
    x ^= flips[:, None]
    place = np.zeros(len(x), np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in range(dims):
            place = (place << one) | ((x[:, axis] >> np.uint64(level)) & one)
    return place.astype(np.int64)


def curve_place(bins: list[Column], bits: int) -> Column:
    @F.arrow_udf("bigint")
    def of(*columns: pa.Array) -> pa.Array:
        return pa.array(hilbert(np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns]), bits))

    return of(*bins)


def coarse(value: Column, numeric: bool) -> Column:
    """What a dimension is counted by: a text value itself, a number by STEPS bins for each doubling, at most some 4,000."""
    if not numeric:
        return value.cast("string")
    steps = F.floor(F.log2(1 + F.abs(value.cast("double"))) * STEPS).cast("long")
    return F.when(F.isnan(value.cast("double")), F.lit(1 << 40)).otherwise(F.when(value < 0, -steps).otherwise(steps))


def with_bins(rows: DataFrame, dims: list[str], bits: int) -> DataFrame:
    """rows with `__bin<k>` for each dimension: equal shares of all rows in the dimension's order, equal values together."""
    for k, dim in enumerate(dims):
        key = coarse(F.col(dim), isinstance(rows.schema[dim].dataType, NumericType))
        counts = rows.groupBy(key.alias("__value")).agg(F.count("*").alias("n"))
        order = placed(counts, ["__value"], "n")
        total = counts.agg(F.sum("n")).first()[0] or 1
        # The middle of a value's rows decides its bin.
        middle = F.floor((F.col("before") + F.col("n") / 2) * float(1 << bits) / total)
        bins = order.select("__value", F.least(middle, F.lit((1 << bits) - 1)).cast("long").alias(f"__bin{k}"))
        few = bins.count() <= BROADCAST_VALUES
        rows = rows.withColumn("__key", key)
        rows = rows.join(F.broadcast(bins) if few else bins, F.col("__key").eqNullSafe(F.col("__value"))).drop("__key", "__value")
    return rows


def shard(
    docs: DataFrame, *, dims: tuple[str, ...] = ("source", "lang", "n_chars"), doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS,
    law: str = "rows", bits: int = BITS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, curve and the columns of `keep`, a row for each row of docs.

    curve is the row's place on the Hilbert curve, slot its place within its shard.
    """
    if law not in LAWS:
        raise ValueError(f"law is one of {LAWS}")
    if not dims or bits * len(dims) > 62:
        raise ValueError("a place on the curve has 1 to 62 bits")
    made = {"doc_id", "size", "text_crc32", "law", "shard", "slot", "curve"}
    if clash := made & set(keep):
        raise ValueError(f"keep names columns that are made here: {sorted(clash)}")
    axes = [f"__dim{k}" for k in range(len(dims))]
    octets = F.coalesce(F.col(text), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), (F.length(octets) + ROW_OVERHEAD).cast("long").alias("size"), F.crc32(octets).alias("text_crc32"), F.xxhash64(text).alias("__text"),
        *[F.col(d).alias(a) for d, a in zip(dims, axes, strict=True)], *keep,
    )
    rows = with_bins(narrow, axes, bits)
    rows = rows.withColumn("curve", curve_place([F.col(f"__bin{k}") for k in range(len(dims))], bits)).select("doc_id", "size", "text_crc32", "curve", "__text", *keep)
    out = placed(rows, ["curve", "__text", "doc_id"], "size" if law == "bytes" else None, rank="__rank", before="__before")
    totals = out.agg(F.count("*"), F.sum("size")).first()
    n, octets_in_all = totals[0], totals[1] or 1
    if law == "rows":
        out = out.withColumn("shard", (F.expr(f"__rank * {shards} div {max(n, 1)}")).cast("int"))
        first = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
        out = out.withColumn("slot", F.col("__rank") - first)
    else:
        out = out.withColumn("shard", F.expr(f"cast(cast(__before as decimal(38,0)) * {shards} div {octets_in_all} as int)"))
        first = out.groupBy(F.col("shard").alias("__shard")).agg(F.min("__rank").alias("__first"))  # a row for each shard
        out = out.join(F.broadcast(first), F.col("shard") == F.col("__shard")).withColumn("slot", F.col("__rank") - F.col("__first"))
    return out.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", "curve", *keep)


def zone_map(sharded: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """shard, rows, bytes and for each dimension the struct (low, high, has_null): what a reader needs to skip shards."""
    spans = [F.struct(F.min(d).alias("low"), F.max(d).alias("high"), F.bool_or(F.col(d).isNull()).alias("has_null")).alias(d) for d in dims]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *spans)


def shards_for(zones: DataFrame, wanted: dict[str, tuple]) -> DataFrame:
    """The shards that may hold a row with every named dimension between its two bounds, inclusive."""
    fits = F.lit(True)
    for d, (low, high) in wanted.items():
        fits = fits & (F.col(f"{d}.low") <= F.lit(high)) & (F.col(f"{d}.high") >= F.lit(low))
    return zones.where(fits).select("shard", "rows", "bytes")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard. Rows are in the curve's order in ranges already, so nothing is shuffled; parquet's own statistics
    within a folder are as narrow as the curve."""
    sharded.write.mode("errorifexists").partitionBy("shard").parquet(path)
