"""Places in one order over all rows, without a task that sorts them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tractloom.llm.common import settle

PART_BITS = 33  # monotonically_increasing_id: the partition above, the place within it below


def placed(df: DataFrame, order: list[str], weight: str | None = None, *, rank: str = "rank", before: str = "before") -> DataFrame:
    """df with `rank`, each row's 0-based place by the columns of `order` (nulls first), and with a weight also `before`,
    the sum of the weights of all rows ahead of it.

    Rows are cut into ranges of the order by sampled bounds, sorted there and written once; a row's place is its place in
    its range and what the ranges before hold. Only a row for each range is ever ranked in one window. Rows that agree in
    all of `order` are spread over ranges by where they were read, so a group of copies is no single task; which of them
    comes first is open, so `order` should hold all that is to be told apart. df is to be read from files or settled, so
    that a task that runs again reads its rows in the same sequence.
    """
    salted = df.withColumn("__salt", F.monotonically_increasing_id())
    cut = settle(salted.repartitionByRange(*order, "__salt").sortWithinPartitions(*order, "__salt").drop("__salt").withColumn("__at", F.monotonically_increasing_id()))
    cut = cut.withColumn("__part", F.shiftright("__at", PART_BITS))
    sums = [F.count("*").alias("__n")] + ([F.sum(weight).alias("__w")] if weight else [])
    by_part = cut.groupBy("__part").agg(*sums)
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    added = {"__rows": F.coalesce(F.sum("__n").over(ahead), F.lit(0))} | ({"__ahead": F.coalesce(F.sum("__w").over(ahead), F.lit(0))} if weight else {})
    j = cut.join(F.broadcast(by_part.withColumns(added).drop("__n", "__w")), "__part")
    j = j.withColumn(rank, F.col("__rows") + F.col("__at").bitwiseAND((1 << PART_BITS) - 1))
    if weight:
        within = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
        j = j.withColumn(before, F.col("__ahead") + F.coalesce(F.sum(weight).over(within), F.lit(0)))
    return j.select(*df.columns, rank, *([before] if weight else []))
