"""Ordered computations without a task that sees all rows: segmented scans.

Rows are dealt out by ranges of their order, so that partition after partition they are in order, and written once. Each partition
is summed up by a few numbers that compose: a count or sum, or the runs that touch its ends. The summaries, one row for each
partition (and group in it), are combined in order, and a second pass finishes every partition with what came before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.sources.files import staged

PART = "_part"


def in_order(df: DataFrame, order: list[str]) -> DataFrame:
    """df with `_part`, the number of its range of the order; written, so that each range stays what it is when tasks run again.
    Rows that are equal in the order stay together."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return staged(df.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id()), "scan")


def prefix_sums(df: DataFrame, order: list[str], **columns: str | Column) -> DataFrame:
    """df with, for each name, the sum of a column over all rows before, in the order; rows equal in it count as one after
    another in no certain order. A sum of nothing is 0."""
    rows = in_order(df.withColumns({name: F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)) for name, c in columns.items()}), order)
    inside = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    sums = rows.groupBy(PART).agg(*(F.sum(c).alias(c) for c in columns))
    before = sums.select(F.col(PART).alias("_p"), *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before_{c}") for c in columns))
    out = rows.join(F.broadcast(before), F.col(PART) == F.col("_p"))
    return out.select(*(F.col(f"`{c}`") for c in df.columns if c not in columns), *((F.col(f"_before_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(c) for c in columns))


def row_numbers(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with the number of each row, from 1 on, in the order over all of it."""
    return prefix_sums(df, order, **{name: F.lit(1)}).withColumn(name, F.col(name) + 1)


def runs(df: DataFrame, group: str, order: str, flag: Column) -> DataFrame:
    """(group, first, last, n) of all runs of consecutive rows of a group, in the order, for which the flag holds.

    A range of rows finds its own runs; only those at the first or last row of a group in a range may go on next door, and
    at most two of these are there for each group and range. They are chained up and added.
    """
    rows = in_order(df.select(group, F.col(order).alias("_o"), F.coalesce(flag, F.lit(False)).alias("_f")), [group, "_o"])
    inside = Window.partitionBy(PART, group).orderBy("_o")
    at, gap = F.row_number().over(inside), F.sum((~F.col("_f")).cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    size = rows.groupBy(PART, F.col(group).alias("_g")).agg(F.count("*").alias("_size"))
    size = size.withColumn("_at", F.row_number().over(Window.partitionBy("_g").orderBy(PART)))  # ranges of a group
    local = rows.withColumns({"_k": at, "_gap": gap}).filter("_f").groupBy(PART, group, "_gap").agg(F.min("_o").alias("first"), F.max("_o").alias("last"), F.count("*").alias("n"), F.min("_k").alias("_from"), F.max("_k").alias("_to"))
    local = staged(local.join(size.withColumnRenamed(PART, "_p"), (F.col(PART) == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))).select(group, "first", "last", "n", "_at", (F.col("_from") == 1).alias("_left"), (F.col("_to") == F.col("_size")).alias("_right")), "runs")
    chain = Window.partitionBy(group).orderBy("_at", "first")
    goes_on = F.col("_left") & F.coalesce(F.lag("_right").over(chain) & (F.lag("_at").over(chain) == F.col("_at") - 1), F.lit(False))
    ends = local.filter("_left or _right").withColumn("_new", (~goes_on).cast("int"))
    ends = ends.withColumn("_chain", F.sum("_new").over(chain.rowsBetween(Window.unboundedPreceding, 0)))
    joined = ends.groupBy(group, "_chain").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))
    return local.filter("not (_left or _right)").select(group, "first", "last", "n").unionByName(joined.select(group, "first", "last", "n"))
