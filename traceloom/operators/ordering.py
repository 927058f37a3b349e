"""Numbers and least values per group without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traceloom.session import cut

_ROW = (1 << 33) - 1


def number_rows(df: DataFrame, *order, name: str = "row_no") -> DataFrame:
    """Adds the place of each row in a total order, from 1.

    Rows are sorted by ranges; a row's number is its place in its range and the
    sizes of the ranges before. Only one size per range is gathered. The order
    must end in a column that tells rows apart, so that ranges can part any group.
    """
    ranged = cut(df.orderBy(*order)).withColumn("_at", F.monotonically_increasing_id())
    place = F.shiftright("_at", 33)
    sizes = sorted((r[0], r[1]) for r in ranged.groupBy(place.alias("p")).agg(F.count("*")).collect())
    before, total = [], 0
    for p, n in sizes:
        before.append((p, total))
        total += n
    offsets = df.sparkSession.createDataFrame(before, "_p long, _before long")
    numbered = ranged.join(F.broadcast(offsets), place == F.col("_p"))
    return numbered.withColumn(name, F.col("_at").bitwiseAND(F.lit(_ROW)) + F.col("_before") + 1).drop("_at", "_p", "_before")


def group_places(df: DataFrame, group: str, order: str, name: str = "place") -> DataFrame:
    """Adds group size, least ``order`` of the group, and the place in it, for groups of any size."""
    numbered = cut(number_rows(df, group, order, name="_no"))
    heads = numbered.groupBy(group).agg(F.count("*").alias("group_size"), F.min("_no").alias("_first"), F.min(order).alias("canonical"))
    return numbered.join(heads, group).withColumn(name, F.col("_no") - F.col("_first") + 1).drop("_no", "_first")


def capped_values(df: DataFrame, group: str, value: str, limit: int = 50, name: str | None = None) -> DataFrame:
    """(group, text): sorted distinct values joined by ``|``, beyond ``limit`` with the number left out.

    Each task keeps its least ``limit`` values of a group before anything is shuffled.
    """
    name = name or value
    distinct = df.select(group, F.col(value).alias("_v")).where("_v <> ''").groupBy(group, "_v").agg(F.lit(1).alias("_one"))
    counts = distinct.groupBy(group).agg(F.count("*").alias("_n"))
    least = distinct.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy("_v"))).where(F.col("_r") <= limit)
    joined = least.groupBy(group).agg(F.array_join(F.array_sort(F.collect_list("_v")), "|").alias("_text")).join(counts, group)
    more = F.col("_n") - limit
    return joined.select(group, F.when(more > 0, F.concat("_text", F.lit("|...(+"), more.cast("string"), F.lit(" more)"))).otherwise(F.col("_text")).alias(name))
