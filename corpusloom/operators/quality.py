"""Validation and scoring as tables: problems, flags, rates, two-by-two tables, completeness against a reference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def problems(*checks: tuple[str, DataFrame, Column]) -> DataFrame:
    """what, which: one row per problem of all checks; no rows means that all is well."""
    parts = [df.select(F.lit(name).alias("what"), which.cast("string").alias("which")) for name, df, which in checks]
    return reduce(lambda a, b: a.unionByName(b), parts)


def flag_counts(df: DataFrame, flags: Column) -> DataFrame:
    """flag, n of each flag of a list column."""
    return df.select(F.explode(flags).alias("flag")).where("flag != ''").groupBy("flag").agg(F.count("*").alias("n"))


def top_per_group(df: DataFrame, group: str, order: list, k: int) -> DataFrame:
    """The first k rows of each group with their place and how many more there are. A group of a third of all rows is
    cut to k rows in every task before its rows meet: the place is first ranked within a random piece."""
    inner = Window.partitionBy(group, "_piece").orderBy(*order)
    few = df.withColumn("_piece", F.spark_partition_id()).withColumn("_r", F.row_number().over(inner)).where(F.col("_r") <= k).drop("_r", "_piece")
    totals = df.groupBy(group).agg(F.count("*").alias("_n"))
    placed = few.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("place") <= k)
    return placed.join(totals, group).withColumn("more", F.greatest(F.col("_n") - k, F.lit(0))).drop("_n")


def rates(df: DataFrame, keys: list[str], parts: dict[str, Column], total: str = "n") -> DataFrame:
    """keys, n, and per condition its count and its share."""
    sums = [F.sum(F.coalesce(c, F.lit(False)).cast("long")).alias(name) for name, c in parts.items()]
    out = df.groupBy(*keys).agg(F.count("*").alias(total), *sums)
    return out.withColumns({f"{name}_rate": F.round(F.col(name) / F.col(total), 6) for name in parts})


def two_by_two(df: DataFrame, keys: list[str], a: Column, b: Column) -> DataFrame:
    """keys and the counts both, only_a, only_b, neither; NULL conditions count as false."""
    x, y = F.coalesce(a, F.lit(False)), F.coalesce(b, F.lit(False))
    cells = {"both": x & y, "only_a": x & ~y, "only_b": ~x & y, "neither": ~x & ~y}
    return df.groupBy(*keys).agg(*[F.sum(c.cast("long")).alias(k) for k, c in cells.items()])


def short_of(df: DataFrame, lines: str, ref_lines: str, chars: str, ref_chars: str) -> DataFrame:
    """Rows with how far they fall short of a reference: a line and 1.5 % of the characters, of more than 200."""
    ratio = F.round(F.col(chars) / F.col(ref_chars), 6)
    short = (F.col(ref_lines) - F.col(lines) >= 1) & (F.col(chars) < 0.985 * F.col(ref_chars)) & (F.col(ref_chars) > 200)
    return df.withColumn("ratio", F.when(F.col(ref_chars) > 0, ratio)).withColumn("short", F.coalesce(short, F.lit(False)))


def odd_lengths(a: Column, b: Column) -> Column:
    """Whether two readings of one text differ oddly in length: at least 30 letters, and a ratio outside 0.75 to 1.35."""
    return F.coalesce((a >= 30) & ~(b / a).between(0.75, 1.35), F.lit(False))
