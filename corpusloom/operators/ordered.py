"""Ordered scans as windows: islands, groups opened by a flag, nearest within a tolerance, longest ordered run."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import cut


def _w(keys: list[str], order: list) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)


def islands(df: DataFrame, keys: list[str], value: str, piece: int = 10_000) -> DataFrame:
    """keys, lo, hi, n of each run of consecutive whole numbers; repeated and NULL values count once and not at all. Runs are
    found within pieces of the number line, so that a key with very many numbers is shared among tasks, and runs that meet
    at the edges of pieces are put together, of which there are few."""
    distinct = df.select(*keys, value).where(F.col(value).isNotNull()).distinct().withColumn("_piece", F.floor(F.col(value) / piece))
    run = F.col(value) - F.row_number().over(_w([*keys, "_piece"], [value]))
    runs = distinct.withColumn("_run", run).groupBy(*keys, "_piece", "_run").agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count("*").alias("n"))
    w = _w(keys, ["lo"])
    fresh = F.coalesce(F.lag("hi").over(w) + 1 != F.col("lo"), F.lit(True)).cast("int")
    met = runs.withColumn("_fresh", fresh).withColumn("_g", F.sum("_fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return met.groupBy(*keys, "_g").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).drop("_g")


def compact_ranges(df: DataFrame, keys: list[str], value: str, name: str = "ranges") -> DataFrame:
    """keys and "1-3,7": the runs of consecutive numbers as text, in order."""
    text = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat_ws("-", "lo", "hi"))
    runs = islands(df, keys, value).withColumn("_t", F.struct(F.col("lo"), text.alias("t")))
    return runs.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("_t")), lambda x: x["t"]), ",").alias(name))


def gap_groups(df: DataFrame, keys: list[str], order: list, gap: Column, name: str = "grp") -> DataFrame:
    """A running group number that grows where ``gap`` (it may use lag over the same window) is true."""
    w = _w(keys, order)
    return df.withColumn("_new", gap.cast("int")).withColumn(name, F.sum(F.coalesce("_new", F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def sessions(df: DataFrame, keys: list[str], at: str, tie: str, gap_seconds: float, name: str = "session") -> DataFrame:
    """Sessions of rows not further apart than the gap."""
    w = _w(keys, [at, tie])
    apart = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(F.lag(at).over(w).cast("timestamp"))
    marked = df.withColumn("_far", apart > int(gap_seconds * 1e6))
    return gap_groups(marked, keys, [at, tie], F.col("_far"), name).drop("_far")


def opened_groups(df: DataFrame, keys: list[str], order: list, start: Column, name: str = "grp") -> DataFrame:
    """Rows that ``start`` open a group, the others go on with it; group 0 has no start."""
    return gap_groups(df, keys, order, start, name)


def reach_cuts(df: DataFrame, keys: list[str], lo: str, hi: str, slack: Column, name: str = "band") -> DataFrame:
    """Bands of intervals: a new one where an interval begins further than ``slack`` beyond all before it."""
    w = _w(keys, [lo, hi])
    reach = F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_cut", F.col(lo) > reach + slack)
    return gap_groups(marked, keys, [lo, hi], F.col("_cut"), name).drop("_cut")


def clamped(df: DataFrame, keys: list[str], order: list, value: str, name: str) -> DataFrame:
    """A value that never falls: the largest so far."""
    return df.withColumn(name, F.max(value).over(_w(keys, order).rowsBetween(Window.unboundedPreceding, 0)))


def ranks_both_ways(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """from_top, from_bottom: places from either end."""
    return df.withColumn("from_top", F.row_number().over(_w(keys, [F.col(order)]))).withColumn("from_bottom", F.row_number().over(_w(keys, [F.col(order).desc()])))


def nearest_within(left: DataFrame, right: DataFrame, keys: list[str], x: str, y: str, tolerance: int) -> DataFrame:
    """Left rows with the right ``y`` nearest to ``x`` of the same keys, not further than the tolerance (ties to the
    lower); NULL if there is none. The value space is cut into cells of the tolerance's width, so the join is an equi
    join on the cell and its neighbours, and a key with very many rows is spread over its cells."""
    width = max(1, int(tolerance))
    cell = lambda c: F.floor(F.col(c) / width)
    tagged = left.withColumn("_row", F.monotonically_increasing_id())
    a = tagged.select("_row", *keys, x, F.explode(F.array(cell(x) - 1, cell(x), cell(x) + 1)).alias("_cell"))
    b = right.select(*keys, y, cell(y).alias("_cell")).distinct()
    near = a.join(b, [*keys, "_cell"]).where(F.abs(F.col(x) - F.col(y)) <= tolerance)
    best = near.groupBy(*keys, x).agg(F.min(F.struct(F.abs(F.col(x) - F.col(y)), F.col(y))).alias("_best"))
    return left.join(best.select(*keys, x, F.col("_best").getField(y).alias(y)), [*keys, x], "left")


class Runs:
    """How long the longest non-decreasing run is that ends in each value, in turn: the values by which runs of each length
    can end lowest are kept, and no more."""

    def __init__(self) -> None:
        self.lowest: list = []

    def ending_in(self, value) -> int:
        length = bisect_right(self.lowest, value) + 1
        self.lowest[length - 1 : length] = [value]
        return length


class Backwards:
    """Which values belong to the run, asked from the last to the first with the lengths of their runs: of each length the
    last value before the one taken for the next length."""

    def __init__(self, longest: int) -> None:
        self.wanted = longest

    def takes(self, length: int) -> bool:
        taken = length == self.wanted
        self.wanted -= taken
        return taken


def longest_ordered(values: list) -> list[bool]:
    """Which values belong to one longest non-decreasing subsequence (the one patience sorting ends with)."""
    runs = Runs()
    lengths = [runs.ending_in(v) for v in values]
    back = Backwards(max(lengths, default=0))
    return [back.takes(n) for n in reversed(lengths)][::-1]


def scanned(df: DataFrame, part: str, order: list, column: str, kind: str, begin, step) -> DataFrame:
    """df with a column made in one pass over each part in its order; rows stream through a task, which keeps the state
    that ``begin`` makes for a part, and no rows."""
    types = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), f"{column} {kind}"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = object(), None
        for pdf in batches:
            found = []
            for row in pdf.itertuples(index=False):
                here = getattr(row, part)
                if here != now and not (here is None and now is None):
                    now, state = here, begin(row)
                found.append(step(state, row))
            pdf[column] = pd.Series(found, index=pdf.index, dtype=object)
            yield pdf

    return df.repartition(part).sortWithinPartitions(part, *order).mapInPandas(run, types)


def out_of_order(df: DataFrame, part: str, order: list[str], key: str) -> DataFrame:
    """Rows of each part with ``in_order``: whether they belong to a longest non-decreasing run of ``key``. Rows without a key
    are not judged (NULL). Two passes over each part in its order, forwards for the lengths of the runs and backwards for
    the one that is kept; a task holds the lowest ends of runs, not the rows."""
    judged = F.col(key).isNotNull()
    forth = scanned(df.where(judged), part, order, "_run", "int", lambda row: Runs(), lambda runs, row: runs.ending_in(getattr(row, key)))
    forth = cut(forth.withColumnRenamed("_run", "run_"))
    longest = forth.groupBy(F.col(part).alias("part_")).agg(F.max("run_").alias("most_"))
    back = forth.join(longest, F.col(part).eqNullSafe(F.col("part_"))).drop("part_")
    back = scanned(back, part, [F.col(c).desc() for c in order], "in_order", "boolean", lambda row: Backwards(row.most_), lambda b, row: b.takes(row.run_))
    return back.drop("run_", "most_").unionByName(df.where(~judged).withColumn("in_order", F.lit(None).cast("boolean")))


def interval_pieces(texts: DataFrame, spans: DataFrame, key: str, length: str) -> DataFrame:
    """key, s, e, kinds: each text cut at all edges of its spans, each piece with the sorted kinds that cover it."""
    edges = spans.select(key, F.explode(F.array("s", "e")).alias("at")).unionByName(
        texts.select(key, F.explode(F.array(F.lit(0), F.col(length))).alias("at"))
    )
    cut_at = edges.join(texts.select(key, length), key).where((F.col("at") >= 0) & (F.col("at") <= F.col(length))).select(key, "at").distinct()
    pieces = cut_at.withColumn("e", F.lead("at").over(_w([key], ["at"]))).where("e is not null").withColumnRenamed("at", "s")
    over = spans.select(key, F.col("s").alias("_s"), F.col("e").alias("_e"), "kind")
    hit = pieces.join(over, key, "left").where("_s is null or (_s < e and _e > s)").groupBy(key, "s", "e")
    covered = hit.agg(F.array_join(F.array_sort(F.collect_set("kind")), "+").alias("kinds"))
    return pieces.join(covered, [key, "s", "e"], "left").withColumn("kinds", F.coalesce("kinds", F.lit("")))
