"""Corrections located in the text, anchors that must not cross, and lists aligned as wholes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import found_span
from corpusloom.operators.align import align

#: "Стран. 209, строка 45 сверху: напечатано X, слѣдуетъ читать Y."
_FORM = r"Стран\. (\d+), строка (\d+)(?:—\d+)? (сверху|снизу): напечатано ([^,]+), слѣдуетъ читать ([^.]+)\."


def parsed(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """keep, page, line, below (counted from the bottom), printed, read of each correction in a text."""
    found = df.select(*keep, F.explode(F.regexp_extract_all(text, F.lit(_FORM), F.lit(0))).alias("_x"))
    part = lambda k: F.regexp_extract("_x", _FORM, k)
    return found.select(*keep, part(1).cast("int").alias("page"), part(2).cast("int").alias("line"), (part(3) == "снизу").alias("below"), part(4).alias("printed"), part(5).alias("read"))


def located(corrections: DataFrame, lines: DataFrame, page: str, order: str, paragraph: str, paragraphs: DataFrame, text: str) -> DataFrame:
    """Corrections with the paragraph (``found_in``) they are to be made in, and how it was found: it is the one of the line
    they name (counted from the top or the bottom of the page, clamped to it) and has the printed words ("line"); else it is
    the page's only paragraph that has them ("page"); else it is the line's all the same ("miss"), or there is none ("").
    Printed words are looked for as they are, in the normal form, and in letters alone (``text.found_span``)."""
    w = Window.partitionBy(page)
    placed = lines.select(page, F.col(paragraph).alias("_para"), F.row_number().over(w.orderBy(order)).alias("_top"), F.count("*").over(w).alias("_n"))
    sizes = placed.groupBy(page).agg(F.max("_n").alias("_n"))
    c = corrections.withColumn("_c", F.xxhash64(*corrections.columns)).join(sizes, page, "left")
    want = F.greatest(F.least("line", F.col("_n")), F.lit(1))
    c = c.withColumn("_top", F.when(F.col("below"), F.col("_n") - want + 1).otherwise(want)).drop("_n")
    at = c.join(placed.drop("_n"), [page, "_top"], "left").drop("_top")
    texts = paragraphs.select(page, F.col(paragraph).alias("_held"), F.col(text).alias("_text"))
    tried = c.select("_c", page, "printed").join(texts, page)
    exact = F.coalesce(F.col("_text").contains(F.col("printed")), F.lit(False))
    near = tried.where(~exact).withColumn("_s", found_span("_text", "printed")["s"]).where("_s is not null")
    held = tried.where(exact).select("_c", "_held").unionByName(near.select("_c", "_held"))
    having = held.groupBy("_c").agg(F.collect_set("_held").alias("_all"))
    out = at.join(having, "_c", "left")
    hit = F.coalesce(F.array_contains("_all", F.col("_para")), F.lit(False))
    only = F.coalesce(F.size("_all") == 1, F.lit(False))
    how = F.when(hit, "line").when(only, "page").when(F.col("_para").isNotNull(), "miss").otherwise("")
    found = F.when(~hit & only, F.element_at("_all", 1)).otherwise(F.col("_para"))
    return out.withColumn("how", how).withColumn("found_in", found).drop("_c", "_all", "_para")


def uncrossed(df: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Pairs (a, b) that cross no other pair: all with a smaller a have a smaller b, all with a larger a a larger one.
    Pairs that share an a or a b are all dropped."""
    w = Window.partitionBy(*keys).orderBy(a)
    before, after = w.rangeBetween(Window.unboundedPreceding, -1), w.rangeBetween(1, Window.unboundedFollowing)
    alone = (F.count("*").over(Window.partitionBy(*keys, a)) == 1) & (F.count("*").over(Window.partitionBy(*keys, b)) == 1)
    ok = F.coalesce(F.max(b).over(before) < F.col(b), F.lit(True)) & F.coalesce(F.min(b).over(after) > F.col(b), F.lit(True))
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).withColumn("_ok", ok & alone).where("_ok").drop("_ok")


def filled_gaps(anchors: DataFrame, a_all: DataFrame, b_all: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """keys, a, b, anchored: the anchors, and between two of them (and before the first, after the last) the other places
    of both sides in turn where both have as many."""
    w = Window.partitionBy(*keys).orderBy(a)
    number = anchors.select(*keys, a, b, F.row_number().over(w).alias("_gap"))

    def in_gaps(every: DataFrame, x: str) -> DataFrame:
        run = Window.partitionBy(*keys).orderBy(x).rowsBetween(Window.unboundedPreceding, 0)
        at = every.select(*keys, x).distinct().join(number.select(*keys, x, "_gap"), [*keys, x], "left")
        gap = at.withColumn("_in", F.coalesce(F.last("_gap", ignorenulls=True).over(run), F.lit(0))).where("_gap is null")
        inside = Window.partitionBy(*keys, "_in")
        return gap.select(*keys, "_in", x, F.row_number().over(inside.orderBy(x)).alias("_k"), F.count("*").over(inside).alias("_n"))

    filled = in_gaps(a_all, a).join(in_gaps(b_all, b), [*keys, "_in", "_k", "_n"]).select(*keys, a, b, F.lit(False).alias("anchored"))
    return number.select(*keys, a, b, F.lit(True).alias("anchored")).unionByName(filled)


def list_scores(df: DataFrame, keys: list[str], truth: str, read: str) -> DataFrame:
    """keys, n, distance, exact: lists of words aligned as wholes, each word a symbol; a NULL list is empty."""
    types = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for *key, x, y in pdf[[*keys, truth, read]].itertuples(index=False, name=None):
                x, y = list(x) if x is not None else [], list(y) if y is not None else []
                distance, cost, _ = align(x, y)
                rows.append((*key, len(x), distance, sum(not c for c in cost)))
            yield pd.DataFrame(rows, columns=[*keys, "n", "distance", "exact"])

    return df.select(*keys, truth, read).mapInPandas(run, f"{types}, n int, distance int, exact int")


def asked(df: DataFrame, keys: list[str], column: str, ask, size: int = 50) -> DataFrame:
    """keys, answer, error: a model asked in batches of ``size``; ``ask`` takes a list and gives a list of as many
    answers. A batch that fails has the reason in ``error`` and no answers, and the others go on."""
    types = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), size):
                part = pdf.iloc[start : start + size]
                out = part[keys].copy()
                try:
                    got = ask(list(part[column]))
                    if len(got) != len(part):
                        raise ValueError(f"{len(got)} answers to {len(part)} questions")
                    out["answer"], out["error"] = got, None
                except Exception as failed:  # noqa: BLE001
                    out["answer"], out["error"] = None, f"{type(failed).__name__}: {failed}"
                yield out

    return df.select(*dict.fromkeys([*keys, column])).mapInPandas(run, f"{types}, answer string, error string")
