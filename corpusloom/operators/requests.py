"""Questions to an outside reader as rows: requests with examples before them, batches, answers read back and accounted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import json_answer
from corpusloom.operators.ordered import compact_ranges


def requests(items: DataFrame, page: str, order: list[str], item: str, examples: list[tuple[str, str | None]] = (), size: int = 250) -> DataFrame:
    """page, n, batch, request: one request a page, as JSON with the examples (the same before every page, so that they can be
    kept by the reader) and the page's items in order; ``size`` pages make a batch."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(*order, item))), lambda x: x[item])
    per = items.groupBy(page).agg(ordered.alias("items"), F.count("*").alias("n"))
    shown = F.array(*[F.struct(F.lit(q).alias("ask"), F.lit(a).cast("string").alias("answer")) for q, a in examples]) if examples else F.array().cast("array<struct<ask:string,answer:string>>")
    numbered = per.withColumn("batch", F.floor((F.row_number().over(Window.orderBy(page)) - 1) / size).cast("int"))  # a row a page
    return numbered.select(page, "n", "batch", F.to_json(F.struct(shown.alias("examples"), "items")).alias("request"))


def ledger(asked: DataFrame, page: str) -> DataFrame:
    """batch, pages (as ranges), n, status of the batches that were sent."""
    ranges = compact_ranges(asked.select("batch", page), ["batch"], page, "pages")
    return asked.groupBy("batch").agg(F.count("*").alias("n")).join(ranges, "batch").select("batch", "pages", "n", F.lit("submitted").alias("status"))


def collected(asked: DataFrame, answers: DataFrame, page: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(readings, failures, ledger) of answers (page, text, state, tokens_in, tokens_cached, tokens_out). An answer has a JSON list
    with a word or null for every item; others fail, with the reason, and are asked again, and the rest is kept. Of repeated
    answers to a page the good one counts."""
    words = json_answer(F.col("text"))
    told = asked.select(page, "n", "batch").join(answers, page, "left").withColumn("_w", words)
    why = F.when(F.col("state").isNull(), "no answer").when(F.col("state") != "succeeded", F.col("state")).when(F.col("_w").isNull(), "no list in the answer")
    why = why.when(F.size("_w") != F.col("n"), F.concat(F.size("_w").cast("string"), F.lit(" answers for "), F.col("n").cast("string")))
    told = told.withColumn("why", F.coalesce(why, F.lit("")))
    best = told.groupBy(page, "batch").agg(F.min_by(F.struct("_w", "why"), F.struct("why", F.coalesce("text", F.lit("")))).alias("b"), *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("tokens_in", "tokens_cached", "tokens_out")])
    good = best.where("b.why = ''")
    each = good.select(page, F.posexplode("b._w").alias("k", "_x"))
    word = F.trim("_x")
    readings = each.select(page, (F.col("k") + 1).alias("k"), F.when((word != "") & (word != "null"), word).alias("reading"))
    failed = F.sum((F.col("b.why") != "").cast("int"))
    status = F.when(failed == 0, "collected").otherwise(F.concat(F.lit("collected ("), failed.cast("string"), F.lit(" failed)")))
    account = best.groupBy("batch").agg(F.count("*").alias("pages"), status.alias("status"), *[F.sum(c).alias(c) for c in ("tokens_in", "tokens_cached", "tokens_out")])
    return readings, best.where("b.why != ''").select(page, "batch", F.col("b.why").alias("why")), account
