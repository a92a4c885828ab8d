"""Readings of several witnesses: votes, agreement, alignment, scores, confirmations."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import align as A
from corpusloom.operators import geometry as G
from corpusloom.operators import vote as V
from corpusloom.session import table


def _disputes(spark, d):
    return table(spark, d, "disputes").select("item_id", "para_id", "s", "e", "read_d", "read_b", "read_a").distinct()


def _answers(spark, d):
    """Each reader's latest answer to each item, in one spelling."""
    return V.counting_answers(table(spark, d, "dispute_labels"))


def word_votes(spark, d):
    """The base rule of the vote for the disputed words (the fourth witness is what people think of d)."""
    v = V.base_rule(F.col("read_d"), F.col("read_b"), F.col("read_a"), F.lit(None).cast("string"))
    return _disputes(spark, d).select("item_id", v["reading"].alias("reading"), v["fixed"].alias("fixed"), v["disputed"].alias("still_disputed"))


def majority_labels(spark, d):
    """The answer most people gave, ties to the reader who comes first."""
    order = [f"reader-{k:02d}" for k in range(1, 25)]
    return V.majority(_answers(spark, d), ["item_id"], "annotator", "label", order)


def reader_agreement(spark, d):
    """How often pairs of witnesses read the same word, and are right (as the voted text has it)."""
    p = table(spark, d, "paragraphs").groupBy("para_id").agg(F.max("text_merged").alias("t"))
    x = _disputes(spark, d).join(p, "para_id", "left").withColumn("truth", F.substring("t", F.col("s") + 1, F.col("e") - F.col("s")))
    return V.agreement(x, ["read_d", "read_b", "read_a"], "truth")


def unanimous_items(spark, d):
    """Items on which at least three people answered, all the same."""
    return G.unanimous(_answers(spark, d), ["item_id"], "annotator", "label", 3)


def witness_alignment(spark, d):
    """The two texts of each paragraph aligned: distance, lengths, where they differ."""
    p = table(spark, d, "paragraphs").select("para_id", "text_d", "text_merged").distinct()
    return A.aligned(p, ["para_id"], "text_merged", "text_d")


def paragraph_cer(spark, d):
    """Character error rate of d against the voted text, by leaf, on the strict texts."""
    p = table(spark, d, "paragraphs").select("para_id", "leaf", "text_d", "text_merged").where("text_d is not null and text_merged is not null").distinct()
    err, n = F.sum(F.levenshtein("text_merged", "text_d").cast("long")), F.sum(F.length("text_merged").cast("long"))
    return p.groupBy("leaf").agg(err.alias("errors"), n.alias("n"), F.round(err / n, 6).alias("cer"))


def confirmed_heads(spark, d):
    """Which witnesses of its paragraph hold an entry's head, in the normal form."""
    e = table(spark, d, "entries").where("headword is not null").groupBy("id").agg(F.max("headword").alias("h"))
    p = table(spark, d, "paragraphs").groupBy(F.col("para_id").alias("id")).agg(F.max("text_d").alias("d"), F.max("text_merged").alias("m"))
    j = e.join(p, "id").select("id", X.squash(F.col("h")).alias("h"), X.squash(F.col("d")).alias("d"), X.squash(F.col("m")).alias("m"))
    by = V.confirmed_by(F.col("h"), D=F.col("d"), M=F.col("m"))
    return j.select("id", by.alias("confirmed_by"), F.when(F.length(by) > 0, "confirmed").otherwise("disputed").alias("check"))


QUERIES = {
    f.__name__: f
    for f in (word_votes, majority_labels, reader_agreement, unanimous_items, witness_alignment, paragraph_cer, confirmed_heads)
}

_DIS = "x AS (SELECT DISTINCT item_id, para_id, s, e, coalesce(read_d, '') AS d, coalesce(read_b, '') AS b, coalesce(read_a, '') AS a FROM disputes)"
ANSWERS = r"""named AS (SELECT item_id, replace(trim(regexp_replace(trim(regexp_replace(lower(annotator), '[^\p{L}\p{N}]+', ' ', 'g')), ' +', ' ', 'g')), ' ', '-') AS annotator, labelled_at, received_at, label_id,
    regexp_replace(trim(regexp_replace(lower(label), '[^\p{L}\p{N}]+', ' ', 'g')), '^(?:wit|witness|text|read|reading) +', '') AS word FROM dispute_labels WHERE item_id IS NOT NULL),
    lst AS (SELECT *, row_number() OVER (PARTITION BY item_id, annotator ORDER BY labelled_at DESC NULLS LAST, received_at DESC NULLS LAST, label_id DESC NULLS LAST) AS k FROM named WHERE annotator <> ''),
    ans AS (SELECT item_id, annotator, CASE WHEN word IN ('x', 'none') THEN 'x' ELSE word END AS label FROM lst WHERE k = 1 AND word IN ('d', 'b', 'a', 'x', 'none'))"""
_FIXED = "(b <> d AND b = a AND ('' <> d OR (contains(b, '=') AND NOT contains(d, '=')) OR list_sort([b, d]) = ['ъ', 'ь']))"

ORACLE = {
    "word_votes": f"WITH {_DIS} SELECT item_id, CASE WHEN {_FIXED} THEN b ELSE d END AS reading, {_FIXED} AS fixed, b <> d AND NOT {_FIXED} AS still_disputed FROM x",
    "majority_labels": f"""WITH {ANSWERS}, c AS (SELECT item_id, label, count(*) AS votes, min(CASE WHEN regexp_full_match(annotator, 'reader-(0[1-9]|1[0-9]|2[0-4])') THEN right(annotator, 2)::INT ELSE 25 END) AS r FROM ans GROUP BY ALL)
        SELECT item_id, label, votes FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY votes DESC, r) AS k FROM c) WHERE k = 1""",
    "reader_agreement": """WITH p AS (SELECT para_id, max(text_merged) AS t FROM paragraphs GROUP BY para_id),
        x AS (SELECT DISTINCT item_id, para_id, s, e, read_d, read_b, read_a FROM disputes), j AS (SELECT x.*, substr(t, s + 1, e - s) AS truth FROM x LEFT JOIN p USING (para_id)),
        r AS (SELECT 'read_d' AS x, 'read_b' AS y, read_d AS u, read_b AS v, truth FROM j UNION ALL SELECT 'read_d', 'read_a', read_d, read_a, truth FROM j UNION ALL SELECT 'read_b', 'read_a', read_b, read_a, truth FROM j)
        SELECT x, y, count(*) FILTER (u IS NOT DISTINCT FROM v) AS agree, count(*) FILTER (u IS NOT DISTINCT FROM v AND u IS NOT DISTINCT FROM truth) AS right_agreed,
        count(*) FILTER (u IS NOT DISTINCT FROM truth OR v IS NOT DISTINCT FROM truth) AS right_either, count(*) AS n FROM r GROUP BY x, y""",
    "unanimous_items": f"WITH {ANSWERS} SELECT item_id, min(label) AS label FROM ans GROUP BY item_id HAVING count(DISTINCT annotator) >= 3 AND min(label) = max(label)",
}
