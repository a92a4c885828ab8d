"""Queries of the training-data operators, and SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import consensus, lookalikes, matching, mixing, packing, scanned, toxicity
from corpusloom.plans.readings import ANSWERS
from corpusloom.session import table

HEADS = ["headword", "headword_civil", "headword_key"]


def p1_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = lookalikes.dirty_values(table(spark, sf_dir, "entries"), "entries", "id", HEADS)
    return entries.unionByName(lookalikes.dirty_values(table(spark, sf_dir, "dictionary_psv"), "dictionary_psv", "lemma_id", ["lemma"]))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_clean(spark, sf_dir).select("tbl", "row_key", "field").distinct()


def _consensus(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return consensus.consensus(table(spark, sf_dir, "disputes"), table(spark, sf_dir, "dispute_labels"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _consensus(spark, sf_dir)[0].select("item_id", "label")


def p2_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _consensus(spark, sf_dir)[0]


def p2_annotators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _consensus(spark, sf_dir)[1]


def p2_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consensus.alpha(consensus.answers(table(spark, sf_dir, "dispute_labels"), table(spark, sf_dir, "disputes")))


def p2_convergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consensus.convergence(table(spark, sf_dir, "disputes"), table(spark, sf_dir, "dispute_labels"))


def p3_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.matches(table(spark, sf_dir, "dictionary_psv"), table(spark, sf_dir, "entries"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_matches(spark, sf_dir).select("lemma_id", "id").distinct()


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = scanned.value_table(table(spark, sf_dir, "entries"), "entries", "id", {"definition": False})
    return entries.unionByName(
        scanned.value_table(table(spark, sf_dir, "paragraphs"), "paragraphs", "para_id", {"text_d": True, "text_merged": True})
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned.found(_values(spark, sf_dir))


def p5_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned.repair(_values(spark, sf_dir))


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "bin_sizes"))


def p6_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.summary(p6_containers(spark, sf_dir))


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(p7_mix(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.found(table(spark, sf_dir, "documents"))


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"))


def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rates(table(spark, sf_dir, "documents"))


QUERIES = {
    "p1_found": p1_found,
    "p1_clean": p1_clean,
    "p2_found": p2_found,
    "p2_items": p2_items,
    "p2_annotators": p2_annotators,
    "p2_agreement": p2_agreement,
    "p2_convergence": p2_convergence,
    "p3_found": p3_found,
    "p3_matches": p3_matches,
    "p5_found": p5_found,
    "p5_repaired": p5_repaired,
    "p6_containers": p6_containers,
    "p6_summary": p6_summary,
    "p7_mix": p7_mix,
    "p7_shares": p7_shares,
    "p8_found": p8_found,
    "p8_scores": p8_scores,
    "p8_rates": p8_rates,
}
ORACLE = {
    "p2_agreement": f"""WITH {ANSWERS}, e AS (SELECT ans.* FROM ans WHERE item_id IN (SELECT item_id FROM disputes)),
        i AS (SELECT item_id, count(*) AS n, count(*) FILTER (label = 'd') AS d, count(*) FILTER (label = 'b') AS b, count(*) FILTER (label = 'a') AS a, count(*) FILTER (label = 'x') AS x FROM e GROUP BY item_id HAVING count(*) > 1),
        s AS (SELECT count(*) AS items, sum(n)::BIGINT AS answers, sum(n - (d * (d - 1) + b * (b - 1) + a * (a - 1) + x * (x - 1)) / (n - 1)) AS apart, sum(d) AS d, sum(b) AS b, sum(a) AS a, sum(x) AS x FROM i),
        o AS (SELECT items, answers, apart / answers AS o, 1 - (d * (d - 1) + b * (b - 1) + a * (a - 1) + x * (x - 1)) / (answers::DOUBLE * (answers - 1)) AS e FROM s)
        SELECT items, coalesce(answers, 0) AS answers, round(o, 6) AS observed, round(e, 6) AS expected, round(CASE WHEN e > 0 THEN 1 - o / e END, 6) AS alpha FROM o""",
}
