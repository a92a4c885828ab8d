"""Words of the corpus, the lexicon, the dictionary's forms, and what covers what."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import upkeep
from corpusloom.session import table


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "lang", "source", F.explode(X.words(F.col("text"))).alias("form"))


def token_frequency(spark, d):
    return _tokens(spark, d).groupBy("form").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))


def lexicon_min2(spark, d):
    counts = _tokens(spark, d).where(F.length("form") >= 2).groupBy("form").agg(F.count("*").alias("n"))
    return counts.where("n >= 2")


def _forms(spark: SparkSession, d: str) -> DataFrame:
    each = table(spark, d, "dictionary_psv").select("lemma_id", "pos", F.explode("forms").alias("form"))
    return each.where(F.col("form").isNotNull()).select("lemma_id", "pos", X.strip_accents(F.lower("form")).alias("form")).distinct()


def form_lookup(spark, d):
    """Each form of the corpus with its count and how many dictionary words claim it."""
    counts = _tokens(spark, d).groupBy("form").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))
    claims = _forms(spark, d).groupBy("form").agg(F.countDistinct("lemma_id").alias("claims"))
    return counts.join(claims, "form", "left").select("form", "n", "docs", F.coalesce("claims", F.lit(0)).alias("claims"))


def form_index(spark, d):
    """Dictionary forms with their count in the corpus (0 if never)."""
    counts = _tokens(spark, d).groupBy("form").agg(F.count("*").alias("n"))
    return _forms(spark, d).select("form", "lemma_id").join(counts, "form", "left").select("form", "lemma_id", F.coalesce("n", F.lit(0)).alias("n"))


def forms_not_in_dictionary(spark, d):
    seen = _tokens(spark, d).groupBy("form").agg(F.count("*").alias("n"))
    return seen.join(_forms(spark, d), "form", "left_anti")


def forms_not_attested(spark, d):
    seen = _tokens(spark, d).select("form").distinct()  # each task's own forms once, before they are shuffled
    return _forms(spark, d).select("form").distinct().join(seen, "form", "left_anti")


def form_claimed_twice(spark, d):
    claims = _forms(spark, d).groupBy("form").agg(F.array_sort(F.collect_set("lemma_id")).alias("ids"))
    return claims.where(F.size("ids") > 1).select("form", F.size("ids").alias("claims"), F.array_join(F.transform("ids", lambda x: x.cast("string")), ";").alias("lemmas"))


def coverage_by_source(spark, d):
    """Share of the tokens of each source that the entries' look-up keys cover."""
    keys = table(spark, d, "entries").select(F.col("headword_key").alias("form")).where("form is not null").distinct().withColumn("known", F.lit(1))
    per = _tokens(spark, d).groupBy("source", "form").agg(F.count("*").alias("n"))  # summed before the join
    joined = per.join(keys, "form", "left")
    total, hit = F.sum("n"), F.sum(F.when(F.col("known") == 1, F.col("n")).otherwise(0))
    return joined.groupBy("source").agg(total.alias("tokens"), hit.alias("covered"), F.round(hit / total, 6).alias("coverage"))


def alphabet_counts(spark, d):
    """Characters of the entries by split of their leaf, with those that training never sees told apart."""
    e = table(spark, d, "entries").select(F.split("id", "-")[0].cast("int").alias("leaf"), F.explode(F.split(F.coalesce("headword", F.lit("")), "")).alias("ch"))
    e = e.where("ch != ''").withColumn("split", upkeep.split_of(F.col("leaf"), [45, 60, 117]))
    per = e.groupBy("ch").pivot("split", ["train", "val", "test"]).count().na.fill(0)
    return per.withColumn("unseen", (F.col("train") == 0).cast("int"))


#: An alphabet with з before б, to tell it from the plain order.
_ALPHABET = "азбвгдежийклмнопрстуфхцчшщъыьэюя"


def collation_sort(spark, d):
    """Dictionary words with their place in the plain and in the custom alphabet's order."""
    from pyspark.sql import Window

    lemmas = table(spark, d, "dictionary_psv").select("lemma_id", "lemma").where("lemma is not null").distinct()
    keyed = lemmas.select("lemma_id", X.sort_key(F.col("lemma")).alias("plain_key"), X.collation_key(F.col("lemma"), _ALPHABET).alias("k"))
    keyed = keyed.withColumn("first", F.substring("plain_key", 1, 1))
    w = Window.partitionBy("first")
    return keyed.select(
        "lemma_id",
        "plain_key",
        F.row_number().over(w.orderBy("plain_key", "lemma_id")).alias("plain_place"),
        F.row_number().over(w.orderBy("k", "lemma_id")).alias("custom_place"),
    )


QUERIES = {
    f.__name__: f
    for f in (token_frequency, lexicon_min2, form_lookup, form_index, forms_not_in_dictionary, forms_not_attested, form_claimed_twice, coverage_by_source, alphabet_counts, collation_sort)
}

_TOKENS = r"tok AS (SELECT doc_id, lang, source, unnest(regexp_extract_all(lower(replace(text, chr(769), '')), '\p{L}+')) AS form FROM documents WHERE text IS NOT NULL)"
_FORMS = "frm AS (SELECT DISTINCT lemma_id, pos, replace(lower(form), chr(769), '') AS form FROM (SELECT lemma_id, pos, unnest(forms) AS form FROM dictionary_psv) WHERE form IS NOT NULL)"
_DEALT = "CASE WHEN leaf IN (45, 60, 117) THEN 'test' WHEN leaf % 20 = 7 THEN 'val' ELSE 'train' END"

ORACLE = {
    "token_frequency": f"WITH {_TOKENS} SELECT form, count(*) AS n, count(DISTINCT doc_id) AS docs FROM tok GROUP BY form",
    "lexicon_min2": f"WITH {_TOKENS} SELECT form, count(*) AS n FROM tok WHERE length(form) >= 2 GROUP BY form HAVING count(*) >= 2",
    "form_lookup": f"""WITH {_TOKENS}, {_FORMS}, c AS (SELECT form, count(*) AS n, count(DISTINCT doc_id) AS docs FROM tok GROUP BY form),
        k AS (SELECT form, count(DISTINCT lemma_id) AS claims FROM frm GROUP BY form)
        SELECT c.form, n, docs, coalesce(claims, 0) AS claims FROM c LEFT JOIN k USING (form)""",
    "form_index": f"""WITH {_TOKENS}, {_FORMS}, c AS (SELECT form, count(*) AS n FROM tok GROUP BY form)
        SELECT DISTINCT frm.form, lemma_id, coalesce(n, 0) AS n, pos FROM frm LEFT JOIN c USING (form)""",
    "forms_not_in_dictionary": f"WITH {_TOKENS}, {_FORMS} SELECT form, count(*) AS n FROM tok WHERE form NOT IN (SELECT form FROM frm) GROUP BY form",
    "forms_not_attested": f"WITH {_TOKENS}, {_FORMS} SELECT DISTINCT form FROM frm WHERE form NOT IN (SELECT form FROM tok)",
    "form_claimed_twice": f"""WITH {_FORMS} SELECT form, count(DISTINCT lemma_id) AS claims, string_agg(DISTINCT lemma_id, ';' ORDER BY lemma_id) AS lemmas
        FROM frm GROUP BY form HAVING count(DISTINCT lemma_id) > 1""",
    "coverage_by_source": f"""WITH {_TOKENS}, k AS (SELECT DISTINCT headword_key AS form FROM entries WHERE headword_key IS NOT NULL)
        SELECT source, count(*) AS tokens, sum(CASE WHEN k.form IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS covered,
        round(sum(CASE WHEN k.form IS NOT NULL THEN 1 ELSE 0 END) / count(*), 6) AS coverage FROM tok LEFT JOIN k USING (form) GROUP BY source""",
    "alphabet_counts": f"""WITH c AS (SELECT split_part(id, '-', 1)::INT AS leaf, unnest(regexp_extract_all(headword, '(?s).')) AS ch FROM entries WHERE headword IS NOT NULL),
        s AS (SELECT ch, {_DEALT} AS split FROM c)
        SELECT ch, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test,
        CASE WHEN count(*) FILTER (split = 'train') = 0 THEN 1 ELSE 0 END AS unseen FROM s GROUP BY ch""",
}
ORACLE["form_index"] = ORACLE["form_index"].replace(", pos FROM frm", " FROM frm")

ORACLE |= {
    "collation_sort": rf"""WITH l AS (SELECT DISTINCT lemma_id, lemma FROM dictionary_psv WHERE lemma IS NOT NULL),
        k AS (SELECT lemma_id, trim(lower(replace(regexp_replace(lemma, '\s*\([^)]*\)', '', 'g'), chr(769), '')), ' ') AS plain_key, regexp_replace(lower(lemma), '[^\p{{L}}]', '', 'g') AS letters FROM l),
        c AS (SELECT *, left(plain_key, 1) AS f, list_transform(string_split(letters, ''), lambda ch: CASE WHEN strpos('{_ALPHABET}', ch) > 0 THEN strpos('{_ALPHABET}', ch) ELSE 1000 END) AS ranks FROM k)
        SELECT lemma_id, plain_key, row_number() OVER (PARTITION BY f ORDER BY plain_key, lemma_id)::INT AS plain_place, row_number() OVER (PARTITION BY f ORDER BY ranks, lemma_id)::INT AS custom_place FROM c""",
}
