"""Sampling, splits, ledgers, and round trips through sources and sinks."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import functions as F

from corpusloom.operators import upkeep as U
from corpusloom.session import shared_dir, table
from corpusloom.sources import delimited as S


def split_counts(spark, d):
    """Entries by the split of their leaf."""
    e = table(spark, d, "entries").select("id", F.split("id", "-")[0].cast("int").alias("leaf")).distinct()
    return e.groupBy("leaf", U.split_of(F.col("leaf"), [45, 60, 117]).alias("split")).agg(F.count("*").alias("n"))


def bucket_sample(spark, d):
    """The eighth of a hundred CRC-32 buckets of the paragraphs: a sample that every run draws alike."""
    return U.bucket_sample(table(spark, d, "paragraphs").select("para_id").distinct(), F.col("para_id"), 100, 8)


def seeded_sample(spark, d):
    """A hundred entries for review, by the order of a hash with a seed."""
    return U.seeded_sample(table(spark, d, "entries").select("id").distinct(), "id", 17, 100)


def review_batches(spark, d):
    """Provisional heads not yet checked, in sheets of fifteen in the book's order."""
    e = table(spark, d, "entries").where("flags like '%hw_provisional%' and status = 'raw'").select("id").distinct()
    return U.batches(e, ["id"], 15, "sheet")


def stale_leaves(spark, d):
    """Leaves of the manifest whose status is missing or not the current one."""
    m = table(spark, d, "manifest").groupBy("idx").agg(F.max(F.when(F.col("status") == "text", 3).when(F.col("status") == "image", 2)).alias("version"))
    return U.work_list(m, "version", 3)


def answer_ledger(spark, d):
    """A ledger of answers after the same news came twice."""
    a = table(spark, d, "dispute_labels").select("label_id", "received_at", "item_id", "label")
    return U.ledger_merge(a, a, "label_id", "received_at")


def decoded_reviews(spark, d):
    """Disputes as review sheets with an answer of each kind, decoded."""
    x = table(spark, d, "disputes").select("item_id", "span_no", "read_d", "read_b", F.crc32("item_id").alias("h")).distinct()
    ans = F.array(*map(F.lit, ["", "a", "B ", "-", "иное"]))[(F.length("read_d") % 5).cast("int")]
    sheet = x.select(F.col("item_id").alias("id"), F.concat(F.lit("a: "), "read_d").alias("a"), F.concat(F.lit("b: "), "read_b").alias("b"), ans.alias("answer"))
    return S.decoded_answers(sheet)


def psv_round_trip(spark, d):
    """The dictionary as " | " lines and read again: the rows that came back."""
    p = table(spark, d, "dictionary_psv").distinct()
    cell = lambda c: F.trim(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"[|\s]+", " "))
    forms = F.array_join("forms", " ")
    parts = [cell("lemma"), cell("pos"), F.coalesce(forms, F.lit("")), cell("ru"), cell("en"), cell("nl"), cell("notes")]
    rows, errors = S.psv_rows(p.select(F.concat_ws(" | ", *parts).alias("value")))
    return rows.select("lemma", "pos", F.array_join("forms", ";").alias("forms"), "ru", "en", "nl", "notes").unionByName(
        errors.select(F.col("value").alias("lemma"), *[F.lit(None).cast("string").alias(c) for c in ("pos", "forms", "ru", "en", "nl", "notes")])
    )


def tsv_round_trip(spark, d):
    """The entries written as unquoted tab-separated text and read again."""
    path = f"{shared_dir(spark).rstrip('/')}/tsv-{spark.sparkContext.applicationId}-{md5(d.encode()).hexdigest()[:12]}"
    e = table(spark, d, "entries").select("id", "headword", "sep", "gram", "status").distinct()
    U.write_tsv(e, path)
    return S.read_tsv(spark, path, "id string, headword string, sep string, gram string, status string")


QUERIES = {
    f.__name__: f
    for f in (split_counts, bucket_sample, seeded_sample, review_batches, stale_leaves, answer_ledger, decoded_reviews, psv_round_trip, tsv_round_trip)
}

_CELL = r"trim(regexp_replace(coalesce({c}, ''), '[|\s]+', ' ', 'g'), ' ')"

ORACLE = {
    "split_counts": """WITH e AS (SELECT DISTINCT id, split_part(id, '-', 1)::INT AS leaf FROM entries)
        SELECT leaf, CASE WHEN leaf IN (45, 60, 117) THEN 'test' WHEN leaf % 20 = 7 THEN 'val' ELSE 'train' END AS split, count(*) AS n FROM e GROUP BY ALL""",
    "seeded_sample": "SELECT id FROM (SELECT DISTINCT id FROM entries) ORDER BY md5('17/' || id), id LIMIT 100",
    "review_batches": """SELECT id, ((row_number() OVER (ORDER BY id) - 1) // 15)::INT AS sheet FROM (SELECT DISTINCT id FROM entries WHERE flags LIKE '%hw_provisional%' AND status = 'raw')""",
    "stale_leaves": """WITH m AS (SELECT idx, max(CASE status WHEN 'text' THEN 3 WHEN 'image' THEN 2 END) AS version FROM manifest GROUP BY idx) SELECT * FROM m WHERE version IS DISTINCT FROM 3""",
    "answer_ledger": """SELECT label_id, received_at, item_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label_id ORDER BY received_at DESC, item_id DESC, label DESC NULLS LAST) AS k
        FROM (SELECT DISTINCT label_id, received_at, item_id, label FROM dispute_labels)) WHERE k = 1""",
    "decoded_reviews": """WITH x AS (SELECT DISTINCT item_id AS id, read_d AS a, read_b AS b, length(read_d) % 5 AS k FROM disputes)
        SELECT id, trim(a, ' ') AS a, trim(b, ' ') AS b, ['open', 'a', 'b', 'none', 'typed'][k + 1] AS how, CASE k WHEN 1 THEN trim(a, ' ') WHEN 2 THEN trim(b, ' ') WHEN 3 THEN '' WHEN 4 THEN 'иное' END AS chosen FROM x""",
    "psv_round_trip": f"""SELECT {_CELL.format(c='lemma')} AS lemma, {_CELL.format(c='pos')} AS pos, array_to_string(forms, ';') AS forms, {_CELL.format(c='ru')} AS ru, {_CELL.format(c='en')} AS en,
        {_CELL.format(c='nl')} AS nl, {_CELL.format(c='notes')} AS notes FROM (SELECT DISTINCT * FROM dictionary_psv)""",
    "tsv_round_trip": r"""SELECT id, regexp_replace(coalesce(headword, ''), '[\t\r\n]', ' ', 'g') AS headword, coalesce(sep, '') AS sep, regexp_replace(coalesce(gram, ''), '[\t\r\n]', ' ', 'g') AS gram, coalesce(status, '') AS status
        FROM (SELECT DISTINCT id, headword, sep, gram, status FROM entries)""",
}
