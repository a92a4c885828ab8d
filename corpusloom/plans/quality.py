"""Validation, scores, flags and reports over the book's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import quality as Q
from corpusloom.session import table


def _entries(spark, d):
    return table(spark, d, "entries").distinct()


def reference_problems(spark, d):
    """Dictionary rows without a lemma or gloss, entries without a definition, disputes of unknown paragraphs, answers to
    unknown items."""
    psv, e = table(spark, d, "dictionary_psv").distinct(), _entries(spark, d)
    p, x, a = (table(spark, d, t) for t in ("paragraphs", "disputes", "dispute_labels"))
    return Q.problems(
        ("no gloss", psv.where("ru is null and en is null and nl is null"), F.col("lemma_id")),
        ("no head", e.where("headword is null or headword = ''"), F.col("id")),
        ("dispute without paragraph", x.join(p, "para_id", "left_anti"), F.col("item_id")),
        ("answer without dispute", a.join(x, "item_id", "left_anti").select("item_id").distinct(), F.col("item_id")),
    )


def flag_counts(spark, d):
    return Q.flag_counts(_entries(spark, d), F.split(F.coalesce("flags", F.lit("")), ";"))


def flag_examples(spark, d):
    """The first five entries of each flag and how many more there are."""
    e = _entries(spark, d).select("id", "headword_key", F.explode(F.split(F.coalesce("flags", F.lit("")), ";")).alias("flag")).where("flag != ''")
    return Q.top_per_group(e.select("id", "flag").distinct(), "flag", ["id"], 5)


def source_counts(spark, d):
    """Entries by part and source of the head, with totals of each and all (grouping sets)."""
    got = _entries(spark, d).cube("part", "hw_source").agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))
    return got.select(F.coalesce("part", F.lit("*")).alias("part"), F.coalesce("hw_source", F.lit("*")).alias("hw_source"), "level", "n")


def source_by_status(spark, d):
    """Counts of status by source of the head, and the share checked."""
    wide = _entries(spark, d).groupBy("hw_source").pivot("status", ["raw", "checked"]).count().na.fill(0)
    return wide.withColumn("share", F.round(F.col("checked") / (F.col("raw") + F.col("checked")), 6))


def head_agreement(spark, d):
    """Whether the civil head follows from the book's, against whether the key follows from the civil head."""
    e = _entries(spark, d).where("headword is not null")
    a = X.civil(F.col("headword")) == F.col("headword_civil")
    b = X.modern_key(F.col("headword_civil")) == F.col("headword_key")
    return Q.two_by_two(e, ["hw_source"], a, b)


def short_readings(spark, d):
    """Columns of a leaf where the voted text falls short of d."""
    p = table(spark, d, "paragraphs").groupBy("para_id", "leaf", "col").agg(F.max("text_d").alias("t"), F.max("text_merged").alias("m"))
    n = lambda c: F.sum(F.coalesce(F.length(c), F.lit(0)).cast("long"))
    lines = lambda c: F.sum(F.coalesce(F.length(c) - F.length(F.replace(F.col(c), F.lit("\n"))) + 1, F.lit(0)).cast("long"))
    sums = p.groupBy("leaf", "col").agg(lines("m").alias("lines"), lines("t").alias("ref_lines"), n("m").alias("chars"), n("t").alias("ref_chars"))
    return Q.short_of(sums, "lines", "ref_lines", "chars", "ref_chars")


def odd_paragraphs(spark, d):
    """Paragraphs whose two readings differ oddly in length."""
    p = table(spark, d, "paragraphs").select("para_id", F.length("text_d").alias("a"), F.length("text_merged").alias("b")).distinct()
    return p.where(Q.odd_lengths(F.col("a"), F.col("b")))


def cut_rates(spark, d):
    """How paragraphs were cut, how many characters the vote changed, and what stays disputed, per leaf."""
    p = table(spark, d, "paragraphs").select("para_id", "leaf", "d_cut", "fixed", F.size("disputed").alias("spans")).distinct()
    r = Q.rates(p, ["leaf"], {"line": F.col("d_cut") == "line", "aligned": F.col("d_cut") == "aligned", "forced": F.col("d_cut") == "forced", "clean": F.col("spans") == 0})
    sums = p.groupBy("leaf").agg(F.sum("fixed").alias("fixed"), F.sum(F.greatest("spans", F.lit(0)).cast("long")).alias("spans"))
    return r.join(sums, "leaf")


def gloss_checks(spark, d):
    """Lint of the dictionary: glosses of unequal number, mixed scripts, spaces that should not be."""
    p = table(spark, d, "dictionary_psv").select("lemma_id", "lemma", "ru", "en", "nl").distinct()
    n = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(F.split(F.col(c), "[,;] *")))
    checks = p.select("lemma_id", (n("en") != n("nl")).alias("unequal"), X.mixed_script(F.col("lemma")).alias("mixed"), (X.clean_spacing(F.col("lemma")) != F.col("lemma")).alias("spaces"))
    return checks.where(F.col("unequal") | F.col("mixed") | F.col("spaces"))


def leaf_report(spark, d):
    """Per leaf: entries, ditto heads, empty heads, heads to be read, definitions' letters, and the section."""
    e = _entries(spark, d).withColumn("leaf", F.split("id", "-")[0].cast("int"))
    yes = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    per = e.groupBy("leaf").agg(
        F.countDistinct("id").alias("entries"),
        yes(F.col("headword_key") == "тожде").alias("ditto"),
        yes(F.coalesce(F.col("headword"), F.lit("")) == "").alias("empty"),
        yes(F.col("flags").contains("hw_provisional")).alias("provisional"),
        F.sum(F.coalesce(F.regexp_count("definition", F.lit(r"\p{L}")), F.lit(0)).cast("long")).alias("letters"),
    )
    m = table(spark, d, "manifest").groupBy(F.col("idx").alias("leaf")).agg(F.max("section").alias("section"))
    return per.join(m, "leaf", "left").select("leaf", "section", "entries", "ditto", "empty", "provisional", "letters")


def label_accuracy(spark, d):
    """Per reader: answers, the share that equal the reading in the voted text."""
    p = table(spark, d, "paragraphs").groupBy("para_id").agg(F.max("text_merged").alias("t"))
    x = table(spark, d, "disputes").distinct().join(p, "para_id").withColumn("truth", F.substring("t", F.col("s") + 1, F.col("e") - F.col("s")))
    a = table(spark, d, "dispute_labels").select("item_id", F.regexp_replace(F.trim(F.lower("annotator")), " ", "-").alias("annotator"), F.trim(F.lower("label")).alias("label")).distinct()
    said = F.when(F.col("label") == "d", F.col("read_d")).when(F.col("label") == "b", F.col("read_b")).when(F.col("label") == "a", F.col("read_a"))
    return Q.rates(a.join(x, "item_id").withColumn("said", said).where("said is not null"), ["annotator"], {"same": F.col("said") == F.col("truth")})


QUERIES = {
    f.__name__: f
    for f in (reference_problems, flag_counts, flag_examples, source_counts, source_by_status, head_agreement, short_readings, odd_paragraphs, cut_rates, gloss_checks,
              leaf_report, label_accuracy)
}

_E = "e AS (SELECT DISTINCT * FROM entries)"
_FLAGS = f"{_E}, f AS (SELECT id, flag FROM (SELECT id, unnest(string_split(coalesce(flags, ''), ';')) AS flag FROM e) WHERE flag <> '')"
_PARAS = "p AS (SELECT para_id, leaf, col, max(text_d) AS t, max(text_merged) AS m FROM paragraphs GROUP BY ALL)"
_MIX = r"\p{Latin}\p{Greek}|\p{Latin}\p{Cyrillic}|\p{Greek}\p{Latin}|\p{Greek}\p{Cyrillic}|\p{Cyrillic}\p{Latin}|\p{Cyrillic}\p{Greek}"

ORACLE = {
    "reference_problems": """SELECT 'no gloss' AS what, lemma_id::VARCHAR AS which FROM (SELECT DISTINCT * FROM dictionary_psv) WHERE ru IS NULL AND en IS NULL AND nl IS NULL
        UNION ALL SELECT 'no head', id FROM (SELECT DISTINCT * FROM entries) WHERE headword IS NULL OR headword = ''
        UNION ALL SELECT 'dispute without paragraph', item_id FROM disputes WHERE para_id NOT IN (SELECT para_id FROM paragraphs)
        UNION ALL SELECT DISTINCT 'answer without dispute', item_id FROM dispute_labels WHERE item_id NOT IN (SELECT item_id FROM disputes)""",
    "flag_counts": f"WITH {_FLAGS} SELECT flag, count(*) AS n FROM f GROUP BY flag",
    "flag_examples": f"""WITH {_FLAGS}, g AS (SELECT DISTINCT id, flag FROM f), r AS (SELECT id, flag, row_number() OVER (PARTITION BY flag ORDER BY id)::INT AS place, greatest(count(*) OVER (PARTITION BY flag) - 5, 0) AS more FROM g)
        SELECT * FROM r WHERE place <= 5""",
    "source_counts": f"WITH {_E} SELECT coalesce(part, '*') AS part, coalesce(hw_source, '*') AS hw_source, grouping(part, hw_source)::INT AS level, count(*) AS n FROM e GROUP BY CUBE (part, hw_source)",
    "source_by_status": f"""WITH {_E} SELECT hw_source, count(*) FILTER (status = 'raw') AS raw, count(*) FILTER (status = 'checked') AS checked,
        round(count(*) FILTER (status = 'checked') / count(*) FILTER (status IN ('raw', 'checked')), 6) AS share FROM e GROUP BY hw_source""",
    "short_readings": f"""WITH {_PARAS}, s AS (SELECT leaf, col, sum(coalesce(length(m) - length(replace(m, chr(10), '')) + 1, 0))::BIGINT AS lines, sum(coalesce(length(t) - length(replace(t, chr(10), '')) + 1, 0))::BIGINT AS ref_lines,
        sum(coalesce(length(m), 0))::BIGINT AS chars, sum(coalesce(length(t), 0))::BIGINT AS ref_chars FROM p GROUP BY leaf, col)
        SELECT *, CASE WHEN ref_chars > 0 THEN round(chars / ref_chars, 6) END AS ratio, ref_lines - lines >= 1 AND chars < 0.985 * ref_chars AND ref_chars > 200 AS short FROM s""",
    "odd_paragraphs": "SELECT * FROM (SELECT DISTINCT para_id, length(text_d)::INT AS a, length(text_merged)::INT AS b FROM paragraphs) WHERE a >= 30 AND NOT (b / a BETWEEN 0.75 AND 1.35)",
    "cut_rates": """WITH p AS (SELECT DISTINCT para_id, leaf, d_cut, fixed, len(disputed) AS spans FROM paragraphs),
        s AS (SELECT leaf, count(*) AS n, count(*) FILTER (d_cut = 'line') AS line, count(*) FILTER (d_cut = 'aligned') AS aligned, count(*) FILTER (d_cut = 'forced') AS forced, count(*) FILTER (spans = 0) AS clean,
        sum(fixed)::BIGINT AS fixed, sum(coalesce(spans, 0))::BIGINT AS spans FROM p GROUP BY leaf)
        SELECT *, round(line / n, 6) AS line_rate, round(aligned / n, 6) AS aligned_rate, round(forced / n, 6) AS forced_rate, round(clean / n, 6) AS clean_rate FROM s""",
    "gloss_checks": rf"""WITH p AS (SELECT DISTINCT lemma_id, lemma, ru, en, nl FROM dictionary_psv),
        c AS (SELECT lemma_id, coalesce(len(regexp_split_to_array(en, '[,;] *')), 0) <> coalesce(len(regexp_split_to_array(nl, '[,;] *')), 0) AS unequal, regexp_matches(lemma, '{_MIX}') AS mixed,
        trim(regexp_replace(regexp_replace(regexp_replace(lemma, '\s+([.,;:!?)])', '\1', 'g'), '\(\s+', '(', 'g'), '\s+', ' ', 'g'), ' ') <> lemma AS spaces FROM p)
        SELECT * FROM c WHERE unequal OR mixed OR spaces""",
    "leaf_report": rf"""WITH {_E}, g AS (SELECT split_part(id, '-', 1)::INT AS leaf, count(DISTINCT id) AS entries, count(*) FILTER (headword_key = 'тожде') AS ditto, count(*) FILTER (coalesce(headword, '') = '') AS empty,
        count(*) FILTER (contains(flags, 'hw_provisional')) AS provisional, sum(coalesce(len(regexp_extract_all(definition, '\p{{L}}')), 0))::BIGINT AS letters FROM e GROUP BY 1),
        m AS (SELECT idx AS leaf, max(section) AS section FROM manifest GROUP BY idx) SELECT leaf, section, entries, ditto, empty, provisional, letters FROM g LEFT JOIN m USING (leaf)""",
    "label_accuracy": """WITH p AS (SELECT para_id, max(text_merged) AS t FROM paragraphs GROUP BY para_id), x AS (SELECT q.*, substr(t, s + 1, e - s) AS truth FROM (SELECT DISTINCT * FROM disputes) q JOIN p USING (para_id)),
        a AS (SELECT DISTINCT item_id, replace(trim(lower(annotator)), ' ', '-') AS annotator, trim(lower(label)) AS label FROM dispute_labels),
        j AS (SELECT annotator, CASE label WHEN 'd' THEN read_d WHEN 'b' THEN read_b WHEN 'a' THEN read_a END AS said, truth FROM a JOIN x USING (item_id))
        SELECT annotator, count(*) AS n, count(*) FILTER (said = truth) AS same, round(count(*) FILTER (said = truth) / count(*), 6) AS same_rate FROM j WHERE said IS NOT NULL GROUP BY annotator""",
}

_MODERN = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(replace(replace(lower(headword_civil), 'аѵ', 'ав'), 'еѵ', 'ев'), 'ѣіѳѵ', 'еифи'), 'ъ([\s\-,;])', '\1', 'g'), 'ъ$', ''), '[^\p{L}\p{N}_\s\-]', '', 'g'), '\s+', ' ', 'g'), ' ')"""
ORACLE |= {
    "head_agreement": f"""WITH e AS (SELECT DISTINCT * FROM entries), x AS (SELECT hw_source, coalesce({X.civil_sql('headword')} = headword_civil, false) AS a, coalesce({_MODERN} = headword_key, false) AS b FROM e WHERE headword IS NOT NULL)
        SELECT hw_source, count(*) FILTER (a AND b) AS "both", count(*) FILTER (a AND NOT b) AS only_a, count(*) FILTER (NOT a AND b) AS only_b, count(*) FILTER (NOT a AND NOT b) AS neither FROM x GROUP BY hw_source""",
}
