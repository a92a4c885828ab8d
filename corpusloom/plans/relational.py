"""Joins of every shape, set operations and cascades over the book's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import upkeep
from corpusloom.session import table

KINDS = ("exact", "verb", "soft")


def _entry_keys(spark: SparkSession, d: str) -> DataFrame:
    """id, key: every alternative of each entry's look-up key; empty keys are not indexed."""
    e = table(spark, d, "entries").select("id", "headword_key").where("headword_key != ''").distinct()
    return e.select("id", F.explode(X.head_alternatives(F.col("headword_key"))).alias("key"))


def _lemma_keys(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "dictionary_psv").select("lemma_id", "lemma", "pos").where("lemma is not null").distinct()
    keys = F.array_distinct(F.transform(X.lemma_alternatives(F.col("lemma")), lambda x: X.modern_key(X.civil(x))))
    return p.select("lemma_id", "pos", F.explode(keys).alias("key")).where("key != ''")


def link_cascade(spark, d):
    """Dictionary words linked to entries by the first level that has hits: the same key; a verb's other form, from either
    side; the soft key. Equi-joins, of which the best level per word is kept."""
    e, p = _entry_keys(spark, d), _lemma_keys(spark, d)
    level = lambda n: F.lit(n).alias("level")
    exact = p.join(e, "key").select("lemma_id", "id", level(0))
    there = p.select("lemma_id", F.explode(X.verb_forms(F.col("key"))).alias("key")).join(e, "key")
    back = e.select("id", F.explode(X.verb_forms(F.col("key"), head=True)).alias("key")).join(p, "key")
    verb = there.select("lemma_id", "id", level(1)).unionByName(back.select("lemma_id", "id", level(1)))
    soft = p.select("lemma_id", X.soft_key(F.col("key")).alias("key")).join(e.select("id", X.soft_key(F.col("key")).alias("key")), "key")
    every = exact.unionByName(verb).unionByName(soft.select("lemma_id", "id", level(2))).groupBy("lemma_id", "id").agg(F.min("level").alias("level"))
    best = every.groupBy("lemma_id").agg(F.min("level").alias("level"))
    found = every.join(best, ["lemma_id", "level"])
    return found.select("lemma_id", "id", F.array(*map(F.lit, KINDS))[F.col("level")].alias("match"))


def link_crosstab(spark, d):
    """Parts of speech by kind of match, with the share matched."""
    kinds = link_cascade(spark, d).select("lemma_id", "match").distinct()
    words = table(spark, d, "dictionary_psv").groupBy("lemma_id").agg(F.max(F.coalesce(F.lower(F.regexp_replace("pos", r"\?", "")), F.lit("-"))).alias("pos"))
    got = words.join(kinds, "lemma_id", "left").withColumn("match", F.coalesce("match", F.lit("none")))
    wide = got.groupBy("pos").pivot("match", ["exact", "verb", "soft", "none"]).count().na.fill(0)
    total = F.col("exact") + F.col("verb") + F.col("soft") + F.col("none")
    return wide.withColumn("matched", F.round(1 - F.col("none") / total, 6))


def linked_entries(spark, d):
    """The entries that some dictionary word links to (a semi join by a foreign set)."""
    ids = link_cascade(spark, d).select("id").distinct()
    return table(spark, d, "entries").select("id", "part", "page").join(ids, "id", "left_semi").distinct()


def work_list(spark, d):
    """Entries without a reading of a sound source, except those already raw-checked: the ones to do."""
    e = table(spark, d, "entries").select("id", "hw_source", "status").distinct()
    todo = e.where(~F.col("hw_source").eqNullSafe("vision") & ~F.col("hw_source").eqNullSafe("manual"))
    done = e.where("status = 'checked'").select("id")
    return todo.select("id").distinct().join(done, "id", "left_anti")


def entry_pages(spark, d):
    """Entries with the printed page and letter of their leaf."""
    m = table(spark, d, "manifest").groupBy(F.col("idx").alias("leaf")).agg(F.max("printed_page").alias("printed_page"), F.max("section").alias("section"), F.max("letter").alias("letter"))
    e = table(spark, d, "entries").select("id", F.split("id", "-")[0].cast("int").alias("leaf")).distinct()
    return e.join(m, "leaf", "left").select("id", "leaf", "printed_page", "section", "letter")


def section_counts(spark, d):
    """Entries of the main part and the supplement by section of their leaf, with subtotals and the total."""
    e = entry_pages(spark, d).where(F.col("section").isin("main", "supplement"))
    got = e.rollup("section", "letter").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))
    return got.select(F.coalesce("section", F.lit("*")).alias("section"), F.when(F.col("level") > 0, "*").otherwise(F.coalesce("letter", F.lit(""))).alias("letter"), F.col("level").cast("int"), "n")


def letter_ranges(spark, d):
    """The first and last leaf of every letter of a section, from the manifest's comma lists."""
    m = table(spark, d, "manifest").select("idx", "section", F.explode(F.split(F.coalesce("letter", F.lit("")), r"\s*,\s*")).alias("letter"))
    return m.where("letter != ''").groupBy("section", "letter").agg(F.min("idx").alias("lo"), F.max("idx").alias("hi"))


def letters_on_leaf(spark, d):
    """Every leaf with the letters whose range holds it. Leaves are bounded intervals' points: ranges are unfolded into
    leaves, so that this is an equi join."""
    r = letter_ranges(spark, d).select("section", "letter", F.explode(F.sequence("lo", "hi")).alias("idx"))
    leaves = table(spark, d, "manifest").select("idx", "section").distinct()
    joined = leaves.join(r, ["idx", "section"])
    return joined.groupBy("idx", "section").agg(F.array_join(F.array_sort(F.collect_set("letter")), ",").alias("letters"))


def paragraph_entries(spark, d):
    """Paragraphs with the entry that begins there; without one, NULLs."""
    e = table(spark, d, "entries").groupBy("id").agg(F.max("headword").alias("headword"), F.max("status").alias("status"))
    p = table(spark, d, "paragraphs").select("para_id", "leaf", "col", "para").distinct()
    return p.join(e, p.para_id == e.id, "left").select("para_id", "leaf", "col", "para", "headword", "status")


def current_answers(spark, d):
    """Each reader's latest answer to each item, in one spelling."""
    labels = table(spark, d, "dispute_labels").select(
        "item_id", F.regexp_replace(F.trim(F.lower("annotator")), " ", "-").alias("annotator"), F.trim(F.lower("label")).alias("label"), "labelled_at", "label_id"
    )
    last = F.max_by("label", F.struct("labelled_at", "label_id")).alias("label")
    return labels.groupBy("item_id", "annotator").agg(last, F.max("labelled_at").alias("labelled_at"))


def first_seen_keys(spark, d):
    """Distinct look-up keys in the book's order of first appearance within their leaf."""
    e = table(spark, d, "entries").where("headword_key is not null and headword_key != ''").select("id", "headword_key", F.split("id", "-")[0].cast("int").alias("leaf")).distinct()
    w = Window.partitionBy("leaf", "headword_key").orderBy("id")
    first = e.withColumn("k", F.row_number().over(w)).where("k = 1")
    return first.select("leaf", "headword_key", "id", F.row_number().over(Window.partitionBy("leaf").orderBy("id")).alias("place"))


def entry_set_checks(spark, d):
    """Entries without a paragraph and paragraphs without an entry."""
    e, p = table(spark, d, "entries").select("id").distinct(), table(spark, d, "paragraphs").select(F.col("para_id").alias("id")).distinct()
    return e.exceptAll(p).withColumn("what", F.lit("entry only")).unionByName(p.exceptAll(e).withColumn("what", F.lit("paragraph only")))


def start_overlap(spark, d):
    """Per leaf: paragraphs that hang, entries, both; precision and recall of hanging as a sign of an entry start."""
    p = table(spark, d, "paragraphs").select("para_id", "leaf", "hanging").groupBy("para_id", "leaf").agg(F.max("hanging").alias("hanging"))
    e = table(spark, d, "entries").select(F.col("id").alias("para_id"), F.lit(1).alias("is_entry")).distinct()
    j = p.join(e, "para_id", "left")
    said, truth = F.sum(F.coalesce("hanging", F.lit(False)).cast("long")), F.sum(F.coalesce("is_entry", F.lit(0)).cast("long"))
    hit = F.sum((F.coalesce("hanging", F.lit(False)) & F.col("is_entry").isNotNull()).cast("long"))
    out = j.groupBy("leaf").agg(said.alias("said"), truth.alias("truth"), hit.alias("hit"))
    return out.withColumn("precision", F.round(F.when(F.col("said") > 0, F.col("hit") / F.col("said")), 6)).withColumn("recall", F.round(F.when(F.col("truth") > 0, F.col("hit") / F.col("truth")), 6))


def rows_side_by_side(spark, d):
    """The k-th disputed span of a paragraph beside the k-th dispute of it, for paragraphs that have as many of both."""
    p = table(spark, d, "paragraphs").select("para_id", "disputed").where("disputed is not null").distinct()
    spans = p.select("para_id", F.size("disputed").alias("n"), F.posexplode("disputed").alias("k", "span"))
    w = Window.partitionBy("para_id")
    q = table(spark, d, "disputes").select("para_id", "item_id", F.col("s").alias("s2"), F.col("e").alias("e2")).distinct()
    q = q.withColumn("k", F.row_number().over(w.orderBy("s2", "item_id")) - 1).withColumn("n", F.count("*").over(w).cast("int"))
    both = spans.join(q, ["para_id", "k", "n"])
    return both.select("para_id", "k", "item_id", F.col("span")[0].alias("s"), F.col("span")[1].alias("e"), "s2", "e2")


def upserted_orders(spark, d):
    """Orders read again, where a priority that was known stays: an upsert that keeps a column of the old rows."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    old = orders.where("o_orderstatus != 'P'")
    new = orders.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 3 == 0, F.lit("9-NEW")))
    return upkeep.upsert(old, new, ["o_orderkey"], ["o_orderpriority"])


def replaced_leaves(spark, d):
    """Paragraph texts where the leaves read again replace all rows of those leaves."""
    p = table(spark, d, "paragraphs").select("para_id", "leaf", "text_d").distinct()
    new = p.where("leaf % 10 = 3 and text_d is not null").select("para_id", "leaf", F.upper("text_d").alias("text_d"))
    return upkeep.replaced(p, new, ["leaf"])


def all_samples(spark, d):
    """Training rows of several kinds in one table."""
    e = table(spark, d, "entries").select("id", "headword", "hw_source", F.length("headword").alias("n"), F.split("id", "-")[0].cast("int").alias("leaf")).distinct()
    kinds = [("checked", "hw_source = 'manual'"), ("agree", "hw_source = 'vision' and n >= 4"), ("cont", "n >= 30")]
    parts = [e.where(cond).select("id", F.lit(kind).alias("kind"), "headword", upkeep.split_of(F.col("leaf"), [45, 60]).alias("split")) for kind, cond in kinds]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES = {
    f.__name__: f
    for f in (link_cascade, link_crosstab, linked_entries, work_list, entry_pages, section_counts, letter_ranges, letters_on_leaf, paragraph_entries, current_answers,
              first_seen_keys, entry_set_checks, start_overlap, rows_side_by_side, upserted_orders, replaced_leaves, all_samples)
}

_LEAF = "split_part(id, '-', 1)::INT"
_EK = r"""eh AS (SELECT DISTINCT id, headword_key AS k FROM entries WHERE headword_key <> ''),
    ep AS (SELECT id, trim(unnest(regexp_split_to_array(k, ',\s*|\s+или\s+|\s+и\s+')), ' ') AS key FROM eh),
    ek AS (SELECT id, k AS key FROM eh UNION SELECT id, key FROM ep WHERE key <> '' AND NOT starts_with(key, '-'))"""
_CIVIL = X.civil_sql("x")
_MODERN = rf"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(replace(replace(lower({_CIVIL}), 'аѵ', 'ав'), 'еѵ', 'ев'), 'ѣіѳѵ', 'еифи'), 'ъ([\s\-,;])', '\1', 'g'), 'ъ$', ''), '[^\p{{L}}\p{{N}}_\s\-]', '', 'g'), '\s+', ' ', 'g'))"""
_LK = rf"""la AS (SELECT DISTINCT lemma_id, pos, lemma, regexp_split_to_array(regexp_replace(lemma, '\s*\([^)]*\)\s*$', ''), ',\s*') AS parts FROM dictionary_psv WHERE lemma IS NOT NULL),
    lp AS (SELECT lemma_id, pos, trim(unnest(parts), ' ') AS p FROM la),
    lx AS (SELECT lemma_id, pos, p AS x FROM lp WHERE p <> '' AND NOT ends_with(p, '(ся)') UNION SELECT lemma_id, pos, unnest([left(p, length(p) - 4) || 'ся', left(p, length(p) - 4)]) FROM lp WHERE ends_with(p, '(ся)')
    UNION SELECT lemma_id, pos, lemma FROM la WHERE len(list_filter(parts, lambda y: trim(y, ' ') <> '')) = 0),
    lk AS (SELECT DISTINCT lemma_id, pos, {_MODERN} AS key FROM lx), pk AS (SELECT * FROM lk WHERE key <> '')"""
# the forms of a key x: its stem st (without -ти), its root ro (without the last letter), its tail (-ся)
_FORMS = r"""SELECT {i}, x || tail AS key FROM (SELECT {i}, tail, unnest(list_filter([
    CASE WHEN ti AND regexp_matches(st, '[ое]ва$') THEN left(st, length(st) - 3) || 'ую' END, CASE WHEN ti AND regexp_matches(st, '[иеая]$') THEN left(st, length(st) - 1) || 'ю' END,
    CASE WHEN ti AND regexp_matches(st, '[иеая]$') THEN left(st, length(st) - 1) || 'у' END, CASE WHEN ti AND ends_with(st, 'ну') THEN st END, CASE WHEN ti THEN st || 'ю' END{back}], lambda v: v IS NOT NULL)) AS x
    FROM (SELECT *, ends_with(b, 'ти') AS ti, regexp_replace(b, 'ти$', '') AS st, left(b, length(b) - 1) AS ro FROM (SELECT {i}, regexp_replace(key, 'с[яѧ]$', '') AS b, CASE WHEN regexp_matches(key, 'с[яѧ]$') THEN 'ся' ELSE '' END AS tail FROM {t})))"""
_BACK = "".join(f", CASE WHEN NOT ti AND regexp_matches(b, '[юу]$') THEN ro || '{v}ти' END" for v in "иаея") + ", CASE WHEN NOT ti AND ends_with(b, 'ую') THEN left(b, length(b) - 2) || 'овати' END"
_VERB = f"vk AS ({_FORMS.format(i='lemma_id', t='pk', back='')}), bk AS ({_FORMS.format(i='id', t='ek', back=_BACK)})"
_SOFT = "translate(key, 'йьъ', 'и')"
_LINK = f"""{_EK}, {_LK}, {_VERB}, every AS (
    SELECT lemma_id, id, 0 AS level FROM pk JOIN ek USING (key) UNION ALL SELECT lemma_id, id, 1 FROM vk JOIN ek USING (key) UNION ALL SELECT lemma_id, id, 1 FROM pk JOIN bk USING (key)
    UNION ALL SELECT a.lemma_id, b.id, 2 FROM (SELECT lemma_id, {_SOFT} AS key FROM pk) a JOIN (SELECT id, {_SOFT} AS key FROM ek) b USING (key)),
    best AS (SELECT lemma_id, min(level) AS level FROM every GROUP BY lemma_id),
    link AS (SELECT DISTINCT lemma_id, id, CASE level WHEN 0 THEN 'exact' WHEN 1 THEN 'verb' ELSE 'soft' END AS match FROM every JOIN best USING (lemma_id, level))"""
_PAGES = f"""m AS (SELECT idx AS leaf, max(printed_page) AS printed_page, max(section) AS section, max(letter) AS letter FROM manifest GROUP BY idx),
    ep AS (SELECT e.id, e.leaf, printed_page, section, letter FROM (SELECT DISTINCT id, {_LEAF} AS leaf FROM entries) e LEFT JOIN m USING (leaf))"""
_LETTERS = r"""r AS (SELECT section, letter, min(idx) AS lo, max(idx) AS hi FROM (SELECT idx, section, unnest(regexp_split_to_array(letter, '\s*,\s*')) AS letter FROM manifest WHERE letter IS NOT NULL)
    WHERE letter <> '' GROUP BY section, letter)"""

ORACLE = {
    "link_cascade": f"WITH {_LINK} SELECT * FROM link",
    "link_crosstab": f"""WITH {_LINK}, w AS (SELECT lemma_id, max(coalesce(lower(replace(pos, '?', '')), '-')) AS pos FROM dictionary_psv GROUP BY lemma_id),
        g AS (SELECT pos, coalesce(match, 'none') AS match FROM w LEFT JOIN (SELECT DISTINCT lemma_id, match FROM link) USING (lemma_id))
        SELECT pos, count(*) FILTER (match = 'exact') AS exact, count(*) FILTER (match = 'verb') AS verb, count(*) FILTER (match = 'soft') AS soft,
        count(*) FILTER (match = 'none') AS none, round(1 - count(*) FILTER (match = 'none') / count(*), 6) AS matched FROM g GROUP BY pos""",
    "linked_entries": f"WITH {_LINK} SELECT DISTINCT id, part, page FROM entries WHERE id IN (SELECT id FROM link)",
    "work_list": """SELECT DISTINCT id FROM entries WHERE hw_source IS DISTINCT FROM 'vision' AND hw_source IS DISTINCT FROM 'manual'
        AND id NOT IN (SELECT id FROM entries WHERE status = 'checked')""",
    "entry_pages": f"WITH {_PAGES} SELECT * FROM ep",
    "section_counts": f"""WITH {_PAGES} SELECT coalesce(section, '*') AS section, CASE WHEN grouping(section, letter) > 0 THEN '*' ELSE coalesce(letter, '') END AS letter,
        grouping(section, letter)::INT AS level, count(*) AS n FROM ep WHERE section IN ('main', 'supplement') GROUP BY ROLLUP (section, letter)""",
    "letter_ranges": f"WITH {_LETTERS} SELECT * FROM r",
    "letters_on_leaf": f"""WITH {_LETTERS} SELECT m.idx, m.section, string_agg(DISTINCT r.letter, ',' ORDER BY r.letter) AS letters
        FROM (SELECT DISTINCT idx, section FROM manifest) m JOIN r ON r.section = m.section AND m.idx BETWEEN lo AND hi GROUP BY m.idx, m.section""",
    "paragraph_entries": """SELECT p.*, headword, status FROM (SELECT DISTINCT para_id, leaf, col, para FROM paragraphs) p
        LEFT JOIN (SELECT id, max(headword) AS headword, max(status) AS status FROM entries GROUP BY id) e ON e.id = p.para_id""",
    "current_answers": """SELECT item_id, annotator, label, labelled_at FROM (SELECT *, row_number() OVER (PARTITION BY item_id, annotator ORDER BY labelled_at DESC, label_id DESC) AS k
        FROM (SELECT item_id, replace(trim(lower(annotator)), ' ', '-') AS annotator, trim(lower(label)) AS label, labelled_at, label_id FROM dispute_labels)) WHERE k = 1""",
    "first_seen_keys": f"""WITH e AS (SELECT {_LEAF} AS leaf, headword_key, min(id) AS id FROM entries WHERE headword_key <> '' GROUP BY 1, 2)
        SELECT leaf, headword_key, id, row_number() OVER (PARTITION BY leaf ORDER BY id)::INT AS place FROM e""",
    "entry_set_checks": """(SELECT DISTINCT id, 'entry only' AS what FROM entries WHERE id NOT IN (SELECT para_id FROM paragraphs))
        UNION ALL (SELECT DISTINCT para_id, 'paragraph only' FROM paragraphs WHERE para_id NOT IN (SELECT id FROM entries))""",
    "start_overlap": """WITH j AS (SELECT p.leaf, coalesce(p.hanging, false) AS h, e.id IS NOT NULL AS t FROM (SELECT para_id, leaf, max(hanging) AS hanging FROM paragraphs GROUP BY ALL) p
        LEFT JOIN (SELECT DISTINCT id FROM entries) e ON e.id = p.para_id), s AS (SELECT leaf, sum(h::INT)::BIGINT AS said, sum(t::INT)::BIGINT AS truth, sum((h AND t)::INT)::BIGINT AS hit FROM j GROUP BY leaf)
        SELECT *, round(CASE WHEN said > 0 THEN hit / said END, 6) AS precision, round(CASE WHEN truth > 0 THEN hit / truth END, 6) AS recall FROM s""",
    "rows_side_by_side": """WITH p AS (SELECT DISTINCT para_id, disputed FROM paragraphs WHERE disputed IS NOT NULL),
        a AS (SELECT para_id, len(disputed) AS n, unnest(range(len(disputed)))::INT AS k, unnest(disputed) AS span FROM p),
        b AS (SELECT *, row_number() OVER (PARTITION BY para_id ORDER BY s2, item_id) - 1 AS k, count(*) OVER (PARTITION BY para_id) AS n
        FROM (SELECT DISTINCT para_id, item_id, s AS s2, e AS e2 FROM disputes))
        SELECT a.para_id, a.k, item_id, span[1] AS s, span[2] AS e, s2, e2 FROM a JOIN b ON a.para_id = b.para_id AND a.k = b.k AND a.n = b.n""",
    "upserted_orders": """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority WHEN o_orderkey % 3 = 0 THEN '9-NEW' END AS o_orderpriority FROM orders""",
    "replaced_leaves": """WITH p AS (SELECT DISTINCT para_id, leaf, text_d FROM paragraphs), n AS (SELECT para_id, leaf, upper(text_d) AS text_d FROM p WHERE leaf % 10 = 3 AND text_d IS NOT NULL)
        SELECT * FROM p WHERE leaf NOT IN (SELECT leaf FROM n) UNION ALL SELECT * FROM n""",
    "all_samples": f"""WITH e AS (SELECT DISTINCT id, headword, hw_source, {_LEAF} AS leaf, CASE WHEN {_LEAF} IN (45, 60) THEN 'test' WHEN {_LEAF} % 20 = 7 THEN 'val' ELSE 'train' END AS split FROM entries)
        SELECT id, 'checked' AS kind, headword, split FROM e WHERE hw_source = 'manual' UNION ALL SELECT id, 'agree', headword, split FROM e WHERE hw_source = 'vision' AND length(headword) >= 4
        UNION ALL SELECT id, 'cont', headword, split FROM e WHERE length(headword) >= 30""",
}
