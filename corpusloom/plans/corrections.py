"""Corrections, line breaks of two witnesses, headword lists, renditions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import corrections as C
from corpusloom.operators import ordered as O
from corpusloom.session import table


def errata_parsed(spark, d):
    """Corrections told in the texts: page, line, from which end, what is printed and what to read."""
    return C.parsed(table(spark, d, "documents"), "text", ["doc_id"]).distinct()


def _paragraphs(spark, d):
    """Paragraphs by the page printed on their leaf, which is what corrections name; a leaf without a number has none."""
    m = table(spark, d, "manifest").select(F.col("idx").alias("leaf"), F.trim("printed_page").try_cast("int").alias("page"))
    m = m.groupBy("leaf").agg(F.max("page").alias("page")).where("page is not null")
    return table(spark, d, "paragraphs").groupBy("leaf", "para_id").agg(F.max("text_d").alias("t")).join(m, "leaf").select("page", "para_id", "t")


def errata_located(spark, d):
    """Corrections with the paragraph of the line they name, or the only one of the page that has the printed words."""
    p = _paragraphs(spark, d)
    lines = p.select("page", "para_id", F.posexplode(F.split("t", "\n")).alias("k", "line_text"))
    lines = lines.select("page", "para_id", F.concat("para_id", F.lpad(F.col("k").cast("string"), 4, "0")).alias("line_id"))
    found = C.located(errata_parsed(spark, d), lines, "page", "line_id", "para_id", p, "t")
    return found.select("doc_id", "page", "line", "below", "printed", "how", "found_in")


def filled_breaks(spark, d):
    """Line ends of the two texts paired: nearest ones that cross no other pair, and those between them in turn."""
    a, b = _breaks(spark, d, "text_merged", "m"), _breaks(spark, d, "text_d", "t")
    return C.filled_gaps(uncrossed_breaks(spark, d).select("para_id", "m", "t"), a, b, ["para_id"], "m", "t")


def _breaks(spark, d, column, name):
    p = table(spark, d, "paragraphs").groupBy("para_id").agg(F.max(column).alias("t")).where("t is not null")
    lengths = F.transform(F.slice(F.split("t", "\n"), 1, F.size(F.split("t", "\n")) - 1), F.length)
    w = Window.partitionBy("para_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    return p.select("para_id", F.posexplode(lengths).alias("k", "n")).select("para_id", (F.sum("n").over(w) + F.col("k")).cast("int").alias(name))


def break_agreement(spark, d):
    """Printed line ends that the voted text keeps: per leaf, how many of d's have one within two characters, and back."""
    a, b = _breaks(spark, d, "text_merged", "m"), _breaks(spark, d, "text_d", "t")
    one = O.nearest_within(a, b, ["para_id"], "m", "t", 2).select("para_id", F.lit("m").alias("of"), F.col("t").isNotNull().alias("hit"))
    two = O.nearest_within(b, a, ["para_id"], "t", "m", 2).select("para_id", F.lit("d").alias("of"), F.col("m").isNotNull().alias("hit"))
    every = one.unionByName(two).withColumn("leaf", F.split("para_id", "-")[0].cast("int"))
    return every.groupBy("leaf", "of").agg(F.count("*").alias("n"), F.sum(F.col("hit").cast("long")).alias("hits"))


def uncrossed_breaks(spark, d):
    """Pairs of line ends of the two texts, nearest within fifteen characters, that cross no other pair."""
    pairs = O.nearest_within(_breaks(spark, d, "text_merged", "m"), _breaks(spark, d, "text_d", "t"), ["para_id"], "m", "t", 15)
    return C.uncrossed(pairs, ["para_id"], "m", "t")


def head_lists(spark, d):
    """Heads of each leaf as the paragraphs have them against the entries' heads, aligned as lists."""
    at = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("id", c))), lambda x: x[c])
    e = table(spark, d, "entries").where("headword is not null").select("id", X.civil(F.col("headword")).alias("h")).distinct()
    p = table(spark, d, "paragraphs").select(F.col("para_id").alias("id"), X.civil(F.trim(F.split("text_merged", " = ")[0])).alias("r")).where("r is not null").distinct()
    both = e.join(p, "id").withColumn("leaf", F.split("id", "-")[0].cast("int"))
    return C.list_scores(both.groupBy("leaf").agg(at("h").alias("truth"), at("r").alias("read")), ["leaf"], "truth", "read")


def verdicts_applied(spark, d):
    """Paragraph starts by the entries' evidence where there is one, else by the layout, and which of them it was."""
    p = table(spark, d, "paragraphs").groupBy("para_id").agg(F.max("hanging").alias("hanging"))
    v = table(spark, d, "entries").select(F.col("id").alias("para_id"), F.lit(True).alias("verdict")).distinct()
    j = p.join(v, "para_id", "left")
    return j.select("para_id", F.coalesce("verdict", "hanging", F.lit(False)).alias("start"), F.when(F.col("verdict").isNotNull(), "CD").when(F.col("hanging").isNotNull(), "A").otherwise("").alias("seg"))


def markdown_sections(spark, d):
    """The dictionary as Markdown, a text for each letter: words in order, with parts of speech, glosses and counts."""
    counts = table(spark, d, "dictionary_psv").groupBy("lemma_id").agg(
        F.max("lemma").alias("lemma"), F.max(F.coalesce("pos", F.lit("?"))).alias("pos"), F.max(F.coalesce("ru", F.lit("—"))).alias("ru"), F.max(F.coalesce(F.size("forms"), F.lit(0))).alias("forms")
    )
    line = F.concat(F.lit("### "), "lemma", F.lit(" *"), "pos", F.lit("* — "), "ru", F.lit(" ("), F.col("forms").cast("string"), F.lit(")"))
    keyed = counts.where("lemma is not null").select(X.sort_key(F.col("lemma")).alias("k"), "lemma_id", line.alias("line")).withColumn("letter", F.upper(F.substring("k", 1, 1)))
    rows = F.array_sort(F.collect_list(F.struct("k", "lemma_id", "line")))
    return keyed.groupBy("letter").agg(F.concat(F.lit("## "), F.first("letter"), F.lit("\n"), F.array_join(F.transform(rows, lambda r: r["line"]), "\n")).alias("text"))


QUERIES = {f.__name__: f for f in (errata_parsed, errata_located, break_agreement, uncrossed_breaks, filled_breaks, head_lists, verdicts_applied, markdown_sections)}

_BREAKS = """{n}l AS (SELECT para_id, max({c}) AS t FROM paragraphs GROUP BY para_id), {n}r AS (SELECT para_id, unnest(range(length(t)))::INT AS x, t FROM {n}l WHERE t IS NOT NULL),
    {n} AS (SELECT para_id, x FROM {n}r WHERE substr(t, x + 1, 1) = chr(10))"""
_B = f"{_BREAKS.format(n='bm', c='text_merged')}, {_BREAKS.format(n='bd', c='text_d')}"

_NEAR = f"""{_B}, prs AS (SELECT para_id, m, t FROM (SELECT bm.para_id, bm.x AS m, bd.x AS t, row_number() OVER (PARTITION BY bm.para_id, bm.x ORDER BY abs(bm.x - bd.x), bd.x) AS k
    FROM bm JOIN bd ON bm.para_id = bd.para_id AND abs(bm.x - bd.x) <= 15) WHERE k = 1),
    unc AS (SELECT * FROM prs p WHERE NOT EXISTS (SELECT 1 FROM prs q WHERE q.para_id = p.para_id AND (q.m <> p.m OR q.t <> p.t) AND ((q.m <= p.m AND q.t >= p.t) OR (q.m >= p.m AND q.t <= p.t))))"""
_GAP = """g{n} AS (SELECT para_id, x, (SELECT count(*) FROM unc u WHERE u.para_id = b{n}.para_id AND u.{c} < x) AS gap FROM b{n} WHERE NOT EXISTS (SELECT 1 FROM unc u WHERE u.para_id = b{n}.para_id AND u.{c} = x)),
    n{n} AS (SELECT *, row_number() OVER (PARTITION BY para_id, gap ORDER BY x) AS k, count(*) OVER (PARTITION BY para_id, gap) AS n FROM g{n})"""

ORACLE = {
    "uncrossed_breaks": f"WITH {_NEAR} SELECT * FROM unc",
    "filled_breaks": f"""WITH {_NEAR}, {_GAP.format(n='m', c='m')}, {_GAP.format(n='d', c='t')}
        SELECT para_id, m, t, true AS anchored FROM unc UNION ALL SELECT a.para_id, a.x, b.x, false FROM nm a JOIN nd b USING (para_id, gap, k, n)""",
    "errata_parsed": r"""WITH x AS (SELECT doc_id, unnest(regexp_extract_all(text, 'Стран\. (\d+), строка (\d+)(?:—\d+)? (сверху|снизу): напечатано ([^,]+), слѣдуетъ читать ([^.]+)\.')) AS x FROM documents),
        y AS (SELECT doc_id, regexp_extract(x, 'Стран\. (\d+), строка (\d+)(?:—\d+)? (сверху|снизу): напечатано ([^,]+), слѣдуетъ читать ([^.]+)\.', ['a', 'b', 'c', 'd', 'e']) AS g FROM x)
        SELECT DISTINCT doc_id, g.a::INT AS page, g.b::INT AS line, g.c = 'снизу' AS below, g.d AS printed, g.e AS read FROM y""",
    "break_agreement": f"""WITH {_B}, e AS (SELECT bm.para_id, 'm' AS of, EXISTS (SELECT 1 FROM bd WHERE bd.para_id = bm.para_id AND abs(bd.x - bm.x) <= 2) AS hit FROM bm
        UNION ALL SELECT bd.para_id, 'd', EXISTS (SELECT 1 FROM bm WHERE bd.para_id = bm.para_id AND abs(bd.x - bm.x) <= 2) FROM bd)
        SELECT split_part(para_id, '-', 1)::INT AS leaf, of, count(*) AS n, count(*) FILTER (hit) AS hits FROM e GROUP BY ALL""",
    "verdicts_applied": """WITH p AS (SELECT para_id, max(hanging) AS hanging FROM paragraphs GROUP BY para_id)
        SELECT p.para_id, coalesce(e.id IS NOT NULL OR hanging, false) AS start, CASE WHEN e.id IS NOT NULL THEN 'CD' WHEN hanging IS NOT NULL THEN 'A' ELSE '' END AS seg
        FROM p LEFT JOIN (SELECT DISTINCT id FROM entries) e ON e.id = p.para_id""",
    "markdown_sections": r"""WITH c AS (SELECT lemma_id, max(lemma) AS lemma, max(coalesce(pos, '?')) AS pos, max(coalesce(ru, '—')) AS ru, max(coalesce(len(forms), 0)) AS forms FROM dictionary_psv GROUP BY lemma_id),
        k AS (SELECT trim(lower(replace(regexp_replace(lemma, '\s*\([^)]*\)', '', 'g'), chr(769), '')), ' ') AS k, lemma_id, '### ' || lemma || ' *' || pos || '* — ' || ru || ' (' || forms || ')' AS line FROM c WHERE lemma IS NOT NULL)
        SELECT upper(left(k, 1)) AS letter, '## ' || upper(left(k, 1)) || chr(10) || string_agg(line, chr(10) ORDER BY k, lemma_id) AS text FROM k GROUP BY upper(left(k, 1))""",
}
