"""Ordered scans: islands, sessions, opened groups, reach cuts, nearest within a tolerance, longest ordered run."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import ordered as O
from corpusloom.session import table


def _leaves(spark, d):
    return table(spark, d, "entries").select(F.split("id", "-")[0].cast("int").alias("leaf"), F.col("hw_source").alias("source")).distinct()


def leaf_islands(spark, d):
    """Runs of consecutive leaves that have an entry of each source."""
    return O.islands(_leaves(spark, d), ["source"], "leaf").select("source", "lo", "hi", "n")


def leaf_ranges(spark, d):
    return O.compact_ranges(_leaves(spark, d), ["source"], "leaf")


def range_list_expand(spark, d):
    """The compact lists unfolded again."""
    return leaf_ranges(spark, d).select("source", F.explode(X.range_list(F.col("ranges"))).alias("leaf"))


def event_sessions(spark, d):
    """Sessions of a user's events, a new one after a gap of 30 minutes."""
    s = O.sessions(table(spark, d, "events"), ["user_id"], "ts", "event_id", 1800.0)
    return s.groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("ts").alias("began"), F.max("ts").alias("ended"))


def event_bands(spark, d):
    """Bands of a user's events as intervals (value seconds long): a new one where nothing before reaches."""
    e = table(spark, d, "events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("lo"), "value")
    e = e.withColumn("hi", F.col("lo") + F.round(F.col("value") * 100).cast("long") * 10_000_000)
    bands = O.reach_cuts(e, ["user_id"], "lo", "hi", F.lit(3_000_000))
    return bands.groupBy("user_id", "band").agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def group_assembly(spark, d):
    """Paragraphs of a column as entries: a hanging one opens an entry, the others go on with it."""
    p = table(spark, d, "paragraphs").groupBy("para_id", "leaf", "col", "para").agg(F.max("hanging").alias("hanging"), F.max("text_d").alias("text_d"))
    g = O.opened_groups(p, ["leaf", "col"], ["para"], F.coalesce("hanging", F.lit(False)))
    ordered = F.array_sort(F.collect_list(F.struct("para", F.coalesce("text_d", F.lit("")).alias("t"))))
    return g.groupBy("leaf", "col", "grp").agg(F.count("*").alias("n"), F.array_join(F.transform(ordered, lambda x: x["t"]), " ").alias("text"))


def paragraph_ranks(spark, d):
    """Paragraphs counted from the top and from the bottom of their column."""
    p = table(spark, d, "paragraphs").select("leaf", "col", "para").distinct()
    return O.ranks_both_ways(p, ["leaf", "col"], "para")


def clamped_spans(spark, d):
    """Starts of the disputed spans of a leaf, clamped so that they never fall within a paragraph's order."""
    s = table(spark, d, "disputes").select("para_id", "span_no", "s", "e").distinct()
    return O.clamped(s, ["para_id"], ["span_no"], "e", "until")


def section_changes(spark, d):
    """Leaves where the section or the letter differs from the leaf before. The order is cut into hundreds of leaves; the
    first of a hundred is compared with the last leaf of the hundred before that has any."""
    m = table(spark, d, "manifest").groupBy("idx").agg(F.max("section").alias("section"), F.max("letter").alias("letter")).where("idx is not null")
    m = m.withColumn("hundred", F.floor(F.col("idx") / 100).cast("int")).withColumn("own", F.struct("section", "letter"))
    ends = m.groupBy("hundred").agg(F.max_by("own", "idx").alias("end"))
    ends = ends.select("hundred", F.lag("end").over(Window.orderBy("hundred")).alias("carried"))  # a row per hundred leaves
    was = F.coalesce(F.lag("own").over(Window.partitionBy("hundred").orderBy("idx")), F.col("carried"))
    new = m.join(ends, "hundred").withColumn("was", was).where("was is not null and not (section <=> was.section and letter <=> was.letter)")
    return new.select("idx", "section", "letter", F.col("was.section").alias("before"), F.col("was.letter").alias("letter_before"))


def nearest_error(spark, d):
    """Each click with the nearest error of the same user within ten minutes (in whole seconds)."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("t"))
    clicks = e.where("event_type = 'click'").select("event_id", "user_id", F.col("t").alias("at"))
    errors = e.where("event_type = 'error'").select("user_id", F.col("t").alias("error_at")).distinct()
    return O.nearest_within(clicks, errors, ["user_id"], "at", "error_at", 600).select("event_id", "user_id", "at", "error_at")


def nearest_span(spark, d):
    """Each disputed span's start with the nearest printed line end (a line break in text_d) within 15 characters."""
    s = table(spark, d, "disputes").select("item_id", "para_id", F.col("s").alias("at")).distinct()
    p = table(spark, d, "paragraphs").where("text_d is not null").select("para_id", "text_d").distinct()
    places = F.transform(F.slice(F.split("text_d", "\n"), 1, F.size(F.split("text_d", "\n")) - 1), F.length)
    ends = p.select("para_id", F.posexplode(places).alias("k", "n"))
    w = Window.partitionBy("para_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.select("para_id", (F.sum("n").over(w) + F.col("k")).cast("int").alias("line_end"))
    return O.nearest_within(s, ends, ["para_id"], "at", "line_end", 15).select("item_id", "para_id", "at", "line_end")


def head_cut(spark, d):
    """The word of each definition in which its twentieth letter lies, and how far into it."""
    e = table(spark, d, "entries").where("definition is not null").select("id", "definition").distinct()
    words = e.select("id", F.posexplode(F.regexp_extract_all("definition", F.lit(r"\p{L}+"), F.lit(0))).alias("k", "word"))
    w = Window.partitionBy("id").orderBy("k")
    run = words.withColumn("until", F.sum(F.length("word")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    first = run.where("until >= 20").withColumn("r", F.row_number().over(w)).where("r = 1")
    return first.select("id", "k", "word", (20 - (F.col("until") - F.length("word"))).cast("int").alias("into"))


def order_flags(spark, d):
    """Entries whose civil head breaks the alphabetical order: not in the longest ordered run of their part of the book. Ditto
    heads, which say nothing of the order, are left out."""
    e = table(spark, d, "entries").where("headword_civil is not null and headword_civil != '' and coalesce(headword_key, '') != 'тожде'")
    e = e.groupBy("id", "part").agg(F.max("headword_civil").alias("headword_civil"))
    place = F.transform(F.split("id", "-"), lambda x: x.try_cast("int"))  # leaves have four digits or more: not the order of the text
    keyed = e.select("id", "part", X.collation_key(F.col("headword_civil")).alias("key"), place.alias("place"))
    return O.out_of_order(keyed, "part", ["place", "id"], "key").where("not in_order").select("id", "part")


def line_start_scores(spark, d):
    """A naive-Bayes score that a paragraph starts an entry, from its own and the former paragraph's text."""
    from corpusloom.operators.geometry import log_odds

    p = table(spark, d, "paragraphs").groupBy("para_id", "leaf", "col", "para").agg(F.max("hanging").alias("hanging"), F.max("text_merged").alias("t"))
    w = Window.partitionBy("leaf", "col").orderBy("para")
    p = p.withColumn("before", F.lag("t").over(w))
    score = log_odds([
        (F.col("hanging"), 2.0, -2.5),
        (F.col("before").rlike(r"[.!?]$"), 1.0, -1.5),
        (F.col("t").rlike("^[А-ЯЅꙀѠІ]"), 1.5, -3.0),
        (F.col("t").contains("="), 1.25, -0.75),
    ])
    return p.select("para_id", score.alias("score"))


QUERIES = {
    f.__name__: f
    for f in (leaf_islands, leaf_ranges, range_list_expand, event_sessions, event_bands, group_assembly, paragraph_ranks, clamped_spans, section_changes,
              nearest_error, nearest_span, head_cut, order_flags, line_start_scores)
}

_LEAVES = "l AS (SELECT DISTINCT split_part(id, '-', 1)::INT AS leaf, hw_source AS source FROM entries)"
_RUNS = f"{_LEAVES}, r AS (SELECT source, leaf, leaf - row_number() OVER (PARTITION BY source ORDER BY leaf) AS run FROM l), i AS (SELECT source, min(leaf) AS lo, max(leaf) AS hi, count(*) AS n FROM r GROUP BY source, run)"
_PARA = "p AS (SELECT para_id, leaf, col, para, max(hanging) AS hanging, max(text_d) AS text_d, max(text_merged) AS t FROM paragraphs GROUP BY ALL)"

ORACLE = {
    "leaf_islands": f"WITH {_RUNS} SELECT * FROM i",
    "leaf_ranges": f"WITH {_RUNS} SELECT source, string_agg(CASE WHEN lo = hi THEN lo::VARCHAR ELSE lo || '-' || hi END, ',' ORDER BY lo) AS ranges FROM i GROUP BY source",
    "range_list_expand": f"WITH {_LEAVES} SELECT source, leaf FROM l",
    "event_sessions": """WITH m AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > 1800000000 THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM m)
        SELECT user_id, session, count(*) AS n, min(ts) AS began, max(ts) AS ended FROM s GROUP BY user_id, session""",
    "event_bands": """WITH e AS (SELECT user_id, epoch_us(ts) AS lo, epoch_us(ts) + round(value * 100)::BIGINT * 10000000 AS hi FROM events),
        m AS (SELECT *, CASE WHEN lo > max(hi) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 3000000 THEN 1 ELSE 0 END AS c FROM e),
        b AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING)::BIGINT AS band FROM m)
        SELECT user_id, band, count(*) AS n, min(lo) AS lo, max(hi) AS hi FROM b GROUP BY user_id, band""",
    "group_assembly": f"""WITH {_PARA}, g AS (SELECT *, sum(coalesce(hanging, false)::INT) OVER (PARTITION BY leaf, col ORDER BY para ROWS UNBOUNDED PRECEDING)::BIGINT AS grp FROM p)
        SELECT leaf, col, grp, count(*) AS n, string_agg(coalesce(text_d, ''), ' ' ORDER BY para) AS text FROM g GROUP BY leaf, col, grp""",
    "paragraph_ranks": """SELECT *, row_number() OVER (PARTITION BY leaf, col ORDER BY para)::INT AS from_top, row_number() OVER (PARTITION BY leaf, col ORDER BY para DESC)::INT AS from_bottom
        FROM (SELECT DISTINCT leaf, col, para FROM paragraphs)""",
    "clamped_spans": "SELECT *, max(e) OVER (PARTITION BY para_id ORDER BY span_no ROWS UNBOUNDED PRECEDING) AS until FROM (SELECT DISTINCT para_id, span_no, s, e FROM disputes)",
    "section_changes": """WITH m AS (SELECT idx, max(section) AS section, max(letter) AS letter FROM manifest WHERE idx IS NOT NULL GROUP BY idx),
        w AS (SELECT *, lag(section) OVER x AS before, lag(letter) OVER x AS letter_before, row_number() OVER x AS k FROM m WINDOW x AS (ORDER BY idx))
        SELECT idx, section, letter, before, letter_before FROM w WHERE k > 1 AND (section IS DISTINCT FROM before OR letter IS DISTINCT FROM letter_before)""",
    "nearest_error": """WITH e AS (SELECT event_id, user_id, event_type, epoch_us(ts) // 1000000 AS t FROM events),
        c AS (SELECT a.event_id, a.user_id, a.t AS "at", b.t AS error_at, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(a.t - b.t), b.t) AS k
        FROM e a LEFT JOIN e b ON a.user_id = b.user_id AND b.event_type = 'error' AND abs(a.t - b.t) <= 600 WHERE a.event_type = 'click') SELECT event_id, user_id, "at", error_at FROM c WHERE k = 1""",
    "nearest_span": """WITH s AS (SELECT DISTINCT item_id, para_id, s AS "at" FROM disputes), p AS (SELECT DISTINCT para_id, text_d FROM paragraphs WHERE text_d IS NOT NULL),
        l AS (SELECT para_id, unnest(range(length(text_d)))::INT AS line_end, text_d FROM p), ends AS (SELECT para_id, line_end FROM l WHERE substr(text_d, line_end + 1, 1) = chr(10)),
        n AS (SELECT s.*, line_end, row_number() OVER (PARTITION BY item_id ORDER BY abs("at" - line_end), line_end) AS k FROM s LEFT JOIN ends ON ends.para_id = s.para_id AND abs("at" - line_end) <= 15)
        SELECT item_id, para_id, "at", line_end FROM n WHERE k = 1""",
    "head_cut": r"""WITH e AS (SELECT DISTINCT id, regexp_extract_all(definition, '\p{L}+') AS ws FROM entries WHERE definition IS NOT NULL),
        w AS (SELECT id, unnest(range(len(ws)))::INT AS k, unnest(ws) AS word FROM e), u AS (SELECT *, sum(length(word)) OVER (PARTITION BY id ORDER BY k ROWS UNBOUNDED PRECEDING) AS until FROM w),
        f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k) AS r FROM u WHERE until >= 20) SELECT id, k, word, (20 - (until - length(word)))::INT AS into FROM f WHERE r = 1""",
    "line_start_scores": f"""WITH {_PARA}, w AS (SELECT *, lag(t) OVER (PARTITION BY leaf, col ORDER BY para) AS before FROM p)
        SELECT para_id, CASE WHEN hanging THEN 2.0 ELSE -2.5 END::DOUBLE + CASE WHEN regexp_matches(before, '[.!?]$') THEN 1.0 ELSE -1.5 END::DOUBLE
        + CASE WHEN regexp_matches(t, '^[А-ЯЅꙀѠІ]') THEN 1.5 ELSE -3.0 END::DOUBLE + CASE WHEN contains(t, '=') THEN 1.25 ELSE -0.75 END::DOUBLE AS score FROM w""",
}
