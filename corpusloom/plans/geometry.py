"""Boxes and lines of the page records: order, overlap, columns, robust statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import geometry as G
from corpusloom.operators import layout as L
from corpusloom.operators import pages as P
from corpusloom.operators.shred import earliest, latest, shredded
from corpusloom.plans.pagesql import PAGE_LINES, WORDS
from corpusloom.session import table

_BOX = ("x0", "y0", "x1", "y1")


def _records(spark, d):
    return shredded(table(spark, d, "page_json"), "body", ["leaf", "written_at"], P.LAYOUT_SPEC)


def _number(c, kind="int"):
    """A number however it is written; other text is missing."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("double").cast(kind)


def _box(c):
    parts = F.from_json(c, "array<string>")
    return [_number(F.get(parts, F.lit(k))).alias(name) for k, name in enumerate(_BOX)]


def _lines(spark, d):
    now = latest(_records(spark, d), "leaf", "written_at")
    lines = P.layout_table(now, P.LINE, ["size", "printed_page", "columns[].paragraphs[].hanging"], ["bbox", "base", "ind", "fs", "text", "words"])
    size = F.from_json("size", "array<string>")
    sizes = [_number(F.get(size, F.lit(0))).alias("width"), _number(F.get(size, F.lit(1))).alias("tall"), _number("printed_page").alias("page")]
    hanging = F.col("hanging").try_cast("boolean").alias("hanging")
    measures = [_number("base").alias("base"), _number("ind").alias("ind"), _number("fs", "double").alias("fs")]
    words = F.from_json("words", "array<array<string>>").alias("words")
    return lines.select("leaf", *sizes, _number("n").alias("n"), "para", hanging, "line", *_box("bbox"), *measures, "text", words).where("x0 is not null")


def page_lines(spark, d):
    """leaf, n, para, line, box and text of every line of the current pages that has a box, however loosely shaped."""
    return _lines(spark, d).drop("tall", "page")


def _words(spark, d):
    w = _lines(spark, d).select("leaf", "width", "tall", "page", "n", F.posexplode("words").alias("k", "w"))
    at = lambda k: F.get("w", F.lit(k))
    cast = [_number(at(k + 1), "double").alias(c) for k, c in enumerate(_BOX)]
    return w.select("leaf", "width", "tall", "page", "n", at(0).alias("text"), *cast, _number(at(5)).alias("conf")).where("x0 is not null")


def column_gutters(spark, d):
    """Per leaf the place between the columns that the fewest lines cover."""
    return G.gutter(page_lines(spark, d).select("leaf", "width", "x0", "x1"), ["leaf"], "width")


def read_order(spark, d):
    """The words that have boxes in reading order: the lines of each leaf by band and side, with their places in its text. The
    signature and the running foot are looked for on the pages of a sheet that carry them."""
    sheet = lambda *k: F.coalesce(F.pmod("page", F.lit(16)).isin(*k), F.lit(False))
    words = _words(spark, d).where("width is not null and tall is not null").withColumns({"signature": sheet(1, 3), "foot": sheet(1), "height": F.col("tall").cast("double")})
    return L.read_pages(words, ["leaf"])


def words_in_lines(spark, d):
    """Words counted in the line box that holds their middle."""
    w = _words(spark, d).select("leaf", ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"), "text")
    lines = page_lines(spark, d).select("leaf", "n", "para", "line", "x0", "y0", "x1", "y1")
    return G.points_in_boxes(w, lines, ["leaf"], "cx", "cy").groupBy("leaf", "n", "para", "line").agg(F.count("*").alias("words"))


def paragraph_boxes(spark, d):
    """Boxes of paragraphs as unions of their lines' boxes."""
    return page_lines(spark, d).groupBy("leaf", "n", "para").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").alias("lines"))


def matched_boxes(spark, d):
    """Paragraph boxes of the first and the last readable record of a leaf, matched one to one by overlap."""
    records = _records(spark, d)

    def boxes(pick):
        q = P.layout_table(pick(records, "leaf", "written_at"), P.PARAGRAPH, [], ["bbox"])
        return q.select("leaf", F.concat_ws("/", "n", "para").alias("id"), *_box("bbox")).where("x0 is not null")

    return G.best_overlaps(boxes(earliest), boxes(latest), "leaf", "id", 0.3)


def line_statistics(spark, d):
    """Per leaf: upper median of line heights, the most frequent indent (the smallest of equals), quartiles of widths."""
    lines = page_lines(spark, d)
    stats = lines.groupBy("leaf").agg(
        G.upper_median("y1 - y0").alias("height"), F.percentile(F.col("x1") - F.col("x0"), [0.25, 0.75]).alias("q"), F.count("*").alias("lines")
    )
    mode = G.mode_low(lines, ["leaf"], "ind", "indent")
    return stats.join(mode, "leaf", "left").select("leaf", "lines", "height", "indent", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))


def word_confidence(spark, d):
    """Mean confidence of a leaf's words without the unknown."""
    return _words(spark, d).groupBy("leaf").agg(G.mean_confidence(F.col("conf")).alias("conf"), F.count("*").alias("words"))


def indent_skew(spark, d):
    """The skew of a column at which its lines' left edges fall best on multiples of the indent."""
    lines = page_lines(spark, d).select("leaf", "n", "x0", "y0")
    return G.skew_grid(lines, ["leaf", "n"], 157.0, [k / 1000 for k in range(-10, 11)])


def flush_levels(spark, d):
    """The indent level of a leaf's columns that tells entry starts best against hanging paragraphs."""
    lines = page_lines(spark, d).select("leaf", "n", "ind", (F.coalesce("hanging", F.lit(False)) & (F.col("line") == 1)).alias("start")).where("ind is not null")
    return G.flush_level(lines, ["leaf", "n"], "ind", "start")


def order_line(spark, d):
    """The weighted least-squares line of price over quantity of each return flag and status."""
    a, b = G.weighted_line(F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_tax") + 1)
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(a, 2).alias("intercept"), F.round(b, 4).alias("slope"))


def event_phase(spark, d):
    """The mean time of day of each kind of event, as an angle, and how concentrated it is."""
    angle = (F.hour("ts") * 60 + F.minute("ts")) * (6.283185307179586 / 1440)
    mean, strength = G.circular(angle)
    return table(spark, d, "events").groupBy("event_type").agg(F.round(mean, 4).alias("phase"), F.round(strength, 5).alias("strength"))


def price_statistics(spark, d):
    """Upper median, the most frequent value and percentiles of quantities by supplier."""
    li = table(spark, d, "lineitem").select("l_suppkey", F.col("l_quantity").cast("int").alias("q"))
    stats = li.groupBy("l_suppkey").agg(G.upper_median("q").alias("upper"), F.percentile("q", [0.01, 0.6]).alias("p"))
    return stats.join(G.mode_low(li, ["l_suppkey"], "q", "mode"), "l_suppkey").select("l_suppkey", "upper", "mode", "times", F.round(F.col("p")[0], 4).alias("p1"), F.round(F.col("p")[1], 4).alias("p60"))


def overlapping_spans(spark, d):
    """Disputed and italic spans of the entries that overlap."""
    from corpusloom.functions.text import unpack_spans

    def spans(c):
        e = table(spark, d, "entries").select("id", c).distinct()
        return e.select("id", F.explode(unpack_spans(F.col(c))).alias("x")).select("id", "x.s", "x.e").distinct()

    return G.span_overlaps(spans("disputed"), spans("italic"), "id")


def covered_pieces(spark, d):
    """Definitions cut at all edges of their disputed and italic spans, each piece with what covers it."""
    from corpusloom.functions.text import unpack_spans
    from corpusloom.operators.ordered import interval_pieces

    e = table(spark, d, "entries").where("definition is not null").groupBy("id").agg(F.max(F.length("definition")).alias("n"), F.max("disputed").alias("disputed"), F.max("italic").alias("italic"))
    kinds = [e.select("id", F.explode(unpack_spans(F.col(c))).alias("x"), F.lit(c).alias("kind")) for c in ("disputed", "italic")]
    spans = kinds[0].unionByName(kinds[1]).select("id", "x.s", "x.e", "kind")
    return interval_pieces(e.select("id", "n"), spans, "id", "n")


def shred_levels(spark, d):
    """How many values each leaf path of the current pages has at each repetition and definition level."""
    from corpusloom.operators.pages import PAGE_SPEC

    now = latest(shredded(table(spark, d, "page_json"), "body", ["leaf", "written_at"], PAGE_SPEC), "leaf", "written_at")
    each = now.select(F.explode("cols").alias("c")).select("c.path", F.explode(F.arrays_zip("c.rep", "c.def")).alias("z"))
    return each.groupBy("path", F.col("z.rep").cast("int").alias("rep"), F.col("z.def").cast("int").alias("def")).agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (page_lines, column_gutters, read_order, words_in_lines, paragraph_boxes, matched_boxes, line_statistics, word_confidence, indent_skew, flush_levels,
              order_line, event_phase, price_statistics, overlapping_spans, covered_pieces, shred_levels)
}

_SPANS = "list_transform(list_filter(string_split(coalesce({c}, ''), ';'), lambda x: regexp_full_match(x, '[0-9]+-[0-9]+')), lambda x: {{'s': split_part(x, '-', 1)::INT, 'e': split_part(x, '-', 2)::INT}})"
_BOTH = f"""dis AS (SELECT DISTINCT id, x.s AS s, x.e AS e FROM (SELECT id, unnest({_SPANS.format(c='disputed')}) AS x FROM entries)),
    ita AS (SELECT DISTINCT id, x.s AS s, x.e AS e FROM (SELECT id, unnest({_SPANS.format(c='italic')}) AS x FROM entries))"""

ORACLE = {
    "order_line": """WITH w AS (SELECT l_returnflag, l_linestatus, l_quantity AS x, l_extendedprice AS y, l_tax + 1 AS w FROM lineitem),
        s AS (SELECT l_returnflag, l_linestatus, sum(w) AS sw, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM w GROUP BY ALL),
        b AS (SELECT *, (sw * sxy - sx * sy) / (sw * sxx - sx * sx) AS slope FROM s) SELECT l_returnflag, l_linestatus, round((sy - slope * sx) / sw, 2) AS intercept, round(slope, 4) AS slope FROM b""",
    "event_phase": """WITH a AS (SELECT event_type, (hour(ts) * 60 + minute(ts)) * (6.283185307179586 / 1440) AS a FROM events), c AS (SELECT event_type, avg(cos(a)) AS c, avg(sin(a)) AS s FROM a GROUP BY event_type)
        SELECT event_type, round(atan2(s, c), 4) AS phase, round(sqrt(c * c + s * s), 5) AS strength FROM c""",
    "price_statistics": """WITH q AS (SELECT l_suppkey, l_quantity::INT AS q FROM lineitem), c AS (SELECT l_suppkey, q, count(*) AS n FROM q GROUP BY ALL),
        m AS (SELECT l_suppkey, q AS mode, n AS times FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, q) AS k FROM c) WHERE k = 1),
        u AS (SELECT l_suppkey, list_sort(list(q))[len(list(q)) // 2 + 1] AS upper, round(quantile_cont(q, 0.01), 4) AS p1, round(quantile_cont(q, 0.6), 4) AS p60 FROM q GROUP BY l_suppkey)
        SELECT l_suppkey, upper, mode, times, p1, p60 FROM u JOIN m USING (l_suppkey)""",
    "overlapping_spans": f"""WITH {_BOTH} SELECT dis.id, dis.s, dis.e, ita.s AS s2, ita.e AS e2, least(dis.e, ita.e) - greatest(dis.s, ita.s) AS common FROM dis JOIN ita ON dis.id = ita.id AND dis.s < ita.e AND dis.e > ita.s""",
    "page_lines": f"WITH {PAGE_LINES} SELECT * FROM ln",
    "paragraph_boxes": f"WITH {PAGE_LINES} SELECT leaf, n, para, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS lines FROM ln GROUP BY leaf, n, para",
    "line_statistics": f"""WITH {PAGE_LINES}, s AS (SELECT leaf, list_sort(list(y1 - y0))[count(*) // 2 + 1] AS height, quantile_cont(x1 - x0, 0.25) AS q1, quantile_cont(x1 - x0, 0.75) AS q3, count(*) AS lines FROM ln GROUP BY leaf),
        m AS (SELECT leaf, ind FROM (SELECT leaf, ind, row_number() OVER (PARTITION BY leaf ORDER BY count(*) DESC, ind) AS k FROM ln WHERE ind IS NOT NULL GROUP BY leaf, ind) WHERE k = 1)
        SELECT leaf, lines, height, ind AS indent, q1, q3 FROM s LEFT JOIN m USING (leaf)""",
    "word_confidence": f"WITH {WORDS} SELECT leaf, coalesce(round_even(avg(conf) FILTER (conf >= 0), 0), -1)::INT AS conf, count(*) AS words FROM wd GROUP BY leaf",
    "words_in_lines": f"""WITH {WORDS} SELECT ln.leaf, ln.n, para, line, count(*) AS words FROM wd JOIN ln ON wd.leaf = ln.leaf AND (wd.x0 + wd.x1) / 2 BETWEEN ln.x0 - 1 AND ln.x1 + 1 AND (wd.y0 + wd.y1) / 2 BETWEEN ln.y0 - 1 AND ln.y1 + 1
        GROUP BY ln.leaf, ln.n, para, line""",
    "column_gutters": f"""WITH {PAGE_LINES}, pg AS (SELECT DISTINCT leaf, width::DOUBLE AS w, greatest(1, floor(width / 400))::BIGINT AS st, floor(0.35 * width)::BIGINT AS lo, floor(0.65 * width)::BIGINT AS hi FROM ln),
        pt AS (SELECT leaf, w, unnest(range(lo, hi, st)) AS x FROM pg), cv AS (SELECT pt.leaf, pt.x, any_value(w) AS w, count(ln.leaf) AS n FROM pt LEFT JOIN ln ON ln.leaf = pt.leaf AND ln.x0 < pt.x AND ln.x1 > pt.x GROUP BY pt.leaf, pt.x)
        SELECT leaf, x AS gutter, n AS covered FROM (SELECT *, row_number() OVER (PARTITION BY leaf ORDER BY n, abs(x - w / 2), x) AS k FROM cv) WHERE k = 1""",
    "flush_levels": f"""WITH {PAGE_LINES}, f AS (SELECT leaf, n, ind, coalesce(hanging, false) AND line = 1 AS s FROM ln WHERE ind IS NOT NULL), g AS (SELECT leaf, n, min(ind) AS low, count(*) AS total FROM f GROUP BY leaf, n),
        lw AS (SELECT g.*, (SELECT count(*) FROM f WHERE f.leaf = g.leaf AND f.n = g.n AND ind = low) AS lowest FROM g), o AS (SELECT *, unnest(CASE WHEN lowest <= greatest(2, 0.05 * total) THEN [-1, 0, 1] ELSE [-1, 0] END) AS flush FROM lw),
        t AS (SELECT o.leaf, o.n, flush, count(*) FILTER (ind - low <= flush AND s) AS hit, count(*) FILTER (ind - low <= flush) AS said, count(*) FILTER (s) AS truth FROM o JOIN f ON f.leaf = o.leaf AND f.n = o.n GROUP BY o.leaf, o.n, flush),
        e AS (SELECT *, round(CASE WHEN said + truth > 0 THEN 2 * hit / (said + truth) ELSE 1.0 END, 6) AS f1, round(CASE WHEN said > 0 THEN hit / said END, 6) AS precision FROM t),
        k AS (SELECT *, row_number() OVER (PARTITION BY leaf, n ORDER BY f1 DESC, flush) AS k FROM e) SELECT leaf, n, flush, f1, precision FROM k WHERE k = 1 AND ((precision >= 0.5 AND said >= 3) OR (said > 0 AND hit = said) OR (said = 0 AND truth = 0))""",
    "covered_pieces": f"""WITH t AS (SELECT id, max(length(definition))::INT AS n, max(disputed) AS dis, max(italic) AS ita FROM entries WHERE definition IS NOT NULL GROUP BY id),
        sp AS (SELECT id, 'disputed' AS kind, unnest({_SPANS.format(c='dis')}) AS x FROM t UNION ALL SELECT id, 'italic', unnest({_SPANS.format(c='ita')}) FROM t),
        ed AS (SELECT DISTINCT id, at_ FROM (SELECT id, unnest([0, n]) AS at_, n FROM t UNION ALL SELECT sp.id, unnest([x.s, x.e]), n FROM sp JOIN t USING (id)) WHERE at_ BETWEEN 0 AND n),
        pc AS (SELECT id, at_ AS s, lead(at_) OVER (PARTITION BY id ORDER BY at_) AS e FROM ed)
        SELECT pc.id, pc.s, pc.e, coalesce((SELECT string_agg(DISTINCT kind, '+' ORDER BY kind) FROM sp WHERE sp.id = pc.id AND sp.x.s < pc.e AND sp.x.e > pc.s), '') AS kinds FROM pc WHERE e IS NOT NULL""",
}
