"""A page laid out from its lines, in stages that are relations: roles, bands and sides, edges, indents, paragraphs, hints.

Lines are rows: leaf, base (of the line), box, text, fs (size of type), height (of its characters), conf. Pages are rows: leaf,
width, tall, section, page (the printed number), g0 and g1 (the column rule x = g0 + g1 * y; NULL for a single column).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.geometry import log_odds
from corpusloom.operators.layout import flush_edge

# What the foot of a page and its signature look like, the end of a head, and the measures of the book's
# type and columns at its resolution.
FOOT, SIGNATURE = r"(?i)Ц[еѳ]рк[^\p{L}\p{N}]{0,3}сла|словарь,?\s*свящ", r"^[^.)]{1,4}$"
HEAD_END = r"=|—|–|\(|\s-\s|\s-$"
BIG, TITLE, BODY_WIDTH, CLIPPED = 110, 85, 1000, 4
RULE_TO_B, HANGING, COLUMN, WIDTHS, BETWEEN = 62, 115, 1930, (1830, 2040), {0: -38, 1: 59}
GUTTER = (40, 30)
BOOK = ("main", "supplement")


def _leaf(*conditions: Column) -> Column:
    """The first condition's value among the rows of a leaf (an aggregate over the page)."""
    return conditions[0].over(Window.partitionBy("leaf"))


def parted(words: DataFrame, pages: DataFrame) -> DataFrame:
    """Lines made anew from their words (leaf, line, base, k, text, box, fs, conf): words centred in the strip about the rule are
    specks and fall away, and a line that runs across the rule is two."""
    at = words.join(pages.select("leaf", "g0", "g1"), "leaf", "left").withColumn("_g", F.col("g0") + F.col("g1") * F.col("base"))
    mid = (F.col("x0") + F.col("x1")) / 2
    kept = at.where(F.col("_g").isNull() | ~((mid > F.col("_g") - GUTTER[0]) & (mid < F.col("_g") + GUTTER[1])))
    across = F.col("_g").isNotNull() & (F.min("x0").over(Window.partitionBy("leaf", "line")) < F.col("_g") - 30) & (F.max("x1").over(Window.partitionBy("leaf", "line")) > F.col("_g") + 30)
    half = F.when(across & (mid >= F.col("_g")), 1).otherwise(0)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), " ")
    return kept.withColumn("_half", half).groupBy("leaf", "line", "_half").agg(
        F.max("base").alias("base"), *[F.min(c).alias(c) for c in ("x0", "y0")], *[F.max(c).alias(c) for c in ("x1", "y1")], text.alias("text"), F.max("fs").alias("fs"),
        F.percentile(F.col("y1") - F.col("y0"), 0.5).alias("height"), F.coalesce(F.avg(F.when(F.col("conf") >= 0, F.col("conf"))), F.lit(-1.0)).alias("conf"),
    ).drop("_half", "line")


def roles(lines: DataFrame, pages: DataFrame, name: str = r"^\b$") -> DataFrame:
    """Lines with the page's columns, ``rule_x`` (the rule at their height, NULL without) and ``role``: header (short lines above
    the first line of text), footer (the running foot on pages that have one, what is level with it or below, and a signature
    at the foot of the right column), heading (initials on the rule and titles), noise (a character or two of no sense), body.
    ``name`` is a pattern of how the second half of the running foot begins, where it is a line of its own."""
    x = lines.join(pages, "leaf").withColumn("rule_x", F.col("g0") + F.col("g1") * F.col("base"))
    x = x.withColumn("_mid", F.coalesce("rule_x", F.col("width") / 2)).withColumn("_t", F.trim("text")).withColumn("letters", F.length(F.regexp_replace("text", r"\s", "")))
    wide, book = F.col("x1") - F.col("x0"), F.col("section").isin(*BOOK)
    like_body = (wide > BODY_WIDTH) & (F.length("_t") > wide / 80) & (F.coalesce("fs", F.lit(0)) < 16)
    first = F.coalesce(_leaf(F.min(F.when(like_body, F.col("base")))), F.col("tall"))
    initial = (F.col("height") >= BIG) & (wide >= 80) & (F.col("x0") < F.col("_mid") - 20) & (F.col("x1") > F.col("_mid") - 60)
    title = (F.coalesce("fs", F.lit(0)) >= 20) & (F.length("_t") >= 20) & (F.col("height") >= TITLE)
    x = x.withColumn("_first", first).withColumn("_initial", initial).withColumn("_title", title)
    x = x.withColumn("_header", (F.col("y0") < 0.12 * F.col("tall")) & (F.col("base") < F.col("_first") - 40) & ~F.col("_initial"))
    has_foot = ~book | F.coalesce(F.pmod("page", F.lit(16)) == 1, F.lit(False))
    x = x.withColumn("_foot", ~F.col("_header") & has_foot & (F.col("y0") > 0.88 * F.col("tall")) & F.col("_t").rlike(FOOT))
    x = x.withColumn("_low", _leaf(F.max(F.when(F.col("_foot"), F.col("base"))))).withColumn("_foot", F.coalesce(F.col("_foot") & (F.col("base") >= F.col("_low") - 60), F.lit(False)))
    x = x.withColumn("_top", _leaf(F.min(F.when(F.col("_foot"), F.col("base")))) - 50).withColumn("_end", _leaf(F.max(F.when(F.col("_foot"), F.col("y1")))))
    level = (F.col("base") >= F.col("_top")) & ((F.col("letters") <= 6) | F.col("_t").rlike(name))
    footer = ~F.col("_header") & (F.col("_foot") | F.coalesce((F.col("y0") > F.col("_end")) | level, F.lit(False)))
    right = ~F.col("_header") & ~footer & (F.col("y0") > 0.9 * F.col("tall")) & (F.col("x0") > F.col("_mid"))
    signed = right & book & F.coalesce(F.pmod("page", F.lit(16)).isin(1, 3), F.lit(False)) & F.col("_t").rlike(SIGNATURE)
    signed = signed & (F.col("base") >= _leaf(F.max(F.when(right, F.col("base")))))
    tiny = book & (F.col("letters") <= 2) & ((F.coalesce("fs", F.lit(99)) <= 8) | F.coalesce(F.col("conf").between(0, 39.99), F.lit(False)) | ~F.col("text").rlike(r"[\p{L}\p{N}]"))
    role = F.when(F.col("_header"), "header").when(footer | signed, "footer").when(F.col("_initial") | F.col("_title"), "heading").when(tiny, "noise").otherwise("body")
    return x.withColumn("role", role).drop("_mid", "_t", "_first", "_initial", "_title", "_header", "_foot", "_low", "_top", "_end")


def headings(lines: DataFrame, pictures: DataFrame, pages: DataFrame) -> DataFrame:
    """leaf, kind, text, box of what cuts a page into bands: headings of text, pictures across the rule, and gaps of 250 to 900
    across both columns that hold no other and have text of both columns above and below (initials that nobody read)."""
    told = lines.where("role = 'heading'").select("leaf", F.lit("text").alias("kind"), F.trim("text").alias("text"), "x0", "y0", "x1", "y1")
    shown = pictures.join(pages.select("leaf", "g0", "g1"), "leaf").withColumn("_g", F.col("g0") + F.col("g1") * (F.col("y0") + F.col("y1")) / 2)
    tall, wide = F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")
    shown = shown.where((F.col("x0") < F.col("_g") - 50) & (F.col("x1") > F.col("_g") + 50) & (tall > 100) & (tall < 1000) & (wide < 2000))
    some = told.unionByName(shown.select("leaf", F.lit("picture").alias("kind"), F.lit("").alias("text"), "x0", "y0", "x1", "y1"))
    body = lines.where((F.col("role") == "body") & (F.col("letters") >= 3) & F.col("rule_x").isNotNull() & F.col("section").isin(*BOOK))
    side = F.when((F.col("x0") + F.col("x1")) / 2 < F.col("rule_x"), "a").otherwise("b")
    body = body.select("leaf", "y0", "y1", "rule_x", side.alias("side"))
    reach = F.max("y1").over(Window.partitionBy("leaf").orderBy("y0", "y1").rowsBetween(Window.unboundedPreceding, -1))
    gaps = body.withColumn("_r", reach).where((F.col("y0") > F.col("_r") + 250) & (F.col("y0") < F.col("_r") + 900)).groupBy("leaf", F.col("_r").alias("_top"), F.col("y0").alias("_low")).agg(F.max("rule_x").alias("_g"))
    both = lambda c: F.countDistinct(F.when(c, F.col("side")))
    around = gaps.join(body.select("leaf", "side", "y0", "y1"), "leaf").groupBy("leaf", "_top", "_low", "_g").agg(both(F.col("y1") <= F.col("_top")).alias("_above"), both(F.col("y0") >= F.col("_low")).alias("_below"))
    free = around.where("_above = 2 and _below = 2")
    taken = some.select(F.col("leaf").alias("_l"), F.col("y0").alias("_y0"), F.col("y1").alias("_y1"))
    free = free.join(taken, (F.col("leaf") == F.col("_l")) & (F.col("_y0") < F.col("_low")) & (F.col("_y1") > F.col("_top")), "left_anti")
    kind = [F.lit("gap").alias("kind"), F.lit("").alias("text"), F.round(F.col("_g") - 250).alias("x0"), F.col("_top").alias("y0"), F.round(F.col("_g") + 250).alias("x1"), F.col("_low").alias("y1")]
    return some.unionByName(free.select("leaf", *kind))


def placed(lines: DataFrame, cuts: DataFrame) -> DataFrame:
    """Body lines with their band (1 and one more for every heading above their middle) and side, fragments of one printed line
    (baselines less than 25 apart, side by side) put together."""
    per = cuts.groupBy("leaf").agg(F.collect_list((F.col("y0") + F.col("y1")) / 2).alias("_cuts"))  # a few a page
    body = lines.where("role = 'body'").join(per, "leaf", "left")
    middle = (F.col("y0") + F.col("y1")) / 2
    band = 1 + F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<double>")), lambda c: c < middle))
    side = F.when(F.col("rule_x").isNull() | ((F.col("x0") + F.col("x1")) / 2 < F.col("rule_x")), "a").otherwise("b")
    body = body.withColumn("band", band).withColumn("side", side)
    w = Window.partitionBy("leaf", "band", "side").orderBy("base", "x0")
    apart = (F.col("x0") >= F.lag("x1").over(w) - 10) | (F.col("x1") <= F.lag("x0").over(w) + 10)
    new = ~F.coalesce((F.col("base") - F.lag("base").over(w) < 25) & apart, F.lit(False))
    body = body.withColumn("_n", new.cast("int")).withColumn("_row", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", F.trim("text").alias("t")))), lambda x: x["t"]), " ")
    same = ["width", "tall", "section", "page", "g0", "g1"]
    return body.groupBy("leaf", "band", "side", "_row").agg(
        F.min("base").alias("base"), *[F.min(c).alias(c) for c in ("x0", "y0")], *[F.max(c).alias(c) for c in ("x1", "y1")], text.alias("text"), F.max("fs").alias("fs"), *[F.first(c).alias(c) for c in same], F.min("rule_x").alias("rule_x")
    ).drop("_row")


EDGES = "leaf int, side string, flush double, indent double, right double, cut boolean, seen double"


def page_edges(pdf: pd.DataFrame) -> list[tuple]:
    """(side, flush, indent, right, cut, seen) of the sides of a page, measured from the rule. The right column is expected a
    known way from it, the left one a column's width from its right edge. A left side of which three lines or more begin at the
    image's edge was cut off: its flush edge is where it is expected, and ``seen`` is where its indented lines still begin."""
    out: dict[str, tuple] = {}
    leaf, ruled = int(pdf["leaf"].iloc[0]), bool(pdf["rule_x"].notna().all())
    width_b = indent_b = None
    for side in ("b", "a"):
        lines = pdf[pdf["side"] == side]
        if not len(lines):
            continue
        rule = lines["rule_x"].to_numpy(float) if ruled else np.zeros(len(lines))
        rel, right = lines["x0"].to_numpy(float) - rule, np.sort(lines["x1"].to_numpy(float) - rule)
        edge = float(np.median(right[len(right) // 3 :]))
        clipped = lines["x0"].to_numpy(float) <= CLIPPED
        free = rel[~clipped]
        usual = width_b if width_b is not None and WIDTHS[0] <= width_b <= WIDTHS[1] else COLUMN
        prior = float(free.min()) if not ruled and len(free) else 0.0 if not ruled else RULE_TO_B if side == "b" else edge - (usual + BETWEEN[leaf % 2])
        cut, seen = ruled and side == "a" and clipped.sum() >= 3, None
        if cut:
            flush, indent = prior, indent_b or HANGING
            x = lines["x0"].to_numpy(float)
            inner = x[(x > 25) & (x < 200)]
            seen = float(np.median(inner)) if len(inner) >= 0.3 * len(x) else None
        else:
            slack, per_line = (None, 10) if not ruled else (30, 10) if side == "b" else (60, 15)
            flush, indent = flush_edge(list(free), prior, slack, per_line, HANGING) if len(free) else (prior, float(HANGING))
            near = ~clipped & (rel - flush < 45)
            with_eq = lines["text"].str.contains("=", regex=False).to_numpy()
            if near.sum() >= 5 and near.sum() > 0.5 * len(lines) and with_eq[near].sum() < 0.25 * near.sum():
                flush -= indent_b if indent_b and 80 <= indent_b <= 150 else HANGING  # continuation lines of one long article
                deep = free[(free - flush >= 50) & (free - flush <= 230)] - flush
                indent = float(np.median(deep)) if len(deep) else float(HANGING)
            if side == "b":
                width_b = edge - flush if (free - flush < 45).sum() + clipped.sum() >= 3 else None
        indent_b = indent if side == "b" else indent_b
        out[side] = (leaf, side, float(flush), float(indent), edge, bool(cut), seen)
    return list(out.values())


def edges(lines: DataFrame) -> DataFrame:
    names = [c.split()[0] for c in EDGES.split(", ")]
    some = lines.select("leaf", "side", "x0", "x1", "rule_x", "text")
    return some.groupBy("leaf").applyInPandas(lambda pdf: pd.DataFrame(page_edges(pdf), columns=names), EDGES)


def indented(lines: DataFrame, sides: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Lines with ``ind`` (0 flush, 1 hanging, 2 deeper), ``guessed`` and ``seg``. Where the side's edge is seen the indent tells, and
    a line that looks like an entry's start after a short last line is one all the same; on a cut side position and text are
    weighed. What the other witnesses say of a line (verdicts: leaf, side, base, verdict) goes before; seg is CD where they
    make a start, A where they say nothing."""
    x = lines.join(sides, ["leaf", "side"]).join(verdicts.select("leaf", "side", "base", "verdict"), ["leaf", "side", "base"], "left")
    w = Window.partitionBy("leaf", "band", "side").orderBy("base", "x0")
    off = F.coalesce("rule_x", F.lit(0.0))
    x = x.withColumn("_t", F.trim("text")).withColumn("_before", F.lag("_t").over(w)).withColumn("_x1", F.lag("x1").over(w))
    d = F.col("x0") - off - F.col("flush")
    bound = F.greatest(F.lit(35.0), F.least(F.lit(70.0), F.col("indent") / 2))
    fit = F.when(F.col("x0") <= CLIPPED, 0).when(d < bound, 0).when(d < F.col("indent") + 110, 1).otherwise(2)
    eq = F.instr("_t", "=") - 1
    early, short, ends = (eq >= 0) & (eq < 0.4 * F.length("_t")), F.col("_x1") - off < F.col("right") - 120, F.col("_before").rlike("[.)»“]$")
    missed = F.coalesce((fit == 1) & early & short & ends, F.lit(False))
    dx = F.col("x0") - F.col("seen")
    place = F.when(F.col("x0") <= 12, 3.7).when(F.col("seen").isNull(), 0.0).when(dx < -30, 3.6).when(dx < -20, 0.4).when(dx <= 20, -3.7).otherwise(-1.0)
    # Weights of the features of an entry's first line and of the line before it.
    own = log_odds([(F.col("_t").contains("="), 3.91, -1.69), (F.col("_t").rlike(r"^\S+(\s\S+)?\s[—-]\s"), 2.36, -0.17)])
    last = log_odds([(F.col("_x1") < F.col("right") + off - 120, 5.95, -1.36), (F.col("_before").rlike("[¬-]$"), -2.36, 0.36), (ends, 1.94, -1.99)])
    score = -1.22 - 0.28 + own + F.when(F.col("_before").isNotNull(), last).otherwise(0.0) + place
    weighed = F.when(F.coalesce(dx > 110, F.lit(False)), 2).when(score > 0, 0).otherwise(1)
    was = F.when(F.col("cut"), weighed).when(missed, 0).otherwise(fit)
    ind = F.when(F.col("verdict") == "start", 0).when((F.col("verdict") == "continue") & (was == 0), 1).otherwise(was)
    guess = F.col("verdict").isNull() & (was == 0) & (F.col("cut") | missed)
    seg = F.when((F.col("verdict") == "start") & (was != 0), "CD").when(F.col("verdict").isNull(), "A")
    return x.withColumn("ind", ind).withColumn("guessed", guess).withColumn("seg", seg).drop("_t", "_before", "_x1", "verdict", "flush", "indent", "right", "cut", "seen")


def paragraphs(lines: DataFrame) -> DataFrame:
    """Lines with n (the number of their column: bands from above, the left side before the right), para, row and hanging: a flush
    line opens a paragraph, as does the first line of a column, which hangs only if it is flush."""
    column = F.dense_rank().over(Window.partitionBy("leaf").orderBy("band", "side"))
    w = Window.partitionBy("leaf", "band", "side").orderBy("base", "x0")
    opens = ((F.col("ind") == 0) | (F.row_number().over(w) == 1)).cast("int")
    x = lines.withColumn("n", column).withColumn("_o", opens).withColumn("para", F.sum("_o").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    inside = Window.partitionBy("leaf", "n", "para")
    x = x.withColumn("row", F.row_number().over(inside.orderBy("base", "x0"))).withColumn("hanging", F.first(F.col("ind") == 0).over(inside.orderBy("base", "x0")))
    return x.drop("_o")


def hints(lines: DataFrame) -> DataFrame:
    """leaf, n, para, measured (the head of a hanging paragraph's first line), eq (a "=" in its first two lines)."""
    first = F.max(F.when(F.col("row") == 1, F.col("text")))
    two = F.max(F.when(F.col("row") <= 2, F.col("text").contains("=").cast("int"))) == 1
    got = lines.where(F.col("hanging") & F.col("section").isin(*BOOK)).groupBy("leaf", "n", "para").agg(first.alias("_t"), F.coalesce(two, F.lit(False)).alias("eq"))
    rest = F.substring(F.col("_t"), F.lit(2), F.length("_t"))
    at = F.regexp_instr(rest, F.lit(HEAD_END))
    at = F.when(at > 0, at).when(F.instr(rest, " ") > 0, F.instr(rest, " ")).otherwise(F.length("_t"))
    head = F.regexp_replace(F.substring(F.col("_t"), F.lit(1), at), r"[^\p{L}\p{N}'’`^|]+$", "")
    return got.select("leaf", "n", "para", F.when(head != "", head).otherwise(F.substring("_t", 1, 1)).alias("measured"), "eq")


def header_parts(lines: DataFrame) -> DataFrame:
    """leaf, page_number, running_title, guide_a, guide_b of the header's words (lines of one word or more: leaf, base, text, box): words
    nearer than 150 are one group; groups left and right of the middle are guide words, the uppermost between them is the page
    number, the others the title."""
    w = Window.partitionBy("leaf", "base").orderBy("x0")
    new = F.coalesce(F.col("x0") - F.lag("x1").over(w) >= 150, F.lit(True)).cast("int")
    groups = lines.withColumn("_n", new).withColumn("_g", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda x: x["text"]), " ")
    centre = F.coalesce("g0", F.col("width") / 2)
    each = groups.groupBy("leaf", "base", "_g").agg(text.alias("t"), F.min("x0").alias("l"), F.max("x1").alias("r"), F.min("y0").alias("y"), F.first(centre).alias("c"))
    where = F.when((F.col("l") < F.col("c") - 300) & (F.col("r") < F.col("c") - 200), "a").when(F.col("l") > F.col("c") + 200, "b").otherwise("m")
    each = each.withColumn("where", where)
    of = lambda name: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("where") == name, F.struct("base", "l", "t")))), lambda x: x["t"]), " ")
    middle = F.transform(F.array_sort(F.collect_list(F.when(F.col("where") == "m", F.struct("y", "t")))), lambda x: x["t"])
    return each.groupBy("leaf").agg(of("a").alias("guide_a"), of("b").alias("guide_b"), middle.alias("_m")).select(
        "leaf", F.coalesce(F.get("_m", F.lit(0)), F.lit("")).alias("page_number"), F.array_join(F.slice("_m", 2, 1000), " ").alias("running_title"), "guide_a", "guide_b"
    )


def laid_out(lines: DataFrame, pages: DataFrame, pictures: DataFrame, verdicts: DataFrame) -> DataFrame:
    """leaf, n, band, side, para, row, hanging, ind, guessed, seg, base, box, text of the body lines of pages."""
    told = roles(lines, pages)
    body = placed(told, headings(told, pictures, pages))
    done = paragraphs(indented(body, edges(body), verdicts))
    return done.select("leaf", "n", "band", "side", "para", "row", "hanging", "ind", "guessed", "seg", "base", "x0", "y0", "x1", "y1", "text", "section")
