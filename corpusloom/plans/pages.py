"""Pages read, voted and parsed into entries; layout relations; readings against the truth; labels, heads and renditions."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import strings as S
from corpusloom.functions import text as X
from corpusloom.operators import entries as E
from corpusloom.operators import evaluate as V
from corpusloom.operators import geometry as G
from corpusloom.operators import labels as B
from corpusloom.operators import layout as L
from corpusloom.operators import ordered as O
from corpusloom.operators import pagelayout as Y
from corpusloom.operators import pages as P
from corpusloom.operators import pagetext as T
from corpusloom.operators import requests as R
from corpusloom.operators import segmentation as Z
from corpusloom.operators import upkeep as U
from corpusloom.operators.shred import latest, shredded
from corpusloom.plans.geometry import page_lines
from corpusloom.plans.pagesql import CHILDREN, LINES, PAGE_LINES, WORDS, each, scalar
from corpusloom.session import cut, table
from corpusloom.sources import witness as W
from corpusloom.sources.delimited import parse_truth

#: What entries and page texts need of a record beside its lines.
SPEC = {
    "size": list, "section": None, "printed_page": None, "warnings": list,
    "columns[]": {"n": None, "side": None, "paragraphs[]": {"hanging": None, "guessed": None, "seg": None, "text_merged": None, "disputed": list, "italic": list, "breaks": list,
                                              "lines[]": {"text": None, "bbox": list, "words": list}}},
    "entries_hint[]": {"col": None, "para": None, "abbyy": None, "eq": None, "headword": None, "headword_source": None, "check": None},
}
# The leaves of the sections.
SECTIONS = [("front", 0, 37), ("main", 38, 900), ("blank", 901, 901), ("supplement", 902, 1157)]


def _records(spark, d):
    return latest(shredded(table(spark, d, "page_json"), "body", ["leaf", "written_at"], SPEC), "leaf", "written_at")


def _paragraph_rows(now):
    """leaf, n, para, side, section, page and what a record says of each paragraph, with its lines' text joined."""
    above = ["section", "printed_page", "columns[].side"]
    own = ["hanging", "guessed", "seg", "text_merged", "disputed", "italic", "breaks"]
    p = P.layout_table(now, P.PARAGRAPH, above, own)
    lines = P.layout_table(now, P.LINE, [], ["text"]).groupBy("leaf", "n", "para").agg(F.array_sort(F.collect_list(F.struct("line", "text"))).alias("_lines"))
    text = X.join_lines(F.transform("_lines", lambda x: F.trim(F.coalesce(x["text"], F.lit("")))))
    return p.join(lines, ["leaf", "n", "para"], "left").withColumn("lines_text", F.coalesce(text, F.lit("")))


def _hints(now):
    def run(batches):
        from corpusloom.operators.shred import Levels

        names = ["col", "para", "abbyy", "eq", "headword", "headword_source", "check"]
        for pdf in batches:
            rows = []
            for leaf, cols in zip(pdf["leaf"], pdf["cols"]):
                lv = Levels(cols)
                there = lv.there("entries_hint[]")
                values = [lv.value(f"entries_hint[].{c}") for c in names]
                rows += [(leaf, P.whole(v[0]), P.whole(v[1]), *v[2:]) for ok, *v in zip(there, *values) if ok]
            yield pd.DataFrame(rows, columns=["leaf", "n", "para", "measured", "eq", "headword", "source", "hint_check"])

    types = "leaf int, n string, para string, measured string, eq string, headword string, source string, hint_check string"
    hints = now.select("leaf", "cols").mapInPandas(run, types)
    one = hints.groupBy("leaf", "n", F.col("para").try_cast("int").alias("para"))
    return one.agg(*[F.max(c).alias(c) for c in ("measured", "headword", "source", "hint_check")], F.max(F.col("eq").try_cast("boolean")).alias("eq")).withColumn("hinted", F.lit(True))


def _spans(c):
    read = F.from_json(c, "array<array<int>>")
    return F.transform(F.filter(F.coalesce(read, F.array().cast("array<array<int>>")), lambda x: F.size(x) == 2), lambda x: F.struct(x[0].alias("s"), x[1].alias("e")))


def head_hints(spark, d):
    """Of every hanging paragraph's first line the head before its separator, without marks at its end, and whether the
    first two lines have a "="."""
    lines = page_lines(spark, d).where("text is not null").select("leaf", "n", "para", "line", "text", "hanging")
    first = lines.where("hanging and line = 1")
    eq = lines.where("line <= 2").groupBy("leaf", "n", "para").agg(F.max(F.col("text").contains("=")).alias("eq"))
    cut = F.regexp_extract("text", r"^(.*?)(?:=|—|–|\(|\s-\s|\s-$|$)", 1)
    return first.select("leaf", "n", "para", F.regexp_replace(F.trim(cut), r"[^\p{L}\p{N}]+$", "").alias("head")).join(eq, ["leaf", "n", "para"])


def parsed_entries(spark, d):
    """The entries of the current pages: assembled over columns and pages, split, repaired and flagged."""
    now = cut(_records(spark, d))  # read once for paragraphs, lines and hints
    p = _paragraph_rows(now).join(_hints(now), ["leaf", "n", "para"], "left").where(F.coalesce("section", F.lit("main")).isin("main", "supplement"))
    number = F.col("n").try_cast("int")
    rows = p.select(
        "leaf", number.alias("number"), "para",
        F.concat_ws("-", F.lpad(F.col("leaf").cast("string"), 4, "0"), "n", F.lpad(F.col("para").cast("string"), 2, "0")).alias("id"),
        F.coalesce("section", F.lit("main")).alias("section"), F.col("printed_page").alias("page"), "side", F.coalesce("text_merged", "lines_text").alias("text"),
        *[_spans(c).alias(c) for c in ("disputed", "italic")], F.transform(_spans("breaks"), lambda x: F.struct(x["s"].alias("at"), (x["e"] > 0).alias("hyphen"))).alias("lines"),
        *[F.coalesce(F.col(c).try_cast("boolean"), F.lit(False)).alias(c) for c in ("hanging", "guessed")], "seg", F.lit(False).alias("odd"),
        "headword", "source", "measured", F.coalesce("eq", F.lit(False)).alias("eq"), "hint_check", F.coalesce("hinted", F.lit(False)).alias("hinted"),
        F.array().cast("array<struct<printed:string,read:string>>").alias("errata"),
    )
    return E.parsed_entries(rows, ["leaf", "number", "para"], "leaf")


def _other_texts(spark, d):
    """Per paragraph the voted text with the disputed words as b and as a read them: stand-ins for those witnesses."""
    p = table(spark, d, "paragraphs").groupBy("para_id", "leaf", "col", "para").agg(F.max("text_d").alias("d"), F.max("text_merged").alias("c"))
    spans = table(spark, d, "disputes").groupBy("para_id", "s", "e").agg(F.max("read_b").alias("b"), F.max("read_a").alias("a"))
    per = spans.groupBy("para_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("k"), "s", "e", F.coalesce("b", F.lit("")).alias("b"), F.coalesce("a", F.lit("")).alias("a")))).alias("_x"))
    put = lambda name: F.aggregate(F.coalesce("_x", F.array().cast("array<struct<k:int,s:int,e:int,b:string,a:string>>")), F.col("c"), lambda t, x: F.concat(F.substring(t, F.lit(1), x["s"]), x[name], F.substring(t, x["e"] + 1, F.length(t))))
    return p.join(per, "para_id", "left").select("para_id", "leaf", "col", "para", "d", "c", put("b").alias("b"), put("a").alias("a"))


def _lexicon(texts, words_in, key):
    """key, lex: of the words that each row may need, the counts of those that the corpus has twice or more."""
    words = lambda c: F.filter(X.words(c, "[Ѐ-ԯ]+"), lambda w: F.length(w) >= 2)
    counts = texts.select(F.explode(words(F.col("d"))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).where("n >= 2")
    asked = words_in.where(F.col("d").rlike("[A-Za-zͰ-Ͽἀ-῿]")).select(key, F.explode(F.array_distinct(F.concat(words(F.col("b")), words(F.col("a"))))).alias("w"))
    return asked.join(counts, "w").groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("w", F.col("n").cast("int")))).alias("lex"))


def merged_texts(spark, d):
    """The vote on each paragraph: d is its text_d; b and a are the voted text with their readings in its disputed places; the
    fourth is the voted text itself (stand-ins, as the tables hold no whole texts of these witnesses)."""
    from corpusloom.operators.vote import merge

    t = _other_texts(spark, d).where("d is not null and c is not null")
    rows = t.join(_lexicon(t, t, "para_id"), "para_id", "left").select("para_id", "d", "b", "a", "c", F.coalesce("lex", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))).alias("lex"))

    def run(batches):
        for pdf in batches:
            out = []
            for key, x, b, a, c, lex in pdf.itertuples(index=False, name=None):
                m = merge(x, b or "", a or "", c or "", dict(lex))
                out.append((key, m["text"], m["fixed"], len(m["disputed"]) - m["fixed"]))
            yield pd.DataFrame(out, columns=["para_id", "text", "fixed", "disputed"])

    return rows.mapInPandas(run, "para_id string, text string, fixed int, disputed int")


def voted_pages(spark, d):
    """Pages driven whole: the records' paragraphs and lines, carried into d (text_d of the leaf's column), cut there and voted
    on with stand-ins for b and the fourth witness (``merged_texts``)."""
    now = _records(spark, d)
    lines = P.layout_table(now, P.LINE, ["size", "columns[].side", "columns[].paragraphs[].hanging"], ["text", "bbox", "words"])
    words = F.transform(F.coalesce(F.from_json("words", "array<array<string>>"), F.array().cast("array<array<string>>")), lambda w: F.struct(F.get(w, F.lit(0)).alias("text"), F.get(w, F.lit(6)).alias("flags")))
    right = F.get(F.from_json("bbox", "array<string>"), F.lit(2)).try_cast("double")
    per = lines.groupBy("leaf", "side", "n", "para").agg(
        F.max(F.get(F.from_json("size", "array<string>"), F.lit(0)).try_cast("double")).alias("width"), F.max(F.coalesce(F.col("hanging").try_cast("boolean"), F.lit(False))).alias("hanging"),
        F.array_sort(F.collect_list(F.struct("line", F.coalesce("text", F.lit("")).alias("text"), right.alias("x1"), words.alias("words")))).alias("lines"),
    )
    sides = per.where("side is not null").groupBy("leaf", "side").agg(
        F.max("width").alias("width"), F.array_sort(F.collect_list(F.struct(F.col("n").try_cast("int").alias("n"), "para", "hanging", "lines"))).alias("paragraphs")
    )
    t = _other_texts(spark, d).where("d is not null")
    whole = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("para", F.coalesce(c, F.lit("")).alias("t")))), lambda x: x["t"]), "\n")
    texts = t.groupBy("leaf", F.when(F.col("col") == 1, "a").otherwise("b").alias("side")).agg(*[whole(c).alias(c) for c in ("d", "b", "a", "c")]).withColumn("key", F.concat_ws("/", "leaf", "side"))
    starts = F.filter(F.transform(F.sequence(F.lit(0), F.length("d")), lambda k: F.when((k == 0) | (F.substring(F.col("d"), k, F.lit(1)) == "\n"), k)), lambda k: k.isNotNull())
    texts = texts.join(_lexicon(texts, texts, "key"), "key", "left").withColumn("d_lines", starts)
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
    both = sides.join(texts, ["leaf", "side"], "left").select("leaf", "side", "width", "paragraphs", "d", F.coalesce("d_lines", F.array().cast("array<int>")).alias("d_lines"), "b", "c", F.coalesce("lex", empty).alias("lex"))
    return T.voted_pages(both, ["leaf", "side"])


def _spread_words(spark, d):
    """The words of the lines with boxes in proportion to their letters (the records hold boxes of few words)."""
    lines = page_lines(spark, d).where("text is not null and x1 > x0").select("leaf", "width", "n", "para", "line", "x0", "y0", "x1", "y1", F.posexplode(F.split("text", " ")).alias("k", "word"), F.length("text").alias("size"))
    w = Window.partitionBy("leaf", "n", "para", "line").orderBy("k")
    at = F.coalesce(F.sum(F.length("word") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = lambda c: F.col("x0") + (F.col("x1") - F.col("x0")) * c / F.greatest("size", F.lit(1))
    words = lines.withColumn("_at", at).select("leaf", F.col("width").cast("double").alias("width"), F.col("word").alias("text"), place(F.col("_at")).alias("x0"), F.col("y0").cast("double").alias("y0"),
                                               place(F.col("_at") + F.length("word")).alias("x1"), F.col("y1").cast("double").alias("y1"))
    return words.select("*", (F.col("width") * 1.6).alias("height"), F.lit(False).alias("signature"), F.lit(False).alias("foot"))


def page_texts(spark, d):
    """The lines of each leaf in reading order, with their places in the joined text."""
    return L.read_pages(_spread_words(spark, d), ["leaf"])


def side_levels(spark, d):
    """The indent level of each line of a column whose left edges fall into levels."""
    lines = page_lines(spark, d).select("leaf", "n", (F.col("para") * 1000 + F.col("line")).alias("at"), F.col("x0").cast("double").alias("x0"), F.col("y0").cast("double").alias("y0"), F.lit(157.0).alias("step"))
    return L.levels(lines, ["leaf", "n"], "at", "step")


def column_edges(spark, d):
    """The flush edge and the indent of each column's lines."""
    lines = page_lines(spark, d).select("leaf", "n", F.col("x0").cast("double").alias("x0"), (F.min("x0").over(Window.partitionBy("leaf", "n"))).alias("least"))
    return L.edges(lines.select("leaf", "n", F.col("x0") - F.col("least") + 0.0 * F.col("least")).toDF("leaf", "n", "x0"), ["leaf", "n"], 0.0)


def line_gutters(spark, d):
    """Per leaf the place about the middle that the fewest body lines cross, of pages of two columns."""
    return G.body_gutter(page_lines(spark, d).select("leaf", "width", "x0", "x1"), ["leaf"], "width")


def lines_of_letters(spark, d):
    """The printed line of text_d that holds each hundredth letter."""
    p = table(spark, d, "paragraphs").groupBy("para_id").agg(F.max("text_d").alias("t")).where("t != ''")
    w = Window.partitionBy("para_id").orderBy("k")
    lines = p.select("para_id", F.posexplode(F.split("t", "\n")).alias("k", "line"))
    start = F.coalesce(F.sum(F.length("line") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.withColumn("start", start.cast("int")).select("para_id", "start", (F.col("start") + F.length("line")).cast("int").alias("end"))
    letters = p.select("para_id", F.explode(F.sequence(F.lit(0), F.length("t") - 1, F.lit(100))).alias("at"))
    return L.line_of_offset(letters, lines, ["para_id"], "at")


def nearest_openings(spark, d):
    """For each line the left edge of the nearest paragraph opening of its column by height."""
    lines = page_lines(spark, d).select("leaf", "n", "para", "line", "y0", "x0", "hanging")
    marks = lines.where("hanging and line = 1").groupBy("leaf", "n", "y0").agg(F.min("x0").alias("edge"))
    return L.nearest_row(lines.select("leaf", "n", "para", "line", "y0"), marks, ["leaf", "n"], "y0", "edge")


def word_hosts(spark, d):
    """The words of a leaf that have a box, each with the line that shares most of its height."""
    from corpusloom.plans.geometry import _words

    lines = page_lines(spark, d).select("leaf", "n", F.concat_ws("/", "para", "line").alias("id"), F.col("y0").cast("double").alias("y0"), F.col("y1").cast("double").alias("y1"))
    words = _words(spark, d).groupBy("leaf", "n", "y0", "y1").agg(F.min("text").alias("t")).select("leaf", "n", F.concat_ws(":", F.lit("w"), "y0", "y1").alias("id"), "y0", "y1")
    return L.hosts(words, lines, ["leaf", "n"], "id")


def merged_rows(spark, d):
    """The lines of a leaf on one baseline, of both columns, as rows."""
    pieces = page_lines(spark, d).where("base is not null and text is not null").select("leaf", F.col("base").cast("double").alias("base"), "x0", "y0", "x1", "y1", "text")
    return L.merged_fragments(pieces, ["leaf"])


def suspect_readings(spark, d):
    """Places where d and b (a stand-in) agree against the voted text."""
    return V.suspect_places(_other_texts(spark, d).where("c is not null"), ["para_id"], "c", ["d", "b"])


def text_differences(spark, d):
    return V.text_differences(_other_texts(spark, d), ["para_id"], "c", "d")


def head_readings(spark, d):
    """The head of each paragraph as the voted text has it, and as d reads it."""
    t = _other_texts(spark, d).where("c is not null and d is not null").select("para_id", "c", "d")

    def run(batches):
        for pdf in batches:
            rows = [(k, r["truth"], r["d"], r["d_ok"]) for k, c, x in pdf.itertuples(index=False, name=None) for r in V.head_readings(parse_truth(c.replace("\n", " ")), {"d": x})]
            yield pd.DataFrame(rows, columns=["para_id", "truth", "d", "ok"])

    return t.mapInPandas(run, "para_id string, truth string, d string, ok boolean")


def doubtful_starts(spark, d):
    lines = page_lines(spark, d).where("text is not null").select("leaf", "n", "para", F.col("line").alias("row"), "text", "x1", "ind", (F.coalesce("hanging", F.lit(False)) & (F.col("line") == 1)).alias("start"))
    return V.doubtful_starts(lines, ["leaf", "n"], ["para", "row"], "start")


def line_markers(spark, d):
    """Where the printed lines of text_d begin in the voted text, and whether that is doubtful."""
    t = _other_texts(spark, d).where("c is not null and d is not null").select("para_id", "c", "d")

    def run(batches):
        for pdf in batches:
            rows = [(k, *V.line_markers(c.replace("\n", " "), x.split("\n"))) for k, c, x in pdf.itertuples(index=False, name=None)]
            yield pd.DataFrame(rows, columns=["para_id", "starts", "doubt"])

    return t.mapInPandas(run, "para_id string, starts array<int>, doubt string")


def witness_coverage(spark, d):
    """Of each witness how many disputed places it reads at all, and how many as the voted text."""
    p = table(spark, d, "paragraphs").groupBy("para_id").agg(F.max("text_merged").alias("t"))
    x = table(spark, d, "disputes").select("item_id", "para_id", "s", "e", "read_d", "read_b", "read_a").distinct().join(p, "para_id", "left")
    each = x.select("t", "s", "e", F.explode(F.map_from_arrays(F.array(*map(F.lit, "DBA")), F.array("read_d", "read_b", "read_a"))).alias("witness", "read"))
    return V.coverage(each, "witness", reads=F.coalesce("read", F.lit("")) != "", right=F.col("read") == F.substring("t", F.col("s") + 1, F.col("e") - F.col("s")))


def label_forms(spark, d):
    """Heads as labels: the compared form, and the spacing as printed."""
    e = table(spark, d, "entries").select("id", "headword").where("headword is not null").distinct()
    return e.select("id", S.label_forms("headword").alias("label"), S.clean_label(F.col("headword")).alias("clean"), F.length(F.regexp_replace("headword", r"\P{L}", "")).alias("letters"))


def same_heads(spark, d):
    """The civil head beside the head of the entry's paragraph, and whether they are alike."""
    e = table(spark, d, "entries").where("headword_civil is not null").groupBy("id").agg(F.max("headword_civil").alias("h"))
    p = table(spark, d, "paragraphs").groupBy(F.col("para_id").alias("id")).agg(F.max("text_merged").alias("t")).where("t is not null")
    j = e.join(p, "id").select("id", "h", S.head_of(F.col("t")).alias("read"))
    return j.select("id", "read", S.same_head(F.col("h"), F.col("read")).alias("same"))


def head_types(spark, d):
    """The spans of heads that stand in the head's own type."""
    e = table(spark, d, "entries").select("id", "headword").where("headword is not null").distinct()

    def run(batches):
        for pdf in batches:
            rows = [(k, s, t) for k, h in pdf.itertuples(index=False, name=None) for s, t in S.script_spans(h)]
            yield pd.DataFrame(rows, columns=["id", "s", "e"])

    return e.mapInPandas(run, "id string, s int, e int")


def head_fits(spark, d):
    """Where in a paragraph's beginning its entry's head ends, by edits."""
    e = table(spark, d, "entries").where("headword != ''").groupBy("id").agg(F.max("headword").alias("h"))
    p = table(spark, d, "paragraphs").groupBy(F.col("para_id").alias("id")).agg(F.max("text_merged").alias("t")).where("t is not null")
    return e.join(p, "id").select("id", S.prefix_ends("h", "t").alias("ends"))


def typst_entries(spark, d):
    """Definitions as typesetting takes them."""
    e = table(spark, d, "entries").select("id", "definition").where("definition is not null").distinct()
    return e.select("id", S.typst_text(F.col("definition")).alias("markup"))


def alphabet_names(spark, d):
    """Every character of the heads, with its code point and name, and how often it stands."""
    e = table(spark, d, "entries").select("id", "headword").where("headword is not null").distinct()
    each = e.select(F.explode(F.split("headword", "")).alias("ch")).where("ch != ''").groupBy("ch").agg(F.count("*").alias("n"))
    return each.select("ch", S.char_names("ch").alias("name"), "n")


def leaf_arithmetic(spark, d):
    """Of every leaf its section, printed page, pages in the other copies, signature, foot and sheet."""
    leaves = table(spark, d, "manifest").select(F.col("idx").alias("leaf")).distinct()
    numbers = S.leaf_numbers(F.col("leaf"))
    return leaves.select("leaf", S.section_of(F.col("leaf"), SECTIONS).alias("section"), *[c.alias(name) for name, c in numbers.items()])


def encoded_texts(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.regexp_replace(F.base64(F.encode("text", "utf-8")), r"\s", "").alias("data"))


def letter_runs(spark, d):
    """The printed word about the tenth character of each definition."""
    e = table(spark, d, "entries").select("id", "definition").where("definition is not null").distinct()
    return e.select("id", S.letter_run(F.col("definition"), 10).alias("run"))


def page_report(spark, d):
    """Per leaf: columns, paragraphs, lines, hints, hints with a "=", "=" signs in the lines; and the sums of all (leaf NULL)."""
    now = cut(_records(spark, d))
    lines = P.layout_table(now, P.LINE, [], ["text"]).groupBy("leaf").agg(F.count("*").alias("lines"), F.sum(F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "[^=]", ""))).alias("eq_signs"))
    paragraphs = P.layout_table(now, P.PARAGRAPH, [], ["hanging"]).groupBy("leaf").agg(F.countDistinct("n").alias("columns"), F.count("*").alias("paragraphs"))
    hints = _hints(now).groupBy("leaf").agg(F.count("*").alias("hints"), F.sum(F.coalesce("eq", F.lit(False)).cast("long")).alias("hints_eq"))
    names = ["columns", "paragraphs", "lines", "eq_signs", "hints", "hints_eq"]
    each = now.select("leaf").distinct().join(paragraphs, "leaf", "left").join(lines, "leaf", "left").join(hints, "leaf", "left").na.fill(0, names)
    return each.rollup("leaf").agg(*[F.sum(c).alias(c) for c in names])


def margin_sides(spark, d):
    """The sides of pages whose margin the scan cut off, by the records' warnings."""
    told = F.coalesce(F.from_json(F.get_json_object("body", "$.warnings"), "array<string>"), F.array().cast("array<string>"))
    each = table(spark, d, "page_json").select("leaf", T.cut_margins(told).alias("sides")).where("size(sides) > 0")
    return each.select("leaf", F.explode("sides").alias("side")).distinct()


def reader_disagreements(spark, d):
    """Entries whose head is read otherwise than it is spelt, not yet checked and not among the tested ones."""
    e = table(spark, d, "entries").where("headword is not null and headword_civil is not null").groupBy("id").agg(F.max("headword").alias("h"), F.max("headword_civil").alias("c"), F.max("status").alias("status"))
    seen = table(spark, d, "entries").where("hw_source = 'manual'").select("id").distinct()
    return e.where((X.civil(F.col("h")) != F.col("c")) & (F.coalesce("status", F.lit("")) != "checked")).join(seen, "id", "left_anti").select("id", "h", "c")


def _letters(spark, d):
    m = table(spark, d, "manifest").groupBy(F.col("idx").alias("leaf")).agg(F.max("letter").alias("letter"))
    return m.select("leaf", F.filter(F.split(F.coalesce("letter", F.lit("")), r"[,\s]+"), lambda x: x != "").alias("letters"))


def letter_checks(spark, d):
    """Leaves where the letters that begin there by the manifest are not as many as the headings found."""
    first = _letters(spark, d).select("leaf", F.explode("letters").alias("letter")).groupBy("letter").agg(F.min("leaf").alias("leaf"))
    starts = first.groupBy("leaf").agg(F.count("*").alias("starts"))
    heads = P.page_children(table(spark, d, "page_json")).where("kind = 'heading'").groupBy(F.col("idx").alias("leaf")).agg(F.count("*").alias("headings"))
    pages = latest(shredded(table(spark, d, "page_json"), "body", ["leaf", "written_at"], {"section": None}), "leaf", "written_at").select("leaf").distinct()
    j = pages.join(starts, "leaf", "left").join(heads, "leaf", "left").na.fill(0, ["starts", "headings"])
    return j.where("starts != headings")


class _Sections:
    """Which letter's section begins before an entry: letters wait in the order of the manifest until an entry begins with
    one, or its leaf begins and has it first (or has it no more)."""

    def __init__(self) -> None:
        self.known: set[str] = set()
        self.waiting: list[str] = []
        self.leaf = None

    def before(self, leaf: int, letters: list[str], first: str) -> str | None:
        opens, self.leaf = leaf != self.leaf, leaf
        new = [x for x in letters if x not in self.known]
        self.waiting += list(dict.fromkeys(new))
        self.known.update(new)
        if not self.waiting:
            return None
        due = self.waiting[0]
        if first == due.lower() or (opens and (letters[:1] == [due] or due not in letters)):
            return self.waiting.pop(0)
        return None


def letter_sections(spark, d):
    """The entries before which a letter's section begins."""
    e = table(spark, d, "entries").groupBy("id", "part").agg(F.max("headword_civil").alias("h")).where("part is not null")
    e = e.withColumn("leaf", F.split("id", "-")[0].try_cast("int")).join(_letters(spark, d), "leaf", "left")
    rows = e.select("part", "leaf", "id", F.lower(F.substring(F.coalesce("h", F.lit("")), 1, 1)).alias("first"), F.coalesce("letters", F.array().cast("array<string>")).alias("letters"))
    step = lambda s, r: s.before(r.leaf, list(r.letters), r.first)
    return O.scanned(rows, "part", ["leaf", "id"], "section", "string", lambda r: _Sections(), step).where("section is not null").select("part", "id", "section")


def typst_sections(spark, d):
    """The dictionary for typesetting: a line a word, with its letter and its place in it."""
    w = table(spark, d, "dictionary_psv").where("lemma is not null").groupBy("lemma_id").agg(F.max("lemma").alias("lemma"), F.max(F.coalesce("pos", F.lit("?"))).alias("pos"), F.max(F.coalesce("ru", F.lit("—"))).alias("ru"))
    line = F.concat(F.lit('#entry("'), F.replace(F.col("lemma"), F.lit('"'), F.lit('\\"')), F.lit('", "'), "pos", F.lit('")['), "ru", F.lit("]"))
    k = X.sort_key(F.col("lemma"))
    keyed = w.select("lemma_id", k.alias("k"), line.alias("line")).withColumn("letter", F.upper(F.substring("k", 1, 1)))
    return keyed.select("letter", "lemma_id", F.row_number().over(Window.partitionBy("letter").orderBy("k", "lemma_id")).alias("place"), "line")


def form_pages(spark, d):
    """The index of forms: each form of the dictionary with its words, in order."""
    f = table(spark, d, "dictionary_psv").select("lemma_id", F.explode("forms").alias("form")).where("form is not null").distinct()
    return f.groupBy("form").agg(F.array_join(F.array_sort(F.collect_list("lemma_id")), ";").alias("words"), F.count("*").alias("n"))


def layer_round_trip(spark, d):
    """Words written as a text layer and read back: what differs (nothing)."""
    from corpusloom.plans.geometry import _words

    return layer_differences(_words(spark, d).where("text is not null and width is not null"))


def layer_differences(words):
    """The words of leaves (leaf, width, text and box) that a layer written of them loses (side "lost") or has beside them
    ("new"), each as often. They are moved once, by leaf; a leaf's layer is read and compared where it is written."""
    cols = ["text", "x0", "y0", "x1", "y1"]
    per = words.select("leaf", "width", *cols).repartition("leaf").distinct().groupBy("leaf").agg(F.max("width").alias("wide"), F.collect_list(F.struct(*cols)).alias("mine"))
    escaped = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    mark = lambda w: F.concat(F.lit('<word xMin="'), w["x0"], F.lit('" yMin="'), w["y0"], F.lit('" xMax="'), w["x1"], F.lit('" yMax="'), w["y1"], F.lit('">'), escaped(w["text"]), F.lit("</word>"))
    value = F.concat(F.lit('<page width="'), "wide", F.lit('" height="1000">'), F.array_join(F.transform("mine", mark), "\n"))
    layer = per.select("leaf", F.col("wide").cast("int").alias("wide"), "mine", value.alias("value"))
    mine = F.transform("mine", lambda w: F.struct(F.lit(1).alias("n"), *[w[c].alias(c) for c in cols], F.lit(None).cast("string").alias("mark")))
    none = [F.lit(None).cast("string" if c == "text" else "double").alias(c) for c in cols]
    back = F.transform(W.layer_marks(F.col("value")), lambda m: F.struct(F.lit(-1).alias("n"), *none, m.alias("mark")))
    one = layer.select("leaf", F.inline(F.array(F.struct("wide", W.layer_size(F.col("value"))[0].cast("int").alias("width"), F.concat(mine, back).alias("ws")))))
    each = one.select("leaf", "wide", "width", F.explode("ws").alias("w"))
    is_back = F.col("w.n") < 0
    read = [F.when(is_back, r).otherwise(F.col(f"w.{c}")).alias(c) for c, r in zip(cols, W.layer_word(F.col("w.mark")))]
    rows = each.select("leaf", F.when(is_back, F.col("width")).otherwise(F.col("wide")).alias("width"), *read, F.col("w.n").alias("n"))

    def differ(batches):
        """The rows of a leaf follow each other."""
        leaf, left = None, Counter()
        told = lambda: [(*key, "lost" if n > 0 else "new") for key, n in left.items() for _ in range(abs(n))]
        for pdf in batches:
            out = []
            for *key, n in pdf.itertuples(index=False, name=None):
                if key[0] != leaf:
                    out += told()
                    leaf, left = key[0], Counter()
                left[tuple(key)] += n
            yield pd.DataFrame(out, columns=["leaf", "width", *cols, "side"])
        yield pd.DataFrame(told(), columns=["leaf", "width", *cols, "side"])

    return rows.mapInPandas(differ, "leaf int, width int, text string, x0 double, y0 double, x1 double, y1 double, side string")


def text_checks(spark, d):
    """Texts against a list of checksums in which every third is wrong and every fifth is not listed."""
    t = table(spark, d, "documents").where("text is not null").select(F.col("doc_id").cast("string").alias("name"), F.encode("text", "utf-8").alias("content"), "doc_id")
    listed = t.where("doc_id % 5 != 0").select("name", F.when(F.col("doc_id") % 3 == 0, F.md5(F.lit("x"))).otherwise(F.md5("content")).alias("md5"))
    return W.verified(t.select("name", "content"), listed)


def _layout_input(spark, d):
    """Lines, pages, pictures and verdicts as the layout takes them, of the current records (which hold no pictures)."""
    lines = page_lines(spark, d).where("text is not null and base is not null")
    lines = lines.select("leaf", "base", "x0", "y0", "x1", "y1", "text", F.coalesce("fs", F.lit(10.0)).alias("fs"), (F.col("y1") - F.col("y0")).alias("height"), F.lit(-1).alias("conf"))
    spec = {"size": list, "rule": list, "section": None, "printed_page": None}

    def run(batches):
        from corpusloom.operators.shred import Levels

        for pdf in batches:
            rows = [(leaf, *(lv.value(c)[0] for c in spec)) for leaf, cols in zip(pdf["leaf"], pdf["cols"]) for lv in (Levels(cols),)]
            yield pd.DataFrame(rows, columns=["leaf", *spec])

    now = latest(shredded(table(spark, d, "page_json"), "body", ["leaf", "written_at"], spec), "leaf", "written_at")
    told = now.mapInPandas(run, "leaf int, size string, rule string, section string, printed_page string")
    number = lambda c, k: F.get(F.from_json(c, "array<string>"), F.lit(k)).try_cast("double")
    pages = told.select("leaf", number("size", 0).alias("width"), number("size", 1).alias("tall"), F.coalesce("section", F.lit("main")).alias("section"), F.col("printed_page").try_cast("int").alias("page"), number("rule", 0).alias("g0"), number("rule", 1).alias("g1"))
    pictures = lines.limit(0).select("leaf", "x0", "y0", "x1", "y1")
    verdicts = spark.createDataFrame([], "leaf int, side string, base int, verdict string")
    return lines, pages.where("width is not null and tall is not null"), pictures, verdicts


def laid_out_lines(spark, d):
    """The lines of each leaf laid out: column, paragraph, row, indent, and what tells so."""
    return Y.laid_out(*_layout_input(spark, d))


def layout_hints(spark, d):
    """The heads of the paragraphs that the layout finds."""
    return Y.hints(laid_out_lines(spark, d))


def paired_lines(spark, d):
    """The printed lines of d beside those of the voted text, by alignment."""
    t = _other_texts(spark, d).where("c is not null and d is not null").select("para_id", "c", "d")
    starts = lambda text: [0, *(k + 1 for k, ch in enumerate(text) if ch == "\n")]

    def run(batches):
        for pdf in batches:
            rows = [(key, k, q) for key, c, x in pdf.itertuples(index=False, name=None) for k, q in enumerate(Z.paired_lines(c, starts(c), x, starts(x)))]
            yield pd.DataFrame(rows, columns=["para_id", "line", "of_d"]).astype({"of_d": "Int32"})

    return t.mapInPandas(run, "para_id string, line int, of_d int")


def line_verdicts(spark, d):
    """The lines that two measures of the same page (indents as recorded, and levels of their left edges) both take for starts or
    for continuations."""
    lines = page_lines(spark, d).where("ind is not null and x0 is not null and y0 is not null")
    lines = lines.select("leaf", "n", (F.col("para") * 1000 + F.col("line")).alias("at"), "ind", "x0", "y0", (F.coalesce("hanging", F.lit(False)) & (F.col("line") == 1)).alias("start"))
    measured = L.levels(lines.select("leaf", "n", "at", F.col("x0").cast("double").alias("x0"), F.col("y0").cast("double").alias("y0"), F.lit(157.0).alias("step")), ["leaf", "n"], "at", "step")
    one = Z.witness_verdicts(lines.select("leaf", "n", "at", F.col("ind").alias("level"), "start"), ["leaf", "n"], "at").withColumn("w", F.lit("recorded"))
    two = Z.witness_verdicts(measured.join(lines.select("leaf", "n", "at", "start"), ["leaf", "n", "at"]), ["leaf", "n"], "at").withColumn("w", F.lit("measured"))
    return Z.agreed(one.unionByName(two), ["leaf", "n", "at"], "w")


def page_rows(spark, d):
    """Pages as text, a row of JSON for each printed line."""
    return U.page_dump(page_lines(spark, d).select("leaf", "n", "para", "line", "x0", "y0", "text"), ["leaf"], ["n", "para", "line"])


def stored_readings(spark, d):
    """Heads as they were read (each entry's newest row), with the texts of the paragraph that confirm them."""
    p = table(spark, d, "paragraphs").groupBy(F.col("para_id").alias("id")).agg(F.max("text_d").alias("d"), F.max("text_merged").alias("m"))
    r = table(spark, d, "entries").where("hw_source in ('vision', 'manual')").select("id", F.col("headword").alias("reading"), F.col("hw_source").alias("source"), F.coalesce("status", F.lit("")).alias("read_at")).distinct()
    return U.stored_readings(p, r, ["id"], {"D": "d", "M": "m"}).select("id", "headword", "headword_source", "confirmed_by", "check")


def zone_scores(spark, d):
    """Errors of each reader against the voted text by zone (head, definition, Greek), and exact heads: per leaf and reader. b and a
    are stand-ins."""
    from corpusloom.operators.align import scored
    from corpusloom.session import spread

    t = _other_texts(spark, d).where("c is not null").select("leaf", "c", F.explode(F.map_from_arrays(F.array(F.lit("d"), F.lit("b"), F.lit("a")), F.array("d", "b", "a"))).alias("cand", "text"))
    names = ["n", "dist", "hw_n", "hw_err", "def_n", "def_err", "grc_n", "grc_err", "hw_count", "hw_exact"]

    def run(batches):
        for pdf in batches:
            rows = []
            for leaf, c, cand, text in pdf.itertuples(index=False, name=None):
                got = scored(parse_truth(c.replace("\n", " ")), text or "", None)
                rows.append((leaf, cand, *(got[x] for x in names)))
            yield pd.DataFrame(rows, columns=["leaf", "cand", *names])

    each = spread(t).mapInPandas(run, "leaf int, cand string, " + ", ".join(f"{x} long" for x in names))
    sums = each.groupBy("leaf", "cand").agg(*[F.sum(x).alias(x) for x in names])
    return sums.withColumn("cer", F.round(F.col("dist") / F.greatest("n", F.lit(1)), 6))


def newest_rows(spark, d):
    """Heads as they were answered, each with the newest row of its entry that showed the same head."""
    e = table(spark, d, "entries").where("headword is not null and status is not null")
    answers = e.where("hw_source = 'manual'").select("id", F.col("headword").alias("saw")).distinct()
    return U.newest_match(answers, e.groupBy("id", "headword", "status").agg(F.max(F.coalesce("flags", F.lit(""))).alias("flags")), "id", "headword", "status")


def label_samples(spark, d):
    """Lines to learn from: those of the voted text that keeps its printed lines, beside d's where it has as many."""
    p = table(spark, d, "paragraphs").groupBy("para_id", "leaf", "col", "para").agg(F.max("text_merged").alias("text"), F.max("text_d").alias("d"), F.max("disputed").alias("spans"))
    p = p.where("size(split(text, '\n')) = size(split(d, '\n'))")
    spans = F.transform(F.filter(F.coalesce("spans", F.array().cast("array<array<int>>")), lambda x: F.size(x) == 2), lambda x: F.struct(x[0].alias("s"), x[1].alias("e"))).cast("array<struct<s:int,e:int>>")
    lines = p.select("leaf", F.col("col").alias("n"), "para", "text", spans.alias("disputed"), "d", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    w = Window.partitionBy("leaf", "n", "para").orderBy("i")
    b0 = F.coalesce(F.sum(F.length("line") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int")
    lines = lines.withColumn("b0", b0).withColumn("b1", (F.col("b0") + F.length("line")).cast("int")).withColumn("read", F.get(F.split("d", "\n"), F.col("i")))
    rows = lines.select("leaf", "n", (F.col("para") * 100 + F.col("i")).alias("k"), (F.col("i") + 1).alias("row"), "text", "disputed", "b0", "b1", F.lit(False).alias("hyphen"), "read",
                        F.lit(100).alias("x0"), F.lit(1000).alias("x1"), F.lit(4000).alias("width"), F.lit(False).alias("cut"))
    return B.labelled(rows)


def page_requests(spark, d):
    """A request for each leaf's provisional heads, in batches of 250 leaves."""
    e = table(spark, d, "entries").where("hw_source = 'D' and headword is not null").groupBy("id").agg(F.max("headword").alias("h"))
    return R.requests(e.withColumn("leaf", F.split("id", "-")[0].try_cast("int")), "leaf", ["id"], "h", [("Слѡво", "Слѡво"), ("■", None)])


def request_ledger(spark, d):
    """The batches of ``page_requests``."""
    return R.ledger(page_requests(spark, d), "leaf")


def review_sheets(spark, d):
    """Sheets of fifteen heads that two readers read otherwise, drawn by seed: a line for the reviewer each."""
    drawn = U.seeded_sample(reader_disagreements(spark, d), "id", 7, 60)
    place = F.row_number().over(Window.orderBy("id")) - 1  # sixty rows
    k = (place % 15 + 1).cast("string")
    return drawn.select((F.floor(place / 15) + 1).cast("int").alias("sheet"), "id", F.concat_ws("\t", k, F.col("id"), F.concat(F.lit("a: "), "h"), F.concat(F.lit("b: "), "c"), F.lit("")).alias("line"))


def validation_lines(spark, d):
    """The report of the entries' flags: three hundred of each flag, and how many more there are."""
    e = table(spark, d, "entries").groupBy("id").agg(*[F.max(c).alias(c) for c in ("page", "col", "headword", "sep", "definition", "flags")])
    each = e.withColumn("flag", F.explode(F.split(F.coalesce("flags", F.lit("")), ";"))).where("flag != ''")
    text = F.coalesce("definition", F.lit(""))
    line = F.concat(F.lit("- `"), "id", F.lit("` p. "), F.coalesce("page", F.lit("")), F.coalesce("col", F.lit("")), F.lit(" **"), F.coalesce("headword", F.lit("")), F.lit("** "), F.coalesce("sep", F.lit("")), F.lit(" "),
                    F.substring(text, 1, 70), F.when(F.length(text) > 70, "…").otherwise(""))
    ranked = each.select("flag", "id", line.alias("line")).withColumn("place", F.row_number().over(Window.partitionBy("flag").orderBy("id")))
    more = each.groupBy("flag").agg((F.count("*") - 300).alias("n")).where("n > 0").select("flag", F.lit(301).alias("place"), F.concat(F.lit("- … and "), F.col("n").cast("string"), F.lit(" more")).alias("line"))
    return ranked.where("place <= 300").select("flag", "place", "line").unionByName(more)


def errata_summary(spark, d):
    """How many corrections were found in the paragraph of their line, elsewhere on the page, or not."""
    from corpusloom.plans.corrections import errata_located

    return errata_located(spark, d).groupBy("how").agg(F.count("*").alias("n"))


def letter_index(spark, d):
    """The index of letters of the dictionary, in order."""
    w = table(spark, d, "dictionary_psv").where("lemma is not null").select(F.upper(F.substring(X.sort_key(F.col("lemma")), 1, 1)).alias("letter")).where("letter != ''").distinct()
    link = F.transform(F.array_sort(F.collect_list("letter")), lambda x: F.concat(F.lit("["), x, F.lit("](#"), F.lower(x), F.lit(")")))
    return w.agg(F.array_join(link, " · ").alias("line"))


QUERIES = {
    f.__name__: f
    for f in (zone_scores, newest_rows, label_samples, page_requests, request_ledger, review_sheets, validation_lines, errata_summary, letter_index, laid_out_lines, layout_hints, paired_lines, line_verdicts, page_rows, stored_readings, head_hints, parsed_entries, merged_texts, voted_pages, page_texts, side_levels, column_edges, line_gutters, lines_of_letters, nearest_openings, word_hosts, merged_rows,
              suspect_readings, text_differences, head_readings, doubtful_starts, line_markers, witness_coverage, label_forms, same_heads, head_types, head_fits, typst_entries,
              alphabet_names, leaf_arithmetic, encoded_texts, letter_runs, page_report, margin_sides, reader_disagreements, letter_checks, letter_sections, typst_sections, form_pages,
              layer_round_trip, text_checks)
}

_SECTION = " ".join(f"WHEN leaf BETWEEN {lo} AND {hi} THEN '{name}'" for name, lo, hi in SECTIONS)
_P = "p AS (SELECT para_id, max(text_d) AS t FROM paragraphs GROUP BY para_id)"

ORACLE = {
    "lines_of_letters": f"""WITH {_P}, c AS (SELECT para_id, t, unnest(range(length(t)::INT)) AS x FROM p WHERE t <> ''), l AS (SELECT para_id, x FROM c WHERE substr(t, (x + 1)::INT, 1) = chr(10)),
        s AS (SELECT para_id, 0 AS start FROM p WHERE t <> '' UNION ALL SELECT para_id, x + 1 FROM l), o AS (SELECT para_id, unnest(range(0, length(t)::INT, 100)) AS x FROM p WHERE t <> '')
        SELECT o.para_id, o.x::INT AS "at", (SELECT max(s.start) FROM s WHERE s.para_id = o.para_id AND s.start <= o.x)::INT AS line_start FROM o""",
    "witness_coverage": """WITH p AS (SELECT para_id, max(text_merged) AS t FROM paragraphs GROUP BY para_id), x AS (SELECT DISTINCT item_id, para_id, s, e, read_d, read_b, read_a FROM disputes),
        j AS (SELECT x.*, substr(t, s + 1, e - s) AS v FROM x LEFT JOIN p USING (para_id)), r AS (SELECT 'D' AS witness, read_d AS r, v FROM j UNION ALL SELECT 'B', read_b, v FROM j UNION ALL SELECT 'A', read_a, v FROM j)
        SELECT witness, count(*) AS n, count(*) FILTER (coalesce(r, '') <> '') AS reads, count(*) FILTER (r = v) AS right, round(count(*) FILTER (coalesce(r, '') <> '') / count(*), 6) AS reads_share, round(count(*) FILTER (r = v) / count(*), 6) AS right_share FROM r GROUP BY witness""",
    "same_heads": r"""WITH e AS (SELECT id, max(headword_civil) AS h FROM entries WHERE headword_civil IS NOT NULL GROUP BY id), p AS (SELECT para_id AS id, max(text_merged) AS t FROM paragraphs GROUP BY para_id HAVING max(text_merged) IS NOT NULL),
        c AS (SELECT id, h, CASE WHEN regexp_matches(t, '=|\(|\s-|-\s|-$') THEN regexp_extract(t, '^((?s).*?)(?:=|\(|\s-|-\s|-$)', 1) ELSE split_part(t, ' ', 1) END AS x FROM e JOIN p USING (id)),
        r AS (SELECT id, replace(h, ' ', '') AS a, regexp_replace(trim(x, ' '), '^[.,;:\-]+|[.,;:\-]+$', '', 'g') AS read FROM c), s AS (SELECT *, replace(read, ' ', '') AS b FROM r)
        SELECT id, read, a = b OR (a <> '' AND starts_with(b, a || '-')) OR (b <> '' AND starts_with(a, b || '-')) AS same FROM s""",
    "leaf_arithmetic": f"""SELECT DISTINCT leaf, CASE {_SECTION} ELSE '' END AS section, leaf - 37 AS page, leaf + 11 AS d_page, leaf - 37 AS b_page, CASE WHEN leaf - 37 <= 566 THEN 1 ELSE 2 END AS c_volume,
        CASE WHEN leaf - 37 <= 566 THEN leaf + 9 ELSE leaf - 595 END AS c_page, (((leaf - 37) % 16) + 16) % 16 IN (1, 3) AS signature, (((leaf - 37) % 16) + 16) % 16 = 1 AS foot, floor((leaf - 38) / 16)::BIGINT + 1 AS sheet FROM (SELECT idx AS leaf FROM manifest)""",
    "encoded_texts": "SELECT doc_id, base64(encode(text)) AS data FROM documents WHERE text IS NOT NULL",
    "letter_runs": r"""SELECT id, regexp_extract(left(definition, 10), '[\p{L}\p{M}]*$') || regexp_extract(substr(definition, 11), '^[\p{L}\p{M}]*') AS run FROM (SELECT DISTINCT id, definition FROM entries WHERE definition IS NOT NULL)""",
    "typst_sections": r"""WITH w AS (SELECT lemma_id, max(lemma) AS lemma, max(coalesce(pos, '?')) AS pos, max(coalesce(ru, '—')) AS ru FROM dictionary_psv WHERE lemma IS NOT NULL GROUP BY lemma_id),
        k AS (SELECT *, trim(lower(replace(regexp_replace(lemma, '\s*\([^)]*\)', '', 'g'), chr(769), '')), ' ') AS k FROM w)
        SELECT upper(left(k, 1)) AS letter, lemma_id, row_number() OVER (PARTITION BY upper(left(k, 1)) ORDER BY k, lemma_id)::INT AS place, '#entry("' || replace(lemma, '"', '\"') || '", "' || pos || '")[' || ru || ']' AS line FROM k""",
    "form_pages": """SELECT form, string_agg(lemma_id, ';' ORDER BY lemma_id) AS words, count(*) AS n FROM (SELECT DISTINCT lemma_id, unnest(forms) AS form FROM dictionary_psv) WHERE form IS NOT NULL GROUP BY form""",
    "text_checks": """SELECT doc_id::VARCHAR AS name, CASE WHEN doc_id % 5 = 0 THEN 'unlisted' WHEN doc_id % 3 = 0 THEN 'changed' ELSE 'ok' END AS status FROM documents WHERE text IS NOT NULL""",
    "layer_round_trip": "SELECT 0 AS leaf, 0 AS width, '' AS text, 0.0 AS x0, 0.0 AS y0, 0.0 AS x1, 0.0 AS y1, '' AS side WHERE false",
    "reader_disagreements": f"""WITH e AS (SELECT id, max(headword) AS h, max(headword_civil) AS c, max(status) AS status FROM entries WHERE headword IS NOT NULL AND headword_civil IS NOT NULL GROUP BY id)
        SELECT id, h, c FROM e WHERE {X.civil_sql('h')} <> c AND coalesce(status, '') <> 'checked' AND id NOT IN (SELECT id FROM entries WHERE hw_source = 'manual')""",
    "typst_entries": r"""WITH d AS (SELECT DISTINCT id, definition AS x FROM entries WHERE definition IS NOT NULL), a AS (SELECT id, regexp_replace(replace(x, '\', '\\'), '([#$*_`<>@\[\]~])', '\\\1', 'g') AS x FROM d),
        b AS (SELECT id, replace(replace(replace(x, '//', '\/\/'), '/*', '/\*'), '--', '—') AS x FROM a), c AS (SELECT id, regexp_replace(regexp_replace(x, '(\S) - (\S)', '\1 — \2', 'g'), '(\S) - (\S)', '\1 — \2', 'g') AS x FROM b),
        e AS (SELECT id, CASE WHEN regexp_matches(x, '^[-+=/]') THEN '\' || x ELSE x END AS x FROM c) SELECT id, regexp_replace(x, '^(\d+)\.(\s)', '\1\\.\2') AS markup FROM e""",
    "head_hints": rf"""WITH {PAGE_LINES}, tx AS (SELECT * FROM ln WHERE text IS NOT NULL), q AS (SELECT leaf, n, para, bool_or(contains(text, '=')) AS eq FROM tx WHERE line <= 2 GROUP BY leaf, n, para)
        SELECT leaf, n, para, regexp_replace(trim(regexp_extract(text, '^(.*?)(?:=|—|–|\(|\s-\s|\s-$|$)', 1), ' '), '[^\p{{L}}\p{{N}}]+$', '') AS head, eq FROM tx JOIN q USING (leaf, n, para) WHERE hanging AND line = 1""",
    "nearest_openings": f"""WITH {PAGE_LINES}, mk AS (SELECT leaf, n, y0 AS y, min(x0) AS edge FROM ln WHERE hanging AND line = 1 GROUP BY leaf, n, y0),
        j AS (SELECT ln.leaf, ln.n, para, line, ln.y0, edge, row_number() OVER (PARTITION BY ln.leaf, ln.n, para, line ORDER BY abs(mk.y - ln.y0), mk.y) AS k FROM ln LEFT JOIN mk ON mk.leaf = ln.leaf AND mk.n = ln.n) SELECT leaf, n, para, line, y0, edge FROM j WHERE k = 1""",
    "line_gutters": f"""WITH {PAGE_LINES}, bd AS (SELECT leaf, x0, x1, width::DOUBLE AS bw FROM ln WHERE x1 - x0 > 300), pg AS (SELECT leaf, max(bw) AS w, count(*) AS total FROM bd GROUP BY leaf HAVING count(*) >= 10),
        pt AS (SELECT leaf, w, total, unnest(range(floor(0.3 * w)::BIGINT, ceil(0.7 * w)::BIGINT, 10)) AS x FROM pg), cv AS (SELECT pt.leaf, x, w, total, count(bd.leaf) AS n FROM pt LEFT JOIN bd ON bd.leaf = pt.leaf AND x0 < x AND x1 > x GROUP BY pt.leaf, x, w, total)
        SELECT leaf, x::DOUBLE AS gutter FROM (SELECT *, row_number() OVER (PARTITION BY leaf ORDER BY n, abs(x - w / 2), x) AS k FROM cv) WHERE k = 1 AND n <= 0.1 * total""",
    "merged_rows": f"""WITH {PAGE_LINES}, pc AS (SELECT * FROM ln WHERE base IS NOT NULL AND text IS NOT NULL), nw AS (SELECT *, CASE WHEN base - lag(base) OVER (PARTITION BY leaf ORDER BY base, x0) < 25 THEN 0 ELSE 1 END AS fresh FROM pc),
        rw AS (SELECT *, sum(fresh) OVER (PARTITION BY leaf ORDER BY base, x0 ROWS UNBOUNDED PRECEDING) AS row_ FROM nw)
        SELECT leaf, row_::BIGINT AS line, string_agg(trim(text, ' '), ' ' ORDER BY x0, text) AS text, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM rw GROUP BY leaf, row_""",
    "page_report": f"""WITH {LINES}, {each('cur', 'b', 'entries_hint', 'h', 'leaf')}, hi AS (SELECT leaf, count(*) AS hints, count(*) FILTER (eq) AS hints_eq FROM (SELECT leaf, c_, p_, bool_or(TRY_CAST({scalar('h_e', 'eq')} AS BOOLEAN)) AS eq
        FROM (SELECT leaf, h_e, trim({scalar('h_e', 'col')}) AS c_, trunc(TRY_CAST({scalar('h_e', 'para')} AS DOUBLE))::INT AS p_ FROM h) GROUP BY ALL) GROUP BY leaf),
        li AS (SELECT leaf, count(*) AS lines, sum(length(regexp_replace(coalesce({scalar('l_e', 'text')}, ''), '[^=]', '', 'g')))::BIGINT AS eq_signs FROM l GROUP BY leaf), pa AS (SELECT leaf, count(DISTINCT n) AS columns, count(*) AS paragraphs FROM p GROUP BY leaf),
        al AS (SELECT leaf, coalesce(columns, 0) AS columns, coalesce(paragraphs, 0) AS paragraphs, coalesce(lines, 0) AS lines, coalesce(eq_signs, 0) AS eq_signs, coalesce(hints, 0) AS hints, coalesce(hints_eq, 0) AS hints_eq
        FROM cur LEFT JOIN pa USING (leaf) LEFT JOIN li USING (leaf) LEFT JOIN hi USING (leaf))
        SELECT leaf, sum(columns)::BIGINT AS columns, sum(paragraphs)::BIGINT AS paragraphs, sum(lines)::BIGINT AS lines, sum(eq_signs)::BIGINT AS eq_signs, sum(hints)::BIGINT AS hints, sum(hints_eq)::BIGINT AS hints_eq FROM al GROUP BY ROLLUP (leaf)""",
    "review_sheets": rf"""WITH e AS (SELECT id, max(headword) AS h, max(headword_civil) AS c, max(status) AS status FROM entries WHERE headword IS NOT NULL AND headword_civil IS NOT NULL GROUP BY id),
        r AS (SELECT id, h, c FROM e WHERE {X.civil_sql('h')} <> c AND coalesce(status, '') <> 'checked' AND id NOT IN (SELECT id FROM entries WHERE hw_source = 'manual')),
        s AS (SELECT * FROM r ORDER BY md5('7/' || id), id LIMIT 60), p AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS k FROM s)
        SELECT (k // 15 + 1)::INT AS sheet, id, (k % 15 + 1)::VARCHAR || chr(9) || id || chr(9) || 'a: ' || h || chr(9) || 'b: ' || c || chr(9) AS line FROM p""",
    "validation_lines": """WITH e AS (SELECT id, max(page) AS page, max(col) AS col, max(headword) AS h, max(sep) AS sep, coalesce(max(definition), '') AS d, max(flags) AS flags FROM entries GROUP BY id),
        x AS (SELECT *, unnest(string_split(coalesce(flags, ''), ';')) AS flag FROM e), f AS (SELECT flag, row_number() OVER (PARTITION BY flag ORDER BY id)::INT AS place, '- `' || id || '` p. ' || coalesce(page, '') || coalesce(col, '') || ' **' || coalesce(h, '') || '** ' ||
        coalesce(sep, '') || ' ' || left(d, 70) || CASE WHEN length(d) > 70 THEN '…' ELSE '' END AS line FROM x WHERE flag <> '')
        SELECT * FROM f WHERE place <= 300 UNION ALL SELECT flag, 301, '- … and ' || (count(*) - 300)::VARCHAR || ' more' FROM f GROUP BY flag HAVING count(*) > 300""",
    "letter_index": r"""WITH k AS (SELECT DISTINCT upper(left(trim(lower(replace(regexp_replace(lemma, '\s*\([^)]*\)', '', 'g'), chr(769), '')), ' '), 1)) AS l FROM dictionary_psv WHERE lemma IS NOT NULL)
        SELECT string_agg('[' || l || '](#' || lower(l) || ')', ' · ' ORDER BY l) AS line FROM k WHERE l <> ''""",
    "word_hosts": f"""WITH {WORDS}, fr AS (SELECT DISTINCT leaf, n, y0, y1 FROM wd), lx AS (SELECT leaf, n, para || '/' || line AS id, y0::DOUBLE AS a, y1::DOUBLE AS b FROM ln),
        j AS (SELECT fr.*, id, row_number() OVER (PARTITION BY fr.leaf, fr.n, fr.y0, fr.y1 ORDER BY least(b, y1) - greatest(a, y0) DESC, id) AS k FROM fr LEFT JOIN lx ON lx.leaf = fr.leaf AND lx.n = fr.n AND least(b, y1) - greatest(a, y0) > 0)
        SELECT leaf, n, 'w:' || y0 || ':' || y1 AS fragment, id AS host FROM j WHERE k = 1""",
    "letter_checks": f"""WITH {CHILDREN}, m AS (SELECT idx AS leaf, max(letter) AS letter FROM manifest GROUP BY idx), x AS (SELECT leaf, unnest(regexp_split_to_array(coalesce(letter, ''), '[,\\s]+')) AS letter FROM m),
        f AS (SELECT letter, min(leaf) AS leaf FROM x WHERE letter <> '' GROUP BY letter), s AS (SELECT leaf, count(*) AS starts FROM f GROUP BY leaf), hd AS (SELECT idx AS leaf, count(*) AS headings FROM ch WHERE kind = 'heading' GROUP BY idx)
        SELECT leaf, coalesce(starts, 0) AS starts, coalesce(headings, 0) AS headings FROM (SELECT leaf FROM cur) LEFT JOIN s USING (leaf) LEFT JOIN hd USING (leaf) WHERE coalesce(starts, 0) <> coalesce(headings, 0)""",
    "margin_sides": """WITH w AS (SELECT leaf, unnest(TRY_CAST(json_extract(CASE WHEN json_valid(body) THEN body::JSON END, '$.warnings') AS VARCHAR[])) AS w FROM page_json)
        SELECT DISTINCT leaf, side FROM (SELECT leaf, regexp_extract(w, '(?:side|column) ([ab])', 1) AS side FROM w WHERE contains(lower(w), 'margin')) WHERE side <> ''""",
    "doubtful_starts": f"""WITH {PAGE_LINES}, q AS (SELECT leaf, n, para, line AS row, text, x1, ind, coalesce(hanging, false) AND line = 1 AS s FROM ln WHERE text IS NOT NULL),
        r AS (SELECT *, row_number() OVER (PARTITION BY leaf, n ORDER BY x1) AS r, count(*) OVER (PARTITION BY leaf, n) AS total, lag(text) OVER w AS before, lag(x1) OVER w AS bx FROM q WINDOW w AS (PARTITION BY leaf, n ORDER BY para, row)),
        e AS (SELECT leaf, n, quantile_cont(x1, 0.5) AS edge FROM r WHERE r > floor(total / 3) GROUP BY leaf, n),
        t AS (SELECT leaf, n, para, row, text, before, CASE WHEN NOT s AND ind = 1 AND strpos(text, '=') > 0 AND strpos(text, '=') - 1 < length(text) * 0.4 AND bx < edge - 120 THEN 'missed'
        WHEN s AND strpos(text, '=') = 0 AND NOT regexp_matches(text, '\\s[—-]\\s') AND regexp_matches(before, '[¬-]$') THEN 'false' END AS what FROM r JOIN e USING (leaf, n) WHERE total >= 4 AND before IS NOT NULL)
        SELECT leaf, n, para, row, what, right(before, 20) AS before, left(text, 50) AS line FROM t WHERE what IS NOT NULL""",
    "request_ledger": """WITH l AS (SELECT DISTINCT split_part(id, '-', 1)::INT AS leaf FROM entries WHERE hw_source = 'D' AND headword IS NOT NULL), b AS (SELECT leaf, ((row_number() OVER (ORDER BY leaf) - 1) // 250)::INT AS batch FROM l),
        g AS (SELECT batch, leaf, leaf - row_number() OVER (PARTITION BY batch ORDER BY leaf) AS k FROM b), r AS (SELECT batch, min(leaf) AS lo, max(leaf) AS hi, count(*) AS n FROM g GROUP BY batch, k)
        SELECT batch, string_agg(CASE WHEN lo = hi THEN lo::VARCHAR ELSE lo || '-' || hi END, ',' ORDER BY lo) AS pages, sum(n)::BIGINT AS n, 'submitted' AS status FROM r GROUP BY batch""",
    "newest_rows": """WITH e AS (SELECT * FROM entries WHERE headword IS NOT NULL AND status IS NOT NULL), a AS (SELECT DISTINCT id, headword AS saw FROM e WHERE hw_source = 'manual'),
        r AS (SELECT id, headword, status, max(coalesce(flags, '')) AS flags FROM e GROUP BY id, headword, status), k AS (SELECT a.id, saw, headword, status, flags, row_number() OVER (PARTITION BY a.id, saw ORDER BY status DESC) AS k FROM a JOIN r ON a.id = r.id AND a.saw = r.headword)
        SELECT id, saw, headword, status, flags FROM k WHERE k = 1""",
}
