"""Pages from their words to entries: reading order, levels, edges, carried cuts, votes, sources, readings and labels."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import strings as S
from corpusloom.operators import entries as E
from corpusloom.operators import evaluate as V
from corpusloom.operators import geometry as G
from corpusloom.operators import layout as L
from corpusloom.operators import pagelayout as Y
from corpusloom.operators import pagetext as T
from corpusloom.operators import segmentation as Z
from corpusloom.operators import upkeep as U
from corpusloom.plans.pages import _Sections, layer_differences
from corpusloom.sources import witness as W
from corpusloom.sources.delimited import parse_truth


def row(words, x, y, h=10, w=40):
    return [(t, x + k * (w + 10), y, x + k * (w + 10) + w, y + h) for k, t in enumerate(words)]


def page():
    words = row(["СЛОВАРЬ", "12"], 100, 20) + row(["Первая", "строка", "сло-"], 60, 100) + row(["во", "и", "дѣло"], 60, 120) + row(["Правая", "сторона", "здѣсь"], 560, 100) + row(["ещё", "три", "слова"], 560, 120)
    words += [("ЗАГОЛОВОКЪ", 300, 200, 700, 220)] + row(["послѣ", "него", "текстъ"], 60, 240) + row(["и", "справа", "тоже"], 560, 240) + row(["32*"], 560, 500) + [("", 0, 0, 1, 1)]
    return words


def test_reading_order():
    got = L.read_page(page(), 1000, 600)
    assert got.text == "Первая строка слово и дѣло Правая сторона здѣсь ещё три слова послѣ него текстъ и справа тоже"
    assert [got.text[x["start"] : x["end"]] for x in got.lines][:2] == ["Первая строка сло", "во и дѣло"]
    assert all(" " not in got.text[x["start"] : x["end"]] for x in got.words)
    sides = L.side_texts(got.lines)
    assert sides["a"]["text"] == "Первая строка слово и дѣло послѣ него текстъ" and sides["b"]["lines"][1]["start"] == 21
    assert L.read_page([], 10, 10).text == "" and L.read_page([(None, 0, 0, 1, 1)], 10, 10).text == ""


def test_heights_signatures_and_feet():
    tall = [("Азъ", 60, 92, 100, 122), *row(["есмь", "слово", "малое"], 110, 100), *row(["конецъ", "листа", "здѣсь"], 60, 140), *row(["да"], 560, 100), *row(["и", "нѣтъ", "сло"], 560, 140), ("32*", 720, 143, 735, 150)]
    assert L.read_page(tall, 1000, 600, mixed=True).text.startswith("Азъ есмь слово малое")
    assert L.read_page(tall, 1000, 600, mixed=True, signature=True).text.endswith("нѣтъ сло")
    foot = [*row(["Церк.-славян.", "словарь", "свящ.", "Г."], 60, 560), *row(["одинъ", "два", "три"], 60, 100), *row(["одинъ", "два", "три"], 560, 100)]
    assert "словарь" not in L.read_page(foot, 1000, 600, foot=True).text and "словарь" in L.read_page(foot, 1000, 600).text


def test_levels_and_edges():
    rng = np.random.default_rng(2)
    level, y = rng.integers(0, 3, 40), np.arange(40) * 12.0
    level[0] = 0
    x = 50 + 11.1 * level + 0.012 * y
    assert (L.line_levels(x, y, 11.1) == level).all()
    assert L.line_levels(x[:5], y[:5], 11.1) is None and L.line_levels(rng.uniform(0, 11.1, 60), np.zeros(60), 11.1) is None
    edge, indent = L.flush_edge([100] * 6 + [220] * 9 + [400], 90)
    assert abs(edge - 100) < 1 and indent == 120
    assert L.flush_edge([200] * 10, 100)[0] == L.flush_edge([200] * 10, 100, slack=10)[0] == 100  # all indented from the edge expected
    assert L.flush_edge([100] * 9 + [215] * 30, 105, slack=5)[0] == 100
    lines = [{"start": 0, "end": 9, "x0": 10}, {"start": 10, "end": 14, "x0": 30}]
    words = [{"start": 0, "end": 1, "box": (10, 0, 12, 1)}, {"start": 2, "end": 9, "box": (40, 0, 60, 1)}, {"start": 10, "end": 14, "box": (30, 0, 60, 1)}]
    assert L.without_specks(lines, words, 11.1) == [40, 30]


def char(t, x, y=0, w=10, h=20, first=False):
    return {"text": t, "x0": x, "y0": y, "x1": x + w, "y1": y + h, "word_first": first}


def test_specks_and_heads():
    word = [char(t, 100 + 12 * k, first=not k) for k, t in enumerate("слово")]
    assert L.leading_speck([char("'", 10), *word]) == 1 and L.leading_speck([char("—", 10), *word]) == 0 and L.leading_speck(word) == 0
    assert L.leading_speck([char("(", 80), *word]) == 0 and L.leading_speck([char("о", 80, y=15), *word]) == 1 and L.leading_speck([]) == 0
    words = [("Слово", (0, 0, 50, 10)), ("=", (60, 0, 65, 10)), ("рѣчь", (70, 0, 110, 12))]
    assert L.head_box(words) == (0, 0, 50, 10) and L.head_box(words, "Слово") == (0, 0, 50, 10) and L.head_box([]) is None
    assert L.head_box([("альбо—польск.", (0, 0, 130, 10))], "альбо")[2] == 52 and L.head_box(words, "Слово весьма длинное и больше")[2] == 110
    assert L.grown((0, 100, 10, 120)) == (0, 91, 10, 123)


def test_page_relations(spark):
    lines = spark.createDataFrame([(1, 0, 4), (1, 5, 9), (1, 9, 12)], "k int, start int, end int")
    at = spark.createDataFrame([(1, 0), (1, 4), (1, 9), (1, 12), (1, 13), (2, 1)], "k int, at int")
    assert {(r.k, r.at): r.line_start for r in L.line_of_offset(at, lines, ["k"], "at").collect()} == {(1, 0): 0, (1, 4): 0, (1, 9): 5, (1, 12): 9, (1, 13): None, (2, 1): None}
    rows = spark.createDataFrame([(1, 0), (1, 14), (1, 16), (1, 15), (2, 3)], "k int, y int")
    marks = spark.createDataFrame([(1, 10, "a"), (1, 20, "b")], "k int, y int, v string")
    assert {(r.k, r.y): r.v for r in L.nearest_row(rows, marks, ["k"], "y", "v").collect()} == {(1, 0): "a", (1, 14): "a", (1, 15): "a", (1, 16): "b", (2, 3): None}
    pieces = spark.createDataFrame([(1, "f", 100, 110), (1, "g", 900, 910)], "k int, id string, y0 int, y1 int")
    tall = spark.createDataFrame([(1, "x", 90, 104), (1, "y", 103, 140)], "k int, id string, y0 int, y1 int")
    assert {r.fragment: r.host for r in L.hosts(pieces, tall, ["k"], "id").collect()} == {"f": "y", "g": None}
    parts = spark.createDataFrame([(1, 100, 50, "два"), (1, 110, 0, "разъ"), (1, 140, 0, "три")], "k int, base int, x0 int, text string").selectExpr("*", "x0 + 10 as x1", "base - 5 as y0", "base as y1")
    assert [r.text for r in L.merged_fragments(parts, ["k"]).orderBy("line").collect()] == ["разъ два", "три"]


def test_rule_and_gutters(spark):
    seps = spark.createDataFrame([(1, 1000, 0, 990, 1000, 2000), (1, 1003, 0, 1003, 300, 2000), (1, 100, 0, 100, 900, 2000), (1, 0, 5, 900, 6, 2000)], "k int, x0 int, y0 int, x1 int, y1 int, w int")
    got = G.column_rule(seps, ["k"], "w").first()
    assert (got.g0, got.g1) == (1000.0, -0.01)
    words = spark.createDataFrame([(1, 0, 480, 1000), (1, 520, 990, 1000), (1, 100, 497, 1000)], "k int, x0 int, x1 int, w int")
    assert (G.gutter(words, ["k"], "w").first().gutter, G.gutter(words, ["k"], "w").first().covered) == (500, 0)
    body = spark.createDataFrame([(1, 0, 480, 1000), (1, 520, 990, 1000)] * 6 + [(2, 0, 990, 1000)] * 12, "k int, x0 int, x1 int, w int")
    assert [(r.k, r.gutter) for r in G.body_gutter(body, ["k"], "w").collect()] == [(1, 500.0)]


def test_paragraphs_and_sides():
    lines = [{"text": "Сло￼во = рѣ-", "x1": 100, "words": [("Сло￼во", "i")]}, {"text": "чь", "x1": 50, "words": []}, {"text": " ", "x1": 1, "words": None}, {"text": "да", "x1": 9}]
    got = T.paragraph(lines, width=102)
    assert got["text"] == "Слово = рѣчь да" and got["lines"] == [0, 10, 12, 13] and got["hyphens"] == [None, False, False, False]
    assert got["italic"][:5] == [True] * 5 and not any(got["italic"][5:])
    text, styles, parts = T.side([{"text": "одинъ сло-", "italic": [False] * 10, "hanging": True}, {"text": "во", "italic": [True] * 2, "hanging": False}, {"text": "два", "italic": [False] * 3, "hanging": True}])
    assert text == "одинъ слово два" and [p["start"] for p in parts] == [0, 9, 12] and len(styles) == len(text)
    assert T.italic_spans("одинъ два три, и", [False] * 6 + [True] * 7 + [None] * 3, 0, 16) == [(6, 14)]


def test_voted_side():
    a = [{**T.paragraph([{"text": "Слово = рѣчь людей,", "x1": 1, "words": [("рѣчь", "i")]}, {"text": "и еще слова", "x1": 1, "words": []}]), "hanging": True}, {**T.paragraph([{"text": "Дѣло = трудъ", "x1": 1, "words": []}]), "hanging": True}]
    d = "Слово = рѣчь людеп,\nи еще слова\nДѣло трудъ"
    got = T.voted_side(a, d, [0, 20, 32], "Слово = рѣчь людей, и еще слова Дѣло = трудъ", "Слово = рѣчь людей, и еще слова Дѣло трудъ", {})
    assert [p["text_merged"] for p in got] == ["Слово = рѣчь людей,\nи еще слова", "Дѣло = трудъ"[:5] + got[1]["text_merged"][5:]]
    assert got[0]["d_cut"] == "line" and got[0]["fixed"] == 1 and got[0]["italic"] == [(8, 12)] and [x for x, _ in got[0]["breaks"]] == [0, 20]
    assert "=" in got[1]["text_merged"] and got[1]["odd"] is None
    assert [p["d_cut"] for p in T.voted_side(a, "", [], "", "", {})] == ["forced", "forced"] and T.voted_side([], "текстъ", [0], "", "", {}) == []


def test_margins(spark):
    df = spark.createDataFrame([(["left margin cut on side b", "x", "MARGIN side a"],), (None,)], "w array<string>")
    assert [r[0] for r in df.select(T.cut_margins(F.col("w"))).collect()] == [["a", "b"], []]


XML = """<page width="100" height="200"><block blockType="Text"><text><par><line baseline="30" l="1" t="2" r="50" b="30"><formatting lang="RussianOldSpelling" fs="10." italic="1">
<charParams l="1" t="2" r="5" b="30" charConfidence="90" wordFirst="1" wordFromDictionary="1">С</charParams><charParams l="6" t="2" r="9" b="30" suspicious="1" charConfidence="50">о</charParams>
<charParams l="10" t="2" r="11" b="30"> </charParams><charParams l="12" t="2" r="19" b="31" charConfidence="-1" wordFirst="1">и</charParams></formatting></line></par></text></block>
<block blockType="Picture" l="1" t="2" r="3" b="4"/><block blockType="Separator"><separator><start x="5" y="0"/><end x="6" y="99"/></separator></block></page>"""


def test_recogniser_pages(spark, tmp_path):
    (tmp_path / "a.xml").write_text(f"<document>\n{XML}\n<page width='3' height='4'></page>\n</document>", "utf-8")
    pages = W.xml_page_texts(spark, str(tmp_path / "a.xml"))
    assert pages.count() == 2 and [r.leaf for r in W.xml_page_texts(spark, str(tmp_path / "a.xml"), [1]).collect()] == [1]
    chars = W.characters(pages.unionByName(spark.createDataFrame([(9, "<page"), (10, None)], "leaf int, xml string")))
    kinds = sorted((r.leaf, r.kind) for r in chars.collect())
    assert kinds == [(0, "char")] * 4 + [(0, "page"), (0, "picture"), (0, "separator"), (1, "page"), (9, "error"), (10, "error")]
    words = [(r.text, r.x0, r.x1, r.conf, r.flags, r.fs) for r in W.words_of(chars).orderBy("word").collect()]
    assert words == [("Со", 1, 9, 70, "iod?", 10.0), ("и", 12, 19, -1, "io", 10.0)]


def test_text_layers(spark):
    xhtml = '<page width="450.5" height="700"><word xMin="1.5" yMin="2" xMax="3" yMax="4">A &amp; B</word>\n<word xMin="5" yMin="2" xMax="6" yMax="4">c</word></page>'
    zones = 'width=100 height=200\n(page 1 1 90 150 (word 10 20 30 40 "a\\"b") (word 1 2 3 4 "\\n"))'
    df = spark.createDataFrame([(1, xhtml, zones), (2, "", "x"), (3, None, None)], "page int, value string, zone string")
    layer = W.layer_words(df.select("page", "value"), ["page"])
    assert [(r.text, r.x0, r.y1, r.width) for r in layer.orderBy("k").collect()] == [("A & B", 1.5, 4.0, 450.5), ("c", 5.0, 4.0, 450.5)]
    zone = W.zone_words(df.select("page", F.col("zone").alias("value")), ["page"])
    assert [(r.text, r.y0, r.y1) for r in zone.orderBy("k").collect()] == [('a"b', 160.0, 180.0), ("", 196.0, 198.0)]
    leaves = spark.createDataFrame([(38,), (700,)], "leaf int")
    both = W.witness_words(leaves, {"B": zone.selectExpr("page", "k", "text", "x0", "y0", "x1", "y1", "width", "height"), "D": layer.withColumn("page", F.lit(49))})
    assert sorted((r.leaf, r.witness) for r in both.collect()) == [(38, "B")] * 2 + [(38, "D")] * 2


def test_a_layer_is_written_and_read_in_place(spark):
    """Words move once; what a layer can not hold (a break in a word, a box below zero, no box) is lost, as often as it is there."""
    good = [(1, 450, t, 1.5, 2.0, 3.0, 4.0) for t in ("A & B", "<x>", "a", "a", "")] + [(2, 9, "a", 1.0, 2.0, 3.0, 4.0)]
    bad = [(1, 450, "c\nd", 1.0, 2.0, 3.0, 4.0), (2, 9, "e", -1.0, 2.0, 3.0, 4.0), (2, 8, "e", -1.0, 2.0, 3.0, 4.0), (3, 9, "f", 1.0, None, 3.0, 4.0)]
    types = "leaf int, width int, text string, x0 double, y0 double, x1 double, y1 double"
    got = layer_differences(spark.createDataFrame(good + bad + [(4, 9, "&amp;", 1.0, 2.0, 3.0, 4.0)], types))
    lost = [(r.leaf, r.width, r.text, r.side) for r in got.collect()]
    assert sorted(lost) == [(1, 450, "c\nd", "lost"), (2, 9, "e", "lost"), (2, 9, "e", "lost"), (3, 9, "f", "lost")]
    assert got.dtypes == [*[tuple(c.split(" ")) for c in types.split(", ")], ("side", "string")]
    assert got._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[2].count("Exchange hashpartitioning") == 1
    layers = spark.range(1).selectExpr("id as page", "cast(id as string) as value")
    for df in (got, W.layer_words(layers, ["page"])):  # no word carries its page
        words = [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Generate explode(" in line or "Generate posexplode(" in line]
        assert words and not any("value#" in line for line in words)


def test_hand_readings_and_checksums(spark):
    asked = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    lines = spark.createDataFrame([(1, "1\tслово"), (2, ""), (3, "3\t-"), (4, "9\tа")], "at int, value string")
    read, missing = W.hand_readings(lines, asked)
    assert sorted((r.k, r.reading) for r in read.collect()) == [(1, "слово"), (3, None)] and sorted((r.k, r.problem) for r in missing.collect()) == [(2, "no answer"), (9, "no question")]
    assert [r.reading for r in W.hand_readings(spark.createDataFrame([(1, "а"), (2, "б"), (3, "-")], "at int, value string"), asked)[0].orderBy("k").collect()] == ["а", "б", None]
    files = spark.createDataFrame([("a", b"x"), ("b", b"y"), ("d", b"z")], "name string, content binary")
    listing = '<files><file name="a" source="o"><md5>9dd4e461268c8034f5c8564e155c67a6</md5></file><file name="b"><size>1</size><md5>00</md5></file><file name="c"><md5>11</md5></file></files>'
    listed = W.checksums(spark.createDataFrame([(listing,)], "value string"))
    assert {r.name: r.status for r in W.verified(files, listed).collect()} == {"a": "ok", "b": "changed", "c": "missing", "d": "unlisted"}


def test_truth(spark):
    assert W.truth_part("{Сло‹во›} = рѣчь[?] ¦да") == ("Слово = рѣчь? да", [(3, 5, "o"), (0, 5, "cs"), (12, 13, "q")], [0, 14])
    assert W.truth_part("{нѣтъ конца")[1] == [(0, 10, "cs")]
    assert W.truth_heads("# x\n{Сло‹во›} = да\n+ ещё\nДѣло [?](то)\n\n@ m") == ["Слово", "Дѣло"]
    rows = W.truth_lines(spark.createDataFrame([(1, "А = б\n+ ещё\nВ = г"), (2, None)], "leaf int, value string")).collect()
    assert [(r.entry, r.part, r.going_on, r.text) for r in rows] == [(0, 0, False, "А = б"), (0, 1, True, "ещё"), (1, 0, False, "В = г")]


def test_readings_against_the_truth():
    truth = parse_truth("{Слово} = рѣчь\n{Дѣло} = трудъ")
    got = V.head_readings(truth, {"d": "Слово = рѣчь Дѣла = трудъ"})
    assert [(r["truth"], r["d"], r["d_ok"]) for r in got] == [("Слово", "Слово", True), ("Дѣло", "Дѣла", False)]
    assert V.suspects("столпъ домъ", ["столбъ домъ", "столбъ дамъ"])[0][:3] == (4, "п", "б") and V.suspects("домъ", ["дамъ", "домъ"]) == [] and V.suspects("домъ", []) == []
    assert V.differences("одинъ столпъ стоитъ", "одинъ столбъ стоитъ", context=2) == [(9, "олпъс", "олбъс")] and V.differences("", "а") == []
    assert V.line_markers("одинъ два три четыре", ["одинъ два", "три четыре"]) == ([0, 10], "")
    assert V.line_markers("одинъ", ["одинъ", "два три четыре пять"])[1] == "length" or V.line_markers("одинъ", ["одинъ", "два"])[1] in ("count", "length")
    assert V.line_markers("", ["а", "б"]) == ([0, 0], "count")


def test_doubtful_starts(spark):
    rows = [(1, k, t, x1, ind, start) for k, (t, x1, ind, start) in enumerate([("Слово = да", 1000, 0, True), ("конецъ.", 500, 1, False), ("Дѣло = трудъ людей", 1000, 1, False), ("сло-", 1000, 1, False), ("во безъ знака", 1000, 0, True), ("и такъ", 1000, 1, False)])]
    df = spark.createDataFrame(rows, "leaf int, k int, text string, x1 int, ind int, start boolean")
    assert sorted((r.k, r.what) for r in V.doubtful_starts(df, ["leaf"], ["k"], "start").collect()) == [(2, "missed"), (4, "false")]


def test_labels(spark):
    assert S.label_form("Ѻтецъ  Оу {сто} ү") == "Отецъ У (сто) у" and S.label_form(" ") == ""
    assert S.prefix_end("слово", "слово = да") == 5 and S.prefix_end("слоо", "слово = да") in (4, 5) and S.prefix_end("", "а") == 0
    assert S.checked_label("Слѡво", "typed", "Слова = рѣчь", "x") == "Слѡво = рѣчь" and S.checked_label("", "b", "m", "v") == "v" and S.checked_label("", "a", "m", "v") == "m"
    assert S.alike("Мождевельникъ", "можжевельникъ") and not S.alike("Полъ", "Луда") and not S.alike("", "")
    assert S.script_spans("Слово или слово") == [(0, 5), (10, 15)] and S.script_spans("Полъ и Луда") == [(0, 11)] and S.script_spans("Мождевельникъ и можжевельникъ") == [(0, 13), (16, 29)]
    one = lambda v, f: spark.createDataFrame([(v,)], "x string").select(f(F.col("x")).alias("y")).first().y
    assert one("слово-греч. да", S.head_of) == "слово-греч" and one("Слово = да", S.head_of) == "Слово" and one("слово да", S.head_of) == "слово"
    assert one("а б", lambda c: S.same_head(c, F.lit("аб-в"))) is True and one("аб", lambda c: S.same_head(c, F.lit("ав"))) is False
    assert one("сло́во, да", lambda c: S.letter_run(c, 2)) == "сло́во" and one("да, и", lambda c: S.letter_run(c, 2)) == "да" and one("- а", lambda c: S.letter_run(c, 0)) == ""
    assert one("1. a*b // -- x", S.typst_text) == "1\\. a\\*b \\/\\/ — x" and one("=x", S.typst_text) == "\\=x" and one(" а  ( б ) .", S.clean_label) == "а (б)."
    assert one("ѣ", lambda c: S.char_names(c)) == "U+0463 CYRILLIC SMALL LETTER YAT"


@pytest.mark.parametrize("leaf, want", [(38, (1, 49, 1, 1, 47, True, True, 1)), (604, (567, 615, 567, 2, 9, False, False, 36))])
def test_leaf_numbers(spark, leaf, want):
    got = spark.createDataFrame([(leaf,)], "leaf int").select(*[c.alias(n) for n, c in S.leaf_numbers(F.col("leaf")).items()]).first()
    assert tuple(got) == want


def test_sections():
    s = _Sections()
    got = [s.before(*x) for x in ((1, ["А"], "а"), (1, ["А"], "а"), (2, ["А", "Б"], "а"), (2, ["А", "Б"], "б"), (3, ["В"], "х"), (4, ["В"], "в"))]
    assert got == ["А", None, None, "Б", "В", None]


def test_parsed_entries(spark):
    """Over columns and leaves: a hanging paragraph opens, a head read as none joins, corrections and spans follow."""
    def p(leaf, n, k, text, hanging, **more):
        base = dict(id=f"{leaf:04d}-{n}-{k:02d}", section="main", page=str(leaf), side="ab"[n - 1], text=text, disputed=[], italic=[], lines=[], hanging=hanging, guessed=False, seg=None, odd=False,
                    headword=None, source=None, measured=None, eq=True, hint_check=None, hinted=True, errata=[])
        return {"leaf": leaf, "n": n, "para": k, **base, **more}

    rows = [
        p(1, 1, 1, "хвостъ прежняго", False),
        p(1, 1, 2, "Слово = рѣчь лю-", True, disputed=[{"s": 8, "e": 12}], seg="CD"),
        p(1, 2, 1, "дей (да", False, odd=True),
        p(2, 1, 1, "нѣтъ) конецъ", True, source="vision", headword=None),
        p(2, 1, 2, "Столпь = домъ", True, source="manual", headword="Столпъ", eq=False, errata=[{"printed": "домъ", "read": "дома"}], guessed=True),
    ]
    kinds = f"leaf int, n int, para int, {E.PARAGRAPH}"
    got = {r.id: r for r in E.parsed_entries(spark.createDataFrame([tuple(r[c.split()[0]] for c in kinds.split(", ")) for r in rows], kinds), ["leaf", "n", "para"], "leaf").collect()}
    assert sorted(got) == ["0001-1-01", "0001-1-02", "0002-1-02"]
    a, b = got["0001-1-02"], got["0002-1-02"]
    assert a.definition == "рѣчь людей (да нѣтъ) конецъ" and a.disputed == "0-4" and a.headword_key == "слово" and {"joined_null", "odd_len", "seg", "hw_provisional"} <= set(a.flags)
    assert b.definition == "дома" and b.hw_source == "manual" and {"errata", "guessed", "no_eq"} <= set(b.flags) and b.headword_civil == "Столпъ"
    assert "no_sep" in got["0001-1-01"].flags and json.loads(json.dumps(a.flags)) == sorted(a.flags)


def test_layout(spark):
    """A page with header, foot, a title between two bands, hanging paragraphs on both sides, a fragment and a speck."""
    def line(base, x0, x1, text, fs=10.0, height=60.0, conf=90):
        return (1, base, x0, base - 50, x1, base + 10, text, fs, height, conf)

    rows = [line(200, 100, 300, "АЗБ"), line(200, 2000, 2060, "12"), line(200, 3700, 3900, "ВОД")]
    for k in range(8):  # two columns of 1900, entries on every fourth line, continuation lines 115 further right
        for left in (200, 2162):
            new = k % 4 == 0
            rows.append(line(900 + 100 * k, left + (0 if new else 115), left + 1900, ("Слово = " if new else "") + "рѣчь людей и дѣла ихъ на земли и въ мори"))
    rows += [line(2050, 1900, 2900, "ЗАГЛАВІЕ ПРИБАВЛЕНІЯ КЪ СЛОВАРЮ", fs=24.0, height=120.0), line(2300, 200, 2100, "Дѣло = трудъ людей и рѣчь ихъ на земли и въ мори и въ горахъ"), line(2400, 315, 1000, "и слово людей безъ"), line(2405, 1050, 2100, "конца и края на земли"), line(2500, 700, 710, "'", conf=10)]
    rows += [line(6300, 200, 1200, "Церк.-славян. словарь свящ. Г. Н."), line(6310, 3900, 3950, "1")]
    lines = spark.createDataFrame(rows, "leaf int, base int, x0 int, y0 int, x1 int, y1 int, text string, fs double, height double, conf int")
    pages = spark.createDataFrame([(1, 4252.0, 6520.0, "main", 17, 2100.0, 0.0)], "leaf int, width double, tall double, section string, page int, g0 double, g1 double")
    told = Y.roles(lines, pages)
    assert {r.role: r.n for r in told.groupBy("role").agg(F.count("*").alias("n")).collect()} == {"header": 3, "body": 19, "heading": 1, "noise": 1, "footer": 2}
    none = lines.limit(0).select("leaf", "x0", "y0", "x1", "y1")
    verdicts = spark.createDataFrame([(1, "b", 1300, "continue"), (1, "b", 1200, "start"), (1, "a", 900, "start")], "leaf int, side string, base int, verdict string")
    got = Y.laid_out(lines, pages, none, verdicts).orderBy("n", "para", "row").collect()
    shape = {}
    for r in got:
        shape.setdefault((r.n, r.para), []).append(r)
    assert {k: len(v) for k, v in shape.items()} == {(1, 1): 4, (1, 2): 4, (2, 1): 3, (2, 2): 5, (3, 1): 2}
    assert all(v[0].hanging for v in shape.values()) and shape[(2, 2)][0].seg == "CD" and shape[(3, 1)][1].text == "и слово людей безъ конца и края на земли"
    assert sorted((r.n, r.para, r.measured, r.eq) for r in Y.hints(Y.laid_out(lines, pages, none, verdicts)).collect())[0] == (1, 1, "Слово", True)
    h = Y.header_parts(told.where("role = 'header'")).first()
    assert (h.page_number, h.guide_a, h.guide_b, h.running_title) == ("12", "АЗБ", "ВОД", "")
    pictures = spark.createDataFrame([(1, 1900, 2060, 2300, 2200)], "leaf int, x0 int, y0 int, x1 int, y1 int")
    assert {r.kind for r in Y.headings(told, pictures, pages).collect()} == {"text", "picture"}
    gap = told.where("base < 1050 or base between 1450 and 1650")
    assert [(r.kind, r.y0, r.y1) for r in Y.headings(gap, none, pages).collect()] == [("gap", 1010, 1450)]
    assert [r.kind for r in Y.headings(gap.where("base != 1500 or x0 < 2100").where("base != 1600 or x0 < 2100"), none, pages).collect()] == []


def test_cut_margins_are_weighed(spark):
    pdf = [(1, "a", 0.0, 1900.0, 2100.0, "x") for _ in range(4)] + [(1, "a", 60.0, 1900.0, 2100.0, "x") for _ in range(6)] + [(1, "b", 2162.0, 4060.0, 2100.0, "=") for _ in range(6)] + [(1, "b", 2280.0, 4060.0, 2100.0, "x") for _ in range(6)]
    import pandas as pd

    got = {r[1]: r for r in Y.page_edges(pd.DataFrame(pdf, columns=["leaf", "side", "x0", "x1", "rule_x", "text"]))}
    assert got["a"][5] is True and got["a"][6] == 60 and abs(got["b"][2] - 62) < 1 and got["b"][5] is False


def test_parted_lines(spark):
    rows = [(1, 1, 100, 0, "слѣва", 100, 50, 900, 110, 10.0, 90), (1, 1, 100, 1, ".", 2095, 50, 2105, 110, 10.0, 9), (1, 1, 100, 2, "справа", 2200, 50, 2900, 110, 10.0, 90)]
    words = spark.createDataFrame(rows, "leaf int, line int, base int, k int, text string, x0 int, y0 int, x1 int, y1 int, fs double, conf int")
    pages = spark.createDataFrame([(1, 2100.0, 0.0)], "leaf int, g0 double, g1 double")
    assert sorted(r.text for r in Y.parted(words, pages).collect()) == ["слѣва", "справа"]


def test_paired_lines():
    a, b = "одинъ два\nтри четыре\nпять шесть", "одинъ два\nтри четыре\nпять шесть"
    assert Z.paired_lines(a, [0, 10, 21], b, [0, 10, 21]) == [0, 1, 2]
    assert Z.paired_lines(a, [0, 10, 21], b, [0, 21]) == [0, None, 1]
    assert Z.paired_lines("одинъ два xx пять", [0, 10, 13], "одинъ два yyyyyyyy пять", [0, 16, 19]) == [0, 1, 2]  # one line in the gap on both sides
    assert Z.paired_lines("", [0], "а", [0]) == [None] and Z.paired_lines("а", [0], "а", []) == [None]


def test_verdicts_and_settling(spark):
    rows = [(1, "C", k, 0 if k % 4 == 0 else 1, k % 4 == 0) for k in range(12)] + [(1, "D", k, 0 if k % 4 == 0 or k == 5 else 1, k % 4 == 0) for k in range(12)]
    df = spark.createDataFrame(rows, "leaf int, w string, k int, level int, start boolean")
    told = Z.witness_verdicts(df, ["leaf", "w"], "k")
    got = {r.k: r.verdict for r in Z.agreed(told, ["leaf", "k"], "w").collect()}
    assert got[0] == got[4] == got[8] == "start" and 5 not in got and got[1] == "continue"
    state = spark.createDataFrame([(1, 5), (2, 1)], "k int, v int")
    end, changed = Z.settled(state, lambda s: s.withColumn("v", F.least(F.col("v") + 1, F.lit(6))), ["k"], most=9)
    assert {r.k: r.v for r in end.collect()} == {1: 6, 2: 6} and changed == [2, 1, 1, 1, 1, 0]


def test_sinks(spark, tmp_path):
    pages = spark.createDataFrame([(1, "а"), (2, "б")], "leaf int, text string")
    U.write_pages(pages, str(tmp_path / "p"))
    U.write_pages(spark.createDataFrame([(2, "в")], "leaf int, text string"), str(tmp_path / "p"))
    assert sorted((r.leaf, r.text) for r in spark.read.parquet(str(tmp_path / "p")).collect()) == [(1, "а"), (2, "в")]
    samples = spark.createDataFrame([("x", "val", "т"), ("y", "train", "т"), ("z", "train", None)], "id string, split string, text string")
    assert {r.split: r.n for r in U.write_samples(samples, str(tmp_path / "s")).collect()} == {"val": 1, "train": 2}
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "s/lists")).where("split = 'train'").collect()) == ["y", "z"]
    asked = []
    registry = {"c": lambda leaves: (asked.append(sorted(r.leaf for r in leaves.collect())), leaves.withColumn("text", F.concat(F.lit("t"), "leaf")))[1]}
    get = lambda leaves, **how: sorted(r.text for r in U.candidates(spark, str(tmp_path / "c"), registry, "c", spark.createDataFrame([(x,) for x in leaves], "leaf int"), **how).collect())
    assert get([1, 2]) == ["t1", "t2"] and get([2, 3]) == ["t2", "t3"] and get([3], refresh=True) == ["t3"] and asked == [[1, 2], [3], [3]]
    dump = U.page_dump(spark.createDataFrame([(1, 2, "б", None), (1, 1, "а", 3)], "leaf int, line int, text string, x int"), ["leaf"], ["line"])
    assert [r.value for r in dump.collect()] == ['{"line":1,"text":"а","x":3}', '{"line":2,"text":"б"}']


def test_stored_readings(spark):
    hints = spark.createDataFrame([(1, "Слово = рѣчь", None), (2, "Дѣло", ""), (3, "x", "y"), (4, None, None)], "k int, d string, c string")
    read = spark.createDataFrame([(1, "Слѡво", "vision", 1), (1, "Слова", "vision", 0), (2, "Тѣло", "manual", 1), (3, None, "manual", 1)], "k int, reading string, source string, read_at int")
    got = {r.k: (r.headword, r.confirmed_by, r.check) for r in U.stored_readings(hints, read, ["k"], {"D": "d", "C": "c"}).collect()}
    assert got == {1: ("Слѡво", "D", "confirmed"), 2: ("Тѣло", "", "disputed"), 3: (None, None, "no_entry"), 4: (None, None, None)}
