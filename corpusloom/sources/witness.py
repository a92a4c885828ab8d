"""Witnesses of the pages: characters from recogniser XML, word boxes from text layers, hand readings, checksums."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.strings import leaf_numbers
from corpusloom.functions.text import unescape

_PAGE = r'<page width="([\d.]+)" height="([\d.]+)"'
_WORD = r'<word xMin="([\d.]+)" yMin="([\d.]+)" xMax="([\d.]+)" yMax="([\d.]+)">(.*?)</word>'
_SIZE = r"^\s*width=(\d+)\s+height=(\d+)"
_ZONE = r'\(word (\d+) (\d+) (\d+) (\d+) "((?:[^"\\]|\\.)*)"\)'


def xml_page_texts(spark: SparkSession, path: str, wanted: list[int] | None = None) -> DataFrame:
    """leaf, xml of each <page> of a recogniser's file, numbered from 0 as they come; pages that are not wanted are dropped
    before they are parsed. A file is cut at the ends of its pages, so none is read as a whole; a compressed one is read by
    one task."""
    pieces = spark.read.option("lineSep", "</page>").text(path).select("value", F.input_file_name().alias("_file"), F.monotonically_increasing_id().alias("_at"))
    pages = pieces.where(F.instr("value", "<page ") > 0)
    leaf = (F.row_number().over(Window.partitionBy("_file").orderBy("_at")) - 1).alias("leaf")
    xml = F.concat(F.regexp_extract("value", r"(?s)<page .*", 0), F.lit("</page>")).alias("xml")
    numbered = pages.select(leaf, xml)
    return numbered.where(F.col("leaf").isin(wanted)) if wanted is not None else numbered


CHAR = "leaf int, kind string, line int, k int, text string, x0 int, y0 int, x1 int, y1 int, base int, conf int, suspicious boolean, word_first boolean, known boolean, fs double, flags string"
# Attributes of a format and the letter of its flag.
STYLES = (("italic", "i"), ("bold", "b"), ("smallcaps", "s"))


def _edges(e) -> list[int]:
    return [int(e.get(c)) for c in "ltrb"]


def page_characters(leaf: int, xml: str) -> Iterator[tuple]:
    """Rows of ``CHAR`` of one page: "page" (its size), "picture", "separator" (its ends), and "char" by line."""
    root = ET.fromstring(xml)
    blank = (None,) * 7
    yield (leaf, "page", None, 0, "", 0, 0, int(root.get("width")), int(root.get("height")), *blank)
    line = 0
    for number, block in enumerate(root.iter("block")):
        if block.get("blockType") == "Picture":
            yield (leaf, "picture", None, number, "", *_edges(block), *blank)
        if block.get("blockType") == "Separator":
            for sep in block.iter("separator"):
                a, b = sep.find("start"), sep.find("end")
                yield (leaf, "separator", None, number, "", int(a.get("x")), int(a.get("y")), int(b.get("x")), int(b.get("y")), *blank)
        for row in block.iter("line"):
            k = 0
            for form in row.iter("formatting"):
                flags = "".join(flag for name, flag in STYLES if form.get(name)) + ("o" if form.get("lang") == "RussianOldSpelling" else "")
                for c in form.iter("charParams"):
                    told = [c.get(name) == "1" for name in ("suspicious", "wordFirst", "wordFromDictionary")]
                    yield (leaf, "char", line, k, c.text or "", *_edges(c), int(row.get("baseline")), int(c.get("charConfidence", -1)), *told, float(form.get("fs", 0)), flags)
                    k += 1
            line += k > 0


def characters(pages: DataFrame) -> DataFrame:
    """``CHAR`` rows of pages given as leaf, xml; a page that cannot be read gives one row of kind "error" with the reason."""
    names = [c.split()[0] for c in CHAR.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for leaf, xml in zip(pdf["leaf"], pdf["xml"]):
                try:
                    rows = list(page_characters(leaf, xml))
                except (ET.ParseError, TypeError, ValueError, AttributeError) as bad:
                    rows = [(leaf, "error", None, 0, f"{type(bad).__name__}: {bad}", *(None,) * 11)]
                yield pd.DataFrame(rows, columns=names)

    return pages.select("leaf", "xml").mapInPandas(run, CHAR)


def words_of(chars: DataFrame) -> DataFrame:
    """leaf, line, word, text, box, conf (rounded mean of the known ones, -1 without), flags, fs of the words of character rows. A
    word ends at white space and before a character that begins one. Flags are the commonest style, then "d" for a known word
    and "?" where half of it is suspicious; of equally common values the smallest counts."""
    w = Window.partitionBy("leaf", "line").orderBy("k")
    blank = F.trim("text") == ""
    opens = ~blank & (F.col("word_first") | F.coalesce(F.lag(blank).over(w), F.lit(True)))
    some = chars.where("kind = 'char'").withColumn("_open", opens).withColumn("word", F.sum(F.col("_open").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    some = some.where(~blank)
    keys = ["leaf", "line", "word"]
    common = lambda c, name: some.groupBy(*keys, c).agg(F.count("*").alias("_n")).groupBy(*keys).agg(F.min_by(c, F.struct(-F.col("_n"), F.col(c))).alias(name))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), "")
    conf = F.coalesce(F.bround(F.avg(F.when(F.col("conf") >= 0, F.col("conf")))), F.lit(-1)).cast("int")
    words = some.groupBy(*keys).agg(
        text.alias("text"), *[F.min(c).alias(c) for c in ("x0", "y0")], *[F.max(c).alias(c) for c in ("x1", "y1")], conf.alias("conf"),
        F.min_by("known", "k").alias("_d"), (F.sum(F.col("suspicious").cast("int")) * 2 >= F.count("*")).alias("_q"),
    )
    both = words.join(common("flags", "_f"), keys).join(common("fs", "fs"), keys)
    flags = F.concat(F.coalesce("_f", F.lit("")), F.when(F.col("_d"), "d").otherwise(""), F.when(F.col("_q"), "?").otherwise("")).alias("flags")
    return both.select(*keys, "text", "x0", "y0", "x1", "y1", "conf", flags, "fs")


def _number(c: Column, k: int, pattern: str) -> Column:
    return F.regexp_extract(c, pattern, k).try_cast("double")


def layer_words(pages: DataFrame, keys: list[str]) -> DataFrame:
    """keys, k, text, box, width, height of the words of a text layer given as "bbox" XHTML in ``value``; boxes in points from
    the top left. The page's size stands before its words are exploded, by a generator that the planner doesn't dissolve: else
    each word carries the whole layer into the queue before Python, which is on disk."""
    one = pages.select(*keys, F.inline(F.array(F.struct(*layer_size(F.col("value")), layer_marks(F.col("value")).alias("_ws")))))
    each = one.select(*keys, "width", "height", F.posexplode("_ws").alias("k", "_w"))
    return each.select(*keys, "k", *layer_word(F.col("_w")), "width", "height")


def layer_size(value: Column) -> list[Column]:
    return [_number(value, k, _PAGE).alias(name) for k, name in ((1, "width"), (2, "height"))]


def layer_marks(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit(_WORD), F.lit(0))


def layer_word(mark: Column) -> list[Column]:
    """text and box of a word's mark."""
    box = [_number(mark, k + 1, _WORD).alias(name) for k, name in enumerate(("x0", "y0", "x1", "y1"))]
    return [unescape(F.regexp_extract(mark, _WORD, 5)).alias("text"), *box]


def zone_words(pages: DataFrame, keys: list[str]) -> DataFrame:
    """The same of a text layer given as zones ("width=… height=…", then "(word x0 y0 x1 y1 "text")") that count from the
    foot of the page: boxes are turned about the page's own height, which the zones' common box is not."""
    size = [_number(F.col("value"), k, _SIZE).alias(name) for k, name in ((1, "width"), (2, "height"))]
    each = pages.select(*keys, *size, F.posexplode(F.regexp_extract_all("value", F.lit(_ZONE), F.lit(0))).alias("k", "_w")).where("height is not null")
    x0, low, x1, high = (_number(F.col("_w"), k, _ZONE) for k in (1, 2, 3, 4))
    text = F.regexp_replace(F.regexp_replace(F.regexp_extract("_w", _ZONE, 5), r"\\[nt]", " "), r"\\(.)", "$1")
    return each.select(*keys, "k", F.trim(F.replace(text, F.lit("\n"), F.lit(" "))).alias("text"), x0.alias("x0"), (F.col("height") - high).alias("y0"), x1.alias("x1"), (F.col("height") - low).alias("y1"), "width", "height")


def witness_words(leaves: DataFrame, layers: dict[str, DataFrame], volume: str = "volume", page: str = "page") -> DataFrame:
    """leaf, witness and the words of the page of each copy that shows the leaf: B by its page, D by its page, C by volume and
    page (``leaf_numbers``). ``layers`` are word tables with the copy's page (and volume)."""
    numbers = leaves.select("leaf", *[c.alias(name) for name, c in leaf_numbers(F.col("leaf")).items() if name.endswith(("_page", "_volume"))])
    on = {"B": {page: "b_page"}, "C": {page: "c_page", volume: "c_volume"}, "D": {page: "d_page"}}
    out = []
    for name, words in layers.items():
        keys = numbers.select("leaf", *[F.col(mine).alias(theirs) for theirs, mine in on[name].items()])
        out.append(keys.join(words, list(on[name])).select("leaf", F.lit(name).alias("witness"), "k", "text", "x0", "y0", "x1", "y1", "width", "height"))
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def hand_readings(lines: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readings, missing) of lines (``at``, ``value``) typed for numbered questions: "12<TAB>word", or one word a line in
    the order of the questions; "-" means that there is nothing to read (NULL). Missing are the questions without an answer
    and the answers without a question."""
    some = lines.where(F.trim("value") != "")
    numbered = F.regexp_extract("value", r"^\s*(\d+)\t", 1)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("at"))  # one sheet of questions
    value = F.trim(F.regexp_replace("value", r"^\s*\d+\t", ""))
    read = some.select(F.when(numbered != "", numbered.cast("int")).otherwise(place).alias("k"), F.when(value != "-", value).alias("reading"))
    unanswered = asked.select("k").join(read, "k", "left_anti").select("k", F.lit("no answer").alias("problem"))
    unasked = read.join(asked, "k", "left_anti").select("k", F.lit("no question").alias("problem"))
    return read.join(asked, "k", "left_semi"), unanswered.unionByName(unasked)


def verified(files: DataFrame, expected: DataFrame) -> DataFrame:
    """name, status of files (``name``, ``content``) against a list of checksums (``name``, ``md5``): "ok", "changed",
    "missing" or "unlisted"."""
    both = files.select("name", F.md5("content").alias("_got")).join(expected.select("name", F.lower("md5").alias("_want")), "name", "full")
    status = F.when(F.col("_got").isNull(), "missing").when(F.col("_want").isNull(), "unlisted").when(F.col("_got") == F.col("_want"), "ok").otherwise("changed")
    return both.select("name", status.alias("status"))


def checksums(manifest: DataFrame) -> DataFrame:
    """name, md5 of the files of an archive's XML listing given as ``value``."""
    one = r'<file name="([^"]+)"[^>]*>(?:(?!</file>)[\s\S])*?<md5>([0-9a-fA-F]+)</md5>'
    each = manifest.select(F.explode(F.regexp_extract_all("value", F.lit(one), F.lit(0))).alias("_f"))
    return each.select(unescape(F.regexp_extract("_f", one, 1)).alias("name"), F.regexp_extract("_f", one, 2).alias("md5"))


_MARK = re.compile(r"\[\?\]|[{}‹›¦]")


def truth_part(raw: str) -> tuple[str, list[tuple[int, int, str]], list[int]]:
    """(text, regions, line starts) of an entry line of ground truth without its marks: "cs" for head type, "o" for letters
    from another copy, "q" for a "?" put where a reading is in doubt; marks left open reach to the end."""
    text, at, regions, starts = "", 0, [], [0]
    open_: dict[str, int] = {}
    kinds = {"{": "cs", "‹": "o"}
    for m in [*_MARK.finditer(raw), None]:
        text += raw[at : m.start() if m else len(raw)]
        if m is None:
            break
        at, mark = m.end(), m.group()
        if mark == "[?]":
            regions.append((len(text), len(text) + 1, "q"))
            text += "?"
        elif mark in kinds:
            open_[mark] = len(text)
        elif mark == "¦":
            starts.append(len(text))
        else:
            begin = "{" if mark == "}" else "‹"
            if begin in open_:
                regions.append((open_.pop(begin), len(text), kinds[begin]))
    regions += [(s, len(text), kinds[mark]) for mark, s in open_.items()]
    return text, regions, starts


def truth_heads(raw: str) -> list[str]:
    """The headwords of a ground-truth page in order: the first braces of an entry line, else what is before a separator."""
    out = []
    for line in raw.splitlines():
        if not line.strip() or line[0] in "#@+":
            continue
        bare = line.replace("[?]", "").replace("¦", "")
        head = bare[1 : bare.index("}")] if bare.startswith("{") else re.split(r"=|—|–|\s-\s|\(", bare)[0]
        out.append(re.sub("[‹›]", "", head).strip())
    return out


TRUTH_LINE = "leaf int, entry int, part int, going_on boolean, text string, regions array<struct<s:int,e:int,kind:string>>, starts array<int>"


def truth_lines(files: DataFrame) -> DataFrame:
    """``TRUTH_LINE`` rows of ground-truth files (leaf, value): every entry line with its marks as regions and its printed lines;
    a line that goes on with the entry above has its number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for leaf, raw in zip(pdf["leaf"], pdf["value"]):
                entry, part = -1, 0
                for line in (raw or "").splitlines():
                    if not line.strip() or line[0] in "#@":
                        continue
                    on = line.startswith("+ ")
                    entry, part = (entry, part + 1) if on else (entry + 1, 0)
                    text, regions, starts = truth_part(line[2:] if on else line)
                    rows.append((leaf, entry, part, on, text, [{"s": s, "e": e, "kind": k} for s, e, k in regions], starts))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in TRUTH_LINE.split(", ")])

    return files.select("leaf", "value").mapInPandas(run, TRUTH_LINE)
