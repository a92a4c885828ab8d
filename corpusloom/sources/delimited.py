"""Delimited and page-wise sources: dictionaries with " | ", unquoted tables, page records in JSON and XML, ranges."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PSV_FIELDS = ("lemma", "pos", "forms", "ru", "en", "nl", "notes")


def psv_rows(lines: DataFrame, fields: tuple[str, ...] = PSV_FIELDS) -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of lines ``value`` with " | " between fields. Blank lines and "#" comments are no rows; a line
    that ends in " |" has an empty last field; lines with another number of fields are the errors."""
    some = lines.where(F.trim("value") != "").where(~F.ltrim("value").startswith("#"))
    padded = F.when(F.rtrim("value").endswith(" |"), F.concat(F.rtrim("value"), F.lit(" "))).otherwise(F.col("value"))
    parts = some.withColumn("p", F.transform(F.split(padded, r" \| "), lambda x: F.trim(x)))
    good = parts.where(F.size("p") == len(fields))
    named = [F.split(F.col("p")[k], " +").alias(f) if f == "forms" else F.col("p")[k].alias(f) for k, f in enumerate(fields)]
    rows = good.select(*named)
    if "forms" in fields:
        rows = rows.withColumn("forms", F.filter("forms", lambda x: x != ""))
    return rows, parts.where(F.size("p") != len(fields)).select("value", F.size("p").alias("fields"))


def read_psv(spark: SparkSession, path: str, fields: tuple[str, ...] = PSV_FIELDS) -> tuple[DataFrame, DataFrame]:
    return psv_rows(spark.read.text(path), fields)


def read_tsv(spark: SparkSession, path: str, schema: StructType | str | None = None, escape: str = "") -> DataFrame:
    """A table with a header whose quotes are ordinary characters; empty cells, and those that a short row lacks, are
    empty strings (NULL in columns of another type)."""
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("escape", escape)
    reader = reader.option("mode", "PERMISSIVE").option("encoding", "UTF-8")
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    return df.na.fill("")


# Names of the two columns of a page, and notes of corrections that are to no entry's text.
SIDES = {"лѣвый": "a", "правый": "b"}
NO_TEXT = "guide word|page number|instruction|not text"


def read_errata(spark: SparkSession, path: str) -> DataFrame:
    """Corrections (all fields as text) with the side of the page, the printed and the read words without type marks, whether
    they can be used, and why not: "doubtful" (a [?] in either), "not entry text" (by the note), "no locator" (no words to
    find, no page number, no column or no line)."""
    names = "leaf string, row string, page string, line string, `where` string, col string, printed string, read string, note string"
    return usable_errata(read_tsv(spark, path, names))


def usable_errata(df: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    bare = lambda c: F.trim(F.translate(text(c), "{}", ""))
    df = df.withColumn("printed_s", bare("printed")).withColumn("read_s", bare("read"))
    side = F.create_map(*[F.lit(x) for pair in SIDES.items() for x in pair])[F.col("col")]
    placed = (F.col("printed_s") != "") & text("page").rlike(r"^\d+$") & side.isNotNull() & (text("line") != "")
    why = F.when(F.concat(text("printed"), text("read")).contains("[?]"), "doubtful").when(text("note").rlike(NO_TEXT), "not entry text").when(~F.coalesce(placed, F.lit(False)), "no locator")
    return df.withColumn("side", side).withColumn("why", F.coalesce(why, F.lit(""))).withColumn("use", F.col("why") == "")


def read_segmentation(spark: SparkSession, path: str) -> DataFrame:
    df = read_tsv(spark, path, "leaf int, side string, base int, verdict string")
    return df.where(F.col("verdict").isin("start", "continue"))


def read_pages(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Page records, a file each, with the leaf from the file's name; only the schema's fields are read."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    return df.withColumn("file_leaf", F.regexp_extract(F.input_file_name(), r"(\d+)\.json", 1).cast("int"))


def read_xml_pages(spark: SparkSession, path: str, row_tag: str = "page", schema: StructType | str | None = None) -> DataFrame:
    """Pages of an XML file; a compressed file is read by one task and its rows are spread afterwards."""
    reader = spark.read.option("rowTag", row_tag)
    return (reader.schema(schema) if schema is not None else reader).xml(path)


def read_review(spark: SparkSession, path: str) -> DataFrame:
    """Review sheets (k, id, "a: …", "b: …", answer): which reading the reviewer chose, or what they typed; an empty
    answer is NULL, "-" is the empty reading."""
    df = spark.read.option("sep", "\t").option("quote", "").option("nullValue", "\u0000").schema("k string, id string, a string, b string, answer string").csv(path)
    return decoded_answers(df.where(F.col("k").rlike(r"^\s*\d+\s*$")))


def decoded_answers(df: DataFrame) -> DataFrame:
    shown = lambda c: F.trim(F.regexp_replace(F.col(c), r"^[ab]:\s*", ""))
    ans = F.trim(F.coalesce("answer", F.lit("")))
    chosen = F.when(ans == "", None).when(F.lower(ans) == "a", shown("a")).when(F.lower(ans) == "b", shown("b")).when(ans == "-", "").otherwise(ans)
    how = F.when(ans == "", "open").when(F.lower(ans).isin("a", "b"), F.lower(ans)).when(ans == "-", "none").otherwise("typed")
    return df.select("id", shown("a").alias("a"), shown("b").alias("b"), how.alias("how"), chosen.alias("chosen"))


_HEAD_END = re.compile(r"=|—|–|\s-\s|\(")


def _head_length(text: str) -> int:
    """Characters of an entry's line that are its head: the type change it begins with, else all before a separator."""
    if text.startswith("{"):
        return text.find("}") + 1
    end = _HEAD_END.search(text)
    return end.start() if end else len(text)


def parse_truth(raw: str) -> list[tuple[str, str, bool]]:
    """(character, zone, entry start) of a ground-truth page. Lines: "# comment", "@ mark-up", "+ continuation of the
    entry above"; any other line begins an entry. "{…}" holds the headword type, "‹…›" letters from another copy,
    "[?]" doubt, "¦" a printed line start; Greek letters of the definition are a zone of their own."""
    out: list[tuple[str, str, bool]] = []
    for line in raw.splitlines():
        if not line.strip() or line[0] in "#@":
            continue
        start = not line.startswith("+ ")
        text = (line if start else line[2:]).replace("[?]", "").replace("¦", "")
        head = _head_length(text) if start else 0
        if out:
            out.append((" ", "def", False))
        for place, ch in enumerate(text):
            if ch in "{}‹›":
                continue
            greek = "Ͱ" <= ch <= "Ͽ" or "ἀ" <= ch <= "῿"
            opens = start and not ch.isspace()
            out.append((ch, "hw" if place < head else "grc" if greek else "def", opens))
            start = start and not opens
    return out


def truth_characters(files: DataFrame) -> DataFrame:
    """leaf, pos, ch, zone, start of ground-truth files given as path, value (whole text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(int(leaf), k, *x) for leaf, text in zip(pdf["leaf"], pdf["value"]) for k, x in enumerate(parse_truth(text or ""))]
            yield pd.DataFrame(rows, columns=["leaf", "pos", "ch", "zone", "start"])

    return files.select("leaf", "value").mapInPandas(run, "leaf int, pos int, ch string, zone string, start boolean")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True)
    return truth_characters(files.withColumn("leaf", F.regexp_extract(F.input_file_name(), r"(\d+)\.txt", 1).cast("int")))
