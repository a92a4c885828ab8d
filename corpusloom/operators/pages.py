"""The page records: current version of each leaf and the child tables with their parents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from corpusloom.operators.shred import Levels, latest, shredded

#: What the child tables need; the words of a line and all measures stay unread.
PAGE_SPEC = {
    "columns[]": {"n": None, "paragraphs[]": {"lines[]": {}}},
    "headings[]": {"before_col": None},
    "entries_hint[]": {"col": None, "para": None},
}
#: What the layout needs.
LAYOUT_SPEC = {
    "size": list,
    "printed_page": None,
    "columns[]": {
        "n": None,
        "paragraphs[]": {
            "bbox": list,
            "hanging": None,
            "lines[]": {"bbox": list, "base": None, "ind": None, "fs": None, "text": None, "words": list},
        },
    },
}
COLUMN, PARAGRAPH, LINE = "columns[]", "columns[].paragraphs[]", "columns[].paragraphs[].lines[]"


def whole(text: str | None) -> str | None:
    """A number as it is written in ids: "2", " 2", "02" and 2.0 are all "2"; other text stays as it is."""
    if text is None:
        return None
    text = text.strip()
    try:
        number = float(text)
    except ValueError:
        return text or None
    return str(int(number)) if np.isfinite(number) and number.is_integer() else text


def _column_numbers(lv: Levels, group: str) -> list[str]:
    """For each entry of a group its column's own number: its ``n``, else its place."""
    at = f"{group}.#"
    given, place = lv.value("columns[].n", at), lv.number(COLUMN, at)
    return [whole(g) or p for g, p in zip(given, place)]


def children(cols) -> list[tuple[str, str, str]]:
    """(kind, child, parent) of every child record of one shredded page."""
    lv, out = Levels(cols), []

    there = lv.there(COLUMN)
    columns = [n for n, ok in zip(_column_numbers(lv, COLUMN), there) if ok]
    out += [("column", n, "page") for n in columns]

    at = f"{PARAGRAPH}.#"
    paragraphs = [
        (n, p) for n, p, ok in zip(_column_numbers(lv, PARAGRAPH), lv.number(PARAGRAPH), lv.there(PARAGRAPH)) if ok
    ]
    out += [("paragraph", f"{n}/{p}", n) for n, p in paragraphs]

    at = f"{LINE}.#"
    for n, p, k, ok in zip(_column_numbers(lv, LINE), lv.number(PARAGRAPH, at), lv.number(LINE), lv.there(LINE)):
        if ok:
            out.append(("line", f"{n}/{p}/{k}", f"{n}/{p}"))

    known = {f"{n}/{p}" for n, p in paragraphs}
    hints = zip(
        lv.number("entries_hint[]"), lv.value("entries_hint[].col"), lv.value("entries_hint[].para"), lv.there("entries_hint[]")
    )
    for k, col, para, ok in hints:
        if ok:
            parent = f"{whole(col)}/{whole(para)}"
            out.append(("hint", k, parent if parent in known else ""))

    has = set(columns)
    for k, col, ok in zip(lv.number("headings[]"), lv.value("headings[].before_col"), lv.there("headings[]")):
        if ok:
            parent = whole(col)
            out.append(("heading", k, parent if parent in has else ""))
    return list(dict.fromkeys(out))


def page_children(pages: DataFrame) -> DataFrame:
    """idx, kind, child, parent of each leaf's current page (``pages`` has leaf, written_at, body).

    The current page is the readable record of the latest ``written_at``; of equal times one is chosen by content, so
    that a record delivered twice counts once. A NULL time is older than any; a NULL leaf has no page. Repeated rows
    of the result are given once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(leaf, *c) for leaf, cols in zip(pdf["leaf"], pdf["cols"]) for c in children(cols)]
            yield pd.DataFrame(rows, columns=["idx", "kind", "child", "parent"])

    now = latest(shredded(pages, "body", ["leaf", "written_at"], PAGE_SPEC), "leaf", "written_at")
    return now.mapInPandas(run, "idx int, kind string, child string, parent string")


def layout_table(records: DataFrame, group: str, above: list[str], own: list[str]) -> DataFrame:
    """leaf, n, para (and line, for the group LINE), then leaves of the levels above (full paths) and the group's own, as
    text named by their last part, of each element of the group in records shredded by LAYOUT_SPEC."""
    at, numbers = f"{group}.#", ["n", "para", "line"] if group == LINE else ["n", "para"]
    names = [p.rpartition(".")[2] for p in above] + own
    types = ", ".join(["leaf int", "n string", *[f"{c} int" for c in numbers[1:]], *[f"`{c}` string" for c in names]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for leaf, cols in zip(pdf["leaf"], pdf["cols"]):
                lv = Levels(cols)
                data = [_column_numbers(lv, group), lv.number(PARAGRAPH, at)]
                data += [lv.number(LINE)] if group == LINE else []
                k = len(data)
                data += [lv.value(p, at) for p in above] + [lv.value(f"{group}.{c}") for c in own]
                rows += [(leaf, data[0][i], *(int(x[i]) for x in data[1:k]), *(x[i] for x in data[k:])) for i in np.flatnonzero(lv.there(group))]
            yield pd.DataFrame(rows, columns=["leaf", *numbers, *names])

    return records.select("leaf", "cols").mapInPandas(run, types)
