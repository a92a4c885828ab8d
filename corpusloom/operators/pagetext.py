"""The text of a page out of its witnesses: the first witness tells paragraphs and lines, the others are voted on.

One side of a page is one unit of work: its paragraphs are put together, carried into the second witness, cut there, voted
on, and the spans are written back to the paragraphs. A page that fails is told by its ``error`` and stops no other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.align import break_positions, cut_positions
from corpusloom.operators.vote import merge
from corpusloom.session import spread

FILLER = "￼"
HYPHENS = ("-", "¬", "‐")
#: A line that ends so near the image's edge is cut off by it.
CLIPPED = 4
#: Paragraphs of so many letters whose voted text is shorter or longer than these parts of the first witness's are odd.
ODD_FROM, ODD = 30, (0.75, 1.35)


def line_styles(line: dict) -> list[bool]:
    """For every character of a line whether it stands in an italic word; words are found in turn."""
    styles, at = [False] * len(line["text"]), 0
    for word, flags in line.get("words") or []:
        k = line["text"].find(word, at)
        if k < 0:
            continue
        at = k + len(word)
        if "i" in (flags or ""):
            styles[k:at] = [True] * len(word)
    return styles


def paragraph(lines: list[dict], width: float | None = None) -> dict:
    """A paragraph of printed lines: text, italic (per character), lines (where each begins), hyphens (whether each ends in
    one; None where its end is cut off). A hyphen at a line's end joins; lines without text begin where the next does."""
    text, italic, starts = "", [], []
    for line in lines:
        shown = [(ch, s) for ch, s in zip(line["text"], line_styles(line)) if ch != FILLER]
        bare = "".join(ch for ch, _ in shown)
        lead, body = len(bare) - len(bare.lstrip()), bare.strip()
        if body and text.endswith(HYPHENS) and not text.endswith(" -"):
            text, italic = text[:-1], italic[:-1]
        elif body and text:
            text, italic = text + " ", [*italic, False]
        starts.append(len(text))
        text += body
        italic += [s for _, s in shown[lead : lead + len(body)]]
    clipped = lambda line: width is not None and line.get("x1") is not None and line["x1"] >= width - CLIPPED
    return {"text": text, "italic": italic, "lines": starts, "hyphens": [None if clipped(x) else x["text"].rstrip().endswith(HYPHENS) for x in lines]}


def side(paragraphs: list[dict]) -> tuple[str, list[bool], list[dict]]:
    """The paragraphs of one side as one text with its styles, and each with its ``start`` in it. They are joined by a space; a
    hyphen at a paragraph's end joins it to one that goes on (is not hanging)."""
    text, italic, out = "", [], []
    for p in paragraphs:
        if p["text"] and text:
            if text.endswith(("-", "¬")) and not p["hanging"]:
                text, italic = text[:-1], italic[:-1]
            else:
                text, italic = text + " ", [*italic, False]
        out.append({**p, "start": len(text)})
        text, italic = text + p["text"], italic + p["italic"]
    return text, italic, out


def italic_spans(text: str, italic: list, start: int, end: int) -> list[tuple[int, int]]:
    """Runs of words of which at least half the known letters are italic, in text[start:end], from its start; words next to
    each other make one run, and runs of one character are none."""
    out: list[tuple[int, int]] = []
    running = False
    for m in re.finditer(r"\S+", text[start:end]):
        known = [italic[start + k] for k in range(*m.span()) if text[start + k].isalnum() and italic[start + k] is not None]
        if not known or 2 * sum(known) < len(known):
            running = False
            continue
        if running and text[start + out[-1][1] : start + m.start()].isspace():
            out[-1] = (out[-1][0], m.end())
        else:
            out.append(m.span())
        running = True
    return [(s, e) for s, e in out if e - s >= 2]


def voted_side(paragraphs: list[dict], d: str, d_lines: list[int], b: str, c: str, lexicon: dict[str, int]) -> list[dict]:
    """Each paragraph with text_d, text_merged, disputed, italic, fixed, d_cut, breaks (offset, hyphen) and odd (the ratio of the
    letters, of paragraphs that are much shorter or longer than the first witness has them)."""
    a, styles, parts = side(paragraphs)
    cuts = cut_positions(a, [p["start"] for p in parts], d, d_lines, empty=[not p["text"] for p in parts])
    at = [place for place, _ in cuts]
    breaks = break_positions(a, parts, at, d, d_lines)
    vote = merge(d, b, a, c, lexicon, styles)
    moved, out = vote["at"], []
    for p, (lo, how), hi, rows in zip(parts, cuts, [*at[1:], len(d)], breaks):
        whole = vote["text"][moved[lo] : moved[hi]]
        text = whole.strip()
        base = moved[lo] + len(whole) - len(whole.lstrip())
        stop = base + len(text)
        inside = [(s, e, f) for s, e, f in vote["disputed"] if base <= s < stop or (s == e == stop and s > base)]
        spans: list[list[int]] = []
        for s, e, _ in inside:
            s, e = s - base, min(e, stop) - base
            if spans and s <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], e)
            else:
                spans.append([s, e])
        printed, last = [], 0
        for place, hyphen in rows:
            last = min(max(moved[min(place, len(d))] - base, last), len(text))
            printed.append((last, bool(hyphen)))
        letters_a, letters = len(p["text"].replace(" ", "")), len(text.replace(" ", ""))
        ratio = letters / letters_a if letters_a >= ODD_FROM else None
        out.append({
            "text_d": d[lo:hi].strip(), "text_merged": text, "disputed": [tuple(x) for x in spans], "italic": italic_spans(vote["text"], vote["italic"], base, stop),
            "fixed": sum(f for _, _, f in inside), "d_cut": how, "breaks": printed, "odd": round(ratio, 2) if ratio is not None and not ODD[0] <= ratio <= ODD[1] else None,
        })
    return out


VOTED = "n int, para int, text_d string, text_merged string, disputed array<struct<s:int,e:int>>, italic array<struct<s:int,e:int>>, fixed int, d_cut string, breaks array<struct<at:int,hyphen:boolean>>, odd double, error string"


def voted_pages(sides: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ``VOTED`` of each paragraph. A row of ``sides`` is a side of a page: width, paragraphs (n, para, hanging, lines with
    text, x1 and words with flags), d, d_lines, b, c, and lex (the lexicon's counts of the words it may need)."""
    types = ", ".join([*(f"`{c}` {sides.schema[c].dataType.simpleString()}" for c in keys), VOTED])
    names = [c.split()[0] for c in VOTED.split(", ")]
    pairs = lambda spans: [{"s": s, "e": e} for s, e in spans]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for rec in pdf.to_dict("records"):
                key = [rec[c] for c in keys]
                try:
                    given = [p for p in rec["paragraphs"]]
                    parts = [{**paragraph([_line(x) for x in p["lines"]], rec["width"]), "hanging": bool(p["hanging"])} for p in given]
                    got = voted_side(parts, rec["d"] or "", list(rec["d_lines"]), rec["b"] or "", rec["c"] or "", dict(rec["lex"]))
                    for p, v in zip(given, got):
                        breaks = [{"at": at, "hyphen": h} for at, h in v["breaks"]]
                        rows.append((*key, p["n"], p["para"], v["text_d"], v["text_merged"], pairs(v["disputed"]), pairs(v["italic"]), v["fixed"], v["d_cut"], breaks, v["odd"], None))
                except Exception as failed:  # noqa: BLE001
                    rows.append((*key, *[None] * (len(names) - 1), f"{type(failed).__name__}: {failed}"))
            yield pd.DataFrame(rows, columns=[*keys, *names]).astype({"n": "Int32", "para": "Int32", "fixed": "Int32"})

    return spread(sides).mapInPandas(run, types)


def _line(x: dict) -> dict:
    return {"text": x["text"] or "", "x1": x["x1"], "words": [(w["text"] or "", w["flags"]) for w in x["words"]] if x["words"] is not None else []}


def cut_margins(warnings: Column) -> Column:
    """The sides of a page whose margin the scan cut off, by its warnings ("… margin cut … side a …"): an array of sides."""
    told = F.filter(F.coalesce(warnings, F.array().cast("array<string>")), lambda w: F.lower(w).contains("margin"))
    return F.array_sort(F.array_distinct(F.filter(F.transform(told, lambda w: F.regexp_extract(w, r"(?:side|column) ([ab])", 1)), lambda s: s != "")))
