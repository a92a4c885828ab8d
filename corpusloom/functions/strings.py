"""Labels, heads and letters compared: forms of recognised lines, edit distances with a free end, names of characters."""

from __future__ import annotations

import difflib
import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from corpusloom.functions.text import norm_char, norm_seq

# Look-alikes that recognisers write and the book does not have.
LABEL_TWINS = {"Ө": "Ѳ", "ө": "ѳ", "Ӏ": "І", "ӏ": "і", "һ": "h", "Һ": "H", "ј": "j", "Ј": "J", "{": "(", "}": ")", "Ѻ": "О", "Ꙩ": "О"}
# What separates a head in normal text, marks trimmed from it, and the explanatory words of heads.
HEAD_END = r"=|\(|\s-|-\s|-$"
HEAD_MARKS = ".,;:-"
CIVIL_WORDS, JOINING_WORDS = ("или", "иногда", "иначе", "также", "вм", "вмѣсто"), ("и",)
ALIKE = 0.55


def label_form(text: str) -> str:
    """A recognised line as it is compared: normal letters, one space for white space, spacing accents dropped, оу as у."""
    spaced = re.sub(r"\s+", " ", "".join(" " if ch.isspace() else norm_char(ch) for ch in text))
    folded = spaced.translate(str.maketrans(LABEL_TWINS))
    plain = "".join(ch for ch in folded if unicodedata.category(ch) not in ("Sk", "Lm")).strip()
    return re.sub("[оО][уУ]", lambda m: "У" if m.group()[0] == "О" else "у" if m.group()[1] == "у" else m.group(), plain)


def clean_label(c: Column) -> Column:
    """Spacing as printed: none before closing marks nor after "(" and "„"."""
    c = F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    return F.regexp_replace(F.regexp_replace(c, r"\s+([.,;:!?)])", "$1"), r"([(„])\s+", "$1")


@F.pandas_udf(StringType())
def label_forms(values: pd.Series) -> pd.Series:
    return values.map(label_form, na_action="ignore")


def head_of(line: Column) -> Column:
    """The head of a first line in normal text: before the separator, else its first word."""
    at = F.regexp_instr(line, F.lit(HEAD_END))
    cut = F.when(at > 0, F.substring(line, F.lit(1), at - 1)).otherwise(F.split(line, " ")[0])
    return F.regexp_replace(F.trim(cut), rf"^[{HEAD_MARKS}]+|[{HEAD_MARKS}]+\z", "")


def same_head(x: Column, y: Column) -> Column:
    """Heads alike but for spaces, or one that goes on with a "-" after the other."""
    x, y = F.replace(x, F.lit(" "), F.lit("")), F.replace(y, F.lit(" "), F.lit(""))
    goes_on = lambda a, b: (a != "") & b.startswith(F.concat(a, F.lit("-")))
    return (x == y) | goes_on(x, y) | goes_on(y, x)


def prefix_end(head: str, line: str) -> int:
    """Where the beginning of a line ends that a head matches best by edits; of equal ones the nearest to its length."""
    letters = np.frombuffer(head.encode("utf-32-le"), np.uint32)
    steps = np.arange(len(head) + 1)
    row = steps.copy()
    ends = [(int(row[-1]), len(head), 0)]
    for place, ch in enumerate(line, 1):
        new = np.minimum(row + 1, np.append(place, row[:-1] + (letters != ord(ch))))
        row = np.minimum.accumulate(new - steps) + steps
        ends.append((int(row[-1]), abs(place - len(head)), place))
    return min(ends)[2]


@F.pandas_udf(IntegerType())
def prefix_ends(heads: pd.Series, lines: pd.Series) -> pd.Series:
    return pd.Series([None if h is None or t is None else prefix_end(h, t) for h, t in zip(heads, lines)], dtype="Int32")


def checked_label(head: str, how: str, model: str, vote: str) -> str:
    """The line to learn from after a review: the confirmed reader's, or the model's with the typed head over its own."""
    if how in ("a", "b"):
        return vote if how == "b" else model
    end = prefix_end(head, model)
    rest = re.compile(r"[^\W\d_]*").match(model, end)
    return head + model[rest.end() :]


def alike(a: str, b: str) -> bool:
    """Whether two words are one word in two spellings, by the ratio of their matching blocks."""
    x, y = ("".join(norm_seq(w.strip(".,;:()"))[0]) for w in (a, b))
    return bool(x and y) and difflib.SequenceMatcher(None, x, y).ratio() >= ALIKE


def script_spans(head: str) -> list[tuple[int, int]]:
    """The spans of a head in its own type: all but explanatory words, and "и" between two spellings of one word."""
    words = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[^ ]+", head)]
    bare = [w.strip(".,;:()").lower() for _, _, w in words]

    def civil(k: int) -> bool:
        between = bare[k] in JOINING_WORDS and 0 < k < len(words) - 1
        return bare[k] in CIVIL_WORDS or (between and alike(words[k - 1][2], words[k + 1][2]))

    out: list[tuple[int, int]] = []
    for k, (s, e, _) in enumerate(words):
        if civil(k):
            continue
        if out and s - out[-1][1] <= 1:
            out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def letter_run(c: Column, at: int) -> Column:
    """The run of letters around a place of a text, or that ends before it; "" without one."""
    left = F.regexp_extract(F.substring(c, 1, at), r"[\p{L}\p{M}]*$", 0)
    right = F.regexp_extract(F.substring(c, F.lit(at + 1), F.length(c)), r"^[\p{L}\p{M}]*", 0)
    return F.concat(left, right)


@F.pandas_udf(StringType())
def char_names(values: pd.Series) -> pd.Series:
    """Code point and name of a character, as in "U+0463 CYRILLIC SMALL LETTER YAT"."""
    return values.map(lambda ch: f"U+{ord(ch[0]):04X} {unicodedata.name(ch[0], '?')}" if ch else "", na_action="ignore")


# Fixed value: characters that mean something in typesetting.
TYPST_MARKS = r"#$*_`<>@[]~"


def typst_text(c: Column) -> Column:
    """Text that typesetting takes as it is: marks escaped, no comments, dashes as printed, no list at the beginning."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.regexp_replace(c, r"([#$*_`<>@\[\]~])", r"\\$1")
    c = F.replace(F.replace(c, F.lit("//"), F.lit("\\/\\/")), F.lit("/*"), F.lit("/\\*"))
    c = F.regexp_replace(F.replace(c, F.lit("--"), F.lit("—")), r"(?<=\S) - (?=\S)", " — ")
    c = F.when(c.rlike(r"^[-+=/]"), F.concat(F.lit("\\"), c)).otherwise(c)
    return F.regexp_replace(c, r"^(\d+)\.(?=\s)", r"$1\\.")


def leaf_numbers(leaf: Column, offset: int = 37) -> dict[str, Column]:
    """What follows from a leaf's number: the printed page, the pages of three other copies (the third is in two volumes),
    whether the page carries the printer's signature or the running foot, and its sheet."""
    page = leaf - offset
    return {
        "page": page, "d_page": page + 48, "b_page": page, "c_volume": F.when(page <= 566, 1).otherwise(2), "c_page": F.when(page <= 566, page + 46).otherwise(page - 558),
        "signature": F.pmod(page, F.lit(16)).isin(1, 3), "foot": F.pmod(page, F.lit(16)) == 1, "sheet": F.floor((page - 1) / 16) + 1,
    }


def section_of(leaf: Column, ranges: list[tuple[str, int, int]]) -> Column:
    """The section whose range of leaves (both ends in it) holds the leaf, the first of several; "" without."""
    out = F.lit("")
    for name, lo, hi in reversed(ranges):
        out = F.when(leaf.between(lo, hi), name).otherwise(out)
    return out
