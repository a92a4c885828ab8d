"""Lines to learn recognition from: labels taken from the voted text where its witnesses agree, spelt the old way by seed."""

from __future__ import annotations

import random
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.strings import clean_label

# The end of a head in a label, debris that spoils one, and the measures of a good one.
HEAD_END, JUNK = r"=|—|–|\s-\s|\(", "[■|]"
LETTERS, RATIO, CLIPPED, RATE = 4, (0.7, 1.4), 4, 8


def _overlap(spans: Column, lo: Column, hi: Column) -> Column:
    return F.exists(spans, lambda x: (x["s"] < hi) & (x["e"] > lo))


def labelled(lines: DataFrame) -> DataFrame:
    """leaf, n, k, first, label, tail of the printed lines that can be learnt from. A row is a line (k in its column n, row in its
    paragraph) with the paragraph's voted text and disputed spans (s, e), the line's offsets b0 and b1 in it, whether a hyphen
    ends it, and the recognised ``read``, its box and the page's width; ``cut`` tells of a cut margin.

    A paragraph's first line is one if its head (up to a separator in the line, two letters or more) is not disputed; ``tail`` counts
    the disputed characters after it. Of other lines a share is taken by a check sum, if nothing in them is disputed. Labels have
    four letters, are not much shorter or longer than what was recognised, hold no debris, and their line is not cut off."""
    spans = F.coalesce("disputed", F.array().cast("array<struct<s:int,e:int>>"))
    piece = F.substring(F.col("text"), F.col("b0") + 1, F.col("b1") - F.col("b0"))
    at = F.regexp_instr(piece, F.lit(HEAD_END))
    end = F.col("b0") + at - 1
    head = F.length(F.regexp_replace(F.substring(piece, F.lit(1), at - 1), r"\P{L}", ""))
    tail = F.aggregate(F.filter(spans, lambda x: (x["s"] < F.col("b1")) & (x["e"] > end)), F.lit(0), lambda a, x: a + F.least(x["e"], F.col("b1")) - F.greatest(x["s"], end))
    label = F.concat(clean_label(piece), F.when(F.col("hyphen"), "-").otherwise(""))
    first = F.col("row") == 1
    agreed = first & (at > 0) & (head >= 2) & ~_overlap(spans, F.col("b0"), end) & (F.col("x0") > CLIPPED)
    going_on = ~first & (F.crc32(F.concat_ws("-", "leaf", "n", "k")) % 100 < RATE) & ~_overlap(spans, F.col("b0"), F.col("b1"))
    kept = lines.where(~F.col("cut") & (F.col("x1") < F.col("width") - CLIPPED)).where(F.coalesce(agreed | going_on, F.lit(False)))
    ratio = F.length("label") / F.greatest(F.lit(1), F.length(F.trim("read")))
    told = kept.select("leaf", "n", "k", first.alias("first"), label.alias("label"), F.when(first, tail).otherwise(0).alias("tail"), "read")
    good = (F.length(F.regexp_replace("label", r"\P{L}", "")) >= LETTERS) & ratio.between(*RATIO) & ~F.col("label").rlike(JUNK)
    return told.where(good).drop("read")


# The old letters that stand for a modern one, with how often each is put (the rest of the time it stays), at a
# word's beginning and elsewhere; digraphs with one letter; letters that carry an accent.
PAIRS = (("от", "ѿ", 0.5, True), ("кс", "ѯ", 0.7, False), ("пс", "ѱ", 0.7, False))
FIRST = {"у": (("оу", 0.5),), "о": (("ѡ", 0.35),), "я": (("ꙗ", 0.6),), "е": (("є", 0.8),)}
LATER = {"у": (("ꙋ", 0.55), ("ѹ", 0.07), ("ѫ", 0.13)), "о": (("ѡ", 0.1), ("ѻ", 0.02)), "я": (("ѧ", 0.6), ("ѩ", 0.15)), "е": (("є", 0.08), ("ѥ", 0.12)),
         "ю": (("ѭ", 0.25),), "и": (("ѵ", 0.08),), "з": (("ѕ", 0.08), ("ꙁ", 0.04)), "ф": (("ѳ", 0.4),)}
VOWELS = frozenset("аеиоуыэюяѣіѡєѧꙗѫѭѵїꙋѹ")
BREATHING, ACUTE = "҆", "́"


def old_spelling(word: str, seed: str) -> tuple[str, str]:
    """(a word spelt the old way, the same with accents), by the seed: a breathing on a vowel at the beginning and an acute on
    one vowel. The same word and seed give the same spelling on every run."""
    draw = random.Random(f"{seed}/{word}")
    low, out, k = word.lower(), [], 0
    while k < len(low):
        pair = next((new for old, new, share, only_first in PAIRS if low.startswith(old, k) and (k == 0 or not only_first) and draw.random() < share), None)
        if pair:
            out.append(pair)
            k += 2
            continue
        choices = (*(FIRST.get(low[k], ()) if k == 0 else ()), *LATER.get(low[k], ()))
        at, put = draw.random(), low[k]
        for new, share in choices:
            if at < share:
                put = new
                break
            at -= share
        out.append(put)
        k += 1
    plain = "".join(out)
    if word[:1].isupper():
        plain = plain[:1].upper() + plain[1:]
    vowels = [i for i, ch in enumerate(plain) if ch.lower() in VOWELS and plain[i - 1 : i + 1].lower() != "оу"]
    marks = dict.fromkeys(vowels[:1] if vowels[:1] == [0] else [], BREATHING)
    if vowels:
        i = draw.choice(vowels)
        marks[i] = marks.get(i, "") + ACUTE
    return plain, unicodedata.normalize("NFC", "".join(ch + marks.get(i, "") for i, ch in enumerate(plain)))
