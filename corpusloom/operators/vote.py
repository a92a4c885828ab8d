"""Voting between witnesses: per character after alignment, per word by majority, and agreement of readers."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce
from itertools import accumulate, combinations, groupby

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import norm_char, norm_seq
from corpusloom.operators.align import align

_GREEK, _CYRILLIC, _LATIN = (re.compile(p) for p in ("[\u0370-\u03ff\u1f00-\u1fff]", "[\u0400-\u052f]", "[A-Za-z]"))
# Fixed value: Latin letters without a Cyrillic letter that looks like them.
NO_TWIN = frozenset("bdfghjklmnqrstuvwzDFGJLNQRSUVWYZ")

CLASSES = ("d", "b", "a", "x")
# Other spellings of the answer that no witness reads rightly.
NO_WITNESS = ("x", "none")


def base_rule(d: Column, b: Column, a: Column, c: Column) -> Column:
    """struct(reading, fixed, disputed): d stands unless b and a agree on something else and c does not side with d;
    two confusions are believed without c ("=" that b has and d lacks; ъ for ь). Without a change, d is disputed where b
    reads otherwise. NULL witnesses read nothing."""
    d, b, a, c = (F.coalesce(x, F.lit("")) for x in (d, b, a, c))
    free = b.contains("=") & ~d.contains("=")
    signs = F.array_sort(F.array(b, d)) == F.array(F.lit("ъ"), F.lit("ь"))
    fixed = (b != d) & (b == a) & ((c != d) | free | signs)
    return F.struct(F.when(fixed, b).otherwise(d).alias("reading"), fixed.alias("fixed"), ((b != d) & ~fixed).alias("disputed"))


def annotator_name(name: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " ")), " ", "-")


def answer_class(label: Column) -> Column:
    """d, b, a or x; NULL for empty and unsure answers."""
    word = F.trim(F.regexp_replace(F.lower(label), r"[^\p{L}\p{N}]+", " "))
    word = F.regexp_replace(word, r"^(?:wit|witness|text|read|reading) +", "")
    return F.when(word.isin(*NO_WITNESS), "x").when(word.isin(*CLASSES), word)


def counting_answers(labels: DataFrame) -> DataFrame:
    """item_id, annotator, label: each annotator's latest answer to each item (by ``labelled_at``, then ``received_at``,
    then ``label_id``); one whose latest answer is empty or unsure has none."""
    named = labels.select(
        "item_id",
        annotator_name(F.col("annotator")).alias("annotator"),
        F.struct("labelled_at", "received_at", "label_id", "label").alias("last"),
    ).where(F.col("item_id").isNotNull() & (F.coalesce(F.col("annotator"), F.lit("")) != ""))
    last = named.groupBy("item_id", "annotator").agg(F.max("last").alias("last"))
    return last.select("item_id", "annotator", answer_class(F.col("last.label")).alias("label")).where("label is not null")


def majority(df: DataFrame, key: list[str], reader: str, value: str, order: list[str]) -> DataFrame:
    """key, value, votes: the value most readers have; ties go to the reader named first in ``order``."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(reader))
    rank = F.when(rank == 0, len(order) + 1).otherwise(rank)
    counted = df.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("votes"), F.min(rank).alias("_rank"))
    best = F.max_by(F.struct(value, "votes"), F.struct("votes", -F.col("_rank"))).alias("_x")
    return counted.groupBy(*key).agg(best).select(*key, f"_x.{value}", "_x.votes")


def agreement(df: DataFrame, readers: list[str], truth: str) -> DataFrame:
    """Of each pair of readers: agree (rows where they read the same), right_agreed, right_either, n."""
    rows = []
    for x, y in combinations(readers, 2):
        same, rx, ry = F.col(x).eqNullSafe(F.col(y)), F.col(x).eqNullSafe(F.col(truth)), F.col(y).eqNullSafe(F.col(truth))
        sums = [F.sum(v.cast("long")).alias(f"{k}_{x}_{y}") for k, v in (("agree", same), ("right_agreed", same & rx), ("right_either", rx | ry))]
        rows.append((x, y, sums))
    one = df.agg(F.count("*").alias("n"), *[s for _, _, sums in rows for s in sums])  # one pass, one row
    names = ("agree", "right_agreed", "right_either")
    parts = [F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), *[F.coalesce(F.col(f"{k}_{x}_{y}"), F.lit(0)).alias(k) for k in names], F.col("n")) for x, y, _ in rows]
    return one.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


class Beside:
    """What another witness has at each normal character of d: its normal and its raw characters, and the place of the
    first of them (None without)."""

    def __init__(self, seq: list[str], text: str) -> None:
        other, at = norm_seq(text)
        begins = align(seq, other)[2] if seq and other else [0] * len(seq)
        spans = list(zip(begins, [*begins[1:], len(other)]))
        self.norm = ["".join(other[s:e]) for s, e in spans]
        self.raw = [text[at[s] : at[e - 1] + 1] if e > s else "" for s, e in spans]
        self.first = [at[s] if e > s else None for s, e in spans]


def _bare(word: str) -> bool:
    return not any(map(unicodedata.combining, unicodedata.normalize("NFD", word)))


def _all(script: re.Pattern, word: str) -> bool:
    return all(map(script.match, word))


class Words:
    """The printed words (runs of letters) of d, and what may be done to each; each is asked once."""

    def __init__(self, d: str, seq: list[str], at: list[int], b: Beside, a: Beside, c: Beside, lexicon: dict[str, int]) -> None:
        self.d, self.seq, self.b, self.a, self.c, self.lexicon = d, seq, b, a, c, lexicon
        self.places = np.asarray(at, int)
        letter = [ch.isalpha() or bool(unicodedata.combining(ch)) for ch in d]
        numbers = np.arange(len(d))
        # a place that is no letter counts to the word that ends before it
        last_gap = np.maximum.accumulate(np.where(letter, -1, numbers)) if len(d) else numbers
        self.begin = [int(last_gap[k - 1]) + 1 if k else 0 for k in range(len(d))]
        next_gap = np.minimum.accumulate(np.where(letter, len(d), numbers)[::-1])[::-1] if len(d) else numbers
        self.finish = next_gap.tolist()
        self.latin, self.greek, self.soft = {}, {}, {}

    def run(self, k: int) -> tuple[int, int]:
        return self.begin[k], self.finish[k]

    def _letters(self, run: tuple[int, int]) -> list[int]:
        lo, hi = np.searchsorted(self.places, run)
        return [k for k in range(lo, hi) if self.seq[k].isalpha()]

    def _read(self, readings: list[str], run: tuple[int, int]) -> str:
        return "".join(ch for k in self._letters(run) for ch in readings[k] if ch.isalpha()).lower()

    def may_leave_latin(self, k: int) -> bool:
        """A Latin word with a letter that has no twin is changed only into a Cyrillic word of the lexicon, into what the
        fourth witness reads too, or into another Latin word."""
        run = self.run(k)
        if run not in self.latin:
            word = self.d[slice(*run)]
            ok = not _all(_LATIN, word) or NO_TWIN.isdisjoint(word)
            if not ok:
                read = self._read(self.b.raw, run)
                ok = not _CYRILLIC.search(read) or read in self.lexicon or self._read(self.b.norm, run) == self._read(self.c.norm, run)
            self.latin[run] = ok
        return self.latin[run]

    def may_leave_greek(self, k: int) -> bool:
        """A Greek letter is changed in a word that is mostly Cyrillic, and in an unaccented one of which b and a read every
        letter as the same Cyrillic one."""
        run = self.run(k)
        if run not in self.greek:
            word = self.d[slice(*run)]
            ok = len(_CYRILLIC.findall(word)) > len(_GREEK.findall(word))
            if not ok and _bare(word):
                some = self._letters(run)
                ok = len(some) > 1 and all(self.a.norm[x] == self.b.norm[x] and _CYRILLIC.match(self.b.norm[x]) for x in some)
            self.greek[run] = ok
        return self.greek[run]

    def instead(self, k: int) -> str | None:
        """The lexicon's word for a whole unaccented Greek word: of two different ones the more frequent; b's if a reads
        nearly the same or no word of the lexicon; a's if b reads nothing."""
        run = self.run(k)
        if run not in self.soft:
            self.soft[run] = self._instead(run) if _all(_GREEK, self.d[slice(*run)]) and _bare(self.d[slice(*run)]) else None
        return self.soft[run]

    def _instead(self, run: tuple[int, int]) -> str | None:
        said = {name: self._read(w.raw, run) for name, w in (("b", self.b), ("a", self.a))}
        known = {n: w for n, w in said.items() if len(w) >= 3 and _all(_CYRILLIC, w) and w in self.lexicon}
        if len(set(known.values())) == 2:
            who = max(known, key=lambda n: (self.lexicon[known[n]], known[n]))
        elif "b" in known and (align(said["a"], said["b"])[0] <= 1 or said["a"] not in self.lexicon):
            who = "b"
        elif "a" in known and "b" not in known and not said["b"]:
            who = "a"
        else:
            return None
        printed = "".join({"b": self.b, "a": self.a}[who].raw[k] for k in self._letters(run)).strip().strip(".,;:")
        return printed if printed.lower() == known[who] else known[who]


def merge(d: str, b: str, a: str, c: str, lexicon: dict[str, int], italic: list[bool] | None = None) -> dict:
    """The voted text of four witnesses of one passage: text; at (for each offset of d, and its end, the offset in the
    text); disputed (s, e, fixed) for every place where b differs from d; fixed, the number of those that were changed; and
    per character of the text whether a's character there is italic (None where a was not asked).

    d stands unless b and a agree on something else and c does not side with d. Two confusions are believed without c ("="
    that b has and d lacks; ъ for ь), and so is Cyrillic for Greek where ``Words.may_leave_greek``; Latin words are guarded by
    ``Words.may_leave_latin``; an unaccented Greek word that is a word of the lexicon to b or a is replaced whole. What is
    changed takes b's characters as b has them."""
    seq, at = norm_seq(d)
    wb, wa, wc = (Beside(seq, text) for text in (b, a, c))
    words = Words(d, seq, at, wb, wa, wc, lexicon)
    pieces, told, slanted = list(d), {}, [None] * len(d)
    for raw, group in groupby(range(len(seq)), key=at.__getitem__):
        ks = list(group)
        dn, bn, an, cn = ("".join(x[k] for k in ks) for x in (seq, wb.norm, wa.norm, wc.norm))
        slanted[raw] = bool(italic) and any(wa.first[k] is not None and italic[wa.first[k]] for k in ks)
        if bn == dn:
            continue
        greek = bool(_GREEK.match(dn))
        whole = words.instead(raw) if greek else None
        if whole is not None:
            first = raw == words.run(raw)[0]
            pieces[raw] = whole if first else ""
            if first:
                told[raw] = True
            continue
        believed = cn != dn or ("=" in bn and "=" not in dn) or {bn, dn} == {"ъ", "ь"} or (greek and _CYRILLIC.match(bn) and words.may_leave_greek(raw))
        told[raw] = bool(bn == an and believed and words.may_leave_latin(raw))
        if told[raw]:
            pieces[raw] = "".join(wb.raw[k] for k in ks)
    place = [0, *accumulate(map(len, pieces))]
    spans = [(place[k], place[k + 1], fixed) for k, fixed in sorted(told.items())]
    styles = [style for style, piece in zip(slanted, pieces) for _ in piece]
    return {"text": "".join(pieces), "at": place, "disputed": spans, "fixed": sum(told.values()), "italic": styles}


def confirmed_by(head: Column, **witness: Column) -> Column:
    """The letters of the witnesses whose text holds the head (both in normal form), in the order given."""
    found = [F.when(F.instr(F.coalesce(text, F.lit("")), F.coalesce(head, F.lit(""))) > 0, F.lit(name)).otherwise("") for name, text in witness.items()]
    return F.when(F.coalesce(F.length(head), F.lit(0)) > 0, reduce(F.concat, found)).otherwise("")


__all__ = ["agreement", "base_rule", "confirmed_by", "majority", "merge", "norm_char"]
