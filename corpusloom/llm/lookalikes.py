"""One consistent form for text that prints alike.

Each word's letters are resolved to the scripts they could belong to (their own, and every script that has a twin of
them); the sets are intersected over the word. One script left: the word is spelt in it. Several left: the whole word
is confusable, and takes the script of the other words of its value, or else of the table's main script. None left: the
word mixes scripts, and takes the one most of its letters allow. Then the remaining forms are normalised: composition,
spaces, hyphens, commas, parentheses, and characters that are not seen.

Defined results: NULL stays NULL; an empty text stays empty; a text of nothing but spaces or unseen characters becomes
empty; digits, symbols and letters of other scripts without a twin stay as they are; the result is a fixed point.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Letters that print alike, as Cyrillic + Latin + Greek; "." where a script has none.
TWINS = """
аaα вʙ. сc. еe. єeε оoο рpρ хxχ уyυ іiι ѕs. јj. кkκ ѡ.ω ѵvν пnπ тtτ фfφ
АAΑ ВBΒ СCϹ ЕEΕ ОOΟ РPΡ ХXΧ УYΥ ІIΙ ЅSΣ ЈJϳ КKΚ МMΜ НHΗ ТTΤ ПNΠ Г.Γ Л.Λ Ф.Φ Ѵ.. З.Ζ
"""
# Small capitals and letters of further scripts with the Cyrillic letter they print like.
OTHERS = "ʜн ᴋк ᴍм ᴛт ᴦг ᴨп ᴫл ʙв ꜱѕ օо ᴏо ᴄс ᴀа ᴇе ᴘр ᴩр ᴠѵ ᴜи ᴙя ɑа ϲс һһ ⲟо ꓳО ꓐВ ꓑР ꓚС"
# Cyrillic letters outside the book's alphabet that print like one of it.
STRANGE = "ӏі Ӏі өѳ ӨѲ ґг ҐГ ԁд ԛq ҝк қк ҡк ң н"
CYRILLIC, LATIN, GREEK = "Cyrillic", "Latin", "Greek"
#: Twins too loose to make a word of its own in that script, but sure inside a word of it.
LOOSE = frozenset("nNftvuαυιτπφχν")
STRESS = "́"


def _tables() -> tuple[dict[str, dict[str, str]], dict[str, str]]:
    to: dict[str, dict[str, str]] = {}

    def add(a: str, script: str, b: str) -> None:
        if "." not in (a, b) and a != b:
            to.setdefault(a, {}).setdefault(script, b)

    for c, latin, greek in TWINS.split():
        add(c, LATIN, latin), add(c, GREEK, greek)
        add(latin, CYRILLIC, c), add(latin, GREEK, greek)
        add(greek, CYRILLIC, c), add(greek, LATIN, latin)
    for pair in OTHERS.split():
        to.setdefault(pair[0], {})[CYRILLIC] = pair[1]
        for script, twin in to.get(pair[1], {}).items():
            to[pair[0]].setdefault(script, twin)
    return to, {p[0]: p[1] for p in STRANGE.split() if len(p) == 2 and p[1] not in "qһ"}


TO, ODD = _tables()
HYPHENS = frozenset("⁃−﹘﹣－")
PLAIN = {"，": ",", "‚": ",", "﹐": ",", "、": ",", "（": "(", "）": ")", "﹙": "(", "﹚": ")", "❨": "(", "❩": ")", "⁽": "(", "⁾": ")"}
UNSEEN = frozenset("͏ᅟᅠ឴឵ㅤﾠ")


@lru_cache(maxsize=65_536)
def script_of(ch: str) -> str:
    """The letter's own script; "" for small capitals and the like, which no word of the tables is spelt in."""
    name = unicodedata.name(ch, "")
    if ch in "ᴫ" or "SMALL CAPITAL" in name or "ARMENIAN" in name or "COPTIC" in name or "LISU" in name:
        return ""
    for script in (CYRILLIC, LATIN, GREEK):
        if script.upper() in name:
            return script
    return name.split(" ")[0]


def unseen(ch: str) -> bool:
    return ch in UNSEEN or unicodedata.category(ch) in ("Cf", "Cc") or 0xFE00 <= ord(ch) <= 0xFE0F


@lru_cache(maxsize=65_536)
def plain(ch: str) -> str:
    """A character without regard to its word: unseen ones fall away, spaces, hyphens and marks become plain."""
    if ch in "\t\n\r" or unicodedata.category(ch) in ("Zs", "Zl", "Zp"):
        return " "
    if unseen(ch):
        return ""
    if ch in HYPHENS or unicodedata.category(ch) == "Pd":
        return "-"
    if ch in PLAIN:
        return PLAIN[ch]
    if unicodedata.name(ch, "").startswith(("FULLWIDTH", "HALFWIDTH", "MATHEMATICAL")):
        return unicodedata.normalize("NFKC", ch)
    return ODD.get(ch, ch)


def letters(word: str) -> list[str]:
    return [ch for ch in word if unicodedata.category(ch)[0] == "L"]


def script_set(word: str) -> frozenset[str] | None:
    """The scripts in which the whole word could be spelt; None for a word without letters."""
    sets = [
        {script_of(ch), *TO.get(ch, {})} - {""} if ch not in LOOSE else {script_of(ch)} for ch in letters(word)
    ]
    return frozenset.intersection(*map(frozenset, sets)) if sets else None


def spelt(word: str, script: str) -> str:
    return "".join(ch if script_of(ch) == script else TO.get(ch, {}).get(script, ch) for ch in word)


def words_of(text: str) -> list[str]:
    """The text cut before and after each space, hyphen, comma and parenthesis, which are pieces of their own."""
    out = [""]
    for ch in text:
        if ch in " -,()/;":
            out += [ch, ""]
        else:
            out[-1] += ch
    return out


def clean(value: str | None, main: str = CYRILLIC) -> str | None:
    """The one form of a value."""
    if value is None:
        return None
    text = unicodedata.normalize("NFD", "".join(map(plain, value)))
    parts = words_of(text)
    sets = [script_set(p) for p in parts]
    sure = Counter(next(iter(s)) for s in sets if s is not None and len(s) == 1)
    for k, (part, found) in enumerate(zip(parts, sets)):
        if found is None:
            continue
        if len(found) == 1:
            script = next(iter(found))
        elif found:
            of_value = [s for s, _ in sure.most_common() if s in found]
            script = of_value[0] if of_value else main if main in found else sorted(found)[0]
        else:
            votes = Counter(s for ch in letters(part) for s in {script_of(ch), *TO.get(ch, {})} if s)
            script = max(votes, key=lambda s: (votes[s], s == main, s))
        parts[k] = spelt(part, script)
    return unicodedata.normalize("NFC", "".join(parts)).strip(" ")


#: Values that are surely clean, by a look at the characters alone: the book's alphabet, single plain marks, stress
#: marks except where they would compose, no space at the ends. All others go through ``clean``.
SURE = r"^(?! )(?:[А-Яа-яЁёЅѕІіЇїЄєѠѡѢѣѦѧѲѳꙀꙁꙊꙋꙖꙗѴѵѮѯѰѱѾѿѺѻѪѫ ,()\-]|(?<=[аеиоуыэюяѣіѡѧѵєѕꙋꙗАЕИОУЫЭЮЯѢІѠѴ])́)*(?<! )$"


@F.pandas_udf(StringType())
def _clean(values: pd.Series) -> pd.Series:
    return values.map(clean, na_action="ignore")


def clean_column(column: Column | str) -> Column:
    """The clean form of a text column; only values that may need it leave the JVM."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c.isNull() | c.rlike(SURE), c).otherwise(_clean(c))


def dirty_values(df: DataFrame, tbl: str, key: str, fields: list[str]) -> DataFrame:
    """tbl, row_key, field, value, clean of each value of ``fields`` that is not in its clean form; repeated rows once.
    NULL values are clean; a NULL key is given as NULL."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x")
    some = df.select(F.col(key).cast("string").alias("row_key"), pairs).select("row_key", "x.field", "x.value")
    some = some.where(F.col("value").isNotNull() & ~F.col("value").rlike(SURE))
    done = some.withColumn("clean", _clean("value")).where(F.col("value") != F.col("clean"))
    return done.select(F.lit(tbl).alias("tbl"), "row_key", "field", "value", "clean").distinct()
