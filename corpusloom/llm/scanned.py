"""Repair of text from scanned pages: cut words, misread letters, running headers and page numbers.

Two passes. The first counts the words of all values outside page furniture and cut places; the words with at least
``SHARE`` of all tokens are the vocabulary, which therefore has at most 1 / SHARE words, however large the corpus. The
second goes over every value: page furniture is found by its form and by likeness to the running title, cut words by
their marks and the vocabulary, misread words by their characters or by the vocabulary. For a word outside the
vocabulary, all vocabulary words that differ from it by confusions of the scanner and at most ``edits`` further letters
are retrieved: the word's Levenshtein automaton is run down a trie of the vocabulary, both in folded letters (letters
and letter groups that scanners take for each other are one). Candidates are ranked by distance, by how often they
follow the word before, and by frequency. Repaired text has no furniture, joined words and the best candidates, and one
space where a line ended.

Defined results: NULL stays NULL and has no noise; an empty text stays empty; a rare word far from all vocabulary is
taken as sound; letters before the first separator (the headword) are not judged; a value is repaired as a whole,
however long.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import cut

SHARE = 3e-5
LEAST = 4
TITLES = ("Словарь старинныхъ реченій",)

# Letters of the text, marks of a cut word, letters that stand for digits, what scanners put for letters.
LOWER, UPPER = "а-яѣіѳѵё", "А-ЯѢІѲѴЁ"
CUT_MARKS = "-¬­=‐"
DIGIT = "0-9ОІЗБо"
GROUPS = (("ьі", "ы"), ("ііі", "ш"), ("лі", "м"), ("іі", "н"), ("fe", "ѣ"), ("зк", "ж"), ("іо", "ю"))
SIGNS = {"0": "о", "3": "з", "4": "ч", "6": "б", "7": "т", "8": "в", "1": "і", "9": "д", "a": "а", "A": "а", "e": "е", "o": "о", "p": "р", "c": "с",
         "y": "у", "x": "х", "m": "т", "n": "п", "u": "и", "k": "к", "g": "д", "r": "г", "b": "ь", "i": "і", "t": "т", "h": "н"}
CLASSES = ("ес", "нипыквб", "лд", "тг", "хж", "ъьѣ", "шщц")
CONJUNCTIONS = frozenset(("и", "или", "да", "либо", "а", "но"))

_FOLD = {ord(s): c for s, c in SIGNS.items()} | {ord(ch): group[0] for group in CLASSES for ch in group}
for _s, _c in SIGNS.items():
    _FOLD[ord(_s)] = _FOLD.get(ord(_c), _c)

_WORD = re.compile(rf"[{LOWER}]+")
_TOKEN = re.compile(r"[^\s,.;:()«»„“”!—\-\[\]·=¬­‐/]+")
_NUMBER = rf"(?:[0-9][{DIGIT}]{{0,3}}|[{DIGIT}]{{0,3}}[0-9][{DIGIT}]{{0,3}}|[ІЗОБ]{{2,4}})"
_CAPS, _NAME = rf"[{UPPER}]{{2,5}}", rf"[{UPPER}][{LOWER}]{{1,5}}"
_GUIDE = re.compile(
    rf"(?:(?<![\w—])(?P<a>{_NUMBER})[ \n])?(?<![\w—]){_CAPS}—{_CAPS}(?!\w)(?:[ \n](?P<d>{_NUMBER})(?!\w))?"
    rf"|(?<!\w){_NAME}— ?(?:(?P<b>{_NUMBER}) ?)?(?:—{_NAME}(?!\w)|{_NAME}—)"
    rf"|(?<!\w){_NAME}\. — {_NAME}\.(?: (?P<c>{_NUMBER})(?!\w))?"
)
_PAGE = re.compile(
    rf"(?:(?<=\n)|^)[ ]*(?:[-·—] ?{_NUMBER} ?[-·—]|{_NUMBER}[*.]?|\[{_NUMBER}\])[ ]*(?=\n|$)"
    rf"|(?<!\w)(?P<m>[-·—]) {_NUMBER} (?P=m)(?!\w)"
    rf"|\[{_NUMBER}\]"
    rf"|(?<=[{LOWER},;.] ){_NUMBER}[*.]?(?= [{LOWER}{UPPER}0-9])(?! г\.)(?! ?\))"
)
_MAYBE_FURNITURE = re.compile(rf"[\n—·\[]|[0-9ІЗО][*.]? [{LOWER}]|[рРpP][еЕсСeEcC][чЧ4]")
_JOIN = re.compile(
    rf"(?P<l>[{LOWER}{UPPER}][^\s,.;:()—\-¬­=‐]*)(?P<m>[¬­‐]\s*|-\s+|=\s*\n\s*|= (?=[{LOWER}])| -\s*\n\s*)(?P<r>[{LOWER}0-9a-z][^\s,.;:()—\-¬­=‐]*)"
)
_ALIEN = re.compile(rf"[^{LOWER}{UPPER}]")
_INNER_CAPITAL = re.compile(rf"[{LOWER}][{UPPER}]|^[{UPPER}]{{2,}}[{LOWER}]")
_HEAD = re.compile(r"^.*?(?: = | — |=)", re.S)
_ROMAN = frozenset("ІVХIXLC")


def fold(word: str) -> str:
    for a, b in GROUPS:
        if a in word:
            word = word.replace(a, b)
    return word.translate(_FOLD)


class Trie:
    """A vocabulary by folded letters; a node is a dict by letter, its words are under the empty key."""

    def __init__(self, words: dict[str, int]) -> None:
        self.root: dict = {}
        self.halves: set[tuple[str, int, int]] = set()
        self.whole: set[str] = set()
        for word in words:
            node = self.root
            folded = fold(word)
            for ch in folded:
                node = node.setdefault(ch, {})
            node.setdefault("", []).append(word)
            half = len(folded) // 2
            self.halves.add((folded[:half], 0, len(folded))), self.halves.add((folded[half:], 1, len(folded)))
            self.whole.add(folded)

    def possible(self, folded: str, edits: int) -> bool:
        """Whether any word can be within one edit: one of the word's halves is then unchanged at its end of the text."""
        if edits == 0:
            return folded in self.whole
        n, halves = len(folded), self.halves
        return edits > 1 or any((folded[: k // 2], 0, k) in halves or (folded[n - k + k // 2 :], 1, k) in halves for k in (n, n - 1, n + 1))

    def within(self, word: str, edits: int) -> list[tuple[int, str]]:
        """All (distance, word) at most ``edits`` from ``word`` in folded letters: the Levenshtein automaton of the
        word, its states as bit sets by number of edits, run down every branch of the trie that keeps it alive."""
        folded = fold(word)
        if not self.possible(folded, edits):
            return []
        bits: dict[str, int] = {}
        for i, ch in enumerate(folded):
            bits[ch] = bits.get(ch, 0) | 1 << i
        goal, out = 1 << len(folded), []
        start = [1]
        for _ in range(edits):
            start.append(start[-1] | start[-1] << 1)
        stack = [(self.root, start)]
        full = (goal << 1) - 1
        while stack:
            node, rows = stack.pop()
            for ch, below in node.items():
                if not ch:
                    d = next((k for k, r in enumerate(rows) if r & goal), None)
                    if d is not None:
                        out += [(d, w) for w in below]
                    continue
                b = bits.get(ch, 0)
                new = [(rows[0] & b) << 1]
                for k in range(1, edits + 1):
                    new.append((((rows[k] & b) << 1) | rows[k - 1] | rows[k - 1] << 1 | new[k - 1] << 1) & full)
                if any(new):
                    stack.append((below, new))
        return sorted(out)


def allowed(word: str) -> int:
    """Edits beyond confusions: none in short words, where any word has neighbours."""
    n = len(word)
    return 0 if n < 5 else 1


class Vocabulary:
    def __init__(self, words: dict[str, int], compounds: dict[str, int], pairs: dict[str, int] | None = None) -> None:
        self.words, self.compounds, self.pairs = words, compounds, pairs or {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("trie", "seen")}

    def __getattr__(self, name: str):
        """The trie and the judged tokens are made where they are first needed, and stay there."""
        if name == "trie":
            self.trie = Trie(self.words)
            return self.trie
        if name == "seen":
            self.seen = {}
            return self.seen
        raise AttributeError(name)

    def wrong(self, token: str) -> bool:
        """Whether a token is a misread word."""
        known = self.seen.get(token)
        if known is None:
            known = _odd(token)
            if known is None:
                low = token.lower()
                known = low not in self.words and bool(self.trie.within(low, allowed(low)))
            if len(self.seen) > 200_000:
                self.seen.clear()
            self.seen[token] = known
        return known

    def candidates(self, word: str, before: str = "") -> list[str]:
        """Vocabulary words for a word outside of it, the best first."""
        found = self.trie.within(word.lower(), allowed(word))
        return [w for _, w in sorted(found, key=lambda f: (f[0], -self.pairs.get(f"{before} {f[1]}", 0), -self.words[f[1]], f[1]))]


@lru_cache(maxsize=8)
def _title_like(titles: tuple[str, ...]) -> re.Pattern:
    """A pattern for anything like a title: its words may be misread, in any case, or shortened."""
    parts = []
    for title in titles:
        words = [rf"{re.escape(w[:2])}[^\s,;()]{{1,{len(w) + 2}}}" for w in title.split()]
        parts.append(r"\s+".join(words) + r"\.?")
    return re.compile("(?i)(?<!\\w)(?:" + "|".join(parts) + ")")


def _near(a: str, b: str) -> bool:
    """Whether a (perhaps shortened) word is a reading of b."""
    a, b = fold(a.lower().rstrip(".")), fold(b.lower())
    if len(a) < len(b) - 1:
        b = b[: len(a)]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] <= max(1, len(b) // 3)


def furniture(text: str, titles: tuple[str, ...] = TITLES) -> list[tuple[int, int, str]]:
    """(start, end, kinds) of headers and page numbers; kinds is "header", "pagenum" or both."""
    if not _MAYBE_FURNITURE.search(text):
        return []
    out = []
    for m in _title_like(titles).finditer(text):
        words = m.group().split()
        if any(len(t.split()) == len(words) and all(map(_near, words, t.split())) for t in titles):
            out.append((m.start(), m.end(), "header"))
    for m in _GUIDE.finditer(text):
        number = any(m.group(g) for g in "abcd")
        out.append((m.start(), m.end(), "header pagenum" if number else "header"))
    taken = list(out)
    for m in _PAGE.finditer(text):
        inside = text.rfind("(", 0, m.start()) > text.rfind(")", 0, m.start()) and "\n" not in m.group() and text[m.start() - 1 : m.start()] != "\n"
        if not inside and all(m.end() <= s or m.start() >= e for s, e, _ in taken):
            out.append((m.start(), m.end(), "pagenum"))
    return sorted(out)


def without(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text without the spans; a line that is left empty goes with its line end."""
    out, at = [], 0
    for s, e, _ in spans:
        if s < at:
            continue
        out.append(text[at:s])
        at = e
    out.append(text[at:])
    return re.sub(r"[ ]*\n[ ]*(?:\n[ ]*)*", "\n", "\u0001".join(out).replace(" \u0001 ", " ").replace("\n\u0001\n", "\n").replace("\u0001", ""))


def space_joins(text: str, words: dict[str, int]) -> list[tuple[int, int, str]]:
    """Words cut in two by nothing but white space: together they are a word, and not both are alone."""
    found = _WORD.findall(text)
    if not any(a + b in words and (a not in words or b not in words) for a, b in zip(found, found[1:])):
        return []
    parts = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(text)]
    out = []
    for (s, e, a), (s2, e2, b) in zip(parts, parts[1:]):
        if (a not in words or b not in words) and a + b in words and len(a) + len(b) > 3 and text[e:s2].isspace():
            if (s == 0 or text[s - 1] in " (\n") and (e2 == len(text) or text[e2] not in CUT_MARKS):
                out.append((s, e2, a + b))
    return out


def all_joins(text: str, voc: Vocabulary) -> list[tuple[int, int, str]]:
    marked = list(_marked_joins(text, voc)) if any(ch in text for ch in CUT_MARKS) else []
    taken = [(s, e) for s, e, _ in marked]
    spaced = [x for x in space_joins(text, voc.words) if all(x[1] <= s or x[0] >= e for s, e in taken)]
    return sorted(marked + spaced)


def _marked_joins(text: str, voc: Vocabulary) -> Iterator[tuple[int, int, str]]:
    words = voc.words
    for m in _JOIN.finditer(text):
        left, mark, right = m.group("l"), m.group("m"), m.group("r")
        joined = left + right
        if joined.lower() not in words:
            if "-" in mark:
                start = max(text.rfind(" ", 0, m.start()), text.rfind("\n", 0, m.start()), text.rfind("(", 0, m.start())) + 1
                whole = f"{text[start : m.start()]}{left}-{right}".lower()
                if right in CONJUNCTIONS or whole in voc.compounds or any(c.startswith(f"{whole}-") for c in voc.compounds):
                    continue
                if mark.startswith(" ") and left.lower() in words and right in words:
                    continue
            elif mark.startswith("= "):
                continue
        yield m.start(), m.end(), joined


def joined_text(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for s, e, word in spans:
        if s < at:
            continue
        out += [text[at:s], word]
        at = e
    return "".join([*out, text[at:]])


def judged_from(text: str, head: bool) -> int:
    """Where the judged text begins: after the first separator, or after the first word of a headword without one."""
    if not head:
        return 0
    m = _HEAD.match(text)
    if m:
        return m.end()
    return len(text.split(None, 1)[0]) if text.strip() else 0


def _odd(token: str) -> bool | None:
    """Whether the token's characters alone show that it is misread; None if the vocabulary must tell."""
    if token.isdigit() or not token:
        return False
    letters = sum(ch.isalpha() for ch in token)
    if letters < 2 or set(token) <= _ROMAN:
        return letters == 1 and len(token) > 1 and not any(ch.isdigit() for ch in token) and not token.endswith(("?", "*"))
    core = token.strip("?*\"'")
    if _ALIEN.search(core):
        return True
    return True if _INNER_CAPITAL.search(core) else None


def misread(text: str, voc: Vocabulary, start: int = 0) -> Iterator[tuple[int, int, str]]:
    """(start, end, word) of each misread word of a text without furniture and cuts."""
    words = voc.words
    for m in _TOKEN.finditer(text, start):
        token = m.group()
        if token not in words and voc.wrong(token):
            yield m.start(), m.end(), token


def noise(text: str | None, voc: Vocabulary, head: bool, titles: tuple[str, ...] = TITLES) -> set[str]:
    """The kinds of noise in a value."""
    if not text:
        return set()
    spans = furniture(text, titles)
    kinds = {k for _, _, both in spans for k in both.split()}
    if spans:
        text = without(text, spans)
    cuts = all_joins(text, voc)
    if cuts:
        kinds.add("break")
        text = joined_text(text, cuts)
    if any(map(voc.wrong, set(_TOKEN.findall(text, judged_from(text, head))).difference(voc.words))):
        kinds.add("misread")
    return kinds


def repaired(text: str | None, voc: Vocabulary, head: bool, titles: tuple[str, ...] = TITLES) -> str | None:
    """The continuous text: no furniture, whole words, the best reading of misread words, one space at line ends."""
    if not text:
        return text
    text = without(text, furniture(text, titles))
    text = joined_text(text, all_joins(text, voc))
    out, at, start = [], 0, judged_from(text, head)
    for s, e, token in misread(text, voc, start):
        before = _WORD.findall(text[max(0, s - 40) : s].lower())
        best = voc.candidates(token, before[-1] if before else "")
        if best:
            word = best[0].capitalize() if token[:1].isupper() and not token[1:2].isupper() else best[0]
            out += [text[at:s], word]
            at = e
    text = "".join([*out, text[at:]])
    return re.sub(r"[ \t]*\n[ \t]*", " ", text).strip()


def _counts(text: str, head: bool, titles: tuple[str, ...], pairs: bool) -> list[str]:
    """Words (and "-" compounds; pairs of words if asked) of a value, outside furniture, cut places and headwords."""
    spans = furniture(text, titles)
    if spans:
        text = without(text, spans)
    if head:
        text = text[judged_from(text, head) :]
    out = []
    if any(ch in text for ch in CUT_MARKS):
        out = [m.lower() for m in _COMPOUND.findall(text)]
        text = _CUT_PLACE.sub("\n", text)
    found = _WHOLE.findall(text.lower())
    if pairs:
        out += [f"{a} {b}" for a, b in zip(found, found[1:])]
    return out + found


_WHOLE = re.compile(rf"(?<![^\s(«„])[{LOWER}]+(?![^\s,.;:)»“!?])")
_COMPOUND = re.compile(rf"(?<![\w-])[{LOWER}{UPPER}]+(?:-[{LOWER}]+)+(?![\w-])")
_CUT_PLACE = re.compile(rf"[^\s]*\s?[{CUT_MARKS}]\s*[^\s]*")


def value_table(df: DataFrame, tbl: str, key: str, fields: dict[str, bool]) -> DataFrame:
    """tbl, row_key, field, head, text of each value that is not NULL; head tells that a headword leads the text."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(h).alias("head"), F.col(f).alias("text")) for f, h in fields.items()])).alias("x")
    return df.select(F.lit(tbl).alias("tbl"), F.col(key).cast("string").alias("row_key"), each).select("tbl", "row_key", "x.*").where("text is not null")


def vocabulary(values: DataFrame, titles: tuple[str, ...] = TITLES, pairs: bool = False) -> Vocabulary:
    """Counted over all values; each task adds up its own counts before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()
        for pdf in batches:
            for text, head in zip(pdf["text"], pdf["head"]):
                total.update(_counts(text, head, titles, pairs))
            if len(total) > 400_000:
                yield pd.DataFrame({"word": list(total), "n": list(total.values())})
                total = Counter()
        if total:
            yield pd.DataFrame({"word": list(total), "n": list(total.values())})

    counts = values.select("text", "head").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = cut(counts)
    tokens = counts.where(~F.col("word").contains(" ") & ~F.col("word").contains("-")).agg(F.sum("n")).first()[0] or 0
    least = max(LEAST, SHARE * tokens)
    rows = counts.where(F.col("n") >= least).collect()  # at most 1 / SHARE words, as many compounds and pairs
    known = {r["word"]: r["n"] for r in rows}
    words = {w: n for w, n in known.items() if " " not in w and "-" not in w}
    return Vocabulary(words, {w: n for w, n in known.items() if "-" in w}, {w: n for w, n in known.items() if " " in w})


def found(values: DataFrame, titles: tuple[str, ...] = TITLES) -> DataFrame:
    """tbl, row_key, field, kind of each kind of noise in each value."""
    sent = values.sparkSession.sparkContext.broadcast(vocabulary(values, titles))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        voc = sent.value
        for pdf in batches:
            rows = []
            for tbl, key, field, head, text in pdf.itertuples(index=False, name=None):
                rows += [(tbl, key, field, kind) for kind in noise(text, voc, head, titles)]
            yield pd.DataFrame(rows, columns=["tbl", "row_key", "field", "kind"])

    return values.mapInPandas(run, "tbl string, row_key string, field string, kind string").distinct()


def repair(values: DataFrame, titles: tuple[str, ...] = TITLES) -> DataFrame:
    """tbl, row_key, field, text of each value, repaired; repeated rows stay."""
    sent = values.sparkSession.sparkContext.broadcast(vocabulary(values, titles, pairs=True))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        voc = sent.value
        for pdf in batches:
            out = pdf[["tbl", "row_key", "field"]].copy()
            out["text"] = [repaired(t, voc, h, titles) for t, h in zip(pdf["text"], pdf["head"])]
            yield out

    return values.mapInPandas(run, "tbl string, row_key string, field string, text string")
