"""Abusive, hateful and sexually explicit language by the odds of its words and letters.

A text is cut into windows (sentences, long ones into overlapping runs of words). Runs of letters, words, pairs of words and
the kinds of words (``toxic_seeds.KINDS``: insults, peoples, killing, parts of the body ...) with what stands beside them are
counted, by hashed numbers, in labelled toxic texts and in all windows of all documents. A window's score is the sum
of its features' log odds over their number, ``DAMP`` added, so that the shortest windows need no rule of their own.
A window above the threshold is given the category whose own odds are the best.

The labelled texts are those of ``toxic_seeds`` (at most ``LIMIT`` a category); nothing is taken from a sample of the documents.
A first model takes all windows for ordinary ones; its threshold comes from held-out folds of the seeds (``threshold``; all texts
of a seed line are in one fold). The second one counts the windows above it, of all documents,
with the toxic texts and no more with the ordinary ones. The last threshold is where the scores of all windows have their gap (``emptiest``).

Defined results: a NULL or blank text has score 0 and no category; ``doc_id`` NULL is scored like any other; documents
repeated in the table are given once by ``found``. Letters swapped for look-alikes, digits or signs, letters set apart,
stretched or hidden characters are undone before scoring, and Russian is compared in modern letters.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.toxic_seeds import HARMLESS_LINES, KINDS, LINES
from corpusloom.session import cut

#: Features have numbers of so many bits; letters of a run.
BITS, GRAM = 18, 4
#: Ordinary windows that are taken to hold none of a feature; weight of the ordinary rates in the toxic ones; bound of a log odd.
UNSEEN, HELD, MOST = 20_000, 2_000, 6.0
#: Documents that are judged at once.
BATCH = 500
#: The last threshold is below TOP; scores are counted by steps, so many on either side.
TOP, STEP, NEAR = 1.5, 0.05, 3
#: One ordinary window in so many may score above the threshold, which is never below LEAST.
STRICT, LEAST = 1_000, 0.04
#: Thresholds whose gains differ by no more than this are as good.
SLACK = 0.02
#: Times that a feature of kinds of words counts; words of a kind that are paired are so many apart, others not counted.
WEIGHT, REACH = 2, 3
#: Features added to a window's number of them.
DAMP = 20
#: Mean log odds that count as a score of 0, as toxic text is the rarer.
ZERO = 0.1
WORDS, STRIDE = 16, 8
FOLDS = 5

CATEGORIES = tuple(LINES)
#: Ends of sentences, also such as are only told by a capital.
_CUT = re.compile(r"[.!?;\n]+\s*|(?<=[a-zа-яѣъ]) (?=[A-ZА-ЯѢІ][a-zа-яѣі ])|(?<=[A-ZА-ЯѢІ]{2}) (?=[A-ZА-ЯѢІ][a-zа-яѣі])")
_PLAIN = re.compile(r"[a-zëïéè ,:'\"()«»—-]+|[а-яёіѣѳѵѡꙋѧєꙗꙁѕї ,:'\"()«»—=-]+")
_APART = re.compile(r"(?<!\w)(?:\w[- ]){3,}\w(?!\w)")
_RUN = re.compile(r"(.)\1{2,}")
_SIGNS = re.compile(r"(?<=\w)[@$*#~^|\\_]+(?=\w)")
_WORD = re.compile(r"\w+")
_UNSEEN = dict.fromkeys([0xAD, 0x34F, *range(0x200B, 0x2010), *range(0x2060, 0x2065), 0xFEFF])
# Letters and digits that stand for each other in disguised words.
_TO_CYR = str.maketrans("aceopxykmtbhi03ѕ", "асеорхукмтвніозс")
_TO_LAT = str.maketrans("асеорхуіѕкмтнв01345", "aceopxyiskmthboieas")
# Letters of the old spelling with the modern letter.
_MODERN = str.maketrans("ѣіѳѵѡꙋѧєꙗꙁѕї", "еифиоуяеяззи")
_HARD = re.compile(r"ъ(?![а-я])")
#: One byte a letter, so that both alphabets weigh the same: ASCII, then the letters of the corpus.
_BYTES = codecs.charmap_build(
    "".join(map(chr, range(128))) + "абвгдежзийклмнопрстуфхцчшщъыьэюяёіѣѳѵѡꙋѧєꙗꙁѕїëïéèóáúíöüäàçñ«»—–„“”’".ljust(128, "\ufffe")
)

#: Signs that may end a word.
_SIGN = np.isin(np.arange(256), np.frombuffer(b",:.\"')!?", np.uint8))


def windows(text: str) -> Iterator[str]:
    for piece in _CUT.split(text):
        if not piece.strip():
            continue
        if len(piece) <= 110:
            yield piece
            continue
        words = piece.split()
        if len(words) <= WORDS:
            yield piece
            continue
        for start in range(0, max(1, len(words) - WORDS + STRIDE), STRIDE):
            yield " ".join(words[start : start + WORDS])


def _same_script(match: re.Match) -> str:
    word = match.group()
    if word.isdigit():
        return word
    cyr, lat = sum("а" <= c <= "я" or c in "ѣіѳ" for c in word), sum("a" <= c <= "z" for c in word)
    if cyr and cyr >= lat:
        return word.translate(_TO_CYR)
    return word.translate(_TO_LAT) if lat else word


def _joined(low: str) -> str:
    """Letters set apart by spaces or hyphens put together."""
    if low.count(" ") * 3 > len(low) or low.count("-") > 2:
        return _APART.sub(lambda m: m.group().replace("-", "").replace(" ", ""), low)
    return low


def plain(window: str) -> str:
    """The window without disguises, in lower case and modern spelling."""
    low = window.lower()
    if _PLAIN.fullmatch(low):
        return _modern(_joined(low))
    low = _joined(_SIGNS.sub("", low.translate(_UNSEEN)))
    return _modern(_RUN.sub(r"\1", _WORD.sub(_same_script, low)))


def _modern(low: str) -> str:
    return _HARD.sub("", low.translate(_MODERN))


def encoded(window: str) -> bytes:
    return codecs.charmap_encode(plain(window).strip(" ,:—"), "replace", _BYTES)[0]


def _fold(numbers: np.ndarray, kind: int) -> np.ndarray:
    """Numbers of features from hashes."""
    x = (numbers + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - BITS)).astype(np.int64)


def _power(n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, 1_000_003, np.uint64)])


class _Kinds:
    """Numbers of the kinds (from 1; 0 for none) of words told by their hashes."""

    def __init__(self, kinds: dict[bytes, int]) -> None:
        hashed = {int(((np.frombuffer(w, np.uint8).astype(np.uint64) + np.uint64(7)) * _power(len(w))[: len(w)]).sum()): k for w, k in kinds.items()}
        self.keys = np.array(sorted(hashed), np.uint64)
        self.kinds = np.array([hashed[int(key)] for key in self.keys], np.int64)
        self.marked = np.zeros(1 << 16, bool)
        self.marked[self._slot(self.keys)] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.int64)

    def among(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes have a kind, and the kinds."""
        some = np.flatnonzero(self.marked[self._slot(hashes)])
        at = np.minimum(np.searchsorted(self.keys, hashes[some]), len(self.keys) - 1)
        known = self.keys[at] == hashes[some]
        return some[known], self.kinds[at[known]]


@lru_cache(maxsize=1)
def _kinds() -> tuple[_Kinds, dict[int, _Kinds], _Kinds]:
    """The whole words, the beginnings by their length, and the first letters that all beginnings have."""
    whole: dict[bytes, int] = {}
    begin: dict[int, dict[bytes, int]] = {}
    for k, words in enumerate(KINDS.values(), 1):
        for w in words.split():
            stem = encoded(w.rstrip("*"))
            (begin.setdefault(len(stem), {}) if w.endswith("*") else whole).setdefault(stem, k)
    least = min(begin)
    return _Kinds(whole), {n: _Kinds(begin[n]) for n in sorted(begin)}, _Kinds({w[:least]: 1 for ws in begin.values() for w in ws})


def _kinds_of(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The kind of each word, 0 for none: that of the word, or else of the longest beginning. ``total`` are sums of its letters' hashes."""
    whole, begin, all_begin = _kinds()
    least = min(begin)
    of = np.zeros(len(start), np.int64)
    enough = np.flatnonzero(end - start >= least)
    some = enough[all_begin.among(total[start[enough] + least] - total[start[enough]])[0]]
    for n, known in begin.items():
        some = some[end[some] - start[some] >= n]
        at, kinds = known.among(total[start[some] + n] - total[start[some]])
        of[some[at]] = kinds
    at, kinds = whole.among(total[end] - total[start])
    of[at] = kinds
    return of


def features(windows_: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the runs of ``GRAM`` letters, words, pairs of words, and kinds of words with the words and kinds about them, of
    encoded windows, and the window of each."""
    spaced = [b" " + b" ".join(w.split()) + b" " for w in windows_]
    if not spaced:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letters = np.frombuffer(b"".join(spaced), np.uint8)
    at = letters.astype(np.uint64)
    own = np.repeat(np.arange(len(spaced)), [len(w) for w in spaced])
    n = max(0, len(at) - GRAM + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(GRAM):
        runs = runs * np.uint64(257) + at[k : k + n]
    whole = own[:n] == own[len(own) - n :]
    found, of = [_fold(runs[whole], 1)], [own[:n][whole]]
    letter = at != 32
    start = np.flatnonzero(letter & ~np.r_[False, letter[:-1]])
    if len(start):
        end = np.flatnonzero(letter & ~np.r_[letter[1:], False]) + 1
        # every window begins with a space, so the first word does not begin at 0
        place = np.arange(len(at)) - np.repeat(np.r_[0, start], np.diff(np.r_[0, start, len(at)]))
        each = np.where(letter, (at + np.uint64(7)) * _power(int(place.max()))[place], np.uint64(0))
        total = np.r_[np.uint64(0), np.cumsum(each)]
        word, of_word = total[end] - total[start], own[start]
        first, last = np.r_[True, of_word[1:] != of_word[:-1]], np.r_[of_word[1:] != of_word[:-1], True]
        before = np.where(first, np.uint64(1), np.r_[np.uint64(0), word[:-1]])
        found += [_fold(word, 2), _fold(before * np.uint64(31) + word, 3), _fold(word[last] * np.uint64(31) + np.uint64(2), 4)]
        of += [of_word, of_word, of_word[last]]
        bare = end - ((end - start > 1) & _SIGN[letters[end - 1]])
        kinds = _kinds_of(total, start, bare)
        some = np.flatnonzero(kinds)
        kind, of_kind = kinds[some].astype(np.uint64), of_word[some]
        after = np.where(last, np.uint64(2), np.r_[word[1:], np.uint64(0)])
        told, of_told = [_beside(0, kind), _beside(1, kind, before[some]), _beside(2, kind, after[some])], [of_kind] * 3
        for d in range(1, REACH + 1):
            a, b, same = kind[:-d], kind[d:], of_kind[:-d] == of_kind[d:]
            # next to each other in their order, farther apart in any
            told.append((_beside(3, a, b) if d == 1 else _beside(4, np.minimum(a, b), np.maximum(a, b)))[same])
            of_told.append(of_kind[:-d][same])
        same = of_kind[:-2] == of_kind[2:]
        told.append(_beside(5, kind[:-2], kind[1:-1] * np.uint64(64) + kind[2:])[same])
        of_told.append(of_kind[:-2][same])
        found += told * WEIGHT
        of += of_told * WEIGHT
    return np.concatenate(found), np.concatenate(of)


def _beside(form: int, kind: np.ndarray, other: np.ndarray | int = 0) -> np.ndarray:
    """Numbers of features of kinds; ``other`` is a kind, kinds or the hash of a word."""
    return _fold((np.uint64(form) * np.uint64(64) + kind) * np.uint64(0xC2B2AE3D27D4EB4F) + np.asarray(other, np.uint64) * np.uint64(0x165667B19E3779F9), 5)


def counts(windows_: list[bytes]) -> np.ndarray:
    """How often each feature occurs, and at the end the number of windows."""
    return np.append(np.bincount(features(windows_)[0], minlength=1 << BITS), len(windows_)).astype(float)


class Model:
    """Log odds of each feature, of toxic text against ordinary text and of each category, and the threshold; a few
    arrays of a fixed size."""

    def __init__(self, ordinary: np.ndarray, harmless: np.ndarray, toxic: np.ndarray, threshold: float = 0.0) -> None:
        """``toxic`` has a row of counts for each category."""
        usual = np.maximum((ordinary[:-1] + 0.5) / (ordinary[-1] + UNSEEN), harmless[:-1] / max(1.0, harmless[-1]))
        # what the seeds don't hold is as frequent as in ordinary text
        odds = lambda c: np.clip(np.log((c[:-1] + HELD * usual) / ((c[-1] + HELD) * usual)), -MOST, MOST).astype(np.float32)
        # a category with few texts weighs more than they are, by the root, so that the others don't hide it
        toxic = toxic * np.sqrt(toxic[:, -1].mean() / np.maximum(toxic[:, -1:], 1.0))
        self.odds, self.by, self.threshold = odds(toxic.sum(axis=0)), [odds(c) for c in toxic], threshold

    def judged(self, windows_: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The score of each window, and the number of the category nearest to it."""
        numbers, own = features(windows_)
        of = lambda odds: np.bincount(own, odds[numbers], len(windows_))
        return of(self.odds) / (np.bincount(own, minlength=len(windows_)) + DAMP) - ZERO, np.argmax([of(odds) for odds in self.by], axis=0)

    def of_text(self, text: str | None) -> dict[str, float]:
        """The best score of each category that has a window above the threshold, and "" with the best of all."""
        best = {"": 0.0}
        for score, c in zip(*self.judged([encoded(w) for w in windows(text or "")])):
            best[""] = max(best[""], float(score))
            if score >= self.threshold:
                best[CATEGORIES[c]] = max(best.get(CATEGORIES[c], 0.0), float(score))
        return best


@lru_cache(maxsize=1)
def _seeds() -> tuple[list[np.ndarray], list[list[list[bytes]]], list[np.ndarray], list[list[bytes]]]:
    """Of each fold of the lines: counts of the harmless seeds, and those of each category, with the texts."""
    folds = lambda lines: [[encoded(x) for k, xs in enumerate(lines) if k % FOLDS == f for x in xs] for f in range(FOLDS)]
    fine, bad = folds(HARMLESS_LINES), [folds(lines) for lines in LINES.values()]
    return [counts(x) for x in fine], fine, [np.stack([counts(x[f]) for x in bad]) for f in range(FOLDS)], [[t for x in bad for t in x[f]] for f in range(FOLDS)]


def fitted(ordinary: np.ndarray, learnt: np.ndarray | None = None) -> Model:
    """A model from the counts of all windows and, with ``learnt``, those of the windows that are surely toxic, by category."""
    harmless, fine, toxic, bad = _seeds()
    if learnt is not None:
        seeds = sum(toxic)
        # what is learnt from the tables weighs no more than the seeds, however large they are
        weight = min(2.0, seeds[:, -1].sum() / max(1.0, learnt[:, -1].sum()))
        return Model(np.maximum(ordinary - learnt.sum(axis=0), 0), sum(harmless), seeds + weight * learnt)
    kept_fine, kept_bad = [], []  # scores of held-out seeds
    for f in range(FOLDS):
        out = Model(ordinary, sum(harmless) - harmless[f], sum(toxic) - toxic[f])
        kept_fine += out.judged(fine[f])[0].tolist()
        kept_bad += out.judged(bad[f])[0].tolist()
    return Model(ordinary, sum(harmless), sum(toxic), threshold([], kept_fine, kept_bad))


def fit(ordinary: list[str]) -> Model:
    """A model from ordinary windows."""
    return fitted(counts(list(map(encoded, ordinary))))


def threshold(plain_: list[float], fine: list[float], bad: list[float]) -> float:
    """The lowest score that separates held-out toxic seeds from harmless ones as well as any, within ``SLACK`` (what is found is
    reviewed, so the more is found the better), of those that no more than one ordinary window in ``STRICT`` exceeds; ``LEAST``
    at least."""
    plain_ = sorted(plain_)
    low = max(LEAST, plain_[-1 - len(plain_) // STRICT] if plain_ else 0.0)
    share = lambda scores, t: sum(s >= t for s in scores) / max(1, len(scores))
    choices = [round(low + k / 100, 3) for k in range(16)]
    gains = [share(bad, t) - share(fine, t) for t in choices]
    return next(t for t, gain in zip(choices, gains) if gain >= max(gains) - SLACK)


def encoded_documents(documents: DataFrame) -> DataFrame:
    """doc_id, source, windows: the encoded windows of each text, one a line."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[["doc_id", "source"]].copy()
            out["windows"] = [b"\n".join(encoded(w) for w in windows(t or "")) for t in pdf["text"]]
            yield out

    return documents.select("doc_id", "source", "text").mapInPandas(run, "doc_id long, source string, windows binary")


def _counted(texts: DataFrame, kinds: int, of: Callable[[list[bytes]], list[np.ndarray]]) -> np.ndarray:
    """Sums of what ``of`` counts over all windows, ``kinds`` rows; each task sends its sums once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((kinds, (1 << BITS) + 1))
        for pdf in batches:
            for start in range(0, len(pdf), BATCH):
                total += of([w for t in pdf["windows"].iloc[start : start + BATCH] if t for w in t.split(b"\n")])
        flat = total.ravel()
        some = np.flatnonzero(flat)
        yield pd.DataFrame({"at": some, "n": flat[some].astype(np.int64)})

    got = texts.select("windows").mapInPandas(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(kinds * ((1 << BITS) + 1))
    total[got["at"].to_numpy(np.int64)] = got["n"].to_numpy(float)
    return total.reshape(kinds, -1)


def model_for(texts: DataFrame) -> Model:
    """Fitted on all windows of ``encoded_documents``: first on all of them as ordinary ones, then with those above the
    threshold of the first model as toxic ones."""
    ordinary = _counted(texts, 1, lambda ws: [counts(ws)])[0]
    sent = texts.sparkSession.sparkContext.broadcast(fitted(ordinary))

    def sure(ws: list[bytes]) -> list[np.ndarray]:
        scores, nearest = sent.value.judged(ws)
        return [counts([ws[i] for i in np.flatnonzero((scores >= sent.value.threshold) & (nearest == c))]) for c in range(len(CATEGORIES))]

    model = fitted(ordinary, _counted(texts, len(CATEGORIES), sure))
    model.threshold = None  # told by all scores
    return model


def emptiest(steps: dict[int, int]) -> float:
    """The lowest score between ``LEAST`` and ``TOP`` that has the fewest windows about it, from the numbers of windows by
    steps of ``STEP``."""
    about = lambda k: sum(steps.get(j, 0) for j in range(k - NEAR, k + NEAR))
    return max(LEAST, min(range(round(TOP / STEP)), key=lambda k: (about(k), k)) * STEP)


def score(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, source, score and, per category, the best score of its windows (0 if none is above the threshold)."""
    texts = encoded_documents(documents)
    if model is None:
        texts = cut(texts)
        model = model_for(texts)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here = sent.value
        low = LEAST if here.threshold is None else here.threshold
        for whole in batches:
            for start in range(0, len(whole), BATCH):
                pdf = whole.iloc[start : start + BATCH]
                each = [t.split(b"\n") if t else [] for t in pdf["windows"]]
                scores, nearest = here.judged([w for ws in each for w in ws])
                ends = np.cumsum([len(ws) for ws in each])[:-1]
                out = pdf[["doc_id", "source"]].copy()
                parts = list(zip(np.split(scores, ends), np.split(nearest, ends)))
                out["score"] = [max(0.0, round(float(s.max()), 4)) if len(s) else 0.0 for s, _ in parts]
                for k, c in enumerate(CATEGORIES):
                    out[c] = [s[(n == k) & (s >= low)].tolist() for s, n in parts]
                yield out

    types = "doc_id long, source string, score double, " + ", ".join(f"{c} array<double>" for c in CATEGORIES)
    scored, least = texts.mapInPandas(run, types), model.threshold
    if least is None:
        scored = cut(scored)
        steps = scored.select(F.explode(F.concat(*CATEGORIES)).alias("s")).groupBy(F.floor(F.col("s") / STEP).cast("int").alias("step")).count()
        least = emptiest({r["step"]: r["count"] for r in steps.where(F.col("step") <= round(TOP / STEP) + NEAR).collect()})
    best = lambda c: F.round(F.coalesce(F.array_max(F.filter(c, lambda x: x >= least)), F.lit(0.0)), 4).alias(c)
    return scored.select("doc_id", "source", "score", *map(best, CATEGORIES))


def found(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, category of every document and category found in it."""
    scored = score(documents, model)
    each = F.explode(F.filter(F.array(*[F.when(F.col(c) > 0, F.lit(c)) for c in CATEGORIES]), lambda c: c.isNotNull()))
    return scored.select("doc_id", each.alias("category")).distinct()


def rates(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """Per source: documents, documents with any category, with each, and the share with any."""
    scored = score(documents, model)
    any_ = F.greatest(*CATEGORIES) > 0
    return scored.groupBy("source").agg(
        F.count("*").alias("documents"),
        F.sum(any_.cast("long")).alias("flagged"),
        *[F.sum((F.col(c) > 0).cast("long")).alias(c) for c in CATEGORIES],
        F.round(F.avg(any_.cast("double")), 6).alias("rate"),
    )
