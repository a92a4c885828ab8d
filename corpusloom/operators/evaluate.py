"""Readings against the truth: heads as each reader has them, places where readers agree against it, differences, starts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import normalised
from corpusloom.operators.align import align, carried


def _zoned(truth: list[tuple[str, str, bool]]) -> tuple[list[str], list[str]]:
    """Normal characters of a truth given as (character, zone, start), and the zone of each."""
    text = "".join(ch for ch, _, _ in truth)
    seq, at = normalised(text)
    return seq, [truth[k][1] for k in at]


def _between(read: list[str], at: list[int], lo: int, hi: int) -> str:
    return "".join(read[at[lo] : at[hi] if hi < len(at) else len(read)])


def head_readings(truth: list[tuple[str, str, bool]], readers: dict[str, str]) -> list[dict]:
    """Of every headword of a page: the truth, and of each reader what is read there and whether it is right (normal form)."""
    seq, zones = _zoned(truth)
    spans = [[k for k, _ in g] for zone, g in groupby(enumerate(zones), key=lambda x: x[1]) if zone == "hw"]
    out = [{"truth": "".join(seq[k] for k in span)} for span in spans]
    for name, text in readers.items():
        read, _ = normalised(text)
        _, cost, at = align(seq, read)
        for row, span in zip(out, spans):
            row[name] = _between(read, at, span[0], span[-1] + 1)
            row[f"{name}_ok"] = not any(cost[k] for k in span)
    return out


def suspects(truth: str, readers: list[str], context: int = 12) -> list[tuple[int, str, str, str, str]]:
    """(place, truth, reading, before, after) of the longest runs of characters where all readers agree on something that the
    truth does not have: faults of the truth, or of all of them."""
    seq, _ = normalised(truth)
    told = []
    for text in readers:
        read, _ = normalised(text)
        at = align(seq, read)[2]
        told.append([_between(read, at, k, k + 1) for k in range(len(seq))])
    agreed = [len(set(x)) == 1 and x[0] != ch for ch, x in zip(seq, zip(*told))] if told else []
    out = []
    for against, run in groupby(range(len(agreed)), key=agreed.__getitem__):
        ks = list(run)
        if against:
            s, e = ks[0], ks[-1] + 1
            out.append((s, "".join(seq[s:e]), "".join(told[0][s:e]), "".join(seq[max(0, s - context) : s]), "".join(seq[e : e + context])))
    return out


def differences(truth: str, read: str, context: int = 6, join: int = 2) -> list[tuple[int, str, str]]:
    """(place, truth, reading) of each stretch of the truth that is read otherwise, with some context; stretches not further
    apart than ``join`` are one."""
    seq, other = normalised(truth)[0], normalised(read)[0]
    _, cost, at = align(seq, other)
    wrong = [k for k, c in enumerate(cost) if c]
    groups: list[list[int]] = []
    for k in wrong:
        if groups and k - groups[-1][-1] <= join:
            groups[-1].append(k)
        else:
            groups.append([k])
    out = []
    for g in groups:
        lo, hi = max(0, g[0] - context), min(len(seq), g[-1] + 1 + context)
        out.append((g[0], "".join(seq[lo:hi]), _between(other, at, lo, hi)))
    return out


def line_markers(truth: str, lines: list[str]) -> tuple[list[int], str]:
    """(where each printed line begins in a truth text, what is doubtful): the lines of a reading, carried over. A line whose
    text in the truth is under 0.8 or over 1.25 of its own in letters makes the places doubtful ("length"), as do lines that
    begin at one place ("count")."""
    joined, starts = "", []
    for line in lines:
        joined += " " if joined else ""
        starts.append(len(joined))
        joined += line.strip()
    if not joined or not truth:
        return [0] * len(lines), "count" if len(lines) > 1 else ""
    at = [0, *map(int, carried(joined, truth, starts[1:]))] if len(starts) > 1 else [0] * len(starts)
    size = lambda t: sum(map(str.isalnum, t))
    parts = [truth[s:e] for s, e in zip(at, [*at[1:], len(truth)])]
    if len(set(at)) < len(at):
        return at, "count"
    off = [size(line) and not 0.8 <= size(part) / size(line) <= 1.25 for line, part in zip(lines, parts)]
    return at, "length" if any(off) else ""


def _texts(df: DataFrame, keys: list[str], truth: str, readers: list[str], types: str, rows) -> DataFrame:
    names = [c.split()[0] for c in types.split(", ")]
    kinds = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys), types])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [(*key, *row) for *key, t, r in zip(*[pdf[c] for c in keys], pdf[truth], pdf[readers].itertuples(index=False, name=None)) for row in rows(t, r)]
            yield pd.DataFrame(found, columns=[*keys, *names])

    return df.select(*keys, truth, *readers).mapInPandas(run, kinds)


def suspect_places(df: DataFrame, keys: list[str], truth: str, readers: list[str]) -> DataFrame:
    """keys and the rows of ``suspects``; a NULL truth has none, readers without a text are not asked."""
    rows = lambda t, r: suspects(t, [x for x in r if x is not None]) if t else []
    return _texts(df, keys, truth, readers, "place int, truth string, reading string, before string, after string", rows)


def text_differences(df: DataFrame, keys: list[str], truth: str, read: str) -> DataFrame:
    """keys and the rows of ``differences``; NULL texts are empty ones."""
    return _texts(df, keys, truth, [read], "place int, truth string, reading string", lambda t, r: differences(t or "", r[0] or ""))


def doubtful_starts(lines: DataFrame, keys: list[str], order: list[str], start: str) -> DataFrame:
    """Lines (text, x1, ind) of columns of four or more whose being an entry's start or not looks wrong: "missed" (no start, at
    the hanging indent, a "=" in its first two fifths, after a short line) and "false" (a start without "=" or a dash of its own,
    after a line that ends in a hyphen). A line is short if it ends 120 before the middle of the right edges of the longer two
    thirds of its column."""
    w, group = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*keys)
    ranked = lines.withColumn("_r", F.row_number().over(group.orderBy("x1"))).withColumn("_n", F.count("*").over(group))
    edge = F.percentile(F.when(F.col("_r") > F.floor(F.col("_n") / 3), F.col("x1")), 0.5).over(group)
    told = ranked.withColumn("_edge", edge).withColumn("_before", F.lag("text").over(w)).withColumn("_x1", F.lag("x1").over(w)).where("_n >= 4 and _before is not null")
    eq = F.instr("text", "=") - 1
    missed = ~F.col(start) & (F.col("ind") == 1) & (eq >= 0) & (eq < F.length("text") * 0.4) & (F.col("_x1") < F.col("_edge") - 120)
    false = F.col(start) & (eq < 0) & ~F.col("text").rlike(r"\s[—-]\s") & F.col("_before").rlike("[¬-]$")
    told = told.withColumn("what", F.when(missed, "missed").when(false, "false")).where("what is not null")
    return told.select(*keys, *order, "what", F.substring(F.col("_before"), F.greatest(F.length("_before") - 19, F.lit(1)), F.lit(20)).alias("before"), F.substring("text", 1, 50).alias("line"))


def coverage(df: DataFrame, by: str, **tests: Column) -> DataFrame:
    """Per witness: n, and of each test how many hold and their share."""
    sums = [F.sum(F.coalesce(t, F.lit(False)).cast("long")).alias(name) for name, t in tests.items()]
    counted = df.groupBy(by).agg(F.count("*").alias("n"), *sums)
    return counted.select(by, "n", *tests, *[F.round(F.col(name) / F.col("n"), 6).alias(f"{name}_share") for name in tests])

