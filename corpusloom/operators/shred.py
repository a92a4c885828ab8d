"""Nested, loosely typed records as columns of levels, and flat tables with parent links made from those columns.

A record is shredded into one column per leaf path. Each column holds, for every value or missing value, a repetition
level (at which repeated ancestor a new element begins) and a definition level (how much of the path is there). Tables
are rebuilt from the level sequences alone: an element's number within its parent, and the parent itself, are
arithmetic on the repetition levels. Only the paths a caller names are shredded.

A specification is a dict of field names; a name with "[]" is a repeated group, its value the specification below it;
any other name is a leaf. Each repeated group has a further leaf "#", the element's number. A leaf whose value is
``list`` holds a list as a whole (a box, the words of a line), kept as its JSON text.

Defined results for untidy input:

* absent, NULL and wrongly shaped fields count as missing; an empty list has no element;
* a single record where a list should be is element 1; a JSON text where a list should be is read;
* an object whose keys are all numbers holds elements that keep those numbers;
* a NULL element has no row, but the following elements keep their places;
* a record that is not readable JSON, or no object, gives no row (``readable`` tells).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLS = "array<struct<path:string,rep:array<tinyint>,def:array<tinyint>,val:array<string>>>"


def leaf_paths(spec: dict, prefix: str = "") -> list[str]:
    out = []
    for name, below in spec.items():
        if name.endswith("[]"):
            out += [f"{prefix}{name}.#", *leaf_paths(below, f"{prefix}{name}.")]
        else:
            out.append(f"{prefix}{name}")
    return out


def max_levels(path: str) -> tuple[int, int]:
    """The highest repetition and definition level of a leaf path. A repeated group has three definition levels (the
    field is there, it has an element, the element is not NULL), a leaf one; "#" is there when its element is."""
    parts = path.split(".")
    rep = sum(p.endswith("[]") for p in parts)
    return rep, 3 * rep + (parts[-1] != "#")


def elements(value) -> list[tuple[str, object]] | None:
    """(number, element) of a repeated field; None where it is missing."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return None
        if isinstance(value, str):
            return None
    if isinstance(value, list):
        return [(str(k), x) for k, x in enumerate(value, 1)]
    if isinstance(value, dict):
        if not value:
            return []
        keys = [k.strip() for k in value]
        if all(k.isascii() and k.isdigit() for k in keys):
            return sorted(((str(int(k)), x) for k, x in zip(keys, value.values())), key=lambda e: int(e[0]))
        return [("1", value)]
    return None


def scalar(value) -> str | None:
    if value is None or isinstance(value, (dict, list)):
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float) and value.is_integer() and abs(value) < 1e15:
        return str(int(value))
    return str(value)


def listed(value) -> str | None:
    """A list as JSON text, its loose shapes read as those of a repeated group."""
    found = elements(value)
    return None if found is None else json.dumps([x for _, x in found], ensure_ascii=False)


def shred(record: dict, spec: dict) -> dict[str, tuple[list[int], list[int], list[str | None]]]:
    """Levels and values of each leaf path of one record."""
    cols = {p: ([], [], []) for p in leaf_paths(spec)}
    below = {}

    def missing(sub: dict, prefix: str, rep: int, level: int) -> None:
        key = prefix, id(sub)
        if key not in below:
            below[key] = [cols[p] for p in leaf_paths(sub, prefix)]
        for r, d, v in below[key]:
            r.append(rep)
            d.append(level)
            v.append(None)

    def walk(group: dict, sub: dict, prefix: str, rep: int, depth: int, level: int) -> None:
        for name, inner in sub.items():
            path = prefix + name
            if not name.endswith("[]"):
                text = (listed if inner is list else scalar)(group.get(name))
                r, d, v = cols[path]
                r.append(rep)
                d.append(level + (text is not None))
                v.append(text)
                continue
            found = elements(group.get(name[:-2]))
            if not found:
                at = level + (found is not None)
                r, d, v = cols[f"{path}.#"]
                r.append(rep)
                d.append(at)
                v.append(None)
                missing(inner, f"{path}.", rep, at)
                continue
            r, d, v = cols[f"{path}.#"]
            for k, (number, element) in enumerate(found):
                now = rep if k == 0 else depth + 1
                r.append(now)
                if isinstance(element, dict):
                    d.append(level + 3)
                    v.append(number)
                    walk(element, inner, f"{path}.", now, depth + 1, level + 3)
                else:
                    d.append(level + 2)
                    v.append(number)
                    missing(inner, f"{path}.", now, level + 2)

    walk(record, spec, "", 0, 0, 0)
    return cols


def parse(body: str | None) -> dict | None:
    if not body:
        return None
    try:
        record = json.loads(body)
    except (ValueError, RecursionError):
        return None
    return record if isinstance(record, dict) else None


def shredded(df: DataFrame, body: str, keep: list[str], spec: dict) -> DataFrame:
    """Each readable record's columns of levels (``cols``) beside the kept columns; unreadable records give no row.
    No shuffle: one pass over the records in Arrow batches."""
    types = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), 256):
                part = pdf.iloc[start : start + 256]
                records = [parse(b) for b in part[body]]
                ok = [x is not None for x in records]
                out = part.loc[ok, keep].copy()
                out["cols"] = [
                    [{"path": p, "rep": r, "def": d, "val": v} for p, (r, d, v) in shred(x, spec).items()]
                    for x in records
                    if x is not None
                ]
                yield out

    return df.select(*keep, body).mapInPandas(run, f"{types}, cols {COLS}")


class Levels:
    """The columns of one record, with the arithmetic that rebuilds tables from them."""

    def __init__(self, cols) -> None:
        self.cols = {c["path"]: (np.asarray(c["rep"], np.int8), np.asarray(c["def"], np.int8), c["val"]) for c in cols}

    def number(self, group: str, at: str | None = None) -> list[str | None]:
        """The number that the ancestor ``group`` has, for each entry of the column ``at`` (its own column by default)."""
        path = f"{group}.#"
        val = self.cols[path][2]
        if at is None or at == path:
            return list(val)
        depth = max_levels(path)[0]
        pos = np.cumsum(self.cols[at][0] <= depth) - 1
        return [val[i] for i in pos]

    def value(self, path: str, at: str | None = None) -> list[str | None]:
        """A leaf's values, carried down to the entries of a deeper column ``at``."""
        val = self.cols[path][2]
        if at is None:
            return list(val)
        pos = np.cumsum(self.cols[at][0] <= max_levels(path)[0]) - 1
        return [val[i] for i in pos]

    def there(self, group: str) -> np.ndarray:
        """Which entries of the group's own column are elements."""
        path = f"{group}.#"
        return self.cols[path][1] == max_levels(path)[1]


def flat_table(df: DataFrame, keep: list[str], group: str, leaves: list[str] | None = None) -> DataFrame:
    """The table of a repeated group out of ``shredded``: one row per element, with the numbers of the element and of
    each repeated ancestor (columns ``n1``, ``n2``, ... from the outermost) and the group's own leaves."""
    parts = group.split(".")
    ancestors = [".".join(parts[: k + 1]) for k, p in enumerate(parts) if p.endswith("[]")]
    leaves = leaves or []
    numbers = [f"n{k}" for k in range(1, len(ancestors) + 1)]
    types = ", ".join(
        [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
        + [f"{c} int" for c in numbers]
        + [f"`{c}` string" for c in leaves]
    )
    wanted = [f"{a}.#" for a in ancestors] + [f"{group}.{x}" for x in leaves]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for *key, cols in pdf[[*keep, "cols"]].itertuples(index=False, name=None):
                lv = Levels(cols)
                there = lv.there(group)
                at = f"{group}.#"
                data = [lv.number(a, at) for a in ancestors] + [lv.value(f"{group}.{x}") for x in leaves]
                k = len(ancestors)
                rows += [
                    (*key, *(int(x[i]) for x in data[:k]), *(x[i] for x in data[k:])) for i in np.flatnonzero(there)
                ]
            yield pd.DataFrame(rows, columns=[*keep, *numbers, *leaves])

    few = F.filter("cols", lambda c: c["path"].isin(wanted))
    return df.select(*keep, few.alias("cols")).mapInPandas(run, types)


def latest(df: DataFrame, key: str, at: str) -> DataFrame:
    """Of each key the shredded record with the latest ``at``; of equal ones the one whose columns sort last. A key
    with very many records is reduced before the shuffle, as max_by keeps one record per key and task."""
    best = F.max_by("cols", F.struct(F.col(at), F.xxhash64(F.to_json("cols")))).alias("cols")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(best)


def earliest(df: DataFrame, key: str, at: str) -> DataFrame:
    """As ``latest``, the record with the earliest ``at``."""
    best = F.min_by("cols", F.struct(F.col(at), F.xxhash64(F.to_json("cols")))).alias("cols")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(best)
