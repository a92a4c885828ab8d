"""Consensus against planted answers, agreement against a plain count, and untidy input."""

import itertools
import random
from collections import defaultdict

from corpusloom.llm import consensus as C

SCHEMA = "label_id long, item_id string, annotator string, label string, labelled_at string, received_at string, score int"


def planted(n=160, seed=3):
    rng, truth, rows = random.Random(seed), {}, []
    people = {f"reader-{k:02d}": p for k, p in enumerate([0.95, 0.9, 0.85, 0.8, 0.6, 0.5, 0.9], 1)}
    for i in range(n):
        t = truth[f"i{i}"] = rng.choice("ddbbax")
        for who, right in people.items():
            if rng.random() < 0.8:
                rows.append((f"i{i}", who, t if rng.random() < right else rng.choice("dbax")))
        rows.append((f"i{i}", "always b", "b"))
        rows.append((f"i{i}", "swaps", {"d": "b", "b": "d"}.get(t, t)))
    return truth, rows


def frames(spark, rows, items):
    full = [(k, i, a, lab, f"2021-01-01 00:00:{k % 60:02d}", None, 1) for k, (i, a, lab) in enumerate(rows)]
    return spark.createDataFrame([(i, "y") for i in items], "item_id string, label string"), spark.createDataFrame(full, SCHEMA)


def test_planted_answers(spark):
    truth, rows = planted()
    items, labels = frames(spark, rows, truth)
    found, people = C.consensus(items, labels)
    got = {r.item_id: r for r in found.collect()}
    assert set(got) == set(truth)
    right = sum(got[i].label == t for i, t in truth.items()) / len(truth)
    majority = defaultdict(list)
    for i, _, lab in rows:
        majority[i].append(lab)
    plain = sum(max("dbax", key=lab.count) == truth[i] for i, lab in majority.items()) / len(truth)
    assert right >= 0.93 and right >= plain
    rel = {r.annotator: r for r in people.collect()}
    assert rel["reader-01"].reliability > rel["reader-05"].reliability > rel["swaps"].reliability
    assert abs(rel["always-b"].informed) < 0.05 and rel["swaps"].informed < rel["reader-06"].informed


def test_untidy_answers(spark):
    rows = [
        (1, "i1", "Reader 01 ", " D.", "2021-01-01", "2021-01-01", 0),
        (1, "i1", "Reader 01 ", " D.", "2021-01-01", "2021-01-01", 0),
        (2, "i1", "reader-01", "wit. B", "2021-01-02", "2021-01-01", 0),
        (3, "i2", "reader-01", "d", "2021-01-01", None, 0),
        (4, "i2", "READER-01", "?", "2021-01-05", None, 0),
        (5, "i3", "reader-02", "text_d", None, None, 0),
        (6, "i3", None, "a", "2021-01-01", None, 0),
        (7, None, "reader-02", "a", "2021-01-01", None, 0),
        (8, "i4", "reader-02", "none", "2021-01-01", None, 0),
        (9, "zz", "reader-02", "a", "2021-01-01", None, 0),
    ]
    labels = spark.createDataFrame(rows, SCHEMA)
    items = spark.createDataFrame([(f"i{k}",) for k in (1, 1, 2, 3, 4, 5)], "item_id string")
    got = sorted((r.item_id, r.annotator, r.label) for r in C.answers(labels, items).collect())
    assert got == [("i1", "reader-01", "b"), ("i3", "reader-02", "d"), ("i4", "reader-02", "x")]
    found = {r.item_id: r for r in C.consensus(items, labels)[0].collect()}
    assert set(found) == {"i1", "i2", "i3", "i4", "i5"}
    assert found["i5"].n_answers == 0 and found["i5"].agreement is None and found["i5"].label in C.CLASSES
    none = C.consensus(items, labels.limit(0))
    assert none[0].count() == 5 and none[1].count() == 0
    assert C.consensus(items.limit(0), labels)[0].count() == 0


def test_alpha(spark):
    _, rows = planted(40)
    items, labels = frames(spark, rows, {i for i, _, _ in rows})
    got = C.alpha(C.answers(labels, items)).first()
    by = defaultdict(list)
    for i, _, lab in rows:
        by[i].append(lab)
    units = [v for v in by.values() if len(v) > 1]
    n = sum(map(len, units))
    apart = sum(sum(a != b for a, b in itertools.permutations(v, 2)) / (len(v) - 1) for v in units) / n
    every = [x for v in units for x in v]
    expected = sum(a != b for a, b in itertools.permutations(every, 2)) / (n * (n - 1))
    assert abs(got.alpha - (1 - apart / expected)) < 1e-5 and got.answers == n


def test_many_annotators(spark, monkeypatch):
    """Beyond the number of annotators that are broadcast the result is the same."""
    truth, rows = planted()
    items, labels = frames(spark, rows, truth)
    near = {r.item_id: (r.label, r.confidence) for r in C.consensus(items, labels)[0].collect()}
    monkeypatch.setattr(C, "BROADCAST_ANNOTATORS", 0)
    far = {r.item_id: (r.label, r.confidence) for r in C.consensus(items, labels)[0].collect()}
    assert {k: v[0] for k, v in near.items()} == {k: v[0] for k, v in far.items()} and all(abs(near[k][1] - far[k][1]) < 1e-4 for k in near)
    told = C.convergence(items, labels).first()
    assert told.rounds > 0 and told.converged == (told.largest_change < 0.01)
