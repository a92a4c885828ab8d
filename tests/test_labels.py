"""Lines to learn from, old spellings by seed, requests and answers."""

import json
from binascii import crc32

from corpusloom.operators import labels as B
from corpusloom.operators import requests as R

LINE = "leaf int, n int, k int, row int, text string, disputed array<struct<s:int,e:int>>, b0 int, b1 int, hyphen boolean, read string, x0 int, x1 int, width int, cut boolean"


def test_labelled(spark):
    text = "Слово = рѣчь людей\nи еще другія слова"
    going = next(k for k in range(100) if crc32(f"1-1-{k}".encode()) % 100 < B.RATE)
    never = next(k for k in range(100) if crc32(f"1-1-{k}".encode()) % 100 >= B.RATE)
    row = lambda k, r, b0, b1, spans=(), read="Слово = рѣчь людей", x0=100, x1=900, cut=False, hyphen=False: (1, 1, k, r, text, [{"s": s, "e": e} for s, e in spans], b0, b1, hyphen, read, x0, x1, 1000, cut)
    rows = [
        row(500, 1, 0, 18, [(13, 18)]), row(501, 1, 0, 18, [(2, 3)]), row(502, 1, 0, 18, x0=2), row(503, 1, 0, 18, x1=998), row(504, 1, 0, 18, cut=True), row(505, 1, 0, 18, read="да"),
        row(506, 1, 19, 37), row(going, 2, 19, 37, hyphen=True), row(never, 2, 19, 37), row(going + 1000, 2, 19, 37, [(20, 21)]),
    ]
    got = sorted((r.k, r["first"], r.label, r.tail) for r in B.labelled(spark.createDataFrame(rows, LINE)).collect())
    assert [x for x in got if x[0] in (going, *range(500, 510))] == sorted([(500, True, "Слово = рѣчь людей", 5), (going, False, "и еще другія слова-", 0)])
    assert B.labelled(spark.createDataFrame(rows, LINE).limit(0)).count() == 0


def test_old_spelling():
    seen = {B.old_spelling("Отецъ", str(k))[0] for k in range(60)}
    assert any(w.startswith("Ѿ") for w in seen) and B.old_spelling("слово", "7") == B.old_spelling("слово", "7")
    back = str.maketrans({"ѡ": "о", "ѻ": "о", "ꙋ": "у", "ѹ": "у", "ѫ": "у", "ѧ": "я", "ѩ": "я", "ꙗ": "я", "є": "е", "ѥ": "е", "ѭ": "ю", "ѵ": "и", "ѕ": "з", "ꙁ": "з", "ѳ": "ф"})
    for k in range(40):
        plain, marked = B.old_spelling("земляника", str(k))
        assert plain.translate(back) == "земляника" and marked.replace(B.BREATHING, "").replace(B.ACUTE, "") == plain and marked.count(B.ACUTE) == 1
    assert B.old_spelling("", "1") == ("", "")


def test_requests(spark):
    items = spark.createDataFrame([(3, "b", "Дѣло"), (3, "a", "Слово"), (1, "a", "Азъ"), (2, "a", "Буки")], "leaf int, id string, h string")
    asked = R.requests(items, "leaf", ["id"], "h", [("x", None)], size=2)
    got = {r.leaf: (r.n, r.batch, json.loads(r.request)) for r in asked.collect()}
    assert got[3] == (2, 1, {"examples": [{"ask": "x"}], "items": ["Слово", "Дѣло"]}) and got[1][1] == got[2][1] == 0
    assert sorted((r.batch, r.pages, r.n, r.status) for r in R.ledger(asked, "leaf").collect()) == [(0, "1-2", 2, "submitted"), (1, "3", 1, "submitted")]
    answers = spark.createDataFrame([(3, 'so: ["Слѡво ", "null"].', "succeeded", 10, 5, 2), (3, "[", "succeeded", 1, 0, 1), (1, '["а", "б"]', "succeeded", 4, 0, 1)], "leaf int, text string, state string, tokens_in int, tokens_cached int, tokens_out int")
    readings, failures, account = R.collected(asked, answers, "leaf")
    assert sorted((r.leaf, r.k, r.reading) for r in readings.collect()) == [(3, 1, "Слѡво"), (3, 2, None)]
    assert sorted((r.leaf, r.why) for r in failures.collect()) == [(1, "2 answers for 1"), (2, "no answer")]
    assert sorted((r.batch, r.status, r.tokens_in) for r in account.collect()) == [(0, "collected (2 failed)", 4), (1, "collected", 11)]
