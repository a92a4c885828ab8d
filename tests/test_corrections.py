"""Located corrections, uncrossed anchors against brute force, word lists, and asking a model in batches."""

import random

from pyspark.sql import functions as F

from corpusloom.operators import corrections as C


def test_corrections(spark):
    text = "Стран. 2, строка 1 сверху: напечатано столпь, слѣдуетъ читать столпъ. Стран. 2, строка 9 снизу: напечатано вода, слѣдуетъ читать воды."
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "Стран. 2, строка 1 снизу: напечатано домъ, слѣдуетъ читать дома.")], "doc_id int, text string")
    parsed = C.parsed(docs, "text", ["doc_id"])
    assert sorted((r.line, r.below, r.printed, r.read) for r in parsed.collect()) == [(1, False, "столпь", "столпъ"), (1, True, "домъ", "дома"), (9, True, "вода", "воды")]
    lines = spark.createDataFrame([(2, "a", "p"), (2, "b", "q"), (2, "c", "r")], "page int, o string, para string")
    texts = spark.createDataFrame([(2, "p", "сто- лпь стоитъ"), (2, "q", "вода"), (2, "r", "рыба")], "page int, para string, t string")
    found = lambda ls: {r.printed: (r.how, r.found_in) for r in C.located(parsed, ls, "page", "o", "para", texts, "t").collect()}
    assert found(lines) == {"столпь": ("line", "p"), "вода": ("page", "q"), "домъ": ("miss", "r")}
    assert found(lines.limit(0)) == {"столпь": ("page", "p"), "вода": ("page", "q"), "домъ": ("", None)}


def test_pages_beyond_a_small_book(spark, tmp_path):
    """Corrections are looked up on the leaf with the printed page they name, however large it is."""
    from corpusloom.plans.corrections import errata_located

    text = "Стран. 300, строка 2 сверху: напечатано вода, слѣдуетъ читать воды. Стран. 7, строка 1 сверху: напечатано домъ, слѣдуетъ читать дома."
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(310, "300"), (310, None), (48, "48"), (7, "XIV")], "idx int, printed_page string").write.parquet(f"{tmp_path}/manifest.parquet")
    lines = [(310, "0310-1-01", "рыба\nвода"), (48, "0048-1-01", "вода\nвода"), (7, "0007-1-01", "домъ")]
    spark.createDataFrame(lines, "leaf int, para_id string, text_d string").write.parquet(f"{tmp_path}/paragraphs.parquet")
    got = {r.page: (r.how, r.found_in) for r in errata_located(spark, str(tmp_path)).collect()}
    assert got == {300: ("line", "0310-1-01"), 7: ("", None)}


def test_uncrossed(spark):
    rng = random.Random(6)
    rows = [(k % 3, rng.randrange(12), rng.randrange(12)) for k in range(24)] + [(0, None, 1)]
    got = sorted((r.k, r.a, r.b) for r in C.uncrossed(spark.createDataFrame(rows, "k int, a int, b int"), ["k"], "a", "b").collect())
    want = []
    for i, (k, a, b) in enumerate(rows):
        others = [(x, y) for j, (q, x, y) in enumerate(rows) if q == k and j != i and x is not None]
        if a is not None and all(x != a and y != b and (x < a) == (y < b) for x, y in others):
            want.append((k, a, b))
    assert got == sorted(want)


def test_lists(spark):
    df = spark.createDataFrame([(1, ["а", "б", "в"], ["а", "в"]), (2, [], ["а"]), (3, None, None)], "k int, truth array<string>, read array<string>")
    assert {r.k: (r.n, r.distance, r.exact) for r in C.list_scores(df, ["k"], "truth", "read").collect()} == {1: (3, 1, 2), 2: (0, 1, 0), 3: (0, 0, 0)}


def test_a_failing_batch_stays_alone(spark):
    def ask(questions):
        if "bad" in questions:
            raise RuntimeError("no answer")
        return [q.upper() for q in questions]

    df = spark.createDataFrame([(k, "bad" if k == 3 else f"q{k}") for k in range(6)], "k int, q string").coalesce(1)
    got = {r.k: (r.answer, r.error) for r in C.asked(df, ["k"], "q", ask, 2).collect()}
    assert got[0] == ("Q0", None) and got[4] == ("Q4", None) and got[2][0] is None and "no answer" in got[3][1]
    assert df.select(F.count("*")).first()[0] == 6


def test_filled_gaps(spark):
    a = spark.createDataFrame([(1, x) for x in (2, 5, 9, 12, 20)], "k int, a int")
    b = spark.createDataFrame([(1, x) for x in (3, 6, 9, 13, 14, 21)], "k int, b int")
    anchors = spark.createDataFrame([(1, 9, 9), (1, 20, 21)], "k int, a int, b int")
    got = sorted((r.a, r.b, r.anchored) for r in C.filled_gaps(anchors, a, b, ["k"], "a", "b").collect())
    assert got == [(2, 3, False), (5, 6, False), (9, 9, True), (20, 21, True)]  # one line against two is left alone
