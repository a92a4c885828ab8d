"""Ordered scans, geometry, quality and upkeep on small fixtures against plain Python."""

import math
import random
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.operators import geometry as G
from corpusloom.operators import layout as L
from corpusloom.operators import ordered as O
from corpusloom.operators import quality as Q
from corpusloom.operators import upkeep as U
from corpusloom.operators.entries import assembled


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=9))
def test_longest_ordered(values):
    kept = [v for v, k in zip(values, O.longest_ordered(values)) if k]
    assert kept == sorted(kept)
    best = max((n for n in range(len(values) + 1) for c in combinations(values, n) if list(c) == sorted(c)), default=0)
    assert len(kept) == best


def test_islands_and_ranges(spark):
    df = spark.createDataFrame([("a", x) for x in (1, 2, 3, 3, 7, None)] + [("b", 5), ("c", None)], "k string, x int")
    assert sorted((r.k, r.lo, r.hi) for r in O.islands(df, ["k"], "x").collect()) == [("a", 1, 3), ("a", 7, 7), ("b", 5, 5)]
    assert {r.k: r.ranges for r in O.compact_ranges(df, ["k"], "x").collect()} == {"a": "1-3,7", "b": "5"}
    assert O.compact_ranges(df.limit(0), ["k"], "x").count() == 0


def test_nearest(spark):
    rng = random.Random(1)
    left = [(k, rng.choice("ab"), rng.randrange(200)) for k in range(60)]
    right = [(rng.choice("ab"), rng.randrange(200)) for _ in range(25)]
    got = O.nearest_within(
        spark.createDataFrame([*left, left[0]], "i int, k string, x int"), spark.createDataFrame([*right, ("c", None)], "k string, y int"), ["k"], "x", "y", 4
    ).collect()
    want = {i: min((y for kk, y in right if kk == k and abs(x - y) <= 4), key=lambda y: (abs(x - y), y), default=None) for i, k, x in left}
    assert len(got) == 61 and all(r.y == want[r.i] for r in got)


def test_groups_and_bands(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 4, 6), (1, 20, 21), (2, 0, 1)], "k int, lo int, hi int")
    assert sorted((r.k, r.lo, r.band) for r in O.reach_cuts(df, ["k"], "lo", "hi", F.lit(3)).collect()) == [(1, 0, 0), (1, 4, 0), (1, 20, 1), (2, 0, 0)]
    flags = spark.createDataFrame([(1, 1, None), (1, 2, "s"), (1, 3, None), (1, 4, "s")], "k int, o int, s string")
    assert [r.grp for r in O.opened_groups(flags, ["k"], ["o"], F.col("s").isNotNull()).orderBy("o").collect()] == [0, 1, 1, 2]
    text = spark.createDataFrame([(1, 1, True, "а-"), (1, 2, False, "б"), (1, 3, True, None), (1, 4, False, "в")], "p int, o int, s boolean, t string")
    assert [r.text for r in assembled(text, ["p"], ["o"], "s", "t").orderBy("first_o").collect()] == ["аб", "в"]


def test_entries_go_on_over_leaves(spark, tmp_path):
    """Against one pass in the book's order; an entry may cover whole leaves and columns."""
    from corpusloom.plans.texts import assembled_entries

    rng = random.Random(8)
    rows = [(leaf, col, k, rng.random() < 0.4, f"t{leaf}/{col}/{k}") for leaf in (9, 10, 11, 12, 14) for col in (1, 2) for k in range(1, rng.randrange(2, 5))]
    rows = [(*r[:3], False, r[4]) if r[0] == 11 else r for r in rows]
    spark.createDataFrame(rows[::-1], "leaf int, col int, para int, hanging boolean, text_d string").write.parquet(f"{tmp_path}/paragraphs.parquet")
    want = []
    for leaf, col, para, start, t in rows:
        if start or not want:
            want.append([leaf, col, para, 0, ""])
        want[-1][3:] = [want[-1][3] + 1, f"{want[-1][4]} {t}".strip()]
    got = assembled_entries(spark, str(tmp_path)).select("leaf", "first_col", "first_para", "n", "text").collect()
    assert sorted(map(list, got)) == want


def test_section_changes_at_hundreds(spark, tmp_path):
    """Also on the first leaf of a hundred, and where hundreds of leaves are missing."""
    from corpusloom.plans.ordered import section_changes

    rows = [(98, "main", "А"), (99, "main", "А"), (100, "main", "Б"), (101, "main", "Б"), (200, "main", "Б"), (500, None, "Б"), (600, None, "Б"), (600, None, None), (None, "x", "x")]
    spark.createDataFrame(rows, "idx int, section string, letter string").write.parquet(f"{tmp_path}/manifest.parquet")
    got = sorted((r.idx, r.section, r.letter, r.before, r.letter_before) for r in section_changes(spark, str(tmp_path)).collect())
    assert got == [(100, "main", "Б", "main", "А"), (500, None, "Б", "main", "Б")]


def test_order_flags(spark):
    df = spark.createDataFrame([("m", 1, "а"), ("m", 2, "я"), ("m", 3, "б"), ("m", 4, None), ("m", 5, "в"), ("s", 1, "а")], "part string, o int, key string")
    got = {(r.part, r.o): r.in_order for r in O.out_of_order(df, "part", ["o"], "key").collect()}
    assert got == {("m", 1): True, ("m", 2): False, ("m", 3): True, ("m", 4): None, ("m", 5): True, ("s", 1): True}
    assert O.out_of_order(df.limit(0), "part", ["o"], "key").count() == 0


def test_order_flags_over_a_whole_part(spark, tmp_path):
    """A head in order among its neighbours but not in its part is flagged; leaves count as numbers, not as text."""
    from corpusloom.plans.ordered import order_flags

    heads = {"0011-1-01": "а", "0012-1-01": "б", "0021-1-01": "я", "0022-1-01": "я", "0031-1-01": "в", "9999-1-01": "г", "10000-1-01": "д", "10001-1-01": "е"}
    rows = [(k, "main", v, v) for k, v in heads.items()] + [("0040-1-01", "supplement", "а", None), ("0041-1-01", "main", "тожде", "тожде"), ("0042-1-01", "main", None, None)]
    spark.createDataFrame(rows, "id string, part string, headword_civil string, headword_key string").write.parquet(f"{tmp_path}/entries.parquet")
    assert sorted(r.id for r in order_flags(spark, str(tmp_path)).collect()) == ["0021-1-01", "0022-1-01"]


def test_pieces(spark):
    texts = spark.createDataFrame([(1, 10), (2, 4)], "id int, n int")
    spans = spark.createDataFrame([(1, 2, 6, "x"), (1, 4, 8, "y"), (1, 4, 20, "y")], "id int, s int, e int, kind string")
    got = sorted((r.id, r.s, r.e, r.kinds) for r in O.interval_pieces(texts, spans, "id", "n").collect())
    assert got == [(1, 0, 2, ""), (1, 2, 4, "x"), (1, 4, 6, "x+y"), (1, 6, 8, "y"), (1, 8, 10, "y"), (2, 0, 4, "")]


def test_boxes(spark):
    old = spark.createDataFrame([(1, "a", 0, 0, 10, 10), (1, "b", 1000, 0, 1400, 100)], "page int, id string, x0 int, y0 int, x1 int, y1 int")
    new = spark.createDataFrame([(1, "p", 0, 0, 10, 11), (1, "q", 1, 0, 11, 10), (2, "a", 0, 0, 10, 10)], "page int, id string, x0 int, y0 int, x1 int, y1 int")
    assert sorted((r.o_id, r.n_id) for r in G.best_overlaps(old, new, "page", "id", 0.3).collect()) == [("a", "p"), ("b", None)]
    more = old.unionByName(spark.createDataFrame([(1, "c", 0, 0, 10, 11)], old.schema))  # wants the box that the first one has
    assert sorted((r.o_id, r.n_id) for r in G.best_overlaps(more, new, "page", "id", 0.3).collect()) == [("a", "p"), ("b", None), ("c", None)]
    points = spark.createDataFrame([(1, 5.0, 5.0), (1, 500.0, 5.0), (1, None, 1.0)], "page int, x double, y double")
    assert G.points_in_boxes(points, new, ["page"], "x", "y").count() == 2


def test_statistics(spark):
    rng = random.Random(2)
    rows = [(float(x), 3.0 + 0.5 * x + rng.random() / 100, 1.0 + x % 3) for x in range(40)]
    a, b = G.weighted_line(F.col("x"), F.col("y"), F.col("w"))
    got = spark.createDataFrame(rows, "x double, y double, w double").agg(a.alias("a"), b.alias("b")).first()
    assert abs(got.a - 3.005) < 0.01 and abs(got.b - 0.5) < 0.001
    mean, strength = G.circular(F.col("x"))
    got = spark.createDataFrame([(0.1,), (2 * math.pi - 0.1,)], "x double").agg(mean.alias("m"), strength.alias("s")).first()
    assert abs(got.m) < 1e-9 and abs(got.s - math.cos(0.1)) < 1e-9
    df = spark.createDataFrame([(1, 4), (1, 2), (1, 2), (1, 4), (2, None)], "k int, v int")
    assert [(r.k, r.m) for r in G.mode_low(df, ["k"], "v", "m").collect()] == [(1, 2)]
    assert df.where("k = 1").agg(G.upper_median("v").alias("m")).first().m == 4
    conf = spark.createDataFrame([(1,), (2,), (-1,), (None,)], "c int").agg(G.mean_confidence(F.col("c")).alias("m")).first().m
    assert conf == 2 and spark.createDataFrame([(-1,)], "c int").agg(G.mean_confidence(F.col("c")).alias("m")).first().m == -1


def test_layout(spark):
    words = [(1, t, float(x), float(y), float(x + 80), float(y + 20), 1000, 800) for t, x, y in [("а", 100, 100), ("б", 200, 104), ("в", 600, 100), ("глаголю", 100, 140), ("", 480, 500)]]
    df = spark.createDataFrame(words, "leaf int, text string, x0 double, y0 double, x1 double, y1 double, width int, height int").selectExpr("*", "false as signature", "false as foot")
    got = [(r.side, r.line, r.raw, r.s, r.e) for r in L.read_pages(df, ["leaf"]).orderBy("line").collect()]
    assert got == [("a", 0, "а б", 0, 3), ("a", 1, "глаголю", 4, 11), ("b", 2, "в", 12, 13)]
    assert L.read_pages(df.limit(0), ["leaf"]).count() == 0
    lines = spark.createDataFrame([(1, 100.0 + 50 * (k % 2) + 0.005 * 100 * k, 100.0 * k) for k in range(12)], "leaf int, x0 double, y0 double")
    assert G.skew_grid(lines, ["leaf"], 50.0, [k / 1000 for k in range(-10, 11)]).first().slope == 0.005
    levels = spark.createDataFrame([(1, 0, True)] * 5 + [(1, 1, False)] * 9 + [(1, 0, False)], "leaf int, level int, start boolean")
    assert G.flush_level(levels, ["leaf"], "level", "start").first().flush == 0


def test_quality(spark):
    df = spark.createDataFrame([(g, k) for g in "ab" for k in range(6)] + [("c", 1)], "g string, k int")
    got = Q.top_per_group(df, "g", ["k"], 4).collect()
    assert len(got) == 9 and {r.more for r in got if r.g == "a"} == {2} and max(r.k for r in got) == 3
    two = Q.two_by_two(spark.createDataFrame([(1, True, None), (1, True, True), (1, False, True)], "k int, a boolean, b boolean"), ["k"], F.col("a"), F.col("b")).first()
    assert (two.both, two.only_a, two.only_b, two.neither) == (1, 1, 1, 0)


def test_upkeep(spark, tmp_path):
    df = spark.createDataFrame([(k, k % 3, f"t{k}") for k in range(100)], "id int, v int, s string")
    sheets = {r.id: r.sheet for r in U.batches(df, ["id"], 15, "sheet", 5).collect()}
    assert sheets == {k: k // 15 for k in range(100)}
    assert U.work_list(df.withColumn("v", F.when(F.col("v") > 0, F.col("v"))), "v", 2).count() == 67
    assert U.seeded_sample(df, "id", 3, 9).count() == 9 and U.replaced(df, df.where("v = 1").limit(2), ["v"]).count() == 69
    old, new = df.where("id < 2"), df.where("id < 3").withColumn("s", F.lit("n"))
    assert sorted(r.s for r in U.upsert(old, new, ["id"], ["s"]).collect()) == ["n", "t0", "t1"]
    U.write_table(df, str(tmp_path / "t"), ["v"])
    U.write_table(df.where("v = 1").withColumn("s", F.lit("again")), str(tmp_path / "t"), ["v"])
    assert spark.read.parquet(str(tmp_path / "t")).where("s = 'again'").count() == 33


def test_islands_over_pieces(spark):
    """Runs that go over the edges of pieces are one."""
    values = [1, 2, 3, 9, 10, 11, 12, 29, 30, 31, -1, 0, 31, None]
    df = spark.createDataFrame([(1, v) for v in values] + [(2, 20)], "k int, v int")
    for piece in (1, 2, 10, 1000):
        got = sorted((r.k, r.lo, r.hi, r.n) for r in O.islands(df, ["k"], "v", piece).collect())
        assert got == [(1, -1, 3, 5), (1, 9, 12, 4), (1, 29, 31, 3), (2, 20, 20, 1)]
