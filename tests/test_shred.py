"""Shredding against a plain walk over the same records, round trips of whole trees, and untidy shapes."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.operators import shred as S
from corpusloom.operators.pages import PAGE_SPEC, children, page_children

SPEC = {"a[]": {"x": None, "b[]": {"y": None, "c[]": {"z": None}}}, "t": None}

leaf = st.one_of(st.none(), st.integers(0, 9), st.text(max_size=3))
level_c = st.one_of(st.none(), st.fixed_dictionaries({}, optional={"z": leaf}))
level_b = st.one_of(
    st.none(), st.fixed_dictionaries({}, optional={"y": leaf, "c": st.one_of(st.none(), st.lists(level_c, max_size=3))})
)
level_a = st.fixed_dictionaries({}, optional={"x": leaf, "b": st.one_of(st.none(), st.lists(level_b, max_size=3))})
record = st.fixed_dictionaries({}, optional={"t": leaf, "a": st.one_of(st.none(), st.lists(level_a, max_size=3))})


def levels(rec, spec=SPEC):
    return S.Levels([{"path": p, "rep": r, "def": d, "val": v} for p, (r, d, v) in S.shred(rec, spec).items()])


def text(x):
    return None if x is None else str(x)


@settings(max_examples=300, deadline=None)
@given(record)
def test_tables_equal_a_plain_walk(rec):
    lv = levels(rec)
    want_a, want_b, want_c = [], [], []
    for i, a in enumerate(rec.get("a") or [], 1):
        want_a.append((i, text(a.get("x"))))
        for j, b in enumerate(a.get("b") or [], 1):
            if b is None:
                continue
            want_b.append((i, j, text(b.get("y"))))
            want_c += [(i, j, k, text(c.get("z"))) for k, c in enumerate(b.get("c") or [], 1) if c is not None]
    got = [(int(n), x) for n, x, ok in zip(lv.number("a[]"), lv.value("a[].x"), lv.there("a[]")) if ok]
    assert got == want_a
    at = "a[].b[].#"
    got = zip(lv.number("a[]", at), lv.number("a[].b[]"), lv.value("a[].b[].y"), lv.there("a[].b[]"))
    assert [(int(i), int(j), y) for i, j, y, ok in got if ok] == want_b
    at = "a[].b[].c[].#"
    got = zip(
        lv.number("a[]", at), lv.number("a[].b[]", at), lv.number("a[].b[].c[]"), lv.value("a[].b[].c[].z"), lv.there("a[].b[].c[]")
    )
    assert [(int(i), int(j), int(k), z) for i, j, k, z, ok in got if ok] == want_c


@settings(max_examples=200, deadline=None)
@given(record)
def test_columns_are_of_one_length_and_within_their_levels(rec):
    cols = S.shred(rec, SPEC)
    for path, (r, d, v) in cols.items():
        rep, most = S.max_levels(path)
        assert len(r) == len(d) == len(v) >= 1 and r[0] == 0
        assert max(r) <= rep and max(d) <= most
        assert all((x is not None) == (k == most) for x, k in zip(v, d) if not path.endswith("#"))
    for parent, child in (("a[].#", "a[].b[].#"), ("a[].b[].#", "a[].b[].c[].#")):
        depth = S.max_levels(parent)[0]
        assert sum(k <= depth for k in cols[child][0]) == len(cols[parent][0])


def test_untidy_shapes():
    assert S.elements(None) is None and S.elements(5) is None and S.elements("no json") is None
    assert S.elements([]) == [] and S.elements({}) == []
    assert S.elements({"n": 1}) == [("1", {"n": 1})]
    assert S.elements({"10": "b", "2": "a"}) == [("2", "a"), ("10", "b")]
    assert S.elements('[{"n": 2}]') == [("1", {"n": 2})]


PAGE = {
    "columns": [
        {"n": "2", "paragraphs": {"3": {"lines": {"text": "only"}}, "1": {"lines": []}}},
        {"paragraphs": None},
    ],
    "headings": {"before_col": 2},
    "entries_hint": json.dumps([{"col": 2, "para": "3"}, {"col": 1, "para": 9}, None]),
}


def as_cols(rec):
    return [{"path": p, "rep": r, "def": d, "val": v} for p, (r, d, v) in S.shred(rec, PAGE_SPEC).items()]


def test_children_of_an_untidy_page():
    assert set(children(as_cols(PAGE))) == {
        ("column", "2", "page"),
        ("paragraph", "2/1", "2"),
        ("paragraph", "2/3", "2"),
        ("line", "2/3/1", "2/3"),
        ("hint", "1", "2/3"),
        ("hint", "2", ""),
        ("heading", "1", "2"),
    }


def test_current_page(spark):
    old, new = json.dumps({"columns": [{"n": 1}]}), json.dumps({"columns": [{"n": 1}, {"n": 2}]})
    rows = [
        (1, "2021-01-01", old, "x"),
        (1, "2021-01-03", new[:-3], "x"),
        (1, "2021-01-02", new, "x"),
        (1, "2021-01-02", new, "x"),
        (2, None, old, "x"),
        (3, "2021-01-01", None, "x"),
        (4, "2021-01-01", "[]", "x"),
        (None, "2021-01-01", old, "x"),
    ]
    df = spark.createDataFrame(rows, "leaf int, written_at string, body string, child string")
    got = sorted((r.idx, r.kind, r.child, r.parent) for r in page_children(df).collect())
    assert got == [(1, "column", "1", "page"), (1, "column", "2", "page"), (2, "column", "1", "page")]
    assert page_children(df.limit(0)).count() == 0


def test_flat_table(spark):
    df = spark.createDataFrame([(7, json.dumps({"a": [{"x": 1, "b": [{"y": "q"}]}, {"x": 2}]}))], "k int, body string")
    cols = S.shredded(df, "body", ["k"], SPEC)
    a = S.flat_table(cols, ["k"], "a[]", ["x"]).collect()
    b = S.flat_table(cols, ["k"], "a[].b[]", ["y"]).collect()
    assert [tuple(r) for r in a] == [(7, 1, "1"), (7, 2, "2")] and [tuple(r) for r in b] == [(7, 1, 1, "q")]
