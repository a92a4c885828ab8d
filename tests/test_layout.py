"""The layout of loosely shaped page records."""

import json
from datetime import datetime

from corpusloom.plans import geometry as L


def line(k, **more):
    return {"bbox": [0, 10 * k, 100, 10 * k + 8], "base": 10 * k + 7, "ind": 0, "text": f"l{k}", "words": [[f"w{k}", 0, 10 * k, 40, 10 * k + 8, 90, "i", 11]]} | more


def test_loose_shapes_are_read(spark, tmp_path):
    """Columns as JSON text, paragraphs as numbered objects, a line without a list, and measures as text are no gaps."""
    box = [0, 0, 100, 90]
    plain = [{"n": 1, "paragraphs": [{"bbox": box, "hanging": True, "lines": [line(1), line(2)]}]}]
    numbered = [{"n": "2", "paragraphs": {"4": {"bbox": box, "lines": line(3)}, "6": {"bbox": json.dumps([0, 300, 100, 390]), "lines": [None, line(5, base="57")]}}}]
    body = {"size": [500, 900], "columns": plain}
    rows = [
        (1, datetime(2024, 1, 1), json.dumps(body)),
        (2, datetime(2024, 1, 1), json.dumps(body | {"columns": json.dumps(plain)})),
        (3, datetime(2024, 1, 1), json.dumps({"size": [500, 900], "columns": numbered})),
        (1, datetime(2024, 1, 2), "{not readable}"),
        (4, datetime(2024, 1, 1), " " + json.dumps({"columns": None})),
    ]
    spark.createDataFrame(rows, "leaf int, written_at timestamp, body string").write.parquet(f"{tmp_path}/page_json.parquet")
    got = sorted((r.leaf, r.n, r.para, r.line, r.hanging, r.y0, r.base, r.width, r.text) for r in L.page_lines(spark, str(tmp_path)).collect())
    assert got == [
        (1, 1, 1, 1, True, 10, 17, 500, "l1"), (1, 1, 1, 2, True, 20, 27, 500, "l2"), (2, 1, 1, 1, True, 10, 17, 500, "l1"), (2, 1, 1, 2, True, 20, 27, 500, "l2"),
        (3, 2, 4, 1, None, 30, 37, 500, "l3"), (3, 2, 6, 2, None, 50, 57, 500, "l5"),
    ]
    assert sum(r.words for r in L.words_in_lines(spark, str(tmp_path)).collect()) == 6
    assert sorted((r.o_id, r.n_id) for r in L.matched_boxes(spark, str(tmp_path)).where("leaf = 3").collect()) == [("2/4", "2/4"), ("2/6", "2/6")]
