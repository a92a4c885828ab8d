"""Votes over answers that were spelled loosely and revised."""

from datetime import datetime

from corpusloom.plans import readings as R


def test_latest_answers_in_one_spelling(spark, tmp_path):
    day = [datetime(2024, 1, k) for k in range(1, 9)]
    rows = [
        (1, "i", "reader-01", "text_d", day[0]), (2, "i", "reader 02", "D.", day[0]), (3, "i", "READER-03", "wit. A", day[0]),
        (4, "i", "reader-03", "d", day[1]), (5, "j", "reader-04", "none", day[0]), (6, "j", "reader-05", "x", day[0]), (7, "j", "reader-06", "b", day[3]),
        (8, "j", "reader-06", "?", day[4]), (9, "k", "reader-01", "b.", day[1]), (10, "k", "reader-01", "wit. B", day[2]), (11, "k", "reader-02", "a", day[1]), (12, "k", "reader-03", "a", day[1]),
    ]
    df = spark.createDataFrame([(*r, r[4]) for r in rows], "label_id long, item_id string, annotator string, label string, labelled_at timestamp, received_at timestamp")
    df.write.parquet(f"{tmp_path}/dispute_labels.parquet")
    assert {r.item_id: (r.label, r.votes) for r in R.majority_labels(spark, str(tmp_path)).collect()} == {"i": ("d", 3), "j": ("x", 2), "k": ("a", 2)}
    assert [(r.item_id, r.label) for r in R.unanimous_items(spark, str(tmp_path)).collect()] == [("i", "d")]
