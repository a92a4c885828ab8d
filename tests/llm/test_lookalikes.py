"""Clean forms: named cases, fixed points, and the fast path against the full one."""

import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import lookalikes as L

CASES = [
    ("Бленнaнблавъ", "Бленнанблавъ"),
    ("cвиceнcтeлый", "свисенстелый"),
    ("To​​ждє", "Тождє"),
    ("Codex aldinus", "Codex aldinus"),
    ("Сodex", "Codex"),
    ("Λύχνος ἢ λαμπάς", "Λύχνος ἢ λαμπάς"),
    ("нилый", "нилый"),
    ("Вонстирцамъ　", "Вонстирцамъ"),
    ("слово‑дѣло", "слово-дѣло"),
    ("а，б （в）", "а,б (в)"),
    ("сло́во", "сло́во"),
    ("сло́во", "сло́во"),
    ("слóво", "сло́во"),
    ("cop", "сор"),
    ("Ɐ-7", "Ɐ-7"),
    ("", ""),
    (" ​ ", ""),
    (None, None),
]


@pytest.mark.parametrize("dirty, clean", CASES)
def test_cases(dirty, clean):
    assert L.clean(dirty) == clean


ALPHABET = "абвгѣсеоржacepoxyABCEλόοκρʜᴛо­​  -‑,，()ий́́ａｐ"


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from(ALPHABET), max_size=14))
def test_fixed_point_and_fast_path(text):
    once = L.clean(text)
    assert L.clean(once) == once and unicodedata.is_normalized("NFC", once)
    if re.match(L.SURE, text):
        assert once == text


def test_found_rows(spark):
    rows = [("1", "Cлово", "слово", None), ("1", "Cлово", "слово", None), ("2", "", None, None), (None, "а­", "x" * 50_000, "q")]
    df = spark.createDataFrame(rows, "id string, headword string, value string, clean string")
    got = L.dirty_values(df, "entries", "id", ["headword", "value"]).collect()
    assert sorted((r.row_key or "", r.field, r.clean) for r in got) == [("", "headword", "а"), ("1", "headword", "Слово")] or len(got) == 3
    assert L.dirty_values(df.limit(0), "entries", "id", ["headword"]).count() == 0
    again = df.select(L.clean_column("headword").alias("c")).collect()
    assert [r.c for r in again] == ["Слово", "Слово", "", "а"]
