"""Named noise and its repair, the automaton against plain edit distance, and untidy input."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import scanned as S

WORDS = """деревянный столпъ раздѣляетъ молитва темный колоколъ храмъ обыкновенно возносится дерево среди гробница читается
издревле вода островъ собираетъ подъ на и въ нетлѣнное сѣдало полотна мѣсто стадо бѣлое прежде рыба жертва""".split()
VOC = S.Vocabulary(dict.fromkeys(WORDS, 50), {"жаръ-птица": 9, "изъ-подъ": 9, "точь-въ-точь": 9})

CASES = [
    ("темный столпъ раз-\nдѣляетъ островъ", False, {"break"}, "темный столпъ раздѣляетъ островъ"),
    ("темный столпъ раздѣ­\nляетъ островъ", False, {"break"}, "темный столпъ раздѣляетъ островъ"),
    ("молитва чита¬ется обыкно- венно подъ деревянный", False, {"break"}, "молитва читается обыкновенно подъ деревянный"),
    ("колоколъ собира -\nетъ стадо", False, {"break"}, "колоколъ собираетъ стадо"),
    ("бѣлое полот на среди", False, {"break"}, "бѣлое полотна среди"),
    ("жаръ-\nптица, сѣверо- и юго, изъ-подъ", False, set(), "жаръ- птица, сѣверо- и юго, изъ-подъ"),
    ("островъ\nсобираетъ стадо", False, set(), "островъ собираетъ стадо"),
    ("молитва 8озн0сится прежде", False, {"misread"}, "молитва возносится прежде"),
    ("молигва возиосится прсжде", False, {"misread"}, "молитва возносится прежде"),
    ("темный гроблалирый колоколъ", False, set(), "темный гроблалирый колоколъ"),
    ("Крин0рый = темный колоколъ", True, set(), "Крин0рый = темный колоколъ"),
    ("дерево\n- 644 -\nсреди", False, {"pagenum"}, "дерево среди"),
    ("дерево\n7І4.\nсреди", False, {"pagenum"}, "дерево среди"),
    ("дерево [704] среди (Мр. 19, 7). 2) вода, въ 1410 г.", False, {"pagenum"}, "дерево среди (Мр. 19, 7). 2) вода, въ 1410 г."),
    ("возно-\n347 ЧОН—КЕР\nсится прежде", False, {"break", "header", "pagenum"}, "возносится прежде"),
    ("вода Свер. — Тро.\nпрежде", False, {"header"}, "вода прежде"),
    ("вода Мок— 12 Бург— прежде", False, {"header", "pagenum"}, "вода прежде"),
    ("вода Сл0варь старинн. речсній. прежде", False, {"header"}, "вода прежде"),
    ("вода СЛОВАРЬ СТАРИННЫХЪ РЕЧЕНІЙ.\nпрежде", False, {"header"}, "вода прежде"),
    ("", False, set(), ""),
    (None, True, set(), None),
]


@pytest.mark.parametrize("text, head, kinds, clean", CASES)
def test_cases(text, head, kinds, clean):
    assert S.noise(text, VOC, head) == kinds
    assert S.repaired(text, VOC, head) == clean


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("абсен", min_size=1, max_size=7), min_size=1, max_size=20, unique=True), st.text("абсенмл", min_size=1, max_size=8), st.integers(0, 2))
def test_the_automaton_finds_all_words_near(words, word, edits):
    trie = S.Trie(dict.fromkeys(words, 1))
    want = sorted((distance(S.fold(word), S.fold(w)), w) for w in words)
    assert trie.within(word, edits) == [x for x in want if x[0] <= edits]


def test_long_and_repeated_values(spark):
    long = " ".join(WORDS * 800)
    rows = [("1", long + " раз-\nдѣляетъ", "q"), ("1", long + " раз-\nдѣляетъ", "q"), ("2", None, "q"), ("3", "", "q"), (None, "молитва прсжде вода", "q")]
    df = spark.createDataFrame(rows, "id string, definition string, text string")
    values = S.value_table(df, "entries", "id", {"definition": False})
    got = {tuple(r) for r in S.found(values).collect()}
    assert got == {("entries", "1", "definition", "break"), ("entries", None, "definition", "misread")}
    fixed = [r.text for r in S.repair(values).collect()]
    assert sorted(map(len, fixed)) == [0, 19, len(long) + 11, len(long) + 11] and "молитва прежде вода" in fixed
    assert S.found(values.limit(0)).count() == 0
