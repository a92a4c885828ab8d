"""Scores on held-out wordings, disguises, harmless uses of the same words, and untidy documents."""

import os

import pytest

from corpusloom.llm import toxicity as T
from corpusloom.llm.toxic_seeds import HARMLESS, LIMIT, SEEDS

FILLER = [
    "The patient lamp often translates the river. A margin of the old page reads every leaf.",
    "Geen hymne bewaakt zo altijd als deze vroege koor. Een oude kaars vergelijkt zelden elke schrijver.",
    "Топоръ означаетъ старинную вдову. Покрывать соборъ издревле. Домъ напоминаетъ стихъ.",
    "Мѣдный столпъ нерѣдко стоитъ между храмами; пестрое блюдо хранитъ вѣру.",
]


@pytest.fixture(scope="module")
def model():
    fitted = T.fit([w for text in FILLER for w in T.windows(text)])
    fitted.threshold = 0.08  # as it is over the tables; four lines of text tell none
    return fitted


TOXIC = [
    ("You are nothing but a filthy liar and a coward.", "abuse"),
    ("SHUT YOUR M0UTH, YOU STUP1D IDIOT!!!", "abuse"),
    ("Чтобъ ты подохъ, вонючій п-р-и-д-у-р-о-къ.", "abuse"),
    ("Закрой пасть, тупая мpa​зь, сломаю тебѣ ноги.", "abuse"),
    ("I will come to your home at night with a rope and kill you.", "abuse"),
    ("Painters are worse than vermin and should be exterminated.", "hate"),
    ("Сосѣди хуже чѣмъ крысы, всѣхъ ихъ надо истреблять.", "hate"),
    ("Hij neukte haar de hele nacht van achteren.", "sexual"),
]
FINE = [*HARMLESS, *FILLER, "", None, "   ", "a", "x" * 30_000, "слово " * 5_000]


@pytest.mark.parametrize("text, category", TOXIC)
def test_toxic(model, text, category):
    got = model.of_text(f"{FILLER[0]} {text} {FILLER[2]}")
    assert got[""] >= model.threshold and max(T.CATEGORIES, key=lambda c: got.get(c, 0)) == category


@pytest.mark.parametrize("text", FINE, ids=range(len(FINE)))
def test_harmless(model, text):
    assert not set(model.of_text(text)) - {""}


def test_every_part_is_read(model):
    text = " ".join(FILLER * 200) + " You are nothing but a worthless idiot. " + " ".join(FILLER * 200)
    assert "abuse" in model.of_text(text)


def test_windows_cover_all_words():
    text = " ".join(f"слово{k}" for k in range(100))
    seen = {w for piece in T.windows(text) for w in piece.split()}
    assert seen == set(text.split())


def test_tables(spark, model):
    rows = [(k, t, "s1", "x") for k, t in enumerate(FILLER)]
    rows += [(10, TOXIC[0][0], "s2", "x"), (10, TOXIC[0][0], "s2", "x"), (11, None, None, "x"), (None, "", "s2", "x")]
    rows += [(12, f"{TOXIC[5][0]} {TOXIC[7][0]}", "s2", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, category string")
    got = {(r.doc_id, r.category) for r in T.found(docs, model).collect()}
    assert got == {(10, "abuse"), (12, "hate"), (12, "sexual")}
    rates = {r.source: r for r in T.rates(docs, model).collect()}
    assert rates["s2"].documents == 4 and rates["s2"].flagged == 3 and rates[None].flagged == 0
    assert T.found(docs.limit(0)).count() == 0 and T.found(docs).count() >= 1


def test_the_sample_is_not_of_the_tables(spark):
    """No seed of four words or more, in any filling, is a sentence of the documents or a part of one."""
    folder = "/root/testdata/sf0.01"
    if not os.path.exists(folder):
        pytest.skip("no tables")
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").where("text is not null").collect()]
    whole = "\n".join(T.plain(w) for t in texts for w in T.windows(t))
    seeds = [x for xs in (*SEEDS.values(), HARMLESS) for x in xs]
    assert not [x for x in seeds if len(x.split()) > 3 and T.plain(x).strip(" ,:—") in whole]
    assert all(len(xs) <= LIMIT for xs in SEEDS.values()) and len(HARMLESS) <= LIMIT


def test_threshold():
    assert T.threshold([-0.1] * 5000, [-0.2, 0.0, 0.05], [0.2, 0.3, 0.4]) == pytest.approx(0.06, abs=0.03)
    assert T.threshold([], [], []) == T.LEAST and T.threshold([0.1] * 100, [0.0], [0.5]) >= 0.1


def test_all_documents_are_counted(spark):
    """Each window of each document is in the ordinary counts, however many there are, and one more document changes them."""
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('слово', id, ' и столпъ') as text", "'s' as source")
    total = T._counted(T.encoded_documents(docs), 1, lambda ws: [T.counts(ws)])[0]
    assert total[-1] == 3000 and (total == T.counts([T.encoded(f"слово{k} и столпъ") for k in range(3000)])).all()


def test_features_of_windows_are_their_own():
    windows = [b"a bc", b"", b"slovo slovo", b"x", b"a longer window of words"]
    numbers, own = T.features(windows)
    for k, w in enumerate(windows):
        assert sorted(numbers[own == k]) == sorted(T.features([w])[0])
    assert T.emptiest({}) == T.LEAST and T.emptiest({k: 0 if 12 <= k < 18 else 5 for k in range(40)}) == pytest.approx(15 * T.STEP)


def test_fresh_wordings_at_the_calibrated_threshold():
    """Wordings that no seed holds are found at the threshold that the held-out seeds give, and ordinary text is not."""
    fresh = ["Those people breed like rabbits and must be stopped", "Чтобъ у тебя руки отсохли", "May you rot in a ditch", "Your mother should be ashamed of raising such a brainless brat"]
    fitted = T.fit([w for text in FILLER for w in T.windows(text)])
    assert all(set(fitted.of_text(text)) - {""} for text in fresh) and not any(set(fitted.of_text(text)) - {""} for text in FILLER)

#: Written after the kinds of words and nearly all of the sample, and not changed afterwards.
FRESH = {
    "abuse": [
        "Only a lying swine like you could ruin a page so badly.",
        "I know your street, and I will set fire to your roof while you sleep.",
        "Your whole family should be ashamed of you, you greedy old hag.",
        "May the plague take you and your cursed house.",
        "Заткни свою грязную пасть, старый осел.",
        "Я тебе шею сверну, подлая гадина.",
        "Хоть бы ты сдох под забором, лживая собака.",
        "Hou je smoel, luie dwaas, of ik breek je nek.",
        "Ik hoop dat je wegrot in een greppel, vuile leugenaar.",
        "Jouw moeder had je moeten wurgen bij je geboorte.",
    ],
    "hate": [
        "Lepers and beggars should be driven from the gate with whips.",
        "Never let a heathen touch your bread, they are filthier than swine.",
        "Women are too dull to read, keep them in the cellar.",
        "Drown the gypsies, every last one, before they breed.",
        "Еретиков в огонь, вместе с их щенками.",
        "Калеки только хлеб едят, лучше бы их утопить.",
        "Кочевники грязнее свиней, травить их собаками.",
        "Doven en kreupelen zijn nutteloos, men moest ze verdrinken.",
        "Ketters zijn luizen, vertrap ze allemaal.",
        "Vreemdelingen stelen en stinken, sla ze de stad uit.",
    ],
    "sexual": [
        "She spread her thighs and begged him to push his cock in deeper.",
        "He sucked her nipples while his fingers worked between her legs.",
        "I want to see you naked on your knees tonight, sucking me.",
        "They fucked on the floor until she came twice.",
        "Он стянул с нее юбку и ласкал ее голые бедра, пока она не кончила.",
        "Она сосала ему, стоя на коленях, голая.",
        "Хочу, чтобы ты голая села на меня и стонала.",
        "Ze trok haar slipje uit en liet zich likken.",
        "Hij neukte haar staande, zij kreunde van genot.",
        "Geile blote vrouw zoekt seks voor vannacht.",
    ],
}
FRESH_FINE = [
    "Thank you for the two sheets, your drawing of the margin is very fine.",
    "Will you be at home on Friday, and may I bring my children?",
    "Your hand is tired, so let your sister copy the rest.",
    "I hope you will forgive my late answer.",
    "The heretics were heard by the bishop and sent home.",
    "Foreigners bought salt and fish in the harbour.",
    "The deaf were taught to read with signs.",
    "She washed the wounded man and covered his naked legs.",
    "The calf sucked until it fell asleep.",
    "He shot two hares and hung them by the door.",
    "The word swine stands twice in this verse.",
    "My stupid pen has spoilt the whole line.",
    "Благодарю вас за два листа, рисунок ваш прекрасен.",
    "Будешь ли ты дома в пятницу?",
    "Простите, что отвечаю вам так поздно.",
    "Кочевники продавали у реки коней и шерсть.",
    "Глухих учили читать знаками.",
    "Теленок сосал корову и уснул.",
    "Она омыла раненого и укрыла его голые ноги.",
    "Слово осел стоит в стихе дважды.",
    "Глупый я, опять потерял очки.",
    "Dank u voor de twee bladen, uw tekening is mooi.",
    "Ben je vrijdag thuis en mag ik mijn kinderen meenemen?",
    "Het spijt me dat ik je zo laat antwoord.",
    "Vreemdelingen kochten zout en vis in de haven.",
    "Doven leerden lezen met gebaren.",
    "Het kalf zoog tot het in slaap viel.",
    "Hij schoot twee hazen en hing ze bij de deur.",
    "Het woord zwijn staat tweemaal in dit vers.",
    "Mijn domme pen heeft de regel bedorven.",
]


def test_fresh_wordings_of_each_category():
    """Of ten wordings a category that no seed holds eight are found and rightly named, and of thirty harmless ones, many of them
    in the second person, six at most are found, though next to no ordinary text is known here."""
    fitted = T.fit([w for text in FILLER for w in T.windows(text)])
    right = {c: sum(c in fitted.of_text(t) for t in texts) for c, texts in FRESH.items()}
    assert min(right.values()) >= 8 and sum(len(set(fitted.of_text(t)) - {""}) > 0 for t in FRESH_FINE) <= 6


def test_kinds_of_words():
    """A word is of the kind of its whole form, or else of its longest beginning; signs at its end are no part of it."""
    names = list(T.KINDS)

    def kinds(window):
        spaced = b" " + T.encoded(window) + b" "
        text = T.np.frombuffer(spaced, T.np.uint8)
        start = T.np.flatnonzero((text[1:] != 32) & (text[:-1] == 32)) + 1
        end = T.np.flatnonzero((text[:-1] != 32) & (text[1:] == 32)) + 1
        place = T.np.concatenate([[0], *[T.np.arange(e - s + 1) for s, e in zip(start, end)]])
        each = T.np.where(text != 32, (text.astype(T.np.uint64) + T.np.uint64(7)) * T._power(len(text))[place], T.np.uint64(0))
        total = T.np.concatenate([[T.np.uint64(0)], T.np.cumsum(each)])
        return [names[k - 1] if k else None for k in T._kinds_of(total, start, end)]

    assert kinds("you idiots книга придурокъ и хуже крысы") == ["you", "insult", None, "insult", None, None, "beast"]
    assert set(T.features([b"you idiot, go"])[0]) & set(T.features([b"jij hufter"])[0])
