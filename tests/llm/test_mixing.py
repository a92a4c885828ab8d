"""Flows against brute force, token counts against the tokenizer, and shares and repeats of a mixture."""

import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import mixing as M
from corpusloom.llm import tokens as T


def test_token_counts():
    import tiktoken

    count = T.Counter()
    encoding = T._encoding(T.VOCABULARY, T.PATTERN)
    assert isinstance(encoding, tiktoken.Encoding)
    for text in ["Мѣдный столпъ, 12 л.\n\n  two  spaces ", "it's <|endoftext|>", "x" * 3000, "", "Радꙋйсѧ"]:
        assert count(text) == len(encoding.encode_ordinary(text))
    assert count(None) == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=4, max_size=4), st.lists(st.integers(1, 6), min_size=2, max_size=2))
def test_cheapest_flow(rooms, costs):
    flow = M.Flow(4)  # 0 -> 1, 2 -> 3
    edges = [flow.edge(0, 1, rooms[0], costs[0]), flow.edge(0, 2, rooms[1], costs[1]), flow.edge(1, 3, rooms[2]), flow.edge(2, 3, rooms[3])]
    sent = flow.run(0, 3, 5)
    ways = [(a + b, a * costs[0] + b * costs[1]) for a, b in itertools.product(range(7), repeat=2) if a <= min(rooms[0], rooms[2]) and b <= min(rooms[1], rooms[3]) and a + b <= 5]
    most = max(w[0] for w in ways)
    assert sent == most and sum(flow.used(e) * c for e, c in zip(edges[:2], costs)) == min(c for n, c in ways if n == most)


def test_the_largest_total():
    total = M.largest_total({"a": 1000, "b": 100, "a|b": 50}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 2})
    assert 595 <= total <= 601  # b has (100 + 50) * 2 at most


@pytest.fixture(scope="module")
def docs(spark):
    rng, rows = random.Random(4), []
    for k in range(900):
        source = "big" if k % 3 else "small" if k % 2 else "middle"
        rows.append((k, source, " ".join(rng.choice(["слово", "дѣло", "page", "leaf"]) for _ in range(rng.randrange(1, 60))), "x"))
    rows += [(2000 + k, "small", rows[3 * k + 1][2], "x") for k in range(40)]  # texts of big that small holds too
    rows += [(3000, "big", None, "x"), (3001, "big", "", "x"), (3002, None, "слово", "x"), (3003, "other", "слово", "x"), (3004, "big", rows[1][2], "x")]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, tokens string")


def test_shares_and_repeats(spark, docs):
    targets = spark.createDataFrame([("big", 0.4, 1), ("small", 0.35, 3), ("middle", 0.25, 2), ("gone", 0.2, 4)], "source string, target_share double, max_repeats int")
    mixed = M.mix(docs, targets)
    got = {r.source: r for r in M.report(mixed, targets).collect()}
    for source, share in (("big", 0.4), ("small", 0.35), ("middle", 0.25)):
        assert abs(got[source].actual_share - share) < 0.01 and got[source].most_copies <= got[source].max_repeats
    assert got["gone"].tokens == 0
    rows = mixed.collect()
    assert len({(r.doc_id, r.source) for r in rows}) == len(rows) and all(r.tokens > 0 for r in rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, M.mix(docs.repartition(7), targets).collect()))


def test_nothing(spark, docs):
    targets = spark.createDataFrame([("big", None, 1), ("small", 0.3, None)], "source string, target_share double, max_repeats int")
    assert M.mix(docs, targets).count() == 0
    assert M.mix(docs.limit(0), targets).count() == 0
