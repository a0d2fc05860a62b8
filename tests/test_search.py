import random

import pytest
from table_rows import as_dict

from textgraph import bool_and, bool_or, bool_search, build_postings, fetch_lines

TEXTS = ["white rose", "red rose rose", "white red", "pluck", "white rose pluck", "And AND", ""]


def answers(df):
    found = {}
    for row in df.collect():
        found.setdefault(row["query_id"], []).append(row["docid"])
    return found


def test_and_or(lines):
    p = build_postings(lines(*TEXTS))
    assert sorted(r["docid"] for r in bool_and(p, "white", "rose").collect()) == [0, 4]
    assert sorted(r["docid"] for r in bool_or(p, "red", "pluck").collect()) == [1, 2, 3, 4]
    assert bool_and(p, "white", "rose").collect() == bool_and(p, "rose", "white").collect()
    assert bool_or(p, "red", "absent").collect() == bool_or(p, "absent", "red").collect()


def test_queries_of_one_batch_are_apart(lines):
    p = build_postings(lines(*TEXTS))
    found = answers(
        bool_search(
            p,
            {
                "lone": "rose",
                "unknown": "absent",
                "no": "absent rose AND",
                "nested": "white red OR rose AND pluck AND",
                "case": "White",
                "left over": "red white rose AND",
                "twice": "rose rose AND",
            },
        )
    )
    assert found == {"lone": [0, 1, 4], "nested": [4], "left over": [0, 4], "twice": [0, 1, 4]}


@pytest.mark.parametrize("query", ["white AND", "OR", "a b AND OR", ""])
def test_too_few_operands(lines, query):
    with pytest.raises(ValueError):
        bool_search(build_postings(lines(*TEXTS)), {"q": query})


def test_random_queries_against_sets_with_more_terms_than_a_flag_word_holds(lines):
    rng = random.Random(7)
    words = [f"t{i}" for i in range(150)]
    texts = [" ".join(rng.sample(words, rng.randint(0, 60))) for _ in range(60)]
    holding = {w: {i for i, t in enumerate(texts) if w in t.split()} for w in words}
    queries, expected = {}, {}
    for q in range(12):
        tokens, stack = [], []
        for w in rng.sample(words, rng.choice([1, 3, 10, 140])):
            tokens.append(w)
            stack.append(holding[w])
            while len(stack) > 1 and rng.random() < 0.6:
                op = rng.choice(["AND", "OR"])
                a, b = stack.pop(), stack.pop()
                tokens.append(op)
                stack.append(a & b if op == "AND" else a | b)
        queries[f"q{q}"], expected[f"q{q}"] = " ".join(tokens), sorted(stack[-1])
    found = answers(bool_search(build_postings(lines(*texts)), queries))
    assert found == {q: ids for q, ids in expected.items() if ids}


def test_fetch_whole_lines_and_snippets(lines):
    collection = lines(*TEXTS, "rose " + "x" * 100)
    hits = bool_search(build_postings(collection), {"q": "rose"})
    assert as_dict(fetch_lines(hits, collection), "query_id", "docid") == {
        ("q", i): line for i, line in enumerate([*TEXTS, "rose " + "x" * 100]) if "rose" in line.split()
    }
    assert as_dict(fetch_lines(hits, collection, "snippet"), "query_id", "docid")["q", 7] == "rose " + "x" * 75


def test_thousands_of_queries_share_few_conditions(lines):
    words = [f"t{i}" for i in range(100)]
    texts = [" ".join(w for j, w in enumerate(words) if (i * 7 + j * 3) % 5 == 0) for i in range(40)]
    holding = {w: {i for i, t in enumerate(texts) if w in t.split()} for w in words}
    queries, expected = {}, {}
    for q in range(5000):
        a, b = words[q % 100], words[q // 100]
        queries[str(q)] = f"{a} {b} {'AND' if q % 2 else 'OR'}"
        expected[str(q)] = sorted(holding[a] & holding[b] if q % 2 else holding[a] | holding[b])
    found = answers(bool_search(build_postings(lines(*texts)), queries))
    assert found == {q: ids for q, ids in expected.items() if ids}


def test_no_query_is_an_error(lines):
    with pytest.raises(ValueError, match="no query"):
        bool_search(build_postings(lines(*TEXTS)), {})
