from table_rows import as_dict
from pyspark.sql import functions as F

import pytest

from textgraph import at_positions, distinct_terms, doc_freq, line_count, part_positions, tokenize, vocab_positions, word_count
from textgraph.functions.text import lines_in, snippet


def test_alpha_tokens_keep_case_and_break_at_anything_but_ascii_letters(lines):
    tokens = tokenize(lines("Don't STOP, été 2x b_c", "", "été"), "alpha")
    assert as_dict(word_count(tokens), "term") == {"Don": 1, "t": 3, "STOP": 1, "x": 1, "b": 1, "c": 1}


def test_ws_tokens_drop_the_empty_one_of_a_leading_blank(lines):
    tokens = tokenize(lines("  Don't\tstop  stop ", "", "   ", "it's one"))
    assert as_dict(word_count(tokens), "term") == {"Don't": 1, "stop": 2, "it's one": 1}


def test_tokens_keep_the_other_columns(lines):
    assert tokenize(lines("a b")).columns == ["docid", "term"]


def test_doc_freq_counts_a_line_once(lines):
    tokens = tokenize(lines("a a b", "a A", "b a"), distinct=True)
    assert as_dict(doc_freq(tokens), "term") == {"a": 3, "b": 2, "A": 1}


def test_line_count_takes_blank_lines(lines):
    assert line_count(lines("a", "", " ")).first()["n"] == 3


def test_distinct_terms(lines):
    assert distinct_terms(tokenize(lines("a b a", "c A"))).first()["terms"] == 4


def test_vocab_positions_follow_byte_order(lines):
    counts = word_count(tokenize(lines("b Zed a zoo a é d")))
    found = as_dict(vocab_positions(counts), "position")
    assert found == {1: ("Zed", 1), -3: ("d", 1)}


def test_vocab_positions_of_small_vocabularies(lines):
    for text, expected in (("", set()), ("b", {1}), ("b a", {1}), ("b a c", {1, -3})):
        assert {r["position"] for r in vocab_positions(word_count(tokenize(lines(text)))).collect()} == expected


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_any_position_of_an_order(spark, parts):
    words = sorted({f"w{i * 7919 % 997}" for i in range(200)})
    rows = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "term string, cnt bigint")
    asked = [1, 2, 50, len(words), len(words) + 1, -1, -3, -len(words), -len(words) - 1]
    found = as_dict(at_positions(rows, "term", asked, parts), "position")
    assert found == {p: (words[p - 1 if p > 0 else p], (p - 1 if p > 0 else p) % len(words)) for p in asked if abs(p) <= len(words)}


def test_positions_in_each_output_file(spark):
    words = sorted(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(w,) for w in words], "term string")
    files = {}
    for r in rows.select("term", F.pmod(F.hash("term"), F.lit(4)).alias("part")).collect():
        files.setdefault(r.part, []).append(r.term)
    expected = {(part, p): sorted(terms)[p - 1 if p > 0 else p] for part, terms in files.items() for p in (1, -3)}
    assert as_dict(part_positions(rows, "term", parts=4), "part", "position") == expected


def test_lines_of_a_text(spark):
    texts = ["a\nb", "a\r\nb\rc", "", "\n", "a\n\n", "a\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(lines_in(F.col("t")).alias("l"))
    assert [r["l"] for r in df.collect()] == [["a", "b"], ["a", "b", "c"], [""], [""], ["a", ""], ["a"]]


def test_snippet_widths(spark):
    blank_at_80 = "x" * 79 + " " + "y" * 20
    texts = ["z" * n for n in (79, 80, 81, 82, 100)] + [blank_at_80, " \t" + "w" * 90, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(snippet(F.col("t")).alias("s"))
    assert [r["s"] for r in df.collect()] == [
        "z" * 79, "z" * 80, "z" * 81, "z" * 80, "z" * 80, "x" * 79, "w" * 78, None,
    ]
