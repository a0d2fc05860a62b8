import math
import random
import re
from collections import Counter
from functools import partial
from itertools import permutations
from pathlib import Path

import pytest
from plan_metrics import nodes
from table_rows import as_dict
from pyspark.sql import functions as F

from textgraph import cooccurrence, pair_counts, pmi, read_lines, stripes, top_pair, top_partners
from textgraph.functions.text import lines_in, pmi_score
from textgraph.operators import cooccur
from textgraph.plans.skew import lookup_join


def brute_pairs(texts, min_count):
    counts = Counter(p for t in texts for p in permutations(sorted(set(t.split())), 2))
    return {p: n for p, n in counts.items() if n >= min_count}


def brute_pmi(texts, min_count):
    df = Counter(w for t in texts for w in set(t.split()))
    return {
        (x, y): (n, math.log10(n * len(texts) / (df[x] * df[y]))) for (x, y), n in brute_pairs(texts, min_count).items()
    }


def corpus(seed, size=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)]
    texts = [" ".join(rng.choices(words, weights=range(25, 0, -1), k=rng.randint(0, 14))) for _ in range(size)]
    return texts + [texts[3]] * 20 + ["", "lone", "w1 w1"]


@pytest.mark.parametrize("block", [1, 2, 3, 256])
def test_pairs_equal_brute_force_for_every_block_size(lines, block):
    texts = corpus(1)
    assert as_dict(cooccurrence(lines(*texts), 3, block), "x", "y") == brute_pairs(texts, 3)


@pytest.mark.parametrize("block, entries, cells", [(1, 100, 10**6), (3, 2, 5), (256, 7, 40), (256, 100_000, 1)])
def test_stripes_are_counted_as_pairs_are(lines, monkeypatch, block, entries, cells):
    texts = corpus(8)
    monkeypatch.setitem(cooccur.COUNTING, "stripes", partial(cooccur._stripe_counts, entries=entries, cells=cells))
    assert as_dict(cooccurrence(lines(*texts), 3, block, by="stripes"), "x", "y") == brute_pairs(texts, 3)
    assert cooccurrence(lines("", "a"), 1, by="stripes").count() == 0


def test_stripes_move_less_than_pairs(spark, lines):
    texts = corpus(9, 3000)

    def moved(by):
        counts, _, _ = cooccur.COUNTING[by](lines(*texts), 10)
        read = nodes(spark, lambda: counts.count(), "Exchange")
        return sum(n["shuffle bytes written"] for n in read if "(x#" in n["what"] or "_groupingexpression#" in n["what"])

    assert 0 < moved("stripes") < moved("pairs")


def shuffled_bytes(spark):
    """Bytes of shuffle files that lie on disk."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(f.stat().st_size for d in folders for f in Path(d).rglob("shuffle_*.data"))


@pytest.mark.parametrize("by", ["pairs", "stripes"])
@pytest.mark.parametrize("block, words_sent", [(3, True), (256, False)])
def test_pairs_are_counted_in_passes_that_leave_no_shuffle_files(spark, lines, monkeypatch, by, block, words_sent):
    texts = corpus(10, 500)
    before = shuffled_bytes(spark)
    monkeypatch.setattr(cooccur, "FEW", 300, raising=False)
    monkeypatch.setattr(cooccur, "PASS_PAIRS", 0.1, raising=False)
    if not words_sent:
        monkeypatch.setattr(cooccur, "BROADCAST_BYTES", 0, raising=False)
    found = cooccurrence(lines(*texts), 3, block, by=by)
    assert shuffled_bytes(spark) <= before + 1000  # of sums alone
    assert as_dict(found, "x", "y") == brute_pairs(texts, 3)


def test_stripes_built_in_passes(lines, monkeypatch):
    texts = corpus(11, 30)
    monkeypatch.setattr(cooccur, "FEW_PARTNERS", 5)
    flat = stripes(cooccurrence(lines(*texts), 2), entries=4).select("x", F.explode("stripe").alias("y", "n"))
    assert as_dict(flat, "x", "y") == brute_pairs(texts, 2)


def test_all_pairs_without_support(lines):
    texts = corpus(2, 20)
    assert as_dict(cooccurrence(lines(*texts), 1), "x", "y") == brute_pairs(texts, 1)


def test_lines_need_no_id_and_one_id_may_repeat(spark, lines, tmp_path):
    texts = corpus(6)
    (tmp_path / "t.txt").write_text("\n".join(texts))
    assert as_dict(cooccurrence(read_lines(spark, str(tmp_path)), 3), "x", "y") == brute_pairs(texts, 3)
    same_id = lines(*texts).withColumn("docid", F.lit(1))
    assert as_dict(cooccurrence(same_id, 3), "x", "y") == brute_pairs(texts, 3)


def test_a_very_long_line(lines):
    common = [f"c{i}" for i in range(40)]
    texts = [" ".join([*(f"u{i}" for i in range(300_000)), *common])] + [" ".join(common)] * 9
    found = cooccurrence(lines(*texts), 10)
    assert found.count() == 40 * 39 and found.filter("n <> 10").count() == 0


def test_support_starts_at_ten(lines):
    texts = ["nine often"] * 9 + ["ten often"] * 10
    assert as_dict(cooccurrence(lines(*texts)), "x", "y") == {("often", "ten"): 10, ("ten", "often"): 10}


def test_pmi_equals_brute_force_and_is_symmetric(lines):
    texts = corpus(3)
    found, expected = as_dict(pmi(lines(*texts), 4), "x", "y"), brute_pmi(texts, 4)
    assert found.keys() == expected.keys()
    for (x, y), (n, score) in found.items():
        assert n == expected[x, y][0]
        assert score == pytest.approx(expected[x, y][1], abs=1e-12)
        assert found[y, x] == (n, score)


def test_hot_words_join_apart_from_the_others(lines, monkeypatch):
    texts = corpus(4)
    monkeypatch.setattr(cooccur, "lookup_join", partial(lookup_join, broadcast_bytes=0, head_keys=12))
    assert as_dict(cooccurrence(lines(*texts), 3), "x", "y") == brute_pairs(texts, 3)


def test_stripes_hold_the_pairs(lines):
    texts = corpus(5)
    pairs = cooccurrence(lines(*texts), 2)
    whole = stripes(pairs)
    assert whole.filter(F.col("shard") != 0).count() == 0
    small = stripes(pairs, entries=3)
    for found in (whole, small):
        flat = found.select("x", F.explode("stripe").alias("y", "n"))
        assert as_dict(flat, "x", "y") == brute_pairs(texts, 2)
    assert small.filter(F.col("shard") > 0).count() > 0


def test_pair_counts_and_top(lines):
    texts = ["m s a"] * 14 + ["c n"] * 12 + ["c x n"] * 10 + ["n q"] * 30
    scored = pmi(lines(*texts))
    expected = brute_pmi(texts, 10)
    assert pair_counts(scored).first().asDict() == {"ordered": len(expected), "unordered": len(expected) // 2}
    best = min((-s, x, y) for (x, y), (_, s) in expected.items() if x < y)
    assert (top_pair(scored).first()["x"], top_pair(scored).first()["y"]) == best[1:]
    partners = as_dict(top_partners(scored.drop("n"), ["c", "n", "absent"], 2), "x", "rank")
    ranked = {a: sorted((-s, y) for (x, y), (_, s) in expected.items() if x == a)[:2] for a in ("c", "n")}
    assert {k: y for k, (y, _) in partners.items()} == {
        (a, i + 1): y for a, best_two in ranked.items() for i, (_, y) in enumerate(best_two)
    }


def test_published_scores(spark):
    # Line counts of two words and of the pair, all lines, and the published score.
    rows = [
        (53, 265, 2378, 156215, 1.118541),
        (23, 276, 2378, 156215, 0.738329),
        (15, 124, 297, 156215, 1.803636),
        (12, 996, 124, 156215, 1.181223),
        (16, 2276, 124, 156215, 0.947248),
        (14, 14, 14, 156215, 4.047594),
    ]
    df = spark.createDataFrame(rows, "n bigint, a bigint, b bigint, lines bigint, expected double")
    scored = df.select(pmi_score(F.col("n"), F.col("a"), F.col("b"), F.col("lines")).alias("s"), "expected")
    for row in scored.collect():
        assert row["s"] == pytest.approx(row["expected"], abs=1e-4)


@pytest.mark.parametrize("by", ["pairs", "stripes"])
@pytest.mark.parametrize("block, cells, own_ranges, passes", [(256, 10**6, 1 << 14, 1), (2, 30, 4, 300), (1, 1, 1, 40)])
def test_pairs_do_not_move_one_by_one(spark, lines, monkeypatch, by, block, cells, own_ranges, passes):
    texts = corpus(12, 400) + ["w1 w2 w3 w4 rare"] * 3 + [" ".join(f"w{i}" for i in range(25))] * 5
    monkeypatch.setattr(cooccur, "OWN_RANGES", own_ranges, raising=False)
    monkeypatch.setattr(cooccur, "RANGES", 2, raising=False)
    monkeypatch.setattr(cooccur, "SENT_WORDS", 50, raising=False)
    if passes > 1:
        monkeypatch.setattr(cooccur, "FEW", passes)
        monkeypatch.setattr(cooccur, "PASS_PAIRS", 0)
    told = []
    count = {"pairs": cooccur._pair_counts, "stripes": cooccur._stripe_counts}[by]
    held = nodes(spark, lambda: told.append(count(lines(*texts), 3, block, cells=cells)[0].collect()), "Exchange")
    # Once lines are numbered, what moves is packed: never a row for a pair.
    assert any("(x#" in h["what"] for h in held) and not any("x#" in h["what"] and "y#" in h["what"] for h in held)
    expected = brute_pairs(texts, 3)
    assert sorted(n for _, _, n in told[0]) == sorted(n for (x, y), n in expected.items() if x < y)
    assert as_dict(cooccurrence(lines(*texts), 3, block, by=by), "x", "y") == expected


@pytest.mark.parametrize("by", ["pairs", "stripes"])
def test_words_that_are_not_broadcast_are_joined(lines, monkeypatch, by):
    texts = corpus(13)
    counts, words, _ = cooccur.COUNTING[by](lines(*texts), 3)
    monkeypatch.setattr(cooccur, "BROADCAST_BYTES", cooccur.measured_bytes(words) // 3)
    named = as_dict(cooccur._with_terms(counts, words).select("a", "b", "df_a", "df_b", "n"), "a", "b")
    expected, df = brute_pairs(texts, 3), Counter(w for t in texts for w in set(t.split()))
    assert {p: n for p, (*_, n) in named.items()} == {(a, b): expected[a, b] for a, b in named}
    assert all((x, y) == (df[a], df[b]) for (a, b), (x, y, _) in named.items()) and 2 * len(named) == len(expected)
    monkeypatch.setattr(cooccur, "_sent_dictionary", lambda *_: None)
    assert as_dict(cooccurrence(lines(*texts), 3, by=by), "x", "y") == expected


def test_lines_end_at_any_break(spark):
    texts = ["", "\n", "\r\n", "\r\r\n", "a\r\nb\rc\nd", "a\n\r", "\n\na", "a\r", None, "a b"]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", lines_in(F.col("t")).alias("l"))
    split = lambda t: None if t is None else re.split(r"\r\n|\r|\n", re.sub(r"(\r\n|\r|\n)\Z", "", t))
    assert as_dict(found, "i") == {i: split(t) for i, t in enumerate(texts)}
