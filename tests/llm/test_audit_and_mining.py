"""Source divergence, hard negatives and passage removal against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from textgraph.llm import divergence, negatives, passages
from textgraph.llm.divergence import source_divergence
from textgraph.llm.negatives import hard_negatives
from textgraph.llm.passages import remove_passages

DOCS = "doc_id bigint, text string, lang string, source string"


def _share(count, total):
    return 1 + 10**9 * (count + 1) // total


def brute_divergence(rows, min_docs=3, top=200):
    by, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        groups.add((lang, source))
        by[lang, source].update(terms)
        df[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        sources = [s for g, s in groups if g == lang]
        shares = {}
        for s in [*sources, None]:
            count = sum((by[lang, x] for x in sources), Counter()) if s is None else by[lang, s]
            total = sum(count[t] for t in kept) + len(kept)
            shares[s] = {t: _share(count[t], total) for t in kept}
        for s in sources:
            pairs = [(-sum((shares[s][t] - shares[o][t]) ** 2 // shares[o][t] for t in kept), o) for o in sources if o != s]
            q = shares[None]
            terms = [(-((p - q[t]) ** 2 // q[t]), t) for t, p in shares[s].items() if by[lang, s][t] and p > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms, key=lambda i: (i[0], i[1].encode()))[:top])):
                out |= {(lang, s, part, item, -v, r) for r, (v, item) in enumerate(items, 1)}
    return out


def _audit_rows():
    draw = random.Random(5)
    words = ["Apfel", "été", "zoo", "the", "a-b", "x1y", "中文", "Ünder", "rare" + "x" * 50] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(i, " ".join(draw.choices(words, k=draw.randrange(30))), draw.choice(["en", "de", None]), draw.choice(["a", "b", "é", None])) for i in range(60)]
    rows += [(1, "same row twice", "en", "a")] * 3 + [(None, None, None, None), (7, "", "xx", "alone"), (8, "!!", "xx", "other"), (9, "long " * 5000, "en", "b")]
    return rows


@pytest.mark.parametrize("held, together, piece", [(300_000, 1 << 16, 1 << 22), (7, 5, 64)])
def test_divergence_is_that_of_brute_force(held, together, piece, spark, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", together)
    assert divergence.term_counts(b"Ab cD ab" * 100) == Counter(re.findall(rb"[a-z]+", b"ab cd ab" * 100))
    rows = _audit_rows()
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS term", "'y' AS number", "1 AS n", "2 AS chunk", "'z' AS documents")
    found = source_divergence(docs, held=held, together=together).collect()
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == brute_divergence(rows)


def test_long_texts_are_counted_by_pieces(monkeypatch):
    text = ("Word other zé " * 999).encode()
    whole = divergence.term_counts(text)
    monkeypatch.setattr(divergence, "PIECE", 100)
    assert divergence.term_counts(text) == whole


def test_shares_are_exact_for_large_counts():
    counts, total = [10**14, 3, 10**14 - 7], 9 * 10**14
    assert divergence.share(np.array(counts), total).tolist() == [_share(c, total) for c in counts]


def brute_negatives(rows, window=(80, 100)):
    rows = [(i, l, np.floor(256 * np.array(v, float)).astype(int)) for i, v, l in rows if l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    size = max((len(v) for *_, v in rows), default=0)
    rows = [(i, l, np.r_[v, np.zeros(size - len(v), int)]) for i, l, v in rows]
    out, asked = [], {(i, l, tuple(v)) for i, l, v in rows if i is not None and i % 100 == 0}
    for i, l, v in asked:
        scored = sorted(((-int(np.dot(v, w)), j is None, j or 0, m) for j, m, w in rows))
        positives = [s for s in scored if s[3] == l and (s[1] or s[2] != i)][:5]
        for s, absent, j, _ in positives:
            inside = [n for n in scored if n[3] != l and window[0] * -s <= 100 * -n[0] <= window[1] * -s][:5]
            out += [(i, None if absent else j, r, None if n[1] else n[2], -s, -n[0]) for r, n in enumerate(inside, 1)]
    return Counter(out)


def _vectors(n, size, labels, seed):
    draw = np.random.default_rng(seed)
    rows = [(int(i) * 10, draw.normal(size=size).round(2).tolist(), int(draw.integers(labels))) for i in range(n)]
    rows += [(int(i) * 10, [0.5] * size, int(i % labels)) for i in range(n, n + 40)]  # one vector many times
    rows += [(100, [0.25] * size, 1)] * 2 + [(200, [0.75] * size, 1), (200, [0.7] * size, 0)]  # repeated rows and ids
    rows += [(None, [0.6] * size, 1), (None, [0.6] * size, 0), (3, None, 1), (4, [0.1, None], 1), (5, [float("nan")] * size, 1), (6, [float("inf")], 0)]
    return rows + [(7, [0.1] * size, None), (8, [], 1), (9, [0.9], 0), (400, [0.9, 0.8], 1)]


@pytest.mark.parametrize("n, size, leaf_rows, block_rows, fit_rows", [(300, 3, 8, 16, 200), (200, 12, 2048, 8192, 4096), (60, 2, 4, 3, 10)])
def test_hard_negatives_are_those_of_brute_force(n, size, leaf_rows, block_rows, fit_rows, spark):
    rows = _vectors(n, size, 4, n)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 AS leaf", "2 AS score", "3 AS rank", "4 AS query", "5 AS block")
    found = hard_negatives(frame, leaf_rows=leaf_rows, block_rows=block_rows, fit_rows=fit_rows).collect()
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]
    assert Counter(map(tuple, found)) == brute_negatives(exact)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert hard_negatives(empty).count() == 0


def test_subtrees_without_an_answer_are_passed_over():
    """On clustered rows a search looks into few leaves, and no answer lies in one passed over."""
    draw = np.random.default_rng(1)
    rows = (draw.integers(-300, 300, (30, 1, 8)) + draw.integers(-9, 9, (30, 40, 8))).reshape(-1, 8)
    tree = negatives.fit(rows, 40)
    leaf, ranges = negatives._placed(tree, rows)
    negatives.ranged(tree, ranges)
    anchors, scores = rows[::40], rows[::40] @ rows.T
    low, high = np.sort(scores, axis=1)[:, [-30]], np.full((len(anchors), 1), negatives.EVERY)
    looked = {(a, l) for l, some in negatives.surviving(tree, anchors, low, high) for a in some.tolist()}
    needed = {(a, int(leaf[i])) for a, i in zip(*np.nonzero(scores >= low))}
    assert needed <= looked and len(looked) < 0.5 * tree.leaves * len(anchors)


def test_wide_components_stay_exact():
    a = np.array([[1 << 23, 1 << 23, 1]], np.int32).repeat(2, axis=0)
    assert negatives.products(a, a).tolist() == [[(1 << 47) + 1] * 2] * 2
    wide = np.full((1, 1 << 10), 1 << 23, np.int32)
    assert negatives.products(wide, wide)[0, 0] == 1 << 56


def brute_passages(rows, length):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, words in split:
        for k in range(len(words) - length + 1) if i is not None else ():
            w = tuple(words[k : k + length])
            least[w] = min(least.get(w, i), i)
    out = Counter()
    for i, words in split:
        gone = set()
        for k in range(len(words) - length + 1) if i is not None else ():
            if least[tuple(words[k : k + length])] < i:
                gone |= set(range(k, k + length))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[i, len(words), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def _passage_rows(seed, vocabulary):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)]
    shared = [" ".join(draw.choices(words, k=30)) for _ in range(3)]
    rows = []
    for i in range(80):
        parts = [" ".join(draw.choices(words, k=draw.randrange(25))) for _ in range(2)]
        parts.insert(1, draw.choice([*shared, "", "again and again " * 12]))
        rows.append((draw.randrange(60), "\n".join(parts)))
    rows += [(70, rows[0][1])] * 4 + [(None, rows[0][1]), (None, shared[0]), (71, None), (72, ""), (73, " \t\n"), (74, shared[1] + " " + shared[1])]
    return rows + [(75, "long text " * 3000), (2, "long text " * 50), (76, "Déjà vu 🙂 " * 9), (1, "Déjà vu 🙂 " * 9)]


@pytest.mark.parametrize("seed, vocabulary, settings", [(1, 500, {}), (2, 3, {}), (3, 40, {"group": 3, "held_bytes": 200, "rows_together": 2}), (4, 4, {"group": 1, "rows_together": 1})])
def test_passages_are_those_of_brute_force(seed, vocabulary, settings, docs, monkeypatch):
    rows = _passage_rows(seed, vocabulary)
    frame = docs(rows).selectExpr("*", "'x' AS doc", "'x' AS digest", "'x' AS words", "'x' AS spans", "'x' AS packed", "1 AS h")
    for length in (5, 13):
        found = remove_passages(frame, length=length, **settings).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == brute_passages(rows, length)


def test_colliding_grams_are_told_apart_by_words(docs, monkeypatch):
    """Groups with one name for all grams give the same result: the tree compares words."""
    monkeypatch.setattr(passages, "_mixed", lambda x: x * np.uint64(0))
    rows = _passage_rows(6, 30)
    words, part = [b"a", b"b"] * 20, np.zeros(40, int)
    assert set(passages.runs(words, part, 13, 5)[0].tolist()) == {0}
    held = [(0, " ".join(t.split()).encode(), i, [i], [0], len(t.split()) - 12) for i, t in rows if i is not None and t and len(t.split()) >= 13]
    stream = passages._tree_rows(passages.STRETCH, sorted(held))
    gone = defaultdict(set)
    for batch in passages._trees(13, 1)(iter([stream])):
        for doc, _, first, last in zip(*(c.to_pylist() for c in batch.columns)):
            gone[doc] |= set(range(first, last + 1))
    least = {}
    for _, text, i, *_ in sorted(held):
        for w in zip(*(text.split()[k:] for k in range(13))):
            least[w] = min(i, least.get(w, i))
    expected = defaultdict(set)
    for _, text, i, *_ in held:
        expected[i] |= {k for k, w in enumerate(zip(*(text.split()[k:] for k in range(13)))) if least[w] < i}
    assert {d: g for d, g in gone.items() if g} == {d: g for d, g in expected.items() if g}


def test_a_subtree_is_its_leaves_and_the_depths_between_them():
    words = np.array([1, 2, 1, 2, 3, 1, 2, 1])
    start, group = np.array([0, 2, 5, 0]), np.array([0, 0, 0, 1])
    order, depth = passages.subtree(words, start, group, 3)
    assert [(group[i], words[start[i] : start[i] + 3].tolist()) for i in order] == [(0, [1, 2, 1]), (0, [1, 2, 1]), (0, [1, 2, 3]), (1, [1, 2, 1])]
    assert depth.tolist() == [3, 2, -1]


def test_parts_of_a_text_have_every_window_once():
    text = b" ".join(b"w%d" % i for i in range(500)) + b"   "
    for size, length in product((1, 7, 100, 10_000), (1, 2, 13)):
        windows = [(first + k, tuple(words[k : k + length])) for first, words in passages.pieces(text, length, size) for k in range(len(words) - length + 1)]
        every = text.split()
        assert windows == [(k, tuple(every[k : k + length])) for k in range(len(every) - length + 1)]
