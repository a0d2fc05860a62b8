"""Near copies, repeats, mixing, context trees and toxicity against brute force or on held-out rows."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textgraph.llm import mixing
from textgraph.llm.columns import fold
from textgraph.llm.components import components
from textgraph.llm.context_tree import context_tree_scores, log_gamma
from textgraph.llm.mixing import flight, mix, source_targets
from textgraph.llm.repeats import remove_repeats
from textgraph.llm.simhash import fingerprint, near_duplicates, near_links
from textgraph.llm.toxicity import marginals, pair_marginals, toxicity


def roots(nodes, linked) -> dict:
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fold_is_crc32_of_the_id_as_text(docs):
    found = docs([(i, "") for i in range(30)]).select("doc_id", fold("doc_id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 5 for r in found)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    expected = roots({n for ab in links for n in ab}, links)
    assert found == {n: r for n, r in expected.items() if n in found}
    assert all(n in found for a, b in links if a != b for n in (a, b))


def test_fingerprint_by_definition():
    words = "The Quick brown fox jumps The Quick brown".split()
    shingles = [" ".join(w.lower() for w in words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    expected = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert fingerprint(" ".join(words).encode()) == expected
    assert fingerprint(b" \n") == 0 and fingerprint(b"A b") == xxhash.xxh64_intdigest(b"a b", 42)


@pytest.mark.parametrize("group", [512, 3])
def test_near_links_connect_what_all_pairs_connect(spark, group):
    rng = random.Random(group)
    prints = set()
    for _ in range(60):
        p = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            prints.add(p)
            for _ in range(rng.randint(1, 4)):
                p ^= 1 << rng.randrange(64)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    linked = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    frame = spark.createDataFrame([(p,) for p in signed], "print bigint")
    found = [(r.a, r.b) for r in near_links(frame, group=group).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in found)
    assert roots(signed, found) == roots(signed, linked)


def test_near_duplicates(docs):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for i in range(30):
        base = [rng.choice(words) for _ in range(300)]
        for _ in range(rng.randint(1, 4)):
            base[rng.randrange(300)] = rng.choice(words)
            texts.append(" ".join(base))
    texts += ["", " ", "A b", "a B", None]
    rows = list(enumerate(texts, 10))
    prints = {i: fingerprint((t or "").encode()) for i, t in rows}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    expected = {i: (f"{prints[i]:016x}", root) for i, root in roots(prints, linked).items()}
    assert {r[0]: (r[1], r[2]) for r in near_duplicates(docs(rows)).collect()} == expected


def brute_repeats(texts, length):
    seen = Counter(t[s : s + length] for _, t in texts for s in range(len(t) - length + 1))
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                gone[s : s + length] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        rest = bytes(b for b, g in zip(t, gone) if not g)
        yield i, (len(t), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest())


@pytest.mark.parametrize("group", [1000, 2])
@pytest.mark.parametrize("letters", ["ab", "abcdefghijklé"])
def test_repeats_against_brute_force(docs, letters, group):
    rng = random.Random(len(letters))
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [text(n) for n in (40, 60, 90, 200)] + ["=" * 150]
    rows = [(i, "".join(rng.choice([text(rng.randint(1, 60)), rng.choice(shared), rng.choice(shared)[5:]]) for _ in range(8))) for i in range(40)]
    rows += [(100, rows[0][1]), (101, "short"), (102, None)]
    found = {r.doc_id: tuple(r)[1:5] for r in remove_repeats(docs(rows), length=40, k=12, group=group).collect()}
    assert found == dict(brute_repeats([(i, (t or "").encode()) for i, t in rows], 40))


def test_repeats_survive_hash_collisions(docs, monkeypatch):
    """With hashes that tell strings apart by their first byte only, contents decide the edges."""
    from textgraph.llm import repeats

    data = np.frombuffer(b"abcdXbcdaaaaabcdXbcd", np.uint8)
    monkeypatch.setattr(repeats.Hashes, "of", lambda self, start, stop: np.zeros(len(start), np.uint64))
    starts = np.array([0, 4, 12])
    assert repeats.repeated_windows(data, starts, np.zeros(3, np.int64), 8).tolist() == [True, False, True]


def morse(n: int, letters: str) -> str:
    """A string that every odd base hashes, modulo 2**64, like the one with its letters exchanged."""
    return "".join(letters[i.bit_count() & 1] for i in range(n))


def test_polynomial_collisions_are_told_apart_by_bytes(docs):
    """Two stretches of 2,048 letters with one polynomial hash stand between equal ones: they are no repeats of each other."""
    from textgraph.llm import repeats

    one, other = (np.frombuffer(morse(2048, x).encode(), np.uint8) for x in ("xy", "yx"))
    ends = np.array([0]), np.array([2048])
    assert repeats.Hashes(one).of(*ends) == repeats.Hashes(other).of(*ends)
    rng, length, k = random.Random(4), 2100, 1
    side = lambda n: "".join(rng.choice("abcdef") for _ in range(n))
    rows = [(10 * i + j, x + morse(2048, letters) + y) for i in range(6) for x, y in [(side(26), side(26))] for j, letters in enumerate(("xy", "yx"))]
    rows += [(100, rows[0][1]), (101, rows[0][1][:-1] + "z")]
    found = {r.doc_id: tuple(r)[1:5] for r in remove_repeats(docs(rows), length=length, k=k).collect()}
    assert found == dict(brute_repeats([(i, t.encode()) for i, t in rows], length))


def test_runs_survive_collisions_of_all_polynomial_hashes(monkeypatch):
    """With one hash for all strings, runs are equal only where their bytes are."""
    import pyarrow as pa

    from textgraph.llm import repeats

    monkeypatch.setattr(repeats.Hashes, "of", lambda self, start, stop: np.zeros(len(start), np.uint64))
    texts = ["abcdefghij", "klmnopqrst", "xxabcdefgh", "uvwxyzabcd"]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(4)), "digest": [0] * 4, "text": texts})
    told = [r for b in repeats._runs_of_texts(8, 3)(iter([batch])) for r in b.to_pylist()]
    equal = [(0, 0), (2, 2)]
    assert sorted((r["doc"], r["first"]) for r in told if r["kind"] == repeats.REPEAT) == equal
    # Texts of tasks of their own meet in a sorted stream.
    apart = [r for i in range(4) for b in repeats._runs_of_texts(8, 3)(iter([batch.slice(i, 1)])) for r in b.to_pylist()]
    assert {r["kind"] for r in apart} == {repeats.RUN}
    schema = pa.schema([*((c, pa.int64()) for c in repeats.RUN_RECORD), ("kind", pa.int32())])
    met = pa.RecordBatch.from_pylist(sorted(apart, key=lambda r: (r["h"], r["full"], r["rest"])), schema=schema)
    judged = [r for b in repeats._compared(iter(met.slice(i, 3) for i in range(0, len(met), 3))) for r in b.to_pylist()]
    assert sorted((r["doc"], r["first"]) for r in judged if r["kind"] == repeats.REPEAT) == equal


def test_repeats_of_texts_with_one_crc(docs):
    """Rows without an id, or with one id, whose different texts have the same crc32 keep spans of their own."""
    seen, pair = {}, None
    letters = random.Random(3)
    while pair is None:  # some 80,000 texts
        head = "%08x" % letters.getrandbits(32)
        crc = zlib.crc32(head.encode())
        pair = (seen[crc], head) if seen.get(crc, head) != head else None
        seen[crc] = head
    tail = "".join(chr(65 + i) for i in range(50))
    texts = [head + tail for head in pair]
    assert zlib.crc32(texts[0].encode()) == zlib.crc32(texts[1].encode())
    texts.append(pair[0] + tail[:20])
    for doc in (None, 7):
        rows = remove_repeats(docs([(doc, texts[0]), (doc, texts[1]), (1, texts[2])]), length=20, k=8).collect()
        expected = dict(brute_repeats([(i, t.encode()) for i, t in enumerate(texts)], 20))
        assert sorted(tuple(r)[1:5] for r in rows) == sorted(expected.values())


def test_windows_of_a_frequent_anchor_travel_once_a_task():
    """A passage between ever different neighbours: of its windows, one of a task goes on, and never with its bytes."""
    import pyarrow as pa

    from textgraph.llm import repeats

    rng, length, k, n = random.Random(5), 40, 12, 60
    letters = lambda m: bytes(rng.choice(b"abcdefgh") for _ in range(m))
    passage = letters(44)
    texts = [letters(29) + bytes([60 + i]) + passage + bytes([60 + i]) + letters(29) for i in range(n)]
    found = [repeats.runs(np.frombuffer(t, np.uint8), length, k) for t in texts]
    inside = [[j for j in range(len(f[0])) if f[2][j] <= 34 and f[3][j] >= 30] for f in found]
    edges = [[{"h": f[0][j], "frequent": True, **{c: int(f[i][j]) for c, i in (("first", 2), ("last", 3), ("anchor", 4))}} for j in js] for f, js in zip(found, inside)]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(n)), "digest": [0] * n, "text": [t.decode() for t in texts], "edges": edges})

    def rows(part):
        return [r for b in repeats._contexts(length, 1000)(iter([part])) for r in b.to_pylist()]

    told = rows(batch)
    windows = [r for r in told if r["kind"] == repeats.WINDOW]
    assert not any(r["bytes"] for r in told)
    assert max(Counter((r["h"], r["h2"]) for r in windows).values()) == 1
    covered = {(r["doc"], s) for r in told if r["kind"] == repeats.REPEAT for s in range(r["first"], r["last"] + 1)}
    assert covered == {(d, s) for d in range(n) for s in range(30, 35)}
    # Two tasks of one text each know nothing of each other's windows until these meet.
    apart = rows(batch.slice(0, 1)) + rows(batch.slice(1, 1))
    met = pa.RecordBatch.from_pylist(sorted(apart, key=lambda r: (r["kind"], r["h"], r["h2"])), schema=pa.schema(repeats.CONTEXT_TYPES))
    spans = [r for b in repeats._sorted_edges(length)(iter(met.slice(i, 7) for i in range(0, len(met), 7))) for r in b.to_pylist()]
    assert sorted((r["doc"], r["first"]) for r in spans) == [(d, s) for d in (0, 1) for s in range(30, 35)]


def plain_targets(sizes: dict) -> dict:
    order = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, total = {}, 1.5 * sum(sizes.values())
    open_ = set(order)
    while open_:
        left, level = total - sum(target.values()), sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / level >= 2 * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / level for s in open_}
        target |= {s: 2.0 * sizes[s] for s in above}
        open_ -= above
    return target


def test_source_targets(spark):
    rng = random.Random(6)
    sizes = {s: rng.randint(0, 1000) for s in ["a", "b", "é", "Z", "zz", "中", "q1", "q2", None]}
    frame = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size bigint, n bigint")
    found = {r.source: r.target for r in source_targets(frame).collect()}
    assert found == pytest.approx(plain_targets(sizes))


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(1)
    chance, size = rng.random(500), rng.integers(1, 3000, 500).astype(float)
    out = flight(chance, size, rng.random(500))
    assert ((out > 0) & (out < 1)).sum() <= 2 and out.min() >= 0 and out.max() <= 1
    assert out.sum() == pytest.approx(chance.sum()) and (out * size).sum() == pytest.approx((chance * size).sum())


def test_a_row_repeated_very_often_is_dealt_to_many_blocks(docs):
    """No block holds all copies of a row, and the mix is still near its target."""
    rows = docs([(1, "one two three", "a"), (2, "four five", "b")])
    many = rows.crossJoin(rows.sparkSession.range(5000)).drop("id")
    counted = mixing._each(many.groupBy(*many.columns).count().withColumnRenamed("count", "copies").withColumn("row", F.hash("text")))
    numbered = counted.groupBy("doc_id").agg(F.countDistinct("copy"), F.max("copy")).collect()
    assert set(map(tuple, numbered)) == {(1, 5000, 4999), (2, 5000, 4999)}
    mixed = mix(many, block=64)
    for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("size")).collect():
        assert r.n == 5000 and abs(r.taken - r.target) <= 12 * r["size"]


@pytest.mark.parametrize("block", [4096, 16])
def test_mix_meets_targets_and_repeats_itself(docs, block):
    rng = random.Random(7)
    rows = [(i, "w " * rng.choice([0, 1, 5, 40, 300]), rng.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(700)]
    first, again = ([tuple(r) for r in mix(docs(rows).repartition(n), block=block).sort("doc_id").collect()] for n in (2, 5))
    assert first == again
    totals, taken, targets = Counter(), Counter(), {}
    for _, source, size, source_size, target, times, words in first:
        assert words == times * size and words <= 2 * size
        totals[source] += size
        taken[source] += words
        targets[source] = (target, source_size)
    assert all(targets[s][1] == totals[s] for s in totals)
    assert {s: t for s, (t, _) in targets.items()} == pytest.approx(plain_targets(dict(totals)))
    assert all(abs(taken[s] - targets[s][0]) <= 300 for s in totals)


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 7.25, 300.5, 1e9])
    assert log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-12)


def plain_tree(train: list[bytes], depth: int):
    """Context-tree weighting by recursion over counts; gives the probability of a one."""
    counts = defaultdict(lambda: [0, 0])
    for text in train:
        padded = b"\xff" * depth + text + b"\xff"
        for i in range(depth, len(padded)):
            for d in range(depth + 1):
                for j in range(8):
                    counts[padded[i - d : i], d, (256 | padded[i]) >> (8 - j)][padded[i] >> (7 - j) & 1] += 1
    children = defaultdict(set)
    for context, d, node in counts:
        if d:
            children[context[1:], d - 1, node].add(context)

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    memo = {}

    def log_p(context, d, node):
        key = context, d, node
        if key not in memo:
            own = kt(*counts[key]) if key in counts else 0.0
            memo[key] = own if d == depth else np.logaddexp(own, below(context, d, node)) + math.log(0.5)
        return memo[key]

    def below(context, d, node):
        return sum(log_p(c, d + 1, node) for c in children.get((context, d, node), ()))

    def one(context, d, node):
        zeros, ones = counts.get((context[len(context) - d :], d, node), (0, 0))
        estimate = (ones + 0.5) / (zeros + ones + 1)
        if d == depth:
            return estimate
        at = context[len(context) - d :]
        weight = 1 / (1 + math.exp(below(at, d, node) - (kt(zeros, ones))))
        return weight * estimate + (1 - weight) * one(context, d + 1, node)

    def score(text):
        padded, total = b"\xff" * depth + text + b"\xff", 0.0
        for i in range(depth, len(padded)):
            for j in range(8):
                p = one(padded[i - depth : i], 0, (256 | padded[i]) >> (8 - j))
                total += math.log10(p if padded[i] >> (7 - j) & 1 else 1 - p)
        return total

    return score


@pytest.mark.parametrize("depth,block_bytes", [(2, 1 << 20), (3, 200), (7, 1 << 20)])
def test_context_tree_against_recursion(docs, depth, block_bytes):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["The", "cat", "é", "sat", "on", "mats", "x"]) for _ in range(rng.randint(0, 12)))) for i in range(30)]
    rows += [(90, None), (91, " lead and\ttrail \n")]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    lower = {i: "".join(c.lower() if c.isascii() else c for c in t or "") for i, t in rows}
    tokens = {i: [*t.split(), "\n"] for i, t in lower.items()}
    counts = Counter(w for i in lower if not held[i] for w in tokens[i])
    total, distinct = sum(counts.values()), len(counts)
    score = plain_tree([lower[i].encode() for i in lower if not held[i]], depth)
    found = {r.doc_id: r for r in context_tree_scores(docs(rows), depth=depth, block_bytes=block_bytes).collect()}
    for i, row in found.items():
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens[i])
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[i], len(tokens[i]), sum(w in counts for w in tokens[i]), total)
        assert row.base_score == pytest.approx(base) and row.score == pytest.approx(score(lower[i].encode()))


def test_a_repeated_row_is_dealt_to_many_blocks(spark, docs, tmp_path):
    """Rows of one id and text, from files or not, never fill one block."""
    from textgraph.llm.columns import placed_rows
    from textgraph.llm.context_tree import in_blocks

    rows = docs([(7, "one row again and again")] * 100_000)
    rows.repartition(3).write.parquet(str(tmp_path / "docs"))
    for each in (rows, spark.read.parquet(str(tmp_path / "docs"))):
        sizes = [r["count"] for r in in_blocks(placed_rows(each), 50).groupBy("block").count().collect()]
        assert len(sizes) == 50 and max(sizes) < 3 * 2_000


def test_a_repeated_row_is_learnt_and_scored_as_often_as_it_comes(docs):
    rows = [(2, "one row again and again")] * 12 + [(3, "another one"), (4, "")]
    counts = Counter(w for _, t in rows for w in [*t.split(), "\n"])
    assert all(zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows)
    score = plain_tree([t.encode() for _, t in rows], 2)
    found = context_tree_scores(docs(rows), depth=2, block_bytes=300).collect()
    assert Counter(r.doc_id for r in found) == {2: 12, 3: 1, 4: 1}
    assert {r.train_tokens for r in found} == {sum(counts.values())}
    for r in found:
        assert r.score == pytest.approx(score(dict(rows)[r.doc_id].encode()))


def test_marginals_against_enumeration():
    rng = np.random.default_rng(2)
    emission, transitions = rng.normal(size=(1, 5)), rng.normal(size=4)
    weights = {}
    for bits in range(32):
        states = [bits >> k & 1 for k in range(5)]
        weights[bits] = math.exp(sum(emission[0, k] * s for k, s in enumerate(states)) + sum(transitions[a * 2 + b] for a, b in zip(states, states[1:])))
    whole = sum(weights.values())
    expected = [sum(w for bits, w in weights.items() if bits >> k & 1) / whole for k in range(5)]
    padded = np.c_[emission, [[np.nan] * 3]].T
    found = marginals(padded, ~np.isnan(padded), tuple(transitions))
    assert found[:, 0] == pytest.approx([*expected, 0, 0, 0])
    again, pairs = pair_marginals(padded, ~np.isnan(padded), tuple(transitions))
    assert again == pytest.approx(found)
    both = {k: 0.0 for k in range(4)}
    for bits, w in weights.items():
        for k in range(4):
            both[2 * (bits >> k & 1) + (bits >> k + 1 & 1)] += w / whole
    assert pairs == pytest.approx([both[k] for k in range(4)])


def test_chains_of_a_text_are_one_chain():
    """Texts cut into chains have the marginals of uncut ones, however strong the links between neighbours."""
    rng = np.random.default_rng(8)
    for transitions in (tuple(rng.normal(size=4)), (6.0, -6.0, -6.0, 6.0), (-3.0, 5.0, 5.0, -3.0)):
        sizes = [1, 8, 9, 16, 67, 8, 640, 3]
        texts = [rng.normal(0, 12, n) for n in sizes]
        pieces = [np.pad(t, (0, -len(t) % 8), constant_values=np.nan).reshape(-1, 8) for t in texts]
        cut = np.concatenate(pieces).T
        first = np.concatenate([np.arange(len(p)) == 0 for p in pieces])
        found = marginals(cut, ~np.isnan(cut), transitions, first).T
        at = 0
        for text, own in zip(texts, pieces):
            whole = marginals(text[:, None], np.ones((len(text), 1), bool), transitions)[:, 0]
            assert found[at : at + len(own)].ravel()[: len(text)] == pytest.approx(whole, rel=1e-9, abs=1e-12)
            at += len(own)


def test_toxicity_learns_from_a_bounded_number_of_rows(spark, docs, monkeypatch):
    """Rows that share an id count against the bound like others, equal rows count once."""
    from textgraph.llm import toxicity as module

    monkeypatch.setattr(module, "SAMPLE_DOCS", 20)
    learnt, counts = [], module._class_counts
    monkeypatch.setattr(module, "_class_counts", lambda labelled: learnt.append(labelled.collect()) or counts(labelled))
    rows = [(2, f"clean words {i}") for i in range(50)] + [(3, "the same text")] * 50 + [(i, f"nasty words {i}") for i in range(100, 130)]
    labels = [(2, 0), (3, 0)] + [(i, 1) for i in range(100, 130)]
    found = toxicity(docs(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    assert len(found) == len(rows)
    of_label = Counter(r.toxic for r in learnt[0])
    assert 0 < of_label[0] <= 20 and 0 < of_label[1] <= 20
    assert sum(r.text == "the same text" for r in learnt[0]) <= 1


def test_toxicity_on_held_out_rows(spark, docs):
    rng = random.Random(9)
    plain, bad = [f"plain{i}" for i in range(200)], ["nasty", "vile", "beastlyer", "beastlyest"]
    rows, labels = [], []
    for i in range(600):
        words, toxic = [rng.choice(plain) for _ in range(rng.randint(3, 120))], i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    found = toxicity(docs(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    held = [r for r in found if r.held_out]
    assert len(held) > 80 and all(r.predicted == dict(labels)[r.doc_id] for r in held)
    told = []
    for r in found:
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert bool(spans) == bool(dict(labels)[r.doc_id])
        told += [dict(rows)[r.doc_id][int(a) : int(b)].strip(".") for a, b in spans]
    assert sum(w in bad for w in told) > 0.95 * len(told)
