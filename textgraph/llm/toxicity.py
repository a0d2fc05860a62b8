"""Toxicity by a linear-chain conditional random field over words.

Labels are given by document. What is learnt is learnt from a bounded sample of labelled training documents, so that
no texts but the sample's are moved. Which words of a toxic document are toxic is settled by counts: a word is, when
it or its beginning is far likelier in toxic documents. On chains labelled so a two-state field (clean, toxic) is
trained by its exact gradient. Forward-backward marginals of the words, over every whole text, give a document's
offending words and, calibrated on the sample, its score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable
from .columns import WORD, doc_rows, fold, text_bytes

# Words of a chain; a text is one chain after the other. It is learnt from chains, but read as a whole.
CHAIN = 64
# Features of a word: itself and its first letters, hashed.
BUCKETS = 1 << 20
PREFIXES = (4, 6)
# A word is toxic from this log-odds on, seen in so many toxic training documents.
LEAST_ODDS, LEAST_DOCS = 2.5, 5
# The bounds of the sample: documents (rows that share id and text count once) of either label, and chains with and
# without toxic words among theirs.
SAMPLE_DOCS, SAMPLE_CHAINS = 10_000, 2_000
# Documents of every fifth id hash are never learnt from.
FOLDS = 5
# Words that a task remembers, and words whose marginals are computed together.
REMEMBERED, TOGETHER = 400_000, 1 << 18

_STRIP = ".,;:!?\"'()[]{}«»¿¡"
_WORD = re.compile(WORD)


def word_features(word: bytes) -> tuple[int, ...]:
    """Buckets of the lower-cased word without punctuation around it, and of its beginnings."""
    bare = word.decode("utf-8", "replace").lower().strip(_STRIP)
    named = [f"w{bare}", *(f"{k}{bare[:k]}" for k in PREFIXES)]
    return tuple(crc32(n.encode()) % BUCKETS for n in named)


class _Words(dict):
    """Row numbers of the words met so far in a growing table of values computed once a word."""

    def __init__(self, value_of, width: int, kind):
        super().__init__()
        self.value_of, self.table, self.used = value_of, np.zeros((1024, width), kind), 0

    def __missing__(self, word: bytes) -> int:
        if self.used == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[self.used] = self.value_of(word)
        self[word] = self.used
        self.used += 1
        return self.used - 1

    def values(self, words: list[bytes]) -> np.ndarray:
        if self.used >= REMEMBERED:
            self.clear()
            self.used = 0
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.table[rows]


@dataclass
class Field:
    """A trained field: log-odds and weights by feature bucket, the weight of the odds, bias and transitions."""

    odds: np.ndarray
    weights: np.ndarray
    odds_weight: float = 0.0
    bias: float = 0.0
    transitions: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)
    calibration: tuple[float, float, float] = (-20.0, 0.0, 0.0)

    def emission(self, features: np.ndarray) -> np.ndarray:
        """How much words by themselves speak for the toxic state, by the features of each."""
        return self.bias + self.odds_weight * self.odds[features].max(axis=1, initial=0.0) + self.weights[features].sum(axis=1)


def _composed(maps: Iterator[tuple]) -> tuple[np.ndarray, ...]:
    """Maps x -> (p x + q) / (r x + s), done one after the other, as one; each number is an array over the chains."""
    a, b, c, d = 1.0, 0.0, 0.0, 1.0
    for k, (p, q, r, s) in enumerate(maps):
        a, b, c, d = p * a + q * c, p * b + q * d, r * a + s * c, r * b + s * d
        if k % 8 == 7:  # only the numbers' proportions count
            size = a + b + c + d
            a, b, c, d = a / size, b / size, c / size, d / size
    return a, b, c, d


def _over_borders(local: np.ndarray, real: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The forward ratio that comes into each chain, and the backward one at its last word.

    A chain as a whole is one map from the ratio at its one end to that at the other, so a text's chains are passed
    one after the other, all texts together, without looking at their words again.
    """
    j00, j01, j10, j11 = transitions
    into, after = np.zeros(len(first)), np.ones(len(first))
    order = np.arange(len(first))
    level = order - np.maximum.accumulate(np.where(first, order, 0))
    if not level.any():
        return into, after
    by_level = np.split(np.argsort(level, kind="stable"), np.cumsum(np.bincount(level))[:-1])
    opening = (np.where(first, 0.0, local[0] * j11), np.where(first, local[0], local[0] * j01), np.where(first, 0.0, j10), np.where(first, 1.0, j00))
    a, b, c, d = _composed(opening if t == 0 else (local[t] * j11, local[t] * j01, j10, j00) for t in range(len(local)))
    for chains in by_level[1:]:
        k = chains - 1
        into[chains] = (a[k] * into[k] + b[k]) / (c[k] * into[k] + d[k])

    def back(t: int) -> tuple[np.ndarray, ...]:
        there = real[t + 1]
        return np.where(there, local[t + 1] * j11, 0.0), np.where(there, j10, 1.0), np.where(there, local[t + 1] * j01, 0.0), np.where(there, j00, 1.0)

    a, b, c, d = _composed(back(t) for t in range(len(local) - 2, -1, -1))
    for k in reversed(by_level[1:]):
        onward = local[0, k] * (a[k] * after[k] + b[k]) / (c[k] * after[k] + d[k])
        after[k - 1] = (j10 + j11 * onward) / (j00 + j01 * onward)
    return into, after


def _ratios(emission: np.ndarray, real: np.ndarray, transitions: tuple, first: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The words' own ratios of toxic against clean, and the forward and backward ones; rows are steps, columns chains.

    ``first`` marks the chains that begin a text; the others go on where the chain before them ends.
    """
    j00, j01, j10, j11 = np.exp(np.array(transitions))
    local = np.exp(np.clip(np.where(real, emission, 0.0), -30, 30))
    forward, backward = np.empty_like(local), np.ones_like(local)
    forward[0] = local[0]
    if first is not None:
        into, backward[-1] = _over_borders(local, real, first, np.exp(np.array(transitions)))
        forward[0] = np.where(first, local[0], local[0] * (j01 + j11 * into) / (j00 + j10 * into))
    for t in range(1, len(local)):
        forward[t] = local[t] * (j01 + j11 * forward[t - 1]) / (j00 + j10 * forward[t - 1])
    for t in range(len(local) - 2, -1, -1):  # padding, at a chain's end, has nothing to say
        onward = local[t + 1] * backward[t + 1]
        backward[t] = np.where(real[t + 1], (j10 + j11 * onward) / (j00 + j01 * onward), 1.0)
    return local, forward, backward


def marginals(emission: np.ndarray, real: np.ndarray, transitions: tuple, first: np.ndarray | None = None) -> np.ndarray:
    """Each word's probability of the toxic state; rows are steps, columns chains, ``real`` marks the words.

    Chains not marked by ``first`` go on with the text of the one before; without it each is a text.
    """
    _, forward, backward = _ratios(emission, real, transitions, first)
    odds = forward * backward
    return np.where(real, odds / (1 + odds), 0.0)


def pair_marginals(emission: np.ndarray, real: np.ndarray, transitions: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The words' marginals, and the expected number of each pair of neighbouring states (00, 01, 10, 11)."""
    local, forward, backward = _ratios(emission, real, transitions)
    odds = forward * backward
    onward, before = local[1:] * backward[1:], forward[:-1]
    j00, j01, j10, j11 = np.exp(np.array(transitions))
    shares = [np.full_like(onward, j00), j01 * onward, j10 * before, j11 * before * onward]
    whole = shares[0] + shares[1] + shares[2] + shares[3]
    pairs = np.array([(share / whole)[real[1:]].sum() for share in shares])
    return np.where(real, odds / (1 + odds), 0.0), pairs


def _chains(values: np.ndarray) -> np.ndarray:
    """A text's word values as rows of CHAIN, the last one filled up with NaN."""
    rows = -(-len(values) // CHAIN)
    padded = np.full((rows * CHAIN, *values.shape[1:]), np.nan)
    padded[: len(values)] = values
    return padded.reshape(rows, CHAIN, *values.shape[1:])


def train_field(odds: np.ndarray, features: np.ndarray, real: np.ndarray, toxic: np.ndarray, rounds: int = 60) -> Field:
    """Maximum-likelihood training: observed minus expected counts, by Adagrad with a small ridge.

    ``features`` (steps, chains, kinds), ``real`` and ``toxic`` (steps, chains) are the labelled chains.
    """
    field = Field(odds, np.zeros(BUCKETS))
    if not features.size:
        return field
    strength = odds[features].max(axis=2)
    seen_buckets, local = np.unique(features, return_inverse=True)
    local = local.reshape(features.shape)
    weights, steps_w = np.zeros(len(seen_buckets)), np.full(len(seen_buckets), 1e-6)
    theta, steps = np.zeros(6), np.full(6, 1e-6)  # weight of the odds, bias, four transitions
    used = local[real]
    seen = np.bincount((toxic[:-1].astype(int) * 2 + toxic[1:].astype(int))[real[1:]], minlength=4)
    for _ in range(rounds):
        emission = theta[1] + theta[0] * strength + weights[local].sum(axis=2)
        expected, pairs = pair_marginals(emission, real, tuple(theta[2:]))
        miss = np.where(real, toxic - expected, 0.0)
        slope = np.r_[(miss * strength).sum(), miss.sum(), seen - pairs] - 0.1 * theta
        steps += slope**2
        theta = theta + slope / np.sqrt(steps) * 0.3
        slope_w = np.bincount(used.ravel(), np.repeat(miss[real], used.shape[1]), len(weights)) - 0.1 * weights
        steps_w += slope_w**2
        weights = weights + slope_w / np.sqrt(steps_w) * 0.05
    field.weights[seen_buckets] = weights
    field.odds_weight, field.bias, field.transitions = float(theta[0]), float(theta[1]), tuple(map(float, theta[2:]))
    return field


def calibrate(most: np.ndarray, expected: np.ndarray, toxic: np.ndarray, share: np.ndarray, rounds: int = 60) -> tuple[float, float, float]:
    """A logistic model of a document's label by its highest marginal and its expected number of offending words.

    ``share`` is how many labelled documents a sampled one stands for.
    """
    x = np.stack([np.ones_like(most), most, np.log1p(expected)], axis=1)
    theta, ridge = np.zeros(3), np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(rounds):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (share * (toxic - p)) - ridge @ theta
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + ridge
        theta = theta + np.linalg.solve(bend, slope) * min(1.0, 5 / (1e-9 + np.abs(np.linalg.solve(bend, slope)).max()))
    return tuple(map(float, theta))


def _class_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Sampled documents of each class that hold a feature, by bucket; documents of each class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int64)
        table = _Words(word_features, 1 + len(PREFIXES), np.int64)
        for batch in batches:
            for value, toxic in zip(text_bytes(batch.column("text")), batch.column("toxic").to_pylist()):
                found = np.unique(table.values(list(set(value.split()))))
                sums[toxic, found] += 1
        used = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in (used, sums[0, used], sums[1, used])], names=["f", "clean", "toxic"])

    counts = labelled.mapInArrow(count, "f bigint, clean bigint, toxic bigint").groupBy("f").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    found = counts.toArrow()  # BUCKETS rows at most
    clean, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    clean[found["f"].to_numpy()], toxic[found["f"].to_numpy()] = found["clean"].to_numpy(), found["toxic"].to_numpy()
    of_class = dict(labelled.groupBy("toxic").count().collect())
    return clean, toxic, of_class.get(0, 0), of_class.get(1, 0)


def log_odds(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """How much likelier a feature is in toxic documents; 0 where it is not likelier or seen too seldom to tell."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return np.where((toxic >= LEAST_DOCS) & (odds > 0), odds, 0.0)


def _sampled_chains(labelled: DataFrame, odds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, words and labels of at most SAMPLE_CHAINS chains with toxic words and as many without, by hash."""
    shared = labelled.sparkSession.sparkContext.broadcast(odds)
    width = 1 + len(PREFIXES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strength = shared.value
        table = _Words(word_features, width, np.int64)
        for batch in batches:
            rows = []
            for doc, value, toxic in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "toxic"))):
                words = value.encode().split()
                features = table.values(words)
                marked = toxic * (strength[features].max(axis=1, initial=0.0) >= LEAST_ODDS)
                for i in range(0, len(words), CHAIN):
                    marks = marked[i : i + CHAIN]
                    packed = features[i : i + CHAIN].astype(np.int32).tobytes()
                    rows.append((bool(marks.any()), crc32(f"{doc}:{i}".encode()), packed, marks.astype(np.int8).tobytes()))
            columns = zip(*rows) if rows else [[]] * 4
            kinds = (pa.bool_(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["any", "key", "features", "marks"])

    chains = labelled.mapInArrow(cut, "any boolean, key bigint, features binary, marks binary")
    taken = []
    for kind in (True, False):
        taken += chains.filter(F.col("any") == kind).orderBy("key", "features").limit(SAMPLE_CHAINS).toArrow().to_pylist()
    features = np.zeros((CHAIN, len(taken), width), np.int32)
    real, marks = np.zeros((CHAIN, len(taken)), bool), np.zeros((CHAIN, len(taken)), bool)
    for i, row in enumerate(taken):
        n = len(row["marks"])
        features[:n, i] = np.frombuffer(row["features"], np.int32).reshape(n, width)
        real[:n, i], marks[:n, i] = True, np.frombuffer(row["marks"], np.int8) > 0
    return features, real, marks


def _read(docs: DataFrame, field: Field, with_spans: bool) -> DataFrame:
    """``<doc_id, most, expected, spans>``: highest marginal, expected number of offending words, offending places."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        table = _Words(word_features, 1 + len(PREFIXES), np.int32)

        def told(ids: list, texts: list[bytes], emissions: list[np.ndarray]) -> pa.RecordBatch:
            pieces = [_chains(e) for e in emissions]
            together = np.ascontiguousarray(np.concatenate(pieces).T)
            first = np.concatenate([np.arange(len(own)) == 0 for own in pieces])
            found = np.ascontiguousarray(marginals(together, ~np.isnan(together), field.transitions, first).T)
            most, expected, spans, at = [], [], [], 0
            for value, own, emission in zip(texts, pieces, emissions):
                p = found[at : at + len(own)].ravel()[: len(emission)]
                at += len(own)
                most.append(float(p.max(initial=0.0)))
                offending = p >= 0.5
                expected.append(float(p[offending].sum()))  # of a long text, many faint suspicions are none
                bad = set(np.flatnonzero(offending).tolist()) if with_spans else ()
                places = [m.span() for k, m in enumerate(_WORD.finditer(value.decode())) if k in bad] if bad else []
                spans.append(",".join(f"{a}:{b}" for a, b in places))
            arrays = [pa.array(ids, pa.int64()), pa.array(most, pa.float64()), pa.array(expected, pa.float64()), pa.array(spans, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "most", "expected", "spans"])

        for batch in batches:
            ids, texts, emissions, held = [], [], [], 0
            for doc, value in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text"))):
                words = value.split()
                ids.append(doc)
                texts.append(value)
                emissions.append(field.emission(table.values(words)))
                held += len(words)
                if held >= TOGETHER:
                    yield told(ids, texts, emissions)
                    ids, texts, emissions, held = [], [], [], 0
            if ids:
                yield told(ids, texts, emissions)

    return docs.mapInArrow(read, "doc_id bigint, most double, expected double, spans string")


def toxicity(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", told: str | None = None
) -> DataFrame:
    """``<doc_id, held_out, score, predicted, spans>``, one row per document.

    ``score`` is the probability of the label 1, ``spans`` the offending words as ``start:end`` in code points.
    Learnt are only rows whose crc32(doc_id) mod 5 is not 0 (the others are ``held_out``); ids and labels are never
    inputs of a score. A document labelled twice is toxic if any label says so; null labels and labels of unknown
    documents are left out. Empty and null texts score as a text without toxic words. Without any toxic training
    document nothing is learnt, and all scores are near 0. ``told`` names a column to tell, as ``doc_id``, in place of
    the id that labels and ``held_out`` go by: a number for each row tells rows apart that share an id.
    """
    rows = doc_rows(docs, doc_id, text)
    known = labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(toxic).cast("int").alias("toxic")).filter("toxic IN (0, 1)")
    known = known.filter(fold("doc_id", FOLDS) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = durable(known.join(rows.select("doc_id"), "doc_id", "left_semi"), "known")
    of_label = dict(known.groupBy("toxic").count().collect())
    order = F.xxhash64("doc_id"), "doc_id"
    taken = [r for t in (0, 1) for r in known.filter(F.col("toxic") == t).orderBy(*order).limit(SAMPLE_DOCS).collect()]
    sample = docs.sparkSession.createDataFrame([tuple(r) for r in taken], "doc_id bigint, toxic int")
    # Ids may stand on any number of rows: equal rows count once, and of the others as many are taken as of ids.
    texts = rows.join(F.broadcast(sample), "doc_id").withColumn("print", F.xxhash64("text"))
    prints = durable(texts.select("doc_id", "toxic", "print").distinct(), "prints")
    taken = [r for t in (0, 1) for r in prints.filter(F.col("toxic") == t).orderBy(*order, "print").limit(SAMPLE_DOCS).collect()]
    chosen = docs.sparkSession.createDataFrame([(r["doc_id"], r["print"]) for r in taken], "doc_id bigint, print bigint")
    labelled = texts.join(F.broadcast(chosen), ["doc_id", "print"]).dropDuplicates(["doc_id", "print"]).drop("print")
    labelled = durable(labelled, "labelled")
    clean, bad, n_clean, n_bad = _class_counts(labelled)
    odds = log_odds(clean, bad, n_clean, n_bad)
    field = train_field(odds, *_sampled_chains(labelled, odds))
    if n_bad:
        judged = _read(labelled.select("doc_id", "text"), field, False).join(F.broadcast(sample), "doc_id")
        columns = judged.select("most", "expected", "toxic").toArrow()
        most, expected, label = (columns[c].to_numpy().astype(float) for c in ("most", "expected", "toxic"))
        share = np.where(label == 1, of_label.get(1, 0) / n_bad, of_label.get(0, 0) / max(1, n_clean))
        field.calibration = calibrate(most, expected, label, share)
    a, b, c = map(F.lit, field.calibration)
    score = 1 / (1 + F.exp(-(a + b * F.col("most") + c * F.log1p("expected"))))
    scored = _read(doc_rows(docs, told or doc_id, text), field, True).withColumn("score", score)
    if told:
        ids = docs.select(F.col(told).cast("bigint").alias("doc_id"), (fold(doc_id, FOLDS) == 0).alias("held_out"))
        scored = scored.join(ids, "doc_id")
    else:
        scored = scored.withColumn("held_out", fold("doc_id", FOLDS) == 0)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
