"""Token counts by a linear longest-match automaton over a public tokenizer's vocabulary.

The vocabulary is a trie over bytes. Every node knows where matching goes on when its next byte has no edge (its
failure link) and how many pieces are complete by then, so a word is measured in one pass over its bytes and no
piece is ever built. A word is blank-separated and starts with the blank's piece mark, as in byte-level vocabularies.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .columns import doc_rows, text_bytes

# Distinct words whose lengths a task remembers before it starts anew.
REMEMBERED = 500_000
# Words of a document measured at a time.
SLICE = 1 << 16


def byte_level_pieces(path: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary file (``tokenizers`` JSON): printable stand-ins turned back into bytes."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    stands_for = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    return [bytes(stands_for[c] for c in piece) for piece in vocabulary if all(c in stands_for for c in piece)]


class LongestMatch:
    """Trie, failure links and popped-piece counts of a vocabulary; ``count(word)`` is its greedy number of pieces."""

    def __init__(self, pieces: Iterable[bytes]):
        edges: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                if byte not in edges[node]:
                    edges[node][byte] = len(edges)
                    edges.append({})
                    final.append(False)
                node = edges[node][byte]
            final[node] = node != 0
        fail: list[int] = [-1] * len(edges)
        popped = [0] * len(edges)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for byte, node in edges[parent].items():
                queue.append(node)
                if final[node]:
                    fail[node], popped[node] = 0, 1
                    continue
                at, pieces_done = fail[parent], popped[parent]
                while at >= 0 and byte not in edges[at]:
                    pieces_done += popped[at]
                    at = fail[at]
                if at >= 0:
                    fail[node], popped[node] = edges[at][byte], pieces_done
        self.edges, self.fail, self.popped = edges, fail, popped

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match; a word that cannot be matched to its end is one unknown piece."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node = pieces = 0
        for byte in word:
            while byte not in edges[node]:
                if fail[node] < 0:
                    return 1
                pieces += popped[node]
                node = fail[node]
            node = edges[node][byte]
        while node:
            if fail[node] < 0:
                return 1
            pieces += popped[node]
            node = fail[node]
        return pieces


class _Remembered(dict):
    """Lengths of the words met so far."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self.automaton.count(b" " + word)
        if len(word) < 64:
            self[word] = found
        return found


def token_counts(docs: DataFrame, pieces: list[bytes], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<doc_id, n_bytes, n_words, n_tokens>``, one row per document.

    A null or blank text has no words and no tokens. Rows with the same id are counted row by row; texts of any
    length are cut into words once and measured slice by slice. ``pieces`` (a vocabulary, so bounded) is broadcast.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(pieces)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_of = _Remembered(LongestMatch(vocabulary.value)).__getitem__
        for batch in batches:
            sizes, words, tokens = [], [], []
            for value in text_bytes(batch.column("text")):
                found = value.split()
                sizes.append(len(value))
                words.append(len(found))
                tokens.append(sum(sum(map(length_of, found[i : i + SLICE])) for i in range(0, len(found), SLICE)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_words", "n_tokens"],
            )

    return doc_rows(docs, doc_id, text).mapInArrow(measure, "doc_id bigint, n_bytes bigint, n_words bigint, n_tokens bigint")
