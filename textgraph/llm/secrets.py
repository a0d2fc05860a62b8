"""Secret scans: fixed patterns, and assignment-aware lexing of names and literals.

A text is cut into tokens of source and configuration syntax: names, literals with escapes (quoted, triple-quoted or
bare), assignment signs and brackets. A parser takes name-literal pairs from them (``name = "literal"``,
``"name": 'literal'``, ``name: type = "literal"``, ``a = b = "literal"``, literals in brackets, calls and on following
lines, elements and attributes of markup). Constants are propagated to a fixed point: a name assigned from another
name, before or after, stands for what that holds, and a literal is scored by the most sensitive name that reaches it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .columns import doc_rows

# Fixed values of the contract: the kinds in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6

NAME = r"[A-Za-z_$][\w$]*(?:[.\-][\w$]+)*"
TOKEN = re.compile(
    r"""(?<![\w"'])(?P<prefix>[bBrRuUfF]{0,2})(?:"{3}(?P<triple>(?:\\.|(?!"{3}).)*+)"{3}|'{3}(?P<triple2>(?:\\.|(?!'{3}).)*+)'{3}"""
    r"""|"(?P<double>(?:\\.|[^"\\\n])*+)"|'(?P<single>(?:\\.|[^'\\\n])*+)'|`(?P<back>(?:\\.|[^`\\\n])*+)`)"""
    rf"""|(?P<name>{NAME})|(?P<sign>===?|!=|<=|>=|=>|:=|::|[=:])|(?P<open>[(\[{{])|(?P<close>[)\]}}])|(?P<line>\n)"""
    r"""|(?P<join>[,+])|(?P<type>[<>|?&*])|(?P<other>[^\s\w])""",
    re.S,
)
LITERALS = ("triple", "triple2", "double", "single", "back")
SIGNS = ("=", ":", ":=", "=>")
# What stands after a sign without quotes, to the next blank or mark that ends a value.
BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>]+""")
# Elements of markup, and keys told apart from their values.
ELEMENT = re.compile(rf"<(?P<name>{NAME})(?:\s[^<>]*)?>(?P<value>[^<>]+)</(?P=name)\s*>")
KEYED = re.compile(
    rf"""\b(?:key|name|id)["']?\s*[=:]\s*(["'])(?P<name>{NAME})\1\s*,?\s*["']?(?:value|val|content)["']?\s*[=:]\s*(?P<q>["'])(?P<value>(?:\\.|(?!(?P=q))[^\\\n])*+)(?P=q)"""
    rf"""|<key>\s*(?P<name2>{NAME})\s*</key>\s*<(?P<tag>\w+)>(?P<value2>[^<>]+)</(?P=tag)>"""
)
# How much a part of a name says that the value is secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9,
    "credentials": 0.9, "private": 0.6, "auth": 0.6, "key": 0.5, "access": 0.4, "signature": 0.4, "salt": 0.4, "session": 0.3,
}
# A literal is reported from this score on; its name tells at most 1, its letters at most 1.
THRESHOLD = 1.2
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
# A text without any of these words cannot have a sensitive name.
TELLING = re.compile("|".join(sorted({"api" if w == "apikey" else w for w in SENSITIVE})), re.I)


def name_score(name: str) -> float:
    """How sensitive a name is, by its parts (``dbPassword``, ``api_key``)."""
    parts = [p.lower() for p in PART.findall(name)]
    joined = [a + b for a, b in zip(parts, parts[1:])]
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in {*parts, *joined}))


def literal_score(literal: str) -> float:
    """How random a literal looks: bits per character against five, less for short ones and for plain words."""
    if len(literal) < 6:
        return 0.0
    n = len(literal)
    bits = -sum(k / n * math.log2(k / n) for k in Counter(literal).values())
    mixed = bool(re.search(r"[0-9]", literal)) and bool(re.search(r"[A-Za-z]", literal))
    return min(1.0, bits / 5) * min(1.0, n / 12) * (1.0 if mixed else 0.6)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns, leftmost and not overlapping per kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


class Pairs:
    """Name-literal pairs of a text: the places each name holds, and the names it is assigned from."""

    def __init__(self, text: str):
        self.text = text
        self.holds: dict[str, list[tuple[int, int]]] = {}
        self.links: dict[str, list[tuple[str, tuple[int, int]]]] = {}
        self.tokens = [(m.lastgroup, *m.span(m.lastgroup)) for m in TOKEN.finditer(text)]
        done = 0
        for i, (kind, start, end) in enumerate(self.tokens):
            if kind == "sign" and i >= done and i and text[start:end] in SIGNS:
                done = self._assigned(i)
        for m in ELEMENT.finditer(text):
            self._hold([m["name"]], m.span("value"))
        for m in KEYED.finditer(text):
            which = ("name", "value") if m["name"] else ("name2", "value2")
            self._hold([m[which[0]]], m.span(which[1]))

    def _hold(self, names: list[str], place: tuple[int, int]) -> None:
        start, end = place
        word = self.text[start:end]
        place = start + len(word) - len(word.lstrip()), end - len(word) + len(word.rstrip())
        for name in names if word.strip() else []:
            self.holds.setdefault(name, []).append(place)

    def _kind(self, i: int) -> str:
        return self.tokens[i][0] if i < len(self.tokens) else ""

    def _sign(self, i: int) -> str:
        return self.text[slice(*self.tokens[i][1:])] if self._kind(i) == "sign" else ""

    def _name(self, i: int) -> str:
        """The name that a token is, a quoted one included."""
        kind, start, end = self.tokens[i]
        word = self.text[start:end]
        return word if kind == "name" or kind in LITERALS and re.fullmatch(NAME, word) else ""

    def _assigned(self, sign: int) -> int:
        """The pairs of the assignment whose first sign is token ``sign``; the token to go on from."""
        names = [n for n in (self._name(sign - 1),) if n]
        if not names:
            return sign + 1
        at = sign + 1
        if self._sign(sign) == ":":  # a type up to a sign of its own on this line
            end = at
            while self._kind(end) in ("name", "type", "open", "close", "join"):
                end += 1
            if end > at and self._sign(end) == "=" and self._kind(at) == "name":
                names += [self._name(at)] if end == at + 1 else []  # or no type, but the name itself after other text
                at = end + 1
        while self._kind(at) == "name" and self._sign(at + 1) == "=":  # a further target
            names.append(self._name(at))
            at += 2
        depth = 0
        while True:
            kind = self._kind(at)
            if kind == "open" or kind == "name" and self._kind(at + 1) == "open" and not self._between(at, at + 1):
                depth += 1
                at += 1 if kind == "open" else 2
            elif kind == "line" and depth:
                at += 1
            elif kind == "other" and self.text[self.tokens[at][1]] == "\\" and self._kind(at + 1) == "line":
                at += 2
            else:
                break
        if kind in LITERALS:
            while self._kind(at) in LITERALS and not self._sign(at + 1) in SIGNS[1:]:
                self._hold(names, self.tokens[at][1:])
                at += 1
                # Literals that follow each other are one value, inside brackets also over lines and commas.
                while self._kind(at) == "join" and (depth or self._kind(at + 1) in LITERALS) or depth and self._kind(at) == "line":
                    at += 1
            return at
        if depth or not kind or kind == "line":
            return at if depth == 0 else max(sign + 1, at - 1)
        start = self.tokens[at][1]
        bare = BARE.match(self.text, start)
        if not bare or kind == "name" and self._sign(at + 1) in SIGNS and self.tokens[at + 1][1] < bare.end():
            return sign + 1  # a pair inside, such as of a nested mapping
        place = bare.span()
        if kind == "name" and bare.end() == self.tokens[at][2]:
            for name in names:
                self.links.setdefault(name, []).append((bare[0], place))
        else:
            self._hold(names, place)
        while at < len(self.tokens) and self.tokens[at][1] < bare.end():
            at += 1
        return at

    def _between(self, i: int, j: int) -> bool:
        return self.tokens[i][2] < self.tokens[j][1]

    def reached(self) -> dict[tuple[int, int], float]:
        """Places of literals, with the score of the most sensitive name that stands for them, over any links."""
        scores: dict[tuple[int, int], float] = {}
        seen: set[str] = set()
        for name in sorted({*self.holds, *self.links}, key=name_score, reverse=True):
            score, waiting = name_score(name), [name]
            while score and waiting:
                own = waiting.pop()
                if own in seen:
                    continue
                seen.add(own)
                for place in self.holds.get(own, []):
                    scores.setdefault(place, score)
                for other, place in self.links.get(own, []):
                    if other in self.holds or other in self.links:
                        waiting.append(other)
                    else:
                        scores.setdefault(place, score)  # no name of this text: a bare literal
        return scores


def literal_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, "literal")`` of literals that reach a sensitive name, in order, each once."""
    if not TELLING.search(text):
        return []
    return [
        (start, end, "literal")
        for (start, end), score in sorted(Pairs(text).reached().items())
        if score + literal_score(text[start:end]) >= THRESHOLD
    ]


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<doc_id, n_assign, n_access, n_hex, n_literal, base_sha256, spans>``, one row per document.

    ``spans`` is ``kind:start:end`` of all spans by start, then kind, in code points; ``base_sha256`` the digest of
    the same text of the pattern spans alone. A literal is added where no pattern span overlaps it. A null or empty
    text has no spans (an empty ``spans``, the digest of nothing). Repeated rows are told each for itself. Whole texts
    are lexed, names and literals of any length; only a text that has no word of a sensitive name anywhere is not.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column("text").to_pylist():
                base = base_spans(value)
                added, at = [], 0
                ends = []
                for start, end, _ in base:  # the farthest end of the spans so far, to find overlaps in one pass
                    ends.append(max(end, ends[-1] if ends else 0))
                for span in literal_spans(value):
                    while at < len(base) and base[at][0] < span[1]:
                        at += 1
                    if at == 0 or ends[at - 1] <= span[0]:
                        added.append(span)
                every = sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))
                kinds = Counter(kind for _, _, kind in every)
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((kinds["assign"], kinds["access"], kinds["hex"], kinds["literal"], digest, _joined(every)))
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds_ = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds_))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans"],
            )

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_literal bigint, base_sha256 string, spans string"
    return doc_rows(docs, doc_id, text).mapInArrow(scan, schema)
