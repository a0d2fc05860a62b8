from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """A documents table of ``(doc_id, text)`` or ``(doc_id, text, source)`` rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def edge_docs(docs):
    """Nulls, blanks, a very long text, ties, a repeated row, and extra columns named like the operators' own."""
    long = "Some words of a very long text, told again and again. " * 4000
    frame = docs(
        [
            (1, None, None),
            (2, "", "a"),
            (3, " \t\n", "a"),
            (4, "one", "b"),
            (5, "Déjà vu, naïve café ünïcode 中文 🙂", "b"),
            (6, long, "b"),
            (7, "same text here", "c"),
            (8, "same  text here", "c"),
            (9, "repeated row", "c"),
            (9, "repeated row", "c"),
            (None, "no id", None),
        ]
    )
    clashing = "size score kept block h recipe spans print key chance bytes gram word n value held_out toxic rank row row_file row_at __row __file __at __number _metadata group place".split()
    for name in clashing:
        frame = frame.selectExpr("*", f"'x' AS {name}")
    return frame
