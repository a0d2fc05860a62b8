"""Every operator and stage over empty tables, nulls, repeated rows and clashing columns."""

from __future__ import annotations

import pytest

import corpus_pipeline
from textgraph.llm import queries
from textgraph.llm.context_tree import context_tree_scores
from textgraph.llm.decontaminate import leaks
from textgraph.llm.exact_dedup import exact_duplicates
from textgraph.llm.licenses import license_spans
from textgraph.llm.divergence import source_divergence
from textgraph.llm.mixing import mix
from textgraph.llm.passages import remove_passages
from textgraph.llm.repeats import remove_repeats
from textgraph.llm.secrets import secret_spans
from textgraph.llm.simhash import near_duplicates
from textgraph.llm.token_counts import token_counts
from textgraph.llm.toxicity import toxicity

PIECES = [bytes([b]) for b in range(256)] + [b" one", b"same"]


def _labels(spark):
    clean = [(i, 0) for i in (1, 2, 3, 5, 6, 7, 8)]
    return spark.createDataFrame([*clean, (4, 1), (4, None), (None, None), (99, 1)], "doc_id bigint, toxic int")


def _benchmark(spark):
    return spark.createDataFrame([(1, "same text here"), (2, None), (3, ""), (None, "one")], "item_id bigint, text string")


PER_DOCUMENT = {
    "tokens": lambda d: token_counts(d, PIECES),
    "exact": exact_duplicates,
    "toxicity": lambda d: toxicity(d, _labels(d.sparkSession)),
    "repeats": remove_repeats,
    "mix": mix,
    "tree": lambda d: context_tree_scores(d, depth=3),
    "secrets": secret_spans,
    "simhash": near_duplicates,
    "passages": remove_passages,
}
PER_MATCH = {"licenses": license_spans, "leaks": lambda d: leaks(d, _benchmark(d.sparkSession)), "divergence": source_divergence}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_document(name, edge_docs):
    rows = PER_DOCUMENT[name](edge_docs).collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9]
    nine = [r for r in rows if r.doc_id == 9]
    assert name == "mix" or nine[0] == nine[1]


@pytest.mark.parametrize("name", [*PER_DOCUMENT, *PER_MATCH])
def test_empty_table(name, docs):
    assert ({**PER_DOCUMENT, **PER_MATCH}[name])(docs([])).count() == 0


def test_matches_of_edge_rows(edge_docs):
    assert license_spans(edge_docs).count() == 0
    assert {(r.doc_id, r.item_id, r.distance) for r in leaks(edge_docs, _benchmark(edge_docs.sparkSession)).collect()} == {(4, None, 0), (7, 1, 0), (8, 1, 0)}


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_keep_columns_and_clean_documents(stage, spark, edge_docs, docs, tmp_path):
    _labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "an item that no document holds")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    function = dict(corpus_pipeline.STAGES)[stage]
    out = function(spark, edge_docs, str(tmp_path))
    assert out.columns[: len(edge_docs.columns)] == edge_docs.columns
    ids = sorted(r.doc_id or 0 for r in out.collect())
    expected = {
        "exact_dedup": [0, 3, 4, 5, 6, 8, 9],
        "simhash_near_dedup": [0, 1, 4, 5, 6, 7, 9, 9],
    }.get(stage, [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9])
    if stage == "mix_sources":
        assert set(ids) <= set(expected)
    else:
        assert ids == expected
    assert function(spark, docs([]), str(tmp_path)).count() == 0


@pytest.mark.parametrize("shared", [None, 5])
def test_stages_reject_row_by_row(shared, spark, docs, tmp_path):
    """Of rows without an id, or of one id, a copy, a near copy and a leak go alone."""
    words = [" ".join(f"w{i}x{j}" for j in range(200)) for i in range(3)]
    item = "the quick benchmark item that nobody should ever learn by heart"
    clean = [(shared, words[0]), (shared, words[1])]
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def left(stage, *rows):
        return sorted(r.text for r in stage(spark, docs([*clean, *rows]), str(tmp_path)).collect())

    own = sorted(t for _, t in clean)
    assert left(corpus_pipeline.drop_copies, (1, words[2] + "  "), (shared, words[2])) == sorted([*own, words[2] + "  "])
    assert left(corpus_pipeline.drop_copies, (shared, words[2]), (1, words[2])) == sorted([*own, words[2]])
    assert left(corpus_pipeline.drop_near_copies, (1, words[2]), (shared, words[2])) == sorted([*own, words[2]])
    assert left(corpus_pipeline.drop_leaks, (shared, f"so {item} it is")) == own


def test_toxic_rows_go_alone(spark, docs, tmp_path):
    """A toxic row without an id takes no clean one along."""
    rows = [(i, "you are a stupid filthy moron " * 4 if i % 2 else f"a fine day number {i} with sun and tea " * 4) for i in range(200)]
    spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows += [(None, rows[1][1]), (None, rows[2][1])]
    out = corpus_pipeline.reject_toxic(spark, docs(rows), str(tmp_path)).collect()
    assert [r.text for r in out if r.doc_id is None] == [rows[2][1]]


def test_the_mix_decides_by_row(spark, docs, tmp_path):
    """Each row has its own decision and size, whatever its id."""
    rows = [(None, "word " * (1 + i % 7) + str(i), "ab"[i % 2]) for i in range(60)]
    out = corpus_pipeline.mix_sources(spark, docs(rows), str(tmp_path)).collect()
    assert len(out) > 1 and all(r["size"] == len(r.text.split()) and r.taken == r.times * r["size"] for r in out)


def test_every_dealt_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
