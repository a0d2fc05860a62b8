import random
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from plan_metrics import nodes
from table_rows import as_dict
from pyspark.sql import functions as F

from textgraph import (
    build_postings,
    decode_gaps,
    encode_gaps,
    forward_index,
    gap_lists,
    lookup_postings,
    postings_lists,
    postings_map,
    save_block_index,
    save_lookup,
    save_postings,
    save_wide_table,
    term_df,
    tf_histogram,
    with_shard,
    write_index,
)
from textgraph.operators import postings as operator
from textgraph.sinks import index as sink


def documents(spark, seed=1):
    rng = random.Random(seed)
    rows, docid = [], 0
    for _ in range(80):
        docid += rng.choice([1, 2, 7, 40, 3_000_000_000])
        rows.append((docid, " ".join(rng.choices("the the the of to cat dog emu".split(), k=rng.randint(0, 9)))))
    return spark.createDataFrame(rows, "docid bigint, line string"), rows


def brute(rows):
    return {(t, d): n for d, line in rows for t, n in Counter(line.split()).items()}


def test_postings_and_frequencies(spark):
    df, rows = documents(spark)
    p, expected = build_postings(df), brute(rows)
    assert as_dict(p, "term", "docid") == expected
    assert as_dict(term_df(p), "term") == Counter(t for t, _ in expected)
    histogram = Counter((t, n) for (t, _), n in expected.items() if t in ("the", "cat"))
    assert as_dict(tf_histogram(p, ["the", "cat", "absent"]), "term", "tf") == histogram
    assert as_dict(lookup_postings(p, ["emu", "absent"]), "term", "docid") == {
        k: n for k, n in expected.items() if k[0] == "emu"
    }


def test_index_of_one_term_has_its_own_frequency(lines):
    assert as_dict(term_df(build_postings(lines("solo solo"))), "term") == {"solo": 1}


@pytest.mark.parametrize("span, fan", [(1, 1 << 16), (4, 1 << 12), (64, 1 << 10), (1 << 40, 1 << 16)])
def test_blocks_of_any_span_hold_all_postings(spark, span, fan):
    df, rows = documents(spark, 2)
    p, expected = build_postings(df).cache(), brute(rows)
    lists = postings_lists(p, span)
    assert lists.filter(F.size("postings") != F.col("block_df")).count() == 0
    whole = Counter(t for t, _ in expected)
    assert all(row["df"] == whole[row["term"]] for row in lists.collect())
    for row in lists.collect():
        ids = [e["docid"] for e in row["postings"]]
        assert ids == sorted(ids) and {i // span for i in ids} == {row["block"]}
    flat = lists.select("term", F.explode("postings").alias("e")).select("term", "e.docid", "e.tf")
    assert as_dict(flat, "term", "docid") == expected
    cells = postings_map(p, span).select("term", F.explode("cells").alias("docid", "tf"))
    assert as_dict(cells, "term", "docid") == expected
    encoded = encode_gaps(p, span, fan)
    assert as_dict(decode_gaps(encoded), "term", "docid") == expected
    gaps = {}
    for row in sorted(gap_lists(encoded).collect(), key=lambda r: (r["term"], r["block"])):
        assert row["block_df"] == len(row["gaps"]) and row["df"] == whole[row["term"]]
        gaps.setdefault(row["term"], []).extend(e["gap"] for e in row["gaps"])
    assert gaps.keys() == {t for t, _ in expected}
    for term, found in gaps.items():
        ids = sorted(d for t, d in expected if t == term)
        assert found == [b - a for a, b in zip([0, *ids], ids)]
    p.unpersist()


def test_docids_beyond_double_precision(spark):
    big = (1 << 62) + 255
    p = spark.createDataFrame([("a", big, 1), ("a", big + 1, 1)], "term string, docid bigint, tf bigint")
    assert sorted(r["block"] for r in postings_lists(p, 256).collect()) == [big // 256, big // 256 + 1]
    assert sorted(r["gap"] for r in encode_gaps(p, 256).collect()) == [1, big]


def test_forward_index(spark):
    df, rows = documents(spark, 3)
    flat = forward_index(build_postings(df)).select("docid", F.explode("terms").alias("term", "tf"))
    assert as_dict(flat, "term", "docid") == brute(rows)


def test_written_index_is_sorted_split_and_whole(spark, tmp_path):
    df, rows = documents(spark, 4)
    path = str(tmp_path / "index")
    for _ in range(2):
        write_index(build_postings(df), path, 4)
    back = spark.read.parquet(path)
    assert as_dict(back, "term", "docid") == brute(rows)
    files = [pq.read_table(f).to_pylist() for f in Path(path).glob("*.parquet")]
    keys = [[(row["term"], row["docid"]) for row in rows_of_file] for rows_of_file in files]
    assert len(keys) == 4
    assert all(k == sorted(k) for k in keys)
    assert sum("the" in {term for term, _ in k} for k in keys) > 1
    assert as_dict(lookup_postings(back, ["dog"]), "term", "docid") == {
        k: n for k, n in brute(rows).items() if k[0] == "dog"
    }


def test_sharded_table(spark, tmp_path):
    df, rows = documents(spark, 5)
    path = str(tmp_path / "table")
    save_postings(build_postings(df), path, buckets=3, shards=4)
    back = spark.read.parquet(path)
    assert as_dict(back.drop("shard"), "term", "docid") == brute(rows)
    assert back.filter(F.col("shard") != F.pmod("docid", F.lit(4))).count() == 0
    save_postings(build_postings(df), path, buckets=3)
    assert spark.read.parquet(path).columns == ["term", "docid", "tf"]
    assert with_shard(build_postings(df), 4).select("shard").distinct().count() <= 4


def test_documents_of_one_id_or_none_are_counted_together(spark):
    rows = [(1, "a b a"), (2, "b"), (1, "a  c"), (None, "a"), (None, "a b"), (3, None), (4, " ")]
    found = build_postings(spark.createDataFrame(rows, "docid bigint, line string"))
    expected = {("a", 1): 3, ("b", 1): 1, ("c", 1): 1, ("b", 2): 1, ("a", None): 2, ("b", None): 1}
    assert as_dict(found, "term", "docid") == expected


def test_terms_of_single_documents_are_not_shuffled(spark):
    df, rows = documents(spark, 6)
    found = build_postings(df)
    assert "Exchange hash" not in found._jdf.queryExecution().executedPlan().toString()
    assert as_dict(found, "term", "docid") == brute(rows)


def test_gaps_in_passes_by_term(spark, monkeypatch):
    df, rows = documents(spark, 7)
    monkeypatch.setattr(operator, "FEW", 20)
    encoded = encode_gaps(build_postings(df), 64, 4)
    assert encoded.settled  # written pass by pass
    assert as_dict(decode_gaps(encoded), "term", "docid") == brute(rows)
    whole = Counter(t for t, _ in brute(rows))
    lists = gap_lists(encoded).collect()
    assert all(r["df"] == whole[r["term"]] and r["block_df"] == len(r["gaps"]) for r in lists)
    assert sum(len(r["gaps"]) for r in lists) == len(brute(rows))


def test_a_large_index_has_more_files_than_asked_for(spark, monkeypatch, tmp_path):
    df, rows = documents(spark, 8)
    monkeypatch.setattr(sink, "TASK_ROWS", 20)
    least = len(brute(rows)) // 20
    write_index(build_postings(df), str(tmp_path / "index"), 2)
    save_lookup(build_postings(df), str(tmp_path / "lookup"), 2, 2)
    save_block_index(build_postings(df), str(tmp_path / "blocks"), 2, 1 << 40)
    save_wide_table(build_postings(df), "wide_of_many", 2, 16, str(tmp_path / "wide"))
    assert as_dict(spark.table("wide_of_many").select("term", F.explode("cells").alias("docid", "tf")), "term", "docid") == brute(rows)
    spark.sql("DROP TABLE wide_of_many")
    for name in ("index", "lookup", "blocks/postings"):
        assert as_dict(spark.read.parquet(str(tmp_path / name)).select("term", "docid", "tf"), "term", "docid") == brute(rows)
        assert len(list((tmp_path / name).rglob("*.parquet"))) >= least - 1
    assert len(list((tmp_path / "wide").rglob("*.parquet"))) > 2


def scattered(spark, seed=9):
    """Postings in no order, of terms in one document and in all, docids on both sides of zero and far apart; some twice or null."""
    rng = random.Random(seed)
    ids = [*range(-40, 200), *(10**12 + i for i in range(0, 900, 7)), -(10**13), 1 << 61]
    rows = [(t, d, rng.randint(1, 9)) for d in ids for t in {"all", "ünï", "", rng.choice("abcdefgh"), f"only{d}"} if t == "all" or rng.random() < 0.6]
    rows += [("all", 5, 77), ("all", None, 1), (None, 5, 1)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "term string, docid bigint, tf bigint").repartition(3), rows


@pytest.mark.parametrize("chunk, width, row", [(1 << 19, 1 << 22, 512), (1, 1, 1), (50, 64, 3), (7, 1 << 10, 512)])
def test_gaps_move_once_in_packed_rows_however_these_are_cut(spark, monkeypatch, chunk, width, row):
    for name, value in (("CHUNK", chunk), ("RANGE", width), ("ROW_GAPS", row), ("TOLD", 10), ("BUCKET_BITS", 4)):
        monkeypatch.setattr(operator, name, value, raising=False)
    p, rows = scattered(spark)
    moved = []
    held = nodes(spark, lambda: moved.append(encode_gaps(p, 16, 4)), "Exchange")
    # The postings move in packed rows and only once; the other exchange is the test's own.
    assert sum("hashpartitioning" in h["what"] for h in held) == sum("(bucket#" in h["what"] for h in held) == 1
    encoded, expected = moved[0], {}
    for t, d, n in rows:
        if t is not None and d is not None:
            expected.setdefault(t, []).append((d, n))
    blocks = {}
    for r in encoded.collect():
        blocks.setdefault((r["term"], r["block"]), []).append((r["pos"], r["gap"], r["tf"], r["prev"]))
    listed = {(r["term"], r["block"]): r for r in gap_lists(encoded).collect()}
    assert listed.keys() == blocks.keys()
    for term, of in expected.items():
        before, seen = 0, Counter()
        for block in dict.fromkeys(int(d / 16) if abs(d) < 1 << 50 else d // 16 for d in sorted(d for d, _ in of)):
            found, told = sorted(blocks.pop((term, block))), listed[term, block]
            assert [pos for pos, *_ in found] == list(range(len(found))) and {prev for *_, prev in found} == {before}
            assert (told["prev"], told["df"], told["block_df"]) == (before, len(of), len(found))
            assert [(e["gap"], e["tf"]) for e in told["gaps"]] == [(gap, n) for _, gap, n, _ in found]
            for _, gap, n, _ in found:
                before += gap
                seen[before, n] += 1
        assert seen == Counter(of)
    assert not blocks
    assert Counter(map(tuple, decode_gaps(encoded).collect())) == Counter((t, d, n) for t, of in expected.items() for d, n in of)
    # Rows that are not as encode_gaps left them are grouped anew.
    assert Counter(map(tuple, decode_gaps(encoded.filter("term = 'all'")).collect())) == Counter(("all", d, n) for d, n in expected["all"])
