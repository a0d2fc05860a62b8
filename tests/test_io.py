import random

import pytest
from plan_metrics import nodes
from table_rows import as_dict

from textgraph import bool_search, build_postings, documents_of, fetch_lines, lines_of, read_lines, read_lines_with_offset, write_tsv, write_tuples
from textgraph.plans.durable import durable, shared_folder


def offsets(data: bytes):
    found, at = {}, 0
    for piece in data.split(b"\n"):
        found[at] = piece.decode().removesuffix("\r")
        at += len(piece) + 1
    if data.endswith(b"\n"):
        del found[len(data)]
    return found


@pytest.mark.parametrize("split_bytes", ["1k", "100m"])
def test_offsets_across_splits_and_files(spark, tmp_path, split_bytes):
    rng = random.Random(3)
    written = {}
    for name in ("a", "b", "c"):
        texts = ["é" * rng.randint(0, 30) + "x" * rng.choice([0, 1, 50, 700]) for _ in range(rng.choice([1, 200]))]
        data = rng.choice(["\n", "\r\n"]).join(texts).encode() + rng.choice([b"", b"\n"])
        (tmp_path / f"{name}.txt").write_bytes(data)
        written[name] = offsets(data)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = read_lines_with_offset(spark, str(tmp_path)).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    found = {}
    for row in rows:
        found.setdefault(row["file"].rsplit("/", 1)[1].removesuffix(".txt"), {})[row["offset"]] = row["line"]
    assert found == written
    assert len({row["docid"] for row in rows}) == len(rows)
    assert all(row["docid"] == row["offset"] for row in rows if row["file"].endswith("a.txt"))


def test_a_finer_split_at_reading_changes_nothing(spark, tmp_path):
    data = "".join(f"line {i}\n" for i in range(20_000)).encode()
    (tmp_path / "t.txt").write_bytes(data)
    lines = read_lines_with_offset(spark, str(tmp_path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        found = {r["docid"]: r["line"] for r in lines.filter("docid >= 100").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {at: line for at, line in offsets(data).items() if at >= 100}


def test_offsets_need_no_python_worker(spark, tmp_path):
    (tmp_path / "t.txt").write_text("red rose\nred car\n")
    found = []
    ran = [n["what"] for n in nodes(spark, lambda: found.extend(read_lines_with_offset(spark, str(tmp_path)).collect()), "")]
    assert [r["docid"] for r in sorted(found)] == [0, 9]
    assert any("Window" in what for what in ran)
    assert not any(word in what for what in ran for word in ("Python", "Arrow", "Pandas"))


def test_lines_of_several_files_are_documents_apart(spark, tmp_path):
    (tmp_path / "a.txt").write_text("red rose\n")
    (tmp_path / "b.txt").write_text("red car\n")
    lines = read_lines_with_offset(spark, str(tmp_path))
    postings = build_postings(lines)
    assert as_dict(postings.filter("term = 'red'").select("docid", "tf"), "docid") == {0: 1, 9: 1}
    assert bool_search(postings, {"q": "rose car AND"}).count() == 0
    assert [r["line"] for r in fetch_lines(bool_search(postings, {"q": "rose red AND"}), lines).collect()] == ["red rose"]


def test_read_lines(spark, tmp_path):
    (tmp_path / "t.txt").write_bytes(b"a\r\n\nb\tc\n")
    assert [r["line"] for r in read_lines(spark, str(tmp_path)).collect()] == ["a", "", "b\tc"]


def test_lines_and_documents_of_a_table(spark):
    df = spark.createDataFrame([(7, "a\nb"), (8, "")], "id int, body string")
    assert as_dict(lines_of(df, "id", "body"), "docid", "ln") == {(7, 0): "a", (7, 1): "b", (8, 0): ""}
    assert as_dict(documents_of(df, "id", "body"), "docid") == {7: "a\nb", 8: ""}


def test_tsv_keeps_quotes_nulls_and_key_order(spark, tmp_path):
    rows = [('q"uote', 2), ("a", 1), ("tab", None), ("\\", 5)]
    path = str(tmp_path / "out")
    for _ in range(2):
        write_tsv(spark.createDataFrame(rows, "k string, v bigint"), path, n=2, sort_by="k")
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert len(parts) == 2
    lines = [line for p in parts for line in p.read_text().splitlines()]
    assert lines == ["\\\t5", "a\t1", 'q"uote\t2', "tab\t"]
    write_tsv(spark.createDataFrame(rows, "k string, v bigint"), path, n=3)
    assert sorted(spark.read.text(path).toPandas()["value"]) == sorted(lines)


def test_tuples(spark, tmp_path):
    write_tuples(spark.createDataFrame([("Jan 24 09", 26473)], "h string, n bigint"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first()["value"] == "(Jan 24 09,26473)"


def test_a_cluster_without_the_setting_is_an_error():
    class Session:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "local-cluster[2,1,1024]"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_durable_rows_live_in_the_shared_folder(spark):
    df = durable(spark.range(5), "five")
    assert all(shared_folder(spark) in f for f in df.inputFiles())
    assert df.count() == 5
