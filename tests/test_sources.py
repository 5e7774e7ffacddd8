import pytest
from pyspark.sql import functions as F

from wordloom.sources import files


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "corpus").mkdir()
    (tmp_path / "corpus" / "news.txt").write_bytes("Été\x00 one\ntwo\n".encode())
    (tmp_path / "corpus" / "blogs.txt").write_bytes(b"three\r\nfour")
    return tmp_path


def test_lines_and_corpus(spark, folder):
    rows = {tuple(r) for r in files.read_lines(spark, f"{folder}/corpus/news.txt").collect()}
    assert rows == {("news", "Été one"), ("news", "two")}
    corpus = files.read_corpus(spark, f"{folder}/corpus/*.txt", str(folder / "work"))
    assert corpus.count() == 4 and corpus.select("doc_id").distinct().count() == 4
    assert {r.text for r in corpus.where("source = 'blogs'").collect()} == {"three", "four"}
    first = {tuple(r) for r in corpus.collect()}
    assert first == {tuple(r) for r in corpus.repartition(3).collect()}


def test_line_ids_do_not_depend_on_splits(spark, folder):
    """Equal ids, and so equal samples, however the files are cut."""
    from wordloom.operators.sampling import sample_records

    for name in ("a", "b"):
        lines = "".join(f"{name} line {i} {'x' * (i % 50)}\n" for i in range(2000))
        (folder / "corpus" / f"{name}.txt").write_text(lines)
    got = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128m", "7k", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        corpus = files.read_corpus(spark, f"{folder}/corpus/*.txt", str(folder / f"work{size}"))
        rows = sorted(tuple(r) for r in corpus.collect())
        got.append((rows, sorted(tuple(r) for r in sample_records(corpus, frac=0.2).collect())))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got[0] == got[1] == got[2]
    lines = [(i % files.LINES_PER_FILE, text.split()[2]) for i, source, text in got[0][0] if source in "ab"]
    assert all(str(number) == told for number, told in lines)


@pytest.mark.parametrize("per_group", [400_000, 2])
def test_corpus_text_is_not_moved(spark, folder, monkeypatch, per_group):
    """Whatever Spark would broadcast by itself, and however many groups the files make."""
    monkeypatch.setattr(files, "BLOCKS_PER_GROUP", per_group)
    for name in "abcde":
        (folder / "corpus" / f"{name}.txt").write_text("".join(f"{name} {i}\n" for i in range(50)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        corpus = files.read_corpus(spark, f"{folder}/corpus/*.txt", str(folder / f"w{per_group}"))
        plan = corpus._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hash" not in plan and "BroadcastHashJoin" in plan
        assert ("Union" in plan) == (per_group == 2)
        got = sorted((r.doc_id // files.LINES_PER_FILE, r.doc_id % files.LINES_PER_FILE, r.text) for r in corpus.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Sorted paths: a, b, blogs, c, d, e, news.
    assert [t for f, i, t in got if f == 0] == [f"a {i}" for i in range(50)]
    assert [t for f, i, t in got if f == 5] == [f"e {i}" for i in range(50)] and len(got) == 254


def test_word_list(spark, folder):
    path = folder / "block.csv"
    path.write_text('about\nthis\nlist\n\nid,term\n1,foo\n2,"bar, baz"\n\n3,qux\n')
    got = [r.word for r in files.read_word_list(spark, str(path)).collect()]
    assert got == ["foo", "bar, baz", "qux"]


def test_tables_round_trip(spark, micro, folder):
    schema = "w1 string, w2 string, bi_freq bigint"
    want = {tuple(r) for r in micro[2].collect()}
    for fmt in ("csv", "parquet"):
        path = str(folder / fmt)
        files.write_table(micro[2], path, fmt)
        assert {tuple(r) for r in files.read_ngrams(spark, path, schema, fmt=fmt).collect()} == want
        some = files.read_ngrams(spark, path, schema, ["w2", "bi_freq"], fmt)
        assert some.columns == ["w2", "bi_freq"] and some.count() == len(want)


def test_write_lines(spark, folder):
    df = spark.createDataFrame([("a b",), ("c",)], "text string")
    files.write_lines(df, str(folder / "out"))
    assert {r.text for r in files.read_lines(spark, str(folder / "out")).collect()} == {"a b", "c"}


def test_documents_scan_only_needed_columns(spark):
    df = files.read_documents(spark, "/root/testdata/sf0.001/documents.parquet").select(F.length("text"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan
