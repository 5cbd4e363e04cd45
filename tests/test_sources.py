from minekit.plans.pagerank import load_ranks, save_ranks
from minekit.sources import readers, writers


def test_matrix_text_round_trip(spark, tmp_path):
    rows = [("M", 0, 1, 10), ("N", 1, 0, -3)]
    df = spark.createDataFrame(rows, "name string, i bigint, j bigint, v bigint")
    writers.write_lines(df, writers.entry_line(), str(tmp_path / "m"))
    assert sorted(map(tuple, readers.read_matrix(spark, str(tmp_path / "m")).collect())) == rows


def test_edges(spark, tmp_path):
    (tmp_path / "edges.txt").write_text("1\t2\n30\t4\n")
    assert sorted(map(tuple, readers.read_edges(spark, str(tmp_path / "edges.txt")).collect())) == [(1, 2), (30, 4)]


def test_vectors(spark, tmp_path):
    (tmp_path / "v.txt").write_text("0 1.5 -2e3\n4 5 6\n")
    assert [r.v for r in readers.read_vectors(spark, str(tmp_path / "v.txt")).collect()] == [
        [0.0, 1.5, -2000.0],
        [4.0, 5.0, 6.0],
    ]


def test_vectors_are_numbered_in_file_order(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"{i} 0\n" for i in range(40)))
    (tmp_path / "b.txt").write_text("".join(f"{40 + i} 1\n" for i in range(3)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    got = readers.read_numbered_vectors(spark, str(tmp_path)).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.id, r.v[0]) for r in got) == [(i, float(i)) for i in range(43)]


def test_corpus_is_keyed_by_file_name(spark, tmp_path):
    (tmp_path / "001.txt").write_bytes(b"Title\r\n\r\nBody text\n")
    (tmp_path / "002.txt").write_text("Other\n")
    got = {r.file: r.text for r in readers.read_corpus(spark, str(tmp_path / "*.txt")).collect()}
    assert got == {"001.txt": "Title\n\nBody text\n", "002.txt": "Other\n"}


def test_corpus_files_round_trip(spark, tmp_path):
    docs = [("1", "first\ntext"), ("2", ""), ("3", None), ("-4", "öl \t x" * 1000)]
    path = f"{tmp_path}/corpus"
    df = spark.createDataFrame(docs, "name string, text string").repartition(3)
    assert writers.write_corpus(df, path) == 4
    # written again: the same files
    assert writers.write_corpus(df, path) == 4
    got = {r.file: r.text for r in readers.read_corpus(spark, path).collect()}
    assert got == {f"{name}.txt": text for name, text in docs if text}
    assert (tmp_path / "corpus/2.txt").read_text() == (tmp_path / "corpus/3.txt").read_text() == ""
    assert writers.write_corpus(df.limit(0), f"{tmp_path}/none") == 0


def test_labeled_rows(spark, tmp_path):
    lines = [
        '"url"\t"urlid"\t"body"\t"kind"\t"x"\t"y"\t"spare"\t"label"',
        '"u"\t"7"\t"{""a"":1}"\t"news"\t"0.5"\t"?"\t"1"\t"1"',
        '"u"\t"8"\t"b"\t"?"\t"2"\t"3"\t"1"\t"0"',
    ]
    (tmp_path / "t.tsv").write_text("\n".join(lines) + "\n")
    got = sorted(map(tuple, readers.read_labeled(spark, str(tmp_path / "t.tsv")).collect()))
    assert got == [(7, "news", ["0.5", "?"], 1.0), (8, "?", ["2", "3"], 0.0)]


def test_ranks_as_tuples_and_as_table(spark, tmp_path):
    ranks = spark.createDataFrame([(3, 0.1), (4, 1.25e-07)], "node bigint, rank double")
    writers.write_lines(ranks, writers.rank_tuple(), str(tmp_path / "text"))
    save_ranks(ranks, str(tmp_path / "table"))
    for back in (readers.read_rank_text(spark, str(tmp_path / "text")), load_ranks(ranks, str(tmp_path / "table"))):
        assert sorted(map(tuple, back.collect())) == [(3, 0.1), (4, 1.25e-07)]
    lines = [r[0] for r in ranks.orderBy("node").select(writers.rank_line()).collect()]
    assert lines == ["3\t0.100000000", "4\t0.000000125"]


def test_files_of_a_corpus_are_read_once(spark, tmp_path):
    from minekit.checks.queries import QUERIES

    rows = [(1, "a b"), (2, "c")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["corpus_documents"](spark, str(tmp_path))
    assert sorted((r.doc_id, r.n_tokens) for r in found.collect()) == [(1, 2), (2, 1)]
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan text") == 1


def test_many_files_lie_in_folders_and_make_few_tasks(spark, tmp_path):
    docs = [(str(i), f"text {i}") for i in range(700)] + [(None, "no name")]
    path = f"{tmp_path}/corpus"
    df = spark.createDataFrame(docs, "name string, text string").repartition(2)
    assert writers.write_corpus(df, path, 16) == 701
    assert writers.write_corpus(df, path, 16) == 701
    folders = list((tmp_path / "corpus").iterdir())
    assert len(folders) == 16 and all(f.is_dir() for f in folders)
    back = readers.read_corpus(spark, path, folders=True)
    # 32 files make a split
    assert back.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sorted((r.file, r.text) for r in back.collect()) == sorted((f"{name}.txt", text) for name, text in docs)


def test_the_driver_holds_no_list_of_the_files(spark, tmp_path):
    docs = [(str(i), f"text {i}\r\nöl\r") for i in range(300)] + [("empty", "")]
    path = f"{tmp_path}/corpus"
    writers.write_corpus(spark.createDataFrame(docs, "name string, text string"), path, 7)
    for hidden in ("0001/_part", "0001/.txt", "_temporary/8.txt"):
        (tmp_path / "corpus" / hidden).parent.mkdir(exist_ok=True)
        (tmp_path / "corpus" / hidden).write_text("not a document")
    (tmp_path / "corpus/0002/deep\tand\nodd").mkdir()
    (tmp_path / "corpus/0002/deep\tand\nodd/9\n.txt").write_bytes(b"more")
    (tmp_path / "corpus/top.txt").write_bytes(b"top")
    back = readers.read_corpus(spark, path, folders=True)
    wanted = [(f"{name}.txt", text.replace("\r\n", "\n").replace("\r", "\n")) for name, text in docs if text]
    assert sorted((r.file, r.text) for r in back.collect()) == sorted([*wanted, ("9\n.txt", "more"), ("top.txt", "top")])
    # a list of the corpus files is read, not an index of them
    assert not any(name.startswith(f"file://{path}") for name in back.inputFiles())
    assert readers.read_corpus(spark, f"file://{path}", folders=True).count() == 302
    (tmp_path / "none").mkdir()
    assert readers.read_corpus(spark, f"{tmp_path}/none", folders=True).count() == 0
