import numpy as np

from charloom.functions import kernels as K
from charloom.functions.exprs import unit_hash
from charloom.functions.sql import unit_hash_sql
from charloom.operators import corpus as C
from charloom.sources.text import corpus_lines, read_text_lines


def test_corpus_lines_split_on_every_break(spark, docs):
    rows = sorted(tuple(r) for r in corpus_lines(docs).collect())
    doc1 = [r for r in rows if r[0] == 1]
    assert [r[2] for r in doc1] == ["x", ""]
    assert all("\r" not in r[2] and "\n" not in r[2] for r in rows)
    assert len([r for r in rows if r[0] == 4]) == 3  # "\n\n" -> three empty lines


def test_read_text_file(spark, tmp_path):
    p = tmp_path / "corpus.txt"
    p.write_text("first line\r\nsecond\n\nlast\n", encoding="utf-8")
    rows = read_text_lines(spark, str(p)).orderBy("line_no").collect()
    assert [r["line"] for r in rows] == ["first line", "second", "", "last"]
    assert {r["doc_id"] for r in rows} == {0}


def test_char_tokens_skip_empty_lines(spark, docs):
    lines = corpus_lines(docs)
    chars = C.char_tokens(lines)
    total = sum(len(r["line"]) for r in lines.collect())
    assert chars.count() == total
    assert chars.where("ch = ''").count() == 0


def test_word_tokens_follow_jvm_split(spark):
    df = spark.createDataFrame([(0, 0, "a b  "), (0, 1, " a"), (0, 2, ""), (0, 3, "   "), (0, 4, "a  b")],
                               "doc_id bigint, line_no bigint, line string")
    got = {}
    for r in C.word_tokens(df).collect():
        got.setdefault(r["line_no"], []).append((r["pos"], r["word"]))
    words = {k: [w for _, w in sorted(v)] for k, v in got.items()}
    assert words == {0: ["a", "b"], 1: ["", "a"], 2: [""], 4: ["a", "", "b"]}


def test_vocab_code_point_order_and_round_trip(spark, docs):
    lines = corpus_lines(docs)
    v = C.collect_vocab(C.vocab_table(lines))
    assert list(v.chars) == sorted(v.chars, key=ord)
    text = "".join(r["line"] for r in lines.collect())
    assert sum(v.counts) == len(text) and set(v.chars) == set(text)
    enc = C.encode_lines(spark, lines, v)
    dec = enc.select("line_no", "doc_id", C.decoder_udf(spark, v)(enc["ids"]).alias("back"))
    back = {(r["doc_id"], r["line_no"]): r["back"] for r in dec.collect()}
    for r in C.nonempty_lines(lines).collect():
        assert back[(r["doc_id"], r["line_no"])] == r["line"]


def test_encode_handles_non_bmp_and_unknown():
    cps = np.array([ord("a"), ord("b"), 0x1F600], dtype=np.int64)
    out = C.encode_text(["ab\U0001F600", "c"], cps)
    assert out[0].tolist() == [0, 1, 2] and out[1].tolist() == [-1]


def test_one_hot(spark):
    df = spark.createDataFrame([(2,)], "id int")
    assert df.select(C.one_hot(df["id"], 4).alias("v")).first()["v"] == [0.0, 0.0, 1.0, 0.0]


def test_hash_agrees_in_spark_numpy_and_duckdb(spark):
    import duckdb
    keys = [0, 1, 17, 123456789, 123456789 + 2**31 - 1, 10**12]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    sp = [r["h"] for r in df.select(unit_hash(7, 3, df["k"]).alias("h")).orderBy("k").collect()]
    npv = K.unit_hash(7, 3, np.array(keys)).tolist()
    dd = [duckdb.sql(f"SELECT {unit_hash_sql(7, 3, str(k))}").fetchall()[0][0] for k in keys]
    assert sp == npv == dd


def test_word_tokens_without_empties(spark):
    df = spark.createDataFrame([(0, 0, " a  b "), (0, 1, "")], "doc_id bigint, line_no bigint, line string")
    assert sorted((r["line_no"], r["word"]) for r in C.word_tokens(df, keep_empty=False).collect()) == \
        [(0, "a"), (0, "b")]


def test_read_text_directory_numbers_files_in_path_order(spark, tmp_path):
    (tmp_path / "b.txt").write_text("second file\n", encoding="utf-8")
    (tmp_path / "a.txt").write_text("first file\nline two\n", encoding="utf-8")
    rows = read_text_lines(spark, str(tmp_path)).orderBy("doc_id", "line_no").collect()
    assert [(r["doc_id"], r["line"]) for r in rows] == [(0, "first file"), (0, "line two"), (1, "second file")]
