"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

LONG = ("Thhe ereation of idiot, that is cc by nd.\n" * 9000) + "x" * 70000
DOCS = [(1, "The and attion to thanedble.\nIt is an er.", "en", "s"), (1, "The and attion to thanedble.\nIt is an er.", "en", "s"),
        (None, "a b c", None, None), (2, None, "en", None), (3, "", None, "s"), (4, LONG, "en", "s"), (5, " \n\t ", "fr", "t"),
        (6, "..., 12", "fr", "t"), (None, None, None, None), (7, "Le la é\x85 x\u2028y", "fr", "t")]
CLASH = ["rk", "doc", "fp", "n", "kept", "score", "ids", "line", "words", "host", "sequence_id", "class", "part", "at", "u", "v", "node"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASH])


def _operators():
    import public_tokenizers as P

    from charloom.llm import bpe, langid, license, line_dedup, packing, quality, simhash, toxicity
    words, ranks = P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")
    return {
        "pack": lambda d: packing.pack_documents(d, words),
        "bpe": lambda d: bpe.round_trip(d, ranks, P.PATTERN),
        "encode_decode": lambda d: bpe.decode_documents(bpe.encode_documents(d, ranks, P.PATTERN), ranks, P.PATTERN),
        "lines": lambda d: line_dedup.dedup_lines(d),
        "line_digest": lambda d: line_dedup.dedup_digest(d),
        "quality": lambda d: quality.quality_verdicts(d),
        "apply_quality": lambda d: quality.apply_quality(d),
        "license": lambda d: license.scan_licenses(d),
        "simhash": lambda d: simhash.simhash_components(d),
        "apply_simhash": lambda d: simhash.apply_simhash(d),
        "language": lambda d: langid.language_predictions(d),
        "apply_language": lambda d: langid.apply_language(d),
        "toxicity": lambda d: toxicity.held_out_toxicity(d, d.select("doc_id", F.lit(1).alias("toxic"))),
    }


SAME_COLUMNS = {"lines", "apply_quality", "apply_simhash", "apply_language"}
A_ROW_EACH = {"bpe", "encode_decode", "lines", "line_digest", "quality", "license", "simhash", "language", "toxicity"}


@pytest.mark.parametrize("name", sorted(_operators()))
def test_odd_rows(docs, name):
    out = _operators()[name](docs)
    rows = out.collect()
    if name in SAME_COLUMNS:
        assert out.columns == docs.columns
        assert all(r[c] == f"own {c}" for r in rows for c in CLASH)
    if name in A_ROW_EACH:
        assert sorted((r["doc_id"] or 0) for r in rows) == sorted((d[0] or 0) for d in DOCS)


@pytest.mark.parametrize("name", sorted(_operators()))
def test_empty_table(docs, name):
    assert _operators()[name](docs.limit(0)).count() == 0


def test_defined_results(docs):
    ops = _operators()
    lang = {(r["doc_id"], r["lang_pred"]) for r in ops["language"](docs).collect()}
    assert {(2, "und"), (3, "und"), (5, "und"), (6, "und")} <= lang and (7, "und") not in lang
    packed = ops["pack"](docs).filter("doc_id = 3").collect()
    assert [(r["start"], r["length"], r["doc_tokens"]) for r in packed] == [(0, 1, 1)]
    assert ops["pack"](docs).filter("doc_id = 1 and start = 0").count() == 2
    sim = {r["doc_id"]: r for r in ops["simhash"](docs).collect()}
    assert sim[2]["fingerprint"] == "0" * 16 and sim[2]["component_id"] == sim[3]["component_id"] == sim[5]["component_id"] == 2
    stays = sorted((r["doc_id"] or 0) for r in ops["apply_simhash"](docs).collect())
    assert stays == [0, 1, 1, 2, 4, 6, 7]
    kept = ops["apply_quality"](docs).select("doc_id").distinct().collect()
    assert [r[0] for r in kept] == []  # too short, or one line over and over
    texts = {r["doc_id"]: r["text"] for r in ops["lines"](docs).collect()}
    assert texts[2] is None and texts[3] == "" and texts[4].startswith("Thhe") and len(texts[4]) < len(LONG)
    back = {r["doc_id"]: r["text_bytes"] for r in ops["encode_decode"](docs).collect()}
    assert bytes(back[4]).decode() == LONG and bytes(back[2]) == b""


def test_embeddings(spark):
    from charloom.llm.pq import embedding_components
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (2, [1.0, 0.01]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (11, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rep", F.lit("own"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_components(df).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[11] == (2, 1, False)
    for i in (3, 4, 5, 6, 7, 8, 9, 10):
        assert got[i] == (0, i, True)
    assert got[None][0] == 0 and len(got) == 12
    assert embedding_components(df.limit(0)).count() == 0


def test_urls(spark):
    from charloom.llm.urlrules import PAGE_RULES, judge_urls
    df = spark.createDataFrame([(1, None), (None, "http://a.org/"), (1, None), (2, "x" * 100000), (3, "http://org"), (4, "")],
                               "page_id long, url string").withColumn("rule", F.lit("own")).withColumn("host", F.lit(1))
    got = judge_urls(df, PAGE_RULES).collect()
    assert len(got) == 6 and [r["rule"] for r in got if r["page_id"] is None] == ["org/"]
    assert all(r["rule"] is None and r["verdict"] == "allow" for r in got if r["page_id"])
    assert judge_urls(df.limit(0), PAGE_RULES).count() == 0
    rules = spark.createDataFrame([("block", "org", "/"), (None, "a.org", "/")], "verdict string, host string, path string")
    assert [r["verdict"] for r in judge_urls(df, rules).collect() if r["page_id"] is None] == ["block"]
