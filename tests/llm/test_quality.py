"""Line frequency by distinct texts per host."""

import duckdb

from charloom.llm.quality import QUALITY_SQL, apply_quality, quality_verdicts

HEAD, FOOT = "home news about contact\nsearch this site now", "terms and privacy notice\nall pages of this site"


def _body(i):
    return "\n".join(" ".join(f"w{i}x{k}y{j}" for j in range(12)) for k in range(4))


def test_blocks_of_boilerplate_beside_mass_copies(spark):
    page = _body(999)
    rows = ([(i, f"{HEAD}\n{_body(i)}\n{FOOT}", "s") for i in range(40)] + [(100 + i, page, "s") for i in range(400)]
            + [(600 + i, f"{HEAD}\n{_body(600 + i)}", None) for i in range(3)] + [(700, f"{HEAD}\n{_body(700)}", "t")])
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality_verdicts(docs).collect()}
    assert all(r["kept"] for r in got.values())
    assert {got[i]["removed_words"] for i in range(40)} == {17}  # every line of both blocks
    assert {got[100 + i]["removed_words"] for i in range(400)} == {0}  # one text, however many rows
    assert {got[600 + i]["removed_words"] for i in range(3)} == {8} and got[700]["removed_words"] == 0
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    told = con.execute(f"SELECT doc_id, removed_words, kept FROM ({QUALITY_SQL})").fetchall()
    assert sorted(told) == sorted((d, r["removed_words"], r["kept"]) for d, r in got.items())
    texts = {r["doc_id"]: r["text"] for r in apply_quality(docs).collect()}
    assert texts[0] == _body(0) and texts[100] == page and texts[600] == _body(600) and texts[700] == rows[-1][1]
