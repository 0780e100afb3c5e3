"""The registered queries against SQL, the tokenizer libraries, brute force and held-out labels."""

import collections
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash

from charloom.llm.queries import LLM_ORACLES, LLM_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY 1").fetchall()


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(None if v != v else v for v in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_sql(spark, con, name):
    assert _rows(LLM_QUERIES[name](spark, SF).toPandas()) == _rows(con.execute(LLM_ORACLES[name]).fetchdf())


def test_every_operator_is_registered():
    assert {re.match(r"op(\d+)_", q)[1] for q in LLM_QUERIES} == {str(i) for i in range(1, 14)}


def test_packing(spark, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    p = LLM_QUERIES["op1_harmonic_packing"](spark, SF).toPandas()
    by_doc = {d: g.sort_values("start") for d, g in p.groupby("doc_id")}
    total = 0
    for d, text in texts:
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        g, at = by_doc[d], 0
        for r in g.itertuples():
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for _, g in p.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 2048
    assert p.sequence_id.nunique() * 2048 < 1.05 * total + 2048


def test_byte_bpe(spark, texts):
    import base64
    import hashlib
    import tiktoken
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = LLM_QUERIES["op2_byte_bpe"](spark, SF).toPandas().set_index("doc_id")
    for d, text in texts:
        ids = e.encode_ordinary(text)
        assert got.n_tokens[d] == len(ids)
        assert got.ids_sha256[d] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256[d] == hashlib.sha256(text.encode()).hexdigest()


def test_license_scan(spark, texts):
    got = LLM_QUERIES["op5_license_scan"](spark, SF).toPandas().set_index("doc_id")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    for d, text in texts:
        w = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        at = [(i, p) for p in phrases for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        r = got.loc[d]
        assert (r.n_words, r.n_base) == (len(w), len(at))
        assert r.base_labels == ",".join(sorted({phrases[p] for _, p in at}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        if at:
            assert (r.first_word, r.last_word) == (min(at)[0], max(at)[0])
        assert 0 <= r.score <= 1


def _fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, texts):
    got = LLM_QUERIES["op6_simhash"](spark, SF).toPandas().sort_values("doc_id")
    fps = [_fingerprint(t) for _, t in texts]
    assert got.fingerprint.tolist() == [f"{f:016x}" for f in fps]
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got.component_id.tolist() == [texts[find(i)][0] for i in range(len(fps))]


def test_simhash_links_across_tiles(spark):
    from charloom.llm.simhash import SimHashRules, fingerprint_links
    from charloom.llm.components import components
    rng = np.random.default_rng(3)
    base = rng.integers(-2**63, 2**63 - 1, 40)
    fps = {int(b) for b in base}
    for b in base[:8]:  # chains and balls of near fingerprints, more than a tile of them
        for _ in range(40):
            bits = rng.choice(64, rng.integers(1, 4), replace=False)
            fps.add(int(np.int64(b) ^ np.bitwise_or.reduce(np.left_shift(np.int64(1), bits))))
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r["node"]: r["root"] for r in components(fingerprint_links(df, SimHashRules(tile=16))).collect()}
    u = np.array(fps).view(np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None]) <= 2
    want, todo = {}, set(range(len(fps)))
    while todo:
        group, edge = set(), {min(todo)}
        while edge:
            group |= edge
            edge = {j for i in edge for j in np.flatnonzero(near[i])} - group
        todo -= group
        if len(group) > 1:
            want |= {fps[i]: min(fps[j] for j in group) for i in group}
    assert got == want


def test_language_held_out(spark):
    got = LLM_QUERIES["op7_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    want = duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").df()
    both = got.merge(want, on="doc_id")
    assert (both.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in both.doc_id]).all()
    held = both[both.held_out]
    assert len(both) == len(want) and (held.lang == held.lang_pred).mean() > 0.97
    assert both.score.between(0, 1).all()


def test_toxicity_held_out(spark):
    from charloom.llm.toxicity import TextScorer, train
    got = LLM_QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.01").toPandas()
    want = duckdb.sql("""SELECT doc_id, toxic, regexp_matches(lower(text), 'idiot|moron|stupid|worthless|trash|pathetic|loser|disgusting|clown|scum') AS says
                         FROM '/root/testdata/sf0.01/documents.parquet' JOIN '/root/testdata/sf0.01/labels.parquet' USING (doc_id)""").df()
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 3 == 1 for d in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.7)).all() and got.score.between(0, 1).all()
    held = got[got.held_out].merge(want, on="doc_id")
    said = held[held.says & (held.toxic == 1)]
    assert said.predicted.mean() > 0.9 and held[held.toxic == 0].predicted.mean() < 0.05
    rows = duckdb.sql("""SELECT text, toxic FROM '/root/testdata/sf0.01/documents.parquet'
                         JOIN '/root/testdata/sf0.01/labels.parquet' USING (doc_id)""").fetchall()
    model = train({y: [t for t, x in rows if x == y] for y in (0, 1)})
    plain = "The thing of that ereation was "
    scores = [model.score(v) for v in TextScorer(model).best(
        [plain, plain + "idiot", plain + "i-d-i-o-t", plain + "i d i o t", plain + "mo.ron", plain + "stuxpid", "", "x"])]
    assert min(scores[1:6]) >= 0.7 and max(scores[0], *scores[6:]) < 0.7


def test_embedding_links(spark):
    from charloom.llm.pq import PqRules, embedding_components
    rng = np.random.default_rng(9)
    x = rng.normal(size=(900, 24))
    near = x[rng.integers(0, 60, 400)]
    x = np.concatenate([x, near + rng.normal(size=near.shape) * 0.12, x[:30]]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = embedding_components(df, PqRules(tile=64)).toPandas().sort_values("vec_id")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = (u @ u.T >= 0.95) & ~np.eye(len(u), dtype=bool)
    assert got.n_links.sum() >= 0.9 * links.sum() > 500
    assert (got.n_links.to_numpy() <= links.sum(1)).all()
    whole = embedding_components(df, PqRules(margin=1.0, tile=64)).toPandas().sort_values("vec_id")
    assert whole.n_links.tolist() == links.sum(1).tolist()  # probes up to the full distance miss nothing
    root = np.arange(len(u))
    while True:
        new = np.minimum(root, np.where(links, root[None, :], len(u)).min(1))
        if (new == root).all():
            break
        root = new
    assert whole.component_id.tolist() == root.tolist() and (whole.kept == (whole.vec_id == whole.component_id)).all()


def test_url_rules_in_blocks(spark):
    from charloom.llm.urlrules import UrlRule, judge_urls
    rng = np.random.default_rng(4)
    labels, parts = ["a", "b", "c", "org", "com"], ["", "x", "xy", "y/", "x/z"]
    rules = [UrlRule(str(rng.choice(["allow", "block"])), ".".join(rng.choice(labels, rng.integers(1, 4))),
                     "/" + str(rng.choice(parts))) for _ in range(60)]
    urls = ["http://" + ".".join(rng.choice(labels, rng.integers(1, 5))) + str(rng.choice(["", "/", "/x/zz", "/xyz?q", "/y/#f", "?x"]))
            for _ in range(300)] + [None, "nothing", "a://", "http://X.ORG/xy", "http://a..org/x"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = judge_urls(df, rules, block_rows=7).toPandas().set_index("page_id")
    for i, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            host = re.match(r"[^/?#]*", u.split("://", 1)[1])[0]
            path = re.match(r"[^?#]*", u.split("://", 1)[1][len(host):])[0]
            host = host.lower()
        fits = [r for r in rules if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        assert (got.host[i], got.path[i]) == (host, path)
        if not fits:
            assert got.rule[i] is None and got.verdict[i] == "allow"
        else:
            top = max(len(r.host + r.path) for r in fits)
            best = {r.host + r.path for r in fits if len(r.host + r.path) == top}
            assert got.rule[i] in best


def test_licence_expressions():
    from charloom.llm.license import LicenseScanner, evaluate, to_postfix
    assert to_postfix("MIT or GPL-2.0 and Apache-2.0 with X") == ["mit", "gpl-2.0", "apache-2.0", "x", "with", "and", "or"]
    assert evaluate("(MIT or GPL-2.0) and Apache-2.0") == ({"mit", "gpl-2.0", "apache-2.0"}, True)
    assert evaluate("MIT and GPL-3.0-only") == ({"mit", "gpl-3.0-only"}, False)
    assert evaluate("GPL-2.0 with Classpath-exception-2.0")[0] == {"gpl-2.0"}
    for bad in ("", "and MIT", "(MIT", "MIT GPL", "MIT or", ")"):
        with pytest.raises(ValueError):
            to_postfix(bad)
    scan = LicenseScanner().scan
    assert scan("// SPDX-License-Identifier: MIT OR Apache-2.0\ncode")[5:] == ("apache-2.0,mit,permissive", 1.0)
    assert "bad-expression" in scan("SPDX-License-Identifier: MIT OR")[5]
    # prose after an expression is none of it; a malformed one names all its licences
    assert scan("SPDX-License-Identifier: MIT see the licence file for details")[5] == "mit,permissive"
    assert scan("SPDX-License-Identifier: (MIT OR GPL-2.0) and more")[5] == "gpl-2.0,mit,more,restricted"
    many = [f"l{i}" for i in range(40)]
    assert scan("SPDX-License-Identifier: (" + " OR ".join(many))[5].split(",") == sorted([*many, "bad-expression"])
    assert scan("SPDX-License-Identifier: ) x")[5] == "bad-expression"
    assert scan("a:b SPDX-License-Identifier: isc\nspdx-license-identifier: 0BSD */ x")[5] == "0bsd,isc,permissive"
    assert scan("CC BY, cc-by")[:6] == (4, 2, 0, 2, "cc-by", "cc-by")


def _line_runs(docs, min_words):
    """Lines (doc, place) that belong to a later copy of a repeated run, by all pairs."""
    own = [(d, i, x) for d, t in docs for i, x in enumerate(y for y in t.split("\n") if y.split())]
    at = {(d, i): x for d, i, x in own}
    gone = set()
    for d, i, x in own:
        for e, j, y in own:
            if x == y and (e, j) < (d, i) and at.get((d, i - 1)) is None or x == y and (e, j) < (d, i) and at.get((d, i - 1)) != at.get((e, j - 1), 0):
                n = 0
                while at.get((d, i + n)) is not None and at.get((d, i + n)) == at.get((e, j + n)):
                    n += 1
                if sum(len(at[d, i + k].split()) for k in range(n)) >= min_words:
                    gone |= {(d, i + k) for k in range(n)}
    return gone


@pytest.mark.parametrize("seed", range(3))
def test_line_runs(spark, seed):
    from charloom.llm.line_dedup import LineRules, dedup_lines
    rng = np.random.default_rng(seed)
    docs = [(d, "\n".join(rng.choice(["a b", "c", "d e f", "", "g h", " "], rng.integers(0, 30), p=[.3, .2, .2, .1, .1, .1])))
            for d in range(8)]
    docs.append((8, docs[3][1]))
    gone = _line_runs(docs, 7)
    got = dict(dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), LineRules(7)).collect())
    for d, t in docs:
        out, i, on = [], -1, True
        for x in t.split("\n"):
            if x.split():
                i += 1
                on = (d, i) not in gone
            if on:
                out.append(x)
        assert got[d] == "\n".join(out)


def test_line_runs_that_overlap_their_copies_and_hot_lines(spark, monkeypatch):
    """The first period of a run of equal lines stays; hot groups take the broadcast way."""
    from charloom.llm import line_dedup
    block = "\n".join(f"line {i} of the notice that all of these pages hold" for i in range(8))
    docs = [(0, "\n".join(["five words in a line"] * 24)), (1, "\n".join(["one two", "three four"] * 40)), (2, "a\n" + block)]
    docs += [(3 + i, f"own {i}\n{block}\n\nend {i}") for i in range(30)]
    want = {0: "five words in a line", 1: "one two\nthree four", 2: docs[2][1]} | {3 + i: f"own {i}\nend {i}" for i in range(30)}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for parts in (1, line_dedup.HOT_PARTS):  # no group is hot; all are
        monkeypatch.setattr(line_dedup, "HOT_PARTS", parts)
        assert dict(line_dedup.dedup_lines(frame).collect()) == want


def test_components_of_long_paths_and_hubs(spark):
    from charloom.llm.components import components
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 4999)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(300)}, 4999: 4999, 5000: 4999}


def test_codewords_tell_classes_apart():
    from charloom.llm.langid import codewords
    for n in (2, 3, 4, 5, 9, 40):
        c = codewords(n)
        assert len({tuple(r) for r in c.tolist()}) == n
    assert collections.Counter(codewords(4).shape)[7] == 1
