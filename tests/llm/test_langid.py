"""The training sample holds distinct texts, however many copies there are."""

from charloom.llm import langid


def test_copies_count_once(spark, monkeypatch):
    learned = []
    counts = langid.gram_counts
    monkeypatch.setattr(langid, "gram_counts", lambda texts, rules: learned.append(sorted(texts)) or counts(texts, rules))
    own = {k: sorted(f"{word} {chr(97 + i % 26)}{chr(97 + i // 26)} {word}" for i in range(60)) for k, word in (("a", "thing"), ("b", "chose"))}
    for seed in range(3):  # hashes on both sides of the share
        rows = [("a", t) for t in own["a"]] + [("a", f"copied page {seed}")] * 3000 + [("b", t) for t in own["b"]]
        docs = spark.createDataFrame(rows, "lang string, text string")
        learned.clear()
        model = langid.fit_languages(docs, langid.LangRules(sample_per_language=100, rounds=2))
        assert model.languages == ["a", "b"]
        assert learned == [sorted([*own["a"], f"copied page {seed}"]), own["b"]]
    learned.clear()
    langid.fit_languages(docs, langid.LangRules(sample_per_language=20, rounds=2))
    assert all(len(set(t)) == len(t) == 20 for t in learned) and len(learned) == 2
    only = spark.createDataFrame([("a", f"one text {i % 1}") for i in range(3000)], "lang string, text string")
    assert langid.fit_languages(only, langid.LangRules(rounds=2)).languages == ["a"]


def test_every_language_is_learned(spark):
    rows = [(f"l{i}", f"{chr(0x4e00 + i)}{chr(0x5e00 + i)} text {j}") for i in range(530) for j in range(3)]
    model = langid.fit_languages(spark.createDataFrame(rows, "lang string, text string"), langid.LangRules(rounds=1, sample_rows=1000, features=256))
    assert model.languages == sorted({k for k, _ in rows})
    # one language has long texts only, as good as an excerpt of each
    rows = [("a", f"the thing of page {i} is this") for i in range(40)] + [("b", f"{i} une chose et une autre, " * 2000) for i in range(40)]
    model = langid.fit_languages(spark.createDataFrame(rows, "lang string, text string"))
    assert model.languages == ["a", "b"]
    assert [p[0] for p in model.predict(["a page of the thing", "et une chose"])] == ["a", "b"]
