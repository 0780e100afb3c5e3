"""Quality rules by cross-document line frequency (DataFrame functions only).

Base rules are per text.  The method's rule counts, for every host and
normalised line, the distinct documents that hold it, removes lines above the
limits, and rejects documents that lose most of their words that way.  Copies of
one text count as one document of their host, for a line and for the host's
total: mass copies are left to near-dedup and hide no boilerplate.

Results in the odd cases: a null text counts as an empty one (no words,
``base_failed``); a null host is a host of its own; identical rows (same id,
host and text) get the same verdict; extra columns
of the input are neither read nor returned by :func:`quality_verdicts`, and are
passed through by :func:`apply_quality`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from charloom.llm.common import SPACES, ascii_words, cut, let, plain_spaces, row_key

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 20
    window: int = 8
    max_repeat_percent: int = 30
    #: a line is above the limits if it stands in at least so many distinct texts of its host ...
    min_line_docs: int = 3
    #: ... which are over this percentage of them
    max_line_percent: int = 2
    #: a document is depleted if fewer than this percentage of its words is left
    min_left_percent: int = 30


def _text(docs: DataFrame, text: str) -> Column:
    return F.coalesce(docs[text], F.lit(""))


def _repeat_words(words: Column, width: int) -> Column:
    """Words in ``width``-word windows that occur twice or more in the text.

    Window hashes are compared inside the row; only texts with a repeated hash
    sort them.  Nothing is exploded or shuffled."""
    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

        def starts(s: Column) -> Column:
            # an element belongs to a repeat if a neighbour in hash order is equal
            after = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
            return let(after, lambda eq: F.sort_array(F.transform(
                F.filter(F.zip_with(F.zip_with(s, eq, lambda e, q: F.struct(e["p"].alias("p"), q.alias("q"))),
                                    F.concat(F.array(F.lit(False)), F.slice(eq, 1, F.size(eq) - 1)),
                                    lambda e, before: F.struct(e["p"].alias("p"), (e["q"] | before).alias("q"))),
                         lambda e: e["q"]), lambda e: e["p"])))

        return let(let(placed, starts), lambda p: F.aggregate(
            F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.lit(width), F.coalesce(b - a, F.lit(width)))),
            F.lit(0).cast("long"), lambda total, x: total + x))

    def longer(step: int, h: Column):
        return F.zip_with(h, F.slice(h, step + 1, F.size(h)), lambda a, b: F.xxhash64(a, b))

    def windows(w: Column) -> Column:
        # hashes of 1, 2, 4, 8, ... words from those of half the length
        h, size = F.transform(w, lambda x: F.xxhash64(x)), 1
        while size < width:
            step = min(size, width - size)
            h, size = let(h, partial(longer, step)), size + step
        return F.when(F.size(w) > width, let(h, lambda x: F.slice(x, 1, F.size(w) - (width - 1)))).otherwise(
            F.array().cast("array<long>"))

    return let(windows(words), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))


def _word_lines(text: Column) -> Column:
    """``\\n``-split lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")


def _normal(line: Column) -> Column:
    """Lower case, single blanks, none at the ends."""
    plain = F.lower(F.trim(plain_spaces(line, "\t\x0b\x0c\r")))
    return let(plain, lambda x: F.when(F.contains(x, F.lit("  ")), F.regexp_replace(x, " +", " ")).otherwise(x))


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def base_features(docs: DataFrame, rules: QualityRules, text: str = "text") -> list[Column]:
    t = _text(docs, text)
    counts = let(ascii_words(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeat_words(w, rules.window).alias("n_repeat_words")))
    return [
        F.inline(F.array(counts)),
        F.length(_without(t, SPACES)).cast("long").alias("word_chars"),
        (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long").alias("n_symbols"),
        let(_word_lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ]


def _text_key(docs: DataFrame, text: str) -> Column:
    return F.xxhash64(_text(docs, text)).alias("body")


def document_lines(docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """One row per line of a document that holds a word: ``rk, host, body`` (hash
    of the text), ``line`` (hash of the normalised line) and its ``words``."""
    lines = F.transform(_word_lines(_text(docs, text)), _normal)
    hashed = let(lines, lambda n: F.transform(n, lambda x: F.struct(
        F.xxhash64(x).alias("line"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("words"))))
    placed = docs.select(row_key(docs[doc_id], docs[host], docs[text]).alias("rk"), docs[host].alias("host"),
                         _text_key(docs, text), F.explode(hashed).alias("x"))
    return placed.select("rk", "host", "body", "x.*")


def frequent_lines(lines: DataFrame, n_docs: DataFrame, rules: QualityRules) -> DataFrame:
    """``host, line`` above the limits.  Two levels of partial aggregation: the
    first key holds the text's hash too, so a line that a third of all documents
    share is spread over the tasks, and copies of a text count once."""
    counted = (lines.select("host", "line", "body").distinct()
               .groupBy("host", "line").agg(F.count("*").alias("docs"))
               .filter(F.col("docs") >= rules.min_line_docs))
    total = n_docs.withColumnRenamed("host", "of_host")
    return (counted.join(total, F.col("host").eqNullSafe(F.col("of_host")))
            .filter(F.col("docs") * 100 > F.col("host_docs") * rules.max_line_percent)
            .select(F.col("host").alias("f_host"), F.col("line").alias("f_line")))


def lines_above_limits(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text",
                       host: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """``rk, line, words`` of every document's lines that go."""
    lines = document_lines(docs, text, host, doc_id)
    n_docs = (docs.select(docs[host].alias("host"), _text_key(docs, text))
              .distinct().groupBy("host").agg(F.count("*").alias("host_docs")))
    frequent = frequent_lines(lines, n_docs, rules)
    return (lines.join(frequent, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("line") == F.col("f_line")))
            .select("rk", "line", "words"))


def quality_verdicts(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text",
                     host: str = "source", doc_id: str = "doc_id", above: DataFrame | None = None) -> DataFrame:
    """One row per document: ``rk``, its id, the base features, ``removed_words``,
    ``base_failed`` and ``kept``.  ``above``: the result of
    :func:`lines_above_limits`, where the caller has it."""
    above = lines_above_limits(docs, rules, text, host, doc_id) if above is None else above
    features = docs.select(row_key(docs[doc_id], docs[host], docs[text]).alias("rk"), docs[doc_id].alias("doc_id"),
                           *base_features(docs, rules, text))
    removed = (above.groupBy(F.col("rk").alias("r_rk")).agg(F.sum("words").alias("removed")))
    failed = ((F.col("n_words") < rules.min_words)
              | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
    left = F.col("n_words") - F.col("removed_words")
    return (features.join(removed, F.col("rk") == F.col("r_rk"), "left")
            .withColumn("removed_words", F.coalesce(F.col("removed"), F.lit(0)).cast("long"))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (100 * left >= rules.min_left_percent * F.col("n_words")))
            .drop("r_rk", "removed"))


def apply_quality(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text",
                  host: str = "source", doc_id: str = "doc_id", n_chars: str | None = "n_chars") -> DataFrame:
    """The kept documents, without the lines above the limits; all columns of
    ``docs`` (``n_chars`` is brought up to date where it exists)."""
    above = cut(lines_above_limits(docs, rules, text, host, doc_id))
    verdicts = quality_verdicts(docs, rules, text, host, doc_id, above)
    kept = (verdicts.filter("kept").groupBy(F.col("rk").alias("_q_rk"))
            .agg(F.max("removed_words").alias("_q_removed")))
    gone = (above.groupBy(F.col("rk").alias("_q_gone_rk")).agg(F.collect_set("line").alias("_q_lines")))
    cols = docs.columns
    keyed = docs.withColumn("_q_key", row_key(docs[doc_id], docs[host], docs[text]))
    joined = (keyed.join(kept.join(gone, F.col("_q_rk") == F.col("_q_gone_rk"), "left"),
                         F.col("_q_key") == F.col("_q_rk")))
    cleaned = F.when(F.col("_q_lines").isNull(), F.col(text)).otherwise(
        let(F.col("_q_lines"), lambda gone: F.array_join(F.filter(
            F.split(F.col(text), "\n"),
            lambda x: ~F.array_contains(gone, F.xxhash64(_normal(x)))), "\n")))
    joined = joined.withColumn("_q_text", cleaned)
    out = {text: F.col("_q_text")}
    if n_chars and n_chars in cols:
        out[n_chars] = F.when(F.col("_q_lines").isNull(), F.col(n_chars)).otherwise(
            F.length("_q_text").cast(docs.schema[n_chars].dataType))
    return joined.select(*[out.get(c, F.col(c)).alias(c) for c in cols])


#: DuckDB SQL for the query's rows with the default rules.
QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
reps AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx
         FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM wins) WHERE c > 1),
rep AS (SELECT doc_id, sum(least(8, coalesce(nx - i, 8)))::BIGINT AS n_repeat_words FROM reps GROUP BY 1),
base AS (
  SELECT d.doc_id, d.source, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)),
nl AS (
  SELECT doc_id, source, t, unnest(list_transform(ls, lambda x: lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))))) AS x FROM d),
dl AS (SELECT doc_id, source, t, x, sum(len(string_split(x, ' '))) AS words FROM nl GROUP BY ALL),
hd AS (SELECT source, count(DISTINCT t) AS host_docs FROM d GROUP BY 1),
freq AS (
  SELECT f.source, x FROM (SELECT source, x, count(DISTINCT t) AS docs FROM dl GROUP BY ALL) f
  JOIN hd ON f.source IS NOT DISTINCT FROM hd.source
  WHERE docs >= 3 AND docs * 100 > host_docs * 2),
gone AS (
  SELECT doc_id, sum(words)::BIGINT AS removed FROM dl JOIN freq ON dl.source IS NOT DISTINCT FROM freq.source AND dl.x = freq.x
  GROUP BY 1),
v AS (
  SELECT base.*, coalesce(removed, 0) AS removed_words,
         (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed
  FROM base LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words, base_failed,
       (NOT base_failed AND 100 * (n_words - removed_words) >= 30 * n_words) AS kept
FROM v
"""
