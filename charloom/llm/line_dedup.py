"""Line dedup by a suffix array over line ids (DataFrame functions only).

The corpus is the sequence of the texts' lines that hold a word.  The lines that
occur once end every repeat and take no part; the others get places in corpus
order, so that the line after place p of the same stretch of neighbouring lines
has place p + 1.  Prefix doubling names the class of every suffix by its first 2,
4, 8, ... lines, from the names of its two halves, by the class's first place:
the suffixes of a class are one interval of the suffix array whose common prefix
is at least that long.  The names tell the intervals apart, which is all that is
asked of the array here; the order of the intervals among each other is not
computed.  Two overlapping names tell the interval of any length between.

For every line the shortest run from it on, and the shortest up to it, with
``min_words`` words are looked up so: the runs whose interval begins at an earlier
place are later copies, and together they cover every maximal repeated run of
``min_words`` words or more, however long, as each of its lines lies in such a
run.  All lines of later copies are deleted; the first copy stays.  Where a run
overlaps its own copy (lines that repeat with a period of d lines, such as one line
many times), the copies begin d lines after the first, so the first d lines stay.

Doubling ends at the longest of these runs, at most ``min_words`` lines.  Texts
are read and split once; after that only places and names (longs) are joined and
grouped.  Groups with more than 1/4096 of all places, fewer than 4,096 of them, get
their names by a broadcast, the others by a shuffle, so no task holds a hot line.

Results in the odd cases: lines are told apart byte by byte; blank lines carry no
id and go with the line before them (blank lines that begin a text stay); null
and empty texts are returned as they are; places follow doc id (nulls first),
then text; rows that repeat an id and a text are one document, so one is not a
copy of the other, and both get the same text; extra columns are passed through
by :func:`dedup_lines`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from charloom.llm.common import SPACES, cut, let, row_key, word_count

#: groups with more than this part of all rows are hot; there are fewer than its inverse
HOT_PARTS = 4096


@dataclass(frozen=True)
class LineRules:
    #: a run is deleted if it has at least so many words
    min_words: int = 51


def _lines(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``id, rk, at, line, words``: lines with a word; ``id, rk`` order documents and
    name them, ``at`` counts such lines.  Keys are made before lines are told
    apart: an expression beside a generator is evaluated for every line."""
    own = F.filter(F.split(docs[text], "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    rows = docs.select(docs[doc_id].alias("id"), F.unhex(row_key(docs[doc_id], docs[text])).alias("rk"), own.alias("lines"))
    return rows.select("id", "rk", F.posexplode("lines").alias("at", "line")).select(
        "id", "rk", "at", F.unhex(F.md5("line")).alias("line"), word_count(F.col("line")).cast("long").alias("words"))


def _named(rows: DataFrame, groups: DataFrame, by: list[str], total: int) -> DataFrame:
    """``rows`` with the other columns of their group, for rows that have one;
    ``members`` of a group tells hot ones, which are broadcast (a proven bound)."""
    fewer = groups.drop("members")
    more = [c for c in fewer.columns if c not in by]
    hot = F.broadcast(groups.filter(F.col("members") * HOT_PARTS > total).drop("members").withColumn("hot", F.lit(True)))
    dealt = rows.join(hot, by, "left")
    rest = dealt.filter("hot is null").drop("hot", *more)
    light = groups.filter(F.col("members") * HOT_PARTS <= total).drop("members")
    return dealt.filter("hot").drop("hot").unionByName(rest.join(light.hint("merge"), by))


def _classes(rows: DataFrame, by: list[str], name: str, total: int) -> DataFrame:
    """``rows`` with ``name``: the first place of their class, for classes of two or more."""
    rows = cut(rows)
    firsts = cut(rows.groupBy(*by).agg(F.min("place").alias(name), F.count("*").alias("members")).filter("members > 1"))
    return _named(rows, firsts, by, total)


def _places(docs: DataFrame, rules: LineRules, text: str, doc_id: str) -> DataFrame:
    """Lines that occur elsewhere too, in corpus order: ``place``; ``rk, at``; the
    line's ``rank`` (a name); ``left``, how many lines its stretch has from it on;
    ``ahead`` and ``back``, the lines of the shortest runs of ``min_words`` words from
    it on and up to it (null where the stretch is too short)."""
    lines = cut(_lines(docs, text, doc_id))
    often = cut(lines.groupBy("line").agg(F.count("*").alias("members")).filter("members > 1")
                .withColumn("rank", F.monotonically_increasing_id()))
    total = often.agg(F.sum("members")).first()[0] or 0
    rows = _named(lines, often, ["line"], total).drop("line")
    # a document's lines stay together: they came from one row
    in_doc = Window.partitionBy("id", "rk").orderBy("at")
    once = (rows.repartitionByRange("id", "rk").withColumn("before", F.lag("at").over(in_doc))
            .filter("before is null or before < at"))
    stretches = once.withColumn("stretch", F.col("at") - F.row_number().over(in_doc))
    whole = Window.partitionBy("id", "rk", "stretch")
    n = rules.min_words
    summed = (stretches.withColumn("upto", F.sum("words").over(whole.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("start", F.col("upto") - F.col("words"))
              .withColumn("sum", F.sum("words").over(whole)).withColumn("last", F.max("at").over(whole)))
    # lines that start fewer than n words after this one starts; lines that end fewer than n before it ends
    ahead = F.count("*").over(whole.orderBy("start").rangeBetween(0, n - 1))
    back = F.count("*").over(whole.orderBy("upto").rangeBetween(1 - n, 0))
    runs = (summed.withColumn("ahead", F.when(F.col("sum") - F.col("start") >= n, ahead))
            .withColumn("back", F.when(F.col("upto") >= n, back)))
    return cut(runs.sortWithinPartitions("id", "rk", "at").select(
        F.monotonically_increasing_id().alias("place"), "rk", "at", "rank",
        (F.col("last") - F.col("at") + 1).alias("left"), "ahead", "back"))


def repeated_lines(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``rk, at``: the lines of later copies."""
    places = _places(docs, rules, text, doc_id)
    total, longest = places.agg(F.count("*"), F.max(F.greatest("ahead", "back"))).first()
    levels, span = [places.select(F.lit(1).alias("span"), "place", "left", "rank")], 1
    while 2 * span <= (longest or 0):
        here = levels[-1]
        after = here.select((F.col("place") - span).alias("place"), F.col("rank").alias("next"))
        pairs = here.filter(F.col("left") >= 2 * span).join(after.hint("merge"), "place")
        span *= 2
        levels.append(cut(_classes(pairs, ["rank", "next"], "longer", total).select(
            F.lit(span).alias("span"), "place", "left", F.col("longer").alias("rank"))))
    return _later_copies(places, reduce(DataFrame.union, levels), span, total)


def _later_copies(places: DataFrame, levels: DataFrame, widest: int, total: int) -> DataFrame:
    """The lines of runs whose interval has an earlier member."""
    runs = (places.filter("ahead is not null").select("place", F.col("ahead").alias("n"))
            .union(places.filter("back is not null").select(F.col("place") - F.col("back") + 1, "back")).distinct())
    # the widest level within the run: its first and its last `span` lines overlap or meet, and name it
    spans = [1 << i for i in range(widest.bit_length())]
    runs = runs.withColumn("span", F.greatest(F.lit(1), *[F.when(F.col("n") >= s, F.lit(s)) for s in spans]))
    head = levels.select("span", "place", F.col("rank").alias("head"))
    tail = levels.select("span", F.col("place").alias("end"), F.col("rank").alias("tail"))
    named = (runs.join(head.hint("merge"), ["span", "place"]).withColumn("end", F.col("place") + F.col("n") - F.col("span"))
             .join(tail.hint("merge"), ["span", "end"]).select("place", "n", "head", "tail"))
    later = _classes(named, ["n", "head", "tail"], "first", total).filter("place > first")
    gone = later.select(F.explode(F.sequence("place", F.col("place") + F.col("n") - 1)).alias("place")).distinct()
    return places.select("place", "rk", "at").join(gone.hint("merge"), "place").select("rk", "at")


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines ``gone`` (numbers of lines with a word) and the
    blank lines after them, in time linear in its lines."""
    def rest(lines: Column) -> Column:
        # where the lines with a word stand among all lines
        stand = F.filter(F.transform(lines, lambda x, i: F.when(F.btrim(x, F.lit(SPACES)) != "", i)), lambda i: i.isNotNull())

        def kept(stand: Column) -> Column:
            gaps = F.transform(gone, lambda k: F.sequence(F.get(stand, k), F.coalesce(F.get(stand, k + 1), F.size(lines)) - 1))
            return F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.flatten(gaps))

        return F.array_join(F.transform(let(stand, kept), lambda i: F.get(lines, i)), "\n")

    return let(F.split(text, "\n"), rest)


def dedup_lines(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text", doc_id: str = "doc_id",
                n_chars: str | None = "n_chars", counts: bool = False) -> DataFrame:
    """``docs`` without the later copies of repeated line runs (all columns, every
    row; ``n_chars`` is brought up to date where it exists).  ``counts`` adds
    ``_l_removed``, the number of lines with a word that went."""
    gone = (repeated_lines(docs, rules, text, doc_id).groupBy(F.col("rk").alias("_l_rk"))
            .agg(F.sort_array(F.collect_list("at")).alias("_l_gone")))
    joined = docs.withColumn("_l_key", F.unhex(row_key(docs[doc_id], docs[text]))).join(gone, F.col("_l_key") == F.col("_l_rk"), "left")
    new = F.when(F.col("_l_gone").isNull(), F.col(text)).otherwise(_without(F.col(text), F.col("_l_gone")))
    joined = joined.withColumn("_l_text", new)
    out = {text: F.col("_l_text")}
    if n_chars and n_chars in docs.columns:
        out[n_chars] = F.when(F.col("_l_gone").isNull(), F.col(n_chars)).otherwise(
            F.length("_l_text").cast(docs.schema[n_chars].dataType))
    more = [F.coalesce(F.size("_l_gone"), F.lit(0)).cast("long").alias("_l_removed")] if counts else []
    return joined.select(*[out.get(c, F.col(c)).alias(c) for c in docs.columns], *more)


def dedup_digest(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_removed, n_chars, text_md5`` (of the text that is left) per row."""
    left = dedup_lines(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), rules, counts=True)
    return left.select("doc_id", F.col("_l_removed").alias("n_removed"), F.length("text").cast("long").alias("n_chars"),
                       F.md5("text").alias("text_md5"))


#: DuckDB SQL for the digest with the default rules, by all pairs of equal lines.
LINE_SQL = r"""
WITH l AS (
  SELECT doc_id, i, x, sum(CASE WHEN w > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos, w
  FROM (SELECT doc_id, i, x, len(list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) AS w
        FROM (SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS x
              FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))),
k AS (SELECT doc_id, pos, x, w FROM l WHERE w > 0),
pairs AS (
  SELECT a.doc_id AS d, a.pos AS p, a.w, b.doc_id AS e, b.pos AS q
  FROM k a JOIN k b ON a.x = b.x AND (b.doc_id, b.pos) < (a.doc_id, a.pos)),
islands AS (
  SELECT *, p - row_number() OVER (PARTITION BY d, e, p - q ORDER BY p) AS island FROM pairs),
runs AS (
  SELECT d, p, sum(w) OVER (PARTITION BY d, e, p - q, island) AS words FROM islands),
gone AS (SELECT DISTINCT d AS doc_id, p AS pos FROM runs WHERE words >= 51),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY 1),
keep AS (
  SELECT l.doc_id, string_agg(l.x, chr(10) ORDER BY l.i) AS t FROM l LEFT JOIN gone USING (doc_id, pos)
  WHERE gone.doc_id IS NULL GROUP BY 1)
SELECT documents.doc_id, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN text IS NOT NULL THEN length(coalesce(t, ''))::BIGINT END AS n_chars,
       CASE WHEN text IS NOT NULL THEN md5(coalesce(t, '')) END AS text_md5
FROM documents LEFT JOIN keep USING (doc_id) LEFT JOIN n USING (doc_id)
"""
