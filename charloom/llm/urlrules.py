"""URL filter rules by a sort-merge range join.

A host's canonical key is its labels in reverse, each closed by a dot
(``a.example.org`` -> ``org.example.a.``): a host and all its subdomains are the
keys of one interval, the key's prefix range, and such intervals nest or are
disjoint.  Pages are sorted by key inside their partitions (no exchange: no host
is too frequent) and swept along the sorted rules; a stack holds the rules whose
interval the sweep is in, so a page meets exactly the rules of its host's
suffixes, and takes the longest of those whose path its own path starts with.

Rules are a control list.  They are swept in blocks of a fixed number, each sent
to the tasks in turn, so neither the driver nor a task holds more than a block
at a time, and a block's verdict only gives way to a longer rule.

Results in the odd cases: a null url, or one without ``://``, has an empty host
and path and fits no rule; of two rules with the same host and path, ``block``
holds; a rule with a null host or path fits nothing; repeated pages and null ids
are carried through row by row; extra columns are neither read nor returned.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from charloom.llm.common import prepare


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # "allow" or "block"
    host: str
    path: str


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_key(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _python_key(host: str) -> str:
    return "".join(label + "." for label in reversed(host.split(".")))


class Sweep:
    """The rules of a block in key order, and the stack of those that are active."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        hosts: dict[str, dict[str, tuple[str, str]]] = {}
        for verdict, host, path in rules:
            paths = hosts.setdefault(_python_key(host), {})
            if paths.get(path, ("allow",))[0] != "block":
                paths[path] = (verdict, host + path)
        # in the byte order of UTF-8, which is Spark's order of strings
        self.starts = sorted(((k.encode(), p) for k, p in hosts.items()), key=lambda x: x[0])
        self.lengths = {k: sorted({len(x) for x in p}, reverse=True) for k, p in self.starts}
        self.next, self.stack = 0, []

    def best(self, key: bytes, path: str) -> tuple[str, str] | None:
        """The longest fitting rule for the next key in order."""
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()
        while self.next < len(self.starts) and self.starts[self.next][0] <= key:
            if key.startswith(self.starts[self.next][0]):
                self.stack.append(self.starts[self.next])
            self.next += 1
        found = None
        for start, paths in self.stack:
            for n in self.lengths[start]:
                rule = paths.get(path[:n]) if len(path) >= n else None
                if rule and (found is None or len(rule[1]) >= len(found[1])):
                    found = rule
                    break
        return found


def _sweep_block(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    sent = pages.sparkSession.sparkContext.broadcast(rules)  # one block: bounded

    def run(batches):
        sweep = Sweep(sent.value)
        for b in batches:
            columns = b.to_pydict()
            rule, verdict = columns["rule"], columns["verdict"]
            for i, (key, path) in enumerate(zip(columns["url_key"], columns["path"])):
                found = sweep.best(key.encode(), path) if key else None
                if found and (rule[i] is None or len(found[1]) > len(rule[i])
                              or len(found[1]) == len(rule[i]) and found[0] == "block"):
                    verdict[i], rule[i] = found
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-2], pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=b.schema.names)

    return pages.mapInArrow(run, pages.schema)


def judge_urls(pages: DataFrame, rules, url: str = "url", page_id: str = "page_id", default: str = "allow",
               block_rows: int = 200_000) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.  ``rules``: an iterable
    of :class:`UrlRule` or a DataFrame of verdict, host, path.  A page that no
    rule fits has rule null and the ``default`` verdict."""
    prepare(pages.sparkSession)
    out = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"),
                       path_of(F.col(url)).alias("path"))
    out = (out.withColumn("url_key", reversed_key(F.col("host"))).sortWithinPartitions("url_key")
           .withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(None).cast("string")))
    if isinstance(rules, DataFrame):
        rows = ((r[0], r[1], r[2]) for r in rules.select("verdict", "host", "path").toLocalIterator())
    else:
        rows = ((r.verdict, r.host, r.path) for r in rules)
    rows = (r for r in rows if None not in r)
    while block := list(islice(rows, block_rows)):
        out = _sweep_block(out, block)
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


#: The rules of the registered query.
PAGE_RULES = (UrlRule("allow", "org", "/"), UrlRule("block", "example.org", "/es/"),
              UrlRule("block", "example.org", "/en/1"), UrlRule("allow", "com", "/fr/"),
              UrlRule("block", "com", "/de/"))

URL_SQL = r"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
     ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
f AS (SELECT page_id, host, path, rhost || rpath AS rule, verdict FROM u JOIN r
      ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
b AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) = 1)
SELECT u.page_id, u.host, u.path, b.rule, coalesce(b.verdict, 'allow') AS verdict FROM u LEFT JOIN b USING (page_id)
"""
