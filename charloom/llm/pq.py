"""Embedding near-duplicates by product quantisation.

A coarse quantiser deals unit vectors into inverted lists; what is left of a
vector beside its list's centroid is coded per subspace.  A vector visits its own
list and every list whose border it lies near (the distance to the hyperplane
between the two centroids is at most ``margin`` times the largest distance of a
linked pair) and meets all members there.  The two ends of a linked pair lie
together no farther from the border of their lists than from each other, so from
``margin`` 0.5 on one of them visits the other and no pair is missed.  Members'
codes are compared to visitors by table look-ups, with a bound that holds for
every linked pair, and what passes is decided by the exact cosine in double
precision.

Centroids and codebooks are fitted on a bounded sample (``sample`` vectors); all
vectors are indexed and compared.  Equal vectors are one class: copies cost one
row.  A list over ``tile`` vectors is dealt into tiles, its visitors into parts;
every tile meets every part.
No pairs leave a task: only counts and each vector's link to the smallest one it
reaches there.

Results in the odd cases: vectors that are null, empty or zero, or that hold null
or non-finite components, link with nothing; only vectors of the same length
link; rows with a null id keep their row and take no part; rows that repeat an
id and a vector are one vector with one row; an empty table gives an empty
result; extra columns are neither read nor returned.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from charloom.llm.common import cut, prepare
from charloom.llm.components import components, spanning_links


@dataclass(frozen=True)
class PqRules:
    cosine: float = 0.95
    subspaces: int = 8
    codes: int = 256
    sample: int = 16_384
    max_lists: int = 4096
    margin: float = 0.5
    tile: int = 4096
    seed: int = 5


def _kmeans(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    centroids = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        label = ((centroids ** 2).sum(1) - 2 * x @ centroids.T).argmin(1)
        n = np.bincount(label, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, label, x)
        centroids[n > 0] = total[n > 0] / n[n > 0, None]
    return centroids


class PqIndex:
    """Coarse centroids and residual codebooks; vectors are padded to ``width``."""

    def __init__(self, sample: np.ndarray, lists: int, width: int, rules: PqRules):
        rng = np.random.default_rng(rules.seed)
        self.rules, self.width = rules, width
        self.reach = math.sqrt(2 - 2 * rules.cosine)
        self.coarse = _kmeans(sample, lists, 8, rng)
        rest = sample - self.coarse[self._nearest(sample)[0]]
        self.sub = width // rules.subspaces
        self.books = [_kmeans(rest[:, m * self.sub:(m + 1) * self.sub], min(rules.codes, len(rest)), 6, rng)
                      for m in range(rules.subspaces)]
        self.between = np.sqrt(np.maximum(0, ((self.coarse[:, None] - self.coarse[None]) ** 2).sum(2)))

    def _nearest(self, x):
        d = (x ** 2).sum(1)[:, None] - 2 * x @ self.coarse.T + (self.coarse ** 2).sum(1)
        own = d.argmin(1)
        return own, d

    def encode(self, x: np.ndarray):
        """Own list, lists to meet, codes, and the least look-up value a linked vector can have."""
        own, d = self._nearest(x)
        meet = d - d[np.arange(len(x)), own][:, None] <= 2 * self.rules.margin * self.reach * self.between[own] + 1e-9
        meet[np.arange(len(x)), own] = True
        rest = x - self.coarse[own]
        codes = np.empty((len(x), self.rules.subspaces), np.uint8)
        coded = self.coarse[own].copy()
        for m, book in enumerate(self.books):
            part = slice(m * self.sub, (m + 1) * self.sub)
            codes[:, m] = ((book ** 2).sum(1) - 2 * rest[:, part] @ book.T).argmin(1)
            coded[:, part] += book[codes[:, m]]
        # q = x + e with |e| <= reach:  q.coded = q.x - (x + e).(x - coded)
        error = x - coded
        least = self.rules.cosine - (x * error).sum(1) - self.reach * np.sqrt((error ** 2).sum(1)) - 1e-9
        return own, meet, codes, least

    def look_up(self, queries: np.ndarray, lists: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric inner products of queries with coded vectors of one list."""
        out = np.repeat((queries @ self.coarse[lists])[:, None], len(codes), 1)
        for m, book in enumerate(self.books):
            out += (queries[:, m * self.sub:(m + 1) * self.sub] @ book.T)[:, codes[:, m]]
        return out


def _matrix(column, width: int) -> np.ndarray:
    """Unit vectors, padded to ``width``, from float64 bytes."""
    raw = [np.frombuffer(v, "<f8") for v in column.to_pylist()]
    x = np.zeros((len(raw), width))
    for i, v in enumerate(raw):
        x[i, :len(v)] = v
    return x / np.sqrt((x ** 2).sum(1))[:, None]


def _classes(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """One row per distinct usable vector: ``rep`` (smallest id), ``copies``, ``vec``, ``size``."""
    usable = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vec", lambda x: x != 0.0))
    return (usable.groupBy("vec", "vec_id").agg(F.count("*").alias("rows"))
            .groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
            .withColumn("size", F.size("vec")))


def embedding_links(classes: DataFrame, rules: PqRules = PqRules()) -> DataFrame:
    """``node, n, root``: per task's group, a class's linked vectors (copies
    counted) and the smallest member it is joined to there."""
    spark = classes.sparkSession
    kind = classes.schema["rep"].dataType.simpleString()
    count, width = classes.agg(F.count("*"), F.max("size")).first()
    if not count:
        return spark.createDataFrame([], f"node {kind}, n long, root {kind}")
    width = -(-width // rules.subspaces) * rules.subspaces
    sample = classes.orderBy(F.xxhash64("vec")).limit(rules.sample).select("vec").toPandas()["vec"]
    x = np.zeros((len(sample), width))
    for i, v in enumerate(sample):
        x[i, :len(v)] = v
    x /= np.sqrt((x ** 2).sum(1))[:, None]
    lists = max(1, min(rules.max_lists, len(x), math.ceil(math.sqrt(count) / 2)))
    sent = spark.sparkContext.broadcast(PqIndex(x, lists, width, rules))  # bounded by max_lists and codes

    def index(batches):
        ix = sent.value
        for b in batches:
            vecs = pa.array([np.asarray(v, "<f8").tobytes() for v in b.column(3).to_pylist()], pa.binary())
            own, meet, codes, least = ix.encode(_matrix(vecs, ix.width)) if b.num_rows else ([], [], np.zeros((0, 1), np.uint8), [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), vecs, pa.array(own, pa.int32()),
                 pa.array([np.flatnonzero(m) for m in meet], pa.list_(pa.int32())),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(least, pa.float64())],
                names=["rep", "copies", "size", "vec", "own", "meet", "codes", "least"])

    indexed = cut(classes.select("rep", "copies", "size", "vec").mapInArrow(
        index, f"rep {kind}, copies long, size int, vec binary, own int, meet array<int>, codes binary, least double")
        .withColumn("id", F.monotonically_increasing_id()))
    visits = indexed.withColumn("other", F.explode("meet"))
    # a row per list: bounded by max_lists
    members = indexed.groupBy("own").agg(F.count("*").alias("members"))
    visited = visits.groupBy(F.col("other").alias("m_list")).agg(F.count("*").alias("visitors"))
    part = F.greatest(F.lit(rules.tile // 4), F.least(F.lit(4 * rules.tile), 4 * F.col("members")))
    dealt = F.broadcast(cut(members.join(visited, F.col("own") == F.col("m_list")).select(
        "m_list", F.ceil(F.col("members") / rules.tile).cast("int").alias("tiles"),
        F.ceil(F.col("visitors") / part).cast("int").alias("parts"))))

    def place(n):
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    cols = ["list", "tile", "part", "size", "member", "id", "rep", "copies", "vec", "own", "meet", "codes", "least"]
    at_home = (indexed.join(dealt, F.col("own") == F.col("m_list")).withColumn("tile", place("tiles"))
               .withColumn("part", every("parts")).withColumn("list", F.col("own")).withColumn("member", F.lit(True)))
    away = (visits.join(dealt, F.col("other") == F.col("m_list")).withColumn("part", place("parts"))
            .withColumn("tile", every("tiles")).withColumn("list", F.col("other")).withColumn("member", F.lit(False))
            .drop("meet", "codes", "least").withColumn("meet", F.lit(None).cast("array<int>"))
            .withColumn("codes", F.lit(None).cast("binary")).withColumn("least", F.lit(None).cast("double")))
    met = at_home.select(cols).unionByName(away.select(cols))

    def compare(key, t):
        ix = sent.value
        here = key[0].as_py()
        t = t.combine_chunks()
        member = t["member"].to_numpy()
        left, right = np.flatnonzero(~member), np.flatnonzero(member)
        n, ends_a, ends_b = np.zeros(t.num_rows, np.int64), [], []
        if len(left) and len(right):
            x = _matrix(t["vec"], ix.width)
            ids, own, copies = t["id"].to_numpy(), t["own"].to_numpy(), t["copies"].to_numpy()
            home = t.filter(t["member"])
            least = home["least"].to_numpy()
            codes = np.frombuffer(b"".join(home["codes"].to_pylist()), np.uint8).reshape(len(right), -1)
            meets = np.zeros((len(right), len(ix.coarse)), bool)
            for at, m in enumerate(home["meet"].to_pylist()):
                meets[at, m] = True
            step = max(1, (1 << 20) // len(right))
            for at in range(0, len(left), step):
                rows = left[at:at + step]
                i, j = np.nonzero(ix.look_up(x[rows], here, codes) >= least)
                p, q = rows[i], right[j]
                # once a pair: in one list by the ids; if both visit, in the smaller list
                once = np.where(own[p] == here, ids[p] < ids[q], (own[p] > here) | ~meets[j, own[p]])
                p, q = p[once], q[once]
                for s in range(0, len(p), 1 << 15):
                    u, v = p[s:s + (1 << 15)], q[s:s + (1 << 15)]
                    linked = np.einsum("ij,ij->i", x[u], x[v]) >= ix.rules.cosine
                    u, v = u[linked], v[linked]
                    np.add.at(n, u, copies[v])
                    np.add.at(n, v, copies[u])
                    ends_a.append(u)
                    ends_b.append(v)
        a = np.concatenate(ends_a) if ends_a else np.zeros(0, int)
        b = np.concatenate(ends_b) if ends_b else np.zeros(0, int)
        root = spanning_links(t.num_rows, a, b)
        out = pa.array(np.flatnonzero(n))
        rep = t["rep"].combine_chunks()
        return pa.table({"node": rep.take(out), "n": pa.array(n[n > 0]), "root": rep.take(pa.array(root[n > 0]))})

    return met.groupBy("list", "tile", "part", "size").applyInArrow(compare, f"node {kind}, n long, root {kind}")


def embedding_components(vectors: DataFrame, rules: PqRules = PqRules(), vec_id: str = "vec_id",
                         embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per vector."""
    prepare(vectors.sparkSession)
    classes = cut(_classes(vectors, vec_id, embedding))
    found = cut(embedding_links(classes, rules))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("node").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "r_node")
    told = (classes.join(counts, F.col("rep") == F.col("node"), "left").join(roots, F.col("rep") == F.col("r_node"), "left")
            .select("vec", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.coalesce("root", "rep").alias("component_id")))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("of"))
    rows = rows.groupBy("vec_id", "of").agg(F.count("*").alias("rows")).drop("rows")
    return (rows.join(told, (F.col("of") == F.col("vec")) & F.col("vec_id").isNotNull(), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
