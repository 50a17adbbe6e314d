"""Centroid clustering of integer vectors with scalar lookup tables.

*Vectors.* Component x becomes the integer floor(64 x). Vectors of exactly ``DIMENSIONS`` components,
none null, infinite or not a number, are kept and written once as lists of integers.

*Tables.* All arithmetic is in integers, and a component only takes as many values as occur. In
every round each batch of vectors tabulates, for each dimension, the squared difference between
every integer that occurs there and every centroid; a vector's distance to all centroids is then the
sum of one gathered table row per dimension, no multiplication per vector. The tables live for one
batch, so memory depends on the batch and not on how many integers the corpus holds.

*Rounds.* Tasks return one row per centroid with the exact sums and count of the vectors nearest to
it (ties: smaller number); these are added up and the new centroids, floor(sum / count), are the only
thing that reaches the driver: ``CLUSTERS`` rows a round. A cluster with a third of all vectors costs
no more than any other, as no vector is ever shuffled. The last assignment is written, and the
inertia is summed from it.

Defined cases: rows with a null or unfit ``embedding`` are left out; a null ``vec_id`` is kept and
stands as empty text in the starting order; rows with the same ``vec_id`` are vectors of their own, of
equal hashes the smaller vector comes first; fewer kept vectors than ``CLUSTERS`` give fewer centroids;
an empty table gives an empty result; other columns are ignored. Integers beyond ``LIMIT`` would
overflow a 64-bit distance: they raise an error instead of giving a wrong one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.rows import stored

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
LIMIT = 1 << 26
SLICE = 8192  # vectors whose tables are made at a time


def integers(embeddings: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """``vec_id`` and ``v``, the integers of every kept vector."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    fit = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where((F.size("embedding") == dimensions) & ~fit)
    return rows.select("vec_id", F.transform(x, lambda e: F.floor(e * float(SCALE)).cast("bigint")).alias("v"))


def starting(vectors: DataFrame, clusters: int = CLUSTERS) -> np.ndarray:
    """The first centroids: vectors with the smallest hashes of their ids."""
    mark = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(clusters).collect()
    return np.array([r["v"] for r in first], np.int64)


def distances(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (vectors x centroids), gathered from one table per dimension."""
    out = np.zeros((len(v), len(centroids)), np.int64)
    for d in range(v.shape[1]):
        values, at = np.unique(v[:, d], return_inverse=True)
        table = (values[:, None] - centroids[:, d]) ** 2
        out += table[at]
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of bounded length and their vectors as a matrix."""
    for batch in batches:
        for s in range(0, len(batch), SLICE):
            part = batch.slice(s, SLICE)
            v = part.column("v").flatten().to_numpy().reshape(len(part), -1)
            if np.abs(v).max() > LIMIT:
                raise ValueError(f"components beyond {LIMIT // SCALE} do not fit 64-bit distances")
            yield part, v


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; a cluster without vectors stays where it is."""
    k, n = centroids.shape
    names = [f"s{d}" for d in range(n)]

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.zeros((k, n), np.int64), np.zeros(k, np.int64)
        for _, v in _slices(batches):
            near = distances(v, centroids).argmin(1)
            order = np.argsort(near, kind="stable")
            hit, first = np.unique(near[order], return_index=True)
            sums[hit] += np.add.reduceat(v[order], first)
            count += np.bincount(near, minlength=k)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(count), *[pa.array(c) for c in np.ascontiguousarray(sums.T)]], names=["cluster", "n", *names])

    parts = vectors.select("v").mapInArrow(fn, "cluster int, n bigint, " + ", ".join(f"{s} bigint" for s in names))
    # sums of sums as decimals: exact for any number of vectors
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in names])
    out = centroids.copy()
    for r in total.where("n > 0").collect():
        out[r["cluster"]] = [int(r[s]) // r["n"] for s in names]
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and squared ``distance`` of every vector."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, v in _slices(batches):
            far = distances(v, centroids)
            near = far.argmin(1)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(v)), near])], names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(fn, "vec_id bigint, cluster int, distance bigint")


def clustered(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> DataFrame:
    """One row per kept vector: its cluster, distance, inertias and the digest of its final centroid."""
    vectors = stored(integers(embeddings, dimensions), "integer-vectors")
    centroids = starting(vectors, clusters)
    if len(centroids):
        for _ in range(rounds):
            centroids = moved(vectors, centroids)
        out = stored(assigned(vectors, centroids), "assigned")
    else:
        out = vectors.selectExpr("vec_id", "0 as cluster", "0L as distance")
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    inertia = {r["cluster"]: r["s"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [(k, inertia.get(k, 0), sum(inertia.values()), d) for k, d in enumerate(digest)]
    # one row per centroid
    facts = out.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return out.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> str:
    """The same in SQL: vectors by component, one centroid table per round."""
    steps = []
    near = """a{k} AS MATERIALIZED (SELECT id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT e.id, z.c, sum((e.v - z.v) * (e.v - z.v)) AS d FROM e JOIN c{k} z ON z.i = e.i GROUP BY e.id, z.c) GROUP BY id)"""
    for k in range(rounds + 1):
        steps.append(near.format(k=k))
        if k < rounds:
            steps.append(f"""m{k} AS (SELECT a.c, e.i, sum(e.v)::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{k} a JOIN e ON e.id = a.id GROUP BY a.c, e.i),
    c{k + 1} AS MATERIALIZED (SELECT z.c, z.i, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, z.v)::BIGINT AS v FROM c{k} z LEFT JOIN m{k} m ON m.c = z.c AND m.i = z.i)""")
    body = ",\n    ".join(steps)
    return f"""WITH kept AS (SELECT vec_id, embedding, row_number() OVER () AS id FROM embeddings
        WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    w AS (SELECT id, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM kept),
    e AS MATERIALIZED (SELECT id, unnest(v) AS v, unnest(range(1, {dimensions + 1})) AS i FROM w),
    s AS (SELECT id, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c FROM w),
    c0 AS MATERIALIZED (SELECT s.c, e.i, e.v FROM s JOIN e ON e.id = s.id WHERE s.c < {clusters}),
    {body},
    h AS (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY i)) AS sha FROM c{rounds} GROUP BY c)
SELECT w.vec_id, a.c::INTEGER AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
    (sum(a.d) OVER ())::BIGINT AS inertia, h.sha AS centroid_sha256
FROM a{rounds} a JOIN w ON w.id = a.id JOIN h ON h.c = a.c"""


ORACLE = oracle()
