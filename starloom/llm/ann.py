"""Approximate nearest neighbours by an adaptive dimension scan of inverted lists.

Unit vectors are turned by a random rotation, so that any block of their dimensions is a
fair sample of the distance.  Lists around sampled centroids hold every vector; a query
probes its nearest lists.  Within a list the distance is summed block of dimensions by
block, and after each block a pair is given up once its partial distance says, at the
test's significance, that it exceeds the query's best so far.  The pairs that come through
are scored exactly on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.sources.scratch import Workspace


@dataclass(frozen=True)
class Index:
    """Parameters.  Centroids are fitted on at most ``sample`` vectors, those with the
    smallest hashes of their ids; all vectors are in the lists."""

    sample: int = 8192
    lists: int = 128
    probes: int = 72
    block_dims: int = 16
    epsilon: float = 2.1
    list_rows: int = 4096
    query_rows: int = 512
    seed: int = 11


def rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def centroids(units: np.ndarray, lists: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means of a bounded sample."""
    random = np.random.default_rng(seed)
    centers = units[random.choice(len(units), min(lists, len(units)), replace=False)]
    for _ in range(rounds):
        near = np.argmax(units @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, units)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(size > 0, sums / np.maximum(size, 1e-300), centers)
    return centers


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of row pairs, summed dimension by dimension: equal rows give equal bits."""
    dot, aa, bb = (np.zeros(len(a)) for _ in range(3))
    for d in range(a.shape[1]):
        dot += a[:, d] * b[:, d]
        aa += a[:, d] * a[:, d]
        bb += b[:, d] * b[:, d]
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def adaptive_scan(
    queries: np.ndarray, rows: np.ndarray, best: int, block_dims: int, epsilon: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) that may be among a query's ``best`` nearest of these rows.

    All vectors are rotated units.  From d of D dimensions the distance is estimated as
    D / d times the partial one; a pair is rejected when its square root exceeds the bound
    by more than epsilon / sqrt(d) of it.  The bound is the query's best-th smallest
    distance among the rows' first few, computed in full.
    """
    dims = rows.shape[1]
    first = rows[: max(8 * best, 64)]
    full = 2 - 2 * queries @ first.T
    k = min(best, full.shape[1]) - 1
    bound = np.partition(full, k, axis=1)[:, k] if full.shape[1] >= best else np.full(len(queries), np.inf)
    bound = np.maximum(bound, 0) + 1e-9
    partial = np.zeros((len(queries), len(rows)))
    # One block for all pairs at once, the later ones for those still alive.
    q, r = queries[:, :block_dims], rows[:, :block_dims]
    partial = (q * q).sum(1)[:, None] + (r * r).sum(1)[None, :] - 2 * q @ r.T
    alive = partial * (dims / block_dims) <= (bound * (1 + epsilon / block_dims**0.5) ** 2)[:, None]
    i, j = np.nonzero(alive)
    sums = partial[i, j]
    for d in range(block_dims, dims, block_dims):
        end = min(d + block_dims, dims)
        gap = queries[i, d:end] - rows[j, d:end]
        sums = sums + (gap * gap).sum(axis=1)
        slack = 1.0 if end == dims else (1 + epsilon / end**0.5) ** 2 * end / dims
        keep = sums <= bound[i] * slack + 1e-9
        i, j, sums = i[keep], j[keep], sums[keep]
    return i, j


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec, v): vectors of finite numbers that are not all zero."""
    v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vectors.select(F.col(f"`{key}`").alias("vec"), v.alias("v")).filter(
        F.col("v").isNotNull() & F.forall("v", fine) & F.exists("v", lambda x: x != 0)
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 1))


def _units(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def search(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50,
    best: int = 5, index: Index = Index(),
) -> DataFrame:
    """For each vector whose key is divisible by ``every``, its ``best`` nearest others.

    Nearness is the cosine in double precision, ties go to the smaller key.  Vectors that
    are null, zero, or hold null or non-finite numbers take no part, nor do null keys;
    vectors of a length other than most of the sample take no part either.  Of vectors that
    are equal, the best + 1 smallest keys suffice as candidates, as all others come after
    them for any query; so a vector that very many rows share burdens no list.  Rows that
    repeat a key are one.
    """
    spark, work = vectors.sparkSession, Workspace(vectors.sparkSession, "ann")
    rows = usable(vectors, key, vector).filter("vec IS NOT NULL")
    picked = rows.orderBy(F.xxhash64("vec", F.lit(1)), "vec").limit(index.sample).collect()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not picked:
        return spark.createDataFrame([], schema)
    sizes = [len(r["v"]) for r in picked]
    dims = max(set(sizes), key=lambda n: (sizes.count(n), -n))
    turn = rotation(dims, index.seed)
    sample = _units(np.array([r["v"] for r in picked if len(r["v"]) == dims])) @ turn
    centers = centroids(sample, index.lists, index.seed)
    probes = min(index.probes, len(centers))

    def listed(count: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                near = _units(_matrix(batch.column(1).to_pandas())) @ turn @ centers.T
                order = np.argsort(-near, axis=1, kind="stable")[:, :count]
                place = np.repeat(np.arange(batch.num_rows), count)
                taken = batch.take(pa.array(place))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(order.ravel().astype(np.int32)), *taken.columns], ["list", "vec", "v"]
                )

        return run

    listing = "list int, vec bigint, v array<double>"
    rows = rows.filter(F.size("v") == dims).select(F.col("vec").cast("bigint").alias("vec"), "v")
    copies = W.partitionBy("v").orderBy("vec")
    candidates = rows.dropDuplicates(["vec", "v"]).withColumn("nth", F.row_number().over(copies)).filter(
        F.col("nth") <= best + 1
    )
    queries = rows.filter(F.col("vec") % every == 0).dropDuplicates(["vec"])
    lists = work.stage(candidates.select("vec", "v").mapInArrow(listed(1), listing), "lists")
    probed = work.stage(queries.mapInArrow(listed(probes), listing), "probed")
    # At most one row per list: how many parts its rows and its queries are dealt into.
    parts = (
        lists.groupBy("list").agg(F.ceil(F.count("*") / index.list_rows).cast("int").alias("row_parts"))
        .join(
            probed.groupBy("list").agg(F.ceil(F.count("*") / index.query_rows).cast("int").alias("query_parts")),
            "list",
        )
    )
    parts = F.broadcast(work.stage(parts, "parts"))
    row_part = F.pmod(F.xxhash64("vec", F.lit(2)), F.col("row_parts")).cast("int")
    query_part = F.pmod(F.xxhash64("vec", F.lit(3)), F.col("query_parts")).cast("int")
    # Each part of a list meets each part of its queries in a task of its own.
    left = lists.join(parts, "list").select(
        "list", row_part.alias("rp"),
        F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)).alias("qp"), "vec", "v",
    )
    right = probed.join(parts, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("row_parts") - 1)).alias("rp"),
        query_part.alias("qp"), "vec", "v",
    )
    block_dims, epsilon = index.block_dims, index.epsilon

    def scan(mine: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if not len(mine) or not len(asked):
            return empty.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        mine = mine.sort_values("vec", kind="stable")
        a, b = _matrix(asked["v"]), _matrix(mine["v"])
        # One more than asked for, as a query may meet itself.
        i, j = adaptive_scan(_units(a) @ turn, _units(b) @ turn, best + 1, block_dims, epsilon)
        asked_ids, ids = asked["vec"].to_numpy(), mine["vec"].to_numpy()
        other = asked_ids[i] != ids[j]
        i, j = i[other], j[other]
        found = pd.DataFrame({"query_id": asked_ids[i], "vec_id": ids[j], "score": exact_cosine(a[i], b[j])})
        found = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return found.groupby("query_id", sort=False).head(best)

    by = ("list", "rp", "qp")
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(
        scan, "query_id bigint, vec_id bigint, score double"
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= best)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
