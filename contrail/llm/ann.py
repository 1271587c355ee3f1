"""Approximate nearest neighbours by multi-index hashing.

Codes: vectors are centred and projected on their principal axes, and ROTATIONS learned rotations (each
found by alternating between signs and the rotation that best fits them) give dims bits each. The model
and the search radius are fitted on a bounded sample (FIT_ROWS); every row is indexed.

Index: a block of rows keeps their codes and, for each 16-bit substring of the code, the rows in
order of the substring's value. By the pigeonhole principle a code within RADIUS bits of the
query's differs from it by at most floor(radius / substrings) bits in some substring, so probing
these values in every substring finds all of them. Found codes are checked against the whole radius, and those
that pass are ranked by their float distance, exact in double precision.

Blocks of rows meet blocks of queries (a stated part of all rows) as units of work; a unit returns
its nearest K for each query, and a grouped merge takes the nearest of all units. A query with fewer than K
found in a block's radius takes the rest from the whole block, so small inputs give full results.

Vectors that are null, zero or hold null or non-finite components take no part, nor do rows with a null
id or with another number of components than most. Repeated rows of one id count as one, its least vector; they are
reduced before rows are dealt into blocks, each task to one row an id, so no block grows with them. Equal
distances go to the smaller id. An empty table, or no query, gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.labelled import bounded_sample
from contrail.llm.staging import staged
from contrail.llm.textvec import prepare

K, QUERY_EVERY = 10, 100
#: Rows that the rotations and the radius are fitted on.
FIT_ROWS = 4_000
ROTATIONS, SUBSTRING_BITS = 4, 16
#: Share of a sample's true neighbours that lie within the radius.
RADIUS_SHARE = 0.98
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 1_024
_FIT_ROUNDS, _SAMPLE_QUERIES = 15, 200


@dataclass
class Codes:
    mean: np.ndarray
    axes: np.ndarray  # dims by bits: all rotations side by side
    radius: int

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Rows of 16-bit substrings."""
        bits = (x - self.mean) @ self.axes > 0
        pad = -bits.shape[1] % SUBSTRING_BITS
        bits = np.hstack((bits, np.zeros((len(bits), pad), bool))) if pad else bits
        return np.packbits(bits, axis=1).view(">u2").astype(np.uint16)


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distance of one vector to each row, in double precision."""
    d = x - q
    return np.sqrt((d * d).sum(1))


def fit(x: np.ndarray, seed: int = 5) -> Codes:
    """Rotations on the sample, and the radius that holds RADIUS_SHARE of its own true neighbours."""
    rng = np.random.default_rng(seed)
    mean = x.mean(0)
    c = x - mean
    dims = x.shape[1]
    _, vectors = np.linalg.eigh(c.T @ c)
    v = c @ vectors
    axes = []
    for _ in range(ROTATIONS):
        r, _ = np.linalg.qr(rng.normal(size=(dims, dims)))
        for _ in range(_FIT_ROUNDS):
            u, _, w = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        axes.append(vectors @ r)
    codes = Codes(mean, np.hstack(axes), 0)
    own = codes.encode(x)
    radii = []
    for q in range(min(_SAMPLE_QUERIES, len(x))):
        d = distances(x[q], x)
        d[q] = np.inf
        near = np.argsort(d, kind="stable")[: min(K, len(x) - 1)]
        radii.append(np.bitwise_count(own[near] ^ own[q]).sum(1, dtype=np.int64))
    radii = np.concatenate(radii) if radii else np.zeros(1)
    codes.radius = int(np.ceil(np.quantile(radii, RADIUS_SHARE))) if len(radii) else 0
    return codes


class MultiIndex:
    """Substring tables over one block's codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=0)
        self.values, self.starts = [], []
        for j in range(codes.shape[1]):
            v, s = np.unique(self.sorted[:, j], return_index=True)
            self.values.append(v)
            self.starts.append(np.append(s, len(codes)))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code differs from ``code`` in at most ``radius`` bits."""
        near = radius // self.codes.shape[1]
        hit = np.zeros(len(self.codes), bool)
        for j, (v, s) in enumerate(zip(self.values, self.starts, strict=True)):
            probed = np.bitwise_count(v ^ code[j]) <= near
            hit[self.order[np.repeat(probed, np.diff(s)), j]] = True
        rows = np.flatnonzero(hit)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(1, dtype=np.int64) <= radius]


def search_block(model: Codes, ids, x, q_ids, q, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, row id, distance) of each query's nearest k in the block; ids are distinct."""
    index, codes = MultiIndex(model.encode(x)), model.encode(q)
    out = [[], [], []]
    for i in range(len(q)):
        rows = index.within(codes[i], model.radius)
        rows = rows[ids[rows] != q_ids[i]]
        if len(rows) < k:
            rows = np.flatnonzero(ids != q_ids[i])
        d = distances(q[i], x[rows])
        if len(rows) > 4 * k:
            near = d <= np.partition(d, k - 1)[k - 1]
            rows, d = rows[near], d[near]
        best = np.lexsort((ids[rows], d))[:k]
        out[0].append(np.full(len(best), q_ids[i]))
        out[1].append(ids[rows[best]])
        out[2].append(d[best])
    return tuple(np.concatenate(o) if o else np.zeros(0) for o in out)


def _packed(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """Stored (id, v: doubles as bytes) of the ids that take part, each once, and their number of components."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0.0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    n = sizes["n"] if sizes else 0
    rows = rows.filter(F.size("v") == n).groupBy("id").agg(F.min("v").alias("v"))

    def pack(batches):
        for batch in batches:
            col = batch.column("v")
            flat, off = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
            data = [flat[s:e].astype("<f8").tobytes() for s, e in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(data, pa.binary())], ["id", "v"])

    return staged(rows.mapInArrow(pack, "id long, v binary"), "vectors"), n


def nearest(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, query_every: int = QUERY_EVERY,
    fit_rows: int = FIT_ROWS, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, id, score) for the rows whose id is divisible by ``query_every``, against all others."""
    spark = vectors.sparkSession
    prepare(spark)
    stored, dims = _packed(vectors, id_col, vector_col)
    shape = f"query_id long, rank int, {id_col} long, score double"
    total = stored.count()
    if not total or not dims:
        return spark.createDataFrame([], shape)
    sample = bounded_sample(stored, ["id", "v"], fit_rows).collect()
    x = np.frombuffer(b"".join(bytes(r["v"]) for r in sample), "<f8").reshape(-1, dims)
    model = spark.sparkContext.broadcast(fit(x))
    asks = F.col("id") % query_every == 0
    n_queries = stored.filter(asks).count()
    row_blocks, query_blocks = max(1, ceil(total / block_rows)), max(1, ceil(n_queries / block_queries))
    # Dealt by a hash of the id, so blocks stay even whatever the vectors are. A row goes to each block
    # of queries and a query to each block of rows: a stated query set against all rows, in blocks.
    rows = stored.select(
        "id", "v", F.lit(False).alias("asks"), F.pmod(F.xxhash64("id"), F.lit(row_blocks)).alias("rb"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"),
    )
    queries = stored.filter(asks).select(
        "id", "v", F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))).alias("rb"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(query_blocks)).cast("int").alias("qb"),
    )

    def join(table: pa.Table) -> pa.Table:
        empty = {"q": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        ids = table["id"].to_numpy()
        side = table["asks"].to_numpy(zero_copy_only=False).astype(bool)
        x = np.frombuffer(b"".join(table["v"].to_pylist()), "<f8").reshape(-1, dims)
        if side.all() or not side.any():
            return pa.table(empty)
        q, i, d = search_block(model.value, ids[~side], x[~side], ids[side], x[side], k)
        return pa.table({"q": q.astype(np.int64), "id": i.astype(np.int64), "score": d.astype(np.float64)})

    found = rows.union(queries).groupBy("rb", "qb").applyInArrow(join, "q long, id long, score double")
    # Spark keeps k rows a query before the shuffle too (window group limit).
    rank = F.row_number().over(Window.partitionBy("q").orderBy("score", "id"))
    best = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.select(F.col("q").alias("query_id"), "rank", F.col("id").alias(id_col), "score")
