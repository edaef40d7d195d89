"""Approximate nearest neighbours by a permutation index (operator 5).

Every vector is represented by its PREFIX nearest pivots in order of distance. A task posts its vectors in one
inverted file per pivot (with the pivot's place in the vector's order), adds up, for each query, what the
postings of the query's own pivots take off the footrule distance of the two prefixes, reranks the vectors of
least footrule by Euclidean distance in double precision, and returns its ten best. The answers of all tasks are
merged by query.

Pivots come from a bounded sample (PIVOT_SAMPLE vectors, by hash); all rows are indexed. Queries go out in
blocks of bounded size, each against all rows. A task's share of candidates follows its rows (SHARE, and at least
LEAST), with all ties at the last footrule, so equal vectors never push each other out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from streamweave.llm.common import scratch, stored

PIVOTS, PREFIX = 256, 128
PIVOT_SAMPLE = 4096
#: Part of a segment's vectors that is reranked for a query, and the fewest.
SHARE, LEAST = 0.05, 200
#: Vectors of a segment, queries of a block.
SEGMENT, QUERY_BLOCK = 50_000, 2_000


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec): without nulls, NaN or infinite parts, all-zero or empty vectors, and null ids; once each."""
    v = F.col("vec")
    sound = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    out = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return out.where(F.col("vec_id").isNotNull() & v.isNotNull() & sound & F.exists(v, lambda x: x != 0))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first among the sample after a start at random: every region gets a pivot."""
    own = np.random.default_rng(7).permutation(len(sample))[:max(1, n // 2)]
    near = ((sample[:, None, :] - sample[own][None, :8, :]) ** 2).sum(2).min(1)
    for p in own[8:]:
        near = np.minimum(near, ((sample - sample[p]) ** 2).sum(1))
    own = list(own)
    while len(own) < min(n, len(sample)) and near.max() > 0:
        own.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[own[-1]]) ** 2).sum(1))
    return sample[own]


def prefixes(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The numbers of each row's nearest pivots, nearest first, ties to the smaller number."""
    d = (pivots ** 2).sum(1)[None, :] - 2 * (x @ pivots.T)
    return np.argsort(d, axis=1, kind="stable")[:, :length].astype(np.int16)


class Segment:
    """Inverted files of a task's vectors; equal vectors are one entry with their smallest ids."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, order: np.ndarray, n_pivots: int, keep: int):
        x = np.ascontiguousarray(x)
        code = np.unique(x.view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel(), return_inverse=True)[1]
        by = np.lexsort((ids, code))
        ids, x, order, code = ids[by], x[by], order[by], code[by]
        new = np.r_[True, code[1:] != code[:-1]]
        again = np.r_[True, (ids[1:] != ids[:-1]) | new[1:]]
        ids, x, order, new = ids[again], x[again], order[again], new[again]
        first = np.flatnonzero(new)
        self.x, self.ids = x[first], np.split(ids, first[1:])
        self.ids = [i[:keep] for i in self.ids]
        self.length = order.shape[1]
        flat = order[first].ravel()
        by = np.argsort(flat, kind="stable")
        self.rows = by // self.length
        self.weight = (self.length - by % self.length).astype(np.int32)
        self.at = np.searchsorted(flat[by], np.arange(n_pivots + 1))

    def search(self, query: int, q: np.ndarray, order: np.ndarray, n: int, share: float, least: int):
        """(distance, id) of the ``n`` nearest among the entries of least footrule to the query's prefix.

        The footrule of two prefixes of length k, a missing pivot standing at place k, is k (k + 1) less
        2 min(k - place here, k - place there) for each pivot in both."""
        off = np.zeros(len(self.x), np.int32)
        for place, pivot in enumerate(order.tolist()):
            a, b = self.at[pivot], self.at[pivot + 1]
            off[self.rows[a:b]] += np.minimum(self.weight[a:b], self.length - place)
        many = max(least, int(np.ceil(share * len(off))))
        if many < len(off):
            own = np.flatnonzero(off >= np.partition(off, len(off) - many)[len(off) - many])
        else:
            own = np.arange(len(off))
        d = np.sqrt(((self.x[own] - q) ** 2).sum(axis=1))
        most = np.partition(d, n)[n] if len(d) > n + 1 else np.inf
        found = [(float(d[i]), int(v)) for i in np.flatnonzero(d <= most) for v in self.ids[own[i]] if v != query]
        return sorted(found)[:n]


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", n: int = 10,
            pivots: int = PIVOTS, prefix: int = PREFIX, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score): for each usable row of ``queries`` the ``n`` nearest rows of ``vectors``
    found, other than the query's own id; score is the Euclidean distance, ties go to the smaller vec_id.

    Vectors that are null, empty, all zero or hold a null or non-finite part take no part, nor do null ids, nor
    vectors of another length than the most common one. Repeated rows are one; an empty table gives an empty
    result; other columns are ignored."""
    spark = vectors.sparkSession
    folder = scratch(spark)
    sound = usable(vectors, id_col, vec_col)
    dims = sound.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if dims is None:
        return spark.createDataFrame([], schema)
    dim = dims[0]
    sound = sound.where(F.size("vec") == dim)
    chance = F.pmod(F.xxhash64("vec"), F.lit(1_000_000)) < max(1, round(1_000_000 * min(1, 2 * PIVOT_SAMPLE / dims[1])))
    sample = sound.select("vec").where(chance).distinct().orderBy(F.xxhash64("vec"), "vec").limit(PIVOT_SAMPLE)
    sample = np.array([r[0] for r in sample.collect()]).reshape(-1, dim)
    if not len(sample):
        sample = np.array([r[0] for r in sound.select("vec").limit(PIVOT_SAMPLE).collect()])
    own = spark.sparkContext.broadcast(choose_pivots(sample, pivots))

    def posted(batches):
        for batch in batches:
            x = matrix(batch.column(1), dim)
            order = prefixes(x, own.value, prefix)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(order), pa.list_(pa.int16()))],
                                             names=["vec_id", "vec", "pivots"])

    index = stored(sound.mapInArrow(posted, "vec_id bigint, vec array<double>, pivots array<smallint>"), folder, "index")
    asked = usable(queries, id_col, vec_col).where(F.size("vec") == dim)
    asked = asked.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    asked = stored(asked.select("vec_id", "vec", F.xxhash64("vec_id").alias("h")), folder, "queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    answers = None
    for b in range(blocks):
        block = asked.where(F.pmod("h", F.lit(blocks)) == b).orderBy("vec_id").collect()
        x = np.array([r[1] for r in block]).reshape(-1, dim)
        sent = spark.sparkContext.broadcast(([r[0] for r in block], x, prefixes(x, own.value, prefix)))

        def search(batches, sent=sent):
            ids, x, order = sent.value
            count = len(own.value)

            def answer(parts):
                segment = Segment(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]),
                                  np.concatenate([p[2] for p in parts]), count, n + 1)
                rows = [(q, v, d) for q, y, o in zip(ids, x, order) for d, v in segment.search(q, y, o, n, share, least)]
                return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                                   pa.array([r[1] for r in rows], pa.int64()),
                                                   pa.array([r[2] for r in rows], pa.float64())],
                                                  names=["query_id", "vec_id", "score"])

            parts, size = [], 0
            for batch in batches:
                if batch.num_rows:
                    parts.append((batch.column(0).to_numpy(), matrix(batch.column(1), dim),
                                  batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)))
                    size += batch.num_rows
                if size >= SEGMENT:
                    yield answer(parts)
                    parts, size = [], 0
            if parts:
                yield answer(parts)

        found = index.mapInArrow(search, "query_id bigint, vec_id bigint, score double")
        answers = found if answers is None else answers.union(found)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (answers.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
            .select("query_id", "rank", "vec_id", "score"))
