"""Exact top-k search by an impact-ordered index, score at a time.

Vectors are dealt into shards of bounded size. In a shard, a posting list for each component holds its vectors by
value, cut into segments of one quantised value. For a query, a segment's impact is the most that any of its postings
adds above the least that the component can add in this shard; so all impacts are 0 or more. Segments are processed by
descending impact, whatever their component: a posting adds its impact to its vector's accumulator. When the segments
left have impacts of at most ``t``, a vector can still gain ``t`` for each component not seen yet (less where all of a
component's impacts are smaller), which bounds its score from above. Processing stops once the vectors whose bound
reaches the query's threshold are so few that they are cheaper to score, or no segment is left; these possible members are
scored exactly, so what is left out is proven not to belong to the answer.

The threshold starts from exact scores of a bounded sample of vectors. Shards are dealt to tasks in bundles of bounded
size; a task holds one bundle, and the queries stream by it in blocks, so they move once for each bundle and are never
broadcast. Only scores that reach the threshold, at most ``k`` for each query and bundle, leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.grams import map_batches
from tidemark.session import cut, share_code

SHARD_VECTORS = 4096
BLOCK_QUERIES = 256
#: Components of the vectors that a task holds at a time, unless fewer shards keep all cores busy.
BUNDLE_NUMBERS = 1 << 22
LEVELS = 32
SEEDS = 1024
STEPS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 3 / 4, 1.0)
#: Larger components could overflow the 64-bit inner product of vectors of up to 2,048 components.
MOST = 1 << 26


def whole(vector: Column, scale: int = 256) -> Column:
    """Components as ``floor(scale * x)``; null for a vector that is null or holds null, NaN or infinity. Components
    beyond ``MOST``, whose scores 64 bits may not hold, raise an error."""
    x = vector.cast("array<double>")
    usable = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    cast = F.transform(x, lambda v: F.when(F.abs(v * scale) < MOST, F.floor(v * scale).cast("int")).otherwise(F.raise_error(F.lit("a component is too large for exact scores"))))
    return F.when(usable, cast)


def _matrix(rows: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` numbers; shorter ones are filled up with zeros."""
    rows = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    sizes = np.diff(rows.offsets.to_numpy())
    out = np.zeros((len(rows), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = rows.flatten().to_numpy()
    return out


class Shard:
    """Vectors with their impact-ordered postings."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n, d = vectors.shape
        self.low, self.high = vectors.min(axis=0), vectors.max(axis=0)
        self.step = np.maximum(1, -(-(self.high - self.low + 1) // LEVELS))
        level = (vectors - self.low) // self.step
        self.order = np.argsort(level, axis=0, kind="stable").T.astype(np.int32).ravel()  # postings: by component, by level
        counts = np.bincount((np.arange(d) * LEVELS + level).ravel(), minlength=d * LEVELS)
        self.ends = np.cumsum(counts)
        self.starts, self.counts = self.ends - counts, counts
        at = np.arange(LEVELS)[None, :] * self.step[:, None]
        self.floor, self.top = at, np.minimum(at + self.step[:, None] - 1, (self.high - self.low)[:, None])

    def impacts(self, query: np.ndarray) -> np.ndarray:
        """The most a segment's posting adds, above the least of its component, for all segments."""
        up = query[:, None] * self.top
        down = -query[:, None] * ((self.high - self.low)[:, None] - self.floor)
        return np.where(query[:, None] >= 0, up, down).ravel()

    def members(self, query: np.ndarray, threshold: int) -> np.ndarray:
        """The vectors whose score may reach ``threshold``: none but these does."""
        n, d = self.vectors.shape
        base = int(np.where(query >= 0, query * self.low, query * self.high).sum())
        need = threshold - base
        everyone = np.arange(n)
        if need <= 0 or not d:
            return everyone if need <= 0 else everyone[:0]
        impacts = self.impacts(query)
        segments = np.flatnonzero((self.counts > 0) & (impacts > 0))
        if not len(segments):
            return everyone[:0]
        segments = segments[np.argsort(-impacts[segments], kind="stable")]
        weight, postings = impacts[segments], np.cumsum(self.counts[segments])
        most = np.zeros(d, np.int64)
        np.maximum.at(most, segments // LEVELS, weight)
        if int(most.sum()) < need:
            return everyone[:0]
        gained, seen, at, possible = np.zeros(n), np.zeros(n, np.int64), 0, everyone
        for step in STEPS:
            to = max(at, int(np.searchsorted(postings, step * postings[-1] - 0.5)) + 1)
            if to > at:
                sizes = self.counts[segments[at:to]]
                spot = np.arange(int(sizes.sum())) + np.repeat(self.starts[segments[at:to]] - np.cumsum(sizes) + sizes, sizes)
                docs = self.order[spot]
                gained += np.bincount(docs, np.repeat(weight[at:to], sizes), n)
                seen += np.bincount(docs, minlength=n)
                at = to
            left = int(weight[at]) if at < len(segments) else 0
            bound = gained + (int(np.minimum(most, left).sum()) - left * seen)
            possible = np.flatnonzero(bound >= need)
            if not left or len(possible) * d * 4 <= int(postings[-1] - postings[at - 1]):
                break
        return possible


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        cut_at = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= cut_at)
        return some[np.lexsort((ids[some], -scores[some]))][:k]
    return np.lexsort((ids, -scores))[:k]


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``(query_id, rank, id, score)``: for every row that ``is_query`` names, the ``k`` other rows of highest integer
    inner product with it, all if there are fewer; ties go to the smaller id.

    Vectors that are null or hold a null or non-finite component, and rows without id, take no part. Of rows with one
    id, which are no candidates of each other, the least vector stands for all. Vectors of different lengths are
    compared as if filled up with zeros. Other columns are ignored.
    """
    spark = vectors.sparkSession
    share_code(spark)
    given = vectors.select(F.col(id_col).cast("long").alias("_id"), whole(F.col(vector_col), scale).alias("_v"), F.coalesce(is_query, F.lit(False)).alias("_q"))
    rows = cut(given.where(F.col("_id").isNotNull() & F.col("_v").isNotNull()).groupBy("_id").agg(F.min("_v").alias("_v"), F.max("_q").alias("_q")), "impact-vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("_v")), F.lit(0)).alias("d"), F.coalesce(F.sum(F.col("_q").cast("long")), F.lit(0)).alias("q")).first()
    n, width = size["n"], max(1, size["d"])
    n_shards, n_blocks = -(-n // SHARD_VECTORS) or 1, -(-size["q"] // BLOCK_QUERIES) or 1

    even = F.pmod(F.xxhash64("_id", F.lit("seed")), F.lit(1 << 30)) / float(1 << 30)
    seeds = rows.where(even < SEEDS / max(1, n)).select("_id", "_v").toArrow()
    seed_ids, seed_vectors = seeds["_id"].to_numpy(), _matrix(seeds["_v"], width)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with their threshold: the ``k``-th best score among the sample, null if the sample has fewer."""
        for batch in batches:
            ids, queries = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
            low = []
            for lo in range(0, len(ids), BLOCK_QUERIES):
                scores = queries[lo : lo + BLOCK_QUERIES] @ seed_vectors.T
                for own, row in zip(ids[lo : lo + BLOCK_QUERIES], scores):
                    row = row[seed_ids != own]
                    low.append(int(np.partition(row, len(row) - k)[len(row) - k]) if len(row) >= k else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(low, pa.int64())], names=["_id", "_v", "_low"])

    queries = map_batches(rows.where("_q").select("_id", "_v"), start, "_id long, _v array<int>, _low long")
    spot = F.struct("_id", "_v", "_low")
    blocks = queries.groupBy(F.pmod(F.xxhash64("_id"), F.lit(n_blocks)).alias("_block")).agg(F.sort_array(F.collect_list(spot)).alias("_queries"))
    n_bundles = min(n_shards, max(2 * spark.sparkContext.defaultParallelism, -(-n * width // BUNDLE_NUMBERS)))
    shard = F.pmod(F.xxhash64("_id", F.lit("shard")), F.lit(n_shards)).cast("int")
    dealt = rows.select(shard.alias("_shard"), "_id", "_v").withColumn("_bundle", F.pmod("_shard", F.lit(n_bundles)))
    everywhere = cut(blocks.select("_queries"), "impact-queries").withColumn("_bundle", F.explode(F.sequence(F.lit(0), F.lit(n_bundles - 1))))
    # a bundle's vectors by shard, then the queries; a bundle is much work on few bytes, so it is a partition whatever its size
    met = dealt.unionByName(everywhere, allowMissingColumns=True).repartitionById(n_bundles, F.col("_bundle"))
    met = met.sortWithinPartitions("_bundle", F.asc_nulls_last("_shard"), "_id").select("_bundle", F.coalesce("_shard", F.lit(-1)).alias("_shard"), "_id", "_v", "_queries")

    def asked_of(shards: list[Shard], asked: pa.StructArray) -> pa.RecordBatch:
        """The best of a bundle for a block of queries; what a query has found in one shard is its threshold in the next."""
        out: list[list[np.ndarray]] = [[], [], []]
        for own, query, low in zip(asked.field("_id").to_numpy(), _matrix(asked.field("_v"), width), asked.field("_low").to_pylist()):
            best, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for index in shards:
                some = np.arange(len(index.ids)) if low is None else index.members(query, low)
                some = some[index.ids[some] != own]
                scores = index.vectors[some] @ query
                if low is not None:
                    some, scores = some[scores >= low], scores[scores >= low]
                best, ids = np.concatenate([best, scores]), np.concatenate([ids, index.ids[some]])
                top = _top(best, ids, k)
                best, ids = best[top], ids[top]
                if len(best) == k:
                    low = int(best[-1]) if low is None else max(low, int(best[-1]))
            for x, part in zip(out, (np.full(len(ids), own), ids, best)):
                x.append(part)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=["_query", "_found", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, number, held, shards = None, None, [], []
        for batch in batches:
            at = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            edges = np.flatnonzero(np.any(at[:, 1:] != at[:, :-1], axis=0)) + 1
            for lo, hi in zip([0, *edges], [*edges, batch.num_rows]) if batch.num_rows else ():
                if held and (bundle, number) != (at[0, lo], at[1, lo]):
                    shards.append(Shard(*(np.concatenate(x) for x in zip(*held))))
                    held = []
                if bundle != at[0, lo]:
                    shards = []
                bundle, number = at[0, lo], at[1, lo]
                if number >= 0:
                    held.append((batch.column(2)[lo:hi].to_numpy(), _matrix(batch.column(3)[lo:hi], width)))
                    continue
                for i in range(lo, hi):
                    yield asked_of(shards, batch.column(4)[i].values)

    found = map_batches(met, run, "_query long, _found long, score long")
    order = Window.partitionBy("_query").orderBy(F.desc("score"), "_found")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select(F.col("_query").alias("query_id"), "rank", F.col("_found").alias(id_col), "score")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
