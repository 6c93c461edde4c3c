"""Jaccard join of documents on word shingles by a grouped prefix join, and its connected components.

Every document is the set of its distinct shingles' 64-bit hashes. Two link when the Jaccard similarity of their sets
reaches 3/4, that is when ``4 * shared >= 3 * union``; then they share at least ``need = ceil(3 * (n + m) / 7)`` shingles.

* Order. Shingles are ordered by how often they occur, rare ones first, then by hash. Any common order gives the same
  result; this one keeps frequent passages out of prefixes.
* Prefix. Under a common order, the first shingle two linked sets share stands at place ``n - need`` at the latest
  in the one and ``m - need`` in the other; so all are found among the first ``n - ceil(3 n / 4) + 1`` of each.
* Groups. Documents of equal size and prefix are one group. Groups meet in the buckets of their prefix shingles; pairs
  of groups are filtered by sizes and places, and those left are expanded to members with different sets, which
  are verified on their whole sets. Documents with equal sets are one member.
* Components. In a bucket whose members are alike it is enough to compare all with one. So the first round
  verifies each group against its bucket's first; the second round takes every pair that the places allow and that
  the first round has not connected, in buckets and within each group, as members may link with each other and not with
  their leader. Both look at the prefixes of a pair before its sets. No pair that might connect two components is left out, and a large group of
  near copies costs as many pairs as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.grams import flat, map_batches, row_blocks
from tidemark.llm.words import mix, shingles, word_hashes
from tidemark.session import cut

WORDS = 5
HOT_SHINGLES = 1 << 20
HOT_LEAST = 4
COUNT_BUFFER = 1 << 21
BROADCAST_IDS = 1 << 20
BLOCK_BYTES = 1 << 20


def _sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, counts, hashes)``: distinct shingle hashes of the rows of a block, ascending in each row."""
    offsets, data = flat(texts)
    for a, b in row_blocks(offsets, BLOCK_BYTES):
        hashes, counts = word_hashes(offsets[a : b + 1], data)
        row, value = shingles(hashes, counts, size)
        order = np.lexsort((value, row))
        row, value = row[order], value[order]
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        yield a, np.bincount(row[fresh], minlength=b - a), value[fresh]


def frequent(docs: DataFrame, text_col: str, size: int, most: int = HOT_SHINGLES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (ascending) and counts of the most frequent shingles, at most ``most`` of them.

    All documents are counted: each task reports the shingles that several documents of a buffer have, and the reports
    are added up. So a shingle that more documents have than there are buffers is always reported. The least count that
    leaves at most ``most`` shingles is found from a histogram of counts, so what reaches the driver is bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def report():
            value, count = np.unique(np.concatenate(held), return_counts=True)
            again = count > 1
            return pa.RecordBatch.from_arrays([pa.array(value[again].view(np.int64)), pa.array(count[again])], names=["token", "n"])

        for batch in batches:
            for _, _, hashes in _sets(batch.column(0), size):
                held.append(hashes)
                n += len(hashes)
                if n >= COUNT_BUFFER:
                    yield report()
                    held, n = [], 0
        if held:
            yield report()

    counts = map_batches(docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text")), run, "token long, n long")
    counts = cut(counts.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT_LEAST), "frequent")
    step = F.floor(F.log2("n") * 4)
    least, total = None, 0
    for level in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("step").desc()).collect():
        total += level["n"]
        if total > most:
            break
        least = level["step"]
    hot = counts.where(step >= least).toArrow() if least is not None else counts.limit(0).toArrow()
    token, n = hot["token"].to_numpy().view(np.uint64), hot["n"].to_numpy()
    order = np.argsort(token)
    return token[order], n[order]


def prefixes(docs: DataFrame, id_col: str, text_col: str, size: int, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``(_id, n, s1, s2, group, prefix)`` of every row: size of the set, two hashes of the whole set, a hash of size
    and prefix, and the prefix in order. A text without words has size 0 and no prefix."""
    tokens, often = hot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, counts, value in _sets(batch.column(1), size):
                row = np.repeat(np.arange(len(counts)), counts)
                rank = np.zeros(len(value), np.int64)
                if len(tokens):
                    slot = np.minimum(np.searchsorted(tokens, value), len(tokens) - 1)
                    rank = np.where(tokens[slot] == value, often[slot], 0)
                order = np.lexsort((value, rank, row))
                place = np.arange(len(value)) - np.repeat(np.cumsum(counts) - counts, counts)
                kept = np.where(counts > 0, counts + (-3 * counts) // 4 + 1, 0)
                front = value[order][place < kept[row]]
                ends = np.cumsum(counts)
                sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(value + np.uint64(1)))]), np.concatenate([[np.uint64(0)], np.cumsum(mix(value ^ np.uint64(0x5851F42D4C957F2D)))])
                s1, s2 = (s[ends] - s[ends - counts] for s in sums)
                edge = np.cumsum(kept)
                spot = np.arange(len(front)) - np.repeat(edge - kept, kept)
                total = np.concatenate([[np.uint64(0)], np.cumsum(mix(front + mix(spot.astype(np.uint64))))])
                group = mix(total[edge] - total[edge - kept] + mix(counts.astype(np.uint64)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(counts)), pa.array(counts), *(pa.array(x.view(np.int64)) for x in (s1, s2, group)),
                    pa.ListArray.from_arrays(pa.array(np.append(0, edge), pa.int32()), pa.array(front.view(np.int64))),
                ], names=["_id", "n", "s1", "s2", "group", "prefix"])

    kept = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return map_batches(kept, run, "_id long, n long, s1 long, s2 long, group long, prefix array<long>")


def _possible(n: Column, at: Column, m: Column, to: Column) -> Column:
    """Whether sets of sizes ``n`` and ``m`` that share their shingles at places ``at`` and ``to`` first can link."""
    need = F.ceil(3 * (n + m) / F.lit(7))
    return (4 * F.least(n, m) >= 3 * F.greatest(n, m)) & (at + need <= n) & (to + need <= m)


def _small(rows: DataFrame) -> DataFrame:
    """Rows of a few numbers, counted: up to ``BROADCAST_IDS`` of them go to every task, more are joined by shuffle."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _plausible(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose prefixes share enough: beyond both prefixes' common shingles two sets can share no more than
    what follows the prefix of one of them. Prefixes, a quarter of the sets, are looked at before any set is made."""
    ids = _small(cut(pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct(), "pair-ids"))
    front = cut(rows.where("n > 0").join(ids, "_id", "left_semi").select("_id", "n", "prefix"), "pair-prefixes")
    x, y = (front.select(F.col("_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("prefix").alias(f"p_{c}")) for c in "ab")
    both = pairs.join(x, "a").join(y, "b")
    most = F.size(F.array_intersect("p_a", "p_b")) + F.greatest(F.col("n_a") - F.size("p_a"), F.col("n_b") - F.size("p_b"))
    return both.where(most >= F.ceil(3 * (F.col("n_a") + F.col("n_b")) / F.lit(7))).select("a", "b").distinct()


def _verify(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """The pairs whose whole sets link. Sets are made anew from the texts, of documents in a pair only: their ids
    go to every task if they are few, as is counted first, else both sides are shuffled."""
    wanted = _small(cut(pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct(), "pair-ids"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, counts, value in _sets(batch.column(1), size):
                edge = np.append(0, np.cumsum(counts)) * 8
                blob = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(value)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(counts)), blob.cast(pa.binary())], names=["_id", "tokens"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked[i] = 4 * shared >= 3 * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked))

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(wanted, "_id", "left_semi")
    sets = cut(map_batches(texts, make, "_id long, tokens binary"), "pair-sets")
    both = pairs.join(sets.select(F.col("_id").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("_id").alias("b"), F.col("tokens").alias("y")), "b")
    return map_batches(both.select("a", "b", "x", "y"), compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of the nodes of ``edges (a, b)``: the smallest node they reach. Labels spread to neighbours
    and jump to their label's label until none changes; every step is written to the shared folder."""
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        spread = cut(labels.join(near, "node").select("node", F.least("component", "near").alias("component"), F.col("component").alias("was")), "spread")
        jump = spread.select(F.col("node").alias("component"), F.col("component").alias("next"))
        moved = cut(spread.join(jump, "component").select("node", F.least("component", "next").alias("component"), "was"), "labels")
        labels = moved.drop("was")
        if moved.where("component <> was").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS) -> DataFrame:
    """``(id, n_shingles, component_id)``: one row per given row, with the size of its set and the smallest id that it
    reaches by links, itself included.

    Ids are whole numbers, unique but for repeated rows. A text with fewer than ``size`` words has its whole
    sequence as its one shingle; one without words, or null, has none and links with nothing. A row with a null id
    is returned with its size and no component. Other columns are ignored.
    """
    rows = cut(prefixes(docs, id_col, text_col, size, frequent(docs, text_col, size)), "prefixes")
    named = rows.where("n > 0 AND _id IS NOT NULL")
    members = cut(named.groupBy("n", "group", "s1", "s2").agg(F.min("_id").alias("member"), F.count(F.lit(1)).alias("copies")), "members")
    groups = cut(members.groupBy("n", "group").agg(F.min("member").alias("leader"), F.count(F.lit(1)).alias("sets"), F.sum("copies").alias("rows")), "groups")
    # one document stands for its group
    spare = cut(named.select("_id", "n", "group").join(groups.where("rows > 1"), ["n", "group"]).where("_id <> leader").select("_id", "n", "group").distinct(), "spare")
    one = named.join(_small(spare), ["_id", "n", "group"], "left_anti")
    entries = one.select(F.col("_id").alias("leader"), "n", "group", F.posexplode("prefix").alias("at", "token"))
    bucket = Window.partitionBy("token")
    entries = entries.withColumns({"_low": F.min("leader").over(bucket), "_high": F.max("leader").over(bucket), "_first": F.min(F.struct("at", "leader", "n")).over(bucket)})
    buckets = cut(entries.where("_low <> _high").drop("_low", "_high"), "buckets")
    several = members.join(groups.where("sets > 1"), ["n", "group"])
    expand = several.where("member <> leader").select("leader", "n", "group", "member")

    # first round: each group against the first of its bucket, and members against their leader
    possible = _possible(F.col("n"), F.col("at"), F.col("_first.n"), F.col("_first.at"))
    met = _ordered(buckets.where(possible).select(F.col("leader").alias("a"), F.col("_first.leader").alias("b")))
    more = met.join(expand.select(F.col("leader").alias("b"), "member"), "b").select("a", F.col("member").alias("b"))
    even = met.join(expand.select(F.col("leader").alias("a"), "member"), "a").select("b", F.col("member").alias("a")).select("a", "b")
    inner = expand.select(F.col("leader").alias("a"), F.col("member").alias("b"))
    tried = cut(_ordered(met.union(more).union(even).union(inner)), "pairs")
    links = cut(_verify(docs, cut(_plausible(rows, tried), "pairs"), id_col, text_col, size), "links")
    label = components(links)

    # second round: every other pair that could join two components, of two groups in a bucket or of one group
    label = _small(label.withColumnRenamed("node", "id"))

    def both(rows: DataFrame, *keys: str) -> DataFrame:
        rows = rows.join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
        x, y = (rows.select(*keys, *(F.col(c).alias(f"{s}_{c}") for c in rows.columns if c not in keys)) for s in "xy")
        return x.join(y, list(keys)).where("x_component < y_component")

    entry = buckets.select("token", "n", "group", "at", F.col("leader").alias("id"))
    entry = entry.union(buckets.join(expand, ["leader", "n", "group"]).select("token", "n", "group", "at", F.col("member").alias("id")))
    across = both(entry, "token").where(
        ((F.col("x_n") != F.col("y_n")) | (F.col("x_group") != F.col("y_group"))) & _possible(F.col("x_n"), F.col("x_at"), F.col("y_n"), F.col("y_at")))
    within = both(several.select("n", "group", F.col("member").alias("id")), "n", "group")
    open_pairs = across.select("x_id", "y_id").union(within.select("x_id", "y_id"))
    rest = _ordered(open_pairs.select(F.col("x_id").alias("a"), F.col("y_id").alias("b"))).join(tried, ["a", "b"], "left_anti")
    rest = cut(_plausible(rows, cut(rest, "pairs")), "pairs")
    links = links.union(_verify(docs, rest, id_col, text_col, size))
    label = components(links)

    found = rows.join(members.select("n", "group", "s1", "s2", "member"), ["n", "group", "s1", "s2"], "left")
    found = found.join(label.withColumnRenamed("node", "member"), "member", "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("component", "member", "_id"))
    kind = docs.schema[id_col].dataType
    return found.select(F.col("_id").cast(kind).alias(id_col), F.col("n").alias("n_shingles"), component.cast(kind).alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS) -> DataFrame:
    """The rows whose id is the smallest of their component, with their own columns. Of rows with the same id one stays,
    and rows with a null id all stay. Texts are not shuffled where the rows to drop are few."""
    found = near_duplicates(docs, id_col, text_col, size)
    drop = cut(found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__drop")).distinct(), "drop")
    left = docs.join(drop, docs[id_col] == F.col("__drop"), "left_anti")
    again = cut(left.groupBy(F.col(id_col).alias("__again")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1 AND __again IS NOT NULL").select("__again"), "again")
    if again.isEmpty():
        return left
    twice = left.join(again, left[id_col] == F.col("__again"), "left_semi").dropDuplicates([id_col])
    return left.join(again, left[id_col] == F.col("__again"), "left_anti").unionByName(twice)


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[ \t\n\x0B\f\r]+', ' ', 'g'), ' '), ' ') AS t FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN t = [''] THEN [] WHEN len(t) < 5 THEN [array_to_string(t, ' ')]
        ELSE list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' ')) END)) AS g FROM w),
n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY ALL),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 4 * c >= 3 * (a.n + b.n - c)),
r AS (SELECT doc_id, doc_id AS z FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.z)
SELECT r.doc_id, any_value(n.n) AS n_shingles, min(z) AS component_id FROM r JOIN n USING (doc_id) GROUP BY r.doc_id
"""
