"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds blocks of documents of similar length. A block's signature is a matrix of bits, a row for each hash
position and a column for each document: a term of a document sets its bit in ``HASHES`` rows, and once more, hashed
anew, in plane ``p`` for every ``p`` with ``2 ** p`` or more occurrences. The rows of a term, joined by AND, are a
bitmap of the documents that may hold it so often: Bloom filters err only upwards. Summed over an item's terms with
the terms' weights, a plane is a weighted slice sum; the slices of all planes, each times what more occurrences may
add at the document's length, are an upper bound of its score. Documents whose bound is below the item's tenth best
exact score so far are excluded; all others are scored exactly from the block's term counts.

Blocks are bounded in bytes, an index of any size is read block by block, and only an item's best documents leave a
task. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.grams import flat, map_batches, row_blocks
from tidemark.llm.words import mix, word_hashes
from tidemark.session import cut, work_dir

BLOCK_DOCS = 128
BLOCK_BYTES = 1 << 18
HASHES = 3
PLANES = 7
BITS_PER_TERM = 8
ITEM_BYTES = 16 << 20
SEED_BLOCKS = 256
ITEMS_AT_ONCE = 64
PAIRS_AT_ONCE = 1024
BATCH_BYTES = 2 << 20
GROUP_BYTES = 8 << 20
K1000, B100, FLAT100 = 8, 90, 10

#: Bytes that end a term count as spaces; letters, digits and all bytes of other than ASCII characters belong to terms.
_TERMS = np.full(256, 32, np.uint8)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _TERMS[_first : _last + 1] = np.arange(_first, _last + 1)


def term_counts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(rows, hashes, occurrences)`` of the distinct terms of each text, for blocks of whole texts in order."""
    offsets, data = flat(texts)
    for a, b in row_blocks(offsets, 1 << 20):
        start = int(offsets[a])
        hashes, words = word_hashes(offsets[a : b + 1] - start, _TERMS[data[start : int(offsets[b])]])
        row = np.repeat(np.arange(a, b), words)
        order = np.lexsort((hashes, row))
        row, hashes = row[order], hashes[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
        first = np.flatnonzero(new)
        yield row[first], hashes[first], np.diff(np.append(first, len(row)))


def _in_plane(hashes: np.ndarray, plane: int) -> np.ndarray:
    return mix(hashes + np.uint64(plane * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def _place(codes: np.ndarray, i: int, rows: int) -> np.ndarray:
    return ((codes >> np.uint64(20 * i)) & np.uint64(rows - 1)).astype(np.int64)


def signature(doc: np.ndarray, hashes: np.ndarray, times: np.ndarray, docs: int, rows: int) -> np.ndarray:
    """The packed bit matrix, ``rows`` by ``ceil(docs / 8)`` bytes, of the terms of ``docs`` documents."""
    bits = np.zeros((rows, docs), bool)
    for plane in range(PLANES):
        often = np.flatnonzero(times >= 1 << plane)
        if not len(often):
            break
        codes = _in_plane(hashes[often], plane)
        for i in range(HASHES):
            bits[_place(codes, i, rows), doc[often]] = True
    return np.packbits(bits, axis=1)


def _height(items: int) -> int:
    return 1 << max(6, (BITS_PER_TERM * items - 1).bit_length())


def _blocks(ids: pa.Array, texts: pa.Array) -> Iterator[dict]:
    """The index blocks of a batch: its documents with a term, by number of signature entries."""
    parts = list(term_counts(texts))
    row, hashes, times = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(3))
    ends = np.searchsorted(row, np.arange(len(texts) + 1))
    entries = np.bincount(row, np.minimum(PLANES, np.frexp(times.astype(float))[1]), len(texts)).astype(np.int64)
    length = np.bincount(row, times, len(texts)).astype(np.int64)
    order = np.flatnonzero(length)
    order = order[np.argsort(entries[order], kind="stable")]
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and to - at < BLOCK_DOCS and _height(int(entries[order[to]])) * (to + 8 - at) // 8 <= BLOCK_BYTES:
            to += 1
        docs = order[at:to]
        rows = _height(int(entries[docs[-1]]))
        sizes = ends[docs + 1] - ends[docs]
        doc = np.repeat(np.arange(len(docs)), sizes)
        starts = np.append(0, np.cumsum(sizes))
        pick = np.arange(len(doc)) - starts[doc] + ends[docs][doc]
        bits = signature(doc, hashes[pick], times[pick], len(docs), rows)
        yield {
            "ids": ids.take(pa.array(docs)), "lengths": length[docs].tobytes(), "signature": bits.tobytes(),
            "starts": starts.astype(np.int64).tobytes(), "terms": hashes[pick].tobytes(), "times": times[pick].astype(np.int32).tobytes(),
            "n_docs": len(docs), "n_terms": int(length[docs].sum()),
        }
        at = to


_INDEX = pa.schema([
    ("ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("signature", pa.binary()), ("starts", pa.binary()), ("terms", pa.binary()),
    ("times", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64())])
INDEX = "ids array<long>, lengths binary, signature binary, starts binary, terms binary, times binary, n_docs long, n_terms long"


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all documents that hold a term, a row for each block, written to the shared folder; map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch.column(0), batch.column(1)):
                block["ids"] = block["ids"].to_pylist()
                yield pa.RecordBatch.from_pylist([block], _INDEX)

    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    folder = work_dir(spark, "lexical-index")
    # readers and writers hold a row group of each file, so these are kept small
    _map(rows, run, INDEX).write.option("parquet.block.size", str(GROUP_BYTES)).parquet(folder)
    return spark.read.schema(INDEX).parquet(folder)


def items(queries: DataFrame, id_col: str = "item_id", text_col: str = "text", item_bytes: int = ITEM_BYTES) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """``(ids, distinct term hashes of each)`` of the query items, in as many passes as it takes to keep each, as is
    counted before, near ``item_bytes``. Rows of one id are one item, with the terms of all its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, hashes, _ in term_counts(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(hashes.view(np.int64))], names=["_id", "_term"])

    rows = queries.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    terms = cut(_map(rows, run, "_id long, _term long").distinct(), "lexical-items")
    parts = -(-terms.count() * 16 // item_bytes) or 1
    for part in range(parts):
        got = terms.where(F.pmod(F.xxhash64("_id"), F.lit(parts)) == part).toArrow()
        ids, codes = got["_id"].to_numpy(), got["_term"].to_numpy().view(np.uint64)
        order = np.lexsort((codes, ids))
        ids, codes = ids[order], codes[order]
        each, first = np.unique(ids, return_index=True)
        yield each.tolist(), np.split(codes, first[1:]) if len(each) else []


class Plan(NamedTuple):
    """What a search needs beside the index: the corpus figures, and the items' terms with their weights."""

    n_docs: int
    n_terms: int
    ids: list[int]
    terms: list[np.ndarray]
    weights: list[np.ndarray]


def plan(blocks: DataFrame, ids: list[int], terms: list[np.ndarray]) -> Plan:
    """Count the documents of every item term over the whole index and weigh the terms."""
    total = blocks.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_docs", "n_terms"))).first()
    known = np.unique(np.concatenate(terms)) if terms else np.zeros(0, np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(known), np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                codes = np.frombuffer(packed, np.uint64)
                at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                found += np.bincount(at[known[at] == codes], minlength=len(known))
        there = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(found[there])], names=["term", "df"])

    df = np.zeros(len(known), np.int64)
    if len(known):
        got = _map(blocks.select("terms"), count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
        df[got["term"].to_numpy()] = got["df"].to_numpy()
    n = total["n_docs"]
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    return Plan(n, total["n_terms"], ids, terms, [weight[np.searchsorted(known, t)] for t in terms])


def _share(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * times) // (1000 * times + K1000 * m)


class _Group:
    """Some of a plan's items, as pairs of item and term."""

    def __init__(self, given: Plan, lo: int, hi: int):
        self.items = range(lo, hi)
        self.known = np.unique(np.concatenate(given.terms[lo:hi]))
        self.codes = [_in_plane(self.known, p) for p in range(PLANES)]
        self.columns = [np.searchsorted(self.known, given.terms[i]) for i in self.items]
        self.weights = [given.weights[i] for i in self.items]
        self.pair_item = np.repeat(np.arange(hi - lo), [len(c) for c in self.columns])
        self.pair_term, self.pair_weight = np.concatenate(self.columns), np.concatenate(self.weights)

    def bounds(self, bits: np.ndarray, docs: int, lengths: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Upper bounds of all scores, items by documents, from the slice sums of the signature's planes."""
        total = np.zeros((len(self.items), docs), np.int64)
        active, had, before = np.arange(len(self.known)), None, 0
        place = np.zeros(len(self.known), np.int64)
        for plane in range(PLANES):
            rows = bits[_place(self.codes[plane][active], 0, len(bits))]
            for i in range(1, HASHES):
                rows = rows & bits[_place(self.codes[plane][active], i, len(bits))]
            if had is not None:
                rows &= had
            some = rows.any(axis=1)
            active, had = active[some], rows[some]
            if not len(active):
                break
            place[:] = -1
            place[active] = np.arange(len(active))
            most = lengths if plane == PLANES - 1 else np.minimum(lengths, (2 << plane) - 1)
            share = _share(most, m)
            pairs = np.flatnonzero(place[self.pair_term] >= 0)
            for lo in range(0, len(pairs), PAIRS_AT_ONCE):  # bounded, however many terms an item has
                part = pairs[lo : lo + PAIRS_AT_ONCE]
                there = np.unpackbits(had[place[self.pair_term[part]]], axis=1, count=docs)
                item = self.pair_item[part]
                first = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
                slices = np.add.reduceat(there * self.pair_weight[part, None], first, axis=0)
                total[item[first]] += slices * (share - before)
            before = share
        return total


def _search(given: Plan, floor: np.ndarray, k: int):
    groups = [_Group(given, lo, min(lo + ITEMS_AT_ONCE, len(given.ids))) for lo in range(0, len(given.ids), ITEMS_AT_ONCE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = floor.copy()
        best: list[list[tuple[int, float, int | None]]] = [[] for _ in given.ids]
        for batch in batches:
            for i in range(batch.num_rows):
                _score(groups, given, {c: batch.column(c)[i] for c in batch.schema.names}, least, best, k)
        rows = [(given.ids[i], doc, -score) for i, top in enumerate(best) for score, _, doc in top]
        columns = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc", "score"])

    return run


def _score(groups: list[_Group], given: Plan, block: dict, least: np.ndarray, best: list, k: int) -> None:
    ids = block["ids"].as_py()
    lengths = np.frombuffer(block["lengths"].as_py(), np.int64)
    m = FLAT100 + (B100 * lengths * given.n_docs) // given.n_terms
    packed = np.frombuffer(block["signature"].as_py(), np.uint8).reshape(-1, -(-len(ids) // 8))
    starts = terms = times = None
    for group in groups:
        bound = group.bounds(packed, len(ids), lengths, m)
        possible = (bound >= np.maximum(least[group.items.start : group.items.stop, None], 1))
        docs = np.flatnonzero(possible.any(axis=0))
        if not len(docs):
            continue
        if starts is None:
            starts, terms, times = (np.frombuffer(block[c].as_py(), kind) for c, kind in (("starts", np.int64), ("terms", np.uint64), ("times", np.int32)))
        sizes = (starts[1:] - starts[:-1])[docs]
        own = np.repeat(np.arange(len(docs)), sizes)
        pick = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[docs][own]
        at = np.minimum(np.searchsorted(group.known, terms[pick]), len(group.known) - 1)
        hit = np.flatnonzero(group.known[at] == terms[pick])
        hit = hit[np.argsort(at[hit], kind="stable")]
        own, at = own[hit], at[hit]
        share = _share(times[pick][hit].astype(np.int64), m[docs][own])
        begin, end = np.searchsorted(at, np.arange(len(group.known))), np.searchsorted(at, np.arange(len(group.known)), "right")
        for i, item in enumerate(group.items):
            columns, some = group.columns[i], possible[i, docs]
            sizes = end[columns] - begin[columns]
            spot = np.arange(int(sizes.sum())) + np.repeat(begin[columns] - np.cumsum(sizes) + sizes, sizes)
            spot_weight = np.repeat(group.weights[i], sizes)
            kept = some[own[spot]]
            # whole numbers far below 2 ** 53, so sums of doubles are exact
            exact = np.bincount(own[spot[kept]], share[spot[kept]] * spot_weight[kept], len(docs)).astype(np.int64)
            good = np.flatnonzero(exact >= max(1, least[item]))
            if len(good):
                found = [(-int(exact[g]), math.inf if (d := ids[docs[g]]) is None else d, d) for g in good]
                best[item] = sorted([*best[item], *found], key=lambda x: x[:2])[:k]
                if len(best[item]) == k:
                    least[item] = max(least[item], -best[item][-1][0])


def _map(rows: DataFrame, run, schema: str) -> DataFrame:
    """``map_batches`` in smaller batches: blocks of the index are large rows."""
    out = map_batches(rows, run, schema)
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return out


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``(item, rank, document, score)``: the ``k`` highest scores above 0 of each item over all documents, equal ones
    by ascending id, in 64-bit whole numbers throughout.

    Every row is a document of its own, so repeated rows count in all figures and may all be listed; a document
    without id comes last among its equals. Null and empty texts hold no term and count nowhere. Items without id, and
    items that share no term with any document, have no rows. Other columns are ignored.

    A floor under each item's ``k``-th best score, from about ``SEED_BLOCKS`` blocks by hash, lets tasks exclude documents
    from their first block on; it is the score of real documents, so it excludes none of the answer.
    """
    spark = docs.sparkSession
    blocks = index(docs, id_col, text_col)
    kept = blocks.drop("n_docs", "n_terms")
    out = spark.createDataFrame([], "item long, doc long, score long")
    sizes = blocks.count()
    for ids, terms in items(queries, item_col, item_text_col, item_bytes):
        if not ids or not sizes:
            continue
        given = plan(blocks, ids, terms)
        none = np.zeros(len(ids), np.int64)
        some = kept.where(F.pmod(F.xxhash64("lengths", "ids"), F.lit(-(-sizes // SEED_BLOCKS))) == 0)
        seeds = _map(some, _search(given, none, k), "item long, doc long, score long")
        low = _best(seeds, k).where(F.col("rank") == k).toArrow()
        floor = none.copy()
        floor[np.searchsorted(ids, low["item"].to_numpy())] = low["score"].to_numpy()
        out = out.unionByName(_map(kept, _search(given, floor, k), "item long, doc long, score long"))
    return _best(out, k).select(F.col("item").alias(item_col), F.col("rank").alias("rank"), F.col("doc").alias(id_col), "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


ORACLE = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
tot AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, doc_id,
             sum(CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT)
                 * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nd) // l))))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN df USING (term) JOIN len USING (doc_id), tot GROUP BY item_id, doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
