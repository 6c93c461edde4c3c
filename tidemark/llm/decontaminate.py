"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared as UTF-8 bytes in lower case, where every run of other than letters, digits and non-ASCII bytes is
one space. An item of ``m`` bytes may differ from a passage by ``k`` edits. A passage within ``k`` edits shares at
least ``m + 1 - q * (k + 1)`` q-grams with the item, all on diagonals that span at most ``k``; so each lies in one of
the bands of ``2 * (k + 1)`` diagonals that start at every multiple of ``k + 1``. Bands with enough shared q-grams are
retained and verified by an alignment of the whole item inside the band. ``q`` is 12, or for a short item as much less
as it takes for at least one shared q-gram; an item without edits and under 12 bytes is one q-gram. The filter loses
nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.grams import flat, map_batches, row_blocks

Q = 12
EDIT_SHARE = 0.06
INDEX_BYTES = 16 << 20
BLOCK_BYTES = 1 << 19
STRETCH = 1 << 20
PAIRS = 1 << 19
_BITS = 20
_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, offsets, places)`` of the normalised rows; ``places`` says where in ``data`` each byte stood."""
    first, last = int(offsets[0]), int(offsets[-1])
    raw, own = data[first:last], offsets - first
    text = _FOLD[raw]
    upper = (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97) & (raw[:-1] == 0xC3)  # Latin-1 capitals
    text[1:][upper] += 32
    blank = text == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    begins = own[:-1][own[:-1] < len(text)]
    keep[begins] = ~blank[begins]
    places = np.flatnonzero(keep)
    return text[places], np.searchsorted(places, own), places


def gram_codes(text: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit code of the ``q`` bytes from each place on, at most ``Q``."""
    n = len(text) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if q < Q:
        code = np.full(n, q, np.uint64)
        for i in range(q):
            code = (code + text[i : n + i]) * _MUL[i % 3]
        return code ^ (code >> np.uint64(29))
    four = text[: len(text) - 3].astype(np.uint32)
    for i in (1, 2, 3):
        four |= text[i : len(text) - 3 + i].astype(np.uint32) << np.uint32(8 * i)
    code = four[:n] * _MUL[0]
    code += four[4 : n + 4] * _MUL[1]
    code += four[8 : n + 8] * _MUL[2]
    return code ^ (code >> np.uint64(29))


@dataclass
class Index:
    """The q-grams of the items: sorted codes, and for each the items and places that have it."""

    ids: list
    texts: list[bytes]
    edits: np.ndarray
    sizes: list[int]
    least: np.ndarray
    codes: np.ndarray
    starts: np.ndarray
    items: np.ndarray
    places: np.ndarray
    seen: np.ndarray


def build(ids: list, texts: list[str | None], edit_share: float = EDIT_SHARE) -> Index:
    """Null texts and those without a letter or digit are left out."""
    offsets, data = flat(pa.array(texts, pa.string()))
    text, own, _ = normalise(data, offsets)
    plain = [text[a:b].tobytes().rstrip(b" ") for a, b in zip(own, own[1:])]
    keep = [i for i, t in enumerate(plain) if t]
    plain = [plain[i] for i in keep]
    sizes = np.array([len(t) for t in plain], np.int64)
    edits = np.minimum((sizes * edit_share).astype(np.int64), sizes - 1)
    qs = np.minimum(Q, sizes // (edits + 1))
    grams = [gram_codes(np.frombuffer(t, np.uint8), q) for t, q in zip(plain, qs.tolist())]
    code = np.concatenate([*grams, np.zeros(0, np.uint64)])
    item = np.repeat(np.arange(len(plain)), [len(g) for g in grams])
    place = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(code, kind="stable")
    codes, starts = np.unique(code[order], return_index=True)
    seen = np.zeros(1 << _BITS, bool)
    seen[codes >> np.uint64(64 - _BITS)] = True
    return Index([ids[i] for i in keep], plain, edits, sorted(set(qs.tolist())), sizes + 1 - qs * (edits + 1), codes, np.append(starts, len(code)), item[order], place[order], seen)


def align(item: bytes, region: bytes, most: int) -> tuple[int, int, int] | None:
    """``(edits, start, end)`` of the passage in ``region`` closest to the whole item, the earliest of equals, or None
    if it takes more than ``most`` edits. Rows of the table are diagonals of the region; cost and start go together
    in one number."""
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    if not most:
        return None
    edge = np.full(most + len(item), 255, np.uint8)  # no text has this byte: reaching past the region costs edits
    doc = np.concatenate([edge[:most], np.frombuffer(region, np.uint8), edge])
    # starts further right would run past the region by more than all edits; paths stray by that many diagonals at most
    width = min(len(region) + most + 1, len(region) - len(item) + 3 * most + 1)
    if width <= 0:
        return None
    one = np.int64(1 << 32)
    ramp = np.arange(width, dtype=np.int64) * one
    cost = np.arange(width, dtype=np.int64)
    for i, char in enumerate(item):
        now = cost + (doc[i : i + width] != char) * one
        now[:-1] = np.minimum(now[:-1], cost[1:] + one)
        cost = np.minimum.accumulate(now - ramp) + ramp
    best = int(np.argmin(cost))
    edits, start, end = int(cost[best] >> 32), int(cost[best] & 0xFFFFFFFF) - most, best + len(item) - most
    return (edits, max(0, start), max(0, min(len(region), end))) if edits <= most else None


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of ``keys`` once each, in order, with their counts added up."""
    order = np.lexsort(keys[::-1])
    keys, counts = keys[:, order], counts[order]
    fresh = np.ones(keys.shape[1], bool)
    fresh[1:] = (keys[:, 1:] != keys[:, :-1]).any(0)
    first = np.flatnonzero(fresh)
    return keys[:, first], np.add.reduceat(counts, first) if len(first) else counts


def _bands(where: np.ndarray, slot: np.ndarray, row: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """``(row, item, band)`` columns and how many q-grams each band shares. Where a phrase repeats in text and item,
    their pairs of places are many more than bands: pairs are made ``PAIRS`` at a time and counted at once."""
    times = index.starts[slot + 1] - index.starts[slot]
    ends = np.cumsum(times)
    parts, held = [(np.zeros((3, 0), np.int64), np.zeros(0, np.int64))], 0
    for at in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        pair = np.arange(at, min(at + PAIRS, int(ends[-1])))
        hit = np.searchsorted(ends, pair, "right")
        entry = index.starts[slot[hit]] + pair - ends[hit] + times[hit]
        item = index.items[entry]
        band = (where[hit] - index.places[entry]) // (index.edits[item] + 1)
        keys = np.concatenate([np.stack([row[hit], item, band]), np.stack([row[hit], item, band - 1])], 1)
        parts.append(_added(keys, np.ones(keys.shape[1], np.int64)))
        held += len(parts[-1][1])
        if held > 2 * PAIRS:
            parts = [_added(*(np.concatenate(x, -1) for x in zip(*parts)))]
            held = len(parts[0][1]) // 2  # what is left grows with the bands alone
    return _added(*(np.concatenate(x, -1) for x in zip(*parts)))


def find(text: np.ndarray, own: np.ndarray, index: Index) -> Iterator[tuple[int, int, int, int, int, int]]:
    """``(row, item, edits, start, end, shared)``: of each row and item the closest passage, places counted from the
    start of the row; ``shared`` is the most q-grams a retained band has."""
    hits = []
    for q, at in ((q, at) for q in index.sizes for at in range(0, max(0, len(text) - q + 1), STRETCH)):
        code = gram_codes(text[at : at + STRETCH + q - 1], q)
        maybe = np.flatnonzero(index.seen[code >> np.uint64(64 - _BITS)])
        if not len(maybe) or not len(index.codes):
            continue
        slot = np.minimum(np.searchsorted(index.codes, code[maybe]), len(index.codes) - 1)
        real = index.codes[slot] == code[maybe]
        hits.append((maybe[real] + at, slot[real], np.full(int(real.sum()), q)))
    if not hits:
        return
    where, slot, size = (np.concatenate(x) for x in zip(*hits))
    row = np.searchsorted(own, where, "right") - 1
    whole = where + size <= own[row + 1]
    where, slot, row = where[whole], slot[whole], row[whole]
    keys, counts = _bands(where - own[row], slot, row, index)
    kept = counts >= index.least[keys[1]]
    best: dict[tuple[int, int], tuple] = {}
    for (r, i, b), n in zip(keys[:, kept].T.tolist(), counts[kept].tolist()):
        k, size, begin, end = int(index.edits[i]), len(index.texts[i]), int(own[r]), int(own[r + 1])
        lo = max(0, b * (k + 1) - k)
        hi = min(end - begin, (b + 2) * (k + 1) + size + k)
        old = best.get((r, i))
        if old and old[0] == 0 and old[1] <= lo:
            best[r, i] = (*old[:3], max(n, old[3]))
            continue
        found = align(index.texts[i], text[begin + lo : begin + hi].tobytes(), k)
        if found:
            new = (found[0], found[1] + lo, found[2] + lo, n)
            best[r, i] = (*min(old[:3], new[:3]), max(n, old[3])) if old else new
    for (r, i), (edits, start, end, n) in sorted(best.items()):
        yield r, i, edits, start, end, n


def _passages(texts: pa.Array, index: Index) -> Iterator[tuple[int, int, int, int, int, int]]:
    """As ``find``, for a whole column, with places as characters of the text as it is."""
    offsets, data = flat(texts)
    for a, b in row_blocks(offsets, BLOCK_BYTES):
        part = offsets[a : b + 1]
        text, own, places = normalise(data, part)
        for row, item, edits, start, end, n in find(text, own, index):
            begin = int(part[row])
            spot = lambda p: int(np.count_nonzero((data[begin : int(part[0]) + int(places[own[row] + p])] & 0xC0) != 0x80))
            yield a + row, item, edits, spot(start), spot(end - 1) + 1, n


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", edit_share: float = EDIT_SHARE, index_bytes: int = INDEX_BYTES) -> Iterator[Index]:
    """The items' indexes: one if the items have at most ``index_bytes`` bytes, as is checked before they are read,
    else as many as it takes, each of a share of the items by hash."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("n")).first()["n"]
    parts = -(-size // index_bytes) or 1
    share = F.pmod(F.xxhash64(text_col), F.lit(parts))
    for part in range(parts):
        rows = benchmark.where(share == part).select(id_col, text_col).toArrow()
        yield build(rows[id_col].to_pylist(), rows[text_col].to_pylist(), edit_share)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", **limits) -> DataFrame:
    """A row for each document and benchmark item it contains: both ids, ``edits``, ``start_char`` and ``end_char`` of
    the closest passage and ``shared_grams``. Clean documents have no row. Null and empty texts are clean; repeated
    rows are reported as often as they occur. No shuffle: the items' index, whose size is checked, goes to the tasks."""
    kept = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    doc_kind, item_kind = kept.schema["_id"].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    names = [id_col, item_col, "edits", "start_char", "end_char", "shared_grams"]

    def scan(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = list(_passages(batch.column(1), index))
                if rows:
                    row, item, *numbers = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row)), pa.array([index.ids[i] for i in item]), *(pa.array(x, pa.int64()) for x in numbers)], names=names)

        return run

    schema = f"`{id_col}` {doc_kind}, `{item_col}` {item_kind}, edits long, start_char long, end_char long, shared_grams long"
    out = None
    for index in indexes(benchmark, item_col, item_text_col, **limits):
        found = map_batches(kept, scan(index), schema)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", **limits) -> DataFrame:
    """The documents that contain no item, with all their columns; map-only."""

    def sieve(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask = np.ones(batch.num_rows, bool)
                mask[[row for row, *_ in _passages(batch.column(text_col), index)]] = False
                yield batch.filter(pa.array(mask))

        return run

    for index in indexes(benchmark, item_col, item_text_col, **limits):
        docs = map_batches(docs, sieve(index), docs.schema)
    return docs
