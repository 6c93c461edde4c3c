"""SentencePiece encoding and decoding, giant documents in chunks joined by a max-plus scan.

The pieces of a text are the best path from its start to its end in a graph whose nodes are "piece t ends at place j".
A step from t to the next piece u has the weight ``score(u)`` if the model leaves t and u next to each other, else
minus infinity. For a BPE model that is so exactly if the pair's own text is encoded as t, u: a segmentation whose
neighbouring pieces all agree in that way is the encoding, and there is only one. So any stretch of a path is the
encoding of its own text, and stretches can be put together wherever the two pieces at the seam agree.

A text of up to ``CHUNK`` characters is one chunk. A longer one is cut at multiples of it. The states of a cut are the
pieces that may lie across it; each chunk yields the matrix of best weights from the states of its left cut to those
of its right cut, computed from the chunk and a margin alone; the matrices are combined from the left in the (max, +)
algebra, which is associative, so that they may be combined in any grouping; from the end backwards the best state of
each cut is fixed; and each chunk is then encoded on its own between its two states.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.grams import flat, map_batches, row_blocks
from tidemark.session import cut

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 65536
MARGIN = 64
LONGEST = 16
BLOCK_BYTES = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)
NEVER = -np.inf


class Codec:
    """A model with what the scan needs: fragments encoded as they are, in the middle of a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.bytes = {i: bytes([int(p[3:5], 16)]) for i, p in enumerate(self.pieces) if self.model.is_byte(i)}
        self.plain = {p: i for i, p in enumerate(self.pieces) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))}
        self.score = [self.model.get_score(i) for i in range(size)]
        self.scores = np.array(self.score)
        # characters an id adds: a byte counts as one where it begins a character
        self.lengths = np.array([len(p) if i not in self.bytes else int(self.bytes[i][0] & 0xC0 != 0x80) for i, p in enumerate(self.pieces)])
        # a line feed merges with nothing, so what follows it is encoded as in the middle of a text
        self.guard = self.model.encode("\n")
        self.agrees = lru_cache(maxsize=1 << 18)(self._agrees)

    def whole(self, text: str) -> list[int]:
        return self.model.encode(text)

    def middle(self, text: str) -> list[int]:
        return self.model.encode("\n" + text)[len(self.guard):] if text else []

    def tokens(self, text: str) -> list[tuple[str, tuple[int, ...]]]:
        """Fragment as ``(characters, ids)``; a character without a piece has the ids of its bytes."""
        out, byte, ids = [], b"", []
        for i in self.middle(text):
            if i not in self.bytes:
                out.append((self.pieces[i], (i,)))
                continue
            byte, ids = byte + self.bytes[i], [*ids, i]
            try:
                out.append((byte.decode(), tuple(ids)))
            except UnicodeDecodeError:
                continue
            byte, ids = b"", []
        return out

    def _agrees(self, left: str, right: str) -> bool:
        found = self.tokens(left + right)
        return len(found) == 2 and found[0][0] == left

    def weight(self, token: tuple[str, tuple[int, ...]]) -> float:
        return sum(self.score[i] for i in token[1])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def escaped(text: str) -> str:
    """The text as the model sees it: one space in front, spaces as the model's mark."""
    return ("▁" + text.replace(" ", "▁")) if text else ""


def states(code: Codec, text: str, cut: int) -> list[tuple[int, str]]:
    """``(end, piece)`` of every piece that may lie across or end at the cut: it starts before ``cut`` and ends at it or later."""
    out = []
    for start in range(max(0, cut - LONGEST), cut):
        for end in range(cut, min(len(text), start + LONGEST) + 1):
            piece = text[start:end]
            if piece in code.plain or len(piece) == 1:
                out.append((end, piece))
    return out


@dataclass
class Core:
    """Encoding of a chunk: where its tokens begin, and the running weight before each."""

    text: str
    begin: int
    starts: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, code: Codec, text: str, begin: int, end: int) -> Core:
        ids = np.array(code.middle(text[begin:end]), np.int64)
        lengths = code.lengths[ids]
        starts = begin + np.cumsum(lengths) - lengths
        sums = np.concatenate([[0.0], np.cumsum(code.scores[ids])])
        first = lengths > 0  # continuation bytes belong to the character before
        return cls(text, begin, np.append(starts[first], end), np.append(sums[:-1][first], sums[-1]))

    def token(self, n: int) -> str:
        return self.text[self.starts[n] : self.starts[n + 1]]

    def at(self, place: int) -> int | None:
        """The token that begins at a place; the number of tokens for the chunk's end."""
        n = int(np.searchsorted(self.starts, place))
        return n if n < len(self.starts) and self.starts[n] == place else None


def _heads(code: Codec, core: Core, start: int, limit: int) -> tuple | None:
    """``(seam, weight, first piece)``: the path from ``start`` to where it goes on as the core's token ``seam``."""
    last = len(core.starts) - 1
    n = core.at(start)
    if n is not None and n < last:
        return n, 0.0, core.token(n)
    window, place, weight = code.tokens(core.text[start : min(limit, start + MARGIN)]), start, 0.0
    for token in window:
        place, weight = place + len(token[0]), weight + code.weight(token)
        n = core.at(place)
        if n is not None and n < last and code.agrees(token[0], core.token(n)):
            return n, weight, window[0][0]
    return None


def _tails(code: Codec, core: Core, end: int, stop: int) -> tuple | None:
    """``(seam, weight, last piece)``: the path to ``stop`` that leaves the core before its token ``seam``."""
    count = len(core.starts) - 1
    if stop == end and count:
        return count, 0.0, core.token(count - 1)
    place = max(core.begin, stop - MARGIN)
    window = code.tokens(core.text[place:stop])
    for i, token in enumerate(window):
        n = core.at(place)
        if n and code.agrees(core.token(n - 1), token[0]):
            return n, sum(code.weight(t) for t in window[i:]), window[-1][0]
        place += len(token[0])
    return None


def transfer(code: Codec, text: str, left: list[tuple[int, str | None]], right: list[tuple[int, str | None]], begin: int, end: int) -> np.ndarray:
    """Best weights from each state of the left cut to each of the right cut of the chunk ``[begin, end)``.

    The chunk is encoded once; the places where paths may enter and leave it differ only near the cuts, where margins
    are encoded and put together with it at the first place of agreement. Where a margin finds none, or the two
    seams cross, the stretch is encoded as a whole. A state without piece, as at the ends of a text, agrees with all.
    """
    matrix = np.full((len(left), len(right)), NEVER)
    core = Core.of(code, text, begin, end)
    heads = {j: _heads(code, core, j, end) for j in {j for j, _ in left}}
    tails = {k: _tails(code, core, end, k) for k in {k for k, _ in right}}
    for j, head in heads.items():
        for k, tail in tails.items():
            if j >= k:
                continue
            if head and tail and head[0] < tail[0]:
                first, last, weight = head[2], tail[2], head[1] + core.weights[tail[0]] - core.weights[head[0]] + tail[1]
            else:
                path = code.tokens(text[j:k])
                first, last, weight = path[0][0], path[-1][0], sum(map(code.weight, path))
            for a in [a for a, (at, piece) in enumerate(left) if at == j and (piece is None or code.agrees(piece, first))]:
                for b in [b for b, (to, piece) in enumerate(right) if to == k and piece in (None, last)]:
                    matrix[a, b] = max(matrix[a, b], weight)
    return matrix


def combine(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The (max, +) product of two matrices."""
    if not first.size or not second.size:
        return np.full((first.shape[0], second.shape[1]), NEVER)
    return (first[:, :, None] + second[None, :, :]).max(1)


def trace(matrices: list[np.ndarray]) -> list[int]:
    """The state at each inner cut on the best path; the first matrix has one row (the start), the last one column."""
    best = [np.zeros((1, 1))]
    for m in matrices:
        best.append(combine(best[-1], m))
    out, state = [], 0
    for n in range(len(matrices) - 1, 0, -1):
        state = int(np.argmax(best[n][0] + matrices[n][:, state]))
        out.append(state)
    return out[::-1]


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def digest(ids: list[int]) -> np.uint64:
    """Sum of ``(id + 1) * BASE ** place`` modulo 2 ** 64, so that digests of chunks add up to that of the document."""
    return ((np.array(ids, np.uint64) + np.uint64(1)) * powers(len(ids))).sum() if ids else np.uint64(0)


def decode(code: Codec, ids: list[int], first: bool) -> str:
    """The text of a chunk's ids; in the middle of a document no space is taken off the front."""
    if not ids:
        return ""
    return code.model.decode(ids) if first else code.model.decode([*code.guard, *ids])[1:]


def _bounds(length: int, chunk: int) -> list[int]:
    """Cuts of an escaped text, its start and end included; the last chunk is not shorter than half a chunk."""
    cuts = list(range(0, max(1, length - chunk // 2), chunk))
    return [*cuts, length]


SCHEMA = "_key string, _id {id}, chunk int, n_chunks int, ids array<int>, n_tokens int, ids_digest long, round_trip boolean"
CHUNK_SCHEMA = "_key string, _id {id}, chunk int, n_chunks int, lead int, length int, slice string, has_next boolean, marked boolean"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into stretches of few bytes of text: lists of ids take many times the memory of their text."""
    for batch in batches:
        for a, b in row_blocks(flat(batch.column(1))[0], BLOCK_BYTES):
            yield batch.slice(a, b - a)


def _short(path: str):
    """Texts of one chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in _blocks(batches):
            texts = [t.as_py() or "" for t in batch.column(1)]
            ids = code.model.encode(texts)
            back = code.model.decode(ids) if ids else []
            n = len(texts)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(n, pa.string()), batch.column(0), pa.array([0] * n, pa.int32()), pa.array([1] * n, pa.int32()), pa.array(ids, pa.list_(pa.int32())),
                pa.array([len(x) for x in ids], pa.int32()), pa.array([int(digest(x).astype(np.int64)) for x in ids], pa.int64()),
                pa.array([a == b for a, b in zip(back, texts)], pa.bool_()),
            ], names=["_key", "_id", "chunk", "n_chunks", "ids", "n_tokens", "ids_digest", "round_trip"])

    return run


def _cutter(chunk: int):
    """Rows of chunks, each with what lies up to ``LONGEST`` before and after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = 0
        names = ["_key", "_id", "chunk", "n_chunks", "lead", "length", "slice", "has_next", "marked"]
        for batch in batches:
            for row in range(batch.num_rows):
                given = batch.column(1)[row].as_py()
                text = escaped(given)
                cuts = _bounds(len(text), chunk)
                key = f"{TaskContext.get().partitionId()}-{number}"
                number += 1
                for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    lead = min(a, LONGEST)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([key]), batch.column(0).slice(row, 1), pa.array([n], pa.int32()), pa.array([len(cuts) - 1], pa.int32()), pa.array([lead], pa.int32()),
                        pa.array([b - a], pa.int32()), pa.array([text[a - lead : b + 2 * LONGEST]]), pa.array([b < len(text)]),
                        pa.array(["▁" in given[max(0, a - 1) : b]]),
                    ], names=names)

    return run


def _frame(code: Codec, row: dict) -> tuple[list, list, int, int]:
    """States at both cuts of a chunk, and where it begins and ends in its slice."""
    text, begin, end = row["slice"], row["lead"], row["lead"] + row["length"]
    left = states(code, text, begin) if row["chunk"] else [(0, None)]
    right = states(code, text, end) if row["has_next"] else [(len(text), None)]
    return left, right, begin, end


def _matrices(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in batches:
            for row in batch.to_pylist():
                left, right, begin, end = _frame(code, row)
                m = transfer(code, row["slice"], left, right, begin, end)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["_key"]]), pa.array([row["chunk"]], pa.int32()), pa.array([m.shape[0]], pa.int32()), pa.array([m.ravel().tolist()], pa.list_(pa.float64())),
                ], names=["_key", "chunk", "height", "matrix"])

    return run


def _backtrace(table: pa.Table) -> pa.Table:
    """The states on the best path of one document: ``enter`` and ``leave`` of each chunk (-1 at the ends of the text)."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    path = trace([np.array(r["matrix"]).reshape(r["height"], -1) for r in rows])
    n = len(rows)
    return pa.table({
        "_key": pa.array([r["_key"] for r in rows]), "chunk": pa.array(range(n), pa.int32()),
        "enter": pa.array([-1, *path], pa.int32()), "leave": pa.array([*path, -1], pa.int32()),
    })


def _between(path: str, kind: pa.DataType):
    """Each chunk encoded between its two states, and decoded again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in batches:
            for row in batch.to_pylist():
                left, right, _, _ = _frame(code, row)
                begin = left[row["enter"]][0] if row["enter"] >= 0 else 0
                end = right[row["leave"]][0] if row["leave"] >= 0 else len(row["slice"])
                text = row["slice"][begin:end]
                ids = code.middle(text)
                plain = text.replace("▁", " ")
                back = decode(code, ids, row["chunk"] == 0)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["_key"]]), pa.array([row["_id"]], kind), pa.array([row["chunk"]], pa.int32()), pa.array([row["n_chunks"]], pa.int32()),
                    pa.array([ids], pa.list_(pa.int32())), pa.array([len(ids)], pa.int32()), pa.array([int(digest(ids).astype(np.int64))], pa.int64()),
                    pa.array([back == (plain[1:] if row["chunk"] == 0 else plain) and not row["marked"]], pa.bool_()),
                ], names=["_key", "_id", "chunk", "n_chunks", "ids", "n_tokens", "ids_digest", "round_trip"])

    return run


def _parts(docs: DataFrame, id_col: str, text_col: str, model: str, chunk: int) -> tuple[DataFrame, DataFrame]:
    """Rows of texts of one chunk, and of the chunks of giant ones."""
    from pyspark.sql.pandas.types import to_arrow_type

    kept = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind, arrow = kept.schema["_id"].dataType.simpleString(), to_arrow_type(kept.schema["_id"].dataType)
    giant = F.coalesce(F.length("_text"), F.lit(0)) > chunk
    short = map_batches(kept.where(~giant), _short(model), SCHEMA.format(id=kind))
    cuts = cut(map_batches(kept.where(giant), _cutter(chunk), CHUNK_SCHEMA.format(id=kind)), "chunks")
    spread = cuts.repartition(F.col("_key"), F.col("chunk"))
    matrices = map_batches(spread, _matrices(model), "_key string, chunk int, height int, matrix array<double>")
    path = matrices.groupBy("_key").applyInArrow(_backtrace, "_key string, chunk int, enter int, leave int")
    joined = cuts.join(path, ["_key", "chunk"])
    long = map_batches(joined, _between(model, arrow), SCHEMA.format(id=kind))
    return short, long


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """``(_key, id, chunk, n_chunks, ids, n_tokens, ids_digest, round_trip)``: the ids of every whole text, a row for each chunk.

    The chunks of a document, in order, are its encoding, the same as the model gives for the text in one piece.
    ``round_trip`` says that decoding the chunk gives its text; it fails only where a text has the model's own mark
    for a space. Null and empty texts have no ids. Repeated rows are encoded each on its own; ``_key`` tells giant
    documents of one id apart and is null for the others. Other columns are ignored. ``model`` is a file that every
    executor can read.
    """
    short, long = _parts(docs, id_col, text_col, model, chunk)
    return short.unionByName(long).withColumnRenamed("_id", id_col)


def _total(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    at, total = 0, 0
    for r in rows:
        total = (total + (r["ids_digest"] % (1 << 64)) * pow(int(BASE), at, 1 << 64)) % (1 << 64)
        at += r["n_tokens"]
    signed = total - (1 << 64) if total >= 1 << 63 else total
    return pa.table({
        "_id": table.column("_id").slice(0, 1), "n_tokens": pa.array([at], pa.int64()), "n_chunks": pa.array([len(rows)], pa.int32()),
        "ids_digest": pa.array([signed], pa.int64()), "round_trip": pa.array([all(r["round_trip"] for r in rows)]),
    })


def per_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """One row per document: number of tokens and chunks, the digest of all its ids, and whether decoding gave the text."""
    short, long = _parts(docs, id_col, text_col, model, chunk)
    one = short.select("_id", F.col("n_tokens").cast("long").alias("n_tokens"), "n_chunks", "ids_digest", "round_trip")
    kind = one.schema["_id"].dataType.simpleString()
    several = long.drop("ids").groupBy("_key").applyInArrow(_total, f"_id {kind}, n_tokens long, n_chunks int, ids_digest long, round_trip boolean")
    return one.unionByName(several).withColumnRenamed("_id", id_col)
