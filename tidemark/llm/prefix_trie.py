"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path of turn keys. Paths are dealt into shards by ranges of their order; the bounds of the ranges,
the splitters, come from a bounded sample. Members of a node are neighbours in that order, so a node whose members lie
in several shards is a prefix of a splitter: these nodes are the skeleton, and the trie of splitter paths is
broadcast. Each shard, sorted, finishes all its other nodes alone, whole subtrees included. For skeleton nodes it gives
partial aggregates, which one reduction by node combines; what skeleton nodes add to each other goes up along their
known ancestors.

Paths longer than ``STRATUM`` turns go on in a further stratum: a row is the piece of a path in one stratum, ordered
behind the hash of all that comes before it. So no row, shard or group grows with a conversation. Totals of deeper
strata are given to the smallest member of their top node and enter the shards of higher strata as sums along that member's
path. Turns are compared by the MD5 of role and text, longer beginnings by two 64-bit hashes besides.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.grams import map_batches
from tidemark.session import cut, share_code

STRATUM = 32
SHARD_ROWS = 2048
MAX_SHARDS = 8192
SAMPLE = 4
KEY = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODES = pa.schema([
    ("kind", pa.int32()), ("depth", pa.int64()), ("conv", pa.int64()), ("parent_conv", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved", pa.int64()), ("words", pa.int64()), ("sha", pa.string()), ("own", pa.binary()), ("parent", pa.binary()),
    ("next", pa.binary()), ("stratum", pa.int64()), ("shard", pa.int64()), ("ends", pa.binary()), ("above", pa.list_(pa.binary()))])
NODES = ("kind int, depth long, conv long, parent_conv long, n_convs long, n_children long, n_leaves long, saved long, words long, sha string, "
         "own binary, parent binary, next binary, stratum long, shard long, ends binary, above array<binary>")
LOCAL, SKELETON, TOP = 0, 1, 2


def numbered(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``(conv, at, key, words)`` of every turn: ``at`` counts from 1 by turn number, null first, turns of one number
    by their key. A conversation of any length is numbered in ranges, whose offsets are added; no window holds it whole."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), key.alias("key"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = ["conv", F.asc_nulls_first("turn"), "key"]
    ranged = cut(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "trie-turns")
    local = ranged.withColumn("at", F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order[1:])).cast("long"))
    sizes = ranged.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv", "part", F.sum("n").over(before).alias("skip")).where(F.col("skip") > 0)
    return local.join(offsets, ["conv", "part"], "left").select("conv", (F.col("at") + F.coalesce("skip", F.lit(0))).alias("at"), "key", "words")


def rebuilt(turns: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Numbered turns with their beginnings exchanged: conversation ``c`` begins with the first ``crc32(c) % most``
    turns of conversation ``c - c % family`` and goes on with its own turns after as many. Returns the turns and the
    conversations with their new lengths ``total``, those left without a turn included."""
    turns = cut(turns, "trie-numbered")
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).select(
        "conv", "n", (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h"), (F.col("conv") - F.col("conv") % family).alias("base"))
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = cut(convs.withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).drop("base_n"), "trie-conversations")
    heads = turns.where(F.col("at") < most).withColumnRenamed("conv", "base")
    begun = convs.where(F.col("taken") > 0).join(heads, "base").where(F.col("at") <= F.col("h")).select("conv", F.col("at").alias("depth"), "key", "words")
    own = turns.join(convs.select("conv", "h", "taken"), "conv").where(F.col("at") > F.col("h"))
    return begun.unionByName(own.select("conv", (F.col("at") - F.col("h") + F.col("taken")).alias("depth"), "key", "words")), convs.select("conv", "total")


def paths(turns: DataFrame, convs: DataFrame, stratum: int = STRATUM) -> DataFrame:
    """A row for each conversation and stratum it reaches: ``keys`` and ``words`` of its turns there, whether ``more``
    follow, and the hashes of all turns before the row (``r1, r2``) and up to its end (``e1, e2``)."""
    held = turns.groupBy("conv", F.floor((F.col("depth") - 1) / stratum).alias("stratum")).agg(F.sort_array(F.collect_list(F.struct("depth", "key", "words"))).alias("turns"))
    none = convs.where(F.col("total") == 0).select("conv", F.lit(0).cast("long").alias("stratum"), F.array().cast("array<binary>").alias("keys"), F.array().cast("array<long>").alias("words"))
    rows = held.select("conv", "stratum", F.col("turns.key").alias("keys"), F.col("turns.words").alias("words")).unionByName(none).join(convs, "conv")
    rows = rows.select("conv", "stratum", "keys", "words", (F.col("total") > (F.col("stratum") + 1) * stratum).alias("more"))
    before = Window.partitionBy("conv").orderBy("stratum").rowsBetween(Window.unboundedPreceding, -1)
    for i in ("1", "2"):
        rows = rows.withColumn(f"o{i}", F.xxhash64("keys", "stratum", F.lit(i)))
    for i in ("1", "2"):
        rows = rows.withColumn(f"r{i}", F.coalesce(F.bit_xor(f"o{i}").over(before), F.lit(0).cast("long")))
    return rows.select("conv", "stratum", "keys", "words", "more", "r1", "r2", *(F.col(f"r{i}").bitwiseXOR(F.col(f"o{i}")).alias(f"e{i}") for i in "12"))


Place = tuple[int, int, int, bytes, int]


def _places(columns: dict[str, pa.Array]) -> list[Place]:
    joined = (b"".join(k) for k in columns["keys"].to_pylist())
    return list(zip(*(columns[c].to_pylist() for c in ("stratum", "r1", "r2")), joined, columns["conv"].to_pylist()))


def splitters(rows: DataFrame, shard_rows: int = SHARD_ROWS, max_shards: int = MAX_SHARDS) -> list[Place]:
    """Bounds that cut the order of paths into shards of about ``shard_rows`` rows, or of more once there are
    ``max_shards``, which bounds what is broadcast: a bound has at most one stratum of keys. They are taken from a
    sample by hash of ``SAMPLE`` rows a shard; where they lie changes no result."""
    n = rows.count()
    shards = min(max_shards, -(-n // shard_rows))
    if shards <= 1:
        return []
    even = F.pmod(F.xxhash64("conv", "stratum", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    got = rows.where(even < SAMPLE * shards / n).select("conv", "stratum", "keys", "r1", "r2").toArrow()
    found = sorted(_places({c: got[c] for c in got.column_names}))
    return sorted({found[i * len(found) // shards] for i in range(1, shards)}) if found else []


def _key(stratum: int, r1: int, r2: int, path: bytes) -> bytes:
    return hashlib.blake2b(b"%d,%d,%d," % (stratum, r1, r2) + path, digest_size=16).digest()


def _grid(paths_: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(p.ljust(width * KEY, b"\0") for p in paths_), np.uint64).reshape(len(paths_), width, 2)


def _shared(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many leading keys two rows of each pair have in common, at most ``most``."""
    same = (a == b).all(axis=2)
    return np.minimum(np.logical_and.accumulate(same, axis=1).sum(axis=1), most)


def shard_nodes(number: int, table: pa.Table, bounds: list[Place], stratum: int) -> pa.Table:
    """All nodes of a shard: local ones finished, skeleton nodes and tops of deeper strata as partial aggregates."""
    given = _places({c: table[c] for c in table.column_names})
    order = sorted(range(len(given)), key=given.__getitem__)
    rows = [given[i] for i in order]
    n = len(rows)
    column = lambda c: table[c].take(pa.array(order)).to_pylist()
    conv = np.array([r[4] for r in rows], np.int64)
    size = np.array([len(r[3]) // KEY for r in rows])
    more, below = np.array(column("more"), bool), [np.array(column(c), np.int64) for c in ("below_leaves", "below_saved")]
    last = [_key(r[0] + 1, e1, e2, b"") if m else None for r, e1, e2, m in zip(rows, column("e1"), column("e2"), more)]
    width = int(size.max())
    words = np.zeros((n, width + 1), np.int64)
    for i, w in enumerate(column("words")):
        words[i, 1 : len(w) + 1] = w
    grid = _grid([r[3] for r in rows], width)
    common = np.full(n, -1)
    if n > 1:
        together = np.array([a[:3] == b[:3] for a, b in zip(rows, rows[1:])])
        common[1:] = np.where(together, _shared(grid[1:], grid[:-1], np.minimum(size[1:], size[:-1])), -1)
    frame = np.full(n, 0)  # how many leading keys a row has in common with a neighbouring bound
    for bound in bounds[max(0, number - 1) : number + 1]:
        near = np.array([r[:3] == bound[:3] for r in rows])
        if near.any():
            cut_short = bound[3][: width * KEY]
            frame = np.where(near, np.maximum(frame, _shared(grid, _grid([cut_short], width), np.minimum(size, len(cut_short) // KEY))), frame)

    out: list[dict] = []
    child = None
    for depth in range(width, -1, -1):
        starts = np.flatnonzero(common < depth)
        to = np.append(starts[1:], n)
        held = [np.add.reduceat(b, starts) for b in below]
        least = np.minimum.reduceat(conv, starts)
        stops = ~more & (size == depth)
        stop = np.add.reduceat(stops.astype(np.int64), starts)
        valid = size[starts] >= depth
        starts, to, least, stop, held = starts[valid], to[valid], least[valid], stop[valid], [h[valid] for h in held]
        m = len(starts)
        skeleton = frame[starts] >= depth
        children, leaves, saved = (np.zeros(m, np.int64) for _ in range(3))
        if child is not None:
            parent = np.searchsorted(starts, child["starts"], "right") - 1
            np.add.at(children, parent[~child["skeleton"]], 1)
            np.add.at(leaves, parent, child["leaves"])
            np.add.at(saved, parent, child["saved"])
        # the row whose continuation names the node's place as a top of the next stratum
        goes_on = [None] * m
        if depth == stratum:
            for i in range(m):
                goes_on[i] = next((last[j] for j in range(starts[i], to[i]) if last[j] is not None), None)
        crossing = np.array([g is not None for g in goes_on], bool)
        leaves = leaves + ((children == 0) & ~skeleton & ~crossing)
        saved = saved + np.where(skeleton, 0, (to - starts - 1) * (words[starts, depth]))
        now = {"starts": starts, "skeleton": skeleton, "leaves": leaves, "saved": saved, "least": least}
        if child is not None:
            _emit(out, child, parent, now, rows, depth)
        now |= {"depth": depth, "to": to, "children": children, "held": held, "stop": stop, "stops": stops, "goes_on": goes_on, "words": words[starts, depth]}
        child = now
    _emit(out, child, None, None, rows, -1)

    return pa.concat_tables([_table(part, rows, conv, number, stratum) for part in out])


def _emit(out: list[dict], nodes: dict, parent: np.ndarray | None, above: dict | None, rows: list[Place], depth: int) -> None:
    """Keep the nodes of a depth with what they know of their parents: the id where those are local, else the key."""
    m = len(nodes["starts"])
    ids, keys = [None] * m, [None] * m
    for i in range(m) if above is not None else ():
        p = parent[i]
        if above["skeleton"][p]:
            r = rows[above["starts"][p]]
            keys[i] = _key(*r[:3], r[3][: depth * KEY])
        else:
            ids[i] = int(above["least"][p])
    out.append(nodes | {"parent_ids": ids, "parent_keys": keys})


def _table(nodes: dict, rows: list[Place], conv: np.ndarray, number: int, stratum: int) -> pa.Table:
    depth, starts = nodes["depth"], nodes["starts"]
    m = len(starts)
    kind = np.where(nodes["skeleton"], SKELETON, LOCAL)
    if depth == 0:
        kind = np.array([SKELETON if rows[s][0] == 0 else TOP for s in starts])
    keys, above, sha, ends = [None] * m, [None] * m, [None] * m, [None] * m
    for i in range(m):
        s, e = int(starts[i]), int(nodes["to"][i])
        listed = b""
        if nodes["stop"][i]:
            listed = ",".join(map(str, conv[s:e][nodes["stops"][s:e]].tolist())).encode()
        if kind[i] == LOCAL:
            sha[i] = hashlib.sha256(listed).hexdigest() if listed else NO_ENDS
        else:
            r = rows[s]
            keys[i] = _key(*r[:3], r[3][: depth * KEY])
            if kind[i] == SKELETON:
                above[i] = [_key(*r[:3], r[3][: d * KEY]) for d in range(depth + 1)]
                ends[i] = listed
    first = [rows[s][0] for s in starts]
    return pa.table({
        "kind": pa.array(kind, pa.int32()), "depth": pa.array([f * stratum + depth for f in first], pa.int64()), "conv": pa.array(nodes["least"]),
        "parent_conv": pa.array(nodes["parent_ids"], pa.int64()), "n_convs": pa.array(nodes["to"] - starts), "n_children": pa.array(nodes["children"]),
        "n_leaves": pa.array(nodes["leaves"] + nodes["held"][0]), "saved": pa.array(nodes["saved"] + nodes["held"][1]), "words": pa.array(nodes["words"]),
        "sha": pa.array(sha, pa.string()), "own": pa.array(keys, pa.binary()), "parent": pa.array(nodes["parent_keys"], pa.binary()),
        "next": pa.array(nodes["goes_on"], pa.binary()), "stratum": pa.array(first, pa.int64()), "shard": pa.array([number] * m, pa.int64()),
        "ends": pa.array(ends, pa.binary()), "above": pa.array(above, pa.list_(pa.binary())),
    }, _NODES)


def _sharded(rows: DataFrame, bounds: list[Place], stratum: int) -> DataFrame:
    """The nodes that the shards of ``rows`` give, with ``below_leaves`` and ``below_saved`` added along the paths."""
    sent = rows.sparkSession.sparkContext.broadcast(bounds)
    columns = ["conv", "stratum", "keys", "words", "more", "r1", "r2", "e1", "e2", "below_leaves", "below_saved"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = _places({c: batch.column(c) for c in ("conv", "stratum", "keys", "r1", "r2")})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([bisect_right(sent.value, p) for p in places], pa.int64())], names=[*columns, "shard"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*columns).schema)
    dealt = map_batches(rows.select(*columns), deal, f"{kinds}, shard long")
    if not bounds:
        dealt = dealt.withColumn("shard", F.lit(0).cast("long"))

    def finish(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return shard_nodes(key[0].as_py(), table, sent.value, stratum)

    return cut(dealt.repartition(max(1, min(2 * len(bounds), 4096)), "shard").groupBy("shard").applyInArrow(finish, NODES), "trie-nodes")


def _combined(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Skeleton nodes, and tops of deeper strata, from their partial aggregates: a row for each prefix of a bound, and
    for each beginning that outlasts a stratum."""
    sums = [F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved"))]
    same = [F.max(c).alias(c) for c in ("depth", "words", "parent", "next", "above")]
    parts = cut(nodes.where(F.col("kind") == SKELETON).groupBy("own").agg(*sums, *same), "trie-skeleton")
    kids = parts.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("own")).agg(F.count(F.lit(1)).alias("kids"))
    tops = nodes.where(F.col("kind") == TOP).groupBy("own").agg(*sums, F.max("stratum").alias("stratum"))
    tops = cut(tops.join(kids, "own", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))), "trie-tops")
    on = tops.select(F.col("own").alias("next"), F.col("n_children").alias("on"))
    whole = parts.join(kids, "own", "left").join(on, "next", "left")
    whole = whole.withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)) + F.coalesce("on", F.lit(0)))
    whole = cut(whole.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "cost": (F.col("n_convs") - 1) * F.col("words")}), "trie-whole")
    added = whole.select(F.explode("above").alias("own"), "leaf", "cost").groupBy("own").agg(F.sum("leaf").alias("more_leaves"), F.sum("cost").alias("more_saved"))

    def plus(df: DataFrame) -> DataFrame:
        df = df.join(added, "own", "left")
        return df.withColumns({c: F.col(c) + F.coalesce(m, F.lit(0)) for c, m in (("n_leaves", "more_leaves"), ("saved", "more_saved"))})

    return plus(whole), plus(tops)


def _below(rows: DataFrame, tops: DataFrame) -> DataFrame:
    """``rows`` with the leaves and savings of all deeper strata whose top has the row's conversation as least member."""
    totals = tops.groupBy("conv", "stratum").agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
    deeper = Window.partitionBy("conv").orderBy(F.desc("stratum")).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.drop("below_leaves", "below_saved").join(totals, ["conv", "stratum"], "left")
    return found.withColumns({"below_leaves": F.coalesce(F.sum("l").over(deeper), F.lit(0)), "below_saved": F.coalesce(F.sum("s").over(deeper), F.lit(0))}).drop("l", "s")


def _end_digests(nodes: DataFrame) -> DataFrame:
    """``(own, sha)`` of the conversations that end at each skeleton node. Shards follow the order of ids there, so a
    digest is made of a stream of sorted pieces, none of which grows with the node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for own, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if own != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = own, hashlib.sha256(piece)
                else:
                    state.update(b"," + piece)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["own", "sha"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["own", "sha"])

    pieces = nodes.where((F.col("kind") == SKELETON) & (F.octet_length("ends") > 0)).select("own", "shard", "ends")
    return map_batches(pieces.repartition("own").sortWithinPartitions("own", "shard"), run, "own binary, sha string")


def trie(rows: DataFrame, stratum: int = STRATUM, shard_rows: int = SHARD_ROWS, max_shards: int = MAX_SHARDS) -> DataFrame:
    """The nodes of the trie of ``paths``, the root included, a row each: see ``shared``."""
    share_code(rows.sparkSession)
    rows = cut(rows.withColumns({"below_leaves": F.lit(0).cast("long"), "below_saved": F.lit(0).cast("long")}), "trie-paths")
    bounds = splitters(rows, shard_rows, max_shards)
    if rows.where("more").limit(1).count():
        deep = _sharded(rows.where(F.col("stratum") > 0), bounds, stratum)
        rows = cut(_below(rows, _combined(deep)[1]), "trie-paths")
    nodes = _sharded(rows, bounds, stratum)
    whole, tops = _combined(nodes)
    whole = cut(whole.join(_end_digests(nodes), "own", "left").withColumn("sha", F.coalesce("sha", F.lit(NO_ENDS))), "trie-skeleton-nodes")
    columns = ["conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "sha"]
    local = nodes.where(F.col("kind") == LOCAL)
    # nodes that the next stratum continues: their children are counted there
    ends = local.where(F.col("next").isNotNull())
    on = tops.select(F.col("own").alias("next"), F.col("n_children").alias("on"))
    ends = ends.join(on, "next", "left").withColumn("n_children", F.col("n_children") + F.coalesce("on", F.lit(0)))
    local = local.where(F.col("next").isNull()).select(*columns, "parent").unionByName(ends.select(*columns, "parent"))
    anchors = whole.select("own", "conv").unionByName(whole.where(F.col("next").isNotNull()).select(F.col("next").alias("own"), "conv"))
    anchors = anchors.unionByName(nodes.where((F.col("kind") == LOCAL) & F.col("next").isNotNull()).select(F.col("next").alias("own"), "conv"))
    anchors = anchors.select(F.col("own").alias("parent"), F.col("conv").alias("of"))
    root = whole.where(F.col("parent").isNull()).select(*(F.lit(None).cast("long").alias(c) if c == "parent_conv" else c for c in columns))
    hung = local.where(F.col("parent").isNotNull()).unionByName(
        whole.where(F.col("parent").isNotNull()).withColumn("parent_conv", F.lit(None).cast("long")).select(*columns, "parent"))
    hung = hung.join(anchors, "parent", "left").withColumn("parent_conv", F.col("of")).select(*columns)
    return local.where(F.col("parent").isNull()).select(*columns).unionByName(hung).unionByName(root)


def shared(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", **limits) -> DataFrame:
    """The prefix trie of the rebuilt conversations (see ``rebuilt``), a row for each node, that is, each distinct
    sequence of the first ``depth`` turns, the empty one of the root included.

    ``conv_id`` is the smallest member, ``parent_conv_id`` the parent's, ``n_convs`` the number of members, ``n_children``
    and ``n_leaves`` those of children and of childless nodes in the subtree, ``saved_tokens`` the words that need no
    second reading in the subtree, and ``ends_sha256`` the digest of the ids that end at the node. The digest of a node
    is one stream by definition: a task makes it piece by piece.

    A null role or text is empty, and a null turn number comes first. Turns of one number, repeated rows among
    them, all stay, in the order of the MD5 of role and text. Rows without conversation take no part; without any
    conversation there is no node. Other columns are ignored.
    """
    rows = paths(*rebuilt(numbered(turns, conv_col, turn_col, role_col, text_col)), stratum=limits.get("stratum", STRATUM))
    return trie(rows, **limits).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"))


ORACLE = r"""
WITH RECURSIVE step(i, k, v) AS (
    SELECT i, 0, i FROM range(256) t(i) UNION ALL
    SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM step WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM step WHERE k = 8),
ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT conv_id, list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(CAST(conv_id AS VARCHAR)) + 1),
            lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT))),
            lambda a, b: xor(t[xor(a, b) % 256 + 1], a // 256)) AS c FROM ids, tab),
h AS (SELECT conv_id, xor(c, 4294967295) % 4 AS h, conv_id - conv_id % 20 AS base FROM crc),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, md5(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
      FROM conversations WHERE conv_id IS NOT NULL),
r AS (SELECT h.conv_id, 0 AS part, t.pos, t.role, t.text FROM h JOIN t ON t.conv_id = h.base AND t.pos <= h.h
      UNION ALL SELECT h.conv_id, 1, t.pos, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id AND t.pos > h.h),
p AS (SELECT ids.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY part, pos) FILTER (WHERE pos IS NOT NULL), []) AS path
      FROM ids LEFT JOIN r USING (conv_id) GROUP BY ids.conv_id),
m AS (SELECT conv_id, len(path) AS total, unnest(range(0, len(path) + 1)) AS depth, path FROM p),
n AS (SELECT depth, list_slice(path, 1, depth) AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
             coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE total = depth), '') AS ends
      FROM m GROUP BY ALL),
x AS (SELECT n.*, q.conv_id AS parent_conv_id, CASE WHEN n.depth = 0 THEN 0 ELSE
             len(list_filter(regexp_split_to_array(n.prefix[n.depth].text, '[ 	-
]+'), lambda w: w <> '')) END AS words,
             (SELECT count(*) FROM n c WHERE c.depth = n.depth + 1 AND list_slice(c.prefix, 1, n.depth) = n.prefix) AS n_children
      FROM n LEFT JOIN n q ON q.depth = n.depth - 1 AND q.prefix = list_slice(n.prefix, 1, n.depth - 1)),
u AS (SELECT unnest(range(0, depth + 1)) AS up, * FROM x),
s AS (SELECT up AS depth, list_slice(prefix, 1, up) AS prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
             CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens FROM u GROUP BY ALL)
SELECT x.conv_id, x.depth, x.parent_conv_id, x.n_convs, x.n_children, s.n_leaves, s.saved_tokens, sha256(x.ends) AS ends_sha256
FROM x JOIN s ON s.depth = x.depth AND s.prefix = x.prefix
"""
