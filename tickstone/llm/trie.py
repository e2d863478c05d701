"""Prefix trie of conversations: which openings they share, and what sharing saves.

Turns are dictionary-encoded, so a conversation is a list of whole numbers.  Equal
conversations become one sequence with a count.  The sequences are dealt to shards by
range, and each shard builds a ternary search tree of its own: the eq-link of a node
leads to the tree of the turns that follow it, and the sequences go in median first,
so that trees of siblings stay balanced.  One backward pass over the nodes, which were
made parents first, adds up members, leaves and savings without recursion.

Only prefixes of a shard's first or last sequence can also occur in another shard.
These boundary nodes are merged by a digest of the prefix; every other node is final
as its shard gives it.  A boundary node belongs to one of the paths (a shard's first or
last sequence) it lies on, and a running sum up each path, added over the paths, carries
leaves and savings to all its ancestors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from .common import BLANKS, counted_lookup, released, salted_lookup

#: Turns a shard's tree holds when there are enough shards, and at the most on average.
SHARD_TURNS, MOST_TURNS = 1 << 14, 1 << 20
#: Width (a power of two) of the ranges of ids whose text goes in one piece to the digest
#: of a node's ends.
ID_RANGE = 512
#: Rows a task hands over at once.
OUT_ROWS = 1 << 14
TURN = "array<struct<id: bigint, words: int>>"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

_NODES = (
    "conv_id bigint, depth int, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 binary, parent_conv_id bigint, parent_key binary, "
    "key binary, words int, path bigint"
)
_ARROW = pa.schema([
    (name, {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[kind])
    for name, kind in (f.split() for f in _NODES.split(", "))
])


# --- sequences ---------------------------------------------------------------


def encoded_turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turn, hash_1, id, words``: every turn with its number in the dictionary."""
    r, t = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    words = F.size(F.array_remove(F.split(t, f"{BLANKS}+"), ""))
    rows = materialise(turns.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.xxhash64(r, t).alias("hash_1"), F.xxhash64(F.lit(1), r, t).alias("hash_2"),
        words.alias("words"),
    ))
    # Written once, so that a number stays what it is when a task is repeated.
    numbers = materialise(rows.groupBy("hash_1", "hash_2").agg(F.count(F.lit(1)).alias("n")).select(
        "hash_1", "hash_2", "n", F.monotonically_increasing_id().alias("id")
    ))
    salt = F.xxhash64("conv_id", "turn", F.spark_partition_id())
    return counted_lookup(rows, numbers, ["hash_1", "hash_2"], "n", salt).select(
        "conv_id", "turn", "hash_1", "id", "words"
    )


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, seq``: the encoded turns of each conversation in order.

    Null turns come first; turns that tie stand in the order of their hashes.
    """
    step = F.struct(
        F.col("turn").isNotNull().alias("dated"), "turn", "hash_1", "id",
        F.col("words").cast("int").alias("words"),
    )
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(step)).alias("s"))
    return listed.select(
        "conv_id", F.transform("s", lambda x: F.struct(x["id"], x["words"])).cast(TURN).alias("seq")
    )


def rebuilt(seqs: DataFrame, block: int = 20, kinds: int = 4) -> DataFrame:
    """Conversations that take their opening from the first one of their block of ids.

    Conversation ``c`` begins with the first ``h`` turns of ``c - c % block`` (all if it
    has fewer, none if it is absent) and goes on with its own turns after its first
    ``h``, ``h`` being the unsigned crc32 of the decimal ``c``, modulo ``kinds``.
    """
    c = F.col("conv_id")
    base = (c - F.expr(f"conv_id % {block}")).alias("base")
    heads = seqs.filter(F.expr(f"conv_id % {block} = 0")).select(
        c.alias("base"), F.slice("seq", 1, kinds - 1).alias("head")
    )
    h = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(kinds)).cast("int")
    own = F.when(F.size("seq") > h, F.slice("seq", h + 1, F.greatest(F.size("seq") - h, F.lit(1))))
    joined = seqs.select("*", base).join(heads, "base", "left")
    none = F.array().cast(TURN)
    opening = F.coalesce(F.slice("head", F.lit(1), h), none)
    return joined.select("conv_id", F.concat(opening, F.coalesce(own, none)).alias("seq"))


# --- one shard ---------------------------------------------------------------


class _Shard:
    """The different sequences of one range, in order, and the trie made of them."""

    def __init__(self, number: int):
        self.number = number
        self.seqs: list[tuple[list[int], list[int]]] = []
        self.ends: list[list] = []  # members, smallest id, SHA-256 so far

    def add(self, ids: list[int], words: list[int], n: int, first: int, text: str) -> None:
        """A run of the conversations that share a sequence; runs come in order."""
        if self.seqs and self.seqs[-1][0] == ids:
            end = self.ends[-1]
            end[0], end[1] = end[0] + n, min(end[1], first)
            end[2].update(b",")
        else:
            self.seqs.append((ids, words))
            self.ends.append(end := [n, first, hashlib.sha256()])
        end[2].update(text.encode())

    def nodes(self) -> Iterator[dict[str, list]]:
        """All nodes, and once more those that lie on the first or the last sequence."""
        split, less, more, under = [0], [-1], [-1], [-1]  # the tree below node 0, the root
        up, depth, words = [-1], [0], [0]

        def child(v: int, t: int, w: int) -> int:
            """The node of turn ``t`` below ``v``, made if it is not there."""
            link, at = under, v
            x = under[v]
            while x >= 0:
                if t == split[x]:
                    return x
                link, at = (less, x) if t < split[x] else (more, x)
                x = link[x]
            link[at] = x = len(split)
            for column, value in (
                (split, t), (less, -1), (more, -1), (under, -1), (up, v),
                (depth, depth[v] + 1), (words, w),
            ):
                column.append(value)
            return x

        last = [0] * len(self.seqs)
        waiting = [(0, len(self.seqs))]
        while waiting:
            lo, hi = waiting.pop()
            if lo >= hi:
                continue
            mid, v = (lo + hi) // 2, 0
            for t, w in zip(*self.seqs[mid], strict=True):
                v = child(v, t, w)
            last[mid] = v
            waiting += [(lo, mid), (mid + 1, hi)]

        size = len(split)
        n, first, sha = [0] * size, [None] * size, [None] * size
        for v, (members, smallest, digest) in zip(last, self.ends, strict=True):
            n[v], first[v], sha[v] = members, smallest, digest.digest()
        paths = [self._path(last[0], up), self._path(last[-1], up)]
        border = bytearray(size)
        for v in paths[0] + paths[1]:
            border[v] = 1
        children, leaves, saved = [0] * size, [0] * size, [0] * size
        for v in range(size - 1, 0, -1):
            p = up[v]
            n[p] += n[v]
            first[p] = first[v] if first[p] is None else min(first[p], first[v])
            if not border[v]:
                leaves[v] = leaves[v] or 1
                saved[v] += (n[v] - 1) * words[v]
                children[p] += 1
                leaves[p] += leaves[v]
                saved[p] += saved[v]

        keys = {}
        for path, (ids, _) in zip(paths, (self.seqs[0], self.seqs[-1]), strict=True):
            running = hashlib.blake2b(digest_size=16)
            keys[0] = running.digest()
            for v, t in zip(path[1:], ids, strict=True):
                running.update(int(t).to_bytes(8, "little", signed=True))
                keys[v] = running.digest()

        def row(v: int, path: int | None, counted: bool = True) -> tuple:
            p = up[v]
            inner = p >= 0 and not border[p]
            totals = (n[v], children[v], leaves[v], saved[v]) if counted else (0, 0, 0, 0)
            return (
                first[v], depth[v], *totals, sha[v], first[p] if inner else None,
                None if inner or p < 0 else keys[p], keys.get(v), words[v], path,
            )

        yield from (row(v, None) for v in range(size) if not border[v])
        yield from (row(v, 2 * self.number) for v in paths[0])
        seen = set(paths[0])
        yield from (row(v, 2 * self.number + 1, v not in seen) for v in paths[1])

    @staticmethod
    def _path(v: int, up: list[int]) -> list[int]:
        out = []
        while v >= 0:
            out.append(v)
            v = up[v]
        return out[::-1]


def _shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of the shards in one partition, rows sorted by shard, sequence and ids."""

    def given(shard: _Shard):
        rows = []
        for row in shard.nodes():
            rows.append(row)
            if len(rows) == OUT_ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    shard = None
    for batch in batches:
        seq = batch.column("seq")
        bounds = np.asarray(seq.offsets).tolist()
        ids = seq.values.field("id").to_pylist()
        words = seq.values.field("words").to_pylist()
        rest = (batch.column(c).to_pylist() for c in ("shard", "n", "first_id", "ids"))
        for k, (number, n, first, text) in enumerate(zip(*rest, strict=True)):
            if shard is None or number != shard.number:
                if shard is not None:
                    yield from given(shard)
                shard = _Shard(number)
            lo, hi = bounds[k], bounds[k + 1]
            shard.add(ids[lo:hi], words[lo:hi], n, first, text)
    if shard is not None:
        yield from given(shard)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW
    )


# --- all shards --------------------------------------------------------------


def dealt(seqs: DataFrame, shards: int | None = None) -> DataFrame:
    """Sequences dealt to range shards: ``shard, seq, n, first_id, ids``, a row for each
    range of ids under a sequence, in order within a partition."""
    pieces = materialise(
        seqs.groupBy("seq", F.shiftright("conv_id", ID_RANGE.bit_length() - 1).alias("ids_at")).agg(
            F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first_id"),
            F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
        )
    )
    if shards is None:
        turns = pieces.agg(F.sum(F.size("seq").cast("bigint") + 1).alias("turns")).first()["turns"] or 0
        wide = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shards = max(-(-turns // MOST_TURNS), min(-(-turns // SHARD_TURNS), wide), 1)
    # By the sequence alone: all conversations that share one meet in its shard.
    return pieces.repartitionByRange(shards, "seq").sortWithinPartitions("seq", "ids_at").select(
        F.spark_partition_id().alias("shard"), "seq", "n", "first_id", "ids"
    )


def merged(nodes: DataFrame) -> DataFrame:
    """Nodes of all shards as one trie: the boundary nodes merged, the others as they are."""
    path = nodes.filter("path is not null")
    total = path.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("ends_sha256").alias("ends_sha256"), F.max("parent_key").alias("parent_key"),
        F.max("words").alias("words"), F.min("path").alias("owner"),
    )
    below = total.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(
        F.count(F.lit(1)).alias("more")
    )
    children = (F.col("n_children") + F.coalesce("more", F.lit(0))).alias("n_children")
    border = materialise(total.join(below, "key", "left").select(
        "key", "parent_key", "conv_id", "depth", "n_convs", children, "ends_sha256", "owner",
        # What a boundary node brings by itself; its boundary children bring theirs.
        (F.col("n_leaves") + F.when(children == 0, 1).otherwise(0)).alias("leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    ))
    up = Window.partitionBy("path").orderBy(F.col("depth").desc()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    owned = F.col("owner") == F.col("path")
    carried = path.select("path", "key").join(border, "key").select(
        "key",
        *(F.sum(F.when(owned, F.col(c)).otherwise(0)).over(up).alias(c) for c in ("leaves", "saved")),
    ).groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parents = border.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ]
    ends = border.drop("leaves", "saved").join(carried, "key").join(parents, "parent_key", "left")
    inner = nodes.filter("path is null")
    # Very many nodes may hang below one boundary node, such as the root.
    hanging = salted_lookup(
        inner.filter("parent_key is not null"), parents, ["parent_key"], F.xxhash64("conv_id", "depth")
    ).withColumn("parent_conv_id", F.col("parent"))
    whole = inner.filter("parent_key is null").select(columns).unionByName(
        hanging.select(columns)
    ).unionByName(ends.withColumn("parent_conv_id", F.col("parent")).select(columns))
    return whole.select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), *columns[2:7],
        F.coalesce(F.lower(F.hex("ends_sha256")), F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def prefix_trie(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", rebuild=rebuilt, shards: int | None = None,
) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    A node is a distinct sequence of first turns (role and text), the root has none; its
    members are the conversations that start with it, and ``conv_id`` is the smallest of
    them.  ``n_leaves`` counts the childless nodes of its subtree, itself included.
    ``saved_tokens`` adds up, over its subtree, the words of each node's last text times
    its members but one.  ``ends_sha256`` digests the ids, ascending and joined by commas,
    of the members that end there.  ``rebuild`` changes the sequences first; pass None to
    take conversations as they are.

    Ids are whole numbers; rows without one belong to no conversation.  A null role or
    text is an empty one, a null turn comes first, turns that tie stand in the order of
    a hash of role and text, and a row held twice is two turns.  A conversation left
    without turns is a member of the root alone.  No conversations give no nodes.  Other
    columns play no role.  One task holds a conversation's turns as numbers, 16 bytes each;
    texts are only hashed, and ids that share a sequence pass in pieces.
    """
    seqs = sequences(encoded_turns(turns, conv_id, turn, role, text))
    seqs = seqs if rebuild is None else rebuild(materialise(seqs))
    return merged(materialise(dealt(seqs, shards).mapInArrow(released(_shard_nodes), _NODES)))
