"""Prefix trie of conversations, in ternary search trees over range shards.

Turns (role, text) are dictionary-encoded: each distinct one gets a 64-bit id,
so texts are read once and do not travel further than the dictionary.
Conversations with the same id sequence are collapsed first (their ids are
hashed in sorted blocks, so a sequence that a third of all conversations
follow is still many small pieces of work). The distinct sequences are dealt
out in ranges of the lexicographic order; each shard inserts its sequences'
distinguishing prefixes into a ternary search tree, the median first, so that
the tree is balanced, and an iterative traversal accumulates members, leaves
and savings. What follows a distinguishing prefix belongs to one sequence
alone and is written out as a chain.

Only prefixes of a shard's first or last sequence can also occur in another
shard. These boundary nodes leave a shard with what lies below them and is not
boundary itself; they are merged by a chained digest of the prefix, and the
sums over their subtrees come from pointer doubling, in as many rounds as the
logarithm of the largest depth.

One row holds the turn ids (not the texts) of one conversation.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import materialise
from .ranks import new_runs, partitions, ranked

#: conv_ids hashed together before they meet the others of their sequence; about so many turns make a shard
ID_BLOCK, SHARD_TURNS = 4096, 1 << 18
NO_IDS = sha256(b"").hexdigest()

ROW = ("edge boolean, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
       "n_children long, n_leaves long, saved_tokens long, last_len long, ends_sha256 string")
_NAMES = [f.split()[0] for f in ROW.split(", ")]
_ARROW = pa.schema([pa.field(f.split()[0], {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
                             [f.split()[1]]) for f in ROW.split(", ")])


# ---------------------------------------------------------------- one shard

class TernaryTree:
    """Ternary search tree over sequences of integers, in parallel lists. ``home[i]`` is the node of sequence i (-1: root)."""

    def __init__(self) -> None:
        self.char: list[int] = []
        self.low: list[int] = []
        self.equal: list[int] = []
        self.high: list[int] = []
        self.root = -1
        self.home: dict[int, int] = {}

    def _node(self, c: int) -> int:
        self.char.append(c)
        self.low.append(-1)
        self.equal.append(-1)
        self.high.append(-1)
        return len(self.char) - 1

    def insert(self, seq, name: int) -> None:
        links, at, above = None, 0, -1  # the list and place that hold the link to the next node
        for c in seq:
            node = self.root if links is None else links[at]
            while True:
                if node < 0:
                    node = self._node(c)
                    if links is None:
                        self.root = node
                    else:
                        links[at] = node
                    break
                if c == self.char[node]:
                    break
                links, at = (self.low if c < self.char[node] else self.high), node
                node = links[at]
            links, at, above = self.equal, node, node
        self.home[name] = above

    def insert_medians(self, seqs: list) -> None:
        """Insert sorted sequences, the median first, then those of both halves."""
        ranges = [(0, len(seqs))]
        while ranges:
            a, b = ranges.pop()
            if a < b:
                mid = (a + b) // 2
                self.insert(seqs[mid], mid)
                ranges += [(mid + 1, b), (a, mid)]

    def walk(self) -> Iterator[tuple[int, int, int]]:
        """(node, its parent in the trie or -1, depth), parents first."""
        stack = [(self.root, -1, 1)] if self.root >= 0 else []
        while stack:
            node, parent, depth = stack.pop()
            yield node, parent, depth
            for link, up, d in ((self.low[node], parent, depth), (self.high[node], parent, depth), (self.equal[node], node, depth + 1)):
                if link >= 0:
                    stack.append((link, up, d))


def _common(a, b) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def child_key(key: bytes, turn: int) -> bytes:
    return md5(key + int(turn).to_bytes(8, "little", signed=True)).digest()


ROOT_KEY = bytes(16)


def shard_nodes(seqs: list[np.ndarray], lens: list[np.ndarray], firsts: list[int], counts: list[int],
                ends: list[str]) -> Iterator[list[tuple]]:
    """Rows (as in ``ROW``) of a shard's nodes, in parts: its sorted distinct sequences, their turns' text lengths,
    smallest members, members and the digests of these."""
    n = len(seqs)
    shared = [0, *(_common(seqs[i], seqs[i + 1]) for i in range(n - 1)), 0]
    kept = [min(len(seqs[i]), max(shared[i], shared[i + 1]) + 1) for i in range(n)]
    tree = TernaryTree()
    tree.insert_medians([seqs[i][:kept[i]].tolist() for i in range(n)])
    order = list(tree.walk())
    size = len(tree.char)
    # The root is the last entry of every list (index -1).
    parent, depth = [-1] * (size + 1), [0] * (size + 1)
    members, first = [0] * (size + 1), [None] * (size + 1)
    children, leaves, saved = [0] * (size + 1), [0] * (size + 1), [0] * (size + 1)
    length, key, end = [0] * (size + 1), [None] * (size + 1), [None] * (size + 1)
    for node, up, d in order:
        parent[node], depth[node] = up, d
    tails: list[tuple[int, int]] = []
    for i in range(n):
        node = tree.home[i]
        members[node], first[node] = counts[i], firsts[i]
        if kept[i] < len(seqs[i]):
            tails.append((i, node))
        else:
            end[node] = ends[i]
        # the last turn's length of each node on the way that has none yet
        d = kept[i]
        while node >= 0 and not length[node]:
            length[node] = int(lens[i][d - 1])
            node, d = parent[node], d - 1
    key[-1] = ROOT_KEY
    for i in {0, n - 1}:  # boundary nodes are those with a key
        path, node = [], tree.home[i]
        while node >= 0:
            path.append(node)
            node = parent[node]
        for node in reversed(path):
            key[node] = key[node] or child_key(key[parent[node]], tree.char[node])
    chains = []
    for i, node in tails:
        d, m = kept[i], counts[i] - 1
        tail = lens[i][d:].astype(np.int64) * m
        below = np.cumsum(tail[::-1])[::-1]
        edge = i in (0, n - 1)
        if not edge:
            children[node] += 1
            leaves[node] += 1
            saved[node] += int(below[0])
        chains.append((i, node, below, edge))
    for node, up, _ in reversed(order):
        members[up] += members[node]
        first[up] = first[node] if first[up] is None else min(first[up], first[node])
        if key[node] is None:
            leaves[node] += children[node] == 0
            saved[node] += (members[node] - 1) * length[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    rows = []
    for node in [-1, *(node for node, _, _ in order)]:
        up, edge = parent[node], key[node] is not None
        top = node >= 0 and not edge and key[up] is not None
        rows.append((edge, key[node], key[up] if node >= 0 and (edge or top) else None, depth[node], first[node],
                     None if node < 0 or edge or top else first[up], members[node], children[node], leaves[node], saved[node],
                     length[node], end[node]))
        if len(rows) >= 4096:
            yield rows
            rows = []
    yield rows
    for i, node, below, edge in chains:
        yield from _chain(seqs[i], lens[i], kept[i], key[node], firsts[i], counts[i], ends[i], below, edge)


def _chain(seq, lens, start: int, key: bytes | None, first: int, count: int, end: str, below, edge: bool) -> Iterator[list[tuple]]:
    """Rows of the nodes below a distinguishing prefix."""
    rows = []
    for j in range(start, len(seq)):
        last = j == len(seq) - 1
        if edge:  # sums below a boundary node are added when these are merged
            up, key = key, child_key(key, seq[j])
            rows.append((True, key, up, j + 1, first, None, count, 0, 0, 0, int(lens[j]), end if last else None))
        else:
            top = j == start and key is not None
            rows.append((False, None, key if top else None, j + 1, first, None if top else first, count, int(not last), 1,
                         int(below[j - start]), int(lens[j]), end if last else None))
        if len(rows) >= 4096:
            yield rows
            rows = []
    if rows:
        yield rows


# ---------------------------------------------------------------- Spark

def encode_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, tid, len), written once: turns in their order, as ids of the dictionary of distinct turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    plain = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                                      role.alias("role"), text.alias("text"))
    key = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    slim = materialise(plain.select("conv_id", "turn", "role", F.substring("text", 1, 32).alias("head"), key.alias("key"),
                                    F.length("text").cast("long").alias("len")))
    placed = ranked(slim, "conv_id", ["turn", "role", "head", "key"], ["conv_id", "key", "len"])
    words = materialise(placed.select("key").distinct().withColumn("tid", F.monotonically_increasing_id()))
    return materialise(placed.join(words, "key").select("conv_id", "pos", "tid", "len"))


def rebuilt(encoded: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """(conv_id, seq_key, tids, lens), written once: every conversation c as the first h turns of conversation
    c - c % ``block`` and its own turns after its first h; h is the unsigned crc32 of the decimal c modulo ``most``."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    convs = encoded.select("conv_id").distinct()
    heads = encoded.where(F.col("pos") < most - 1).withColumnRenamed("conv_id", "base")
    borrowed = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % block).alias("base"), h.alias("h")) \
        .join(heads, "base").where("pos < h").select("conv_id", "pos", "tid", "len")
    own = encoded.where(F.col("pos") >= h).select("conv_id", (F.col("pos") + most).alias("pos"), "tid", "len")
    turns = borrowed.unionByName(own).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "tid", "len"))).alias("t"))
    none = F.array().cast("array<long>")
    seqs = convs.join(turns, "conv_id", "left").select("conv_id", F.coalesce("t.tid", none).alias("tids"), F.coalesce("t.len", none).alias("lens"))
    return materialise(seqs.select("conv_id", F.unhex(F.md5(F.array_join(F.col("tids").cast("array<string>"), ",").cast("binary"))).alias("seq_key"), "tids", "lens"))


def same_sequences(seqs: DataFrame) -> DataFrame:
    """(seq_key, conv_id, n, ends_sha256), one row a distinct sequence: its smallest member, members, and the digest
    of these. Ids are sorted in ranges and joined in blocks where they lie; only the blocks of sequences that begin
    or end a range meet in one task, which hashes them one after another."""
    placed = seqs.select("seq_key", "conv_id").repartitionByRange(partitions(seqs), "seq_key", "conv_id") \
        .sortWithinPartitions("seq_key", "conv_id")
    schema = pa.schema([("seq_key", pa.binary()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ids", pa.string()), ("ends_sha256", pa.string())])

    def digest(key, ids):
        return {"seq_key": key, "conv_id": ids[0], "n": len(ids), "ids": None, "ends_sha256": sha256(",".join(map(str, ids)).encode()).hexdigest()}

    def piece(key, ids):
        return {"seq_key": key, "conv_id": ids[0], "n": len(ids), "ids": ",".join(map(str, ids)), "ends_sha256": None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, begun, first = None, [], True, True  # begun: pieces of this sequence have left, or others have its start
        for batch in batches:
            if not batch.num_rows:
                continue
            new = new_runs(batch.column(0), key)
            starts = np.flatnonzero(new).tolist()
            ids = batch.column(1).to_pylist()
            out = []
            for a, b in zip([0, *starts] if not new[0] else starts, [*starts, len(ids)] if not new[0] else [*starts[1:], len(ids)], strict=True):
                if new[a]:
                    if held:
                        out.append((piece if begun else digest)(key, held))
                    begun = first
                    key, held, first = batch.column(0)[a].as_py(), [], False
                held += ids[a:b]
                while len(held) > ID_BLOCK:
                    out.append(piece(key, held[:ID_BLOCK]))
                    held, begun = held[ID_BLOCK:], True
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if held:
            yield pa.RecordBatch.from_pylist([piece(key, held)], schema=schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close():
            return {"seq_key": key, "conv_id": low, "n": n, "ends_sha256": h.hexdigest()}

        key, low, n, h, done = None, 0, 0, None, []
        for batch in batches:
            for k, c, m, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if k != key:
                    if key is not None:
                        done.append(close())
                    key, low, n, h = k, c, 0, sha256()
                else:
                    h.update(b",")
                h.update(ids.encode())
                n += m
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=whole)
                done = []
        if key is not None:
            yield pa.RecordBatch.from_pylist([close()], schema=whole)

    whole = pa.schema([f for f in schema if f.name != "ids"])
    kind = "seq_key binary, conv_id long, n long, ends_sha256 string"
    found = materialise(placed.mapInArrow(run, kind.replace("ends", "ids string, ends")))
    names = [f.split()[0] for f in kind.split(", ")]
    met = found.where("ids IS NOT NULL").select("seq_key", "conv_id", "n", "ids").repartition("seq_key") \
        .sortWithinPartitions("seq_key", "conv_id").mapInArrow(join, kind)
    return found.where("ids IS NULL").select(names).unionByName(met)


def _shards(distinct: DataFrame, turns: int) -> DataFrame:
    """Rows of ``ROW`` of every shard's nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tids, lens, rest = [], [], [[], [], []]
        for batch in batches:
            for into, c in ((tids, 0), (lens, 1)):
                column = batch.column(c)
                flat, at = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
                into += [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            for i, into in enumerate(rest):
                into += batch.column(i + 2).to_pylist()
        if tids:
            for rows in shard_nodes(tids, lens, *rest):
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], _NAMES)

    n = max(partitions(distinct), turns // SHARD_TURNS + 1)
    return distinct.select("tids", "lens", "conv_id", "n", "ends_sha256").repartitionByRange(n, "tids") \
        .sortWithinPartitions("tids").mapInArrow(run, ROW)


def _merge_boundary(edges: DataFrame) -> DataFrame:
    """Boundary nodes of all shards, one row a node, with the sums over their subtrees."""
    met = edges.groupBy("key").agg(F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
                                   *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
                                   F.max("last_len").alias("last_len"), F.max("ends_sha256").alias("ends_sha256"))
    met = cut_lineage(met)
    kids = met.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("kids"))
    met = cut_lineage(met.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))))
    # Each node's own part of the sums; then every round adds what lies twice as deep.
    state = met.select("key", F.col("parent_key").alias("up"), (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
                       (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("last_len")).alias("saved"))
    for _ in range(int(met.agg(F.max("depth")).first()[0] or 0).bit_length()):
        state = cut_lineage(state)
        below = state.where("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        above = state.select(F.col("key").alias("up"), F.col("up").alias("next"))
        state = state.join(above, "up", "left").join(below, "key", "left").select(
            "key", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"))
    return cut_lineage(met.join(state.select("key", "leaves", "saved"), "key"))


def prefix_nodes(turns: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Null roles and texts count as empty; a null turn comes first. Turns of the same number are ordered by role, the
    first 32 code points of the text and a digest of both; repeated rows are turns of their own. Rows without a
    conv_id belong to no conversation. An empty table has no nodes. Further columns are ignored."""
    encoded = encode_turns(turns)
    seqs = rebuilt(encoded, block, most)
    groups = same_sequences(seqs)
    distinct = materialise(groups.join(seqs.select("conv_id", "tids", "lens"), "conv_id"))
    total = distinct.agg(F.sum(F.size("tids"))).first()[0] or 0
    nodes = materialise(_shards(distinct, total))
    met = _merge_boundary(nodes.where("edge"))
    tops = met.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("top_conv_id"))
    inner = nodes.where("NOT edge").join(tops, "parent_key", "left") \
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "top_conv_id"))
    outer = met.join(tops, "parent_key", "left").withColumn("parent_conv_id", F.col("top_conv_id")) \
        .withColumn("n_leaves", F.col("leaves")).withColumn("saved_tokens", F.col("saved"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return inner.select(*names, "ends_sha256").unionByName(outer.select(*names, "ends_sha256")) \
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS)))
