"""Merkle manifest of a table of documents, by time-forward processing.

A row is a leaf: the SHA-256 of its values. Within a language leaves ascend by
id; every eight consecutive nodes have a parent until one node is left. The
languages' last nodes are joined to the root in the same way.

Nodes are labelled level by level, so a parent's label is larger than its
children's. A sweep in ascending labels takes a node's child digests from a
priority queue ordered by label, hashes them and sends the digest to the
parent's label. A second sweep in descending labels sends each node's proof
suffix (the siblings from its level up to the root) to its children. Blocks of
``BLOCK`` neighbouring leaves, whole subtrees, are swept in one task with a
queue of that size; what leaves a block (its top digest upwards, its suffix
downwards) is a message to another block, and Spark's external sort by (group,
block) is the queue that delivers it. A language of any size is spread over
blocks; rounds grow with the logarithm of its size to the base ``BLOCK``.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .ranks import ranked

ARITY = 8
#: Levels that one task climbs, and the leaves below so many levels.
STEP = 4
BLOCK = ARITY ** STEP

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(*values: Column) -> Column:
    """Hex SHA-256 of the values one after another: ``-`` for a null, else byte count, colon, value."""
    part = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-"))
            for v in values]
    return F.sha2(F.concat(*part).cast("binary"), 256)


def lower_case_text(values: dict[str, Column]) -> dict[str, Column]:
    return {**values, "text": F.translate(values["text"], UPPER, LOWER)}


def crc_divisible(doc_id: Column, by: int = 3) -> Column:
    """The unsigned crc32 of the decimal id divides by ``by``; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(by)) == 0, F.lit(False))


# ---------------------------------------------------------------- one block

def _height(n: int) -> int:
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def _levels(block: int, n: int) -> int:
    """Levels to climb in a block of n nodes. Only a group's first block can hold the whole group; a full one takes
    as many steps as one of many."""
    return STEP if block or n == BLOCK else _height(n)


def _first_labels(n: int, levels: int) -> list[int]:
    """First label of each level, and the label after the last."""
    first = [0]
    for _ in range(levels + 1):
        first.append(first[-1] + n)
        n = -(-n // ARITY)
    return first


def climb_block(digests: list[str], levels: int) -> list[list[str]]:
    """Digests of each level of a block, in ascending labels."""
    first = _first_labels(len(digests), levels)
    queue: list[tuple[int, int, str]] = []
    out: list[list[str]] = []
    for level in range(levels + 1):
        here = []
        for label in range(first[level], first[level + 1]):
            if level == 0:
                digest = digests[label]
            else:
                h = sha256()
                while queue and queue[0][0] == label:
                    h.update(heappop(queue)[2].encode())
                digest = h.hexdigest()
            here.append(digest)
            if level < levels:
                heappush(queue, (first[level + 1] + (label - first[level]) // ARITY, label, digest))
        out.append(here)
    return out


def descend_block(digests: list[str], levels: int, suffix: list[str]) -> list[list[str]]:
    """Proof suffixes of the nodes of a block, in their order. A suffix has two texts a level, from the node's own
    level upwards: the digests left and right of it in its run. ``suffix`` is that of the block's top node."""
    nodes = climb_block(digests, levels)
    first = _first_labels(len(digests), levels)
    queue: list[tuple[int, list[str]]] = [(-(first[levels + 1] - 1), suffix)]
    out: list[list[str]] = [[]] * len(digests)
    for level in range(levels, -1, -1):
        for label in range(first[level + 1] - 1, first[level] - 1, -1):
            own = heappop(queue)[1]  # messages come in the order of the sweep: the top one is this label's
            if level == 0:
                out[label] = own
                continue
            below = nodes[level - 1]
            begin = (label - first[level]) * ARITY
            run = below[begin:begin + ARITY]
            for i in range(len(run)):
                heappush(queue, (-(first[level - 1] + begin + i), ["".join(run[:i]), "".join(run[i + 1:]), *own]))
    return out


def fold(digest: str, suffix: list[str]) -> str:
    """The root that a digest and its proof suffix lead to."""
    for left, right in zip(suffix[::2], suffix[1::2], strict=True):
        digest = sha256((left + digest + right).encode()).hexdigest()
    return digest


def proof_digest(suffix: list[str]) -> str:
    return sha256("".join(suffix).encode()).hexdigest()


# ---------------------------------------------------------------- Spark

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[dict]]]:
    """(group, block, its rows) of sorted rows whose first columns are group and block."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and (row["grp"] != rows[0]["grp"] or row["block"] != rows[0]["block"]):
                yield rows[0]["grp"], rows[0]["block"], rows
                rows = []
            rows.append(row)
    if rows:
        yield rows[0]["grp"], rows[0]["block"], rows


def _block() -> Column:
    return F.floor(F.col("pos") / BLOCK).cast("long").alias("block")


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Tables (grp, pos, digest) from the given nodes up to one node a group, each STEP levels above the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grp, block, rows in _blocks(batches):
            top = climb_block([r["digest"] for r in rows], _levels(block, len(rows)))[-1]
            yield pa.RecordBatch.from_pylist([{"grp": grp, "pos": block, "digest": top[0]}])

    tables = [nodes]
    while (tables[-1].agg(F.max("pos")).first()[0] or 0) > 0 or len(tables) == 1:
        dealt = tables[-1].select("grp", _block(), "pos", "digest").repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
        tables.append(materialise(dealt.mapInArrow(run, "grp string, pos long, digest string")))
    return tables


def descend(tables: list[DataFrame], suffixes: DataFrame, carried: dict[str, str], finish, schema: str) -> DataFrame:
    """Bring the suffixes (grp, pos 0, suffix, and the ``carried`` columns of a group: name -> type) of the last
    table's nodes down to the first table. ``finish`` makes an output row from a row of the first table, its suffix
    and its group's carried values."""
    extra = list(carried)

    def message(df: DataFrame) -> DataFrame:
        return df.select("grp", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "suffix", *extra)

    def step(table: DataFrame, last: bool) -> DataFrame:
        payload = [c for c in table.columns if c not in ("grp", "pos")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for grp, block, rows in _blocks(batches):
                head, rows = rows[0], rows[1:]  # the message comes first: pos -1
                found = descend_block([r["digest"] for r in rows], _levels(block, len(rows)), head["suffix"])
                more = {c: head[c] for c in extra}
                if last:
                    out = [finish(r, s, more) for r, s in zip(rows, found, strict=True)]
                else:
                    out = [{"grp": grp, "pos": r["pos"], "suffix": s, **more} for r, s in zip(rows, found, strict=True)]
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

        kind = schema if last else "grp string, pos long, suffix array<string>" + "".join(f", {c} {t}" for c, t in carried.items())
        arrow = pa.schema([pa.field(f.split()[0], _ARROW[f.split()[1]]) for f in kind.split(", ")])
        none = {c: F.lit(None).cast(carried[c]).alias(c) for c in extra}
        leaves = table.select("grp", _block(), "pos", *payload, F.lit(None).cast("array<string>").alias("suffix"), *none.values())
        both = leaves.unionByName(message(suffixes), allowMissingColumns=True)
        return both.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos").mapInArrow(run, kind)

    for i in range(len(tables) - 2, 0, -1):
        suffixes = step(tables[i], False)
    return step(tables[0], True)


_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}


def manifest(docs: DataFrame, tampered=lower_case_text, tampers: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256`` of the table as it is, and
    ``folded_root, verified``: where ``tampers`` holds (a condition on doc_id), the proof is applied to the leaf of
    the values that ``tampered`` returns, else to the leaf itself.

    Any value may be null; a null id sorts first and is not tampered with. Rows of the same id in a language are
    ordered by their leaves; repeated rows are leaves of their own. An empty table gives no rows."""
    values = {c: F.col(c) for c in FIELDS}
    tampers = crc_divisible(F.col("doc_id")) if tampers is None else tampers
    other = leaf_digest(*tampered(values).values())
    grp = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("grp")  # null before any language
    leaves = materialise(docs.select(grp, F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(*values.values()).alias("digest"),
                                     F.when(tampers, other).alias("other")))
    base = ranked(leaves, "grp", ["doc_id", "digest", "other"], ["grp", "doc_id", "digest", "other"])
    low = climb(base)
    subroots = low[-1].select(F.lit("").alias("grp"), F.col("grp").alias("lang"), "digest")
    high = climb(ranked(subroots, "grp", ["lang"], ["grp", "lang", "digest"]))
    top = high[-1].first()
    root = top["digest"] if top else ""
    down = descend(high, high[-1].select("grp", "pos", F.array().cast("array<string>").alias("suffix")), {},
                   lambda r, s, _: {"grp": r["lang"], "pos": 0, "suffix": s, "subroot": r["digest"]},
                   "grp string, pos long, suffix array<string>, subroot string")

    def finish(row: dict, suffix: list[str], more: dict) -> dict:
        folded = fold(row["other"] or row["digest"], suffix)
        return {"doc_id": row["doc_id"], "leaf": row["digest"], "subroot": more["subroot"], "root": root,
                "proof_sha256": proof_digest(suffix), "folded_root": folded, "verified": folded == root}

    return descend(low, materialise(down), {"subroot": "string"}, finish,
                   "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
