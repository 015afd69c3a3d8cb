"""Minimum-cost-flow resharding (built-in functions; the flow itself is a
problem over shards, not documents).

From the bytes of the old shards and the capacities of the new ones a
min-cost flow decides how many bytes go from each old shard to each new one:
keeping a byte where it is costs nothing, moving it costs one. Old shards are
dealt into blocks of documents by a hash of the row; each block's place in its
old shard's byte order is the sum of the blocks before it, and the flow's
amounts cut that order into consecutive stretches, one for each receiving
shard. A document that lies inside a stretch goes to its shard; the few that a
cut runs through, at most one a cut, are placed last, the largest first, each
where most room is left. Only shard totals and these documents' sizes (both
bounded by the numbers of shards) reach the driver; blocks grow in number, not
in size, with the data.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import materialise

#: About so many documents a block.
BLOCK_ROWS = 20_000


def sized(docs: DataFrame, old_shard: Column, n_old: int) -> DataFrame:
    """(doc_id, size, text_crc32, old) of each row: UTF-8 bytes of the text plus
    8, crc32 of the text, old shard 0..n_old-1 (null: 0)."""
    old = F.coalesce(F.pmod(old_shard.cast("long"), F.lit(n_old)), F.lit(0)).cast("int")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), old.alias("old"))
    return d.select("doc_id", (F.octet_length("text") + 8).cast("long").alias("size"),
                    F.crc32(F.encode("text", "utf-8")).alias("text_crc32"), "old")


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> list[list[int]]:
    """Amounts ``flow[i][j]`` that ship all of ``supply`` within ``capacity`` at
    the least total cost, by successive cheapest augmenting paths."""
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("the new shards cannot hold the old ones")
    # nodes: source 0, old 1..n, new n+1..n+m, sink
    sink = n + m + 1
    edges: list[list[int]] = []  # to, capacity left, cost; the partner is at index ^ 1
    out: list[list[int]] = [[] for _ in range(sink + 1)]

    def link(a: int, b: int, cap: int, price: int) -> None:
        out[a].append(len(edges))
        edges.append([b, cap, price])
        out[b].append(len(edges))
        edges.append([a, 0, -price])

    for i, s in enumerate(supply):
        link(0, 1 + i, s, 0)
    first = len(edges)
    for i in range(n):
        for j in range(m):
            link(1 + i, n + 1 + j, min(supply[i], capacity[j]), cost(i, j))
    for j, c in enumerate(capacity):
        link(n + 1 + j, sink, c, 0)
    left = sum(supply)
    while left:
        dist, via, queued = [None] * (sink + 1), [-1] * (sink + 1), [False] * (sink + 1)
        dist[0], todo = 0, deque([0])
        while todo:  # label-correcting shortest path; prices may be negative on the way back
            a = todo.popleft()
            queued[a] = False
            for e in out[a]:
                b, cap, price = edges[e]
                if cap and (dist[b] is None or dist[a] + price < dist[b]):
                    dist[b], via[b] = dist[a] + price, e
                    if not queued[b]:
                        queued[b] = True
                        todo.append(b)
        path, b, push = [], sink, left
        while b:
            e = via[b]
            path.append(e)
            push = min(push, edges[e][1])
            b = edges[e ^ 1][0]
        for e in path:
            edges[e][1] -= push
            edges[e ^ 1][1] += push
        left -= push
    return [[edges[first + 2 * (i * m + j) + 1][1] for j in range(m)] for i in range(n)]


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def plan_transfers(old_bytes: list[int], capacities: list[int]) -> list[list[int]]:
    """Bytes from each old to each new shard that move the fewest bytes."""
    return min_cost_flow(old_bytes, capacities, lambda i, j: int(i != j))


def place_last(placed: DataFrame, capacities: list[int]) -> Column:
    """The shard of each row of ``placed`` (old, begin, size, stretch, is_cut): that of its stretch, and for rows that a cut runs
    through the shard with most room left, the largest of them first. The other rows lie within the capacities, so the shards
    end no further apart than the largest of these rows is. There are no more of them than cuts."""
    whole = placed.where(~F.col("is_cut")).groupBy("stretch").agg(F.sum("size").alias("size")).collect()
    free = list(capacities)
    for r in whole:
        free[r.stretch] -= r.size
    chosen = []
    for r in sorted(placed.where("is_cut").select("old", "begin", "size", "stretch").collect(), key=lambda r: (-r.size, r.old, r.begin)):
        to = max(range(len(free)), key=lambda j: (free[j], j == r.old, j == r.stretch, -j))
        free[to] -= r.size
        chosen.append((f"{r.old}:{r.begin}", to))
    if not chosen:
        return F.col("stretch")
    table = F.create_map(*[F.lit(x) for pair in chosen for x in pair])
    here = F.try_element_at(table, F.concat_ws(":", F.col("old").cast("string"), F.col("begin").cast("string")))
    return F.when(F.col("is_cut"), here).otherwise(F.col("stretch"))


def assign(rows: DataFrame, n_old: int, shards: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Place ``sized`` rows: adds ``shard`` and ``slot`` (gapless from 0 in each
    shard) and ``moved`` (it leaves the shard of the same number)."""
    totals = {r.old: r for r in rows.groupBy("old").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()}
    old_bytes = [totals[i].size if i in totals else 0 for i in range(n_old)]
    flow = plan_transfers(old_bytes, even_capacities(sum(old_bytes), shards))
    blocks = [max(1, -(-(totals[i].n if i in totals else 0) // block_rows)) for i in range(n_old)]
    # An old shard's byte order is cut at the running sums of its flow; what stays comes first.
    cuts, owners = [], []
    for i, amounts in enumerate(flow):
        order = sorted(range(shards), key=lambda j: (j != i, j))
        at, ends, who = 0, [], []
        for j in order:
            if amounts[j]:
                at += amounts[j]
                ends.append(at)
                who.append(j)
        cuts.append(ends or [0])
        owners.append(who or [0])
    n_blocks = F.element_at(F.array(*[F.lit(b) for b in blocks]), F.col("old") + 1)
    block = F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), n_blocks).cast("int")
    placed = rows.withColumn("block", block)
    # Bytes of the blocks before a block; the window runs over blocks, a few thousandths of a percent of the rows.
    sums = placed.groupBy("old", "block").agg(F.sum("size").alias("bytes"))
    before = F.sum("bytes").over(Window.partitionBy("old").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    base = cut_lineage(sums.select("old", "block", F.coalesce(before, F.lit(0)).alias("base")))
    inside = Window.partitionBy("old", "block").orderBy("doc_id", "text_crc32", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    ends = F.element_at(F.array(*[F.array(*[F.lit(int(x)).cast("long") for x in c]) for c in cuts]), F.col("old") + 1)
    who = F.element_at(F.array(*[F.array(*[F.lit(int(x)) for x in o]) for o in owners]), F.col("old") + 1)
    placed = placed.join(base, ["old", "block"]).withColumn("begin", begin)
    rank = F.least(F.size(F.filter(ends, lambda e: e <= F.col("begin"))) + 1, F.size(who))
    placed = placed.withColumn("rank", rank)
    placed = cut_lineage(placed.select(
        "doc_id", "size", "text_crc32", "old", "block", "begin", F.element_at(who, F.col("rank")).alias("stretch"),
        (F.col("begin") + F.col("size") > F.element_at(ends, F.col("rank"))).alias("is_cut")))
    last = place_last(placed, even_capacities(sum(old_bytes), shards))
    placed = cut_lineage(placed.withColumn("shard", last).withColumn("n_in", F.row_number().over(
        Window.partitionBy("old", "block", "shard").orderBy("doc_id", "text_crc32", "size")) - 1)
        .select("doc_id", "size", "text_crc32", "old", "block", "shard", "n_in"))
    # Slots: rows of the pieces (old shard, block) of a shard that come before.
    pieces = placed.groupBy("shard", "old", "block").agg(F.count(F.lit(1)).alias("n"))
    start = F.sum("n").over(Window.partitionBy("shard").orderBy("old", "block").rowsBetween(Window.unboundedPreceding, -1))
    pieces = cut_lineage(pieces.select("shard", "old", "block", F.coalesce(start, F.lit(0)).alias("start")))
    return placed.join(pieces, ["shard", "old", "block"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("n_in")).cast("long").alias("slot"),
        F.col("old").alias("old_shard"), (F.col("old") != F.col("shard")).alias("moved"))


def reshard(docs: DataFrame, old_shard: Column, n_old: int, shards: int = 24, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard, old_shard, moved``. Law ``bytes``: the fullest and the emptiest
    shard differ by no more than the largest document. Null texts have
    size 8; rows that are equal in id, size and crc are interchangeable; an empty
    table gives an empty result."""
    rows = cut_lineage(sized(docs, old_shard, n_old))
    return assign(rows, n_old, shards, block_rows).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}) \
        .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "old_shard", "moved")


def rewrite(docs: DataFrame, placed: DataFrame, path: str) -> DataFrame:
    """Write the affected shards (any that gives or receives a row) as Parquet
    folders ``shard=N`` in slot order; returns (shard, rows, bytes) of what was
    written. Documents meet their place by id and text crc; further columns
    travel along, whatever their names."""
    gives = placed.where("moved").select(F.explode(F.array("old_shard", "shard")).alias("shard")).distinct()
    todo = placed.join(gives, "shard", "left_semi").groupBy("doc_id", "text_crc32").agg(
        F.array_sort(F.collect_list(F.struct("shard", "slot", "size"))).alias("places"))  # one entry a repeated row
    names = docs.columns
    # Columns travel by position: c0, c1, ... clash with nothing.
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, text = (F.col(f"c{names.index(c)}") for c in ("doc_id", "text"))
    keyed = plain.withColumns({"__id": F.coalesce(doc_id.cast("long").cast("string"), F.lit("null")),
                               "__crc": F.crc32(F.encode(F.coalesce(text.cast("string"), F.lit("")), "utf-8"))})
    place = todo.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("__id"),
                        F.col("text_crc32").alias("__crc"), "places")
    nth = F.row_number().over(Window.partitionBy("__id", "__crc").orderBy(F.lit(0)))
    rows = keyed.join(place, ["__id", "__crc"]).withColumn("__place", F.element_at("places", nth))
    rows = rows.select(F.col("__place.shard").alias("shard"), F.col("__place.slot").alias("slot"),
                       F.col("__place.size").alias("size"), F.struct(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]).alias("row"))
    out = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    out.write.mode("overwrite").partitionBy("shard").parquet(path)
    back = docs.sparkSession.read.parquet(path)
    return materialise(back.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")))


def documents_by_shard(placed: DataFrame) -> DataFrame:
    """(shard, rows, bytes, moved bytes): the balance of a placement."""
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"),
                                       F.sum(F.when(F.col("moved"), F.col("size")).otherwise(0)).alias("moved_bytes"))
