"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window`` consecutive words of a benchmark item (an item of fewer
words, but not none, is one window). Its shingles (three words, or all of a
shorter window) are ordered by rarity in the documents. For exact containment
the necessary prefix of that order is one shingle: a document that holds the
window holds its rarest shingle. Documents are therefore only asked for prefix
shingles; a hit must leave room for the window on both sides (positional and
length bounds), and the aligned words are then compared exactly.

The benchmark is the stated query set. It is sent to the tasks in blocks whose
size is checked (``block_bytes`` of text each; one block in practice), so the
documents are never shuffled; with more blocks their spans are merged by row.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import id_and_text, map_in_place, slices, split_words, text_bytes

WINDOW, SHINGLE = 13, 3
BLOCK_BYTES = 24 << 20


@dataclass
class WindowIndex:
    """One block of benchmark windows."""

    windows: dict[bytes, tuple[str, ...]] = field(default_factory=dict)  # joined words -> item ids
    prefix: dict[bytes, tuple[tuple[int, int], ...]] = field(default_factory=dict)  # shingle -> (offset, words)
    first: frozenset[bytes] = frozenset()  # first words of the prefix shingles
    sizes: tuple[int, ...] = ()  # words in a shingle


def item_windows(words: list[bytes], window: int = WINDOW) -> list[list[bytes]]:
    if not words:
        return []
    n = min(window, len(words))
    return [words[i:i + n] for i in range(len(words) - n + 1)]


def window_shingles(words: list[bytes], shingle: int = SHINGLE) -> list[bytes]:
    n = min(shingle, len(words))
    return [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]


def build_index(items: list[tuple[str, str]], rarity: dict[bytes, int], window: int = WINDOW) -> WindowIndex:
    """Windows of a block and, for each, its rarest shingle (ties: the smaller one)."""
    ids: dict[bytes, set[str]] = {}
    prefix: dict[bytes, set[tuple[int, int]]] = {}
    for item_id, text in items:
        for w in item_windows(split_words(text.encode()), window):
            key = b" ".join(w)
            if key not in ids:
                s = window_shingles(w)
                k = min(range(len(s)), key=lambda i: (rarity.get(s[i], 0), s[i], i))
                prefix.setdefault(s[k], set()).add((k, len(w)))
            ids.setdefault(key, set()).add(item_id)
    return WindowIndex({k: tuple(v) for k, v in ids.items()}, {k: tuple(v) for k, v in prefix.items()},
                       frozenset(k.split(b" ", 1)[0] for k in prefix),
                       tuple(sorted({k.count(b" ") + 1 for k in prefix})))


def find_windows(words: list[bytes], index: WindowIndex) -> tuple[list[tuple[int, int]], set[str]]:
    """Word spans ``[start, end)`` of the windows that occur, and their items."""
    spans, items = [], set()
    first, prefix, windows, total = index.first, index.prefix, index.windows, len(words)
    for i in [i for i, w in enumerate(words) if w in first]:
        for n in index.sizes:
            for offset, size in prefix.get(b" ".join(words[i:i + n]), ()):
                a = i - offset
                if a >= 0 and a + size <= total:
                    got = windows.get(b" ".join(words[a:a + size]))
                    if got:
                        spans.append((a, a + size))
                        items.update(got)
    return spans, items


def covered(spans: list[tuple[int, int]]) -> int:
    """Number of words under a union of spans."""
    n, end = 0, 0
    for a, b in sorted(spans):
        if b > end:
            n += b - max(a, end)
            end = b
    return n


def _count_shingles(docs: DataFrame, wanted: dict[bytes, int]) -> dict[int, int]:
    """How often each wanted shingle occurs in all documents (index -> count)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((wanted, frozenset(k.split(b" ", 1)[0] for k in wanted),
                                           tuple(sorted({k.count(b" ") + 1 for k in wanted}))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, first, sizes = shared.value
        seen: Counter[int] = Counter()
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                words = split_words(text)
                at = [i for i, w in enumerate(words) if w in first]
                for n in sizes:
                    keys = map(index.get, [b" ".join(words[i:i + n]) for i in at])
                    seen.update(k for k in keys if k is not None)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.int64()),
                                          pa.array(list(seen.values()), pa.int64())], ["k", "n"])

    rows = (id_and_text(docs).select("text").mapInArrow(run, "k long, n long")
            .groupBy("k").agg(F.sum("n").alias("n")))
    return {r.k: r.n for r in rows.collect()}  # as many rows at most as the block has shingles


def _blocks(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    b = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("item_id IS NOT NULL AND text IS NOT NULL")
    total = b.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    return b, max(1, -(-total // block_bytes))


def index_block(docs: DataFrame, items: list[tuple[str, str]], window: int = WINDOW) -> WindowIndex:
    wanted: dict[bytes, int] = {}
    for _, text in items:
        for w in item_windows(split_words(text.encode()), window):
            for s in window_shingles(w):
                wanted.setdefault(s, len(wanted))
    counts = _count_shingles(docs, wanted) if wanted else {}
    return build_index(items, {s: counts.get(k, 0) for s, k in wanted.items()}, window)


def _indexes(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> list:
    """One broadcast index a block; each block's text is at most about
    ``block_bytes``, the largest item aside."""
    b, n = _blocks(benchmark, block_bytes)
    out = []
    for k in range(n):
        part = b if n == 1 else b.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k)
        items = [(r.item_id, r.text) for r in part.collect()]
        out.append(docs.sparkSession.sparkContext.broadcast(index_block(docs, items, window)))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, spans, items``. ``spans`` are the word spans of the windows
    found, ``items`` the sorted item ids. Null texts have no words. Benchmark
    rows without id or text are ignored; repeated ones count once. An empty
    benchmark leaves every document clean.
    """
    d = id_and_text(docs)
    indexes = _indexes(docs, benchmark, window, block_bytes)
    span = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def scan(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part in slices(batch, 1):
                    n, spans, items, key = [], [], [], []
                    for text in text_bytes(part.column(1)):
                        words = split_words(text)
                        s, i = find_windows(words, index)
                        n.append(len(words))
                        spans.append([{"a": a, "b": b} for a, b in sorted(set(s))])
                        items.append(sorted(i))
                        key.append(hashlib.blake2b(text, digest_size=16).digest())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(n, pa.int64()), pa.array(spans, span),
                         pa.array(items, pa.list_(pa.string())), pa.array(key, pa.binary())],
                        ["doc_id", "n_words", "spans", "items", "text_key"])
        return run

    schema = "doc_id long, n_words long, spans array<struct<a:int,b:int>>, items array<string>, text_key binary"
    parts = [d.mapInArrow(scan(shared), schema) for shared in indexes]
    found = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            found = found.unionByName(p)
        found = found.groupBy("doc_id", "text_key", "n_words").agg(
            F.flatten(F.collect_list("spans")).alias("spans"),  # one list a block, bounded by the text
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            (F.count(F.lit(1)) / len(parts)).cast("int").alias("copies")) \
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))) \
            .withColumn("spans", F.array_sort(F.array_distinct("spans")))
    # Sorted spans: each adds what lies beyond the furthest end so far.
    hit = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], acc["end"]))).alias("n"),
        F.greatest(acc["end"], s["b"]).alias("end")), lambda acc: acc["n"].cast("long"))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "spans", "items") \
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows that are not contaminated, with all their columns and without a
    shuffle when the benchmark is one block; further blocks are filtered jointly
    through the per-document spans."""
    indexes = _indexes(docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                       benchmark, window, block_bytes)
    cols = docs.columns
    at = cols.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [x.value for x in indexes]
        for batch in batches:
            for part in slices(batch, at):
                keep = []
                for text in text_bytes(part.column(at)):
                    words = split_words(text)
                    n = covered([s for index in found for s in find_windows(words, index)[0]])
                    keep.append(not (n > 0 and 20 * n >= len(words)))
                yield part.filter(pa.array(keep, pa.bool_()))

    return map_in_place(docs, run)


def contamination_table(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``contamination`` written to the shared folder, for callers that read it more than once."""
    return cut_lineage(contamination(docs, benchmark))
