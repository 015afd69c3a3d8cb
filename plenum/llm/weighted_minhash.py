"""Near-duplicate classes by improved consistent weighted sampling.

Weights. A document is its distinct shingles of five words, each weighted
``(1 + ln tf) * (1 + SPAN * idf)``: tf is the number of times it occurs in the
text, idf is ``ln(N / df) / ln N`` (0 for a shingle of every document, 1 for a
rare one). df is counted for each 64-bit shingle over all documents and
travels with the texts; nothing is broadcast. SPAN bounds how far idf may pull
the measure from plain resemblance.

Signature. Each of ``BANDS * ROWS`` samples draws (r, c, beta) per shingle and
keeps the shingle and level of the smallest ln a (Ioffe 2010); two documents
agree in a sample with a probability equal to their weighted Jaccard
similarity. Draws come from a table of 2**14 seeded triples picked by the
shingle's hash; equal values go to the smaller hash.

Candidates and classes. Texts with the same words are collapsed first. Members
of a bucket (equal band) are compared with its smallest member; the verified
links form components. Members outside a bucket's largest component are then
compared with a few members of it. Last come the pairs of a bucket whose
components still differ: the members outside the largest component with all
others, without those that cannot reach the threshold because too much of their
weight lies on shingles of one text alone. A bucket of copies costs a few
comparisons a member. Before two texts are fetched, their samples must agree in
no less than four standard deviations below the threshold; a pair whose
similarity is the threshold fails that about twice in 10,000, closer pairs
hardly ever. Every link has a verified weighted Jaccard similarity of at least
``THRESHOLD``; a class is a connected component of links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import discard, id_and_text, materialise, release_shuffles, slices, split_words, text_bytes
from .shingles import mix, shingle_sets

SIZE, THRESHOLD = 5, 0.8
BANDS, ROWS = 14, 5
#: After the stars, what is left is compared with so many members of its bucket's largest component.
PIVOTS = 16
#: Room for rounding in the bounds on a similarity.
SLACK = 1e-6
SPAN = 0.5
#: Text whose shingles are counted together before they meet the others'; text a part of the shingles stands for
#: (its shingles take about as much again, in texts of very short words a few times that); the fewest parts, in bits.
UNIT_BYTES, PART_BYTES, LEAST_PART_BITS = 1 << 22, 1 << 24, 9
_TRIPLE_BITS = 14
_TRIPLES = 1 << _TRIPLE_BITS


# ---------------------------------------------------------------- weights

def _units(every: DataFrame) -> DataFrame:
    """(doc_id, text, unit), written once: about UNIT_BYTES of text that one task
    read in a row share a unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, before = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = before + np.cumsum(sizes)
            units = base + (ends - sizes) // UNIT_BYTES
            before = int(ends[-1]) if len(ends) else before
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(units, pa.int64())],
                                             ["doc_id", "text", "unit"])

    return materialise(every.mapInArrow(run, "doc_id long, text string, unit long"))


def _blobs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """One binary value for each run of ``values`` between two cuts."""
    offsets = (cuts * values.itemsize * math.prod(values.shape[1:])).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(
        np.ascontiguousarray(values))]).cast(pa.binary())


def _split(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """High and low bytes of sorted hashes: apart, the high ones take little room when compressed."""
    b = np.ascontiguousarray(s).view(np.uint8).reshape(-1, 8)
    return b[:, 6:], b[:, :6]


def _joined(high: bytes, low: bytes) -> np.ndarray:
    out = np.empty((len(high) // 2, 8), np.uint8)
    out[:, 6:] = np.frombuffer(high, np.uint8).reshape(-1, 2)
    out[:, :6] = np.frombuffer(low, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).reshape(-1)


def _runs(*columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of rows with equal values."""
    if len(columns[0]):
        new = np.any([np.diff(c) != 0 for c in columns], axis=0)
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(columns[0])]
        yield from zip(edges, edges[1:])


def document_frequencies(units: DataFrame, size: int = SIZE) -> DataFrame:
    """(unit, high, low, df), the shingles in two parts: the number of documents of the corpus that hold each
    64-bit shingle, for those of a unit's shingles that occur in two documents
    or more. Each unit counts its distinct shingles and sends them, sorted, to
    parts by their first bits; a part adds the counts up and answers each unit.
    A shingle of very many documents is one entry a unit; the number of parts
    follows the corpus, their size does not."""
    total = units.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(LEAST_PART_BITS, (total // PART_BYTES).bit_length())

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = batch.column(1).to_numpy()
            for a, b in _runs(unit):
                s, _, _ = shingle_sets(list(text_bytes(batch.column(0).slice(a, b - a))), size)
                if not len(s):
                    continue
                s, n = np.unique(s, return_counts=True)
                part = (s >> np.uint64(64 - bits)).astype(np.int64)
                at = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(s)]])
                yield pa.RecordBatch.from_arrays([
                    pa.array(part[at[:-1]]), pa.array(np.full(len(at) - 1, unit[a])), *(_blobs(x, at) for x in _split(s)),
                    _blobs(n.astype(np.uint32), at)], ["part", "unit", "high", "low", "n"])

    def add_up(rows: list[tuple[int, bytes, bytes, bytes]]) -> pa.RecordBatch:
        unit, high, low, n = zip(*rows, strict=True)
        s = _joined(b"".join(high), b"".join(low))
        _, which = np.unique(s, return_inverse=True)
        df = np.bincount(which, np.frombuffer(b"".join(n), np.uint32))[which].astype(np.uint32)
        more = df > 1
        at = np.concatenate([[0], np.cumsum(more)])[np.cumsum([0] + [len(x) // 4 for x in n])]
        out = pa.RecordBatch.from_arrays([pa.array(unit, pa.int64()), *(_blobs(x, at) for x in _split(s[more])),
                                          _blobs(df[more], at)], ["unit", "high", "low", "df"])
        return out.filter(pa.array(np.diff(at) > 0))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now = [], None
        for batch in batches:
            for part, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != now and rows:
                    yield add_up(rows)
                    rows = []
                now = part
                rows.append(row)
        if rows:
            yield add_up(rows)

    asked = units.select("text", "unit").mapInArrow(ask, "part long, unit long, high binary, low binary, n binary")
    return asked.repartition("part").sortWithinPartitions("part") \
        .mapInArrow(answer, "unit long, high binary, low binary, df binary")


def idf_factors(df: np.ndarray, n_docs: int, span: float = SPAN) -> np.ndarray:
    """Weight factor of each document frequency: 1 + span * idf."""
    idf = np.log(max(n_docs, 2) / np.clip(df, 1, max(n_docs, 2)).astype(float)) / math.log(max(n_docs, 2))
    return (1.0 + span * idf).astype(np.float32)


def shingle_weights(tf: np.ndarray, df: np.ndarray, n_docs: int, span: float = SPAN) -> np.ndarray:
    return ((1.0 + np.log(tf.astype(np.float32))) * idf_factors(df, n_docs, span)).astype(np.float32)


def weighted_sets(texts: list[bytes], dfs: Iterable[bytes], n_docs: int, size: int = SIZE, span: float = SPAN):
    """Shingles, weights and starts of texts; ``dfs`` are their shingles' document
    frequencies (32 bits each, in the order of ``shingle_sets``)."""
    s, tf, start = shingle_sets(texts, size)
    return s, shingle_weights(tf, np.frombuffer(b"".join(dfs), np.uint32), n_docs, span), start


def weighted_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum of minima over sum of maxima; 0 when either side is empty."""
    if not len(a) or not len(b):
        return 0.0
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    low = float(np.minimum(wa[ia], wb[ib]).sum(dtype=np.float64))
    return low / (float(wa.sum(dtype=np.float64)) + float(wb.sum(dtype=np.float64)) - low)


# ---------------------------------------------------------------- signatures

@lru_cache(maxsize=2)
def draws(samples: int) -> list[tuple[np.ndarray, ...]]:
    """(r, ln c, beta, 1/r) triples of each sample, seeded by its number."""
    out = []
    for j in range(samples):
        g = np.random.Generator(np.random.PCG64(977 + j))
        r = g.gamma(2.0, 1.0, _TRIPLES).astype(np.float32) + np.float32(1e-6)
        out.append((r, np.log(g.gamma(2.0, 1.0, _TRIPLES) + 1e-12).astype(np.float32),
                    g.random(_TRIPLES).astype(np.float32), (1 / r).astype(np.float32)))
    return out


def signatures(s: np.ndarray, w: np.ndarray, start: np.ndarray, table: list) -> np.ndarray:
    """One row a document, one 64-bit value a sample; documents without a
    shingle must be left out by the caller."""
    lens = np.diff(start)
    out = np.empty((len(lens), len(table)), np.uint64)
    lw = np.log(w)
    at = start[:-1]
    doc_of = np.repeat(np.arange(len(lens)), lens)
    with np.errstate(over="ignore"):
        for j, (r, lc, beta, rinv) in enumerate(table):
            pick = ((s * np.uint64(2 * j + 1) + np.uint64(j) * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(64 - _TRIPLE_BITS)).astype(np.int64)
            rr, bb = r[pick], beta[pick]
            t = np.floor(lw * rinv[pick] + bb)
            a = lc[pick] - rr * (t - bb + np.float32(1))
            low = np.minimum.reduceat(a, at)
            hit = np.flatnonzero(a == low[doc_of])
            owner = doc_of[hit]
            hit = hit[np.concatenate([[True], owner[1:] != owner[:-1]])]  # first: the smallest hash
            out[:, j] = mix(s[hit] + t[hit].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    keys = np.empty((len(sig), bands), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            k = np.full(len(sig), b + 1, np.uint64)
            for r in range(rows):
                k = mix(k * np.uint64(0x9E3779B97F4A7C15) + sig[:, b * rows + r])
            keys[:, b] = k
    return keys.view(np.int64)


# ---------------------------------------------------------------- Spark

def _word_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, word_key): equal keys mean equal word sequences. Texts without
    words are keyed by the whole text; blank ones have no key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for t in text_bytes(batch.column(1)):
                words = split_words(t)
                keys.append(hashlib.blake2b(b" ".join(words) if words else b"\0" + t, digest_size=16).digest() if t else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], ["doc_id", "word_key"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, word_key binary")


def _signed(units: DataFrame, n_docs: int, bands: int, rows: int, size: int, span: float) -> DataFrame:
    """(doc_id, text, dfs, keys, sketch) of each document with a shingle, written
    once: the document frequencies of its shingles, its band keys and samples."""
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    counted = materialise(document_frequencies(units, size))
    release_shuffles(units.sparkSession)
    both = counted.select("unit", F.lit(0).alias("kind"), none("long", "doc_id"), none("string", "text"), "high", "low", "df") \
        .unionByName(units.select("unit", F.lit(1).alias("kind"), "doc_id", "text",
                                  *(none("binary", c) for c in ("high", "low", "df"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = draws(bands * rows)
        now, heard, known, known_df = None, [], np.empty(0, np.uint64), np.empty(0, np.uint32)
        for batch in batches:
            unit, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b in _runs(unit, kind):
                if unit[a] != now:
                    now, heard, known = unit[a], [], None
                if kind[a] == 0:
                    heard += zip(*(batch.column(c).slice(a, b - a).to_pylist() for c in (4, 5, 6)), strict=True)
                    continue
                if known is None:  # a unit's counts come before its texts
                    known = _joined(b"".join(x for x, _, _ in heard), b"".join(x for _, x, _ in heard))
                    order = np.argsort(known, kind="stable")
                    known = known[order]
                    known_df = np.frombuffer(b"".join(x for _, _, x in heard), np.uint32)[order]
                    heard = []
                for part in slices(batch.slice(a, b - a), 3):
                    s, tf, start = shingle_sets(list(text_bytes(part.column(3))), size)
                    some = np.flatnonzero(np.diff(start))
                    if not len(some):
                        continue
                    df = np.ones(len(s), np.uint32)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        df = np.where(known[at] == s, known_df[at], df)
                    # texts without a shingle have no extent, so the others' starts still fit together
                    start = np.append(start[some], start[-1])
                    sig = signatures(s, shingle_weights(tf, df, n_docs, span), start, table)
                    keys = band_keys(sig, bands, rows)
                    pick = pa.array(some)
                    yield pa.RecordBatch.from_arrays([
                        part.column(2).take(pick), part.column(3).take(pick), _blobs(df, start),
                        pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1)), bands).cast(pa.list_(pa.int64())),
                        pa.FixedSizeListArray.from_arrays(pa.array((sig & np.uint64(0x7FFF)).astype(np.int16).reshape(-1)),
                                                          bands * rows).cast(pa.list_(pa.int16()))],
                        ["doc_id", "text", "dfs", "keys", "sketch"])

    signed = materialise(both.repartition("unit").sortWithinPartitions("unit", "kind").mapInArrow(
        run, "doc_id long, text string, dfs binary, keys array<long>, sketch array<short>"))
    discard(counted)
    return signed


def _verify(pairs: DataFrame, texts: DataFrame, n_docs: int, threshold: float, size: int, span: float) -> DataFrame:
    """(a, b, similarity) of the candidate pairs that reach the threshold. Each
    text of a pair is fetched by an equi-join."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"), F.col("dfs").alias("dfs_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"), F.col("dfs").alias("dfs_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b", "dfs_a", "dfs_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                n = part.num_rows
                s, w, at = weighted_sets([*text_bytes(part.column(2)), *text_bytes(part.column(3))],
                                         [*part.column(4).to_pylist(), *part.column(5).to_pylist()], n_docs, size, span)
                sim = [weighted_jaccard(s[at[i]:at[i + 1]], w[at[i]:at[i + 1]], s[at[n + i]:at[n + i + 1]],
                                        w[at[n + i]:at[n + i + 1]]) for i in range(n)]
                out = pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sim, pa.float64())],
                                                 ["a", "b", "similarity"])
                yield out.filter(pa.array([x >= threshold for x in sim], pa.bool_()))

    return both.mapInArrow(run, "a long, b long, similarity double")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node reachable from each node of an edge
    list, by alternating large-star and small-star steps. Every round is a few
    aggregations and equi-joins, checkpointed; rounds end when nothing changes."""
    e = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct())
    before, rounds = None, 0
    while True:
        # large star: neighbours larger than u join u's smallest neighbour
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))  # AQE can split the join's hot side
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # small star: u and its smaller neighbours join the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v") \
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = cut_lineage(small)
        both = low = large = small = None
        release_shuffles(edges.sparkSession, passes=1)  # a round's shuffles are many small files
        rounds += 1
        if rounds >= 2:  # the first rounds always change something worth another one
            state = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
            if state == before:
                return cut_lineage(e.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label"))
            before = state


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    size: int = SIZE, span: float = SPAN) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, kept``. The class id
    is the smallest doc_id of the class, whose row is kept. Documents with the
    same words share a class; texts without words meet only equal texts; blank
    or null texts are alone. Repeated rows come out as often as they went in
    (one of them is kept). Rows with a null id are alone with a null class."""
    keys = cut_lineage(_word_keys(docs).groupBy("doc_id", "word_key").agg(F.count(F.lit(1)).alias("copies")))
    reps = cut_lineage(keys.where("word_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("word_key")
                       .agg(F.min("doc_id").alias("rep")))
    labels = rep_classes(docs, reps, threshold, bands, rows, size, span)
    classes = cut_lineage(reps.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
                          .select("word_key", F.coalesce("label", "rep").alias("class_id")))
    out = keys.join(classes, "word_key", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "copies", F.col("word_key").isNull().alias("alone"))
    out = cut_lineage(out)
    sizes = cut_lineage(out.where("NOT alone AND doc_id IS NOT NULL").groupBy("class_id")
                        .agg(F.sum("copies").alias("class_size")))
    out = out.join(sizes, "class_id", "left")
    # A class's smallest id may come with several texts; only its first row stays.
    n = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    own = F.col("alone") | F.col("doc_id").isNull()
    return out.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"),
                      F.when(own, F.lit(1).cast("long")).otherwise(F.col("class_size")).alias("class_size"),
                      own.alias("own"), n.alias("copy")) \
        .select("doc_id", "class_id", "class_size",
                (F.col("own") | ((F.col("doc_id") == F.col("class_id")) & (F.col("copy") == 1))).alias("kept"))


def _likely(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Candidate pairs whose samples agree often enough. Samples agree in about
    the similarity's share; more than four deviations below the threshold there
    is no link to find, and no text needs to be fetched."""
    x = sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sketch_a"))
    y = sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sketch_b"))
    return pairs.join(x, "a").join(y, "b").where(_agreement("sketch_a", "sketch_b") >= _least(threshold)
                                                 * F.size("sketch_a")).select("a", "b")


def _agreement(x: str, y: str):
    return F.aggregate(F.zip_with(x, y, lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, v: s + v)


def _least(threshold: float, samples: int = BANDS * ROWS) -> float:
    return max(0.0, threshold - 4.0 * math.sqrt(threshold * (1 - threshold) / samples))


def rep_classes(docs: DataFrame, reps: DataFrame, threshold: float, bands: int, rows: int, size: int,
                span: float) -> DataFrame:
    """(node, label) over the representative ids that have a verified link."""
    spark = docs.sparkSession
    units = _units(id_and_text(docs))
    n = units.count()
    signed = _signed(units, n, bands, rows, size, span)
    discard(units)
    release_shuffles(spark)
    # Signatures are cut down to the representatives afterwards: they are short, texts are not.
    banded = cut_lineage(signed.select("doc_id", "keys", "sketch")
                         .join(reps.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"))
    buckets = banded.select("doc_id", F.explode("keys").alias("key"))
    shared = cut_lineage(buckets.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last"))
                         .where("pivot < last").select("key", "pivot"))
    members = cut_lineage(buckets.join(shared, "key").select("key", "pivot", "doc_id"))
    wanted = cut_lineage(members.select("doc_id").distinct())
    # The texts of bucket members, fetched once for all comparisons (one row an id).
    texts = materialise(signed.select("doc_id", "text", "dfs").join(wanted, "doc_id", "left_semi").groupBy("doc_id")
                        .agg(F.max(F.struct("text", "dfs")).alias("t")).select("doc_id", "t.text", "t.dfs"))
    discard(signed)
    sketches = cut_lineage(banded.join(wanted, "doc_id", "left_semi").groupBy("doc_id")
                           .agg(F.max(F.struct("sketch", "keys")).alias("s")).select("doc_id", "s.sketch", "s.keys"))
    del banded, buckets, shared, wanted
    release_shuffles(spark)
    star = members.where("doc_id != pivot").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct()
    star = cut_lineage(_likely(star, sketches, threshold))
    links = cut_lineage(_verify(star, texts, n, threshold, size, span).select("a", "b"))
    labels = components(links)
    apart = _apart(members, labels)
    pairs = _likely(_to_pivots(apart).join(star, ["a", "b"], "left_anti"), sketches, threshold)
    links = cut_lineage(links.unionByName(_verify(pairs, texts, n, threshold, size, span).select("a", "b")))
    labels = components(links)
    release_shuffles(spark)
    # What is still apart in a bucket: pairs of different components, each in the first bucket it shares, where the
    # shingles that occur in more than one of these texts leave room for a link.
    apart = _apart(members, labels)
    left = cut_lineage(apart.select("doc_id").distinct())
    room = cut_lineage(_shared_mass(texts.join(left, "doc_id", "left_semi"), n, size, span)
                       .where(F.col("shared") >= (threshold - SLACK) * F.col("mass")))
    apart = _split_buckets(cut_lineage(apart.join(room, "doc_id").select("key", "doc_id", "label", "mass", "shared")))
    del left, room
    release_shuffles(spark)
    # Members of a bucket's largest component need no pair among each other: they are on one side of the join only.
    carried = ("doc_id", "label", "main", "mass", "shared", "sketch", "keys")
    apart = cut_lineage(_with_main(apart).join(sketches, "doc_id").select("key", *carried))
    x = apart.where("label != main").select("key", *[F.col(c).alias(f"{c}_x") for c in carried])
    y = apart.select("key", *[F.col(c).alias(f"{c}_y") for c in carried])
    other = (F.col("label_y") == F.col("main_y")) | (F.col("label_x") < F.col("label_y"))
    common = F.least("shared_x", "shared_y")
    roomy = common * (1 + threshold) >= (threshold - SLACK) * (F.col("mass_x") + F.col("mass_y"))
    same = F.zip_with("keys_x", "keys_y", lambda p, q: p == q)
    first = F.element_at("keys_x", F.array_position(same, True).cast("int")) == F.col("key")
    near = _agreement("sketch_x", "sketch_y") >= _least(threshold, bands * rows) * F.size("sketch_x")
    rest = x.join(y, "key").where(other & roomy & first & near) \
        .select(F.least("doc_id_x", "doc_id_y").alias("a"), F.greatest("doc_id_x", "doc_id_y").alias("b")).distinct()
    rest = cut_lineage(rest.join(star, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        labels = components(links.unionByName(_verify(rest, texts, n, threshold, size, span).select("a", "b")))
    discard(texts)
    return labels


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, doc_id, label) of the buckets whose members are not all in one component."""
    labelled = cut_lineage(members.join(labels, members.doc_id == labels.node, "left")
                           .select("key", "doc_id", F.coalesce("label", "doc_id").alias("label")))
    return _split_buckets(labelled)


def _split_buckets(labelled: DataFrame) -> DataFrame:
    """The rows of the buckets that hold more than one label."""
    split = labelled.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 != l1").select("key")
    return cut_lineage(labelled.join(split, "key").select(*labelled.columns))


def _shared_mass(texts: DataFrame, n_docs: int, size: int, span: float) -> DataFrame:
    """(doc_id, mass, shared): the weight of a text's shingles, and of those that
    another of the texts has too. Two texts have at most the smaller ``shared``
    in common, which bounds their similarity from above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                s, w, start = weighted_sets(list(text_bytes(part.column(1))), part.column(2).to_pylist(), n_docs, size, span)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                lens, w = np.diff(start), w.astype(np.float64)
                some = np.flatnonzero(lens)
                if not len(some):
                    continue
                whole = np.add.reduceat(w, start[some])  # a row for the whole text, under its own id
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([np.repeat(ids, lens), ids[some]])),
                    pa.array(np.concatenate([s.view(np.int64), ids[some]])), pa.array(np.concatenate([w, whole])),
                    pa.array(np.arange(len(s) + len(some)) >= len(s))], ["doc_id", "shingle", "weight", "whole"])

    rows = texts.select("doc_id", "text", "dfs").mapInArrow(run, "doc_id long, shingle long, weight double, whole boolean")
    own = rows.groupBy("whole", "shingle").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("other"),
                                               F.max("weight").alias("weight")).where("doc_id = other")
    sums = own.groupBy("doc_id").agg(F.sum(F.when(F.col("whole"), F.col("weight"))).alias("mass"),
                                     F.sum(F.when(~F.col("whole"), F.col("weight")).otherwise(0.0)).alias("alone"))
    return sums.select("doc_id", "mass", (F.col("mass") - F.col("alone")).alias("shared"))


def _with_main(apart: DataFrame) -> DataFrame:
    """The rows with the label of their bucket's largest component as ``main``."""
    sizes = apart.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "label")).alias("m")).select("key", F.col("m.label").alias("main"))
    return apart.join(main, "key")


def _to_pivots(apart: DataFrame) -> DataFrame:
    """Candidate pairs of each member outside its bucket's largest component with
    a few members of that component: PIVOTS at most a bucket, picked by hash."""
    placed = cut_lineage(_with_main(apart))
    pivots = cut_lineage(placed.where("label = main").groupBy("key", F.pmod(F.xxhash64("doc_id"), F.lit(PIVOTS)).alias("pick"))
                         .agg(F.min("doc_id").alias("p")).select("key", "p"))
    pairs = placed.where("label != main").select("key", "doc_id").join(pivots, "key")
    return pairs.select(F.least("p", "doc_id").alias("a"), F.greatest("p", "doc_id").alias("b")).distinct()


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents that stay, with all their columns: one row of each class.
    Rows whose id is null stay."""
    found = near_duplicates(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), **how)
    gone = found.where("NOT kept AND doc_id != class_id").select("doc_id").distinct()
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    key = F.col(f"c{docs.columns.index(id_col)}").cast("long")
    left = named.withColumn("k_id", key).join(gone.withColumnRenamed("doc_id", "k_id"), "k_id", "left_anti")
    return left.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
