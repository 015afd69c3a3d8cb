"""Removal of repeated 50-byte strings by prefix-free phrases.

Parse. A rolling hash of ``GRAM`` bytes picks triggers: of the grams inside a
string of ``LENGTH`` bytes, the one with the smallest hash (the leftmost of
equals). The strings of a text that share a trigger make up a *phrase*: the
bytes from the first such string's start to the last one's end. A phrase is
fixed by its own bytes, so equal strings of different texts have the same
trigger at the same place in their phrases, and comparing phrases with the
same trigger misses nothing.

Dictionary. Phrases are known by (trigger hash, phrase hash). A trigger seen in
one document only needs no further look: a first pass finds the triggers of
several documents, a second one leaves out the rest (by a filter of fixed size
before the shuffle, exactly by a join after it). Where all occurrences of a trigger are
one phrase, the first document keeps it and later ones lose it whole: highly
repetitive text ends here, without its bytes having moved. Only the distinct
phrases of triggers with several phrases are fetched, each once, from its first
document.

Suffix order. The ``LENGTH``-byte prefixes of the dictionary's suffixes are
sorted with their first documents, trigger by trigger; a run of equal prefixes
belongs to its smallest document, and a phrase's suffixes whose run began
earlier are removed. Together with the parse this is the order of all corpus
suffixes as far as ``LENGTH`` bytes tell them apart. Triggers with very many
distinct phrases go through a Spark aggregation by string instead, so that no
trigger's phrases must fit into one task.

Strings are compared by a 64-bit hash under an independent 64-bit hash of the
trigger inside them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import materialise, release_shuffles, slices, text_bytes
from .shingles import mix, mix_byte, powers

LENGTH, GRAM = 50, 20
#: A trigger with more distinct phrases than this is split by string.
MANY_PHRASES = 20_000
_CHUNK = 4 << 20
#: The filter of shared triggers: 2**FILTER_LOG blocks of FILTER_BLOCK bytes.
FILTER_LOG, FILTER_BLOCK = 9, 1 << 16
_HIGH = np.uint64(0xFFFFFFFF00000000)


def _sums(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the polynomial over the buffer, and inverse powers."""
    up, down = powers(len(buf) + 1)
    acc = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(mix_byte(buf) * up[:len(buf)], out=acc[1:])
    return acc, down


def _hash(acc: np.ndarray, down: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the bytes [a, b)."""
    return mix((acc[b] - acc[a]) * down[a] + (b - a).astype(np.uint64))


def _hash_all(acc: np.ndarray, down: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every position on."""
    n = len(acc) - size
    return mix((acc[size:] - acc[:n]) * down[:n] + np.uint64(size)) if n > 0 else np.empty(0, np.uint64)


def parse(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Phrases of each text: (text number, trigger hash, phrase hash, first
    string's start, number of strings), in order."""
    none = np.empty(0, np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    buf = np.frombuffer(b"".join(texts), np.uint8)
    if len(buf) < length:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    with np.errstate(over="ignore"):
        acc, down = _sums(buf)
        h = _hash_all(acc, down, gram)
        low = (h & _HIGH) | np.arange(len(h), dtype=np.uint64)
        span, have = length - gram + 1, 1
        while have * 2 <= span:  # sliding minimum over ``span`` grams by doubling
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        if have < span:
            low = np.minimum(low[:-(span - have)], low[span - have:])
        start = np.concatenate([[0], np.cumsum(sizes)])
        count = np.maximum(sizes - length + 1, 0)  # strings of each text
        doc = np.repeat(np.arange(len(texts)), count)
        if not len(doc):
            return none, none.astype(np.uint64), none.astype(np.uint64), none, none
        p = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + start[doc]
        at = (low[p] & ~_HIGH).astype(np.int64)
        new = np.ones(len(p), bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(p)))
        lo, at, doc = p[first], at[first], doc[first]
        phrase = mix(_hash(acc, down, lo, lo + n - 1 + length) + (at - lo).astype(np.uint64))
        return doc, h[at], phrase, lo - start[doc], n


def string_hashes(phrases: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``length``-byte strings of each phrase, and each phrase's number of them."""
    count = np.fromiter((max(0, len(x) - length + 1) for x in phrases), np.int64, len(phrases))
    buf = np.frombuffer(b"".join(phrases), np.uint8)
    start = np.concatenate([[0], np.cumsum([len(x) for x in phrases])])[:-1].astype(np.int64)
    with np.errstate(over="ignore"):
        acc, down = _sums(buf)
        h = _hash_all(acc, down, length)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)
    return h[at], count


def _ids(docs: DataFrame) -> DataFrame:
    """(doc, part, text): null ids come after all others; ``part`` tells rows of
    one id apart by their text where ids repeat."""
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    d = docs.select(ident.alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    repeated = not d.select("doc").groupBy("doc").count().where("count > 1").isEmpty()
    part = F.xxhash64("text") if repeated else F.lit(0).cast("long")
    return d.select("doc", part.alias("part"), "text")


def _phrases(d: DataFrame, length: int, gram: int, known=None) -> DataFrame:
    """(doc, trigger) of every phrase; with ``known``, the broadcast filter of
    the shared triggers, (doc, trigger, phrase, part, lo, n) of those it lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 2):
                doc, trigger, phrase, lo, n = parse(list(text_bytes(piece.column(2))), length, gram)
                if known is not None:
                    some = maybe_shared(trigger, known.value)
                    doc, trigger, phrase, lo, n = doc[some], trigger[some], phrase[some], lo[some], n[some]
                take = pa.array(doc)
                cols = {"doc": piece.column(0).take(take), "trigger": pa.array(trigger.view(np.int64))}
                if known is not None:
                    cols |= {"phrase": pa.array(phrase.view(np.int64)), "part": piece.column(1).take(take),
                             "lo": pa.array(lo, pa.int64()), "n": pa.array(n, pa.int64())}
                yield pa.RecordBatch.from_pydict(cols)

    return d.mapInArrow(run, "doc long, trigger long" + (", phrase long, part long, lo long, n long" if known is not None else ""))


def _bits(trigger: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block of a trigger in the filter and its two bits there."""
    mask = np.uint64(8 * FILTER_BLOCK - 1)
    return ((trigger >> np.uint64(64 - FILTER_LOG)).astype(np.int64), ((trigger >> np.uint64(20)) & mask).astype(np.int64),
            ((mix(trigger) >> np.uint64(9)) & mask).astype(np.int64))


def maybe_shared(trigger: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which triggers the filter lets through: all shared ones and few others."""
    block, x, y = _bits(trigger)
    base = block * FILTER_BLOCK
    hit = (table[base + (x >> 3)] >> (x & 7).astype(np.uint8)) & (table[base + (y >> 3)] >> (y & 7).astype(np.uint8))
    return np.flatnonzero(hit & 1)


def shared_filter(shared: DataFrame) -> np.ndarray:
    """A blocked Bloom filter of the shared triggers. Its size is fixed
    (``2**FILTER_LOG`` blocks of ``FILTER_BLOCK`` bytes); with more triggers it
    lets more through, and the join after it stays exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            block, x, y = _bits(batch.column(0).to_numpy().view(np.uint64))
            order = np.argsort(block, kind="stable")
            which, start = np.unique(block[order], return_index=True)
            for k, part in zip(which.tolist(), np.split(order, start[1:]), strict=True):
                bits = own.setdefault(k, np.zeros(FILTER_BLOCK, np.uint8))
                for z in (x[part], y[part]):
                    np.bitwise_or.at(bits, z >> 3, np.uint8(1) << (z & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64()),
                                          pa.array([v.tobytes() for v in own.values()], pa.binary())], ["block", "bits"])

    block = F.shiftrightunsigned("trigger", 64 - FILTER_LOG)
    rows = shared.select("trigger").repartition(block).mapInArrow(run, "block long, bits binary").collect()
    table = np.zeros((1 << FILTER_LOG, FILTER_BLOCK), np.uint8)
    for r in rows:
        table[r.block] |= np.frombuffer(bytes(r.bits), np.uint8)
    return table.reshape(-1)


def _fetch(d: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted phrases: (trigger, doc, part, lo, many, bytes)."""
    lists = wanted.groupBy("doc", "part").agg(F.collect_list(F.struct("trigger", "lo", "n", "many")).alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 2):
                rows = []
                for doc, part, text, w in zip(*(piece.column(i) for i in (0, 1)), text_bytes(piece.column(2)),
                                              piece.column(3), strict=True):
                    doc, part = doc.as_py(), part.as_py()
                    rows += [(x["trigger"], doc, part, x["lo"], x["many"], text[x["lo"]:x["lo"] + x["n"] - 1 + length])
                             for x in w.as_py()]
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                 ["trigger", "doc", "part", "lo", "many", "bytes"])

    return d.join(lists, ["doc", "part"]).select("doc", "part", "text", "w") \
        .mapInArrow(run, "trigger long, doc long, part long, lo long, many boolean, bytes binary")


def _later(trigger: np.ndarray, doc: np.ndarray, phrases: list[bytes], length: int):
    """Sort the strings of a chunk of whole triggers; (phrase number, string
    number, strings) of the runs that began in a smaller document."""
    h, count = string_hashes(phrases, length)
    owner = np.repeat(np.arange(len(phrases)), count)
    order = np.lexsort((doc[owner], h, trigger[owner]))
    t, s, o = trigger[owner][order], h[order], doc[owner][order]
    new = np.ones(len(order), bool)
    new[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
    first = o[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    gone = np.zeros(len(order), bool)
    gone[order] = o > first
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    edge = np.flatnonzero(gone & ~np.concatenate([[False], gone[:-1] & (owner[1:] == owner[:-1])]))
    stop = np.flatnonzero(gone & ~np.concatenate([gone[1:] & (owner[1:] == owner[:-1]), [False]]))
    return owner[edge], number[edge], stop - edge + 1


def _sorted_triggers(found: DataFrame, length: int) -> DataFrame:
    """(doc, part, lo, n): strings of the dictionary's phrases that began in a
    smaller document, by sorting each trigger's strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(rows: pa.Table) -> pa.RecordBatch:
            trigger, doc, lo = (rows.column(c).to_numpy() for c in ("trigger", "doc", "lo"))
            who, number, n = _later(trigger, doc, [b.as_py() for b in rows.column("bytes")], length)
            return pa.RecordBatch.from_arrays([pa.array(doc[who]), pa.array(rows.column("part").to_numpy()[who]),
                                               pa.array(lo[who] + number), pa.array(n, pa.int64())], ["doc", "part", "lo", "n"])

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= _CHUNK:
                rows = pa.Table.from_batches(held).combine_chunks()
                trigger = rows.column("trigger").to_numpy()
                cut = int(np.searchsorted(trigger, trigger[-1]))  # the last trigger may go on
                if cut:
                    yield work(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
                size = sum(b.nbytes for b in held)
        if held and sum(b.num_rows for b in held):
            yield work(pa.Table.from_batches(held))

    return found.repartition("trigger").sortWithinPartitions("trigger") \
        .select("trigger", "doc", "part", "lo", "bytes").mapInArrow(run, "doc long, part long, lo long, n long")


def _split_triggers(found: DataFrame, length: int) -> DataFrame:
    """The same for triggers with many phrases, one row a string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, count = string_hashes([b.as_py() for b in batch.column(4)], length)
            own = np.repeat(np.arange(batch.num_rows), count)
            number = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
            take = pa.array(own)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(i).take(take) for i in (0, 1, 2)), pa.array(batch.column(3).to_numpy()[own] + number),
                pa.array(h.view(np.int64))], ["trigger", "doc", "part", "lo", "string"])

    rows = found.select("trigger", "doc", "part", "lo", "bytes") \
        .mapInArrow(run, "trigger long, doc long, part long, lo long, string long")
    first = cut_lineage(rows.groupBy("trigger", "string").agg(F.min("doc").alias("first")))
    return rows.join(first, ["trigger", "string"]).where("doc > first") \
        .select("doc", "part", "lo", F.lit(1).cast("long").alias("n"))


def repeated_strings(d: DataFrame, length: int = LENGTH, gram: int = GRAM, many: int = MANY_PHRASES) -> DataFrame:
    """(doc, part, lo, n): runs of ``n`` strings from byte ``lo`` on that also
    start in a smaller document (the same string may be in several runs)."""
    spark = d.sparkSession
    shared = materialise(_phrases(d, length, gram).groupBy("trigger").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
                         .where("first < last").select("trigger", "first"))
    release_shuffles(spark)
    known = spark.sparkContext.broadcast(shared_filter(shared))  # a fixed size, whatever the corpus
    seen = materialise(_phrases(d, length, gram, known).join(shared, "trigger"))
    release_shuffles(spark)
    kinds = materialise(seen.groupBy("trigger").agg((F.min("phrase") == F.max("phrase")).alias("one")))
    seen = seen.join(kinds, "trigger")
    whole = seen.where("one AND doc > first").select("doc", "part", "lo", "n")
    mixed = seen.where("NOT one").select("trigger", "phrase", "doc", "part", "lo", "n")
    origin = materialise(mixed.groupBy("trigger", "phrase").agg(F.min("doc").alias("origin")))
    placed = materialise(mixed.join(origin, ["trigger", "phrase"]))
    copied = placed.where("doc > origin").select("doc", "part", "lo", "n")
    crowded = origin.groupBy("trigger").count().where(F.col("count") > many).select("trigger", F.lit(True).alias("many"))
    wanted = placed.where("doc = origin").join(cut_lineage(crowded), "trigger", "left") \
        .select("trigger", "doc", "part", "lo", "n", F.coalesce("many", F.lit(False)).alias("many"))
    found = materialise(_fetch(d, wanted, length))
    release_shuffles(spark)
    parts = [whole, copied, _sorted_triggers(found.where("NOT many"), length)]
    if not found.where("many").isEmpty():
        parts.append(_split_triggers(found.where("many"), length))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def kept_bytes(text: bytes, lo: np.ndarray, n: np.ndarray, length: int = LENGTH) -> tuple[bytes, int, list[tuple[int, int]]]:
    """What is left of a text, the number of removed bytes, and the removed runs."""
    if not len(lo):
        return text, 0, []
    edge = np.zeros(len(text) + 1, np.int32)
    np.add.at(edge, lo, 1)
    np.add.at(edge, lo + n - 1 + length, -1)
    gone = np.cumsum(edge[:-1]) > 0
    turn = np.flatnonzero(np.diff(gone, prepend=False, append=False))
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), list(zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, many: int = MANY_PHRASES,
                   keep_bytes: bool = True) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans,
    kept_sha256`` and, with ``keep_bytes``, ``spans`` (removed byte runs
    ``[a, b)``) and ``kept`` (the remaining bytes, which may cut a character).

    Null texts are empty; texts under ``length`` bytes lose nothing. Rows that
    repeat an id are compared with smaller ids only, never with each other.
    Null ids come after all others. An empty table gives an empty result.
    """
    d = _ids(docs)
    gone = repeated_strings(d, length, gram, many)
    lists = gone.groupBy("doc", "part").agg(F.collect_list("lo").alias("lo"), F.collect_list("n").alias("n"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if keep_bytes:
        schema += ", spans array<struct<a:long,b:long>>, kept binary"
    span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 1):
                rows = []
                for text, lo, n in zip(text_bytes(piece.column(1)), piece.column(2), piece.column(3), strict=True):
                    at = np.asarray(lo.values, np.int64) if lo.is_valid else np.empty(0, np.int64)
                    many_ = np.asarray(n.values, np.int64) if n.is_valid else at
                    kept, removed, spans = kept_bytes(text, at, many_, length)
                    rows.append((len(text), removed, len(spans), hashlib.sha256(kept).hexdigest(),
                                 [{"a": a, "b": b} for a, b in spans], kept))
                cols = list(zip(*rows, strict=True))
                out = [piece.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                       pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if keep_bytes:
                    out += [pa.array(cols[4], span), pa.array(cols[5], pa.binary())]
                    names += ["spans", "kept"]
                yield pa.RecordBatch.from_arrays(out, names)

    ident = F.when(F.col("doc") != (1 << 63) - 1, F.col("doc"))
    return d.join(lists, ["doc", "part"], "left").select(ident.alias("doc_id"), "text", "lo", "n").mapInArrow(run, schema)
