"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosines.

Vectors are scaled to length one, so a cosine c is a distance sqrt(2 - 2c).
A hash is ``floor((a.v + b) / WIDTH)`` with Gaussian ``a`` and uniform ``b``; a
table's key joins several hashes. The hashes a table and the number of tables
follow from the number of distinct vectors: pairs at the threshold meet in some
table with probability ``RECALL`` (closer ones more often), unrelated vectors
meet about one stranger in all tables together.

Identical vectors are one node. In each bucket the smallest node is the pivot;
exact cosines with it come first. A node whose pivots are all farther than the
threshold is on its own; one that never lies next to a smaller pivot is a
centre, and other nodes take the smallest centre next to them as home. Angles
obey the triangle inequality: two nodes of one home whose angles to the centre
add up to no more than the threshold's angle are linked for certain and are
counted by angle, not as pairs. The other pairs of a home, and the pairs of a
bucket whose homes differ, are candidates, and each gets its exact cosine. A
bucket of n close copies so costs about n comparisons; only what lies at the
rim of a home, or between homes, is compared pair by pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .common import discard, materialise
from .shingles import mix
from .weighted_minhash import components

THRESHOLD, RECALL, WIDTH = 0.95, 0.98, 2.0
#: Strangers that a vector meets in all tables together, in the mean.
STRANGERS = 1.0
#: The threshold's angle is divided into so many cells; angles are rounded up to whole cells.
CELLS = 2048
#: Cells are joined in so many bands.
BANDS = 32
_ROWS = 1024


# ---------------------------------------------------------------- hashing

def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that one hash puts two vectors at this distance into one cell."""
    x = width / distance
    return math.erf(x / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


def tables_for(n: int, threshold: float = THRESHOLD, recall: float = RECALL, strangers: float = STRANGERS) -> tuple[int, int]:
    """(tables, hashes a table) for n distinct vectors."""
    near, far = collision(math.sqrt(2 - 2 * threshold)), collision(math.sqrt(2))
    hashes = 1
    while True:
        tables = math.ceil(math.log(1 - recall) / math.log1p(-near ** hashes))
        if n * far ** hashes * tables <= strangers:
            return tables, hashes
        hashes += 1


@lru_cache(maxsize=2)
def _projections(dim: int, tables: int, hashes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    g = np.random.Generator(np.random.PCG64([41, dim, tables, hashes]))
    return (g.standard_normal((dim, tables * hashes)) / WIDTH, g.random(tables * hashes),
            g.integers(0, 1 << 63, tables * hashes, np.uint64) * np.uint64(2) + np.uint64(1))


def bucket_keys(unit: np.ndarray, tables: int, hashes: int) -> np.ndarray:
    """One key a table for each row of vectors of length one."""
    a, b, odd = _projections(unit.shape[1], tables, hashes)
    out = np.empty((len(unit), tables), np.uint64)
    for i in range(0, len(unit), _ROWS):
        q = np.floor(unit[i:i + _ROWS] @ a + b).astype(np.int64).view(np.uint64)
        with np.errstate(over="ignore"):
            out[i:i + _ROWS] = mix((q * odd).reshape(len(q), tables, hashes).sum(axis=2, dtype=np.uint64)
                                   + np.arange(tables, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(unit.shape[1]))
    return out.view(np.int64)


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows in double precision, each divided by a power of two near its largest component, which is exact."""
    rows = rows.astype(np.float64)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = scaled(a), scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _by_length(blobs: list[bytes], kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix) of the vectors of each length."""
    lens = np.array([len(x) for x in blobs])
    for n in np.unique(lens):
        at = np.flatnonzero(lens == n)
        yield at, np.frombuffer(b"".join(blobs[i] for i in at), kind).reshape(len(at), -1)


# ---------------------------------------------------------------- Spark

def _blobs(vectors: DataFrame) -> tuple[DataFrame, str]:
    """(vec_id, blob), written once, and the components' type: the components' bytes, null for vectors that link
    with nothing (null, empty or zero ones, and those with null or non-finite components)."""
    double = vectors.schema["embedding"].dataType.elementType.typeName() != "float"
    kind = "<f8" if double else "<f4"
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>" if double else "array<float>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            lens = column.value_lengths().fill_null(0).to_numpy()
            at = np.concatenate([[0], np.cumsum(lens)])
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.dtype(kind).type(0)  # a null is NaN, -0 is 0
            out = []
            for a, b in zip(at[:-1], at[1:], strict=True):
                v = flat[a:b]
                out.append(v.tobytes() if np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "blob"])

    return materialise(plain.mapInArrow(run, "vec_id long, blob binary")), kind


def _hashed(nodes: DataFrame, kind: str, tables: int, hashes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, rows in _by_length(batch.column(1).to_pylist(), kind):
                rows = scaled(rows)
                keys = bucket_keys(rows / np.sqrt((rows * rows).sum(axis=1))[:, None], tables, hashes)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[at], tables)), pa.array(keys.reshape(-1))], ["node", "key"])

    return materialise(nodes.select("node", "blob").mapInArrow(run, "node long, key long"))


def _verified(pairs: DataFrame, nodes: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(a, b, angle), written once: the pairs that reach the threshold, with the angle between them."""
    left = nodes.select(F.col("node").alias("a"), F.col("blob").alias("blob_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("blob").alias("blob_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "blob_a", "blob_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            same = [i for i in range(len(x)) if len(x[i]) == len(y[i])]
            cos = np.full(len(x), -2.0)
            for at, rows in _by_length([x[i] + y[i] for i in same], kind):
                half = rows.shape[1] // 2
                cos[np.array(same)[at]] = cosines(rows[:, :half], rows[:, half:])
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.arccos(np.clip(cos, -1, 1)))], ["a", "b", "angle"])
            yield out.filter(pa.array(cos >= threshold))

    return materialise(both.mapInArrow(run, "a long, b long, angle double"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``; links have a cosine of at least ``threshold``.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and vectors of
    different lengths do not link with each other. Equal vectors are linked, repeated rows included. A vector with a
    null id links with nothing and is kept in a component without an id. An empty table gives no rows; further
    columns are ignored."""
    rows, kind = _blobs(vectors)
    nodes = materialise(rows.where("blob IS NOT NULL AND vec_id IS NOT NULL").groupBy("blob")
                        .agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n")).withColumn("node", F.monotonically_increasing_id()))
    tables, hashes = tables_for(nodes.count(), threshold, recall)
    hashed = _hashed(nodes, kind, tables, hashes)
    shared = hashed.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot < last").select("key", "pivot")
    members = materialise(hashed.join(shared, "key").select("key", "pivot", "node"))
    discard(hashed)
    star = cut_lineage(members.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct())
    near = _verified(star, nodes, kind, threshold)
    homes = _homes(near, nodes, math.acos(threshold))
    more = _verified(_open_pairs(members, homes, star), nodes, kind, threshold)
    discard(members)
    links = cut_lineage(near.unionByName(more).select("a", "b"))
    # Links that angles vouch for are counted by angle; the others one by one.
    x = homes.select(F.col("node").alias("a"), F.col("home").alias("home_a"), F.col("cell").alias("cell_a"))
    y = homes.select(F.col("node").alias("b"), F.col("home").alias("home_b"), F.col("cell").alias("cell_b"))
    counted = F.coalesce((F.col("home_a") == F.col("home_b")) & (F.col("cell_a") + F.col("cell_b") < CELLS), F.lit(False))
    single = links.join(x, "a", "left").join(y, "b", "left").where(~counted).select("a", "b")
    weight = nodes.select(F.col("node").alias("b"), F.col("n").alias("w"))
    each = single.unionByName(single.select(F.col("b").alias("a"), F.col("a").alias("b"))) \
        .join(weight, "b").groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("single"))
    sure = _sure_counts(homes)
    label = components(links)
    found = nodes.join(each, "node", "left").join(sure, "node", "left").join(label, "node", "left") \
        .select("blob", "first", F.coalesce("label", "node").alias("label"),
                (F.col("n") - 1 + F.coalesce("single", F.lit(0)) + F.coalesce("sure", F.lit(0))).alias("n_links"))
    found = materialise(found)
    ids = found.groupBy("label").agg(F.min("first").alias("component_id"))
    found = found.join(ids, "label").select("blob", "n_links", "component_id")
    lone = F.col("vec_id").isNull()
    out = rows.withColumn("blob", F.when(~lone, F.col("blob"))).join(found, "blob", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _homes(near: DataFrame, nodes: DataFrame, angle: float) -> DataFrame:
    """(node, n, home, cell) of the centres and of the nodes next to one; a cell is an angle rounded up."""
    centres = near.select(F.col("a").alias("home")).distinct().join(near.select(F.col("b").alias("home")).distinct(), "home", "left_anti")
    taken = near.join(centres, near.a == centres.home).groupBy(F.col("b").alias("node")).agg(F.min(F.struct("home", "angle")).alias("h"))
    # One cell is left over for rounding: sums below CELLS are within the threshold's angle.
    cell = F.ceil(F.col("h.angle") / angle * (CELLS - 1) + 1e-6).cast("long")
    all_homes = taken.select("node", F.col("h.home").alias("home"), cell.alias("cell")) \
        .unionByName(centres.select(F.col("home").alias("node"), "home", F.lit(0).cast("long").alias("cell")))
    return cut_lineage(all_homes.join(nodes.select("node", "n"), "node"))


def _open_pairs(members: DataFrame, homes: DataFrame, done: DataFrame) -> DataFrame:
    """(a, b): pairs that no angle vouches for and that were not compared yet: those of one home, each once, found by
    their cells, and those of a bucket that have different homes."""
    band = CELLS // BANDS
    rim = homes.where(F.col("cell") * 2 >= CELLS)  # of two cells that add up to CELLS or more, the larger one
    x = rim.select("home", F.explode(F.sequence(F.floor((CELLS - F.col("cell")) / band), F.floor(F.col("cell") / band))).alias("band"),
                   F.col("node").alias("u"), F.col("cell").alias("cell_u"))
    y = homes.select("home", F.floor(F.col("cell") / band).alias("band"), F.col("node").alias("v"), F.col("cell").alias("cell_v"))
    larger = (F.col("cell_v") < F.col("cell_u")) | ((F.col("cell_v") == F.col("cell_u")) & (F.col("v") < F.col("u")))
    within = x.join(y, ["home", "band"]).where((F.col("cell_u") + F.col("cell_v") >= CELLS) & larger) \
        .select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))
    placed = cut_lineage(members.join(homes.select("node", "home"), "node", "left").select("key", "node", F.coalesce("home", "node").alias("home")))
    mixed = placed.groupBy("key").agg(F.min("home").alias("low"), F.max("home").alias("high")).where("low < high").select("key")
    placed = cut_lineage(placed.join(mixed, "key").select("key", "node", "home"))
    x = placed.select("key", F.col("node").alias("u"), F.col("home").alias("home_u"))
    y = placed.select("key", F.col("node").alias("v"), F.col("home").alias("home_v"))
    between = x.join(y, "key").where("home_u < home_v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    return cut_lineage(within.unionByName(between).join(done, ["a", "b"], "left_anti"))


def _sure_counts(homes: DataFrame) -> DataFrame:
    """(node, sure): vectors of other nodes of the same home whose angles and the node's add up to less than the threshold's."""
    cells = cut_lineage(homes.groupBy("home", "cell").agg(F.sum("n").alias("n")))
    # Running sums over a home's cells, CELLS rows at most, asked at the largest cell that still fits.
    asked = cells.select("home", (F.lit(CELLS - 1) - F.col("cell")).alias("at"), F.lit(0).cast("long").alias("n"), F.col("cell").alias("asks")) \
        .unionByName(cells.select("home", F.col("cell").alias("at"), "n", F.lit(None).cast("long").alias("asks")))
    running = F.sum("n").over(Window.partitionBy("home").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    known = asked.withColumn("sum", running).where("asks IS NOT NULL").select("home", F.col("asks").alias("cell"), "sum")
    own = F.when(F.col("cell") * 2 < CELLS, F.col("n")).otherwise(0)
    return homes.join(known, ["home", "cell"]).select("node", (F.col("sum") - own).alias("sure"))
