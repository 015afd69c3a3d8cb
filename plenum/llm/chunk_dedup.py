"""Exact de-duplication by content-defined chunk recipes (built-in functions only).

Texts are equal when they are identical after deleting blanks and
``\\x09-\\x0D``. Each normalised text is cut at content-defined boundaries;
the distinct chunks form a dictionary whose 64-bit identifiers are *verified*
(no two different chunks share one; otherwise the identifier is widened by
another salted hash and verified again). Two documents are equal exactly when
their ordered identifier lists are equal, so after the dictionary has been
built only short lists travel, never the long texts again.

Skew: chunks and rows are pre-aggregated before each shuffle, group facts are
joined back by an equi-join whose hot side AQE can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import id_and_text

BLANKS = r"[\x20\x09-\x0D]+"
MIN_CHUNK, MAX_CHUNK = 384, 4096
#: A chunk ends after such a pair of characters (about one pair in a few dozen).
BOUNDARY = r"[b-dgkmpvwzB-DGKMPVWZ0-3à-ïа-п一-忿][b-dghkmpvwzB-DGHKMPVWZ4-7à-ï]"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, "")


def chunk_pattern(min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK) -> str:
    """From its start a chunk runs at least ``min_chunk`` characters to the first
    boundary pair, or ``max_chunk`` characters (or to the end) when none comes.
    The cut depends on nothing but the characters since the chunk's start."""
    return rf"(?s).{{{min_chunk},{max_chunk}}}?{BOUNDARY}|.{{1,{max_chunk}}}"


def chunks(norm: Column, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK) -> Column:
    return F.regexp_extract_all(norm, F.lit(chunk_pattern(min_chunk, max_chunk)), F.lit(0))


def _identifier(chunk: Column, width: int, first_bits: int) -> Column:
    """``width`` 64-bit hashes of a chunk; ``first_bits`` narrows the first (tests)."""
    parts = [F.xxhash64(chunk) if k == 0 else F.xxhash64(chunk, F.lit(k)) for k in range(width)]
    if first_bits < 64:
        parts[0] = parts[0].bitwiseAND(F.lit((1 << first_bits) - 1))
    return F.array(*parts)


def verified_width(docs: DataFrame, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK,
                   first_bits: int = 64) -> int:
    """Build the chunk dictionary (distinct chunks, compared byte by byte by the
    grouping) and return the number of hashes an identifier needs to be unique
    in it. One hash is practically always enough; the check is what makes it sure."""
    d = id_and_text(docs)
    dictionary = (d.select(F.explode(chunks(normalised(F.col("text")), min_chunk, max_chunk)).alias("chunk"))
                  .groupBy("chunk").agg(F.lit(1).alias("one")))
    for width in range(1, 9):
        clash = (dictionary.select(_identifier(F.col("chunk"), width, first_bits).alias("id"))
                 .groupBy("id").count().where("count > 1"))
        if clash.isEmpty():
            return width
    raise RuntimeError("chunk identifiers could not be made unique")


def recipes(docs: DataFrame, width: int = 1, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK,
            first_bits: int = 64) -> DataFrame:
    """Per document: ``doc_id``, ``n_chars`` (original), ``text_sha256``
    (normalised) and ``recipe``, the ordered list of chunk identifiers."""
    d = id_and_text(docs).select("doc_id", F.length("text").alias("n_chars"),
                                 normalised(F.col("text")).alias("norm"))
    return d.select("doc_id", "n_chars", F.sha2("norm", 256).alias("text_sha256"),
                    F.flatten(F.transform(chunks(F.col("norm"), min_chunk, max_chunk),
                                          lambda c: _identifier(c, width, first_bits))).alias("recipe"))


def exact_groups(docs: DataFrame, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK,
                 first_bits: int = 64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, n_chunks``.

    Of equal texts the row with the most code points in the original text stays,
    then the smallest ``doc_id`` (a null id comes last). Null texts count as
    empty and form one group. Rows repeated with the same id and text stay as
    one row; the others come out with ``kept`` false. An empty table gives an
    empty result; further input columns are ignored.
    """
    width = verified_width(docs, min_chunk, max_chunk, first_bits)
    rows = cut_lineage(recipes(docs, width, min_chunk, max_chunk, first_bits)
                       .groupBy("doc_id", "n_chars", "text_sha256", "recipe")
                       .agg(F.count(F.lit(1)).alias("copies")))
    best = F.max(F.struct("n_chars", F.col("doc_id").isNotNull().alias("has_id"),
                          F.bitwise_not("doc_id").alias("order_id")))
    groups = cut_lineage(rows.groupBy("recipe").agg(F.sum("copies").alias("group_size"), best.alias("best"))
                         .select("recipe", "group_size", F.col("best.n_chars").alias("best_chars"),
                                 F.bitwise_not("best.order_id").alias("keep_id")))
    out = rows.join(groups, "recipe")
    first = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("best_chars"))
    return out.select("doc_id", "keep_id", "group_size", first.alias("first"), "text_sha256",
                      F.size("recipe").alias("n_chunks"),
                      F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")) \
        .select("doc_id", "keep_id", "group_size", (F.col("first") & (F.col("copy") == 1)).alias("kept"),
                "text_sha256", "n_chunks")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: the decisions are joined to
    the documents on id and normalised text, one row per kept pair. Null ids
    are matched as equal."""
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    cols = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    key_id = F.col(at[id_col]).cast("long")
    text = F.coalesce(F.col(at[text_col]).cast("string"), F.lit(""))
    keyed = named.withColumns({"k_id": F.coalesce(key_id.cast("string"), F.lit("null")), "k_len": F.length(text),
                               "k_sha": F.sha2(normalised(text), 256)})
    groups = exact_groups(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    kept = groups.where("kept").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("k_id"),
                                       F.col("text_sha256").alias("k_sha"))
    # Only repeated ids can match more than once; the longest row of such a pair is the kept one.
    pick = F.max_by(F.struct(*cols), "k_len")
    out = keyed.join(kept, ["k_id", "k_sha"]).groupBy("k_id", "k_sha").agg(pick.alias("row"))
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
