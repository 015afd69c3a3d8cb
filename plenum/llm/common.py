"""Helpers shared by the corpus operators: column picking, the word rule and
in-task iteration over Arrow batches.

Word rule (used by every operator on words): ``A-Z`` is lower-cased, and a word
is a maximal run of code points other than ASCII non-alphanumerics. On UTF-8
bytes that is: keep ``0-9``, ``a-z`` and every byte from 0x80 up.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: byte -> lower-cased word byte, or a blank
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else (b if b in _KEEP else 0x20) for b in range(256))

#: about so much text is held as Python objects at a time inside one task
SLICE_BYTES = 1 << 20


def split_words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text under the word rule."""
    return text.translate(WORD_BYTES).split()


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null text becomes empty), so that further
    columns of the input, whatever their names, neither travel nor clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def id_crc(doc_id: Column) -> Column:
    """crc32 of the decimal id (null ids count as the text ``null``)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))


def text_bytes(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of an Arrow column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for v in column.cast(kind):
        b = v.as_py()
        yield b if b is not None else b""


def slices(batch: pa.RecordBatch, text_index: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into pieces of about SLICE_BYTES of text (one row at least),
    so that what a task expands in Python stays bounded by one text."""
    start, size = 0, 0
    col = batch.column(text_index)
    for i in range(batch.num_rows):
        v = col[i]
        n = v.as_buffer().size if v.is_valid else 0
        if size and size + n > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += max(n, 1)
    if start < batch.num_rows:
        yield batch.slice(start, batch.num_rows - start)


def materialise(df: DataFrame) -> DataFrame:
    """Write an intermediate table as Parquet below the shared checkpoint folder
    and read it back: a lost executor loses nothing, and wide texts take less
    room than in a checkpoint."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/plenum-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialise`` wrote and nothing reads any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        if folder.rsplit("/", 1)[1].startswith("plenum-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def map_in_place(docs: DataFrame, run, added: dict[str, str] | None = None) -> DataFrame:
    """``mapInArrow`` over all columns of a table whatever their names (clashes,
    dots): they travel as ``c0, c1, ...`` and get their names back. ``added``
    (name -> type) are new columns; input columns of these names are replaced."""
    added = added or {}
    names = [c for c in docs.columns if c not in added]
    keep = [i for i, c in enumerate(docs.columns) if c not in added]
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).select(*[f"c{i}" for i in keep])
    schema = T.StructType([*plain.schema.fields, *[T.StructField(f"a{i}", T._parse_datatype_string(kind))
                                                   for i, kind in enumerate(added.values())]])
    return plain.mapInArrow(run, schema).toDF(*names, *added)


def release_shuffles(spark, passes: int = 2) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps now instead
    of at the driver's next garbage collection."""
    import gc
    import time

    for _ in range(passes):  # Python lets go of its handles, then the JVM of the plans, then the cleaner acts
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
