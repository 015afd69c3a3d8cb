"""Scans (S1-S12). Schemas are passed explicitly wherever the caller knows
them; inference is a convenience for exploration only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str = "parquet",
               encoding: str | None = None, header: bool = True, **options) -> DataFrame:
    """Table scan. CSV with a header row; ``encoding`` e.g. ISO-8859-1.
    Parquet scans get column pruning and filter pushdown from Catalyst."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", str(header).lower()).option("mode", "PERMISSIVE")
        if schema is None:
            r = r.option("inferSchema", "true")
    if encoding:
        r = r.option("encoding", encoding)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ROWS_PER_TASK = 50_000


def spread(df: DataFrame, rows: int = ROWS_PER_TASK) -> DataFrame:
    """The same rows over at least as many partitions as the session has cores, and over more where a partition would
    hold more than ``rows`` rows: a scan is cut by bytes and by row groups, so that a task with heavy work on narrow
    rows would grow with the table. The rows are counted first (of a Parquet scan, in its footers). Inputs with enough
    partitions stay as they are; select the needed columns first."""
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def read_by_filename(spark: SparkSession, glob: str, pattern: str, key: str = "part_key",
                     fmt: str = "csv", schema=None, **options) -> DataFrame:
    """S3: one scan over many files; a key derived from each file name by the
    first group of ``pattern`` (replaces a per-file Python loop)."""
    df = read_table(spark, glob, schema, fmt, **options)
    return df.withColumn(key, F.regexp_extract(F.col("_metadata.file_name"), pattern, 1))


def read_jsonl(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """S4."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_labels(spark: SparkSession, glob: str, year_pattern: str = r"^(\d{4})_labeled\.json$") -> DataFrame:
    """JSON files whose root is an array of open-keyed objects, one row per
    object as map<string,string> plus the year from the file name. A file whose
    root is not an array raises."""
    raw = spark.read.text(glob, wholetext=True).select(
        F.col("value"), F.col("_metadata.file_name").alias("file_name"))
    first = F.substring(F.regexp_replace("value", r"^\s+", ""), 1, 1)
    checked = raw.withColumn("value", F.when(first == "[", F.col("value"))
                             .otherwise(F.raise_error(F.concat(F.col("file_name"), F.lit(" must be a JSON array")))))
    items = checked.select(
        F.regexp_extract("file_name", year_pattern, 1).cast("int").alias("year"),
        F.posexplode(F.from_json("value", "array<map<string,string>>")).alias("pos", "label"))
    return items


def lenient_utf8(content) -> Column:
    """Text of UTF-8 bytes in which bytes that belong to no character are dropped (the rest of a broken character too).
    Read as Latin-1 every byte is one character, so whole byte sequences can be told from stray bytes by a pattern;
    only bytes beyond ASCII are looked at."""
    content = F.col(content) if isinstance(content, str) else content
    tail = "[\\x80-\\xBF]"
    whole = "|".join([f"[\\xC2-\\xDF]{tail}", f"\\xE0[\\xA0-\\xBF]{tail}", f"[\\xE1-\\xEC\\xEE\\xEF]{tail}{{2}}", f"\\xED[\\x80-\\x9F]{tail}",
                      f"\\xF0[\\x90-\\xBF]{tail}{{2}}", f"[\\xF1-\\xF3]{tail}{{3}}", f"\\xF4[\\x80-\\x8F]{tail}{{2}}"])
    kept = F.regexp_replace(F.decode(content, "ISO-8859-1"), f"({whole})|[\\x80-\\xFF]", "$1")
    plain = content.cast("string")
    return F.when(F.is_valid_utf8(plain), plain).otherwise(F.decode(F.encode(kept, "ISO-8859-1"), "UTF-8"))


def read_documents(spark: SparkSession, glob: str, name_pattern: str | None = None) -> DataFrame:
    """Whole-document scan, bytes that are no UTF-8 dropped; ``\\r\\n`` and ``\\r`` normalised to
    ``\\n``; file name kept; optional year from the name."""
    df = spark.read.format("binaryFile").load(glob).select(
        F.regexp_replace(lenient_utf8("content"), "\r\n?", "\n").alias("text"),
        F.col("_metadata.file_name").alias("file_name"))
    if name_pattern:
        df = df.withColumn("year", F.regexp_extract("file_name", name_pattern, 1))
    return df


def concat_parts(df: DataFrame, key: str, name: str = "file_name", text: str = "text", sep: str = "\n\n") -> DataFrame:
    """Several files of one key joined in name order with ``sep``. The
    number of files per key is small by construction (a year's samples)."""
    g = df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(name, text))).alias("__p"))
    return g.select(key, F.array_join(F.transform("__p", lambda s: s[text]), sep).alias(text))


def matrix_json_to_rows(df: DataFrame, col: str, extra: Sequence[str] = ()) -> DataFrame:
    """A JSON array-of-arrays payload (row 0 = header) -> one row per data
    row with a map header -> value (all text)."""
    m = df.select(*extra, F.from_json(col, "array<array<string>>").alias("__m"))
    return m.select(*extra, F.explode(F.slice("__m", 2, F.greatest(F.size("__m"), F.lit(1)))).alias("__r"),
                    F.col("__m")[0].alias("__h")) \
            .select(*extra, F.map_from_arrays("__h", "__r").alias("row"))


def sample_table(spark: SparkSession, df: DataFrame, n: int = 1000, view: str = "t") -> DataFrame:
    """SELECT * ... LIMIT n on a temp view (the preview is the feature)."""
    df.createOrReplaceTempView(view)
    return spark.sql(f"SELECT * FROM {view} LIMIT {int(n)}")


def read_binary(spark: SparkSession, glob: str) -> DataFrame:
    """Raw files (pages, PDFs) as path, length, content."""
    return spark.read.format("binaryFile").load(glob)


def promote_header(df: DataFrame, order: str, skip: int, value_cols: Sequence[str]) -> DataFrame:
    """Rows ordered by ``order``; the first ``skip`` rows are preamble,
    row ``skip`` holds the header. Returns the rows after it renamed to the
    cleaned header. The header row is fetched once (one row)."""
    hdr = df.filter(F.col(order) == skip).select(*value_cols).first()
    names = [(str(h).strip().lower() if h is not None else c) for h, c in zip(hdr, value_cols)]
    return df.filter(F.col(order) > skip).select(*[F.col(c).alias(n) for c, n in zip(value_cols, names)])


def header_rows(df: DataFrame, order: str, skip: int, value_cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """S11 in the plan: (``keep``, ``order``, ``cells``) of the rows after row ``skip``; ``cells`` is a map from the cleaned
    cells of row ``skip`` (stripped, lower case; an empty one keeps its column's name) to the row's values. The header
    is a scalar subquery, so nothing is fetched while the query is built. A repeated header cell keeps its first
    column; without a header row there are no names and ``cells`` is empty."""
    names = F.array(*[F.coalesce(F.nullif(F.lower(F.trim(F.col(c).cast("string"))), F.lit("")), F.lit(c)) for c in value_cols])
    header = df.where(F.col(order) == skip).agg(F.min(names).alias("h")).scalar()
    cells = F.array(*[F.col(c).cast("string") for c in value_cols])
    named = F.transform(cells, lambda c, i: F.struct(F.get("__header", i).alias("name"), c.alias("value")))
    pairs = F.filter(named, lambda p, i: F.array_position("__header", p["name"]) == i + 1)
    rows = df.where(F.col(order) > skip).withColumn("__header", header)  # higher-order functions take no subquery themselves
    return rows.select(*keep, order, F.map_from_entries(pairs).alias("cells"))


def read_text_files(spark: SparkSession, path: str, text: str = "text") -> DataFrame:
    """What ``sinks.write_text_files`` wrote: the folders' keys as columns and each file's whole text."""
    return spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"\n\z", "").alias(text), "*").drop("value")


def rows_to_table(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """An inline list of open-keyed records -> map<string,string> rows."""
    data = [({k: (None if v is None else str(v)) for k, v in r.items()},) for r in rows]
    return spark.createDataFrame(data, "label map<string,string>")


def drop_index_col(df: DataFrame) -> DataFrame:
    """K2 on read: drop a blank-named / 'Unnamed: 0' first column."""
    first = df.columns[0]
    if first in ("", "_c0", "Unnamed: 0"):
        return df.drop(first)
    return df


def file_year(c: Column | str, pattern: str = r"(\d{4})") -> Column:
    """Year from a file name."""
    return F.regexp_extract(F.col(c) if isinstance(c, str) else c, pattern, 1)
