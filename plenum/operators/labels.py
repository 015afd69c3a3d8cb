"""Hand labels from file to training pair.

Labels are open-keyed JSON objects whose values may be text, numbers, nested
lists or null. Each label is kept as two maps with the same keys in the order
of the file: ``label`` holds VARIANT values, which say what type a value has,
and ``raw`` its text (the value itself of a string, JSON of anything else,
nested keys in the order of the file). Keys can so be mended and added, and
the label written out again, without a schema and without a Python parser.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import scalar as X
from .aggregate import explode_nonempty
from .records import json_string


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_labels(files: DataFrame, name: str = "file_name", value: str = "value", year_pattern: str = P.LABEL_FILE_RE) -> DataFrame:
    """One row per label of files whose text is a JSON array of objects: ``year`` (from the file name), ``file_name``,
    ``pos`` (0-based in its file), ``label``, ``raw``. Files of other names are left out; a text that is no array
    raises; an element that is no object gives empty maps."""
    named = files.where(F.col(name).rlike(year_pattern))
    array = F.regexp_extract(value, r"^\s*+(.)", 1) == "["
    checked = F.when(array, F.col(value)).otherwise(F.raise_error(F.concat(F.col(name), F.lit(" must be a JSON array"))))
    both = F.arrays_zip(F.from_json(checked, "array<map<string,variant>>").alias("label"), F.from_json(checked, "array<map<string,string>>").alias("raw"))
    year = F.regexp_extract(name, year_pattern, 1)
    rows = explode_nonempty(named, [year.alias("year"), F.col(name).alias("file_name")], both, ("pos", "l"))
    empty = [F.create_map().cast(f"map<string,{t}>") for t in ("variant", "string")]
    return rows.select("year", "file_name", "pos", F.coalesce("l.label", empty[0]).alias("label"), F.coalesce("l.raw", empty[1]).alias("raw"))


def read_typed_labels(spark: SparkSession, glob: str, year_pattern: str = P.LABEL_FILE_RE) -> DataFrame:
    """``parse_labels`` of files."""
    files = spark.read.text(glob, wholetext=True).select("value", F.col("_metadata.file_name").alias("file_name"))
    return parse_labels(files, year_pattern=year_pattern)


def mend_keys(label, aliases: Mapping[str, str]) -> Column:
    """D23 in place: misspelt keys get their right name where they stand. A key of the right name wins over misspelt
    ones; of several misspelt ones the first does. Works for maps of any values."""
    if not aliases:
        return _c(label)
    known = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    keys = F.map_keys(_c(label))
    right = F.transform(keys, lambda k: F.coalesce(F.try_element_at(known, k), k))

    def stays(both: Column, i: Column) -> Column:
        new = F.get(both["right"], i)
        return (F.get(both["keys"], i) == new) | (~F.array_contains(both["keys"], new) & (F.array_position(both["right"], new) == i + 1))

    def mended(both: Column) -> Column:
        named = F.transform(F.map_entries(_c(label)), lambda e, i: F.struct(F.get(both["right"], i).alias("key"), e["value"].alias("value")))
        return F.map_from_entries(F.filter(named, lambda e, i: stays(both, i)))

    # The names are looked up once a label, not once for each of its keys.
    return X.bound(F.struct(keys.alias("keys"), right.alias("right")), mended)


def spaced_json(c) -> Column:
    """Compact JSON with a blank after each comma and colon outside strings, as Python writes it by default."""
    pieces = F.regexp_extract_all(_c(c), F.lit(r'"(?:[^"\\]++|\\.)*+"|[^"]++'), 0)
    return F.array_join(F.transform(pieces, lambda p: F.when(p.startswith('"'), p).otherwise(F.replace(F.replace(p, F.lit(","), F.lit(", ")), F.lit(":"), F.lit(": ")))), "")


def label_json(label, raw, required: Sequence[str] = P.REQUIRED_KEYS, list_keys: Sequence[str] = P.LIST_KEYS) -> Column:
    """P22 + X14: the label as one line of JSON, keys in their order, then the required keys it lacks (an empty list for
    ``list_keys``, else an empty text). A key that is present keeps its value, null too."""
    label, raw = _c(label), _c(raw)

    def value(k: Column) -> Column:
        v, text = F.element_at(label, k), F.element_at(raw, k)
        return F.when(v.isNull() | F.is_variant_null(v), F.lit("null")).when(F.schema_of_variant(v) == "STRING", json_string(text)).otherwise(spaced_json(text))

    own = F.transform(F.map_keys(label), lambda k: F.concat(json_string(k), F.lit(": "), value(k)))
    lists = F.array(*[F.lit(k) for k in list_keys]).cast("array<string>")
    missing = F.filter(F.array(*[F.lit(k) for k in required]).cast("array<string>"), lambda k: ~F.map_contains_key(label, k))
    filled = F.transform(missing, lambda k: F.concat(json_string(k), F.lit(": "), F.when(F.array_contains(lists, k), F.lit("[]")).otherwise(F.lit('""'))))
    return F.concat(F.lit("{"), F.array_join(F.concat(own, filled), ", "), F.lit("}"))


def pair_labels(labels: DataFrame, longest: DataFrame, aliases: Mapping[str, str] | None = None, year: str = "year", block: str = "block",
                case_key: str = "case_number") -> DataFrame:
    """Each label with the longest block of its (year, normalised case number). ``longest`` has one row per (year,
    code), code not blank. Adds ``code``, ``paired``, ``prompt`` (null without a block) and ``completion``. Labels
    without a case number keep an empty code and meet no block; they do not take part in the join."""
    mended = labels.withColumns({"label": mend_keys("label", aliases or {}), "raw": mend_keys("raw", aliases or {})})
    mended = mended.withColumn("code", F.coalesce(X.normalise_case(F.try_element_at(F.col("raw"), F.lit(case_key))), F.lit(""))) \
        .withColumn("completion", F.concat(label_json("label", "raw"), F.lit(" " + P.TERMINATOR)))
    blocks = longest.select(F.col(year).alias("__year"), F.col("code").alias("__code"), F.col(block).alias("__block"))
    # A null key meets nothing and is not shuffled to one task: outer joins spread such rows.
    asked = mended.withColumn("__ask", F.when(F.col("code") != "", F.col("code")))
    joined = asked.join(blocks, (F.col(year) == F.col("__year")) & (F.col("__ask") == F.col("__code")), "left")
    return joined.select(*[c for c in mended.columns if c != "completion"], F.col("__block").isNotNull().alias("paired"),
                         F.concat("__block", F.lit("\n\n")).alias("prompt"), "completion")
