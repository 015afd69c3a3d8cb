"""Records: prompts, predictions, field salvage, training pairs, diagnostics
(D13-D19, D21-D23, X12, X14, A25 inputs).

Everything but an injected predictor (D14) and a batched map (V7) is a
built-in expression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import patterns as P
from ..functions import scalar as X
from . import documents as D


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- JSON text
def json_string(c) -> Column:
    """A JSON string literal for a text column, escaped the way Python's
    ``json.dumps(..., ensure_ascii=False)`` escapes it."""
    s = _c(c).cast("string")
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"),
                 ("\b", "\\b"), ("\f", "\\f")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), s, F.lit('"'))


def _json_value(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: json_string(x)), ", "), F.lit("]"))
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return c.cast("string")
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("true")).otherwise(F.lit("false"))
    return json_string(c)


def dump_json(df: DataFrame, cols: Sequence[str]) -> Column:
    """One-line JSON object of ``cols`` in that order, with Python's
    default separators (', ' and ': '); NULL becomes null."""
    parts = []
    for c in cols:
        dt = df.schema[c].dataType
        v = F.coalesce(_json_value(F.col(f"`{c}`"), dt), F.lit("null"))
        parts.append(F.concat(json_string(F.lit(c)), F.lit(": "), v))
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


# Marks for what a piece of JSON text is: characters that JSON allows inside strings only.
_ESCAPED, _STRING, _VALUE = "\ue000", "\ue001", "\ue002"
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?"


def is_valid_json(c, allow_nan: bool = True) -> Column:
    """Whether the whole text is one JSON value, as Python's ``json.loads`` has it: duplicate keys are allowed,
    trailing text is not, NaN and the infinities are numbers. Without ``allow_nan`` these are refused, as the JSON
    standard does. Null is not valid.

    The text is reduced: escapes, strings, numbers and words become marks, blanks between them go, and then the
    innermost lists and objects become value marks, one nesting level a step, until one mark is left."""
    v, s = _VALUE, f"[{_STRING}{_VALUE}]"
    text = _c(c)
    for mark in (_ESCAPED, _STRING, _VALUE):  # to letters: fine in a string, nothing outside
        text = F.replace(text, F.lit(mark), F.lit("x"))
    text = F.regexp_replace(text, r'\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})', _ESCAPED)
    text = F.regexp_replace(text, r'"[^"\\\x00-\x1F]*+"', _STRING)
    words = "true|false|null" + ("|NaN|-?Infinity" if allow_nan else "")
    text = F.regexp_replace(text, f"{words}|{_NUMBER}", v)
    text = F.regexp_replace(text, r"[ \t\n\r]++", "")
    one = rf"\[(?:{s}(?:,{s})*+)?\]|\{{(?:{_STRING}:{s}(?:,{_STRING}:{s})*+)?\}}"
    # A level is opened by a bracket, so there are no more steps than brackets; most end as one mark long before.
    def reduced(marks: Column) -> Column:
        opened = F.length(F.regexp_replace(marks, r"[^\[{]++", ""))
        steps = F.when(opened > 0, F.sequence(F.lit(1), opened)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, marks, lambda t, _: F.when(F.length(t) > 1, F.regexp_replace(t, one, v)).otherwise(t))

    return F.coalesce(X.bound(text, reduced).isin(_STRING, _VALUE), F.lit(False))


# A JSON list of strings without escapes, and one that starts with a comma: told without a parser.
_PLAIN_LIST = r'\A\[[ \t\n\r]*+(?:"[^"\\\x00-\x1F]*+"(?:[ \t\n\r]*+,[ \t\n\r]*+"[^"\\\x00-\x1F]*+")*+)?[ \t\n\r]*+\]\z'
_NO_LIST = r"\A\[[ \t\n\r]*+,"


def _joined_list(lst: Column, sep: str) -> Column:
    """The strings of a JSON list joined by ``sep``, '' if it does not parse."""
    inside = F.regexp_replace(lst, r'\A\[[ \t\n\r]*+"?|"?[ \t\n\r]*+\]\z', "")
    mark = sep.replace("\\", "\\\\").replace("$", "\\$")
    parsed = F.from_json(lst, "array<string>", {"allowSingleQuotes": "false"})
    return (F.when(lst.rlike(_PLAIN_LIST), F.regexp_replace(inside, r'"[ \t\n\r]*+,[ \t\n\r]*+"', mark))
            .when(lst.rlike(_NO_LIST), F.lit(""))
            .otherwise(F.coalesce(F.array_join(parsed, sep), F.lit(""))))


def salvage_fields(pred, keys: Sequence[str] = P.REQUIRED_KEYS, list_sep: str = ", ") -> Column:
    """Pull each key out of possibly malformed model output. Per key,
    case-insensitive: a JSON-looking list first (a list that does not parse
    gives an empty list), then a quoted scalar (stripped), else ''. List
    values are returned joined by ``list_sep`` so every field is text."""
    plain = [k for k in keys if k.isascii() and k.replace("_", "").isalnum()]  # any other key is a pattern of its own
    named = rf'(?i)"({"|".join(plain)})"(?=\s*:\s*(\[[^\]]*+\]|"[^"]*+"))'

    def own_pattern(text: Column, k: str) -> Column:
        lst = F.regexp_extract(text, rf'(?i)"{k}"\s*:\s*(\[[^\]]*+\])', 1)
        return F.when(lst != "", _joined_list(lst, list_sep)).otherwise(X.strip(F.regexp_extract(text, rf'(?i)"{k}"\s*:\s*"([^"]*+)"', 1)))

    def fields(text: Column, found: Column) -> Column:
        def value(kind: str) -> Column:
            return F.get(found["values"], F.array_position(found["kinds"], kind).cast("int") - 1)

        def field(k: str) -> Column:
            own = k.lower()
            return (F.when(found["all"].contains(f",[{own},"), X.bound(value(f"[{own}"), lambda lst: _joined_list(lst, list_sep)))
                    .when(found["all"].contains(f",{own},"), X.strip(F.btrim(value(own), F.lit('"'))))
                    .when(text.isNotNull(), F.lit("")))

        return F.struct(*[(field(k) if k in plain else own_pattern(text, k)).alias(k) for k in keys])

    # All keys that have a value, in one pass over the text, with their values in a second; a key is looked at, its value
    # only looked ahead to, so a key inside another's value counts as well.
    def with_kinds(pair: Column) -> Column:
        names = F.split(F.lower(F.array_join(pair["names"], ",")), ",")  # lowered at once
        kinds = F.zip_with(names, pair["values"], lambda n, v: F.when(v.startswith("["), F.concat(F.lit("["), n)).otherwise(n))
        return X.bound(kinds, lambda ks: F.struct(ks.alias("kinds"), pair["values"].alias("values"),
                                                  F.concat(F.lit(","), F.array_join(ks, ","), F.lit(",")).alias("all")))

    def salvaged(text: Column) -> Column:
        pair = F.struct(*[F.regexp_extract_all(text, F.lit(named), g).alias(n) for g, n in ((1, "names"), (2, "values"))])
        return X.bound(X.bound(pair, with_kinds), lambda found: fields(text, found))

    return X.bound(pred, salvaged)


def build_prompts(block, instruction: str = P.PROMPT_INSTRUCTION) -> Column:
    """Instruction + block."""
    return F.concat(F.lit(instruction), _c(block))


def _name_lists(b: Column) -> tuple[Column, Column, Column]:
    return (X.split_names(F.regexp_extract(b, P.AYES_RE, 1)),
            X.split_names(F.regexp_extract(b, P.NAYS_RE, 1)),
            X.split_names(F.regexp_extract(b, P.BLOCK_ABSENT_RE, 1)))


def rule_predictor(block, names: tuple[Column, Column, Column] | None = None) -> Column:
    """Default predictor for D14: a rule-based extractor written as built-in
    expressions (no model). Emits a JSON object with the required keys.
    ``names`` may pass pre-computed (ayes, noes, absent) arrays."""
    b = _c(block)
    ayes, noes, absent = names if names is not None else _name_lists(b)
    action = X.strip(F.regexp_extract(b, P.ACTION_RE, 1))
    parts = {
        "case_number": json_string(F.regexp_extract(b, P.CASE_CODE_RE, 1)),
        "project_address": json_string(X.strip(F.regexp_extract(b, r"[–-]\s*([^\n]*)", 1))),
        "action": json_string(action),
        "ayes": _json_value(ayes, T.ArrayType(T.StringType())),
        "noes": _json_value(noes, T.ArrayType(T.StringType())),
        "absent": _json_value(absent, T.ArrayType(T.StringType())),
        "vote": json_string(F.concat_ws("-", F.size(ayes).cast("string"), F.size(noes).cast("string"))),
    }
    body = F.concat_ws(", ", *[F.concat(json_string(F.lit(k)), F.lit(": "), v) for k, v in parts.items()])
    return F.concat(F.lit("{"), body, F.lit("} "), F.lit(P.TERMINATOR))


def with_rule_prediction(df: DataFrame, block_col: str = "block", out: str = "pred") -> DataFrame:
    """``rule_predictor`` as a DataFrame step: the three name lists are staged
    as columns first (each is read twice, for its JSON list and for the vote
    count), so each list is split once per block."""
    a, n, s = _name_lists(F.col(block_col))
    staged = df.withColumns({"__ayes": a, "__noes": n, "__absent": s})
    res = staged.withColumn(out, rule_predictor(block_col, (F.col("__ayes"), F.col("__noes"), F.col("__absent"))))
    return res.drop("__ayes", "__noes", "__absent")


def infer(df: DataFrame, prompt_col: str, predictor: Callable[[pd.Series], pd.Series] | None = None,
          out: str = "pred", block_col: str | None = None) -> DataFrame:
    """Apply a predictor to prompts in Arrow batches. ``predictor`` maps a
    pandas Series of prompts to a Series of strings (e.g. a model wrapper);
    without one the built-in rule predictor runs on ``block_col``."""
    if predictor is None:
        return with_rule_prediction(df, block_col or prompt_col, out)
    udf = F.pandas_udf(predictor, T.StringType())
    return df.withColumn(out, udf(F.col(prompt_col)))


def infer_with(df: DataFrame, prompt_col: str, load: Callable[[], Callable[[pd.Series], pd.Series]], out: str = "pred") -> DataFrame:
    """D14 with a model: ``load`` returns a predictor (Series of prompts -> Series of texts) and is called once in each
    Python worker's task, before its first batch; prompts then pass in Arrow batches. Null prompts stay null and are
    not shown to the predictor."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for prompts in batches:
            result = pd.Series([None] * len(prompts), dtype=object)
            asked = prompts.notna().to_numpy()
            if asked.any():
                result[asked] = list(predict(prompts[asked].reset_index(drop=True)))
            yield result

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(out, F.pandas_udf(run, T.StringType())(F.col(prompt_col)))


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType) -> DataFrame:
    """V7: a batched map over a dataset (e.g. tokenisation) — ``fn`` gets
    Arrow-backed pandas batches of each partition and returns frames of
    ``schema``; Spark partitions and schedules the work."""

    def run(it):
        for pdf in it:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def assemble_records(df: DataFrame, source_file: str, meeting_date: str, block: str, pred: str,
                     pos: str = "pos") -> DataFrame:
    """One result row per block: source file, meeting date, block header
    and the salvaged fields (X19 applied first) as the struct ``extracted``,
    its ``assessor_block`` cleaned to the block number (X15)."""
    fields = salvage_fields(X.before_token(pred))
    rows = df.select(
        F.col(source_file).alias("source_file"),
        F.col(meeting_date).alias("meeting_date"),
        F.col(pos).alias("block"),
        X.block_header(block).alias("block_header"),
        fields.alias("extracted"),
    )
    return rows.withColumn("extracted", F.col("extracted").withField(
        "assessor_block", X.clean_block_no(F.col("extracted.assessor_block"))))


def flat_records(records: DataFrame) -> DataFrame:
    """D16 -> P20 -> P21 -> P7: records as a flat table in the fixed column
    order, other columns at the end; list columns become joined text."""
    from .clean import flatten_struct, join_lists, order_columns

    return order_columns(join_lists(flatten_struct(records, "extracted"), P.JOINED_LIST_KEYS), P.FLAT_ORDER)


# ---------------------------------------------------------------- pairs
def code_summary(blocks: DataFrame, block_col: str = "block", year: str = "year", pos: str = "pos",
                 lenient: bool = False) -> DataFrame:
    """One pass over the blocks: per (year, normalised code) the number of
    blocks and the longest block (first on ties, A19); code '' collects the
    blocks without a code. Partially aggregated, so a hot code stays cheap;
    every pairing statistic is derived from this one (small) frame."""
    coded = blocks.select(year, pos, block_col, D.case_code(block_col, lenient).alias("code"))
    best = F.max_by(F.struct(F.col(pos).alias(pos), F.col(block_col).alias(block_col)),
                    F.struct(F.length(block_col), -F.col(pos)))
    return coded.groupBy(year, "code").agg(F.count(F.lit(1)).alias("n_blocks"), best.alias("__b")) \
        .select(year, "code", "n_blocks", F.col(f"__b.{pos}").alias(pos), F.col(f"__b.{block_col}").alias(block_col))


def block_codes(blocks: DataFrame, block_col: str = "block", year: str = "year", pos: str = "pos",
                lenient: bool = False, summary: DataFrame | None = None) -> DataFrame:
    """Blocks with their normalised case code; blocks without a code dropped;
    one (the longest, first on ties) block per (year, code) — A19. A summary
    cut down to its codes gives the codes alone."""
    s = summary if summary is not None else code_summary(blocks, block_col, year, pos, lenient)
    return s.filter(F.col("code") != "").select(year, "code", *[c for c in (pos, block_col) if c in s.columns])


def training_pairs(labels: DataFrame, blocks: DataFrame, label_cols: Sequence[str], year: str = "year",
                   case_col: str = "case_number", block_col: str = "block", pos: str = "pos",
                   list_keys: Sequence[str] = P.LIST_KEYS, required: Sequence[str] = P.REQUIRED_KEYS,
                   summary: DataFrame | None = None) -> DataFrame:
    """Join labels to the longest block of their (year, normalised code);
    backfill required keys; completion = label JSON + ' ' + terminator;
    prompt = block + blank line. Returns every label with ``paired``. With a
    ``summary`` of codes alone (for who asks only what is paired) there is no
    text to join, and the prompt is null."""
    from .clean import ensure_fields

    coded = block_codes(blocks, block_col, year, pos, summary=summary)
    lab = ensure_fields(labels, list(required), list(list_keys))
    keys_out = list(dict.fromkeys(list(label_cols) + list(required)))
    lab = lab.withColumn("code", X.normalise_case(case_col)) \
             .withColumn("completion", F.concat(dump_json(lab, keys_out), F.lit(" " + P.TERMINATOR)))
    # ``paired`` is told by a mark, so that no text is joined where only the pairing is asked for. A blank code meets
    # nothing: as a null key it is not shuffled to one task.
    text = F.col(block_col) if block_col in coded.columns else F.lit(None).cast("string")
    blocks = coded.select(F.col(year).alias("__year"), F.col("code").alias("__code"), text.alias("__block"), F.lit(True).alias("__found"))
    asked = lab.withColumn("__ask", F.when(F.col("code") != "", F.col("code")))
    j = asked.join(blocks, (F.col(year) == F.col("__year")) & (F.col("__ask") == F.col("__code")), "left")
    return j.select(*labels.columns, "code", F.concat("__block", F.lit("\n\n")).alias("prompt"),
                    "completion", F.coalesce("__found", F.lit(False)).alias("paired"))


def pairing_diagnostics(pairs: DataFrame, blocks: DataFrame, year: str = "year", block_col: str = "block",
                        pos: str = "pos", summary: DataFrame | None = None) -> DataFrame:
    """D18 in long form: (year, kind, code) for label codes without a block
    (blank -> '<missing case_number>') and block codes without a label,
    sorted. Long rows rather than per-year arrays, so a large year is never
    collected into one row; a writer partitions them by year (K4)."""
    missing = pairs.filter(~F.col("paired")).select(
        year, F.lit("missing_label_case_numbers").alias("kind"),
        F.when(F.col("code") == "", F.lit(P.MISSING_CASE)).otherwise(F.col("code")).alias("code"))
    coded = block_codes(blocks, block_col, year, pos, summary=summary)
    unmatched = coded.join(pairs.filter("paired").select(year, "code"), [year, "code"], "left_anti") \
        .select(year, F.lit("unmatched_block_case_numbers").alias("kind"), "code")
    return missing.unionByName(unmatched).orderBy(year, "kind", "code")


def split_train_test(df: DataFrame, id_col: str, seed: int = 42, test_pct: int = 10) -> DataFrame:
    """Deterministic split, stable under repartitioning and retries:
    a row is in the test set when an md5-derived bucket of (id, seed) falls
    below ``test_pct`` of 100."""
    h = F.conv(F.substring(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10)
    return df.withColumn("split", F.when(F.pmod(h.cast("bigint"), F.lit(100)) < test_pct, F.lit("test"))
                         .otherwise(F.lit("train")))


def explode_votes(records: DataFrame, case_col: str = "case_number", date_col: str = "meeting_date",
                  vote_cols: Mapping[str, str] | None = None) -> DataFrame:
    """Long vote table (case, date, member, vote) from joined name lists."""
    from .aggregate import explode_nonempty

    vote_cols = vote_cols or {"ayes": "aye", "noes": "no", "absent": "absent"}
    # one array of (member, vote) per record and a single explode: the records
    # are read once, not once per vote column as a union would
    def tag(label: str):
        # one-argument lambda: F.transform passes the index to a 2-argument one
        return lambda m: F.struct(m.alias("member"), F.lit(label).alias("vote"))

    tagged = F.concat(*[F.transform(X.split_names(col), tag(label)) for col, label in vote_cols.items()])
    out = explode_nonempty(records, [case_col, date_col], tagged, ("v",), with_pos=False)
    return out.select(case_col, date_col, "v.member", "v.vote")


def project_history(records: DataFrame, case_col: str = "case_number", date_col: str = "meeting_date",
                    action_col: str = "action") -> DataFrame:
    """Per case: first and last meeting, number of appearances, and the
    action at the last meeting (max_by, partially aggregated)."""
    return records.filter(F.col(case_col) != "").groupBy(case_col).agg(
        F.min(date_col).alias("first_meeting"), F.max(date_col).alias("last_meeting"),
        F.count(F.lit(1)).alias("appearances"), F.max_by(action_col, F.struct(F.coalesce(F.col(date_col), F.lit("")), F.col(action_col))).alias("last_action"),
        F.countDistinct(action_col).cast("bigint").alias("n_actions"))


def canonical_keys(label_map, aliases: Mapping[str, str]) -> Column:
    """Rename misspelt keys of a map<string,string> label. When both the
    alias and the canonical key are present, the canonical value wins."""
    m = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    lm = _c(label_map)
    renamed = F.transform_keys(F.map_filter(lm, lambda k, v: F.try_element_at(m, k).isNull()), lambda k, v: k)
    moved = F.transform_keys(F.map_filter(lm, lambda k, v: F.try_element_at(m, k).isNotNull()),
                             lambda k, v: F.try_element_at(m, k))
    moved = F.map_filter(moved, lambda k, v: ~F.array_contains(F.map_keys(renamed), k))
    return F.map_concat(renamed, moved)
