"""Documents, conversations, events-as-records and API payloads: per-key
selection, deterministic splits, turn pairs, record flattening and the
JSON-matrix scan, on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import aggregate as A
from ..operators import clean as C
from ..operators import merge as M
from ..operators import records as R
from ..sources.readers import matrix_json_to_rows, table
from .registry import query


@query("longest_per_key", sql="""
SELECT lang, source, max_by(doc_id, [n_chars, -doc_id]) AS doc_id, max(n_chars) AS n_chars
FROM documents GROUP BY lang, source
""")
def longest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """A19 + W4: the longest document per (lang, source); lowest id on ties."""
    d = table(spark, sf, "documents").select("lang", "source", "doc_id", "n_chars")
    return d.groupBy("lang", "source").agg(
        F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("doc_id"), F.max("n_chars").alias("n_chars"))


@query("longest_text_per_key", sql="""
SELECT lang, source, max_by(doc_id, [length(text), -doc_id]) AS doc_id, CAST(max(length(text)) AS BIGINT) AS text_chars
FROM documents GROUP BY lang, source
""")
def longest_text_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """A19 on the whole texts (length measured on the text itself)."""
    # Lengths, not texts, go into the aggregate.
    d = table(spark, sf, "documents").select("lang", "source", "doc_id", F.length("text").cast("bigint").alias("text_chars"))
    return A.longest_per_key(d, ["lang", "source"], "text_chars", "doc_id", sized=True)


@query("latest_per_key", sql="""
SELECT lang, source, max(doc_id) AS doc_id FROM documents GROUP BY lang, source
""")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """Order-preserving de-duplication — the first row per key by a
    descending position (the latest document per (lang, source))."""
    d = table(spark, sf, "documents").select("lang", "source", "doc_id").withColumn("rank_key", -F.col("doc_id"))
    return C.dedupe_first(d, ["lang", "source"], "rank_key").select("lang", "source", "doc_id")


@query("train_test_split", sql="""
SELECT doc_id, CASE WHEN CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 100 < 10
                    THEN 'test' ELSE 'train' END AS split
FROM documents
""")
def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    """90/10 split, seed 42, by an md5 bucket of the id (stable across
    repartitioning and task retries)."""
    d = table(spark, sf, "documents").select("doc_id")
    return R.split_train_test(d, "doc_id", 42, 10)


@query("conversation_pairs", sql="""
SELECT u.conv_id, u.turn, CAST(length(u.text) AS BIGINT) AS prompt_chars, CAST(length(a.text) AS BIGINT) AS completion_chars
FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
""")
def conversation_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """J8-style pairing: each user turn with the assistant turn that follows.
    The join key is (conversation, turn), so one long conversation spreads
    over many partitions instead of landing in one task."""
    cv = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    u = cv.filter(F.col("role") == "user").select("conv_id", (F.col("turn") + 1).alias("next_turn"),
                                                  F.col("turn"), F.col("text").alias("prompt"))
    a = cv.filter(F.col("role") == "assistant").select("conv_id", F.col("turn").alias("next_turn"),
                                                       F.col("text").alias("completion"))
    j = u.join(a, ["conv_id", "next_turn"])
    return j.select("conv_id", "turn", F.length("prompt").cast("bigint").alias("prompt_chars"),
                    F.length("completion").cast("bigint").alias("completion_chars"))


def _event_records(spark: SparkSession, sf: str) -> DataFrame:
    """Inference-style JSON records from events: flat fields plus a nested
    'extracted' object whose vote lists are arrays."""
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "props")
    props = F.from_json("props", "struct<k:bigint>")
    extracted = F.struct(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("case_number"),
        F.col("event_type").alias("action"),
        props["k"].cast("string").alias("vote"),
        F.array(F.concat(F.lit("u"), F.col("user_id").cast("string")),
                F.concat(F.lit("k"), props["k"].cast("string"))).alias("ayes"),
        F.when(F.col("event_type") == "error", F.array(F.lit("sys"))).alias("noes"))
    return e.select(F.concat(F.lit("events_"), F.col("event_type"), F.lit(".jsonl")).alias("source_file"),
                    F.to_date("ts").cast("string").alias("meeting_date"), "event_id", extracted.alias("extracted"))


_ORDER_FIELDS = [c for c in P.FLAT_ORDER if c != "block_header"]


@query("ensure_and_order", sql="""
WITH e AS (SELECT event_id, 'events_' || event_type || '.jsonl' AS source_file, CAST(CAST(ts AS DATE) AS VARCHAR) AS meeting_date,
                  'E' || CAST(event_id AS VARCHAR) AS case_number, event_type AS action,
                  CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) AS vote,
                  'u' || CAST(user_id AS VARCHAR) || ', k' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) AS ayes,
                  CASE WHEN event_type = 'error' THEN 'sys' ELSE '' END AS noes FROM events)
SELECT source_file, meeting_date, case_number, '' AS project_address, '' AS lot_number, '' AS assessor_block,
  '' AS project_descr, '' AS type_district, '' AS type_district_descr, action, '' AS action_name, vote, ayes, noes,
  '' AS absent, '' AS modifications, event_id, '' AS speakers,
  '{"case_number": "' || case_number || '", "project_address": "", "lot_number": "", "assessor_block": "", '
  || '"project_descr": "", "type_district": "", "type_district_descr": "", "speakers": "", "action": "' || action
  || '", "modifications": "", "ayes": "' || ayes || '", "noes": "' || noes || '", "absent": "", "vote": "' || vote
  || '", "action_name": ""}' AS record_json
FROM e
""")
def ensure_and_order(spark: SparkSession, sf: str) -> DataFrame:
    """P20 + P21 + P22 + P7 + X14: flatten the nested object, join list
    fields with ', ', backfill the required keys, put known columns first and
    serialise the record as one-line JSON."""
    r = _event_records(spark, sf)
    flat = C.flatten_struct(r, "extracted")
    flat = C.join_lists(flat, P.JOINED_LIST_KEYS)
    flat = C.ensure_fields(flat, P.REQUIRED_KEYS, [])
    ordered = C.order_columns(flat, P.FLAT_ORDER)
    return ordered.withColumn("record_json", R.dump_json(ordered, P.REQUIRED_KEYS))


@query("api_matrix", sql="""
SELECT lower(r.r_name) AS region, CAST(n.n_nationkey AS DOUBLE) AS n_nationkey, n.n_name,
  CAST(CASE WHEN n.n_nationkey % 4 = 0 THEN NULL ELSE n.n_nationkey * 1.5 END AS DOUBLE) AS score
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def api_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """S8 + P12: an API-style JSON matrix per region (row 0 = header, text
    cells, 'n/a' for missing) is parsed back into rows and coerced to numbers.
    A region holds at most its nations (fixed, 25 in all), so the per-region
    payload is bounded."""
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.lower("r_name").alias("region"))
    cells = F.array(F.col("n_nationkey").cast("string"), F.col("n_name"),
                    F.when(F.col("n_nationkey") % 4 == 0, F.lit("n/a"))
                    .otherwise((F.col("n_nationkey") * 1.5).cast("string")))
    rows = n.join(M.bounded_broadcast(r), "n_regionkey").groupBy("region").agg(
        F.sort_array(F.collect_list(F.struct(F.col("n_nationkey").alias("k"), cells.alias("c")))).alias("rs"))
    payload = rows.select("region", F.to_json(F.concat(
        F.array(F.array(F.lit("n_nationkey"), F.lit("n_name"), F.lit("score"))),
        F.transform("rs", lambda x: x["c"]))).alias("payload"))
    t = matrix_json_to_rows(payload, "payload", ["region"])
    t = t.select("region", *[F.col("row")[k].alias(k) for k in ("n_nationkey", "n_name", "score")])
    return C.to_number(t, ["n_nationkey", "score"])
