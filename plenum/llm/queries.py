"""``opN_*``: each operator with production parameters over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import table
from . import (chunk_dedup, cotrain, decontaminate, language_id, merkle, phrase_dedup, piece_table, quote_threads, reshard, toxicity,
               turn_trie, vector_lsh, weighted_minhash)
from .common import id_crc
from .registry import query

#: Folder of the public vocabulary files (a parameter of the deployment).
TOKENIZERS = os.environ.get("PLENUM_TOKENIZERS", "/opt/tokenizers")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    return os.path.join(TOKENIZERS, name)


@query("op1_exact_dedup", sql=r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS k FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY k) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(k) AS text_sha256
FROM d WINDOW w AS (PARTITION BY k ORDER BY n DESC, doc_id)
""")
def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Exact groups by verified chunk recipes."""
    return chunk_dedup.exact_groups(table(spark, sf, "documents")).drop("n_chunks")


@query("op3_decontaminate", sql=r"""
WITH dw AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text,
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
il AS (SELECT item_id, w, least(13, len(w)) AS n FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, w[p:p + n - 1] AS x
        FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM il)),
dp AS (SELECT rid, n, p, w[p:p + n - 1] AS x FROM
       (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hits AS (SELECT rid, item_id, p, n FROM dp JOIN win USING (n, x)),
words AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hits) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
""")
def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark windows in documents by a prefix-filtered set join."""
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")) \
        .drop("spans", "items")


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Clause-level toxicity; labels of held-out ids are not looked at."""
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", (F.pmod(id_crc(F.col("doc_id")), F.lit(5)) == 0).alias("held_out"), "score", "predicted")


@query("op7_near_dedup")
def op7_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate classes by weighted sampling and verified similarity."""
    return weighted_minhash.near_duplicates(table(spark, sf, "documents"))


@query("op8_piece_table")
def op8_piece_table(spark: SparkSession, sf: str) -> DataFrame:
    """SentencePiece ids and their decoding through tables of distinct words."""
    return piece_table.encode_documents(table(spark, sf, "documents"), piece_table.read_model(model_path()), keep_ids=False)


@query("op2_byte_cnn")
def op2_byte_cnn(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every whole text; held-out ids are not trained on."""
    docs = table(spark, sf, "documents")
    held = F.pmod(id_crc(F.col("doc_id")), F.lit(3)) == 1
    return language_id.predict(docs, language_id.fit(docs)).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query("op5_flow_reshard")
def op5_flow_reshard(spark: SparkSession, sf: str) -> DataFrame:
    """From 16 shards by source (one of them hot) to 24 of equal bytes."""
    docs = table(spark, sf, "documents")
    return reshard.reshard(docs, F.xxhash64(F.coalesce("source", F.lit(""))), 16, 24)


@query("op9_cotrain_quality")
def op9_cotrain_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document from two co-trained views; labels of held-out
    ids (crc32 mod 5 is 0) are not looked at."""
    docs = table(spark, sf, "documents")
    model = cotrain.fit(docs, table(spark, sf, "labels"))
    return cotrain.score_documents(docs, model).select(
        "doc_id", (F.pmod(id_crc(F.col("doc_id")), F.lit(5)) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "content_score", "metadata_score")


@query("op10_quote_threads", sql=r"""
WITH RECURSIVE c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT conv_id, turn, max(text) AS t FROM c GROUP BY ALL),
m AS (SELECT c.conv_id, c.turn, c.role, concat(
        CASE WHEN c.turn % 2 = 0 AND p2.t IS NOT NULL THEN '> > ' || replace(p2.t, chr(10), chr(10) || '> > ') || chr(10) ELSE '' END,
        CASE WHEN p1.t IS NOT NULL THEN '> ' || replace(p1.t, chr(10), chr(10) || '> ') || chr(10) ELSE '' END, c.text) AS text
      FROM c LEFT JOIN p p1 ON p1.conv_id = c.conv_id AND p1.turn = c.turn - 1
             LEFT JOIN p p2 ON p2.conv_id = c.conv_id AND p2.turn = c.turn - 2),
l AS (SELECT row_number() OVER () AS rid, * FROM m),
ln AS (SELECT rid, conv_id, turn, i, len(regexp_replace(regexp_extract(s, '^((?:[ \t]*>)*)[ \t]?(.*)$', 1), '[^>]', '', 'g')) AS level,
              regexp_extract(s, '^((?:[ \t]*>)*)[ \t]?(.*)$', 2) AS content
       FROM (SELECT rid, conv_id, turn, unnest(string_split(text, chr(10))) AS s,
                    generate_subscripts(string_split(text, chr(10)), 1) AS i FROM l)),
g AS (SELECT *, i - row_number() OVER (PARTITION BY rid, level ORDER BY i) AS grp FROM ln),
pas AS (SELECT rid, conv_id, turn, level, min(i) AS i, string_agg(content, chr(10) ORDER BY i) AS content
        FROM g GROUP BY rid, conv_id, turn, level, grp),
body AS (SELECT l.rid, trim(regexp_replace(coalesce(string_agg(content, chr(10) ORDER BY i), ''), '^\s+|\s+$', '', 'g')) AS content
         FROM l LEFT JOIN pas ON pas.rid = l.rid AND level = 0 GROUP BY l.rid),
own AS (SELECT conv_id, turn, content FROM pas WHERE level = 0
        UNION ALL SELECT conv_id, turn, content FROM l JOIN body USING (rid)
        UNION ALL SELECT conv_id, turn, unnest(string_split_regex(content, '\n[ \t]*\n')) FROM pas WHERE level = 0
        UNION ALL SELECT conv_id, turn, content FROM ln WHERE level = 0),
o AS (SELECT DISTINCT conv_id, trim(regexp_replace(lower(content), '[^\p{L}\p{N}]+', ' ', 'g')) AS h, turn AS origin FROM own),
q AS (SELECT rid, conv_id, turn, level, trim(regexp_replace(lower(content), '[^\p{L}\p{N}]+', ' ', 'g')) AS h
      FROM pas WHERE level > 0 AND trim(regexp_replace(lower(content), '[^\p{L}\p{N}]+', ' ', 'g')) <> ''),
k AS (SELECT conv_id, turn, level, h, max(origin) AS origin FROM q JOIN o USING (conv_id, h) WHERE origin < turn GROUP BY ALL),
par AS (SELECT conv_id, turn, max_by(origin, [-level, origin]) AS reply_to, count(*) AS n_linked FROM k GROUP BY ALL),
up AS (SELECT conv_id, turn, reply_to AS anc, 1 AS depth FROM par
       UNION ALL SELECT up.conv_id, up.turn, par.reply_to, depth + 1 FROM up JOIN par ON par.conv_id = up.conv_id AND par.turn = up.anc),
tops AS (SELECT conv_id, turn, max(depth) AS depth, min(anc) AS root FROM up GROUP BY ALL),
nq AS (SELECT rid, count(*) AS n FROM q GROUP BY rid)
SELECT l.conv_id, l.turn, l.role, reply_to, coalesce(root, l.turn) AS root_turn,
       CAST(coalesce(depth, 0) AS BIGINT) AS reply_depth, CAST(coalesce(nq.n, 0) AS BIGINT) AS n_quotes,
       CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked, body.content
FROM l JOIN body USING (rid) LEFT JOIN par ON par.conv_id = l.conv_id AND par.turn = l.turn
       LEFT JOIN tops ON tops.conv_id = l.conv_id AND tops.turn = l.turn LEFT JOIN nq ON nq.rid = l.rid
""")
def op10_quote_threads(spark: SparkSession, sf: str) -> DataFrame:
    """The conversations as quoted mail, threaded back by their quotations."""
    return quote_threads.thread(quote_threads.mail_replies(table(spark, sf, "conversations")))


@query("op6_phrase_dedup")
def op6_phrase_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """50-byte strings that start in a smaller document, by prefix-free phrases."""
    return phrase_dedup.remove_repeats(table(spark, sf, "documents"), keep_bytes=False)


def _crc32(text: str) -> str:
    """DuckDB expression of the unsigned crc32 of an ASCII text."""
    return (f"xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length({text}) + 1), lambda i: "
            f"list_concat([CAST(ascii({text}[i]) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1])))), "
            "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)")


@query("op11_turn_trie", sql=rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT *, md5(strlen(role) || ':' || role || text) AS k FROM t),
o AS (SELECT conv_id, k, length(text) AS len,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 32), k) - 1 AS pos FROM k),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32('CAST(conv_id AS VARCHAR)')} % 6 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, o.k, o.len, o.pos FROM c JOIN o ON o.conv_id = c.base WHERE o.pos < c.h
      UNION ALL SELECT c.conv_id, o.k, o.len, o.pos + 6 FROM c JOIN o USING (conv_id) WHERE o.pos >= c.h),
s AS (SELECT c.conv_id, coalesce(list(r.k ORDER BY r.pos) FILTER (r.k IS NOT NULL), []) AS ks,
             coalesce(list(r.len ORDER BY r.pos) FILTER (r.k IS NOT NULL), []) AS ls FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, d, ks[1:d] AS prefix, CASE WHEN d = 0 THEN 0 ELSE ls[d] END AS len, d = len(ks) AS ended
      FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM s)),
n AS (SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(len) AS len,
             coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '') AS ids FROM p GROUP BY prefix, d),
kids AS (SELECT prefix[1:d - 1] AS prefix, count(*) AS n FROM n WHERE d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(kids.n, 0) AS n_children FROM n LEFT JOIN kids USING (prefix)),
sub AS (SELECT prefix[1:a] AS prefix, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves, sum((n_convs - 1) * len) AS saved
        FROM (SELECT prefix, n_children, n_convs, len, unnest(range(0, d + 1)) AS a FROM m) GROUP BY 1)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, m.n_convs, CAST(m.n_children AS BIGINT) AS n_children,
       CAST(sub.n_leaves AS BIGINT) AS n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(m.ids) AS ends_sha256
FROM m JOIN sub USING (prefix) LEFT JOIN n up ON m.d > 0 AND up.prefix = m.prefix[1:m.d - 1]
""")
def op11_turn_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    return turn_trie.prefix_nodes(table(spark, sf, "conversations"))


def _leaf(text: str) -> str:
    def part(column: str) -> str:
        return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"

    return "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


@query("op12_merkle", sql=rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS grp, {_leaf('text')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0
              THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, other NULLS FIRST) - 1 AS pos FROM d),
up AS (SELECT grp, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY grp) AS n FROM l
       UNION ALL SELECT grp, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 7) // 8
       FROM up WHERE n > 1 GROUP BY grp, level, pos // 8),
sub AS (SELECT grp, digest AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS level, pos, subroot AS digest, n FROM sub
        UNION ALL SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 7) // 8
        FROM top WHERE n > 1 GROUP BY level, pos // 8),
root AS (SELECT digest AS root FROM top WHERE n = 1),
kin AS (SELECT grp, level, pos, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
               coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
        FROM up WHERE n > 1 WINDOW w AS (PARTITION BY grp, level, pos // 8 ORDER BY pos)),
topkin AS (SELECT level, pos, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
               coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
        FROM top WHERE n > 1 WINDOW w AS (PARTITION BY level, pos // 8 ORDER BY pos)),
path AS (SELECT l.rid, kin.level, kin.lft, kin.rgt FROM l JOIN kin ON kin.grp = l.grp AND kin.pos = l.pos // CAST(pow(8, kin.level) AS BIGINT)
         UNION ALL SELECT l.rid, 100 + topkin.level, topkin.lft, topkin.rgt FROM l JOIN sub USING (grp)
         JOIN topkin ON topkin.pos = sub.pos // CAST(pow(8, topkin.level) AS BIGINT)),
step AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY level) AS i FROM path),
folds AS (SELECT rid, 1 AS i, coalesce(other, leaf) AS digest FROM l
          UNION ALL SELECT f.rid, f.i + 1, sha256(s.lft || f.digest || s.rgt) FROM folds f JOIN step s ON s.rid = f.rid AND s.i = f.i),
done AS (SELECT rid, max_by(digest, i) AS folded_root FROM folds GROUP BY rid),
proof AS (SELECT rid, sha256(string_agg(lft || rgt, '' ORDER BY i)) AS proof_sha256 FROM step GROUP BY rid)
SELECT l.doc_id, l.leaf, sub.subroot, root.root, coalesce(proof.proof_sha256, sha256('')) AS proof_sha256, done.folded_root,
       done.folded_root = root.root AS verified
FROM l JOIN sub USING (grp) JOIN done USING (rid) LEFT JOIN proof USING (rid), root
""")
def op12_merkle(spark: SparkSession, sf: str) -> DataFrame:
    """Merkle manifest per language with a tamper check of every document."""
    return merkle.manifest(table(spark, sf, "documents"))


@query("op13_vector_lsh", sql=r"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT rid, vec_id, list_transform(e, lambda x: x / list_max(list_transform(e, lambda y: abs(y)))) AS e FROM v
       WHERE vec_id IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.rid AS a, b.rid AS b FROM ok a JOIN ok b ON a.rid < b.rid AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
both AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rid, rid AS seen FROM v UNION SELECT r.rid, k.b FROM reach r JOIN both k ON k.a = r.seen),
comp AS (SELECT r.rid, min(v.vec_id) AS component_id FROM reach r JOIN v ON v.rid = r.seen GROUP BY r.rid),
n AS (SELECT a AS rid, count(*) AS n FROM both GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, coalesce(v.vec_id = component_id, true) AS kept
FROM v JOIN comp USING (rid) LEFT JOIN n USING (rid)
""")
def op13_vector_lsh(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate embeddings: p-stable hashing, exact cosines."""
    return vector_lsh.near_vectors(table(spark, sf, "embeddings"))
