"""Family C — meeting minutes -> blocks -> records, on a minutes text that
Spark derives from the driver tables.

The driver's ``documents`` contain no case headers, numbered items or
month-name dates, so the minutes are derived: one document per order row, a
header (weekday date, meeting type, location, attendance) and one to four
project blocks, all from that row's own columns. Even orders use case-code
headers (``98.000011AF – ...``), odd orders numbered items in the modern format
(``1. 1998-000011AF (STAFF)``), so every splitting mode is exercised. The
same text is built in SQL for the oracle (``MINUTES_CTE``).

Scale: the text is a projection of one scan, so there is no group, join or
shuffle whose size could depend on a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import scalar as X
from ..operators import aggregate as A
from ..operators import documents as D
from ..operators import labels as L
from ..operators import records as R
from ..session import cut_lineage
from ..sources.readers import lenient_utf8, spread, table
from .registry import query

# FIXED VALUES: invented commissioner names and street kinds used to derive
# the minutes text (the oracle SQL spells out the same lists).
NAMES = ["Alder", "Birch", "Cedar", "Dogwood", "Elm", "Fir", "Ginkgo", "Hazel", "Ivy", "Juniper", "Kapok", "Larch"]
KINDS = ["STREET", "AVENUE", "BOULEVARD", "PLACE", "ROAD", "DRIVE"]

_SQL_NAMES = "['" + "','".join(NAMES) + "']"
_SQL_KINDS = "['" + "','".join(KINDS) + "']"


def _name(i: Column, names: list[str] = NAMES) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (F.pmod(i, F.lit(len(names))) + 1).cast("int"))


CAPITALS = [n.upper() for n in NAMES]


def _kind(i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in KINDS]), (F.pmod(i, F.lit(len(KINDS))) + 1).cast("int"))


def _s(c: Column) -> Column:
    return c.cast("string")


def _block(x, ok: Column, odate: Column) -> Column:
    """Text of one project block; ``x[name]`` gives a line-item column."""
    ln, pk, sk = x["l_linenumber"].cast("bigint"), x["l_partkey"], x["l_suppkey"]
    yr = F.year(odate)
    yy2 = F.lpad(_s(yr % 100), 2, "0")
    digits = F.lpad(_s(ok * 10 + ln), 6, "0")
    suffix = F.concat(x["l_returnflag"], x["l_linestatus"])
    dotted = F.concat(F.when(ln % 2 == 0, _s(yr)).otherwise(yy2), F.lit("."), digits, suffix)
    sep = F.when(x["l_linestatus"] == "F", F.lit(" – ")).otherwise(F.lit(": "))
    title = F.concat(F.lit("PROJECT "), _s(pk))
    address = F.concat_ws(" ", _s(100 + pk % 900), _name(sk, CAPITALS), _kind(pk))
    speakers = F.concat(F.when(x["l_quantity"] % 5 == 0, F.lit("+\n")).otherwise(F.lit("+ ")), _name(pk), F.lit("\n- "), _name(sk),
                        F.when(x["l_quantity"] > 25, F.concat(F.lit("\n= "), _name(pk + sk))).otherwise(F.lit("")))
    sd = x["l_shipdate"]
    action = (F.when(x["l_returnflag"] == "A", F.lit("Approved"))
              .when(x["l_returnflag"] == "R", F.lit("Disapproved"))
              .otherwise(F.concat(F.lit("Continued to "), F.date_format(sd, "MMMM"), F.lit(" "),
                                  _s(F.dayofmonth(sd)), F.lit(", "), _s(F.year(sd)))))
    ayes = F.concat_ws(", ", _name(ok + ln), _name(ok + ln + 1), _name(ok + ln + 2))
    nays = F.when(x["l_discount"] >= 5, _name(ok + ln + 3)).otherwise(F.lit("None"))
    gone = F.when((ok + ln) % 4 < 2, F.concat(F.lit("\nABSENT: "), _name(ok + ln + 5))).otherwise(F.lit(""))
    even = F.concat(dotted, sep, title, F.lit("\n"), address, F.lit("\nSPEAKERS:\n"), speakers,
                    F.lit("\nACTION: "), action, F.lit("\nAYES: "), ayes, F.lit("\nNAYS: "), nays, gone)
    staff = F.when((ok + ln) % 11 == 0, F.lit("")).otherwise(F.concat(F.lit(" ("), _name(ok, CAPITALS), F.lit(")")))
    odd = F.concat(_s(ln), F.lit(". "), _s(yr), F.lit("-"), digits, suffix, staff, F.lit("\n"), title, F.lit("\n"), address, F.lit("\nSPEAKERS:\n"), speakers,
                   F.lit("\nACTION:\n"), action, F.lit("\nAYES: "), ayes, F.lit("\nNAYS: "), nays, gone,
                   F.lit("\nMOTION: "), _s(ok * 10 + ln))
    return F.when(ok % 2 == 0, even).otherwise(odd)


def _header(ok: Column, ck: Column, odate: Column, prio: Column, status: Column) -> Column:
    d = odate
    date_line = F.concat(F.date_format(d, "EEEE"), F.when(ok % 5 == 0, F.lit(" ")).otherwise(F.lit(", ")),
                         F.date_format(d, "MMMM"), F.when(ok % 7 == 0, F.lit("\u00a0 ")).otherwise(F.lit(" ")),
                         _s(F.dayofmonth(d)),
                         F.when(prio == "4-NOT SPECIFIED", F.lit(" ")).otherwise(F.lit(", ")), _s(F.year(d)))
    mtype = (F.when(prio == "1-URGENT", F.lit("Special Meeting"))
             .when(prio == "2-HIGH", F.lit("Joint Meeting")).otherwise(F.lit("Regular Meeting")))
    loc = (F.when(status == "F", F.concat(F.lit("CITY HALL, ROOM "), _s(400 + ck % 10)))
           .when(status == "O", F.lit("City Hall, Room 400")).otherwise(F.lit("COMMISSION CHAMBERS")))
    present = F.concat_ws(", ", _name(ck), _name(ck + 1), _name(ck + 2))
    absent = F.when(ok % 3 == 0, F.lit("None")).otherwise(_name(ck + 5))
    staff = F.concat_ws(", ", _name(ok + 7), _name(ok + 9))
    return F.concat_ws("\n", date_line, F.lit("CITY PLANNING COMMISSION"), mtype, loc,
                       F.concat(F.lit("PRESENT: "), present), F.concat(F.lit("ABSENT: "), absent),
                       F.concat(F.lit("STAFF IN ATTENDANCE: "), staff))


MAX_BLOCKS = 4


def _line(i, ok: Column, ck: Column, od: Column) -> dict[str, Column]:
    """The fields of an order's block ``i``, from the order's own columns."""
    return {"l_linenumber": (F.lit(i) if isinstance(i, int) else i).cast("bigint"), "l_partkey": ck + i, "l_suppkey": ok + 3 * i,
            "l_quantity": (ok + 7 * i) % 50, "l_discount": (ok + i) % 10,
            "l_returnflag": F.when((ck + i) % 3 == 0, F.lit("A")).when((ck + i) % 3 == 1, F.lit("R")).otherwise(F.lit("N")),
            "l_linestatus": F.when((ck + i) % 2 == 0, F.lit("F")).otherwise(F.lit("O")),
            "l_shipdate": F.date_add(od, 30 * i if isinstance(i, int) else (30 * i).cast("int"))}


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")


def minutes(spark: SparkSession, sf: str, orders: DataFrame | None = None) -> DataFrame:
    """Minutes documents: (o_orderkey, year, source_file, text), one per order
    row; a customer's number decides whether it has one, two, three or four
    blocks. A projection of the given orders (those of ``sf``): no shuffle."""
    o = _orders(spark, sf) if orders is None else orders
    ok, ck, od = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    # One expression for every block: four in a row make a method that the JVM's compiler leaves alone for its length.
    numbers = F.when(ck % MAX_BLOCKS >= 0, F.sequence(F.lit(1).cast("bigint"), ck % MAX_BLOCKS + 1)).otherwise(F.array().cast("array<bigint>"))
    blocks = F.transform(numbers, lambda i: _block(_line(i, ok, ck, od), ok, od))
    head = _header(ok, ck, od, F.col("o_orderpriority"), F.col("o_orderstatus"))
    return o.select("o_orderkey", _s(F.year(od)).alias("year"),
                    F.concat(F.lit("minutes_"), _s(ok), F.lit(".txt")).alias("source_file"),
                    F.concat(head, F.lit("\n\n"), F.array_join(blocks, "\n")).alias("text"))


def spread_minutes(spark: SparkSession, sf: str) -> DataFrame:
    """The minutes, the narrow order rows dealt out first where the scan has fewer partitions than there are cores."""
    return minutes(spark, sf, spread(_orders(spark, sf)))


MINUTES_CTE = f"""
order_lines AS (
  SELECT o_orderkey AS l_orderkey, ln AS l_linenumber, o_custkey + ln AS l_partkey, o_orderkey + 3 * ln AS l_suppkey,
    (o_orderkey + 7 * ln) % 50 AS l_quantity, (o_orderkey + ln) % 10 AS l_discount,
    ['A', 'R', 'N'][(o_custkey + ln) % 3 + 1] AS l_returnflag,
    CASE WHEN (o_custkey + ln) % 2 = 0 THEN 'F' ELSE 'O' END AS l_linestatus,
    o_orderdate + to_days(CAST(30 * ln AS INTEGER)) AS l_shipdate
  FROM (SELECT *, unnest(range(1, CAST(o_custkey % 4 + 2 AS BIGINT))) AS ln FROM orders)),
mlines AS (
  SELECT l.l_orderkey AS o_orderkey, l.l_linenumber AS ln, l.l_partkey AS s1, l.l_suppkey AS s2, l.l_quantity AS s3,
    l.l_discount AS s4, l.l_returnflag AS s5, l.l_linestatus AS s6, l.l_shipdate AS s7,
    CASE WHEN o.o_orderkey % 2 = 0 THEN
      (CASE WHEN l.l_linenumber % 2 = 0 THEN CAST(year(o.o_orderdate) AS VARCHAR)
            ELSE lpad(CAST(year(o.o_orderdate) % 100 AS VARCHAR), 2, '0') END)
      || '.' || lpad(CAST(o.o_orderkey * 10 + l.l_linenumber AS VARCHAR), 6, '0') || l.l_returnflag || l.l_linestatus
      || CASE WHEN l.l_linestatus = 'F' THEN ' – ' ELSE ': ' END
      || 'PROJECT ' || CAST(l.l_partkey AS VARCHAR) || chr(10)
      || CAST(100 + l.l_partkey % 900 AS VARCHAR) || ' ' || upper({_SQL_NAMES}[l.l_suppkey % 12 + 1]) || ' ' || {_SQL_KINDS}[l.l_partkey % 6 + 1]
      || chr(10) || 'SPEAKERS:' || chr(10) || CASE WHEN l.l_quantity % 5 = 0 THEN '+' || chr(10) ELSE '+ ' END || {_SQL_NAMES}[l.l_partkey % 12 + 1] || chr(10) || '- ' || {_SQL_NAMES}[l.l_suppkey % 12 + 1]
      || CASE WHEN l.l_quantity > 25 THEN chr(10) || '= ' || {_SQL_NAMES}[(l.l_partkey + l.l_suppkey) % 12 + 1] ELSE '' END
      || chr(10) || 'ACTION: '
      || CASE l.l_returnflag WHEN 'A' THEN 'Approved' WHEN 'R' THEN 'Disapproved'
           ELSE 'Continued to ' || monthname(l.l_shipdate) || ' ' || CAST(day(l.l_shipdate) AS VARCHAR) || ', ' || CAST(year(l.l_shipdate) AS VARCHAR) END
      || chr(10) || 'AYES: ' || {_SQL_NAMES}[(o.o_orderkey + l.l_linenumber) % 12 + 1] || ', ' || {_SQL_NAMES}[(o.o_orderkey + l.l_linenumber + 1) % 12 + 1]
      || ', ' || {_SQL_NAMES}[(o.o_orderkey + l.l_linenumber + 2) % 12 + 1]
      || chr(10) || 'NAYS: ' || CASE WHEN l.l_discount >= 5 THEN {_SQL_NAMES}[(o.o_orderkey + l.l_linenumber + 3) % 12 + 1] ELSE 'None' END
      || CASE WHEN (o.o_orderkey + l.l_linenumber) % 4 < 2 THEN chr(10) || 'ABSENT: ' || {_SQL_NAMES}[(o.o_orderkey + l.l_linenumber + 5) % 12 + 1] ELSE '' END
    ELSE
      CAST(l.l_linenumber AS VARCHAR) || '. ' || CAST(year(o.o_orderdate) AS VARCHAR) || '-'
      || lpad(CAST(o.o_orderkey * 10 + l.l_linenumber AS VARCHAR), 6, '0') || l.l_returnflag || l.l_linestatus
      || CASE WHEN (o.o_orderkey + l.l_linenumber) % 11 = 0 THEN '' ELSE ' (' || upper({_SQL_NAMES}[o.o_orderkey % 12 + 1]) || ')' END || chr(10)
      || 'PROJECT ' || CAST(l.l_partkey AS VARCHAR) || chr(10)
      || CAST(100 + l.l_partkey % 900 AS VARCHAR) || ' ' || upper({_SQL_NAMES}[l.l_suppkey % 12 + 1]) || ' ' || {_SQL_KINDS}[l.l_partkey % 6 + 1]
      || chr(10) || 'SPEAKERS:' || chr(10) || CASE WHEN l.l_quantity % 5 = 0 THEN '+' || chr(10) ELSE '+ ' END || {_SQL_NAMES}[l.l_partkey % 12 + 1] || chr(10) || '- ' || {_SQL_NAMES}[l.l_suppkey % 12 + 1]
      || CASE WHEN l.l_quantity > 25 THEN chr(10) || '= ' || {_SQL_NAMES}[(l.l_partkey + l.l_suppkey) % 12 + 1] ELSE '' END
      || chr(10) || 'ACTION:' || chr(10)
      || CASE l.l_returnflag WHEN 'A' THEN 'Approved' WHEN 'R' THEN 'Disapproved'
           ELSE 'Continued to ' || monthname(l.l_shipdate) || ' ' || CAST(day(l.l_shipdate) AS VARCHAR) || ', ' || CAST(year(l.l_shipdate) AS VARCHAR) END
      || chr(10) || 'AYES: ' || {_SQL_NAMES}[(o.o_orderkey + l.l_linenumber) % 12 + 1] || ', ' || {_SQL_NAMES}[(o.o_orderkey + l.l_linenumber + 1) % 12 + 1]
      || ', ' || {_SQL_NAMES}[(o.o_orderkey + l.l_linenumber + 2) % 12 + 1]
      || chr(10) || 'NAYS: ' || CASE WHEN l.l_discount >= 5 THEN {_SQL_NAMES}[(o.o_orderkey + l.l_linenumber + 3) % 12 + 1] ELSE 'None' END
      || CASE WHEN (o.o_orderkey + l.l_linenumber) % 4 < 2 THEN chr(10) || 'ABSENT: ' || {_SQL_NAMES}[(o.o_orderkey + l.l_linenumber + 5) % 12 + 1] ELSE '' END
      || chr(10) || 'MOTION: ' || CAST(o.o_orderkey * 10 + l.l_linenumber AS VARCHAR)
    END AS block
  FROM order_lines l JOIN orders o ON l.l_orderkey = o.o_orderkey),
minutes AS (
  SELECT o.o_orderkey, CAST(year(o.o_orderdate) AS VARCHAR) AS year,
    'minutes_' || CAST(o.o_orderkey AS VARCHAR) || '.txt' AS source_file,
    dayname(o.o_orderdate) || CASE WHEN o.o_orderkey % 5 = 0 THEN ' ' ELSE ', ' END || monthname(o.o_orderdate)
      || CASE WHEN o.o_orderkey % 7 = 0 THEN chr(160) || ' ' ELSE ' ' END || CAST(day(o.o_orderdate) AS VARCHAR)
      || CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN ' ' ELSE ', ' END || CAST(year(o.o_orderdate) AS VARCHAR)
    || chr(10) || 'CITY PLANNING COMMISSION' || chr(10)
    || CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Special Meeting' WHEN '2-HIGH' THEN 'Joint Meeting' ELSE 'Regular Meeting' END
    || chr(10) || CASE o.o_orderstatus WHEN 'F' THEN 'CITY HALL, ROOM ' || CAST(400 + o.o_custkey % 10 AS VARCHAR)
                                     WHEN 'O' THEN 'City Hall, Room 400' ELSE 'COMMISSION CHAMBERS' END
    || chr(10) || 'PRESENT: ' || {_SQL_NAMES}[o.o_custkey % 12 + 1] || ', ' || {_SQL_NAMES}[(o.o_custkey + 1) % 12 + 1] || ', ' || {_SQL_NAMES}[(o.o_custkey + 2) % 12 + 1]
    || chr(10) || 'ABSENT: ' || CASE WHEN o.o_orderkey % 3 = 0 THEN 'None' ELSE {_SQL_NAMES}[(o.o_custkey + 5) % 12 + 1] END
    || chr(10) || 'STAFF IN ATTENDANCE: ' || {_SQL_NAMES}[(o.o_orderkey + 7) % 12 + 1] || ', ' || {_SQL_NAMES}[(o.o_orderkey + 9) % 12 + 1]
    || chr(10) || chr(10) || b.body AS text
  FROM orders o JOIN (SELECT o_orderkey, string_agg(block, chr(10) ORDER BY ln, s1, s2, s3, s4, s5, s6, s7) AS body
                     FROM mlines GROUP BY o_orderkey) b
    ON o.o_orderkey = b.o_orderkey)
"""

# RE2 spellings of the block boundaries (same patterns; DuckDB needs the
# replacement written as \\0 and a global flag).
_CASE_RE = P.CASE_HEADER_RE
_ITEM_RE = P.AGENDA_ITEM_RE


def _sql_pieces(text: str, pattern: str) -> str:
    return (f"list_filter(list_transform(string_split(regexp_replace({text}, '{pattern}', chr(1) || '\\0', 'g'), chr(1))[2:],"
            f" lambda p: regexp_replace(p, '^\\s+|\\s+$', '', 'g')), lambda p: p <> '')")


def _sql_blocks(text: str) -> str:
    case = _sql_pieces(text, _CASE_RE)
    item = _sql_pieces(text, _ITEM_RE)
    return (f"CASE WHEN len({case}) >= 2 THEN {case} WHEN regexp_matches({text}, '{_ITEM_RE}') THEN {item} "
            f"ELSE [regexp_replace({text}, '^\\s+|\\s+$', '', 'g')] END")


def _sql_mode(text: str) -> str:
    case = _sql_pieces(text, _CASE_RE)
    return (f"CASE WHEN len({case}) >= 2 THEN 'case' WHEN regexp_matches({text}, '{_ITEM_RE}') THEN 'item' "
            f"ELSE 'whole' END")


def blocks_of(docs: DataFrame, keys) -> DataFrame:
    """D6 + W3: one row per block with its ordinal and the splitting mode."""
    return D.explode_block_rows(docs, keys)


BLOCKS_SQL = f"""
blocks AS (
  SELECT o_orderkey, year, source_file, mode, CAST(pos AS BIGINT) AS pos, blocks[pos] AS block
  FROM (SELECT o_orderkey, year, source_file, {_sql_mode('text')} AS mode, {_sql_blocks('text')} AS blocks FROM minutes) s,
       range(1, len(blocks) + 1) r(pos))
"""


@query("split_blocks", sql=f"""
WITH {MINUTES_CTE}, {BLOCKS_SQL}
SELECT o_orderkey, mode, pos, block FROM blocks
""")
def split_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """D6 + W2/W3: minutes -> project blocks (case headers, else numbered
    items, else the whole text) with their ordinal."""
    b = blocks_of(spread_minutes(spark, sf), ["o_orderkey"])
    return b.select("o_orderkey", "mode", F.col("pos").cast("bigint").alias("pos"), "block")


@query("split_documents", sql=f"""
SELECT doc_id, {_sql_mode('text')} AS mode, CAST(len({_sql_blocks('text')}) AS BIGINT) AS n_blocks,
       CAST(length(({_sql_blocks('text')})[1]) AS BIGINT) AS first_block_chars
FROM documents
""")
def split_documents(spark: SparkSession, sf: str) -> DataFrame:
    """D6 on the driver documents (whole texts)."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    b = D.with_blocks(d)
    return b.select("doc_id", "mode", F.size("blocks").cast("bigint").alias("n_blocks"),
                    F.length(F.get("blocks", 0)).cast("bigint").alias("first_block_chars"))


def _sql_tag(blocks: str) -> str:
    return (f"array_to_string(list_transform({blocks}, lambda b: '{P.PROJECT_START}' || chr(10) || regexp_replace(b, '\\s+$', '', 'g')"
            f" || chr(10) || '{P.PROJECT_END}'), chr(10))")


def _sql_untag(tagged: str) -> str:
    return (f"list_transform(regexp_extract_all({tagged}, '(?s)<<Project Start>>(.*?)<<Project End>>', 1),"
            f" lambda b: regexp_replace(b, '^\\s+|\\s+$', '', 'g'))")


@query("tag_untag", sql=f"""
WITH {MINUTES_CTE},
t AS (SELECT o_orderkey, {_sql_blocks('text')} AS blocks FROM minutes),
g AS (SELECT o_orderkey, blocks, {_sql_tag('blocks')} AS tagged FROM t)
SELECT o_orderkey, CAST(len(blocks) AS BIGINT) AS n_blocks, CAST(length(tagged) AS BIGINT) AS tagged_chars,
       md5(tagged) AS tagged_md5, {_sql_untag('tagged')} = blocks AS roundtrip
FROM g
""")
def tag_untag(spark: SparkSession, sf: str) -> DataFrame:
    """D7 + D8: blocks wrapped in start/end tags, then extracted again; the
    round trip is the identity on non-blank blocks."""
    m = D.with_blocks(spread_minutes(spark, sf).select("o_orderkey", "text"), mode=None) \
        .select("o_orderkey", "blocks")
    g = m.withColumn("tagged", D.tag_blocks("blocks"))
    return g.select("o_orderkey", F.size("blocks").cast("bigint").alias("n_blocks"),
                    F.length("tagged").cast("bigint").alias("tagged_chars"), F.md5("tagged").alias("tagged_md5"),
                    (D.untag_blocks("tagged") == F.col("blocks")).alias("roundtrip"))


def _sql_squash(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"


def _sql_long_date(x: str) -> str:
    return f"try_strptime(regexp_replace({x}, '[\\s\\p{{Z}}]+', ' ', 'g'), '%B %d, %Y')"


def _sql_weekday_date(x: str) -> str:
    found = f"regexp_extract({x}, '{P.HEADER_DATE_RE}', 0)"
    return (f"CASE WHEN regexp_matches({found}, '^[A-Za-z]+,[\\s\\p{{Z}}]') THEN "
            + _sql_long_date(f"regexp_extract({x}, '{P.HEADER_DATE_RE}', 2)") + " END")


@query("meeting_header", sql=f"""
WITH {MINUTES_CTE},
h AS (SELECT o_orderkey, year, text,
  regexp_extract(text, '{P.DATE_RE}', 1) AS date,
  regexp_extract(text, '{P.DAY_RE}', 1) AS day_of_week,
  regexp_extract(text, '{P.MEET_TYPE_RE}', 1) AS meeting_type,
  coalesce(list_filter(string_split(text, chr(10))[1:20],
      lambda l: l = upper(l) AND regexp_matches(l, '[A-Z]') AND regexp_matches(l, 'ROOM|HALL|BUILDING'))[1], '') AS location,
  {_sql_squash(f"regexp_extract(text, '{P.PRESENT_RE}', 1)")} AS present,
  {_sql_squash(f"regexp_extract(text, '{P.ABSENT_RE}', 1)")} AS absent,
  {_sql_squash(f"regexp_extract(text, '{P.STAFF_RE}', 1)")} AS staff,
  {_sql_weekday_date('text')} AS wd_date
  FROM minutes)
SELECT o_orderkey, date, day_of_week, meeting_type, location, present, absent, staff,
  CAST(CAST(wd_date AS DATE) AS VARCHAR) AS meeting_date,
  coalesce(nullif(replace(replace(replace(date, ',', ''), '/', '-'), ' ', '_'), ''), year || '_minutes_' || CAST(o_orderkey AS VARCHAR)) AS file_key
FROM h
""")
def meeting_header(spark: SparkSession, sf: str) -> DataFrame:
    """D9 + X10 + X17 + X26 + X28: header fields of each minutes document,
    the weekday-prefixed meeting date and the file key."""
    m = spread_minutes(spark, sf)
    h = m.select("o_orderkey", "year", D.meeting_header("text").alias("h"),
                 X.parse_weekday_date("text").cast("string").alias("meeting_date"))
    return h.select("o_orderkey", "h.*", "meeting_date",
                    X.file_key("h.date", "year", F.lit("minutes"), "o_orderkey").alias("file_key"))


@query("date_strings", sql=f"""
WITH {MINUTES_CTE},
d AS (SELECT o_orderkey, unnest(list_distinct(regexp_extract_all(text, '{P.DATE_RE}', 1))) AS date_text FROM minutes)
SELECT o_orderkey, date_text, lower(strftime(CAST({_sql_long_date('date_text')} AS DATE), '%B-%d-%Y')) AS slug FROM d
""")
def date_strings(spark: SparkSession, sf: str) -> DataFrame:
    """D5 + X8 + X9: distinct month-name dates per document and their slugs."""
    m = spread_minutes(spark, sf)
    d = A.explode_nonempty(m, ["o_orderkey"], D.extract_dates("text"), ("date_text",), with_pos=False)
    return d.withColumn("slug", X.date_slug(X.parse_long_date("date_text")))


# The ways in which the pages write a named anchor, one a block.
ANCHOR_FORMS = [('<a name="', '"></a>'), ("<A NAME='", "'></A>"), ('<a class="z" name="', '">'), ('<a  id="q" name="', '" title="t"></a>')]


def _meeting_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Minutes wrapped as HTML pages: each block behind a named anchor
    ``<a name="m_d_yy"></a>`` (month, day, two-digit year of the line's ship
    date); pending orders get no anchors (single-meeting pages)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    ok, ck, od = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    pieces = []
    for i, (opened, closed) in enumerate(ANCHOR_FORMS, 1):
        sd = F.date_add(od, 30 * i)
        name = F.concat(_s(F.month(sd)), F.lit("_"), _s(F.dayofmonth(sd)), F.lit("_"), F.lpad(_s(F.year(sd) % 100), 2, "0"))
        mark = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.concat(F.lit(opened), name, F.lit(closed)))
        pieces.append(F.when(ck % MAX_BLOCKS >= i - 1, F.concat(mark, F.lit(f"<p>Item {i}</p>"))))
    return o.select("o_orderkey", F.concat(F.lit("<html><body><p>Preamble</p>"), F.concat_ws("", *pieces),
                                           F.lit("</body></html>")).alias("html"))


@query("split_meetings", sql="""
WITH lines AS (SELECT *, unnest(range(1, CAST(o_custkey % 4 + 2 AS BIGINT))) AS ln FROM orders),
named AS (SELECT *, CAST(month(sd) AS VARCHAR) || '_' || CAST(day(sd) AS VARCHAR) || '_' || lpad(CAST(year(sd) % 100 AS VARCHAR), 2, '0') AS a
          FROM (SELECT *, o_orderdate + to_days(CAST(30 * ln AS INTEGER)) AS sd FROM lines)),
pg AS (
  SELECT o_orderkey, '<html><body><p>Preamble</p>' || string_agg(
      CASE WHEN o_orderstatus = 'P' THEN '' WHEN ln = 1 THEN '<a name="' || a || '"></a>' WHEN ln = 2 THEN '<A NAME=' || chr(39) || a || chr(39) || '></A>'
           WHEN ln = 3 THEN '<a class="z" name="' || a || '">' ELSE '<a  id="q" name="' || a || '" title="t"></a>' END
      || '<p>Item ' || CAST(ln AS VARCHAR) || '</p>', '' ORDER BY ln) || '</body></html>' AS html
  FROM named GROUP BY o_orderkey),
parts AS (
  SELECT o_orderkey, html,
    string_split(regexp_replace(html, '(?i)<a\\s[^>]*?name=["''](\\d+_\\d{1,2}_\\d{2})["''][^>]*>(?:\\s*</a>)?', chr(1) || '\\1' || chr(2), 'g'), chr(1))[2:] AS ps
  FROM pg),
m AS (
  SELECT o_orderkey, CAST(pos AS BIGINT) AS meeting_pos,
    CASE WHEN len(ps) > 0 THEN split_part(ps[pos], chr(2), 1) ELSE 'single' END AS anchor,
    CASE WHEN len(ps) > 0 THEN split_part(ps[pos], chr(2), 2) ELSE html END AS mhtml
  FROM parts, range(1, greatest(len(ps), 1) + 1) r(pos))
SELECT o_orderkey, meeting_pos, anchor,
  CASE WHEN regexp_matches(anchor, '(\\d{1,2})_(\\d{1,2})_(\\d{2})')
    THEN lpad(regexp_extract(anchor, '(\\d{1,2})_(\\d{1,2})_(\\d{2})', 1), 2, '0') || '/' ||
         lpad(regexp_extract(anchor, '(\\d{1,2})_(\\d{1,2})_(\\d{2})', 2), 2, '0') || '/19' ||
         regexp_extract(anchor, '(\\d{1,2})_(\\d{1,2})_(\\d{2})', 3) ELSE '' END AS anchor_date,
  CAST(length(mhtml) AS BIGINT) AS html_chars
FROM m
""")
def split_meetings(spark: SparkSession, sf: str) -> DataFrame:
    """D4 + X27: pages cut into meetings at named anchors (a page without
    anchors is one meeting named 'single') and the anchor's fallback date."""
    pg = _meeting_pages(spark, sf)
    m = A.explode_nonempty(pg, ["o_orderkey"], D.split_meetings("html"), ("meeting_pos", "m"))
    return m.select("o_orderkey", (F.col("meeting_pos") + 1).cast("bigint").alias("meeting_pos"),
                    F.col("m.anchor").alias("anchor"), X.anchor_date("m.anchor").alias("anchor_date"),
                    F.length("m.html").cast("bigint").alias("html_chars"))


def _minutes_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(o_orderkey, year, slug, url, html): a page per order with one to four meetings, the i-th with blocks 1 to i, its
    header with or without a date line; pending orders have no anchors."""
    o = spread(_orders(spark, sf))
    ok, ck, od = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    o = o.select("*", *[F.replace(_block(_line(j, ok, ck, od), ok, od), F.lit("\n"), F.lit("<br/>")).alias(f"b{j}")
                        for j in range(1, MAX_BLOCKS + 1)])
    sections = []
    for i, (opened, closed) in enumerate(ANCHOR_FORMS, 1):
        sd = F.date_add(od, 30 * i)
        name = F.concat(_s(F.month(sd)), F.lit("_"), _s(F.dayofmonth(sd)), F.lit("_"), F.lpad(_s(F.year(sd) % 100), 2, "0"))
        mark = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.concat(F.lit(opened), name, F.lit(closed)))
        dated = F.when((ok + i) % 3 != 0, F.date_format(sd, "EEEE, MMMM d, yyyy"))
        head = F.concat_ws("<br>", dated, F.lit("<b>PLANNING</b> &amp; ZONING"), F.lit("Special Meeting" if i % 2 == 0 else "Regular Meeting"),
                           F.concat(F.lit("CITY HALL, ROOM "), _s(400 + ck % 10)),
                           F.concat(F.lit("PRESENT: "), _name(ck), F.lit(", "), _name(ck + i)), F.concat(F.lit("ABSENT: "), _name(ok + i)),
                           F.concat(F.lit("STAFF IN ATTENDANCE: "), _name(ok + 7)))
        blocks = F.concat_ws("<br>", *[f"b{j}" for j in range(1, i + 1)])
        sections.append(F.when(ck % MAX_BLOCKS >= i - 1, F.concat(mark, F.lit("<p>"), head, F.lit("</p><div>"), blocks, F.lit("</div>"))))
    return o.select("o_orderkey", _s(F.year(od)).alias("year"), F.concat(F.lit("page"), _s(ok)).alias("slug"),
                    F.concat(F.lit("http://minutes.example/"), _s(F.year(od)), F.lit("/page"), _s(ok), F.lit(".htm")).alias("url"),
                    F.concat(F.lit("<html><body><!-- <p>x</p> --><p>Preamble</p>"), F.concat_ws("", *sections),
                             F.lit("</body></html>")).alias("html"))


_SQL_ANCHOR = "(\\d{1,2})_(\\d{1,2})_(\\d{2})"


@query("meeting_files", sql=f"""
WITH {MINUTES_CTE},
sections AS (
  SELECT o.o_orderkey, o.o_orderdate, o.o_orderstatus, a.ln AS i, o.o_orderdate + to_days(CAST(30 * a.ln AS INTEGER)) AS sd,
    CASE WHEN (o.o_orderkey + a.ln) % 3 <> 0 THEN dayname(o.o_orderdate + to_days(CAST(30 * a.ln AS INTEGER))) || ', ' ||
      monthname(o.o_orderdate + to_days(CAST(30 * a.ln AS INTEGER))) || ' ' || CAST(day(o.o_orderdate + to_days(CAST(30 * a.ln AS INTEGER))) AS VARCHAR)
      || ', ' || CAST(year(o.o_orderdate + to_days(CAST(30 * a.ln AS INTEGER))) AS VARCHAR) || chr(10) ELSE '' END
    || 'PLANNING' || chr(10) || ' & ZONING' || chr(10) || CASE WHEN a.ln % 2 = 0 THEN 'Special Meeting' ELSE 'Regular Meeting' END || chr(10)
    || 'CITY HALL, ROOM ' || CAST(400 + o.o_custkey % 10 AS VARCHAR) || chr(10)
    || 'PRESENT: ' || {_SQL_NAMES}[o.o_custkey % 12 + 1] || ', ' || {_SQL_NAMES}[(o.o_custkey + a.ln) % 12 + 1] || chr(10)
    || 'ABSENT: ' || {_SQL_NAMES}[(o.o_orderkey + a.ln) % 12 + 1] || chr(10)
    || 'STAFF IN ATTENDANCE: ' || {_SQL_NAMES}[(o.o_orderkey + 7) % 12 + 1] || chr(10)
    || (SELECT string_agg(b.block, chr(10) ORDER BY b.ln) FROM mlines b WHERE b.o_orderkey = o.o_orderkey AND b.ln <= a.ln) AS text
  FROM orders o JOIN mlines a ON a.o_orderkey = o.o_orderkey),
meetings AS (
  SELECT o_orderkey, o_orderdate, CAST(i AS BIGINT) AS meeting_pos,
    CAST(month(sd) AS VARCHAR) || '_' || CAST(day(sd) AS VARCHAR) || '_' || lpad(CAST(year(sd) % 100 AS VARCHAR), 2, '0') AS anchor, text
  FROM sections WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT o_orderkey, o_orderdate, CAST(1 AS BIGINT), 'single', 'Preamble' || chr(10) || string_agg(text, chr(10) ORDER BY i)
  FROM sections WHERE o_orderstatus = 'P' GROUP BY o_orderkey, o_orderdate),
h AS (SELECT *, CAST(year(o_orderdate) AS VARCHAR) AS year,
  coalesce(nullif(regexp_extract(text, '{P.DATE_RE}', 1), ''), CASE WHEN regexp_matches(anchor, '{_SQL_ANCHOR}') THEN
    lpad(regexp_extract(anchor, '{_SQL_ANCHOR}', 1), 2, '0') || '/' || lpad(regexp_extract(anchor, '{_SQL_ANCHOR}', 2), 2, '0')
    || '/19' || regexp_extract(anchor, '{_SQL_ANCHOR}', 3) ELSE '' END) AS date,
  {_sql_blocks('text')} AS blocks FROM meetings),
g AS (SELECT *, {_sql_tag('blocks')} AS tagged FROM h)
SELECT o_orderkey, year, meeting_pos, anchor, date, regexp_extract(text, '{P.DAY_RE}', 1) AS day_of_week,
  regexp_extract(text, '{P.MEET_TYPE_RE}', 1) AS meeting_type,
  coalesce(list_filter(string_split(text, chr(10))[1:20],
      lambda l: l = upper(l) AND regexp_matches(l, '[A-Z]') AND regexp_matches(l, 'ROOM|HALL|BUILDING'))[1], '') AS location,
  {_sql_squash(f"regexp_extract(text, '{P.PRESENT_RE}', 1)")} AS present,
  {_sql_squash(f"regexp_extract(text, '{P.ABSENT_RE}', 1)")} AS absent,
  {_sql_squash(f"regexp_extract(text, '{P.STAFF_RE}', 1)")} AS staff,
  'http://minutes.example/' || year || '/page' || CAST(o_orderkey AS VARCHAR) || '.htm' AS source_url,
  coalesce(nullif(replace(replace(replace(date, ',', ''), '/', '-'), ' ', '_'), ''),
           year || '_page' || CAST(o_orderkey AS VARCHAR) || '_' || CAST(meeting_pos AS VARCHAR)) AS file_key,
  CAST(length(tagged) AS BIGINT) AS tagged_chars, md5(tagged) AS tagged_md5
FROM g
""")
def meeting_files(spark: SparkSession, sf: str) -> DataFrame:
    """D4 + D3 + D9 + X27 + D6 + D7 + X28: pages to meetings, each with its header, the anchor's date where the text has
    none, its file key and tagged text."""
    m = D.meetings_of_pages(_minutes_pages(spark, sf), ["o_orderkey"])
    return m.select(*[c for c in m.columns if c != "tagged"], F.length("tagged").cast("bigint").alias("tagged_chars"),
                    F.md5("tagged").alias("tagged_md5"))


@query("case_codes", sql=f"""
WITH {MINUTES_CTE}, {BLOCKS_SQL}
SELECT o_orderkey, pos, upper(replace(coalesce(regexp_extract(block, '{P.CASE_CODE_RE}', 1), ''), ' ', '')) AS code,
  upper(replace(coalesce(regexp_extract(block, '\\b((?:\\d{{2}}|\\d{{4}})\\.\\d{{3,}}(?: ?[A-Z0-9/]+)?)\\b', 1), ''), ' ', '')) AS code_lenient
FROM blocks
""")
def case_codes(spark: SparkSession, sf: str) -> DataFrame:
    """D10 + X16: normalised case code of every block (strict and lenient)."""
    b = blocks_of(spread_minutes(spark, sf), ["o_orderkey"])
    return b.select("o_orderkey", F.col("pos").cast("bigint").alias("pos"), D.case_code("block").alias("code"),
                    D.case_code("block", lenient=True).alias("code_lenient"))


def _sql_initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


@query("item_records", sql=f"""
WITH {MINUTES_CTE},
it AS (SELECT o_orderkey, {_sql_pieces('text', P.ITEM_HEADER_RE)} AS items FROM minutes),
b AS (SELECT o_orderkey, CAST(pos AS BIGINT) AS pos, items[pos] AS b FROM it, range(1, len(items) + 1) r(pos)),
f AS (SELECT o_orderkey, pos, b,
  list_filter(string_split(b, chr(10))[2:], lambda l: regexp_replace(l, '^\\s+|\\s+$', '', 'g') <> ''
              AND NOT starts_with(regexp_replace(l, '^\\s+|\\s+$', '', 'g'), '(')) AS rest,
  list_transform(regexp_extract_all(regexp_replace(regexp_extract(b, '{P.SPEAKERS_RE}', 1), '^\\s+|\\s+$', '', 'g'), '{P.SPEAKER_LINE_RE}', 0),
                 lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')) AS sp,
  regexp_extract(b, '{P.ADDRESS_RE}', 1) AS addr
  FROM b WHERE regexp_matches(string_split(b, chr(10))[1], '\\([^)]*\\)'))
SELECT o_orderkey, pos,
  regexp_extract(b, '^(\\d{{1,2}})[a-zA-Z]?\\.', 1) AS item_num,
  regexp_extract(b, '^\\d{{1,2}}[a-zA-Z]?\\.\\s+(\\d{{4}}-\\d{{6,}}[A-Z]*)', 1) AS code,
  regexp_extract(b, '^\\d{{1,2}}[a-zA-Z]?\\.\\s+\\d{{4}}-\\d{{6,}}[A-Z]*\\s+\\((.*?)\\)', 1) AS staff,
  coalesce(regexp_replace(rest[1], '^\\s+|\\s+$', '', 'g'), '') AS title,
  CASE WHEN addr <> '' THEN {_sql_initcap('addr')} END AS address,
  nullif(regexp_replace(regexp_extract(b, '{P.ACTION_RE}', 1), '^\\s+|\\s+$', '', 'g'), '') AS action,
  nullif(regexp_replace(regexp_extract(b, '{P.AYES_RE}', 1), '^\\s+|\\s+$', '', 'g'), '') AS aye_votes,
  nullif(regexp_replace(regexp_extract(b, '{P.NAYS_RE}', 1), '^\\s+|\\s+$', '', 'g'), '') AS nay_votes,
  nullif(regexp_extract(b, '{P.MOTION_RE}', 2), '') AS motion_or_resolution,
  CAST(len(sp) AS BIGINT) AS speakers_count, array_to_string(sp, '; ') AS speakers_raw
FROM f
""")
def item_records(spark: SparkSession, sf: str) -> DataFrame:
    """D11 + D12 + X20 + X21: modern-format items parsed into fields."""
    r = D.item_rows(spread_minutes(spark, sf), ["o_orderkey"])
    return r.withColumn("pos", F.col("pos").cast("bigint"))


# ---------------------------------------------------------------- records
def _with_damaged_pred(df: DataFrame, out: str = "pred") -> DataFrame:
    """Model-like output from the rule predictor, damaged deterministically:
    a third cut short (invalid JSON), a third with a broken list. The raw
    prediction is staged in its own column (referenced by every branch), so
    it is computed once per block."""
    staged = R.with_rule_prediction(df, "block", "__raw")
    return staged.withColumn(out, _damaged_pred(F.col("__raw"), F.col("o_orderkey"), F.col("pos"))).drop("__raw")


def _damaged_pred(pred: Column, ok: Column, pos: Column) -> Column:
    k = F.pmod(ok + pos, F.lit(3))
    return (F.when(k == 0, F.substring(pred, 1, F.greatest(F.length(pred) - 40, F.lit(1))))
            .when(k == 1, F.replace(pred, F.lit('"noes": ['), F.lit('"noes": [,')))
            .otherwise(pred))


def _sql_json_str(x: str) -> str:
    return f"'\"' || replace(replace({x}, '\\', '\\\\'), '\"', '\\\"') || '\"'"


def _sql_names_list(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, ','), lambda n: regexp_replace(n, '^\\s+|\\s+$', '', 'g')), lambda n: n <> '')"


def _sql_json_list(x: str) -> str:
    return f"'[' || array_to_string(list_transform({x}, lambda n: '\"' || n || '\"'), ', ') || ']'"


_SQL_RULE_PRED = (
    "'{' || '\"case_number\": ' || " + _sql_json_str(f"regexp_extract(block, '{P.CASE_CODE_RE}', 1)")
    + " || ', \"project_address\": ' || " + _sql_json_str("regexp_replace(regexp_extract(block, '[–-]\\s*([^\\n]*)', 1), '^\\s+|\\s+$', '', 'g')")
    + " || ', \"action\": ' || " + _sql_json_str(f"regexp_replace(regexp_extract(block, '{P.ACTION_RE}', 1), '^\\s+|\\s+$', '', 'g')")
    + " || ', \"ayes\": ' || " + _sql_json_list(_sql_names_list(f"regexp_extract(block, '{P.AYES_RE}', 1)"))
    + " || ', \"noes\": ' || " + _sql_json_list(_sql_names_list(f"regexp_extract(block, '{P.NAYS_RE}', 1)"))
    + " || ', \"absent\": ' || " + _sql_json_list(_sql_names_list("regexp_extract(block, 'ABSENT:\\s+([^\\n]+)', 1)"))
    + " || ', \"vote\": ' || '\"' || CAST(len(" + _sql_names_list(f"regexp_extract(block, '{P.AYES_RE}', 1)")
    + ") AS VARCHAR) || '-' || CAST(len(" + _sql_names_list(f"regexp_extract(block, '{P.NAYS_RE}', 1)")
    + f") AS VARCHAR) || '\"' || '}} {P.TERMINATOR}'"
)

PRED_SQL = f"""
preds AS (
  SELECT o_orderkey, pos, source_file, block, raw,
    CASE (o_orderkey + pos) % 3 WHEN 0 THEN substr(raw, 1, greatest(length(raw) - 40, 1))
         WHEN 1 THEN replace(raw, '"noes": [', '"noes": [,') ELSE raw END AS pred
  FROM (SELECT o_orderkey, pos, source_file, block, {_SQL_RULE_PRED} AS raw FROM blocks) s)
"""


def _sql_salvage(pred: str, k: str) -> str:
    lst = f"regexp_extract({pred}, '(?i)\"{k}\"\\s*:\\s*(\\[[^\\]]*?\\])', 1)"
    scal_re = f"(?i)\"{k}\"\\s*:\\s*\"([^\"]*?)\""
    return (f"CASE WHEN {lst} <> '' THEN coalesce(CASE WHEN json_valid({lst}) THEN array_to_string(CAST(json({lst}) AS VARCHAR[]), ', ') END, '') "
            f"WHEN regexp_matches({pred}, '{scal_re}') THEN regexp_replace(regexp_extract({pred}, '{scal_re}', 1), '^\\s+|\\s+$', '', 'g') "
            f"ELSE '' END")


_SALVAGE_KEYS = P.REQUIRED_KEYS


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    m = spread_minutes(spark, sf)
    b = blocks_of(m, ["o_orderkey", "source_file"])
    return _with_damaged_pred(b)


@query("salvage_json", sql=f"""
WITH {MINUTES_CTE}, {BLOCKS_SQL}, {PRED_SQL},
s AS (SELECT o_orderkey, pos, source_file, block, substr(pred, 1, CASE WHEN strpos(pred, '{P.TERMINATOR}') > 0
        THEN strpos(pred, '{P.TERMINATOR}') - 1 ELSE length(pred) END) AS p FROM preds)
SELECT o_orderkey, CAST(pos AS BIGINT) AS pos, source_file, substr(split_part(block, chr(10), 1), 1, 120) AS block_header,
  {", ".join(_sql_salvage("p", k) + " AS " + k for k in _SALVAGE_KEYS)},
  CASE WHEN regexp_matches(block, '^\\s*(\\d{{1,4}})\\b') THEN regexp_extract(block, '^\\s*(\\d{{1,4}})\\b', 1)
       ELSE regexp_replace(block, '^\\s+|\\s+$', '', 'g') END AS block_no,
  json_valid(p) AS valid_json
FROM s
""")
def salvage_json(spark: SparkSession, sf: str) -> DataFrame:
    """D15/D16 + X12/X13/X18/X19: fields salvaged from damaged predictions,
    the block header and strict JSON validity."""
    p = _predictions(spark, sf).withColumn("p", X.before_token("pred"))
    return p.select("o_orderkey", F.col("pos").cast("bigint").alias("pos"), "source_file",
                    X.block_header("block").alias("block_header"),
                    R.salvage_fields("p", _SALVAGE_KEYS).alias("f"),
                    X.clean_block_no("block").alias("block_no"),
                    R.is_valid_json(X.outer_object("p")).alias("valid_json")).select(
        "o_orderkey", "pos", "source_file", "block_header", "f.*", "block_no", "valid_json")


@query("valid_json_ratio", sql=f"""
WITH {MINUTES_CTE}, {BLOCKS_SQL}, {PRED_SQL},
s AS (SELECT year_of, substr(pred, 1, CASE WHEN strpos(pred, '{P.TERMINATOR}') > 0
        THEN strpos(pred, '{P.TERMINATOR}') - 1 ELSE length(pred) END) AS p
      FROM (SELECT p.*, b.year AS year_of FROM preds p JOIN blocks b ON p.o_orderkey = b.o_orderkey AND p.pos = b.pos) q)
SELECT year_of AS year, round(avg(CASE WHEN json_valid(p) THEN 1.0 ELSE 0.0 END), 6) AS valid_json_ratio FROM s GROUP BY year_of
""")
def valid_json_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Share of predictions that are valid JSON, per year."""
    m = spread_minutes(spark, sf)
    b = blocks_of(m, ["o_orderkey", "year"])
    p = _with_damaged_pred(b).withColumn("pred", X.before_token("pred"))
    p = p.withColumn("ok", R.is_valid_json("pred"))
    return A.valid_ratio(p, "ok", "year").withColumn("valid_json_ratio", F.round("valid_json_ratio", 6))


@query("prompts_infer", sql=f"""
WITH {MINUTES_CTE}, {BLOCKS_SQL}
SELECT o_orderkey, CAST(pos AS BIGINT) AS pos, CAST(length('{P.PROMPT_INSTRUCTION.replace(chr(10), "' || chr(10) || '")}' || block) AS BIGINT) AS prompt_chars,
  {_SQL_RULE_PRED} AS pred
FROM blocks
""")
def prompts_infer(spark: SparkSession, sf: str) -> DataFrame:
    """D13 + D14: prompt = instruction + block; predictions from the default
    (rule) predictor in the batch-inference surface."""
    b = blocks_of(spread_minutes(spark, sf), ["o_orderkey"])
    b = b.withColumn("prompt", R.build_prompts("block"))
    r = R.infer(b, "prompt", None, "pred", block_col="block")
    return r.select("o_orderkey", F.col("pos").cast("bigint").alias("pos"),
                    F.length("prompt").cast("bigint").alias("prompt_chars"), "pred")


def load_outline():
    """A predictor without a model: the number of keys that the prompt asks for, and the first words of its block."""
    import pandas as pd

    def predict(prompts: pd.Series) -> pd.Series:
        parts = prompts.str.split("Raw block:\n", n=1)
        asked, block = parts.str[0].str.count(r"(?m)^- "), parts.str[1]
        return asked.astype(str) + " " + block.str.slice(0, 12).str.replace("\n", " ")

    return predict


@query("prompts_predict", sql=f"""
WITH {MINUTES_CTE}, {BLOCKS_SQL}
SELECT o_orderkey, CAST(pos AS BIGINT) AS pos, CASE WHEN o_orderkey % 2 = 0 THEN '{len(P.REQUIRED_KEYS)} ' ELSE '2 ' END
  || replace(substr(block, 1, 12), chr(10), ' ') AS pred
FROM blocks
""")
def prompts_predict(spark: SparkSession, sf: str) -> DataFrame:
    """D13 + D14: a supplied predictor, loaded once a task, that reads the prompt; odd orders get a shorter instruction."""
    b = blocks_of(spread_minutes(spark, sf), ["o_orderkey"])
    short = "Required keys:\n- action\n- vote\n\nRaw block:\n"
    prompt = F.when(F.col("o_orderkey") % 2 == 0, R.build_prompts("block")).otherwise(R.build_prompts("block", short))
    r = R.infer_with(b.select("o_orderkey", "pos", prompt.alias("prompt")), "prompt", load_outline)
    return r.select("o_orderkey", F.col("pos").cast("bigint").alias("pos"), "pred")


@query("lenient_text", sql="""
SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, md5(text) AS text_md5, doc_id % 4 > 0 AS repaired FROM documents
""")
def lenient_text(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as bytes, three of four with stray bytes around them, decoded without these."""
    bad = lambda h: F.unhex(F.lit(h))
    text, n = F.col("text").cast("binary"), F.col("doc_id") % 4
    docs = table(spark, sf, "documents").select("doc_id", F.when(n == 1, F.concat(bad("FFC3"), text)).when(n == 2, F.concat(text, bad("E282")))
                                                .when(n == 3, F.concat(bad("EDA080C080"), text, bad("F09080"))).otherwise(text).alias("content"))
    out = docs.select("doc_id", lenient_utf8("content").alias("text"), (~F.is_valid_utf8(F.col("content").cast("string"))).alias("repaired"))
    return out.select("doc_id", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("text_md5"), "repaired")


# ---------------------------------------------------------------- pairs
def _labels(spark: SparkSession, sf: str) -> DataFrame:
    """Hand-label stand-ins: one label per fulfilled block of every
    order with the case number it should pair with; every 5th carries a
    blank case number, every 7th a number with a stray space."""
    o = spread(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate"))
    ok, ck, ln = F.col("o_orderkey"), F.col("o_custkey"), F.col("ln")
    j = o.withColumn("ln", F.explode(F.sequence(F.lit(1).cast("bigint"), ck % MAX_BLOCKS + 1)))
    line = _line(ln, ok, ck, F.col("o_orderdate"))
    j = j.withColumn("l_returnflag", line["l_returnflag"]).filter(line["l_linestatus"] == "F")
    yr = F.year("o_orderdate")
    code = F.concat(F.when(ln % 2 == 0, _s(yr)).otherwise(F.lpad(_s(yr % 100), 2, "0")), F.lit("."),
                    F.lpad(_s(ok * 10 + ln), 6, "0"), F.col("l_returnflag"), F.lit("F"))
    code = (F.when((ok * 10 + ln) % 5 == 0, F.lit(""))
            .when((ok * 10 + ln) % 7 == 0, F.concat(F.substring(code, 1, 3), F.lit(" "), F.substring(code, 4, 100)))
            .otherwise(F.lower(code)))
    action = F.when(F.col("l_returnflag") == "A", F.lit("Approved")).when(F.col("l_returnflag") == "R", F.lit("Disapproved"))
    return j.select(_s(yr).alias("year"), (ok * 10 + ln).alias("label_id"), code.alias("case_number"),
                    action.alias("action"))


_LABEL_SQL = """
labels_d AS (
  SELECT CAST(year(o.o_orderdate) AS VARCHAR) AS year, l.l_orderkey * 10 + l.l_linenumber AS label_id,
    CASE WHEN (l.l_orderkey * 10 + l.l_linenumber) % 5 = 0 THEN ''
         WHEN (l.l_orderkey * 10 + l.l_linenumber) % 7 = 0 THEN substr(code, 1, 3) || ' ' || substr(code, 4, 100)
         ELSE lower(code) END AS case_number,
    CASE l.l_returnflag WHEN 'A' THEN 'Approved' WHEN 'R' THEN 'Disapproved' END AS action
  FROM (SELECT *, (CASE WHEN l_linenumber % 2 = 0 THEN CAST(year(o_orderdate) AS VARCHAR)
               ELSE lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0') END)
          || '.' || lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 6, '0') || l_returnflag || 'F' AS code
        FROM order_lines JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F') l
  JOIN orders o ON l.l_orderkey = o.o_orderkey)
"""

_CODED_SQL = f"""
coded AS (
  SELECT year, code, max_by(block, [length(block), -pos]) AS block FROM (
    SELECT year, pos, block, upper(replace(coalesce(regexp_extract(block, '{P.CASE_CODE_RE}', 1), ''), ' ', '')) AS code
    FROM blocks) WHERE code <> '' GROUP BY year, code),
lab AS (SELECT *, upper(replace(coalesce(case_number, ''), ' ', '')) AS code FROM labels_d),
pairs AS (
  SELECT lab.year, lab.label_id, lab.case_number, lab.action, lab.code, c.block IS NOT NULL AS paired,
         c.block || chr(10) || chr(10) AS prompt,
         '{{"case_number": "' || coalesce(lab.case_number, '') || '", "action": ' ||
           CASE WHEN lab.action IS NULL THEN '""' ELSE '"' || lab.action || '"' END ||
         ', "project_address": "", "lot_number": "", "assessor_block": "", "project_descr": "", "type_district": "", '
         || '"type_district_descr": "", "speakers": "", "modifications": "", "ayes": [], "noes": [], "absent": [], "vote": "", "action_name": ""}}'
         || ' {P.TERMINATOR}' AS completion
  FROM lab LEFT JOIN coded c ON lab.year = c.year AND lab.code = c.code)
"""


def _pairs(spark: SparkSession, sf: str, codes_only: bool = False):
    m = spread_minutes(spark, sf)
    blocks = blocks_of(m, ["o_orderkey", "year"])
    # The summary (one row per (year, code)) feeds the pairs and the unmatched codes. Who reads it twice and asks for no
    # prompt gets its codes, without block texts, written once to the shared checkpoint folder: the expensive text
    # stages (minutes -> split -> codes) run once, no text is shuffled or written, and a lost executor re-reads them.
    summary = R.code_summary(blocks, "block", "year", "pos")
    if codes_only:
        summary = cut_lineage(summary.select("year", "code", "n_blocks"))
    labels = _labels(spark, sf)
    pairs = R.training_pairs(labels, blocks, ["case_number", "action"], year="year", summary=summary)
    return labels, summary, pairs


@query("training_pairs", sql=f"""
WITH {MINUTES_CTE}, {BLOCKS_SQL}, {_LABEL_SQL}, {_CODED_SQL}
SELECT year, label_id, code, paired, prompt, completion FROM pairs
""")
def training_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """D17 + J8 + A19 + P22 + X14: labels paired with the longest block of
    their (year, normalised case code); completion = label JSON with the
    required keys backfilled, plus the terminator."""
    _, _, pairs = _pairs(spark, sf)
    return pairs.select("year", "label_id", "code", "paired", "prompt", "completion")


KEY_ALIASES = {"actoin": "action", "Speakers": "speakers"}


def _label_files(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in label files: JSON arrays of the hand labels of 64 order numbers each, named by their year, with nested
    lists, numbers, nulls, irregular blanks and a misspelt key."""
    n, action = F.col("label_id"), F.coalesce(R.json_string("action"), F.lit("null"))
    text = F.concat(F.lit('{"case_number":'), R.json_string("case_number"), F.when(n % 3 == 0, F.lit(' ,"actoin": ')).otherwise(F.lit(', "action" : ')), action,
                    F.lit(',"lot_number":'), _s(n), F.lit(', "votes": [{"name":"An:n, B", "seat": '), _s(n % 7), F.lit('},{"name": "Bo\\"b","seat":null}]'),
                    F.when(n % 2 == 0, F.lit(',\n"ayes": ["A, B" , "C"]')).otherwise(F.lit(',\t"ayes":"A"')),
                    F.when(n % 4 == 1, F.lit(', "vote":2.5,"absent":null')).otherwise(F.lit("")), F.lit("}"))
    rows = _labels(spark, sf).select("year", n.alias("n"), text.alias("label"), F.floor(n / 640).alias("part"))
    files = rows.groupBy("year", "part").agg(F.sort_array(F.collect_list(F.struct("n", "label"))).alias("l"))
    return files.select(F.concat("year", F.lit("_labeled.json")).alias("file_name"),
                        F.concat(F.lit(" [\n"), F.array_join("l.label", ",\n"), F.lit("]")).alias("value"))


@query("label_pairs", sql=f"""
WITH {MINUTES_CTE}, {BLOCKS_SQL}, {_LABEL_SQL},
coded AS (
  SELECT year, code, max_by(block, [length(block), -pos]) AS block FROM (
    SELECT year, pos, block, upper(replace(coalesce(regexp_extract(block, '{P.CASE_CODE_RE}', 1), ''), ' ', '')) AS code
    FROM blocks) WHERE code <> '' GROUP BY year, code),
lab AS (SELECT *, upper(replace(case_number, ' ', '')) AS code FROM labels_d)
SELECT lab.year, lab.label_id, lab.code, c.block IS NOT NULL AS paired, c.block || chr(10) || chr(10) AS prompt,
  '{{"case_number": "' || case_number || '", "action": ' || coalesce('"' || action || '"', 'null') || ', "lot_number": ' || label_id ||
  ', "votes": [{{"name": "An:n, B", "seat": ' || label_id % 7 || '}}, {{"name": "Bo\\"b", "seat": null}}], "ayes": ' ||
  CASE WHEN label_id % 2 = 0 THEN '["A, B", "C"]' ELSE '"A"' END || CASE WHEN label_id % 4 = 1 THEN ', "vote": 2.5, "absent": null' ELSE '' END ||
  ', "project_address": "", "assessor_block": "", "project_descr": "", "type_district": "", "type_district_descr": "", "speakers": "", '
  || '"modifications": "", "noes": []' || CASE WHEN label_id % 4 = 1 THEN '' ELSE ', "absent": [], "vote": ""' END || ', "action_name": ""}}'
  || ' {P.TERMINATOR}' AS completion
FROM lab LEFT JOIN coded c ON lab.year = c.year AND lab.code = c.code
""")
def label_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """S5 + D23 + P22 + X14 + D17 + J8 + A19: label files, read with their types, mended and paired with blocks."""
    labels = L.parse_labels(_label_files(spark, sf))
    longest = R.block_codes(blocks_of(spread_minutes(spark, sf), ["o_orderkey", "year"]), "block", "year", "pos")
    pairs = L.pair_labels(labels, longest, KEY_ALIASES)
    return pairs.select("year", F.element_at("raw", F.lit("lot_number")).cast("bigint").alias("label_id"), "code", "paired", "prompt", "completion")


@query("pairing_diagnostics", sql=f"""
WITH {MINUTES_CTE}, {BLOCKS_SQL}, {_LABEL_SQL}, {_CODED_SQL}
SELECT year, 'missing_label_case_numbers' AS kind, CASE WHEN code = '' THEN '{P.MISSING_CASE}' ELSE code END AS code
FROM pairs WHERE NOT paired
UNION ALL
SELECT c.year, 'unmatched_block_case_numbers' AS kind, c.code FROM coded c
WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.paired AND p.year = c.year AND p.code = c.code)
""")
def pairing_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    """D18 (long form): label codes without a block, block codes without a label."""
    _, summary, pairs = _pairs(spark, sf, codes_only=True)
    return R.pairing_diagnostics(pairs, None, "year", summary=summary)


@query("pairing_stats", sql=f"""
WITH {MINUTES_CTE}, {BLOCKS_SQL}, {_LABEL_SQL}, {_CODED_SQL},
lb AS (SELECT year, count(*) AS labels FROM labels_d GROUP BY year),
bk AS (SELECT year, count(*) AS blocks_found FROM blocks GROUP BY year),
pr AS (SELECT year, sum(CASE WHEN paired THEN 1 ELSE 0 END) AS paired, sum(CASE WHEN paired THEN 0 ELSE 1 END) AS labels_without_block
       FROM pairs GROUP BY year),
um AS (SELECT c.year, count(*) AS unmatched_blocks FROM coded c
       WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.paired AND p.year = c.year AND p.code = c.code) GROUP BY c.year),
y AS (SELECT coalesce(lb.year, bk.year, pr.year, um.year) AS year, coalesce(labels, 0) AS labels, coalesce(blocks_found, 0) AS blocks_found,
             coalesce(paired, 0) AS paired, coalesce(labels_without_block, 0) AS labels_without_block, coalesce(unmatched_blocks, 0) AS unmatched_blocks
      FROM lb FULL JOIN bk ON lb.year = bk.year FULL JOIN pr ON coalesce(lb.year, bk.year) = pr.year
      FULL JOIN um ON coalesce(lb.year, bk.year, pr.year) = um.year)
SELECT year, CAST(labels AS BIGINT) AS labels, CAST(blocks_found AS BIGINT) AS blocks_found, CAST(paired AS BIGINT) AS paired,
       CAST(labels_without_block AS BIGINT) AS labels_without_block, CAST(unmatched_blocks AS BIGINT) AS unmatched_blocks FROM y
UNION ALL
SELECT NULL, CAST(sum(labels) AS BIGINT), CAST(sum(blocks_found) AS BIGINT), CAST(sum(paired) AS BIGINT),
       CAST(sum(labels_without_block) AS BIGINT), CAST(sum(unmatched_blocks) AS BIGINT) FROM y
""")
def pairing_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Per-year pairing counts plus a grand total row, from one aggregate; no block text travels."""
    blocks = blocks_of(spread_minutes(spark, sf), ["o_orderkey", "year"]).select("year", D.case_code("block").alias("code"))
    labels = _labels(spark, sf).select("year", X.normalise_case("case_number").alias("code"))
    return A.pairing_stats(labels, blocks)


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Structured records per block (case, meeting date, address, action,
    vote lists as text), extracted directly with the rule predictor's field
    patterns — one regex per field instead of generating JSON and salvaging
    it back."""
    m = spread_minutes(spark, sf).select("o_orderkey", "text", "year")
    m = m.withColumn("meeting_date", X.parse_weekday_date("text").cast("string"))
    b = blocks_of(m, ["o_orderkey", "meeting_date"])
    blk = F.col("block")
    return b.select(
        "o_orderkey", "pos", "meeting_date",
        F.regexp_extract(blk, P.CASE_CODE_RE, 1).alias("case_number"),
        X.strip(F.regexp_extract(blk, r"[–-]\s*([^\n]*)", 1)).alias("project_address"),
        X.strip(F.regexp_extract(blk, P.ACTION_RE, 1)).alias("action"),
        F.array_join(X.split_names(F.regexp_extract(blk, P.AYES_RE, 1)), ", ").alias("ayes"),
        F.array_join(X.split_names(F.regexp_extract(blk, P.NAYS_RE, 1)), ", ").alias("noes"),
        F.array_join(X.split_names(F.regexp_extract(blk, P.BLOCK_ABSENT_RE, 1)), ", ").alias("absent"))


_RECORDS_SQL = f"""
recs AS (
  SELECT b.o_orderkey, b.pos, CAST(CAST({_sql_weekday_date('m.text')} AS DATE) AS VARCHAR) AS meeting_date,
    regexp_extract(b.block, '{P.CASE_CODE_RE}', 1) AS case_number,
    regexp_replace(regexp_extract(b.block, '[–-]\\s*([^\\n]*)', 1), '^\\s+|\\s+$', '', 'g') AS project_address,
    regexp_replace(regexp_extract(b.block, '{P.ACTION_RE}', 1), '^\\s+|\\s+$', '', 'g') AS action,
    array_to_string({_sql_names_list(f"regexp_extract(b.block, '{P.AYES_RE}', 1)")}, ', ') AS ayes,
    array_to_string({_sql_names_list(f"regexp_extract(b.block, '{P.NAYS_RE}', 1)")}, ', ') AS noes,
    array_to_string({_sql_names_list(f"regexp_extract(b.block, '{P.BLOCK_ABSENT_RE}', 1)")}, ', ') AS absent
  FROM blocks b JOIN minutes m ON b.o_orderkey = m.o_orderkey)
"""


@query("speaker_stances", sql=f"""
WITH {MINUTES_CTE},
numbered AS (SELECT l.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS pos FROM order_lines l),
said AS (
  SELECT l_orderkey AS o_orderkey, pos, 1 AS entry, {_SQL_NAMES}[l_partkey % 12 + 1] AS name, 'for' AS stance FROM numbered
  UNION ALL SELECT l_orderkey, pos, 2, {_SQL_NAMES}[l_suppkey % 12 + 1], 'against' FROM numbered
  UNION ALL SELECT l_orderkey, pos, 3, {_SQL_NAMES}[(l_partkey + l_suppkey) % 12 + 1], 'neutral' FROM numbered WHERE l_quantity > 25)
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 2 = 0 AND n = 1 THEN 1 ELSE pos END AS BIGINT) AS pos, CAST(entry AS BIGINT) AS entry, name, stance
FROM said JOIN (SELECT l_orderkey, count(*) AS n FROM order_lines GROUP BY l_orderkey) c ON said.o_orderkey = c.l_orderkey
""")
def speaker_stances(spark: SparkSession, sf: str) -> DataFrame:
    """The speakers of every block, in order, with the side they took; some names stand on the line after their sign."""
    b = blocks_of(spread_minutes(spark, sf), ["o_orderkey"])
    section = F.regexp_extract("block", P.SPEAKERS_RE, 1)
    said = A.explode_nonempty(b.select("o_orderkey", "pos", D.speakers(section).alias("said")), ["o_orderkey", "pos"], "said", ("entry", "s"))
    return said.select("o_orderkey", F.col("pos").cast("bigint").alias("pos"), (F.col("entry") + 1).cast("bigint").alias("entry"), "s.name", "s.stance")


def _model_output(ok: Column, ln: Column) -> Column:
    """Stand-in output of a model for block ``ln`` of an order: all keys, sometimes cut off after the last complete one, with a
    list that does not parse, or with text after the end mark."""
    no = _s(ok * 10 + ln)
    parts = [('"case_number": "98.', no, 'C"'), (', "project_address": " ', no, ' Main \\u0026 First "'), (', "lot_number": "', _s(ok % 97), '"'),
             (', "assessor_block": "', F.concat(_s(ok % 9000 + 1), F.when(ok % 2 == 0, F.lit(" and others")).otherwise(F.lit(""))), '"'),
             (', "project_descr": "Lot ', no, '"'), (', "TYPE_DISTRICT": "', F.concat(F.lit("RH-"), _s(ln)), '"'),
             (', "type_district_descr": "house of ', _s(ln), '"'), (', "speakers": [', F.concat(F.lit('"+ '), _name(ok), F.lit('", "- '), _name(ln), F.lit('"')), ']'),
             (', "action": "', F.when(ok % 3 == 0, F.lit("Approved")).otherwise(F.lit("Continued")), '"'),
             (', "modifications": "', _s(ok % 5), '"'), (', "ayes": [', F.concat(F.lit('"'), _name(ok + ln), F.lit('", "'), _name(ok + ln + 1), F.lit('"')), ']'),
             (', "noes": [', F.when(ok % 4 == 0, F.lit(",")).otherwise(F.concat(F.lit('"'), _name(ok), F.lit('"'))), ']'),
             (', "absent": "', _name(ln), '"')]
    tail = F.when((ok + ln) % 5 == 0, F.lit(', "vote": "3-')).otherwise(F.concat(
        F.lit(', "vote": "2-'), _s(ok % 2), F.lit('", "action_name": "Motion '), no, F.lit(f'"}} {P.TERMINATOR} "vote": "9-9"')))
    return F.concat(F.lit("{"), *[c for a, v, z in parts for c in (F.lit(a), v, F.lit(z))], tail)


@query("flat_records", sql=f"""
WITH {MINUTES_CTE}, {BLOCKS_SQL},
k AS (SELECT b.*, m.text, b.o_orderkey AS ok, b.pos AS ln FROM blocks b JOIN minutes m ON b.o_orderkey = m.o_orderkey)
SELECT source_file, CAST(CAST({_sql_weekday_date('text')} AS DATE) AS VARCHAR) AS meeting_date, '98.' || (ok * 10 + ln) || 'C' AS case_number,
  (ok * 10 + ln) || ' Main \\u0026 First' AS project_address, CAST(ok % 97 AS VARCHAR) AS lot_number, CAST(ok % 9000 + 1 AS VARCHAR) AS assessor_block,
  'Lot ' || (ok * 10 + ln) AS project_descr, 'RH-' || ln AS type_district, 'house of ' || ln AS type_district_descr,
  CASE WHEN ok % 3 = 0 THEN 'Approved' ELSE 'Continued' END AS action,
  CASE WHEN (ok + ln) % 5 = 0 THEN '' ELSE 'Motion ' || (ok * 10 + ln) END AS action_name,
  CASE WHEN (ok + ln) % 5 = 0 THEN '' ELSE '2-' || (ok % 2) END AS vote,
  {_SQL_NAMES}[(ok + ln) % 12 + 1] || ', ' || {_SQL_NAMES}[(ok + ln + 1) % 12 + 1] AS ayes,
  CASE WHEN ok % 4 = 0 THEN '' ELSE {_SQL_NAMES}[ok % 12 + 1] END AS noes, {_SQL_NAMES}[ln % 12 + 1] AS absent,
  CAST(ok % 5 AS VARCHAR) AS modifications, substr(split_part(block, chr(10), 1), 1, 120) AS block_header,
  ln AS block, '+ ' || {_SQL_NAMES}[ok % 12 + 1] || ', - ' || {_SQL_NAMES}[ln % 12 + 1] AS speakers
FROM k
""")
def flat_records(spark: SparkSession, sf: str) -> DataFrame:
    """D6 -> X10 -> D15 -> D16 -> P20 -> P21 -> P7: blocks and a model's output become one flat table of records."""
    m = spread_minutes(spark, sf).select("o_orderkey", "source_file", "text")
    m = m.withColumn("meeting_date", X.parse_weekday_date("text").cast("string"))
    b = blocks_of(m, ["o_orderkey", "source_file", "meeting_date"]).withColumn("pos", F.col("pos").cast("bigint"))
    p = b.withColumn("pred", _model_output(F.col("o_orderkey"), F.col("pos")))
    return R.flat_records(R.assemble_records(p, "source_file", "meeting_date", "block", "pred", "pos"))


def _hearings(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in minutes in which a project comes up again: an order is a meeting that hears its customer's project and the next
    customer's one; the action follows from the order's status and priority."""
    o = spread(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"))
    d, ck = F.col("o_orderdate"), F.col("o_custkey")
    date = F.concat(F.date_format(d, "EEEE, MMMM "), _s(F.dayofmonth(d)), F.lit(", "), _s(F.year(d)))

    def block(no: Column, action: Column) -> Column:
        return F.concat(F.lit("\n97."), F.lpad(_s(no), 9, "0"), F.lit("E – PROJECT\nACTION: "), action, F.lit("\nAYES: Elm"))

    first = F.when(F.col("o_orderstatus") == "F", F.lit("Approved")).when(F.col("o_orderstatus") == "O", F.lit("Continued")).otherwise(F.lit("Disapproved"))
    return o.select("o_orderkey", F.concat(F.when(F.col("o_orderkey") % 13 == 0, F.lit("undated")).otherwise(date), F.lit("\nRegular Meeting"),
                                           block(ck, first), block(ck + 1, F.col("o_orderpriority"))).alias("text"))


@query("hearing_history", sql="""
WITH h AS (
  SELECT CASE WHEN o_orderkey % 13 <> 0 AND dayofweek(o_orderdate) BETWEEN 1 AND 5 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS meeting_date,
    unnest([o_custkey, o_custkey + 1]) AS no,
    unnest([CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Continued' ELSE 'Disapproved' END, o_orderpriority]) AS action
  FROM orders)
SELECT '97.' || lpad(CAST(no AS VARCHAR), 9, '0') || 'E' AS case_number, min(meeting_date) AS first_meeting, max(meeting_date) AS last_meeting,
  count(*) AS appearances, max_by(action, [coalesce(meeting_date, ''), action]) AS last_action, CAST(count(DISTINCT action) AS BIGINT) AS n_actions
FROM h GROUP BY no
""")
def hearing_history(spark: SparkSession, sf: str) -> DataFrame:
    """D22 (after D6, X10, D10): projects heard at many meetings, some of them undated."""
    m = _hearings(spark, sf).withColumn("meeting_date", X.parse_weekday_date("text").cast("string"))
    b = blocks_of(m, ["o_orderkey", "meeting_date"])
    recs = b.select("meeting_date", D.case_code("block").alias("case_number"), X.strip(F.regexp_extract("block", P.ACTION_RE, 1)).alias("action"))
    return R.project_history(recs, "case_number", "meeting_date", "action")


@query("votes_long", sql=f"""
WITH {MINUTES_CTE}, {BLOCKS_SQL}, {_RECORDS_SQL}
SELECT case_number, meeting_date, trim(member) AS member, vote FROM (
  SELECT case_number, meeting_date, unnest({_sql_names_list('ayes')}) AS member, 'aye' AS vote FROM recs
  UNION ALL
  SELECT case_number, meeting_date, unnest({_sql_names_list('noes')}) AS member, 'no' AS vote FROM recs
  UNION ALL
  SELECT case_number, meeting_date, unnest({_sql_names_list('absent')}) AS member, 'absent' AS vote FROM recs)
""")
def votes_long(spark: SparkSession, sf: str) -> DataFrame:
    """Long vote table (case, meeting date, member, vote)."""
    r = _records(spark, sf)
    return R.explode_votes(r, "case_number", "meeting_date")


@query("project_history", sql=f"""
WITH {MINUTES_CTE}, {BLOCKS_SQL}, {_RECORDS_SQL}
SELECT case_number, min(meeting_date) AS first_meeting, max(meeting_date) AS last_meeting, count(*) AS appearances,
       max_by(action, [coalesce(meeting_date, ''), action]) AS last_action, CAST(count(DISTINCT action) AS BIGINT) AS n_actions
FROM recs WHERE case_number <> '' GROUP BY case_number
""")
def project_history(spark: SparkSession, sf: str) -> DataFrame:
    """History of each case across meetings (first/last meeting,
    appearances, last and distinct actions); undated records count."""
    return R.project_history(_records(spark, sf), "case_number", "meeting_date", "action")
