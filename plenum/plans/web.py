"""Pages — link harvesting, filtering, grouping, page text, URL parts and
incremental skip-landed, on the driver ``pages`` table (page_id, url, html).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators import aggregate as A
from ..operators import clean as C
from ..operators import documents as D
from ..operators import markup as MK
from ..operators import merge as M
from ..sources import sinks as K
from ..sources.readers import spread, table
from .registry import query

_HREF_SQL = "regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1)"

# Resolution of common href forms against the page URL (absolute,
# protocol-relative, root-relative, query-only, fragment-only, relative
# without dot segments) — the oracle for X29 on this data.
_RESOLVE_SQL = """
CASE WHEN regexp_matches(h, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN h
     WHEN starts_with(h, '//') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) || ':' || h
     WHEN h = '' THEN regexp_replace(url, '#.*$', '')
     WHEN starts_with(h, '#') THEN regexp_replace(url, '#.*$', '') || h
     WHEN starts_with(h, '?') THEN regexp_replace(regexp_replace(url, '#.*$', ''), '\\?.*$', '') || h
     WHEN starts_with(h, '/') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || h
     ELSE regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)
          || regexp_replace(coalesce(nullif(regexp_extract(regexp_replace(regexp_replace(url, '#.*$', ''), '\\?.*$', ''),
                 '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/.*)?$', 1), ''), '/'), '[^/]*$', '') || h END
"""

LINKS_SQL = f"""
raw AS (SELECT page_id, url, regexp_replace(unnest({_HREF_SQL}), '^\\s+|\\s+$', '', 'g') AS h FROM pages),
links AS (SELECT page_id, url, h AS href, {_RESOLVE_SQL} AS link FROM raw)
"""


def links(spark: SparkSession, sf: str) -> DataFrame:
    """D1 (regex path) + X29: every href of every page resolved against the page URL."""
    g = table(spark, sf, "pages").select("page_id", "url", "html")
    e = A.explode_nonempty(g, ["page_id", "url"], D.href_links("html"), ("href",), with_pos=False)
    e = e.withColumn("href", X.strip("href"))
    return e.withColumn("link", X.resolve_url("url", "href"))


@query("link_extract", sql=f"""
WITH {LINKS_SQL}
SELECT DISTINCT link FROM links
""")
def link_extract(spark: SparkSession, sf: str) -> DataFrame:
    """D1 + X29 + P24: distinct absolute links over all pages."""
    return links(spark, sf).select("link").distinct()


def _framed(pages: DataFrame) -> DataFrame:
    """Stand-in pages: every third one gets the content element around its article, with links in it, in other
    spellings and partly broken (an unclosed paragraph, nested elements, an anchor without a target)."""
    begin = F.concat(F.lit('<div id="ctl00_content_Screen"><div class="x"><A class=l title="a>b" HREF=\' /doc/'), F.col("page_id").cast("string"),
                     F.lit(".pdf '>Minutes &amp; <b>notes</b>\n"), F.col("page_id").cast("string"), F.lit(" </A></div><article>"))
    end = F.lit('</article><p><a href="#end">End&#33;</a><div></div><a name="x">no link</a></div>')
    html = F.replace(F.replace("html", F.lit("<article>"), begin), F.lit("</article>"), end)
    return pages.withColumn("html", F.when(F.col("page_id") % 3 == 0, html).otherwise(F.col("html")))


@query("link_parse", sql=f"""
WITH raw AS (
  SELECT page_id, url, unnest([1, 2]) AS pos, unnest(['/doc/' || page_id || '.pdf', '#end']) AS h,
         unnest(['Minutes & notes' || chr(10) || page_id, 'End!']) AS text FROM pages WHERE page_id % 3 = 0
  UNION ALL
  SELECT page_id, url, generate_subscripts(a, 1) AS pos, regexp_extract(unnest(a), '"([^"]*)"', 1) AS h,
         regexp_extract(unnest(a), '>([^<]*)<', 1) AS text
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="[^"]*">[^<]*<') AS a FROM pages WHERE page_id % 3 <> 0))
SELECT page_id, url, CAST(pos AS BIGINT) AS pos, h AS href, text, {_RESOLVE_SQL} AS link FROM raw
""")
def link_parse(spark: SparkSession, sf: str) -> DataFrame:
    """D1 + X29: anchors with text, inside the content element when a page has one, and their absolute links."""
    ln = D.extract_links(_framed(spread(table(spark, sf, "pages"))))
    return ln.withColumn("link", X.resolve_url("url", "href"))


@query("link_filter", sql=f"""
WITH {LINKS_SQL}
SELECT page_id, count(*) AS n_links,
  count(*) FILTER (WHERE regexp_matches(lower(href), '\\.html?$') AND NOT contains(lower(href), 'agenda')) AS n_page_links,
  count(*) FILTER (WHERE ends_with(lower(link), '.pdf') AND contains(lower(link), 'minute')
                   AND NOT regexp_matches(lower(link), '(example|template|sample)\\.pdf$')) AS n_minutes_docs,
  count(*) FILTER (WHERE contains(lower(href), 'e')) AS n_with_e
FROM links GROUP BY page_id
""")
def link_filter(spark: SparkSession, sf: str) -> DataFrame:
    """F7 + F8: page-link and minutes-document predicates counted per page."""
    ln = links(spark, sf)
    return ln.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n_links"),
        F.count(F.when(X.is_page_link("href"), 1)).alias("n_page_links"),
        F.count(F.when(X.is_minutes_doc("link", F.lit("")), 1)).alias("n_minutes_docs"),
        F.count(F.when(F.lower("href").contains("e"), 1)).alias("n_with_e"))


# What an archive page lists: href, anchor text ({n} is the page's number).
ARCHIVE = [("/doc/{n}.pdf", "Minutes of meeting {n}"), ("/files/minutes-{n}.PDF", "Record"), ("day{n}.HTML", "Day"),
           ("agenda{n}.htm", "Agenda"), ("/doc/sample.pdf", "Minutes sample"), ("/doc/{n}.pdf?x=1", "Minutes, printed"),
           ("notes{n}.htm", "<b>MIN</b>UTES"), ("/doc/plan{n}.pdf", "Plan")]


def _archived(pages: DataFrame) -> DataFrame:
    """Stand-in pages: a list of links goes before the article, the entries beginning at one that the page's number names."""
    n = F.col("page_id").cast("string")
    entries = [F.when((F.col("page_id") + i) % 3 != 0, F.replace(F.lit(f'<li><a href="{h}"> {t} </a></li>'), F.lit("{n}"), n))
               for i, (h, t) in enumerate(ARCHIVE)]
    listed = F.concat(F.lit("<ul>"), F.concat_ws("", *entries), F.lit("</ul><article>"))
    return pages.withColumn("html", F.replace("html", F.lit("<article>"), listed))


@query("archive_links", sql=f"""
WITH listed AS (
  SELECT page_id, e.i AS i, replace(e.h, '{{n}}', CAST(page_id AS VARCHAR)) AS h, replace(e.t, '{{n}}', CAST(page_id AS VARCHAR)) AS t
  FROM pages, (VALUES {", ".join(f"({i}, '{h}', '{t.replace('<b>', '').replace('</b>', '')}')" for i, (h, t) in enumerate(ARCHIVE))}) e(i, h, t)
  WHERE (page_id + e.i) % 3 <> 0)
SELECT page_id, h AS href, t AS text, i IN (2, 6) AS is_page, i IN (0, 1) AS is_document FROM listed WHERE i IN (0, 1, 2, 6)
""")
def archive_links(spark: SparkSession, sf: str) -> DataFrame:
    """D1 -> X29 -> F7/F8 -> F4: the links worth following on archive pages, pages by their suffix and documents by their
    address or the text of the anchor."""
    ln = D.extract_links(_archived(spread(table(spark, sf, "pages"))))
    ln = ln.withColumns({"text": X.strip("text"), "link": X.resolve_url("url", "href")})
    judged = ln.withColumns({"is_page": X.is_page_link("href"), "is_document": X.is_minutes_doc("link", "text")})
    return C.keep_any(judged, F.col("is_page"), F.col("is_document")).select("page_id", "href", "text", "is_page", "is_document")


@query("harvested_urls", sql="""
WITH t AS (SELECT page_id, 1995 + page_id % 10 AS y, page_id % 7 AS f FROM pages),
u AS (
  SELECT y AS year, 'https://one.example/' || y || '/p' || (page_id // 20) AS url FROM t
  UNION ALL SELECT 2004 - page_id % 10, 'http://two.example/a/' || (2004 - page_id % 10) || '-0' || (f + 1) || '.pdf' FROM t)
SELECT DISTINCT CAST(year AS VARCHAR) AS year, url FROM u WHERE year BETWEEN 1998 AND 2001
""")
def harvested_urls(spark: SparkSession, sf: str) -> DataFrame:
    """X33 -> X31 (year in the path) -> F6 -> A22: addresses in free text, those of some years, distinct and sorted per year."""
    n, y = F.col("page_id"), 1995 + F.col("page_id") % 10
    text = F.concat(F.lit("See {https://one.example/"), y.cast("string"), F.lit("/p"), F.floor(n / 20).cast("string"), F.lit("}\nor <http://two.example/a/"),
                    (2004 - n % 10).cast("string"), F.lit("-0"), (n % 7 + 1).cast("string"), F.lit(".pdf> ; ftp://no.example/1999/ https://none.example/"), n.cast("string"))
    notes = table(spark, sf, "pages").select("page_id", text.alias("text"))
    urls = A.explode_nonempty(notes, ["page_id"], X.harvest_urls("text"), ("url",), with_pos=False)
    dated = urls.withColumn("year", X.url_year("url", default=None, mode="path"))
    return A.sorted_unique_by(C.keep_range(dated, "year", "1998", "2001"), "year", "url")


@query("payload_kinds", sql="""
SELECT kind, count(*) AS n, min(page_id) AS first_page, CAST(sum(n_bytes) AS BIGINT) AS n_bytes
FROM (SELECT page_id, CASE WHEN page_id % 4 = 1 THEN 'pdf' ELSE 'html' END AS kind,
        octet_length(encode(html)) + CASE WHEN page_id % 4 = 1 THEN 9 ELSE 0 END AS n_bytes FROM pages)
GROUP BY kind
""")
def payload_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """payloads told apart by their first bytes (every fourth page stands in for a PDF file)."""
    raw = table(spark, sf, "pages").select("page_id", F.concat(F.when(F.col("page_id") % 4 == 1, F.lit("%PDF-1.4\n")).otherwise(F.lit("")), "html").cast("binary").alias("body"))
    kinds = [C.keep_type(raw, "body", k).withColumn("kind", F.lit(k)) for k in ("pdf", "html")]
    return M.union_strict(*kinds).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_page"),
                                                      F.sum(F.octet_length("body").cast("bigint")).alias("n_bytes"))


@query("links_by_year", sql=f"""
WITH {LINKS_SQL},
k AS (SELECT coalesce(nullif(regexp_extract(url, '(\\d+)', 1), ''), 'unknown') AS year, link FROM links)
SELECT year, count(*) AS n_links, count(DISTINCT link) AS n_distinct FROM k GROUP BY year
""")
def links_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """Links grouped by the first digit run of the page URL
    ('unknown' when none): counts and distinct links per group."""
    ln = links(spark, sf).withColumn(
        "year", F.coalesce(F.nullif(F.regexp_extract("url", r"(\d+)", 1), F.lit("")), F.lit("unknown")))
    return ln.groupBy("year").agg(F.count(F.lit(1)).alias("n_links"), F.count_distinct("link").alias("n_distinct"))


@query("unique_links_by_year", sql=f"""
WITH {LINKS_SQL}
SELECT DISTINCT coalesce(nullif(regexp_extract(url, '(\\d{{4}})', 1), ''), 'unknown') AS year, link FROM links
""")
def unique_links_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """A22 + X31 by value: the sorted distinct links of each URL year."""
    return A.sorted_unique_by(links(spark, sf).withColumn("year", X.url_year("url")), "year", "link")


def _plain_sql(text: str) -> str:
    for ref, ch in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = f"replace({text}, '{ref}', '{ch}')"
    return text


@query("page_text", sql=f"""
WITH v AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>', '<!>', 'g') AS h FROM pages),
p AS (SELECT page_id, h, list_transform(string_split_regex(h, '<p>')[2:], lambda x: list_filter(string_split_regex(
        string_split_regex(x, '</p>')[1], '<[^>]*>'), lambda y: y <> '')) AS ps FROM v),
t AS (SELECT page_id, array_to_string(list_filter(string_split_regex(h, '<[^>]*>'), lambda x: x <> ''), chr(10)) AS page,
  array_to_string(list_filter(list_transform(ps, lambda x: trim(array_to_string(x, ''), ' ' || chr(10))), lambda x: x <> ''), chr(10)) AS paras,
  array_to_string(list_filter(list_transform(ps, lambda x: array_to_string(list_transform(x, lambda y: trim(y, ' ' || chr(10))), '')),
                              lambda x: x <> ''), chr(10)) AS stripped FROM p),
d AS (SELECT page_id, {_plain_sql('page')} AS page, {_plain_sql('paras')} AS paras, {_plain_sql('stripped')} AS stripped FROM t)
SELECT page_id, CAST(length(paras) AS BIGINT) AS paragraph_chars, CAST(length(page) AS BIGINT) AS page_chars, md5(paras) AS paragraph_md5,
       md5(page) AS page_md5, md5(stripped) AS stripped_md5, CAST(0 AS BIGINT) AS n_tables FROM d
""")
def page_text(spark: SparkSession, sf: str) -> DataFrame:
    """D2 + D3: paragraph text (whole paragraphs stripped, and every text node stripped) and page text of each page."""
    pages = spread(table(spark, sf, "pages").select("page_id", "html"))
    t = MK.page_texts(pages.select("page_id", F.col("html").alias("url"), "html"))  # the page itself is kept for the second form
    return t.select("page_id", F.length("paragraph_text").cast("bigint").alias("paragraph_chars"),
                    F.length("page_text").cast("bigint").alias("page_chars"), F.md5("paragraph_text").alias("paragraph_md5"),
                    F.md5("page_text").alias("page_md5"), F.md5(MK.paragraph_text("url", strip_nodes=True)).alias("stripped_md5"), "n_tables")


def _order_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in pages with tables: one page per order, a table row per line item (seven at most). Other tables stand
    before and inside the table; closing tags are missing here and there."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")

    def made(x: Column) -> Column:
        s = lambda c: x[c].cast("string")
        odd = F.concat(F.lit("<tr><td> "), s("l_linenumber"), F.lit("\n</td><td>Part &amp; No.  "), s("l_partkey"), F.lit("<td class='wikitable'>"), s("l_returnflag"))
        even = F.concat(F.lit("<TR><th>"), s("l_linenumber"), F.lit("</th><TD>Part &#38; <i>No.</i> "), s("l_partkey"),
                        F.lit("<table class=inner><tr><td>inner</td></tr></table></TD><td>"), s("l_returnflag"), F.lit("<!-- <td> --></td></TR>"))
        return F.struct(x["l_linenumber"], x["l_partkey"], F.when(x["l_linenumber"] % 2 == 0, even).otherwise(odd).alias("row"))

    # The numbers travel; the text is made where a page's rows have come together.
    lines = rows.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag")).alias("lines"))
    body = lines.select("l_orderkey", F.array_join(F.transform(F.sort_array(F.transform("lines", made)), lambda x: x["row"]), "").alias("body"))
    head = F.lit("</table><p>Intro<table><tr><td>not this one</td></tr></table><table id='t' class=\"sortable wikitable\"><tr><th>Line<th>Part<th>Flag</tr>")
    tail = F.when(F.col("l_orderkey") % 2 == 0, F.lit("</table><table class=wikitable><tr><td>second</td></tr>")).otherwise(F.lit(""))
    return body.select(F.col("l_orderkey").alias("page_id"), F.concat(head, "body", tail).alias("html"))


@query("page_tables", sql="""
WITH l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_returnflag) AS n,
                  [CAST(l_linenumber AS VARCHAR), 'Part & No. ' || l_partkey, l_returnflag] AS c FROM lineitem)
SELECT l_orderkey AS page_id, CAST(1 AS BIGINT) AS table_pos, CAST(n + 1 AS BIGINT) AS row_pos, array_to_string(c, '|') AS cells FROM l
UNION ALL SELECT DISTINCT l_orderkey, 1, 1, 'Line|Part|Flag' FROM l
UNION ALL SELECT DISTINCT l_orderkey, 2, 1, 'second' FROM l WHERE l_orderkey % 2 = 0
""")
def page_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the tables of a class, one page per order."""
    return D.extract_tables(_order_pages(spark, sf)).withColumn("cells", F.array_join("cells", "|"))


# FIXED VALUES: URL templates filled per page.
TEMPLATES = ["{origin}/archive/{stem}", "{origin}/minutes?year={year}", "{origin}/meetings/{stem}.pdf"]


@query("url_parts", sql="""
WITH p AS (SELECT page_id, url,
    regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) AS origin,
    regexp_extract(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)', 1), '([^/]*)$', 1) AS base,
    coalesce(nullif(regexp_extract(url, '(\\d{4})', 1), ''), 'unknown') AS year
  FROM pages),
q AS (SELECT *, regexp_replace(base, '\\.[^.]*$', '') AS stem,
             regexp_replace(coalesce(url_decode(base), base), '[\\\\/*?:"<>|]', '_', 'g') AS safe_name FROM p)
SELECT page_id, CAST(t.pos AS BIGINT) AS template_pos,
  replace(replace(replace(t.tpl, '{origin}', origin), '{stem}', stem), '{year}', year) AS filled,
  stem AS url_stem, base AS url_basename, safe_name, year
FROM q, (SELECT unnest(['{origin}/archive/{stem}', '{origin}/minutes?year={year}', '{origin}/meetings/{stem}.pdf']) AS tpl,
                unnest([1, 2, 3]) AS pos) t
""")
def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    """X30 + X31 + X32 + J9: basename, stem, sanitised name, year and a short
    list of templates filled per page (an exploded literal array, no cross join)."""
    g = table(spark, sf, "pages").select("page_id", "url")
    g = g.select("page_id", "url",
                 F.regexp_extract("url", r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1).alias("origin"),
                 X.url_basename("url").alias("url_basename"), X.url_stem("url").alias("url_stem"),
                 X.safe_name("url").alias("safe_name"), X.url_year("url").alias("year"))
    t = g.select("*", F.posexplode(F.array(*[F.lit(x) for x in TEMPLATES])).alias("template_pos", "tpl"))
    filled = F.replace(F.replace(F.replace("tpl", F.lit("{origin}"), "origin"), F.lit("{stem}"), "url_stem"),
                       F.lit("{year}"), "year")
    return t.select("page_id", (F.col("template_pos") + 1).cast("bigint").alias("template_pos"),
                    filled.alias("filled"), "url_stem", "url_basename", "safe_name", "year")


@query("skip_landed", sql=f"""
WITH {LINKS_SQL},
all_links AS (SELECT DISTINCT link FROM links),
landed AS (SELECT DISTINCT link FROM links WHERE contains(url, '/en/'))
SELECT status, count(*) AS n FROM (
  SELECT CASE WHEN link IN (SELECT link FROM landed) THEN 'exists' ELSE 'to_download' END AS status FROM all_links)
GROUP BY status
""")
def skip_landed(spark: SparkSession, sf: str) -> DataFrame:
    """K8 + A21: links already landed (those harvested from English pages in
    an earlier run) are skipped; the rest are to be fetched; outcome counts."""
    ln = links(spark, sf)
    all_links = ln.select("link").distinct()
    landed = ln.filter(F.col("url").contains("/en/")).select("link").distinct()
    todo = K.skip_landed(all_links, landed, "link").withColumn("status", F.lit("to_download"))
    exists = M.matching_keys(all_links, landed, "link").withColumn("status", F.lit("exists"))
    return A.count_by(M.union_strict(todo, exists), "status", "n")
