"""Page structure in built-in expressions: anchors (D1), paragraph text (D2),
page text (D3) and table rows (D20), without a Python parser.

A page is cut at tags by regular expressions; container and table nesting is
counted over the pieces. Rules for broken markup: an unclosed tag runs to the
end of the page, a new ``<p>`` or ``<a>`` ends an open one, a stray closing tag
changes nothing, quoted attribute values may hold ``>``, and a ``<`` that starts
no tag is text. Comments, scripts, styles and templates hold no text.

Every function takes a Column (or its name) of whole pages and needs no shuffle.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import scalar as X
from .aggregate import explode_nonempty

# Attributes of a tag up to its end; a quoted value may hold any character but its quote.
_ATTRS = r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+"""
_TAG = rf"""<(?:/?[a-zA-Z]{_ATTRS}>|[a-zA-Z/!?][^>]*+(?:>|\z))"""
_SILENT = (r"(?is)<(?:!--.*?(?:-->|\z)|script\b[^>]*+>.*?(?:</script\s*+>|\z)|style\b[^>]*+>.*?(?:</style\s*+>|\z)"
           r"|template\b[^>]*+>.*?(?:</template\s*+>|\z))")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _rest(a: Column) -> Column:
    """An array without its first element."""
    return F.slice(a, 2, F.greatest(F.size(a), F.lit(1)))


def visible(html) -> Column:
    """The page with an empty mark in place of each comment, script, style and template; null counts as empty."""
    return F.regexp_replace(F.coalesce(_c(html), F.lit("")), _SILENT, "<!>")


def _chr(code: Column) -> Column:
    """Character of a code point; what is none becomes U+FFFD. 128 to 159 stand for the Windows characters, as browsers read them."""
    windows = {i: bytes([i]).decode("cp1252", "replace") for i in range(128, 160)}
    low = F.create_map(*[F.lit(x) for i, ch in windows.items() if ch != "�" for x in (i, ch)])
    odd = code.isNull() | (code <= 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(code.between(1, 127), F.char(code)).when(odd, F.lit("�")).when(code.between(128, 159), F.coalesce(F.try_element_at(low, code.cast("int")), plain)).otherwise(plain)


def decode_entities(c) -> Column:
    """Character references: decimal and hexadecimal ones (the semicolon may be missing) and the named ones of HTML 4
    and ``&apos;`` (with their semicolon). Others stay as they are."""
    names = F.create_map(*[F.lit(x) for n, code in [*sorted(name2codepoint.items()), ("apos", 39)] for x in (n, chr(code))])

    def one(part: Column) -> Column:
        number = r"^#(?:[xX][0-9a-fA-F]{1,8}|[0-9]{1,9});?"
        decimal, hexa = F.regexp_extract(part, r"^#([0-9]{1,9})", 1), F.regexp_extract(part, r"^#[xX]([0-9a-fA-F]{1,8})", 1)
        code = X.bound(decimal, lambda d: F.when(d != "", d.cast("bigint")).otherwise(F.conv(hexa, 16, 10).cast("bigint")))
        named = F.regexp_extract(part, r"^([a-zA-Z][a-zA-Z0-9]*);", 1)
        known = X.bound(named, lambda name: F.concat(F.try_element_at(names, name), F.substring(part, F.length(name) + 2, F.length(part))))
        return (F.when(part.startswith("amp;"), F.concat(F.lit("&"), F.substring(part, F.lit(5), F.length(part))))
                .when(part.rlike(number), F.concat(X.bound(code, _chr), F.regexp_replace(part, number, "")))
                .otherwise(F.coalesce(known, F.concat(F.lit("&"), part))))

    def decoded(text: Column) -> Column:
        cut = X.bound(F.split(text, "&"), lambda parts: F.concat(parts[0], F.array_join(F.transform(_rest(parts), one), "")))
        return F.when(text.contains("&"), cut).otherwise(text)

    return X.bound(c, decoded)


def _nodes(html: Column) -> Column:
    return F.filter(F.split(html, _TAG), lambda s: s != "")


def page_text(html) -> Column:
    """D3: all text nodes joined by newlines (blank ones stay), character references decoded."""
    return decode_entities(F.array_join(_nodes(visible(html)), "\n"))


def paragraphs(html, strip_nodes: bool = False) -> Column:
    """D2 as an array: the stripped text of each ``<p>``; empty ones are left out. With ``strip_nodes`` each text node
    is stripped before they are joined, so words that only blanks at a tag kept apart run together."""
    opened = rf"""(?i)<p(?:[\s/]{_ATTRS})?>"""
    own = F.transform(_rest(F.split(visible(html), opened)), lambda s: F.split(s, r"(?i)</p\s*+>", 2)[0])
    if strip_nodes:
        texts = F.transform(own, lambda s: F.array_join(F.transform(_nodes(s), lambda n: X.strip(decode_entities(n))), ""))
    else:
        texts = F.transform(own, lambda s: X.strip(decode_entities(F.array_join(_nodes(s), ""))))
    return F.filter(texts, lambda s: s != "")


def paragraph_text(html, strip_nodes: bool = False) -> Column:
    """Non-empty paragraph texts joined by newlines."""
    return F.array_join(paragraphs(html, strip_nodes), "\n")


def container(html: Column, container_id: str) -> Column:
    """What the first element with this id holds, null if there is none. Its end is found by counting the tags of its
    own name; without an end it runs to the end of the page."""
    opening = rf"""(?i)<([a-z][a-z0-9]*)(?:\s(?:[^"'>]|"[^"]*"|'[^']*')*?)?\sid\s*=\s*["']?{_quote(container_id)}(?=["'\s>]){_TAIL}>"""
    name = F.lower(F.regexp_extract(html, opening, 1))
    after = F.concat(F.lit(" "), F.split(html, opening, 2)[1])  # a first piece before any tag of that name
    pieces = F.split(after, F.concat(F.lit("(?i)(?=</?"), name, F.lit(r"[\s/>])")))

    def step(s: Column, piece: Column) -> Column:
        depth = s["depth"] + F.when(piece.startswith("</"), -1).otherwise(1)
        return F.struct(depth.alias("depth"), (s["seen"] + 1).alias("seen"),
                        F.when((s["end"] == 0) & (depth == 0), s["seen"]).otherwise(s["end"]).alias("end"))

    state = F.struct(F.lit(1).alias("depth"), F.lit(1).alias("seen"), F.lit(0).alias("end"))
    end = F.aggregate(_rest(pieces), state, step, lambda s: s["end"])
    return F.when(name != "", F.array_join(F.when(end > 0, F.slice(pieces, 1, end)).otherwise(pieces), ""))


_TAIL = r"""["']?(?:[^"'>]|"[^"]*"|'[^']*')*?"""


def _quote(text: str) -> str:
    return "".join(ch if ch.isalnum() or ch == "_" else "\\" + ch for ch in text)


def anchors(html, container_id: str | None = P.CONTENT_ID) -> Column:
    """D1 as an array of (href, text): every ``<a>`` with an href (stripped) and its text (stripped), in the element
    with ``container_id`` if the page has it, else on the whole page."""
    page = visible(html)
    region = F.coalesce(F.when(page.contains(container_id), container(page, container_id)), page) if container_id else page
    pieces = _rest(F.split(region, r"(?i)<a(?=[\s/>])"))
    attrs = rf"^({_ATTRS})>"
    href = r"""(?i)(?:^|[\s"'/])href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""

    def one(piece: Column) -> Column:
        own = F.regexp_extract(piece, attrs, 1)
        text = F.array_join(_nodes(F.split(F.regexp_replace(piece, attrs, ""), r"(?i)</a\s*+>", 2)[0]), "")
        target = F.concat(*[F.regexp_extract(own, href, i) for i in (1, 2, 3)])
        return F.struct(own.rlike(href).alias("linked"), X.strip(decode_entities(target)).alias("href"), X.strip(decode_entities(text)).alias("text"))

    linked = F.filter(F.transform(pieces, one), lambda s: s["linked"])
    return F.transform(linked, lambda s: F.struct(s["href"].alias("href"), s["text"].alias("text")))


# ---------------------------------------------------------------- DataFrames

def extract_links(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  container_id: str | None = P.CONTENT_ID) -> DataFrame:
    """One row per anchor: page id, url, 1-based position, href, text."""
    rows = explode_nonempty(pages, [id_col, url_col], anchors(html_col, container_id), ("pos", "a"))
    return rows.select(id_col, url_col, (F.col("pos") + 1).cast("bigint").alias("pos"), "a.href", "a.text")


def page_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """D2 + D3: paragraph text, page text and the number of tables of every page."""
    tables = F.size(F.split(visible(html_col), r"(?i)<table(?=[\s/>])")) - 1
    return pages.select(id_col, url_col, paragraph_text(html_col).alias("paragraph_text"), page_text(html_col).alias("page_text"),
                        tables.cast("bigint").alias("n_tables"))


_CELL_EDGE = r"(?i)(?=</?(?:table|tr|td|th)[\s/>])"


def _tables(html: Column, table_class: str | None) -> Column:
    """The tables of a page with ``table_class`` as an array of (number in the page's order, what lies in the table itself).
    The page is cut at the tags of tables only; a fold keeps the open tables, and each cut goes to the innermost one
    when that table ends. A stray end changes nothing, and the tables still open at the end of the page end there."""
    inside = rf"^<[a-zA-Z]({_ATTRS})>"

    def wanted(piece: Column) -> Column:
        if not table_class:
            return F.lit(True)
        cls = r"""(?i)\sclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
        classes = X.bound(F.regexp_extract(F.split(piece, _CELL_EDGE, 2)[0], inside, 1),
                          lambda own: F.split(F.concat(*[F.regexp_extract(own, cls, i) for i in (1, 2, 3)]), r"\s+"))
        return piece.contains(table_class) & F.array_contains(classes, table_class)

    def kind(piece: Column) -> Column:  # 1: a wanted table begins, 0: another one, -1: one ends; null: neither
        return F.when(piece.rlike("(?i)^<table(?![a-z])"), F.when(wanted(piece), 1).otherwise(0)).when(piece.rlike("(?i)^</table(?![a-z])"), -1)

    pieces = F.transform(F.split(html, r"(?i)(?=</?table[\s/>])"), lambda p: F.struct(kind(p).alias("kind"), p.alias("piece")))
    none = F.array().cast("array<struct<no:int,own:array<string>>>")
    start = F.struct(F.lit(0).alias("n"), none.alias("open"), none.alias("done"))

    def step(s: Column, p: Column) -> Column:
        begins, ends, depth = p["kind"] >= 0, p["kind"] < 0, F.size(s["open"])
        n = s["n"] + F.greatest(p["kind"], F.lit(0))
        own = F.when(p["kind"] == 1, F.array(p["piece"])).otherwise(F.array().cast("array<string>"))
        fresh = F.struct(F.when(p["kind"] == 1, n).otherwise(F.lit(0)).alias("no"), own.alias("own"))
        outer = F.get(s["open"], depth - 2)
        resumed = F.struct(outer["no"].alias("no"), F.when(outer["no"] > 0, F.concat(outer["own"], F.array(p["piece"]))).otherwise(outer["own"]).alias("own"))
        closed = F.when(depth == 1, none).otherwise(F.concat(F.slice(s["open"], 1, F.greatest(depth - 2, F.lit(0))), F.array(resumed)))
        ended = F.when(F.get(s["open"], depth - 1)["no"] > 0, F.concat(s["done"], F.slice(s["open"], depth, 1))).otherwise(s["done"])
        after = F.struct(n.alias("n"), F.concat(s["open"], F.array(fresh)).alias("open"), s["done"].alias("done"))
        back = F.struct(s["n"].alias("n"), closed.alias("open"), ended.alias("done"))
        return F.when(begins, after).when(ends & (depth > 0), back).otherwise(s)

    found = F.aggregate(pieces, start, step, lambda s: F.concat(s["done"], F.filter(s["open"], lambda t: t["no"] > 0)))
    return F.transform(found, lambda t: F.struct(t["no"].alias("no"), F.array_join(t["own"], "").alias("own")))


def extract_tables(pages: DataFrame, table_class: str | None = P.TABLE_CLASS, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per table row: page id, 1-based number of the table on its page (among those with
    ``table_class``), 1-based row number, and the cells' texts with single blanks. A row belongs to the innermost
    table around it; a cell ends where another table, row or cell begins or ends. Pages are read one by one: no shuffle."""
    tables = explode_nonempty(pages, [id_col], _tables(visible(html_col), table_class), ("__t",), with_pos=False)
    rows = explode_nonempty(tables, [id_col, F.col("__t.no").alias("__no")], _rest(F.split("__t.own", r"(?i)(?=<tr[\s/>])")), ("__row", "__own"))

    def cell(piece: Column) -> Column:
        text = F.regexp_replace(piece, rf"^</?[a-zA-Z]{_ATTRS}>|^<[^>]*+(?:>|\z)|{_TAG}", "")
        return X.strip(F.regexp_replace(decode_entities(text), r"[\s\p{Z}]+", " "))

    cells = F.transform(F.filter(F.split("__own", _CELL_EDGE), lambda p: p.rlike("(?i)^<t[dh]")), cell)
    return rows.select(id_col, F.col("__no").cast("bigint").alias("table_pos"), (F.col("__row") + 1).cast("bigint").alias("row_pos"), cells.alias("cells"))
