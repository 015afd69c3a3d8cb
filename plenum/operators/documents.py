"""Document operators (D1-D12, D20): semi-structured text at scale.

Text work is built-in regex expressions over whole documents. Block splitting
uses the sentinel method: a control character is inserted in front of every
boundary match with ``regexp_replace`` and the text is split on it, which is
the same as "from this match to the next" without look-around and without
leaving the JVM.

Page structure (D1-D3, D20) lies in ``markup``: tags are cut by patterns and
nesting is counted over the pieces, in built-in expressions as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import scalar as X
from .markup import extract_links, extract_tables, page_text, page_texts  # noqa: F401

SENTINEL = "\u0001"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- splitting
def _unmarked(text: Column) -> Column:
    """The text without the control characters that mark boundaries."""
    return F.replace(F.replace(text, F.lit(SENTINEL), F.lit("")), F.lit("\u0002"), F.lit(""))


def pieces_after(text, boundary_re: str) -> Column:
    """Pieces between successive matches of ``boundary_re`` (text before the
    first match dropped), stripped, empty pieces removed."""
    marked = F.regexp_replace(_unmarked(_c(text)), boundary_re, SENTINEL + "$0")
    parts = F.slice(F.split(marked, SENTINEL), 2, 1 << 30)
    return F.filter(F.transform(parts, lambda p: X.strip(p)), lambda p: p != "")


def split_blocks(text) -> Column:
    """Project blocks of a minutes text, as an array.

    1. case headers (``98.226D – ...``) when they give at least two blocks;
    2. otherwise numbered agenda items (``1. ...``) when there is any;
    3. otherwise the whole stripped text as one block."""
    t = _c(text)
    by_case = pieces_after(t, P.CASE_HEADER_RE)
    by_item = pieces_after(t, P.AGENDA_ITEM_RE)
    has_item = t.rlike(P.AGENDA_ITEM_RE)
    return (F.when(F.size(by_case) >= 2, by_case)
            .when(has_item, by_item)
            .otherwise(F.array(X.strip(t))))


def with_blocks(df: DataFrame, text: str = "text", blocks: str = "blocks", mode: str | None = "mode") -> DataFrame:
    """D6 as a DataFrame step: adds the block array (and the rule that
    applied). The case-header split is staged in its own projection: it is
    referenced by the condition and by the value, and a column referenced
    several times is not inlined by Catalyst, so each document is split once
    instead of two or three times."""
    t = F.col(text)
    staged = df.withColumn("__by_case", pieces_after(t, P.CASE_HEADER_RE)) \
               .withColumn("__has_item", t.rlike(P.AGENDA_ITEM_RE))
    n_case = F.size("__by_case")
    out = staged.withColumn(blocks, F.when(n_case >= 2, F.col("__by_case"))
                            .when(F.col("__has_item"), pieces_after(t, P.AGENDA_ITEM_RE))
                            .otherwise(F.array(X.strip(t))))
    if mode:
        out = out.withColumn(mode, F.when(n_case >= 2, F.lit("case")).when(F.col("__has_item"), F.lit("item"))
                             .otherwise(F.lit("whole")))
    return out.drop("__by_case", "__has_item")


def _raw_pieces(text: Column, boundary_re: str) -> Column:
    marked = F.regexp_replace(_unmarked(text), boundary_re, SENTINEL + "$0")
    return F.slice(F.split(marked, SENTINEL), 2, 1 << 30)


def explode_block_rows(df: DataFrame, keys, text: str = "text", out: str = "block", pos: str = "pos",
                       mode: str | None = "mode") -> DataFrame:
    """D6 + W3 as rows: one row per block with its 1-based ordinal.

    Fast path of ``with_blocks`` + ``explode_blocks``: both boundary patterns
    match non-blank text (the case code, the item number), so no piece after a
    boundary is blank and the 'drop empty pieces' step is a no-op; the raw
    pieces are exploded and each is stripped in a flat projection (whole-stage
    codegen) instead of interpreted array lambdas. Same result as
    ``split_blocks``."""
    from .aggregate import explode_nonempty

    t = F.col(text)
    staged = df.select(*keys, text, _raw_pieces(t, P.CASE_HEADER_RE).alias("__case"),
                       t.rlike(P.AGENDA_ITEM_RE).alias("__item"))
    n_case = F.size("__case")
    m = F.when(n_case >= 2, F.lit("case")).when(F.col("__item"), F.lit("item")).otherwise(F.lit("whole"))
    raw = (F.when(n_case >= 2, F.col("__case"))
           .when(F.col("__item"), _raw_pieces(t, P.AGENDA_ITEM_RE))
           .otherwise(F.array(t)))
    staged = staged.select(*keys, m.alias("__mode"), raw.alias("__raw"))
    rows = explode_nonempty(staged, [*keys, "__mode"], "__raw", (pos, out))
    cols = [*keys] + ([F.col("__mode").alias(mode)] if mode else [])
    return rows.select(*cols, (F.col(pos) + 1).alias(pos), X.strip(out).alias(out))


def block_mode(text) -> Column:
    """Which rule of D6 applied: 'case', 'item' or 'whole'."""
    t = _c(text)
    return (F.when(F.size(pieces_after(t, P.CASE_HEADER_RE)) >= 2, F.lit("case"))
            .when(t.rlike(P.AGENDA_ITEM_RE), F.lit("item")).otherwise(F.lit("whole")))


def tag_blocks(blocks) -> Column:
    """Wrap each block in start/end tags, one per line."""
    return F.array_join(F.transform(_c(blocks), lambda b: F.concat_ws(
        "\n", F.lit(P.PROJECT_START), X.rstrip(b), F.lit(P.PROJECT_END))), "\n")


def untag_blocks(tagged) -> Column:
    """The stripped contents of every tagged block, in order."""
    return F.transform(F.regexp_extract_all(_c(tagged), F.lit(P.BLOCK_RE), 1), lambda b: X.strip(b))


def explode_blocks(df: DataFrame, blocks_col: str, out: str = "block", pos: str = "pos",
                   repartition: int | None = None) -> DataFrame:
    """One row per block with its 1-based ordinal (W3). Documents are few and
    large; blocks are many and small, so callers may spread them again."""
    keep = [c for c in df.columns if c != blocks_col]
    from .aggregate import explode_nonempty

    res = explode_nonempty(df, keep, blocks_col, (pos, out)).withColumn(pos, F.col(pos) + 1)
    return res.repartition(repartition) if repartition else res


def split_meetings(html) -> Column:
    """Cut a page at named anchors ``<a name="m_d_yy">``; the part before
    the first anchor is dropped; a page without anchors is one meeting named
    'single'. Returns array<struct<anchor, html>>."""
    marked = F.regexp_replace(_unmarked(_c(html)), P.NAMED_ANCHOR_RE, SENTINEL + "$1" + "\u0002")
    single = F.array(F.struct(F.lit("single").alias("anchor"), _c(html).alias("html")))

    def meetings(parts: Column) -> Column:
        cut = F.transform(parts, lambda p: F.struct(F.substring_index(p, "\u0002", 1).alias("anchor"),
                                                    F.substring_index(p, "\u0002", -1).alias("html")))
        return F.when(F.size(parts) > 0, cut).otherwise(single)

    return X.bound(F.slice(F.split(marked, SENTINEL), 2, 1 << 30), meetings)


def extract_dates(text) -> Column:
    """Every month-name date in the text, distinct, in first-seen order."""
    return F.array_distinct(F.regexp_extract_all(_c(text), F.lit(P.DATE_RE), 1))


def _first(text, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(_c(text), pattern, group)


def meeting_header(text) -> Column:
    """Struct of date, day_of_week, meeting_type, location, present,
    absent, staff — the first match of each; multi-line fields squashed."""
    t = _c(text)
    return F.struct(
        X.strip(_first(t, P.DATE_RE)).alias("date"),
        X.strip(_first(t, P.DAY_RE)).alias("day_of_week"),
        X.strip(_first(t, P.MEET_TYPE_RE)).alias("meeting_type"),
        X.location_line(t).alias("location"),
        X.squash(_first(t, P.PRESENT_RE)).alias("present"),
        X.squash(_first(t, P.ABSENT_RE)).alias("absent"),
        X.squash(_first(t, P.STAFF_RE)).alias("staff"),
    )


def meetings_of_pages(pages: DataFrame, keys, year: str = "year", slug: str = "slug", url: str = "url", html: str = "html",
                      pos: str = "meeting_pos") -> DataFrame:
    """D4 + D3 + D9 + X27 + D6 + D7 + X28: one row per meeting of a page, with its 1-based ordinal, anchor, header
    fields, ``source_url``, ``file_key`` and ``tagged`` text. A meeting without a month-name date takes the date of its
    anchor, without either the file is named after year, slug and ordinal. A null page is one meeting with empty text."""
    from .aggregate import explode_nonempty

    own = pages.select(F.struct(*keys).alias("__keys"), F.col(year).alias("__year"), F.col(slug).alias("__slug"),
                       F.col(url).alias("__url"), F.col(html).alias("__html"))
    held = ["__keys", "__year", "__slug", "__url"]
    cut = explode_nonempty(own, held, split_meetings("__html"), ("__i", "__m"))
    text = cut.select(*held, (F.col("__i") + 1).cast("bigint").alias("__pos"), F.col("__m.anchor").alias("__anchor"),
                      page_text("__m.html").alias("__text"))
    rows = with_blocks(text, "__text", "__blocks", mode=None).select(
        *held, "__pos", "__anchor", meeting_header("__text").alias("__h"), tag_blocks("__blocks").alias("__tagged"))
    date = F.when(F.col("__h.date") == "", X.anchor_date("__anchor")).otherwise(F.col("__h.date"))
    rows = rows.withColumn("__date", date)
    fields = [F.col(f"__h.{c}").alias(c) for c in ("day_of_week", "meeting_type", "location", "present", "absent", "staff")]
    return rows.select("__keys.*", F.col("__year").alias(year), F.col("__pos").alias(pos), F.col("__anchor").alias("anchor"),
                       F.col("__date").alias("date"), *fields, F.col("__url").alias("source_url"),
                       X.file_key("__date", "__year", "__slug", "__pos").alias("file_key"), F.col("__tagged").alias("tagged"))


def case_code(block, lenient: bool = False) -> Column:
    """D10 + X16: normalised case code of a block ('' when none). ``lenient``
    also accepts a suffix separated by one space."""
    pat = P.CASE_CODE_RE if not lenient else r"\b((?:\d{2}|\d{4})\.\d{3,}(?: ?[A-Z0-9/]+)?)\b"
    return X.normalise_case(_first(block, pat))


def parse_items(text) -> Column:
    """Modern minutes items -> array of structs (item_num, code, staff,
    title, address, action, aye_votes, nay_votes, motion_or_resolution,
    speakers_count, speakers_raw). Values may sit on the line after their
    label. Text before the first item is dropped, and so are items whose first
    line names no staff in parentheses."""
    blocks = pieces_after(text, P.ITEM_HEADER_RE)
    return F.transform(F.filter(blocks, _has_staff), _item_fields)


def _has_staff(b: Column) -> Column:
    return F.substring_index(b, "\n", 1).rlike(P.ITEM_STAFF_RE)


def item_rows(df: DataFrame, keys, text: str = "text", pos: str = "pos") -> DataFrame:
    """D11 as rows: one row per item with its 1-based ordinal (items without
    staff are counted, but left out) and the fields of ``parse_items``. The item header always matches non-blank text, so the
    raw pieces are exploded and parsed in a flat projection (codegen) rather
    than inside an array lambda."""
    from .aggregate import explode_nonempty

    staged = df.select(*keys, _raw_pieces(F.col(text), P.ITEM_HEADER_RE).alias("__items"))
    rows = explode_nonempty(staged, keys, "__items", (pos, "__b"))
    rows = rows.select(*keys, (F.col(pos) + 1).alias(pos), X.strip("__b").alias("__b")).where(_has_staff(F.col("__b")))
    return rows.select(*keys, pos, _item_fields(F.col("__b")).alias("__f")).select(*keys, pos, "__f.*")


def _item_fields(b: Column) -> Column:
    """Fields of one stripped item block."""
    lines = F.split(b, "\n")
    rest = F.filter(F.slice(lines, 2, 1 << 30), lambda l: (X.strip(l) != "") & ~X.strip(l).startswith("("))
    sp = F.regexp_extract(b, P.SPEAKERS_RE, 1)
    sp_list = F.transform(F.regexp_extract_all(X.strip(sp), F.lit(P.SPEAKER_LINE_RE), 0), lambda s: X.strip(s))

    def opt(pattern: str, g: int = 1) -> Column:
        v = F.regexp_extract(b, pattern, g)
        return F.when(v != "", X.strip(v))

    addr = F.regexp_extract(b, P.ADDRESS_RE, 1)
    return F.struct(
        F.regexp_extract(b, r"^(\d{1,2})[a-zA-Z]?\.", 1).alias("item_num"),
        F.regexp_extract(b, r"^\d{1,2}[a-zA-Z]?\.\s+(\d{4}-\d{6,}[A-Z]*)", 1).alias("code"),
        F.regexp_extract(b, P.ITEM_STAFF_RE, 1).alias("staff"),
        F.coalesce(X.strip(F.get(rest, 0)), F.lit("")).alias("title"),
        F.when(addr != "", X.title_address(addr)).alias("address"),
        opt(P.ACTION_RE).alias("action"),
        opt(P.AYES_RE).alias("aye_votes"),
        opt(P.NAYS_RE).alias("nay_votes"),
        opt(P.MOTION_RE, 2).alias("motion_or_resolution"),
        F.size(sp_list).cast("bigint").alias("speakers_count"),
        F.array_join(sp_list, "; ").alias("speakers_raw"),
    )


def speakers(block) -> Column:
    """Speaker entries (from a +, = or - sign to the end of its line; a name
    may follow on the next line) with their stance: + for, - against, = neutral."""
    lst = F.transform(F.regexp_extract_all(_c(block), F.lit(P.SPEAKER_LINE_RE), 0), lambda s: X.strip(s))
    return F.transform(lst, lambda s: F.struct(
        X.strip(F.substring(s, F.lit(2), F.length(s))).alias("name"),
        F.when(s.startswith("+"), F.lit("for")).when(s.startswith("-"), F.lit("against"))
        .otherwise(F.lit("neutral")).alias("stance")))


# ---------------------------------------------------------------- HTML
def href_links(html) -> Column:
    """D1 fast path: every double- or single-quoted ``href`` of an <a> tag."""
    return F.regexp_extract_all(_c(html), F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), 1)
