"""Column functions (Column -> Column). All built-in expressions, so they stay
inside whole-stage codegen; none of them calls Python per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value, fn) -> Column:
    """``fn`` of a value that it names in several places, as a lambda's variable: computed once, not once a place."""
    return F.get(F.transform(F.array(_c(value)), lambda v: fn(v)), 0)


# ---------------------------------------------------------------- arithmetic
def share(v, total) -> Column:
    """V / total, NULL when the total is zero or NULL."""
    return F.try_divide(_c(v).cast("double"), _c(total).cast("double"))


def residual(total, a, b, corrected: bool = False) -> Column:
    """Residual count. Literal form is total - (a - b); the corrected form
    is total - a - b."""
    if corrected:
        return _c(total) - _c(a) - _c(b)
    return _c(total) - (_c(a) - _c(b))


def monthly_payment(value, rate, rate_scale: float = 1.0, down: float = 0.8,
                    months: int = 360) -> Column:
    """Amortised monthly payment on ``down`` of ``value``.

    ``rate`` is used as read divided by ``rate_scale`` (1 reproduces a rate in
    percent points used as a fraction; 100 converts percent to a fraction)."""
    r = _c(rate).cast("double") / F.lit(rate_scale) / F.lit(12.0)
    return F.lit(down) * _c(value) * F.try_divide(r, F.lit(1.0) - F.lit(1.0) / F.pow(F.lit(1.0) + r, F.lit(months)))


def payment_burden(payment, income) -> Column:
    """12 * payment / income * 100."""
    return F.try_divide(_c(payment) * 12.0, _c(income)) * 100.0


def qualifying_income(payment) -> Column:
    """Payment * 4 * 12."""
    return _c(payment) * 4.0 * 12.0


def affordability_index(income, payment) -> Column:
    """Income / qualifying income * 100."""
    return F.try_divide(_c(income), qualifying_income(payment)) * 100.0


def pct_change(a, b) -> Column:
    """(b - a) / a."""
    return F.try_divide(_c(b) - _c(a), _c(a))


def gap(a, b) -> Column:
    """A - b."""
    return _c(a) - _c(b)


# ---------------------------------------------------------------- dates
def to_year(c) -> Column:
    """Calendar year of a date/timestamp/ISO string."""
    return F.year(F.to_date(_c(c)))


def parse_long_date(c) -> Column:
    """X8b: 'October 14, 2004' -> date; NULL when it does not parse. Runs of
    blanks (no-break ones too) count as one."""
    plain = F.regexp_replace(_c(c), r"[\s\p{Z}]+", " ")
    return F.to_date(F.try_to_timestamp(plain, F.lit("MMMM d, yyyy")))


def date_slug(d) -> Column:
    """Date -> 'october-14-2004'."""
    return F.lower(F.date_format(_c(d), "MMMM-dd-yyyy"))


def parse_weekday_date(c) -> Column:
    """X10: 'Thursday, October 14, 2004' -> date. The weekday is dropped first
    (Spark cannot parse full weekday names); a date without the comma after the
    weekday or the day gives NULL rather than an error."""
    starts = "(?=[MTWFmtwf])" + P.HEADER_DATE_RE  # a look at one letter spares the list of weekdays at most places
    return bound(F.regexp_extract(_c(c), starts, 0), lambda found: F.when(
        found.rlike(r"^[A-Za-z]+,[\s\p{Z}]"), parse_long_date(F.regexp_replace(found, r"^[A-Za-z]+,[\s\p{Z}]*", ""))))


def expand_year(yy) -> Column:
    """X11: two-digit year -> four-digit string; >50 -> 19yy, <50 -> 20yy, 50 -> NULL."""
    s = F.lpad(_c(yy).cast("string"), 2, "0")
    n = _c(yy).cast("int")
    return (F.when(n > 50, F.concat(F.lit("19"), s))
            .when(n < 50, F.concat(F.lit("20"), s)))


# ---------------------------------------------------------------- JSON-ish text
def outer_object(c) -> Column:
    """Text from the first '{' to the last '}', else the raw text."""
    return F.regexp_replace(_c(c), r"(?s)\A[^{]*+(\{.*\})[^}]*+\z", "$1")


def clean_block_no(c) -> Column:
    """Leading 1-4 digits (after optional blanks), else the stripped input."""
    m = F.regexp_extract(_c(c), r"^\s*(\d{1,4})\b", 1)
    return F.when(m != "", m).otherwise(strip(_c(c)))


def normalise_case(c) -> Column:
    """Remove spaces, upper-case; NULL -> ''."""
    return F.upper(F.replace(F.coalesce(_c(c), F.lit("")), F.lit(" "), F.lit("")))


def squash(c) -> Column:
    """Collapse whitespace runs to one space and strip."""
    return strip(F.regexp_replace(_c(c), r"(?U)\s+", " "))


# The characters that ``(?U)\s`` matches.
_BLANKS = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c) -> Column:
    """Unicode-aware strip (Java ``trim`` is ASCII-only); looks at the ends of the text only."""
    return F.btrim(_c(c), F.lit(_BLANKS))


def rstrip(c) -> Column:
    """Unicode-aware right strip."""
    return F.rtrim(_c(c), F.lit(_BLANKS))


def head_lines(c, k: int = 20) -> Column:
    """The first ``k`` lines of a text, as an array."""
    return F.slice(F.split(_c(c), "\n"), 1, k)


def first_match(c, pattern: str, group: int = 0) -> Column:
    """T4: the first match of ``pattern`` (or one of its groups); '' when none."""
    return F.regexp_extract(_c(c), pattern, group)


def block_header(c, n: int = 120) -> Column:
    """First line, first ``n`` characters."""
    return F.substring(F.substring_index(_c(c), "\n", 1), 1, n)


def before_token(c, tok: str = P.TERMINATOR) -> Column:
    """Text before the terminator token (all of it when absent)."""
    return F.substring_index(_c(c), tok, 1)


def split_names(c) -> Column:
    """Split on ',' and strip each name; empty names dropped."""
    parts = F.transform(F.split(_c(c), ","), lambda x: strip(x))
    return F.filter(parts, lambda x: x != "")


def title_address(c) -> Column:
    """Title-case an address."""
    return F.initcap(F.lower(_c(c)))


def first_char(c) -> Column:
    """Keep the first character of a longer code."""
    return F.when(F.length(_c(c)) > 1, F.substring(_c(c), 1, 1)).otherwise(_c(c))


def sub_first(c, pattern: str, replacement: str) -> Column:
    """Replace the first occurrence of ``pattern`` (a literal char or
    simple class) — anchored so only the first match changes."""
    return F.regexp_replace(_c(c), f"(?s)^(.*?){pattern}", f"$1{replacement}")


def concat_key(*cols) -> Column:
    """Concatenated key."""
    return F.concat(*[_c(c).cast("string") for c in cols])


def control(gov, upper, lower, unicameral=None) -> Column:
    """Trifecta ladder. All three D -> D; all three R -> R; a split
    chamber (S) -> Split; any other governor in D/R/I with both chambers in D/R
    -> Split; anything else NULL. ``unicameral`` marks rows that get '-'."""
    g, u, lo = _c(gov), _c(upper), _c(lower)
    both_dr = u.isin("D", "R") & lo.isin("D", "R")
    ladder = (F.when((u == "S") | (lo == "S"), F.lit("Split"))
              .when((g == "D") & (u == "D") & (lo == "D"), F.lit("D"))
              .when((g == "R") & (u == "R") & (lo == "R"), F.lit("R"))
              .when(g.isin("D", "R", "I") & both_dr, F.lit("Split")))
    if unicameral is not None:
        return F.when(_c(unicameral), F.lit("-")).otherwise(ladder)
    return ladder


def location_line(text, n_lines: int = P.HEADER_LINES) -> Column:
    """First all-caps line among the first ``n_lines`` that contains
    ROOM, HALL or BUILDING; '' when none."""
    lines = F.split(F.substring_index(_c(text), "\n", n_lines), "\n")

    def hit(l: Column) -> Column:
        named = F.lit(False)
        for word in P.LOCATION_WORDS:
            named = named | l.contains(word)
        return named & (l == F.upper(l))  # the words are in capitals themselves

    hits = F.filter(lines, hit)
    return F.coalesce(strip(F.get(hits, 0)), F.lit(""))


def anchor_date(name) -> Column:
    """Anchor 'm_d_yy' -> 'MM/DD/19yy'; '' when the name has no such part."""
    pat = r"(\d{1,2})_(\d{1,2})_(\d{2})"
    m, d, y = (F.regexp_extract(_c(name), pat, i) for i in (1, 2, 3))
    return F.when(m != "", F.concat(F.lpad(m.cast("int").cast("string"), 2, "0"), F.lit("/"),
                                    F.lpad(d.cast("int").cast("string"), 2, "0"), F.lit("/19"), y)) \
            .otherwise(F.lit(""))


def file_key(date, year, slug, i) -> Column:
    """File key from a date ('October 14, 2004' -> 'October_14_2004',
    '01/08/98' -> '01-08-98'), or ``year_slug_i`` when the date is empty."""
    k = F.replace(F.replace(F.replace(_c(date), F.lit(","), F.lit("")), F.lit("/"), F.lit("-")),
                  F.lit(" "), F.lit("_"))
    return F.coalesce(F.nullif(k, F.lit("")),
                      F.concat_ws("_", _c(year).cast("string"), _c(slug).cast("string"), _c(i).cast("string")))


# ---------------------------------------------------------------- URLs
def resolve_url(base, href) -> Column:
    """Resolve ``href`` against ``base`` (RFC 3986 common cases: absolute,
    protocol-relative, root-relative, query-only, fragment-only, relative with
    ./ and ../ segments)."""
    b, h = _c(base), strip(_c(href))
    scheme = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    origin = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    base_nofrag = F.regexp_replace(b, r"#.*$", "")
    base_noquery = F.regexp_replace(base_nofrag, r"\?.*$", "")
    base_path = F.regexp_extract(base_noquery, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/.*)?$", 1)
    base_dir = F.regexp_replace(F.coalesce(F.nullif(base_path, F.lit("")), F.lit("/")), r"[^/]*$", "")
    href_path = F.regexp_extract(h, r"^([^?#]*)", 1)
    href_rest = F.substring(h, F.length(href_path) + 1, 1 << 30)
    merged = F.when(href_path.startswith("/"), href_path).otherwise(F.concat(base_dir, href_path))
    normalised = _remove_dot_segments(merged)
    relative = F.concat(origin, normalised, href_rest)
    return (F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
            .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
            .when(h == "", base_nofrag)
            .when(h.startswith("#"), F.concat(base_nofrag, h))
            .when(h.startswith("?"), F.concat(base_noquery, h))
            .otherwise(relative))


def _remove_dot_segments(path: Column) -> Column:
    """Drop '.' segments and fold '..' against the previous segment."""
    segs = F.split(path, "/")
    # Fold left: keep a stack as an array; '..' pops, '.' is skipped.
    folded = F.aggregate(
        F.slice(segs, F.lit(2), F.size(segs)),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    last = F.element_at(segs, -1)
    trail = F.when(last.isin(".", "..") & (F.size(segs) > 1), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(folded, "/"), trail)


def url_path(c) -> Column:
    return F.regexp_extract(_c(c), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def url_basename(c) -> Column:
    """Last path segment."""
    return F.regexp_extract(url_path(c), r"([^/]*)$", 1)


def url_stem(c) -> Column:
    """Basename without its extension."""
    return F.regexp_replace(url_basename(c), r"\.[^.]*$", "")


def safe_name(c) -> Column:
    """Url-decoded basename with characters illegal in file names -> '_'."""
    dec = F.coalesce(F.try_url_decode(url_basename(c)), url_basename(c))
    return F.regexp_replace(dec, P.ILLEGAL_NAME_CHARS_RE, "_")


def url_year(c, default: str | None = "unknown", mode: str = "any") -> Column:
    """First 4-digit run (mode='any'), or a '/yyyy/' / 'yyyy-' year
    (mode='path'); ``default`` when none."""
    if mode == "path":
        y = F.coalesce(F.nullif(F.regexp_extract(_c(c), r"/(\d{4})/", 1), F.lit("")),
                       F.nullif(F.regexp_extract(_c(c), r"(\d{4})-", 1), F.lit("")))
    else:
        y = F.nullif(F.regexp_extract(_c(c), r"(\d{4})", 1), F.lit(""))
    return F.coalesce(y, F.lit(default)) if default is not None else y


def fill_template(template: str, **cols) -> Column:
    """X32: '{name}' placeholders filled from columns."""
    out: Column = F.lit(template)
    for k, v in cols.items():
        out = F.replace(out, F.lit("{" + k + "}"), _c(v).cast("string"))
    return out


def harvest_urls(c) -> Column:
    """Every http(s) URL in free text, with braces/angle brackets stripped."""
    return F.transform(F.regexp_extract_all(_c(c), F.lit(P.URL_RE), 0),
                       lambda u: F.regexp_replace(u, r"^[{}<>]+|[{}<>]+$", ""))


def is_page_link(href) -> Column:
    """.htm/.html suffix and no 'agenda', case-insensitive."""
    h = F.lower(strip(_c(href)))
    return h.rlike(P.PAGE_LINK_SUFFIX_RE) & ~h.contains("agenda")


def is_minutes_doc(href, text) -> Column:
    """F8: .pdf suffix, 'minute' in the anchor text or the URL, and not an
    example/template/sample file."""
    h = F.lower(_c(href))
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    return (h.endswith(".pdf") & (t.contains("minute") | h.contains("minute"))
            & ~h.rlike(r"(example|template|sample)\.pdf$"))


# ---------------------------------------------------------------- dictionaries
def map_values(c, mapping: Mapping[str, str], default: str | None = "self", lower_self: bool = True,
               normalise: bool = False) -> Column:
    """Dictionary lookup.

    default='self' falls back to the input (lower-cased when ``lower_self``);
    default=None gives NULL on a miss. ``normalise`` strips and upper-cases the
    input before the lookup (keys are then expected upper-case)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    key = strip(F.upper(_c(c))) if normalise else _c(c)
    hit = F.try_element_at(m, key)
    if default == "self":
        return F.coalesce(hit, F.lower(_c(c)) if lower_self else _c(c))
    if default is None:
        return hit
    return F.coalesce(hit, F.lit(default))


def key_to_string(c) -> Column:
    """Integer-valued key (possibly stored as double) -> canonical string."""
    return _c(c).try_cast("double").try_cast("bigint").cast("string")


def strip_zeros(c) -> Column:
    """Remove leading zeros."""
    return F.ltrim(_c(c), F.lit("0"))


def zfill(c, width: int = 5) -> Column:
    """Left-pad with zeros to ``width``; longer values are kept whole."""
    s = _c(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def tract_key(county, tract, truncate: bool = True) -> Column:
    """County * 10^6 + tract * 100 -> string key. ``truncate`` reproduces
    a float truncation; otherwise the value is rounded first."""
    v = _c(county).cast("double") * 1_000_000 + _c(tract).cast("double") * 100
    v = v if truncate else F.round(v)
    return v.cast("bigint").cast("string")
