"""Dataset link discovery over a table of web pages.

Re-aimed from "fetch one page": the input is a ``pages(page_id, url, html)``
table, pages are cut into tags by one linear pattern, anchors give their ``href``,
resolved against the page URL with a small column rule, filtered by suffix and
marker words, de-duplicated to their first occurrence and parsed for year and
period.  No HTTP, no Python per row.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

# ---------------------------------------------------------------------------
# Marker words a dataset URL must contain (any, case-insensitive),
# the archive suffix, and the file-name patterns for year and period.
DATASET_MARKERS = ["hard-drive-data", "hard_drive_data", "drive-stats", "drivestats", "backblaze"]
DATASET_SUFFIX = ".zip"
QUARTER_FIRST = r"(?i)(?:^|[_\-])Q([1-4])[_\-]?((?:19|20)\d{2})"
YEAR_FIRST = r"(?i)((?:19|20)\d{2})[_\-]?Q([1-4])"
YEAR_ONLY = r"((?:19|20)\d{2})"
# ---------------------------------------------------------------------------

# How a page is cut into tags.  Every repetition is possessive and every piece may end with the page, so
# the first way to read a tag is the only one tried: the work is linear and needs no stack, whatever a tag holds.
ATTRIBUTE_NAME = r"[^\s/>][^\s/>=]*+"
ATTRIBUTE_VALUE = r""" "[^"]*+(?:"|\z) | '[^']*+(?:'|\z) | [^\s>"'][^\s>]*+ """.replace(" ", "")
ATTRIBUTE = rf"({ATTRIBUTE_NAME})(?:\s*+=\s*+({ATTRIBUTE_VALUE})?+)?+"
INSIDE_TAG = r"(?:[\s/]++|" + ATTRIBUTE.replace("(" + ATTRIBUTE_NAME, "(?:" + ATTRIBUTE_NAME).replace(
    "(" + ATTRIBUTE_VALUE, "(?:" + ATTRIBUTE_VALUE) + ")*+"
PIECES = "|".join([
    r"<!--(?:-?>|.*?(?:--!?>|\z))",                                                           # comments
    rf"<(script|style)(?=[\s/>]){INSIDE_TAG}(?:>|\z).*?(?=</\1[\s/>]|\z)",                    # text that is no markup
    rf"<[a-z][^\s/>]*+{INSIDE_TAG}(?:>|\z)",                                                  # start tags
    r"<[!?/][^>]*+(?:>|\z)"])                                                                 # end tags, declarations
CLOSED_ANCHOR = rf"(?is)^<a(?=[\s/]){INSIDE_TAG}>\z"
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*[;=]?)"
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def without_dots(url: Column) -> Column:
    """``.`` and ``..`` segments of the path resolved; the rest of the URL as it is."""
    origin = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    path = url_path(url)
    rest = F.substr(url, F.length(origin) + F.length(path) + 1, F.length(url))
    parts = F.split(path, "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, part: F.when(
        part == "..", F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(done)).when(
        part == ".", done).otherwise(F.concat(done, F.array(part))))
    end = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.when((origin != "") & path.rlike(r"(^|/)\.\.?(/|$)"),
                  F.concat(origin, F.array_join(kept, "/"), end, rest)).otherwise(url)


def resolve_url(base: Column, href: Column) -> Column:
    """Join ``href`` to the page URL: absolute, scheme-relative, root-relative, query-only or relative."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    no_frag = F.regexp_replace(base, r"#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    path_dir = F.regexp_replace(no_query, r"[^/]*$", "")
    # an origin without a path resolves relative links under '/'
    path_dir = F.when(path_dir == F.concat(origin, F.lit("/")), path_dir).when(
        F.length(path_dir) <= F.length(origin), F.concat(origin, F.lit("/"))).otherwise(path_dir)
    h = F.trim(href)
    return without_dots(F.when(h.rlike(ABSOLUTE), h)
            .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
            .when(h.startswith("/"), F.concat(origin, h))
            .when(h.startswith("?"), F.concat(no_query, h))
            .when(h.startswith("#"), F.concat(no_frag, h))
            .when(h == "", no_frag)
            .otherwise(F.concat(path_dir, h)))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)?([^?#]*)", 1)


def file_name(url: Column) -> Column:
    return F.regexp_extract(url_path(url), r"([^/]*)$", 1)


def is_candidate(url: Column, suffix: str = DATASET_SUFFIX, markers: list[str] | None = DATASET_MARKERS) -> Column:
    """Path ends with ``suffix`` (case-insensitive) and the URL contains any marker."""
    ok = F.lower(url_path(url)).endswith(suffix.lower()) if suffix else F.lit(True)
    if markers:
        low = F.lower(url)
        anym = None
        for m in markers:
            c = low.contains(m.lower())
            anym = c if anym is None else (anym | c)
        ok = ok & anym
    return ok


def year_period(name: Column) -> tuple[Column, Column]:
    """(year, period) from a file name: 'Q1_2020' / '2020Q1' style quarters, else a year -> ANNUAL."""
    q1y = F.regexp_extract(name, QUARTER_FIRST, 2)
    q1q = F.regexp_extract(name, QUARTER_FIRST, 1)
    q2y = F.regexp_extract(name, YEAR_FIRST, 1)
    q2q = F.regexp_extract(name, YEAR_FIRST, 2)
    y = F.regexp_extract(name, YEAR_ONLY, 1)
    year = (F.when(q1y != "", q1y).when(q2y != "", q2y).when(y != "", y)).cast("int")
    period = (F.when(q1y != "", F.concat(F.lit("Q"), q1q)).when(q2y != "", F.concat(F.lit("Q"), q2q))
              .when(y != "", F.lit("ANNUAL")).otherwise(F.lit("UNKNOWN")))
    return year, period


def period_order(period: Column) -> Column:
    return F.when(period == "ANNUAL", 0).when(period.rlike("^Q[0-9]$"), F.substring(period, 2, 1).cast("int")
                                             ).otherwise(99)


def reference_table() -> dict[str, str]:
    """Named character references of the HTML standard, and the code points that pages mean as Windows-1252."""
    old = {f"#{n}": bytes([n]).decode("cp1252", "ignore") for n in range(0x80, 0xA0)}
    return {**html5, **{k: v for k, v in old.items() if v}}


def unescaped(text: Column, table: dict[str, str] | None = None) -> Column:
    """Character references decoded as in an attribute: numbers always, names only as the standard writes
    them and not before ``=`` (so ``?a=1&copy=2`` stays).  Numbers that are no character give U+FFFD."""
    names = F.from_json(F.lit(json.dumps(table or reference_table())), "map<string,string>")

    def decoded(part: Column) -> Column:
        ref = F.regexp_extract(part, REFERENCE, 1)
        digits = F.regexp_extract(ref, r"^#0*([0-9]*)", 1)
        sixteen = F.regexp_extract(ref, r"^#[xX]0*([0-9a-fA-F]*)", 1)
        far = F.lit(0x110000)
        number = (F.when(ref.rlike("^#[xX]"), F.when(F.length(sixteen) > 6, far).otherwise(F.conv(F.concat(F.lit("0"), sixteen), 16, 10).cast("int")))
                  .when(ref.rlike("^#[0-9]"), F.when(F.length(digits) > 7, far).otherwise(F.concat(F.lit("0"), digits).cast("int"))))
        known = F.element_at(names, F.when(number.isNotNull(), F.concat(F.lit("#"), number.cast("string"))).otherwise(ref))
        found = (F.when((number == 0) | (number >= far) | number.between(0xD800, 0xDFFF), F.lit("�"))
                 .otherwise(F.coalesce(known, F.decode(F.unhex(F.lpad(F.hex(number.cast("bigint")), 8, "0")), "UTF-32"))))
        return F.concat(F.coalesce(found, F.concat(F.lit("&"), ref)), F.substr(part, F.length(ref) + 1))

    parts = F.split(text, "&")
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), decoded)
    return F.when(text.contains("&"), F.concat(F.element_at(parts, 1), F.array_join(rest, ""))).otherwise(text)


def page_links(pages: DataFrame) -> DataFrame:
    """Every ``a[href]`` of every page: page_id, pos (order in the page), href, resolved url.

    One pattern cuts a page into comments, scripts, styles and tags, so what stands in a
    comment, a script or an attribute's value is no link.  A tag that the page leaves open
    is none either.  Of several ``href`` of one anchor the last counts, one without a value is
    empty.  A null page has no links.  No row leaves its task.
    """
    tags = F.filter(F.regexp_extract_all("html", F.lit("(?is)" + PIECES), 0), lambda t: t.rlike(CLOSED_ANCHOR))

    def own_href(tag: Column) -> Column:
        inside = F.substr(tag, F.lit(3))
        names, values = (F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(group)) for group in (1, 2))
        pairs = F.arrays_zip(names.alias("name"), values.alias("value"))
        return F.try_element_at(F.filter(pairs, lambda p: F.lower(p["name"]) == "href"), F.lit(-1))["value"]

    def value_of(raw: Column) -> Column:
        quoted = raw.startswith('"') | raw.startswith("'")
        return F.regexp_replace(unescaped(F.when(quoted, F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)), r"^\s+|\s+$", "")

    # decoded before the rows are made, so that what follows refers to a plain column
    found = F.transform(F.filter(F.transform(tags, own_href), lambda v: v.isNotNull()), value_of)
    hrefs = pages.select("page_id", "url", F.posexplode(found).alias("pos", "href"))
    return hrefs.select("page_id", "pos", "href", resolve_url(F.col("url"), F.col("href")).alias("link"))


def extract_dataset_links(pages: DataFrame, suffix: str = DATASET_SUFFIX,
                          markers: list[str] | None = DATASET_MARKERS) -> DataFrame:
    """Candidate links, first occurrence per URL (smallest page_id, position), with file name."""
    links = page_links(pages).where(is_candidate(F.col("link"), suffix, markers))
    first = links.groupBy(F.col("link").alias("url")).agg(F.min(F.struct("page_id", "pos")).alias("_f"))
    return first.select("url", F.col("_f.page_id").alias("page_id"), F.col("_f.pos").alias("pos"),
                        file_name(F.col("url")).alias("file_name"))


def dataset_manifest(pages: DataFrame, year_from: int = 2013, year_to: int | None = None,
                     suffix: str = DATASET_SUFFIX, markers: list[str] | None = DATASET_MARKERS,
                     require: bool = True) -> DataFrame:
    """dataset_id, year, period, file_name, url for links with a year, in [year_from, year_to];
    ``year_to`` defaults to the latest year found.  Sorted by year, period rank, file name."""
    links = extract_dataset_links(pages, suffix, markers)
    y, p = year_period(F.col("file_name"))
    m = links.select("url", "file_name", y.alias("year"), p.alias("period")).where(F.col("year").isNotNull())
    if require and m.isEmpty():
        raise RuntimeError("the pages link to no dataset")
    # year_to=None means "up to the latest year found", which every row satisfies
    if year_to is not None:
        m = m.where(F.col("year") <= year_to)
    m = m.where(F.col("year") >= year_from)
    out = m.select(F.concat_ws("_", F.col("year").cast("string"), "period", "file_name").alias("dataset_id"),
                   "year", "period", "file_name", "url")
    return out.orderBy("year", period_order(F.col("period")), "file_name")
