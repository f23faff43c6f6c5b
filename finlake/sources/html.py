"""Article paragraphs and table rows from stored HTML pages, with Spark SQL regexes.

The original scraper fetched one page and walked it with an HTML parser; here
a table of pages is processed column-wise (``regexp_replace`` /
``regexp_extract_all`` / higher-order ``transform``), so the work runs in
whole-stage codegen on every executor and never leaves the JVM.

Rules:

* comments, ``<script>`` and ``<style>`` blocks are removed first (a ``</p>``
  inside a script is not a paragraph end);
* a tag ends at its ``>`` outside quoted attribute values; a ``<`` before anything
  but a letter, ``/`` or ``!`` is text;
* elements nest: an element ends at the end tag that belongs to it, found by
  splitting the page at this element's tags and folding the pieces with a depth
  counter; one that is never closed runs to the end of the page;
* paragraphs are read from every outermost ``<article>`` of a page, in order (from
  the first one only on request), or from the whole page if it has none;
* a paragraph runs from ``<p ...>`` to ``</p>`` or, as the HTML standard has
  it for unclosed ones, to the next start tag of a block element (``BLOCK_STARTS``)
  or the end tag of one around it (``BLOCK_ENDS``); text between blocks that is
  in no ``<p>`` is no paragraph;
* a table's rows and cells are its own: those of a table inside a cell are that
  cell's text.  Row and cell end tags may be missing; ``colspan`` repeats a cell;
* text has its tags removed, entities (numeric and HTML 4's named ones, with
  their semicolon) decoded in one pass and whitespace collapsed; empty
  paragraphs are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Block elements.
BLOCK_STARTS = ("p|h[1-6]|ul|ol|dl|table|div|section|article|aside|blockquote|pre|form|fieldset|header|footer|"
                "main|nav|hr|figure|address|details")
BLOCK_ENDS = "article|div|body|section|td|li|main|footer|header|blockquote"

#: what follows a tag's name up to its ">", quoted values whole
REST = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+>"""
#: after a tag's name
END = r"(?=[\s/>])"
ANY_TAG = rf"(?:</?[a-zA-Z]|<!){REST}"
#: put before every tag once, so that "<" inside an attribute's value is never taken for a tag (no HTML text has it)
MARK = "\u0001"

#: numbers that the standard reads as Windows-1252, and names by their code point
_WINDOWS = {i: ord(bytes([i]).decode("cp1252")) for i in range(128, 160) if i not in (129, 141, 143, 144, 157)}
_NAMES = {**name2codepoint, "apos": ord("'"), "nbsp": ord(" ")}
LAST_CODE_POINT = 0x10FFFF


def strip_noise(html: Column) -> Column:
    """The page without comments, scripts and styles, its tags marked."""
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    out = F.regexp_replace(out, rf"(?is)<script{END}{REST}.*?</script\s*>", "")
    out = F.regexp_replace(out, rf"(?is)<style{END}{REST}.*?</style\s*>", "")
    return F.regexp_replace(F.replace(out, F.lit(MARK), F.lit("")), rf"</?[a-zA-Z]{REST}", f"{MARK}$0")


def outer_elements(html: Column, tag: str, nested: Callable[[Column], Column] | None = None) -> Column:
    """The outermost ``<tag>`` elements of a stripped page, each from its start tag to before its own end tag.

    ``nested`` changes what lies inside a further ``<tag>`` within one.  The fold
    has a step per tag of this name, not per character.
    """
    pieces = F.split(html, rf"(?i){MARK}(?=</?{tag}{END})")
    opens = lambda x: x.rlike(rf"(?i)^<{tag}{END}")
    closes = lambda x: x.rlike(rf"(?i)^</{tag}{END}")
    texts = F.array().cast("array<string>")
    start = F.struct(F.lit(0).alias("depth"), texts.alias("now"), texts.alias("done"))

    def step(s: Column, x: Column) -> Column:
        depth = F.when(opens(x), s["depth"] + 1).when(closes(x), F.greatest(s["depth"] - 1, F.lit(0))).otherwise(s["depth"])
        ended = closes(x) & (s["depth"] == 1)
        kept = x
        if nested:
            # behind an inner element's end tag the outer one goes on
            kept = F.when(depth >= 2, nested(x)).when(closes(x), F.regexp_replace(x, rf"(?i)^</{tag}{END}{REST}", "")).otherwise(x)
        now = F.when(depth > 0, F.concat(s["now"], F.array(kept))).otherwise(texts)
        return F.struct(depth.alias("depth"), now.alias("now"), F.when(ended, F.concat(
            s["done"], F.array(F.array_join(s["now"], MARK)))).otherwise(s["done"]).alias("done"))

    return F.aggregate(pieces, start, step, lambda s: F.when(
        s["depth"] > 0, F.concat(s["done"], F.array(F.array_join(s["now"], "")))).otherwise(s["done"]))


def within(html: Column, tag: str | None, first_only: bool = False) -> Column:
    """The outermost ``<tag>`` elements, joined (the whole page if there is none with content).

    ``first_only`` keeps the first element alone, as a scraper that asks for
    one element does.
    """
    if not tag:
        return html
    every = outer_elements(html, tag)
    if first_only:
        every = F.slice(every, 1, 1)
    # an end tag keeps the paragraphs of two elements apart
    inner = F.array_join(F.transform(every, lambda x: F.concat(F.lit(MARK), x)), f"{MARK}</article>")
    content = F.regexp_replace(inner, rf"(?i){MARK}?</?{tag}{END}{REST}|{MARK}</article>", "")
    return F.when(F.trim(content) == "", html).otherwise(inner)


def _character(code: Column) -> Column:
    """The character of a code point; U+FFFD where there is none."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, LAST_CODE_POINT)
    known = F.create_map(*[F.lit(x) for pair in _WINDOWS.items() for x in pair])
    code = F.coalesce(F.try_element_at(known, code), code)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")


def decode_entities(text: Column) -> Column:
    """``&name;``, ``&#n;`` and ``&#xh;`` replaced once, from left to right; others stay as they are."""
    parts = F.split(text, "&")
    names = F.create_map(*[x for n, c in sorted(_NAMES.items()) for x in (F.lit(n), F.lit(chr(c)))])

    def decoded(part: Column) -> Column:
        ref = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        code = F.when(ref.rlike("^#[0-9]"), F.substring(ref, 2, 7).try_cast("int")).otherwise(
            F.conv(F.substring(ref, 3, 6), 16, 10).try_cast("int"))
        char = F.when(ref.startswith("#"), _character(code)).otherwise(F.try_element_at(names, ref))
        return F.when((ref == "") | char.isNull(), F.concat(F.lit("&"), part)).otherwise(
            F.concat(char, F.substr(part, F.length(ref) + 2)))

    joined = F.concat(parts[0], F.array_join(F.transform(F.slice(parts, F.lit(2), F.greatest(
        F.size(parts) - 1, F.lit(0))), decoded), ""))
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def text_of(fragment: Column) -> Column:
    """Visible text of an HTML fragment: tags removed, entities decoded, spaces collapsed."""
    out = decode_entities(F.regexp_replace(fragment, rf"{ANY_TAG}|{MARK}", ""))
    return F.trim(F.regexp_replace(out, r"[\s\u00A0]+", " "))


def _close_paragraphs(html: Column) -> Column:
    # every block start, every block end and the end of the fragment close the
    # paragraph before them
    out = F.regexp_replace(html, rf"(?i){MARK}<({BLOCK_STARTS}){END}{REST}", f"{MARK}</p>$0")
    out = F.regexp_replace(out, rf"(?i){MARK}</({BLOCK_ENDS})\s*>", f"{MARK}</p>$0")
    return F.concat(out, F.lit(f"{MARK}</p>"))


def paragraph_array(html: Column, container: str | None = "article",
                    classes: Iterable[str] | None = None, first_only: bool = False) -> Column:
    """Array of paragraph texts of one page, in document order."""
    body = _close_paragraphs(within(strip_noise(html), container, first_only))
    found = F.regexp_extract_all(body, F.lit(rf"(?is){MARK}<p{END}{REST}.*?{MARK}</p\s*>"), F.lit(0))
    if classes:
        wanted = F.array(*[F.lit(c) for c in classes])
        found = F.filter(found, lambda x: F.arrays_overlap(F.split(F.regexp_extract(
            x, rf"(?is)^{MARK}<p[^>]*?\sclass\s*=\s*[\"']([^\"']*)[\"']", 1), r"\s+"), wanted))
    # text_of drops all tags, the paragraph's own among them
    return F.filter(F.transform(found, text_of), lambda t: t != "")


def paragraphs(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
               container: str | None = "article",
               classes: Iterable[str] | None = None, first_only: bool = False) -> DataFrame:
    """(page id, pos, text): one row per non-empty paragraph."""
    arr = paragraph_array(F.col(html_col), container, classes, first_only)
    return pages.select(id_col, F.posexplode(arr).alias("pos", "text"))


def article_text(html: Column, container: str | None = "article",
                 classes: Iterable[str] | None = None) -> Column:
    """Paragraphs joined by newlines (what the scraper stored as content)."""
    return F.array_join(paragraph_array(html, container, classes), "\n")


def _cells(row: Column) -> Column:
    """Texts of a row's cells, repeated by their colspan (1 to 1,000 as in the standard)."""
    starts = F.filter(F.split(row, rf"(?i){MARK}(?=<t[dh]{END})"), lambda x: x.rlike(rf"(?i)^<t[dh]{END}"))

    def cell(x: Column) -> Column:
        tag = F.regexp_extract(x, rf"(?is)^<t[dh]{REST}", 0)
        span = F.regexp_extract(tag, r"""(?i)\scolspan\s*=\s*["']?\s*([0-9]{1,4})""", 1).try_cast("int")
        inner = F.split(F.substr(x, F.length(tag) + 1), rf"(?i){MARK}</t[dh]\s*>", 2)[0]
        return F.array_repeat(text_of(inner), F.greatest(F.lit(1), F.least(F.lit(1000), F.coalesce(span, F.lit(1)))))

    return F.flatten(F.transform(starts, cell))


def table_rows(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
               table_index: int = 0) -> DataFrame:
    """(page id, row, cells) of the ``table_index``-th outermost table of each page."""
    parts = "table|thead|tbody|tfoot|caption|tr|td|th"
    tables = outer_elements(strip_noise(F.col(html_col)), "table",
                            lambda x: F.regexp_replace(x, rf"(?i)(?:^|{MARK})</?(?:{parts}){END}{REST}", ""))
    table = F.coalesce(F.try_element_at(tables, F.lit(table_index + 1)), F.lit(""))
    rows = F.filter(F.split(table, rf"(?i){MARK}(?=<tr{END})"), lambda x: x.rlike(rf"(?i)^<tr{END}"))
    own = F.transform(rows, lambda x: F.split(x, rf"(?i){MARK}(?:</tr\s*>|</?(?:thead|tbody|tfoot|caption){END})", 2)[0])
    return pages.select(id_col, F.posexplode(F.transform(own, _cells)).alias("row", "cells"))


def news_from_search(results: DataFrame, pages: DataFrame, url_col: str = "url",
                     html_col: str = "html") -> DataFrame:
    """Search hits (title, providerPublishTime epoch seconds, link) with date and content."""
    content = pages.select(F.col(url_col).alias("link"),
                           article_text(F.col(html_col)).alias("content"))
    return results.join(content, "link", "left").select(
        "title",
        F.to_date(F.from_unixtime(F.col("providerPublishTime"))).alias("date"),
        "content")


def table_frame(rows: DataFrame, columns: dict[str, str], id_col: str = "page_id") -> DataFrame:
    """Rows of :func:`table_rows` -> named, typed columns picked by header text.

    ``columns`` maps a header cell text to a Spark type, e.g.
    ``{"Symbol": "string", "CIK": "bigint"}``; row 0 is the header.
    """
    header = rows.filter(F.col("row") == 0).select(id_col, F.col("cells").alias("_h"))
    body = rows.filter(F.col("row") > 0).join(header, id_col)
    return body.select(*[
        F.try_element_at("cells", (F.array_position("_h", F.lit(name))).cast("int"))
        .cast(typ).alias(name) for name, typ in columns.items()])


def company_list(pages: DataFrame) -> DataFrame:
    """(Symbol, CIK) from the first table of company-list pages."""
    return table_frame(table_rows(pages), {"Symbol": "string", "CIK": "bigint"})
