"""WARC derivatives: from response records, metadata records and plain-text conversion records."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from html.entities import html5
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

CRLF = "\r\n"
# What follows a tag's name: a quoted value may hold the sign that ends a tag. A tag
# whose quotes do not pair ends at the first such sign.
REST = r"""(?:[^"'>]*+(?:"[^"]*+"[^"'>]*+|'[^']*+'[^"'>]*+)*+>|[^>]*>)"""
# What is left out of the text, what parts its lines, and named characters.
DROPPED = r"(?is)<!--.*?(?:-->|\z)|" + "|".join(
    rf"<{tag}\b{REST}.*?(?:</{tag}\s*>|\z)" for tag in ("script", "style", "noscript", "template", "head"))
LINE_TAGS = (r"(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main"
             r"|nav|ol|p|pre|section|table|td|th|tr|ul)\b" + REST)
OTHER_TAGS = r"<[A-Za-z/!?]" + REST
NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®",
         "middot": "·", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘",
         "rsquo": "’", "ldquo": "“", "rdquo": "”", "euro": "€", "deg": "°", "amp": "&"}
TITLE = rf"(?is)<title\b{REST}(.*?)</title\s*>"
LINK = r"""(?i)<a\b[^>]*?\shref\s*=\s*["']([^"']*)["']"""
# DROPPED, NAMED and LINK are as the SQL has them, for pages with closed heads and
# plain links. Here a head that is not closed ends with the text only if no tag
# follows that cannot stand in a head, else it is read like a body but for its title.
IN_BODY = r"<(?!(?:html|head|meta|link|base|title|script|style|noscript|template)\b)[a-z]"
# One sign begins all that is left out, so most characters are looked at once.
DROPPED_HERE = r"(?is)<(?:!--.*?(?:-->|\z)|" + "|".join(
    rf"{tag}\b{REST}.*?(?:</{tag}\s*>|\z)" for tag in ("script", "style", "noscript", "template")
) + rf"|head\b{REST}(?:.*?</head\s*>|(?!.*{IN_BODY}).*))"
OPEN_HEAD = r"(?is)<head\b(?!.*?</head\s*>)"
FIRST_TITLE = rf"(?is)\A(.*?)<title\b{REST}.*?</title\s*>"
# An address in its own quotes, or in none, after values in their quotes.
LINK_HERE = r"""(?i)<a\b[^"'>]*?(?:(?:"[^"]*"|'[^']*')[^"'>]*?)*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
# All of HTML's names that end in a semicolon; those of NAMED are looked up first.
ALL_NAMED = {f"&{name}": text for name, text in html5.items() if name.endswith(";")}


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def record_id(*parts: Column) -> Column:
    """A name that follows from what it names: a UUID from an MD5, version 3."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cuts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("3"), F.substring(h, 14, 3)),
            F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
              date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of pages that were fetched: ``record_id, target_uri, warc_date, block, payload_digest``."""
    body = F.coalesce(F.col(html), F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(body).cast("string"), F.lit(CRLF + CRLF))
    return pages.select(
        record_id(F.lit("response"), F.col(page_id), F.col(url), body).alias("record_id"),
        F.coalesce(F.col(url), F.lit("")).alias("target_uri"), F.lit(date).alias("warc_date"),
        F.concat(head, body).alias("block"), digest(body).alias("payload_digest"))


ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _character(entity: Column) -> Column:
    """What an entity stands for; a name that is not known stays, a number that is none becomes U+FFFD."""
    names = F.create_map(*[F.lit(x) for name, char in NAMED.items() for x in (f"&{name};", char)])
    listed = "\x01".join(f"{key}\x02{text}" for key, text in ALL_NAMED.items())
    more = F.str_to_map(F.lit(listed), F.lit("\x01"), F.lit("\x02"))

    def spelled(code: Column) -> Column:
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")

    lower = F.lower(entity)
    hexadecimal = F.conv(F.regexp_extract(lower, "([0-9a-f]+);", 1), 16, 10).cast("long")
    decimal = F.regexp_extract(entity, "([0-9]+);", 1).cast("long")
    return (F.when(F.startswith(lower, F.lit("&#x")), _bound(hexadecimal, spelled))
            .when(F.startswith(entity, F.lit("&#")), _bound(decimal, spelled))
            .otherwise(F.coalesce(F.try_element_at(names, entity), F.try_element_at(more, entity), entity)))


def _characters(text: Column) -> Column:
    """Named and numbered characters, each once: an ampersand comes last, so it begins no other."""
    def put(so_far: Column, e: Column) -> Column:
        return F.replace(so_far, e["entity"], e["char"])

    def replaced(t: Column) -> Column:
        # Parts behind an ampersand, up to a semicolon: far cheaper than a search of all text for the pattern.
        parts = F.filter(F.split(t, "&"), lambda p, k: (k > 0) & F.contains(p, F.lit(";")))
        spelled = F.array_distinct(F.transform(
            parts, lambda p: F.concat(F.lit("&"), F.substring_index(p, ";", 1), F.lit(";"))))
        found = F.transform(F.filter(spelled, lambda e: e.rlike(rf"\A{ENTITY}\z")),
                            lambda e: F.struct(e.alias("entity"), _character(e).alias("char")))
        # False sorts before true.
        last = F.transform(found, lambda e: F.struct((e["char"] == "&").alias("last"), e["entity"], e["char"]))
        return F.aggregate(F.array_sort(last), t, put)

    return _bound(text, replaced)


def _blanks(text: Column) -> Column:
    """Runs of blanks as one, none beside a line end, and no empty lines."""
    def single(t: Column) -> Column:
        # Few texts have anything but single spaces, and to find that out is far cheaper than the pattern.
        rare = reduce(or_, [F.contains(t, F.lit(blank)) for blank in ("  ", *"\t\r\f\x0B\xA0")])
        return F.when(rare, F.regexp_replace(t, r"[\x20\t\r\f\x0B\xA0]{2,}|[\t\r\f\x0B\xA0]", " ")).otherwise(t)

    lines = F.transform(F.split(_bound(text, single), "\n"), lambda line: F.trim(line))
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def plain_text(html: Column) -> Column:
    """The text of a page: no scripts, styles, comments or head; block tags part lines.

    What is left: names of characters without a semicolon stay as they are, text
    of an unclosed head before its first body tag is kept but for the title, and
    an unclosed head whose page spells ``</head>`` later on ends there. A tag whose
    quotes do not pair ends at the first ``>``, and a link in one may be missed.
    """
    html = F.when(html.rlike(OPEN_HEAD), F.regexp_replace(html, FIRST_TITLE, "$1 ")).otherwise(html)
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, DROPPED_HERE, " "), LINE_TAGS, "\n"), OTHER_TAGS, "")
    return _blanks(_characters(bare))


def links(html: Column) -> Column:
    """Addresses of a page's links, as written, each once."""
    def bare(u: Column) -> Column:
        return F.when(u.rlike("^[\"']"), F.substring(u, F.lit(2), F.length(u) - 2)).otherwise(u)
    return F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(LINK_HERE), F.lit(1)), bare))


def derive(records: DataFrame) -> DataFrame:
    """Two records for each response, a metadata and a conversion one.

    ``record_id, warc_type, refers_to, concurrent_to, target_uri, warc_date,
    content_type, content_length, block_digest, source_status, source_headers,
    source_payload_digest, block``. Both refer to the response and name each
    other; both carry its target, date and payload digest, and the HTTP headers
    as they came, which the metadata's block repeats with title and links.

    A null block is an empty one: it has no status, no headers, no links and an
    empty text. A block without an empty line is all headers. Null ids, targets,
    dates and digests are empty. Equal responses give equal records. An empty
    table gives none, and other columns are not read.
    """
    def known(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    block, gap = known("block"), CRLF + CRLF
    cut = F.instr(block, gap)
    parsed = records.select(
        known("record_id").alias("refers_to"), known("target_uri").alias("target_uri"),
        known("warc_date").alias("warc_date"), known("payload_digest").alias("source_payload_digest"),
        F.when(cut > 0, F.substring(block, F.lit(1), cut - 1)).otherwise(block).alias("head"),
        F.when(cut > 0, F.substring(block, cut + len(gap), F.length(block))).otherwise("").alias("body"))
    parsed = parsed.select(
        "*", F.substring_index("head", CRLF, 1).alias("source_status"),
        F.when(F.contains("head", F.lit(CRLF)), F.substring(F.col("head"), F.instr("head", CRLF) + 2, F.length("head")))
        .otherwise("").alias("source_headers"),
        plain_text(F.col("body")).alias("text"),
        _blanks(_characters(F.regexp_extract("body", TITLE, 1))).alias("title"),
        links(F.col("body")).alias("links"))
    lines = [F.concat(F.lit("source-status: "), "source_status"),
             F.concat(F.lit("source-payload-digest: "), "source_payload_digest"),
             F.array_join(F.transform(F.filter(F.split("source_headers", CRLF), lambda h: h != ""),
                                      lambda h: F.concat(F.lit("source-header: "), h)), CRLF),
             F.concat(F.lit("title: "), F.regexp_replace("title", r"\n", " ")),
             F.array_join(F.transform("links", lambda u: F.concat(F.lit("outlink: "), _characters(u))), CRLF)]
    fields = F.concat(F.array_join(F.filter(F.array(*lines), lambda s: s != ""), CRLF), F.lit(CRLF))
    # Columns, so that each is worked out once.
    ids = {f"{k}_id": record_id(F.lit(k), F.col("refers_to"), F.col("target_uri"), F.col("source_payload_digest"))
           for k in ("metadata", "conversion")}

    def made(kind: str, other: str, content: str, own: Column) -> Column:
        return F.struct(
            F.col(f"{kind}_id").alias("record_id"), F.lit(kind).alias("warc_type"),
            F.col(f"{other}_id").alias("concurrent_to"), F.lit(content).alias("content_type"), own.alias("block"))

    both = F.array(made("metadata", "conversion", "application/warc-fields", fields),
                   made("conversion", "metadata", "text/plain; charset=utf-8", F.col("text")))
    return (parsed.withColumns(ids).withColumn("made", F.explode(both)).select(
        "made.record_id", "made.warc_type", "refers_to", "made.concurrent_to", "target_uri", "warc_date",
        "made.content_type", F.octet_length("made.block").cast("long").alias("content_length"),
        digest(F.col("made.block")).alias("block_digest"), "source_status", "source_headers",
        "source_payload_digest", "made.block"))


# The header fields, in the order they are written.
FIELDS = {"WARC-Type": "warc_type", "WARC-Record-ID": "record_id", "WARC-Date": "warc_date",
          "WARC-Target-URI": "target_uri", "WARC-Refers-To": "refers_to", "WARC-Concurrent-To": "concurrent_to",
          "WARC-Block-Digest": "block_digest", "WARC-Source-Payload-Digest": "source_payload_digest",
          "Content-Type": "content_type", "Content-Length": "content_length"}


def serialized(records: DataFrame) -> DataFrame:
    """Each derived record as it stands in a file, without the two line ends that close it: ``value``."""
    lines = [F.when(F.col(c).cast("string") != "", F.concat(F.lit(f"{name}: "), F.col(c).cast("string")))
             for name, c in FIELDS.items()]
    return records.select(F.concat(F.lit(f"WARC/1.1{CRLF}"), F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF),
                                   "block").alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files below ``path``, compressed."""
    serialized(records).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)
