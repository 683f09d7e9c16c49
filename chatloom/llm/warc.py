"""WARC derivatives: responses become linked metadata and plain-text conversion records.

A record is a row: record_id, warc_type, target_uri, warc_date, content_type, refers_to, source_digest, block_digest,
payload_digest, block. Derived records name the response in ``refers_to``, carry its target URI, date and payload digest, and have digests of
their own; the metadata record keeps the status line and every header of the response as fields. Identifiers are derived from the source's, so a rerun or a retried task
writes the same records. All of it is column expressions; nothing is shuffled.

Edge cases: a response without a blank line has no head, and its whole block is the payload; a null block is empty and still gives both records;
a null target stays null; a declared digest that does not agree is kept as declared, and ``digest_ok`` is false; repeated
responses give repeated records with equal identifiers; an empty table gives an empty result. Columns named in ``keep`` pass through.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.text import let

# Elements whose content is no text, elements that begin a line, named references.
HIDDEN = ("script", "style", "template", "noscript", "title")
BLOCKS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|tr|ul"
NAMED = (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("nbsp", " "), ("copy", "©"), ("middot", "·"))
# Every named reference, with its semicolon, and those that stand without one, longest first.
REFERENCES = {name: char for name, char in html5.items() if name.endswith(";")} | {f"{name};": char for name, char in NAMED}
BARE = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
# The attributes of a tag and its end: a > in quotes does not end it, a quote that stays open holds nothing.
TAG_END = r"(?:[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>|[^>]*+>)"
CRLF = "\r\n"


def record_id(kind: str, *parts: Column) -> Column:
    """A name-based identifier in the form of a UUID."""
    h = F.md5(F.concat_ws(" ", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    pieces = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def digest(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.encode(c, "UTF-8"), 256))


def responses(pages: DataFrame, fetched: str = "2020-01-01T00:00:00Z", url: str = "url", html: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Response records of raw pages."""
    body = F.coalesce(F.col(html), F.lit(""))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(body).cast("string"), F.lit(CRLF + CRLF),
    )
    rows = pages.select(*keep, F.col(url).alias("target_uri"), body.alias("_body"), F.concat(head, body).alias("block"))
    return rows.select(
        *keep, record_id("response", *[F.col(k) for k in keep], F.col("target_uri"), digest(F.col("_body"))).alias("record_id"), F.lit("response").alias("warc_type"),
        "target_uri", F.lit(fetched).alias("warc_date"), F.lit("application/http; msgtype=response").alias("content_type"),
        F.lit(None).cast("string").alias("refers_to"), F.lit(None).cast("string").alias("source_digest"), digest(F.col("block")).alias("block_digest"),
        digest(F.col("_body")).alias("payload_digest"), "block",
    )


def decode_numbers(c: Column) -> Column:
    """Numeric character references; those of no character become U+FFFD."""

    def one(part: Column) -> Column:
        number = F.regexp_extract(part, r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", 1)
        value = F.when(number.rlike("^[xX]"), F.conv(F.substring(number, 2, 6), 16, 10)).otherwise(number).cast("int")
        good = ((value > 0) & (value < 0xD800)) | ((value > 0xDFFF) & (value < 0x110000))
        char = F.when(good, F.decode(F.unhex(F.lpad(F.hex(value.cast("long")), 8, "0")), "UTF-32")).otherwise(F.lit("�"))
        return F.when(number == "", F.concat(F.lit("&#"), part)).otherwise(F.concat(char, F.regexp_replace(part, "^[0-9a-zA-Z]+;", "")))

    decoded = lambda parts: F.concat(
        F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), one), ""))
    return let(c, lambda t: F.when(F.instr(t, F.lit("&#")) > 0, let(F.split(t, "&#", -1), decoded)).otherwise(t))


def decode_names(c: Column) -> Column:
    """Named references of the HTML5 table, except the ampersand's, which are written ``&amp;`` to be decoded last."""
    table = F.create_map(*[F.lit(x) for pair in REFERENCES.items() for x in pair])

    def one(part: Column) -> Column:
        def named(name: Column) -> Column:
            bare = F.regexp_extract(part, f"^({'|'.join(BARE)})", 1)
            found = F.when(name != "", F.element_at(table, name))
            short = F.element_at(table, F.concat(bare, F.lit(";")))
            char = lambda x: F.when(x == "&", F.lit("&amp;")).otherwise(x)
            return F.when(found.isNotNull(), F.concat(char(found), F.substring(part, F.length(name) + 1, F.length(part)))).when(
                bare != "", F.concat(char(short), F.substring(part, F.length(bare) + 1, F.length(part)))).when(
                F.startswith(part, F.lit("#")), F.concat(F.lit("&"), part)).otherwise(F.concat(F.lit("&amp;"), part))

        return let(F.regexp_extract(part, "^[a-zA-Z][a-zA-Z0-9]*;", 0), named)

    decoded = lambda parts: F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), one), ""))
    return let(F.split(c, "&", -1), decoded)


def plain_text(html: Column) -> Column:
    """The text of a page: hidden elements, comments and markup go, elements that begin a line begin one, references are decoded, white space
    inside a line is one space, and empty lines go. A comment or hidden element that is not closed ends with the text."""
    out = F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", "")
    for tag in HIDDEN:
        out = F.regexp_replace(out, rf"(?is)<{tag}\b{TAG_END}.*?(?:</{tag}\s*>|\z)", "")
    out = F.regexp_replace(out, r"[ \t\n\r\x0b\x0c]+", " ")
    out = F.regexp_replace(out, rf"(?i)</?(?:{BLOCKS})\b{TAG_END}", "\n")
    out = F.regexp_replace(out, rf"<[a-zA-Z/!?]{TAG_END}", "")
    common = "|".join(["amp", *[name for name, _ in NAMED]])

    def listed(t: Column) -> Column:
        for name, char in NAMED:
            t = F.replace(t, F.lit(f"&{name};"), F.lit(char))
        return t

    # the whole table where a reference beside the usual ones stands
    out = let(out, lambda t: F.when(t.rlike(f"&(?!(?:{common});)[a-zA-Z]"), decode_names(t)).otherwise(listed(t)))
    out = F.replace(decode_numbers(out), F.lit("&amp;"), F.lit("&"))
    return F.regexp_replace(F.regexp_replace(out, r" *\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", "")


def derivatives(records: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """For each response of ``records`` a metadata and a conversion record, with ``digest_ok`` of the source."""
    block = F.coalesce(F.col("block"), F.lit(""))
    at = F.instr(block, CRLF + CRLF)
    rows = records.filter("warc_type = 'response'").withColumns({"_at": at, "_block": block})
    rows = rows.withColumns({
        "_head": F.when(F.col("_at") > 0, F.expr("substring(_block, 1, _at - 1)")).otherwise(F.lit("")),
        "_payload": F.when(F.col("_at") > 0, F.expr("substring(_block, _at + 4)")).otherwise(F.col("_block")),
    })
    rows = rows.withColumn("_actual", digest(F.col("_payload")))
    source = F.coalesce(F.col("payload_digest"), F.col("_actual"))
    lines = F.split(F.col("_head"), CRLF, -1)
    fields = F.concat(
        F.lit("http-status-line: "), F.get(lines, F.lit(0)), F.lit(CRLF),
        F.array_join(F.transform(F.slice(lines, F.lit(2), F.greatest(F.size(lines), F.lit(1))), lambda x: F.concat(F.lit("http-header-"), x, F.lit(CRLF))), ""),
        F.lit("source-record: "), F.col("record_id"), F.lit(CRLF + "source-payload-digest: "), source, F.lit(CRLF),
    )
    derived = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), plain_text(F.col("_payload")).alias("block")),
    )
    out = rows.select(
        *keep, F.col("record_id").alias("refers_to"), "target_uri", "warc_date", source.alias("source_digest"),
        (source == F.col("_actual")).alias("digest_ok"), F.inline(derived),
    )
    return out.select(
        *keep, record_id("derived", F.col("warc_type"), F.col("refers_to")).alias("record_id"), "warc_type", "target_uri", "warc_date", "content_type", "refers_to",
        "source_digest", digest(F.col("block")).alias("block_digest"), F.octet_length("block").cast("long").alias("content_length"), "digest_ok", "block",
    )


def record_text(records: DataFrame) -> Column:
    """The record as it stands in a file, without the two line ends behind it."""
    named = [
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "warc_date"), ("WARC-Refers-To", "refers_to"),
        ("WARC-Block-Digest", "block_digest"), ("WARC-Payload-Digest", "payload_digest"), ("Content-Type", "content_type"),
    ]
    lines = [F.concat(F.lit(f"{n}: "), F.col(c), F.lit(CRLF)) for n, c in named if c in records.columns]
    block = F.coalesce(F.col("block"), F.lit(""))
    return F.concat(F.lit("WARC/1.1" + CRLF), F.concat_ws("", *lines), F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF), block)


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """WARC files, one per task."""
    records.select(record_text(records).alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", compression).text(path)


def parse(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, by content length."""
    if raw[:2] == b"\x1f\x8b":
        raw = gzip.decompress(raw)
    at = 0
    while (at := raw.find(b"WARC/1.", at)) >= 0:
        end = raw.index(b"\r\n\r\n", at)
        pairs = (line.split(":", 1) for line in raw[at:end].decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
        headers = {k.strip().lower(): v.strip() for k, v in pairs}
        size = int(headers.get("content-length", 0))
        yield headers, raw[end + 4 : end + 4 + size]
        at = end + 4 + size


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files, plain or gzip; a file is the unit of work, so keep files at the usual size of up to 1 GB."""
    names = {
        "record_id": "warc-record-id", "warc_type": "warc-type", "target_uri": "warc-target-uri", "warc_date": "warc-date", "content_type": "content-type",
        "refers_to": "warc-refers-to", "block_digest": "warc-block-digest", "payload_digest": "warc-payload-digest",
    }

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for raw in part["content"]:
                rows = []
                for headers, block in parse(raw):
                    rows.append({c: headers.get(n) for c, n in names.items()} | {"block": block.decode("utf-8", "replace")})
                    if len(rows) == 256:
                        yield pd.DataFrame(rows)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows)

    schema = ", ".join(f"{c} string" for c in [*names, "block"])
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(batches, schema)
