"""Legacy web archives: ARC files, their conversion to WARC, and reading WARC back.

An ARC file starts with a version block whose second line names the fields of the URL
lines that follow, so records are read by the fields of their own file's version and by
their declared length, never by looking for a separator. Conversion synthesises what WARC
wants: record ids, W3C dates, types and SHA-1 digests. Files are written by Spark's own
text writer, so any store will do, and read with its binary reader, a file a row; how many
records and bytes a file holds is limited.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroskein.llm.common import dealt, hot_keys, in_parts, scratch_path, staged

#: The URL-line fields of the two ARC versions.
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CAPTURED = "20200101000000"
#: Most records and bytes of an archive file before it is packed; one longer record has a file of its own.
FILE_RECORDS, FILE_BYTES = 2_000, 8 << 20
PAGE_HEADER = "X-Page-Id"
RECORD = "arc_file string, offset long, url string, ip string, date string, content_type string, status int, http_headers binary, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def arc_version_block(version: int, name: str, date: str) -> str:
    """The version block that begins a file: its URL line, version line and field names."""
    body = f"{version} {0 if version == 1 else 1} archive\n{FIELDS[version]}\n"
    extra = "" if version == 1 else " 200 - - 0 " + name
    return f"filedesc://{name} 0.0.0.0 {date} text/plain{extra} {len(body)}\n{body}"


def write_arc(pages: DataFrame, path: str, version: int = 1) -> None:
    """Write `pages` (page_id, url, html) as ARC files, a record a row in the HTTP response it came in.

    Null html is an empty payload, a null or blank url is "-"; white space and controls in
    urls are percent-encoded. Every file begins with a version block.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.coalesce(F.nullif(F.regexp_replace(F.col("url"), r"[\x00-\x20\x7f]+", "%20"), F.lit("")), F.lit("-"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n" + PAGE_HEADER + ": "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"),
    )
    length = (F.octet_length(head) + F.octet_length(payload)).cast("string")
    middle = F.lit(f" 0.0.0.0 {CAPTURED} text/html ") if version == 1 else F.lit(f" 0.0.0.0 {CAPTURED} text/html 200 - - 0 pages ")
    record = F.concat(url, middle, length, F.lit("\n"), head, payload)
    block = arc_version_block(version, "pages.arc", CAPTURED).encode()

    def filed(frames):
        yield from _files((bytes(x) for frame in frames for x in frame["value"]), [block])

    _write(pages.select(record.cast("binary").alias("value")).mapInPandas(filed, "value binary"), path)


def _files(records, first: list[bytes]):
    """Frames of one value each: what a file holds, records parted by line ends, after `first`."""
    held, size = [], 0
    for record in records:
        if held and (len(held) >= FILE_RECORDS or size + len(record) > FILE_BYTES):
            yield pd.DataFrame({"value": [b"\n".join(first + held)]})
            held, size = [], 0
        held.append(record)
        size += len(record)
    if held:
        yield pd.DataFrame({"value": [b"\n".join(first + held)]})


def _write(files: DataFrame, path: str) -> None:
    """Each row as a file; the text writer ends it with the line end that ends its last record."""
    values = files.select(F.col("value").cast("string").alias("value"))
    values.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def unpacked(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def arc_records(content: bytes):
    """(offset, fields by name, block) of each record of one ARC file's bytes; the version block sets the fields."""
    at, size = 0, len(content)
    names = FIELDS[1].split()
    while at < size:
        if content[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = content.find(b"\n", at)
        if end < 0:
            return
        parts = content[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        if parts[-1].isdigit() is False or len(parts) < 4:
            at = end + 1  # not a URL line: look on at the next
            continue
        length = int(parts[-1])
        block = content[end + 1 : end + 1 + length]
        if parts[0].startswith("filedesc:"):
            lines = block.decode("utf-8", "replace").split("\n")
            if len(lines) > 1 and lines[1].strip():
                names = lines[1].split()
        else:
            # a content type may hold spaces; the fields after it are counted from the end
            after = len(names) - 1 - next((i for i, n in enumerate(names) if n.lower() == "content-type"), 3)
            head, kind, tail = parts[:3], " ".join(parts[3 : len(parts) - after]), parts[len(parts) - after :]
            yield at, dict(zip((n.lower() for n in names), [*head, kind, *tail])), block
        at = end + 1 + length


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the ARC files at `path`: see RECORD. Version blocks give none; a cut last record what it has."""

    def parsed(frames):
        columns = [c.split()[0] for c in RECORD.split(", ")]
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"]):
                out = []
                for offset, got, block in arc_records(unpacked(content)):
                    headers, payload = b"", block
                    if block.startswith(b"HTTP/"):
                        cut = block.find(b"\r\n\r\n")
                        step = 4 if cut >= 0 else 2
                        cut = cut if cut >= 0 else block.find(b"\n\n")
                        if cut >= 0:
                            headers, payload = block[: cut + step], block[cut + step :]
                    status = re.match(rb"HTTP/\S+ (\d{3})", headers)
                    out.append((name, offset, got.get("url"), got.get("ip-address"), got.get("archive-date"), got.get("content-type"), int(status[1]) if status else None, headers, payload))
                    if len(out) >= 500:
                        yield pd.DataFrame(out, columns=columns).astype({"status": "Int32"})
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=columns).astype({"status": "Int32"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(parsed, RECORD)


def w3c_date(stamp: str | None) -> str:
    """A W3C date of an ARC stamp of up to 14 digits; what is missing or wrong counts as its beginning."""
    digits = re.sub(r"\D", "", stamp or "")[:14]
    digits += "19700101000000"[len(digits) :]
    try:
        when = datetime.strptime(digits, "%Y%m%d%H%M%S").replace(tzinfo=UTC)
    except ValueError:
        when = datetime(1970, 1, 1, tzinfo=UTC)
    return when.strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(*parts: object) -> str:
    """An id that says the same for the same record, so that a task that runs again writes it again."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def warc_record(row, refers_to: str | None, refers_url: str | None) -> bytes:
    """One WARC/1.1 record of an ARC record; without the last line end, which the writer adds."""
    payload, headers = row.payload or b"", row.http_headers or b""
    http = bool(headers)
    kind = "revisit" if refers_to else "response" if http else "resource"
    block = headers if refers_to else headers + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Target-URI: {row.url}", f"WARC-Date: {w3c_date(row.date)}",
        f"WARC-Record-ID: {row.record_id}", f"WARC-IP-Address: {row.ip or '0.0.0.0'}",
        f"Content-Type: {'application/http; msgtype=response' if http else row.content_type or 'application/octet-stream'}",
        f"WARC-Payload-Digest: sha1:{row.digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
    ]
    if refers_to:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {refers_to}"]
        lines += [f"WARC-Refers-To-Target-URI: {refers_url}"] if refers_url else []
        lines += [f"X-Payload-Length: {len(payload)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r"


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str, least_payload: int = 0) -> None:
    """Convert the ARC files at `arc_path` to WARC files at `warc_path`.

    Of records with equal payloads of `least_payload` bytes or more, that with the largest
    page id (then the largest record id) is written whole and the others are revisits of it.
    Archives are parsed once, into a table. Only ids and digests are shuffled to find
    revisits, those of a very common payload to several tasks; payloads move once at most, by
    record id.
    """

    @F.pandas_udf("string")
    def digests(payload: pd.Series) -> pd.Series:
        return payload.map(base32_sha1)

    @F.pandas_udf("string")
    def ids(name: pd.Series, offset: pd.Series) -> pd.Series:
        return pd.Series([record_id(n.rsplit("/", 1)[-1], o) for n, o in zip(name, offset)], dtype=object)

    records = read_arc(spark, arc_path)
    page = F.try_to_number(F.regexp_extract(F.col("http_headers").cast("string"), rf"(?i){PAGE_HEADER}: *(-?\d+)", 1), F.lit("S9999999999999999999")).cast("long")
    full = staged(records.withColumn("page_id", page).withColumn("record_id", ids("arc_file", "offset")).withColumn("digest", digests("payload")), "arc")
    small = full.where(F.octet_length("payload") >= least_payload).select("record_id", "page_id", "url", "digest")
    best = F.max(F.struct(F.coalesce("page_id", F.lit(-(1 << 62))).alias("p"), "record_id", "url")).alias("top")
    first = staged(small.groupBy("digest").agg(best, F.count("*").alias("n")), "firsts")
    hot = hot_keys(first.select("digest", "n"), "digest")
    twice = in_parts(first.where("n > 1"), hot, "digest")
    revisits = (
        dealt(small, hot, "digest", "record_id").join(twice, ["digest", "part"]).where(F.col("record_id") != F.col("top.record_id"))
        .select("record_id", F.col("top.record_id").alias("refers_to"), F.col("top.url").alias("refers_url"))
    )

    def converted(frames):
        yield from _files((warc_record(r, r.refers_to, r.refers_url) for frame in frames for r in frame.itertuples()), [])

    rows = full.join(staged(revisits, "revisits"), "record_id", "left")
    _write(rows.mapInPandas(converted, "value binary"), warc_path)


def warc_records(content: bytes):
    """(headers by lower-case name, block) of each record of one WARC file's bytes, by declared lengths."""
    at = content.find(b"WARC/")
    while 0 <= at < len(content):
        end = content.find(b"\r\n\r\n", at)
        if end < 0:
            return
        headers = {}
        for line in content[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers.get("content-length", "0") or 0)
        yield headers, content[end + 4 : end + 4 + length]
        at = content.find(b"WARC/", end + 4 + length)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, url, date, page_id, refers_to_id, payload_bytes, payload_digest) of the WARC files at `path`.

    The digest of a response is made anew from its payload; a revisit's is the one it declares.
    """
    schema = "record_id string, record_type string, url string, date string, page_id long, refers_to_id string, payload_bytes long, payload_digest string"

    def parsed(frames):
        for frame in frames:
            for content in frame["content"]:
                out = []
                for h, block in warc_records(unpacked(content)):
                    cut = block.find(b"\r\n\r\n") + 4 if block.startswith(b"HTTP/") else 0
                    page = re.search(rb"(?i)" + PAGE_HEADER.encode() + rb": *(-?\d+)", block[:cut])
                    revisit = h.get("warc-type") == "revisit"
                    payload = block[cut:]
                    out.append((
                        h.get("warc-record-id"), h.get("warc-type"), h.get("warc-target-uri"), h.get("warc-date"), int(page[1]) if page else None, h.get("warc-refers-to"),
                        int(h.get("x-payload-length", 0)) if revisit else len(payload), h.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else base32_sha1(payload),
                    ))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")]).astype({"page_id": "Int64"})

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").mapInPandas(parsed, schema)


def archive_round_trip(pages: DataFrame, version: int = 1) -> DataFrame:
    """Pages to ARC, ARC to WARC, and what the WARC files say: one row a page.

    Returns page_id, payload_bytes, payload_digest, record_type and refers_to (the page_id of
    the response that a revisit names). Null html is an empty payload. A null page_id comes
    back null. Repeated rows are records of their own. Empty input gives no rows.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, version)
    arc_to_warc(spark, arc, warc)
    got = staged(read_warc(spark, warc), "records")
    target = got.where("record_type != 'revisit'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    again = got.where("record_type = 'revisit'")
    # the response of a page that a third of all pages repeat meets its revisits in several tasks
    hot = hot_keys(again.groupBy("refers_to_id").agg(F.count("*").alias("n")), "refers_to_id")
    revisits = dealt(again, hot, "refers_to_id", "record_id").join(in_parts(target, hot, "refers_to_id"), ["refers_to_id", "part"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return revisits.select(*columns, "refers_to").union(got.where("record_type != 'revisit'").select(*columns, F.lit(None).cast("long").alias("refers_to")))
