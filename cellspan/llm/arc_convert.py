"""Legacy ARC archives to WARC.

An ARC file opens with a version block whose second line names the header fields (version 1 has five, version 2
has ten); a record is one header line, as many bytes as its last field declares, and a line end. Each becomes a
WARC record with the identifier, date, type and digests that WARC needs; records whose payload another record
holds become revisits of it. Spark's text writer lays the records down (with the record separator as line end), so
archives are committed whole; they are read back file by file and cut by declared lengths. One
archive is what one task wrote; it is read by one task and must stay below 2 GB.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspan.llm.common import stored
from cellspan.plans.sizes import broadcast_if_small

# The field lines of the two versions.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_PAGE_HEADER = "X-Page-Id"

_RECORD_SCHEMA = (
    "record_id string, target_uri string, ip string, warc_date string, warc_type string, content_type string, block binary, "
    "payload_at int, payload_bytes bigint, payload_digest string, block_digest string, page_id bigint"
)
_READ_SCHEMA = "record_id string, warc_type string, refers_to_id string, page_id bigint, payload_bytes bigint, payload_digest string, payload binary"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- ARC ----


def version_block(name: str, version: int) -> bytes:
    body = f"{version} 0 cellspan\n{FIELDS[version]}\n".encode()
    head = ["filedesc://" + name, "0.0.0.0", "19960101000000", "text/plain", *(["200", "-", "-", "0", name] if version == 2 else []), str(len(body))]
    return " ".join(head).encode() + b"\n" + body


def arc_header(url: str, date: str, kind: str, length: int, version: int, offset: int, name: str) -> bytes:
    url = re.sub(r"\s", "%20", url) or "urn:none"
    middle = ["200", "-", "-", str(offset), name] if version == 2 else []
    return " ".join([url, "0.0.0.0", date, kind, *middle, str(length)]).encode("utf-8", "surrogatepass")


def _arc_rows(version: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = f"part-{TaskContext.get().partitionId():05d}.arc"
        block = version_block(name, version)
        offset, first = len(block) + 1, True
        for frame in frames:
            out = [block] if first else []
            first = False
            for page, url, html in zip(frame["page_id"].tolist(), frame["url"], frame["html"], strict=True):
                payload = (html or "").encode("utf-8", "surrogatepass")
                known = [] if pd.isna(page) else [f"{_PAGE_HEADER}: {int(page)}"]
                http = "\r\n".join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", *known, "", ""])
                content = http.encode() + payload
                seconds = 0 if pd.isna(page) else int(page) % 10**9
                date = (pd.Timestamp("2000-01-01") + pd.Timedelta(seconds=seconds)).strftime("%Y%m%d%H%M%S")
                head = arc_header(url or "", date, "text/html", len(content), version, offset, name)
                out.append(head + b"\n" + content)
                offset += len(out[-1]) + 1
            yield pd.DataFrame({"value": out})

    return run


def write_arc(pages: DataFrame, path: str, version: int) -> None:
    """Pages (page_id, url, html) as gzipped ARC files of one version: the legacy input. Null html is empty."""
    rows = pages.select("page_id", "url", "html").mapInPandas(_arc_rows(version), "value binary")
    rows.select(F.col("value").cast("string")).write.option("compression", "gzip").text(path)


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """(header fields, offset, content) of every record but the version block; raises on a malformed one."""
    at, fields = 0, FIELDS[1].split()
    while at < len(data):
        end = data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)]
        if not line.strip():
            at += len(line) + 1
            continue
        parts = line.rstrip(b"\r").decode("utf-8", "surrogatepass").split(" ")
        if line.startswith(b"filedesc://"):
            length = int(parts[-1])
            body = data[end + 1 : end + 1 + length].decode("utf-8", "replace").splitlines()
            if len(body) < 2 or body[0].split(" ")[0] not in ("1", "2"):
                raise ValueError(f"unknown ARC version block at {at}")
            fields = body[1].split()
        else:
            # an old writer may have left spaces in the URL, so fields count from the right
            if end < 0 or len(parts) < len(fields) or not parts[-1].isdigit():
                raise ValueError(f"malformed ARC header at {at}: {line[:200]!r}")
            n = len(fields) - 1
            length = int(parts[-1])
            content = data[end + 1 : end + 1 + length]
            if len(content) < length:
                raise ValueError(f"ARC record at {at} declares {length} bytes and has {len(content)}")
            yield dict(zip(fields, [" ".join(parts[:-n]), *parts[-n:]], strict=True)), at, content
        at = end + 1 + length


# ---- conversion ----


def to_warc(archive: str, fields: dict[str, str], offset: int, content: bytes) -> tuple:
    """One ARC record, at ``offset`` of ``archive``, as the row of :data:`_RECORD_SCHEMA`."""
    date = fields["Archive-date"].ljust(14, "0")[:14]
    stamp = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    http = content.startswith(b"HTTP/")
    cut = content.find(b"\r\n\r\n") + 4 if http else 0
    cut = len(content) if http and cut < 4 else cut
    payload = content[cut:]
    digest = sha1_base32(payload)
    page = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", content[:cut]) if http else None
    record = uuid.uuid5(uuid.NAMESPACE_URL, f"{archive} {offset} {fields['URL']} {date} {digest}")
    return (
        f"<urn:uuid:{record}>", fields["URL"], fields["IP-address"], stamp, "response" if http else "resource",
        "application/http; msgtype=response" if http else fields["Content-type"], content, cut, len(payload), digest,
        sha1_base32(content), int(page[1]) if page else None,
    )


def _converted(narrow: bool):
    names = [x.split()[0] for x in _RECORD_SCHEMA.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for folder, name, content in zip(frame["folder"], frame["name"], frame["content"], strict=True):
                rows, held = [], 0
                for found in arc_records(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content):
                    row = to_warc(f"{folder}/{name}", *found)
                    rows.append((*row[:6], None, *row[7:]) if narrow else row)
                    held += len(row[6])
                    if held > 8_000_000:
                        yield _typed(rows, names)
                        rows, held = [], 0
                yield _typed(rows, names)

    return run


def _typed(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    out["page_id"] = out["page_id"].astype("Int64")
    return out


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.element_at(F.split("path", "/"), -2).alias("folder"), "content")


def convert(spark: SparkSession, arc_path: str, warc_path: str, *, min_bytes: int = 0) -> None:
    """Convert all ARC files below ``arc_path`` to gzipped WARC files below ``warc_path``.

    Of the records with equal payloads of at least ``min_bytes`` bytes the one with the largest page id (a record
    without one is smallest; then the largest record id) stays a response, the others become revisits that keep their
    own HTTP headers. Malformed or cut records raise. No files, no records: empty archives.
    """
    digests = stored(_files(spark, arc_path).mapInPandas(_converted(True), _RECORD_SCHEMA).select("record_id", "payload_digest", "payload_bytes", "page_id", "target_uri", "warc_date"), "payload-digests")
    groups = (
        digests.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "record_id", "target_uri", "warc_date")).alias("keeper")).where("n > 1")
        .select(F.col("payload_digest").alias("__digest"), "keeper")
    )
    records = _files(spark, arc_path).mapInPandas(_converted(False), _RECORD_SCHEMA)
    judged = records.join(broadcast_if_small(groups, materialize=True), F.col("payload_digest") == F.col("__digest"), "left")
    again = F.col("keeper").isNotNull() & (F.col("keeper.record_id") != F.col("record_id"))
    block = F.when(again, F.substring("block", F.lit(1), F.col("payload_at"))).otherwise(F.col("block"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit("WARC/1.0\r\n"), line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.col("warc_type"))),
        line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.col("warc_date")), line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-IP-Address", F.col("ip")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(again, F.concat(
            line("WARC-Refers-To", F.col("keeper.record_id")), line("WARC-Refers-To-Target-URI", F.col("keeper.target_uri")),
            line("WARC-Refers-To-Date", F.col("keeper.warc_date")),
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\n"),
        )).otherwise(line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.col("block_digest")))),
        line("Content-Type", F.col("content_type")), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"),
    )
    value = F.concat(head.cast("binary"), block).cast("string")
    # a record ends with two line ends, which the text writer puts after each row
    judged.select(value.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(warc_path)


# ---- WARC ----


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record, cut by declared lengths; raises on a malformed one."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/1.0\r\n", at) or end < 0:
            raise ValueError(f"no WARC record at {at}")
        fields = dict(x.split(": ", 1) for x in data[at:end].decode("utf-8", "surrogatepass").split("\r\n")[1:])
        length = int(fields["Content-Length"])
        block = data[end + 4 : end + 4 + length]
        at = end + 4 + length
        if len(block) < length or data[at : at + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record is cut short")
        at += 4
        yield fields, block


def _read(with_payload: bool):
    names = [x.split()[0] for x in _READ_SCHEMA.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                rows, held = [], 0
                for fields, block in warc_records(gzip.decompress(content)):
                    http = fields["Content-Type"].startswith("application/http")
                    cut = block.find(b"\r\n\r\n") + 4 if http else 0
                    head, payload = block[:cut], block[cut:]
                    page = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "revisit":
                        size, payload = int(re.search(rb"\r\nContent-Length: (\d+)\r\n", head)[1]), None
                    else:
                        size = len(payload)
                        if sha1_base32(payload) != digest:
                            raise ValueError(f"{fields['WARC-Record-ID']}: its payload has another digest")
                    rows.append((fields["WARC-Record-ID"], fields["WARC-Type"], fields.get("WARC-Refers-To"), int(page[1]) if page else None, size, digest, payload if with_payload else None))
                    held += size
                    if with_payload and held > 8_000_000:
                        yield _typed(rows, names)
                        rows, held = [], 0
                yield _typed(rows, names)

    return run


def read_warc(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """All records below ``path`` (:data:`_READ_SCHEMA`); payload digests are checked while reading."""
    return _files(spark, path).mapInPandas(_read(with_payload), _READ_SCHEMA)


def with_referred_page(records: DataFrame) -> DataFrame:
    """``records`` with ``refers_to``, the page id of the response that a revisit names."""
    answers = records.where("warc_type <> 'revisit'").select(F.col("record_id").alias("__r"), F.col("page_id").alias("refers_to"))
    return records.join(answers, F.col("refers_to_id") == F.col("__r"), "left").drop("__r")
