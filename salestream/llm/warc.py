"""WARC archives: writing with segments and revisits, and reading with segment reassembly.

Writing: a payload is sent as an HTTP response in chunked transfer framing. A block longer than
``SEGMENT_BYTES`` is cut into segments: the first in the response record, the others in continuation records
that name the response as their origin, number themselves, and in the last give the total length. Of equal
payloads of at least ``LEAST_REVISIT`` bytes one is stored, the others are revisit records that refer to it.
Records go out through Spark's text sink (strings are bytes there, and the record end is its line
separator), so the archives are on any file system and are committed like other tables.

Reading: all visible files below a path, packed or not, come whole (written ones unpack to ``FILE_BYTES`` at most, and
no file may be larger than a task's memory) and are parsed
record by record in Arrow batches. Continuation records are grouped by their origin, ordered by number, and
joined; missing, repeated or excess segments and a wrong total length are errors, as is broken framing:
``error`` names it, and the payload is null. Revisits take length and digest from what they refer to. Resources and
conversions are payload throughout; warcinfo, request and metadata records have none, and are no pages.
A stated payload digest (hex or base32, of the payload or of its body as transferred) is compared where its algorithm is
one of ``DIGESTS``.

Defined results: a null payload is written as an empty one, a null target or page id as no header. Control
characters of a target are percent-encoded. Rows that repeat an id are records of their own. Payloads may
hold anything, record ends included. An empty table gives an empty archive and no rows. Where a file is broken,
the records before that place are read, and a row without type and id has an ``error`` with the byte (unpacked) and the file;
the other files are read as ever. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salestream.llm.common import stored, table
from salestream.workspace import new_path

SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
LEAST_REVISIT = 1000
FILE_BYTES = 64_000_000
#: All records of this writer have the same date, so that an archive is the same whenever it is written.
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
DIGESTS = ("sha1", "md5", "sha256")
#: Records that stand for a page; what is broken beyond recognition has no type.
PAGES = ("response", "resource", "revisit")
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

RECORD = "record_type string, record_id string, target string, page_id long, digest string, refers_to string, " \
         "origin string, segment long, total long, block binary"


def _bytes(text: Column | str) -> Column:
    return (F.lit(text) if isinstance(text, str) else text).cast("binary")


def _chunked(payload: Column) -> Column:
    """The payload in chunked transfer framing."""
    piece = lambda at: F.substring(payload, at, F.lit(CHUNK_BYTES))
    chunk = lambda at: F.concat(
        _bytes(F.lower(F.hex(F.octet_length(piece(at)).cast("long")))), _bytes("\r\n"), piece(at), _bytes("\r\n"))
    starts = F.sequence(F.lit(1), F.octet_length(payload), F.lit(CHUNK_BYTES))
    body = F.aggregate(F.transform(starts, chunk), F.lit(b""), lambda a, b: F.concat(a, b))
    return F.concat(F.when(F.octet_length(payload) > 0, body).otherwise(F.lit(b"")), _bytes("0\r\n\r\n"))


def _keyed(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """page_id, target, payload, bytes, sha and key, a digest of all three columns."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("target"), payload.alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload")).withColumn("sha", F.unhex(F.sha2("payload", 256)))
    named = F.concat_ws("|", F.hex("sha"), F.coalesce(F.col("page_id").cast("string"), F.lit("-")),
                        F.coalesce(F.concat(F.lit("="), "target"), F.lit("-")))
    return rows.withColumn("key", F.md5(named.cast("binary")))


def responses_of_groups(keyed: DataFrame, least_revisit: int) -> DataFrame:
    """key, keep (the key of the response) for rows whose payload others have too.

    Rows that are equal in all columns are one key here. Payloads are not moved.
    """
    best = F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "key"))
    by_key = stored(
        keyed.where(F.col("bytes") >= least_revisit).groupBy("key", "sha", "page_id").agg(F.count("*").alias("n")),
        "warc-keys")
    groups = stored(  # both stored, so that Spark can split a large group in the join
        by_key.groupBy("sha").agg(F.sum("n").alias("copies"), best.alias("best")).where("copies > 1")
        .select("sha", F.col("best.key").alias("keep")),
        "warc-groups")
    return by_key.join(groups, "sha").select("key", "keep")


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", least_revisit: int = LEAST_REVISIT) -> None:
    """Write every row of ``pages`` as a record; ``path`` must not exist."""
    keyed = _keyed(pages, id_col, url_col, payload_col)
    keep = responses_of_groups(keyed, least_revisit)
    # rows with one key are equal, so any of them may be the first; the join has put them together
    copy = F.row_number().over(W.partitionBy("key").orderBy("key")) - 1
    numbered = keyed.drop("sha").join(keep, "key", "left").withColumn("copy", copy)
    record_id = lambda key, nth: F.concat(F.lit("<urn:x-page:"), key, F.lit("-"), nth, F.lit(">"))
    revisit = F.col("keep").isNotNull() & ((F.col("key") != F.col("keep")) | (F.col("copy") > 0))
    records = numbered.select(
        record_id(F.col("key"), F.col("copy")).alias("id"), "page_id",
        F.regexp_replace(F.regexp_replace("target", "\r", "%0D"), "\n", "%0A").alias("target"),
        F.when(revisit, record_id(F.col("keep"), F.lit(0))).alias("refers_to"),
        F.sha1("payload").alias("digest"),
        F.when(revisit, F.lit(b"")).otherwise(F.concat(_bytes(HTTP), _chunked(F.col("payload")))).alias("block"))
    length = F.octet_length("block")
    starts = F.when(length > SEGMENT_BYTES, F.sequence(F.lit(1), length, F.lit(SEGMENT_BYTES))).otherwise(F.array(F.lit(1)))
    cut = records.withColumn("total", length).withColumn("starts", starts).withColumn("parts", F.size("starts")).select(
        "*", F.posexplode("starts").alias("at", "from"))
    part = F.substring(F.col("block"), F.col("from"), F.lit(SEGMENT_BYTES))
    first, segmented = F.col("at") == 0, F.col("parts") > 1
    kind = F.when(~first, "continuation").when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")
    own_id = F.when(first, F.col("id")).otherwise(
        F.concat(F.expr("substring(id, 1, length(id) - 1)"), F.lit(":"), F.col("at") + 1, F.lit(">")))
    text = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit(f"\r\nWARC-Date: {DATE}\r\n"),
        _header("WARC-Record-ID", own_id),
        _header("WARC-Target-URI", F.when(first, F.col("target"))),
        _header("WARC-Page-ID", F.when(first, F.col("page_id"))),
        _header("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        _header("WARC-Refers-To", F.when(first, F.col("refers_to"))),
        F.when(F.col("refers_to").isNotNull(), F.lit(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")).otherwise(""),
        _header("WARC-Segment-Number", F.when(segmented, F.col("at") + 1)),
        _header("WARC-Segment-Origin-ID", F.when(~first, F.col("id"))),
        _header("WARC-Segment-Total-Length", F.when(segmented & (F.col("at") + 1 == F.col("parts")), F.col("total"))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("Content-Length", F.octet_length(part)), F.lit("\r\n"))
    out = cut.select(F.concat(_bytes(text), part).cast("string").alias("value"))
    writer = out.write.option("lineSep", END).option("maxRecordsPerFile", max(1, FILE_BYTES // SEGMENT_BYTES))
    writer.option("compression", "gzip").text(path)


_HEADERS = {b"warc-record-id": 1, b"warc-target-uri": 2, b"warc-page-id": 3, b"warc-payload-digest": 4,
            b"warc-refers-to": 5, b"warc-segment-origin-id": 6, b"warc-segment-number": 7,
            b"warc-segment-total-length": 8}
_KINDS = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(),
          pa.int64(), pa.binary())
_NAMES = [c.strip().split()[0] for c in RECORD.split(",")]


def parse_records(content: bytes) -> Iterator[tuple]:
    """The records of an archive file, as rows of ``RECORD``."""
    at, end = 0, len(content)
    while at < end:
        stop = content.find(b"\r\n\r\n", at)
        if stop < 0 or not content.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        row: list = [None] * 10
        length = None
        for line in content[at:stop].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            name, value = name.strip().lower(), value.strip()
            if name == b"warc-type":
                row[0] = value.decode()
            elif name == b"content-length":
                length = int(value)
            elif (k := _HEADERS.get(name)) is not None:
                row[k] = int(value) if k in (3, 7, 8) else value.decode("utf-8", "replace")
        if length is None:
            raise ValueError(f"no Content-Length at byte {at}")
        row[9] = content[stop + 4:stop + 4 + length]
        at = stop + 4 + length
        if len(row[9]) < length or content[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"record is cut off before byte {at}")
        at += 4
        yield tuple(row)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of ``RECORD`` with error."""
    kinds, names = (*_KINDS, pa.string()), [*_NAMES, "error"]
    columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=names)


def _unpacked(content: bytes) -> tuple[bytes, str | None]:
    """What the members of a gzip file hold, as far as they can be read, and what is wrong with them."""
    out = []
    while content:
        member = zlib.decompressobj(31)
        try:
            out.append(member.decompress(content))
        except zlib.error:
            return b"".join(out), "broken gzip member"
        if not member.eof:
            return b"".join(out), "gzip member is cut off"
        content = member.unused_data
    return b"".join(out), None


def gunzip(content: bytes) -> bytes:
    """All members of a gzip file, one for the whole or one for each record."""
    whole, wrong = _unpacked(content)
    if wrong:
        raise ValueError(wrong)
    return whole


def _file_records(file: str, content: bytes) -> Iterator[tuple]:
    """The records of a file with error, and a row that is nothing but an error where it is broken."""
    content, wrong = _unpacked(content) if content[:2] == b"\x1f\x8b" else (content, None)
    try:
        for row in parse_records(content):
            yield *row, None
    except ValueError as error:
        wrong = f"{wrong}, {error}" if wrong else str(error)
    else:
        wrong = wrong and f"{wrong} after byte {len(content)}"
    if wrong:
        yield *[None] * len(_NAMES), f"{wrong} of {file}"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, content in zip(batch.column(0), batch.column(1), strict=True):
            rows, size = [], 0
            for row in _file_records(file.as_py(), content.as_py()):
                rows.append(row)
                size += len(row[9] or b"")
                if size > 2_000_000:
                    yield _record_batch(rows)
                    rows, size = [], 0
            yield _record_batch(rows)


def read_records(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Every record as it stands: the columns of ``RECORD``, and error.

    ``pattern``: names of the files to read; those that begin with a dot or an underscore are hidden.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", pattern).load(path)
    return files.select("path", "content").mapInArrow(_parse, f"{RECORD}, error string")


def reassemble(records: DataFrame) -> DataFrame:
    """Continuations joined to the record they continue: columns of ``RECORD`` without origin, and error.

    Whole records pass by; only segmented ones are shuffled, each by its origin. A group is one record's block.
    """
    base = ["record_type", "record_id", "target", "page_id", "digest", "refers_to"]
    stated = F.col("error") if "error" in records.columns else F.lit(None).cast("string")
    whole = records.where("origin IS NULL AND segment IS NULL").select(*base, "block", stated.alias("error"))
    parts = records.where("origin IS NOT NULL OR segment IS NOT NULL").withColumn(
        "key", F.coalesce("origin", "record_id"))
    firsts = [F.max(F.when(F.col("origin").isNull(), F.col(c))).alias(c) for c in base]
    joined = parts.groupBy("key").agg(
        *firsts, F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"))
    block = F.aggregate(F.col("parts.block"), F.lit(b""), lambda a, b: F.concat(a, b))
    numbers = F.col("parts.segment")
    out = joined.withColumn("block", block).withColumn(
        "error",
        F.when(F.col("record_id").isNull(), "first segment is missing")
        .when(~numbers.eqNullSafe(F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long"))),
              "segments are missing or repeated")
        .when(F.col("total").isNull(), "last segment is missing")
        .when(F.col("total") != F.octet_length("block"), "total length differs"))
    return whole.unionByName(out.select(
        *base[:1], F.coalesce("record_id", "key").alias("record_id"), *base[2:], "block", "error"))


_STATUS_END = re.compile(rb"\r?\n\r?\n")


def decode_http(block: bytes) -> tuple[bytes | None, str | None]:
    """Payload of an HTTP response, and what is wrong with it."""
    head = _STATUS_END.search(block)
    if head is None:
        return None, "no end of HTTP headers"
    headers = block[:head.start()].lower()
    if not re.search(rb"\ntransfer-encoding:[^\n]*chunked", headers):
        return block[head.end():], None
    at, out = head.end(), []
    while True:
        line = block.find(b"\r\n", at)
        size = block[at:line].split(b";")[0].strip() if line >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return None, "broken chunk size"
        n, at = int(size, 16), line + 2
        if n == 0:
            return b"".join(out), None
        if block[at + n:at + n + 2] != b"\r\n":
            return None, "broken chunk end"
        out.append(block[at:at + n])
        at += n + 2


def _differs(stated: str | None, payload: bytes, block: bytes) -> bool:
    """Whether a stated digest is neither that of the payload nor that of the body as transferred."""
    kind, _, value = (stated or "").partition(":")
    if kind.lower() not in DIGESTS:
        return False
    head = _STATUS_END.search(block)
    for body in (payload, block[head.end():] if head else block):
        digest = hashlib.new(kind.lower(), body).digest()
        if value.lower() == digest.hex() or value.upper().rstrip("=") == base64.b32encode(digest).decode().rstrip("="):
            return False
    return True


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        columns = {n: batch.column(i) for i, n in enumerate(names)}
        payloads, errors = [], []
        for kind, block, error, digest in zip(*(columns[c] for c in ("record_type", "block", "error", "digest")), strict=True):
            payload, wrong, kind = None, error.as_py(), kind.as_py()
            if wrong is None and kind == "response":
                payload, wrong = decode_http(block.as_py())
            elif wrong is None and kind in ("resource", "conversion"):
                payload = block.as_py()
            if payload is not None and _differs(digest.as_py(), payload, block.as_py()):
                wrong = "digest differs"
            payloads.append(payload)
            errors.append(wrong)
        columns |= {
            "payload": pa.array(payloads, pa.binary()), "error": pa.array(errors, pa.string()),
            "payload_bytes": pa.array([p if p is None else len(p) for p in payloads], pa.int64()),
            "payload_digest": pa.array([p if p is None else hashlib.sha1(p).hexdigest() for p in payloads], pa.string())}
        order = ["record_type", "record_id", "target", "page_id", "digest", "refers_to", "payload", "error",
                 "payload_bytes", "payload_digest"]
        yield pa.RecordBatch.from_arrays([columns[n] for n in order], names=order)


def read_archive(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """All records, segments put together: record_type, record_id, target, page_id, digest, refers_to, payload, error,
    payload_bytes, payload_digest.

    ``digest`` is the one that the archive states; a response whose payload has another gets an error.
    """
    return reassemble(read_records(spark, path, pattern)).mapInArrow(
        _decode, "record_type string, record_id string, target string, page_id long, digest string, "
                 "refers_to string, payload binary, error string, payload_bytes long, payload_digest string")


def resolve(archive: DataFrame) -> DataFrame:
    """One row per page record: page_id, payload_bytes, payload_digest, record_type, refers_to, error.

    Records of other types than ``PAGES`` are left out; what is broken beyond recognition is a row with an error.
    A revisit has the figures of the response it names. Responses are looked up by their record id, so the
    revisits of one response may meet in a partition; adaptive execution splits it.
    """
    pages = archive.where(F.col("record_type").isin(*PAGES) | F.col("record_type").isNull())
    found = stored(pages.select(
        "record_type", "record_id", "page_id", "refers_to", "error", "payload_bytes", "payload_digest"), "warc-read")
    responses = found.where("refers_to IS NULL").drop("refers_to")
    named = responses.select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("response_page"),
        F.col("payload_bytes").alias("response_bytes"), F.col("payload_digest").alias("response_digest"))
    revisits = found.where("refers_to IS NOT NULL").join(named, "refers_to", "left")
    return responses.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"), "error",
    ).unionByName(revisits.select(
        "page_id", F.col("response_bytes").alias("payload_bytes"), F.col("response_digest").alias("payload_digest"),
        "record_type", F.col("response_page").alias("refers_to"),
        F.coalesce("error", F.when(F.col("response_bytes").isNull(), "response is missing")).alias("error")))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archive")
    write_archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return resolve(read_archive(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes,
           sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT body, max(page_id) AS keep FROM p WHERE payload_bytes >= 1000 GROUP BY body HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN keep <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keep <> page_id THEN keep END AS refers_to,
       CAST(NULL AS VARCHAR) AS error
FROM p LEFT JOIN g USING (body)
"""
