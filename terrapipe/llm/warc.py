"""WARC archives compressed with Zstandard: writer and reader.

An archive file opens with a skippable frame (magic ``0x184D2A5D``) that
holds the dictionary, itself a Zstandard frame or plain; then every record is
one frame of its own, made with that dictionary. The reader loads the
dictionary from the leading frame, walks from frame to frame by their headers,
decodes one at a time and validates version line, header fields, dates, ids,
lengths and digests.

Payloads seen before are written as ``revisit`` records without a body.

The reader takes archives of other tools too: without a dictionary, with other
skippable frames, with several records in a frame, with records of any type,
WARC 1.0 or 1.1, folded fields, names in any case, digests of any kind or none.
Fields of our own (``X-...``) are used where they are and needed nowhere.
Whatever is not a valid archive raises :class:`BadArchive`.
"""

from __future__ import annotations

import base64
import binascii
import datetime as dt
import hashlib
import json
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapipe.llm.shared import PartFiles, is_committed, pieces, staged
from terrapipe.session import run_dir

DICTIONARY_FRAME = 0x184D2A5D
#: Sixteen magic numbers from here are frames to skip.
SKIPPABLE = 0x184D2A50
FRAME = 0xFD2FB528
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Fields of our own: the page's number, that of the page a revisit repeats, the length of a revisit's full payload
#: (which its block leaves out), and a url as it came where it cannot stand in a field.
PAGE, REFERS_TO_PAGE, FULL_LENGTH, ORIGINAL = "X-Page-ID", "X-Refers-To-Page", "X-Payload-Length", "X-Original-URI"
RECORD = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
          "record_type string, refers_to long, record_id string, date string")
DATE = re.compile(r"\d{4}(-\d\d(-\d\d(T\d\d:\d\d(:\d\d(\.\d{1,9})?)?Z)?)?)?")
RECORD_ID = re.compile(r"<[A-Za-z][A-Za-z0-9+.-]*:[^<>\s]+>")
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")


class BadArchive(ValueError):
    """A file that is not a valid archive; the message names the place."""


# ---- one archive -------------------------------------------------------------

def leading_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=9).compress(dictionary)
    return struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed


def _field_safe(url: str) -> str:
    """The url as a field can hold it: white space and control characters escaped, all else as it is."""
    return re.sub(r"[\x00-\x20\x7f-\x9f\u2028\u2029]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, record_id: str, date: str,
           refers_to_url: str | None = None) -> bytes:
    """The bytes of one record before compression."""
    head = HTTP.encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_field_safe(url)}")
        if _field_safe(url) != url or url[:1] == "<":
            lines.append(f"{ORIGINAL}: {json.dumps(url)}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To-Date: {date}",
                  f"{REFERS_TO_PAGE}: {refers_to}"]
        if refers_to_url is not None:
            lines.append(f"WARC-Refers-To-Target-URI: {_field_safe(refers_to_url)}")
    if page_id is not None:
        lines.append(f"{PAGE}: {page_id}")
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
              f"{FULL_LENGTH}: {len(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _number(data: bytes, at: int) -> int:
    if len(data) - at < 4:
        raise BadArchive(f"the file ends inside a frame header at byte {at}")
    return struct.unpack_from("<I", data, at)[0]


def frames(data: bytes) -> Iterator[tuple[int, int]]:
    """``(begin, end)`` of every frame of records; checks that they and frames to skip tile the file."""
    at = 0
    while at < len(data):
        magic = _number(data, at)
        if magic & ~0xF == SKIPPABLE:
            at += 8 + _number(data, at + 4)
            if at > len(data):
                raise BadArchive("a skippable frame is cut off")
            continue
        if magic != FRAME or len(data) - at < 6:
            raise BadArchive(f"no frame at byte {at}")
        begin, flags = at, data[at + 4]
        try:
            at += zstandard.frame_header_size(data[at:at + 18])
        except zstandard.ZstdError as error:
            raise BadArchive(f"the frame header at byte {begin}: {error}") from error
        last = False
        while not last:
            if at + 3 > len(data):
                raise BadArchive(f"the frame at byte {begin} is cut off")
            header = int.from_bytes(data[at:at + 3], "little")
            last, kind, size = header & 1, header >> 1 & 3, header >> 3
            if kind == 3:
                raise BadArchive(f"reserved block kind at byte {at}")
            at += 3 + (1 if kind == 1 else size)
        at += 4 if flags & 4 else 0
        if at > len(data):
            raise BadArchive(f"the frame at byte {begin} is cut off")
        yield begin, at


def _text(data: bytes) -> str:
    try:
        return data.decode()
    except UnicodeDecodeError:
        return data.decode("latin-1")


def fields_of(head: bytes) -> dict[str, str]:
    """A header's fields by lower-case name: unfolded, of repeated ones the first."""
    version, *lines = re.split(r"\r?\n", _text(head))
    if version not in ("WARC/1.1", "WARC/1.0"):
        raise BadArchive(f"not a record: {version[:40]!r}")
    fields: dict[str, str] = {}
    name = None
    for line in lines:
        if line[:1] in (" ", "\t"):
            if name is None:
                raise BadArchive(f"a folded line without a field: {line[:40]!r}")
            fields[name] += " " + line.strip(" \t")
            continue
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise BadArchive(f"not a field: {line[:40]!r}")
        name = name.strip(" \t").lower()
        if name in fields:
            name = "repeated " + name
        fields[name] = value.strip(" \t")
    return fields


def digest_fits(field: str, data: bytes) -> bool:
    """Whether a digest field (``sha1:...``, hexadecimal, base 32 or base 64) fits the data; of a kind unknown here, any does."""
    kind, _, shown = field.partition(":")
    kind = kind.strip().lower().replace("-", "")
    if kind not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return True
    wanted, shown = hashlib.new(kind, data).digest(), shown.strip()
    for read in (bytes.fromhex, lambda s: base64.b32decode(s + "=" * (-len(s) % 8), casefold=True),
                 lambda s: base64.b64decode(s.replace("-", "+").replace("_", "/") + "=" * (-len(s) % 4), validate=True)):
        try:
            if read(shown.rstrip("=") if read is not bytes.fromhex else shown) == wanted:
                return True
        except (ValueError, binascii.Error):
            pass
    return False


def _int(fields: dict[str, str], name: str) -> int | None:
    value = fields.get(name.lower())
    if value is None:
        return None
    if not re.fullmatch(r"-?[0-9]{1,19}", value):
        raise BadArchive(f"{name} is no number: {value[:40]!r}")
    return int(value)


def _http_payload(block: bytes) -> tuple[bytes, bool]:
    """The body of an HTTP message, and whether it is the payload as digests count it (not in a transfer encoding)."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        head, gap, body = block.partition(b"\n\n")
    return (body, b"transfer-encoding:" not in head.lower()) if gap else (b"", True)


def parse(raw: bytes, at: int = 0) -> tuple[tuple, int]:
    """Validate the decoded record at byte ``at``: the values of ``RECORD`` in order, and where the next record begins."""
    edge = re.compile(rb"\r?\n\r?\n").search(raw, at)
    if not edge:
        raise BadArchive(f"a record's header does not end: {raw[at:at + 40]!r}")
    fields = fields_of(raw[at:edge.start()])
    for name in MANDATORY:
        if name not in fields:
            raise BadArchive(f"field {name} is missing")
    key = fields["warc-record-id"]
    if not RECORD_ID.fullmatch(key):
        raise BadArchive(f"WARC-Record-ID is no <uri>: {key[:60]!r}")
    if not DATE.fullmatch(fields["warc-date"]):
        raise BadArchive(f"WARC-Date of {key}: {fields['warc-date'][:40]!r}")
    n = _int(fields, "Content-Length")
    if n < 0:
        raise BadArchive(f"Content-Length of {key} is negative")
    block, after = raw[edge.end():edge.end() + n], edge.end() + n
    if len(block) != n or raw[after:after + 4] != b"\r\n\r\n":
        raise BadArchive(f"Content-Length {n} does not fit the record {key}")
    if "warc-block-digest" in fields and not digest_fits(fields["warc-block-digest"], block):
        raise BadArchive(f"block digest of {key}")
    kind, http = fields["warc-type"], fields.get("content-type", "").lower().startswith("application/http")
    payload, plain = _http_payload(block) if http else (block, True)
    given, length = fields.get("warc-payload-digest"), _int(fields, FULL_LENGTH)
    if kind == "revisit":
        payload = None
        digest = given.partition(":")[2].strip() if given and given.lower().startswith("sha256:") else given
    else:
        if length is not None and length != len(payload):
            raise BadArchive(f"payload length of {key}")
        if given and plain and "warc-truncated" not in fields and "warc-segment-number" not in fields and not digest_fits(given, payload):
            raise BadArchive(f"payload digest of {key}")
        length, digest = len(payload), hashlib.sha256(payload).hexdigest()
    url = fields.get("warc-target-uri")
    if url is not None and url[:1] == "<" and url[-1:] == ">":
        url = url[1:-1]
    if ORIGINAL.lower() in fields:
        try:
            url = str(json.loads(fields[ORIGINAL.lower()]))
        except ValueError as error:
            raise BadArchive(f"{ORIGINAL} of {key}") from error
    return (_int(fields, PAGE), url, payload, length, digest, kind, _int(fields, REFERS_TO_PAGE), key, fields["warc-date"]), after + 4


def read_archive(data: bytes) -> Iterator[tuple]:
    """The records of an archive, decoded one frame at a time."""
    dictionary = b""
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", data, 4)[0]
        if 8 + size > len(data):
            raise BadArchive("the leading frame is cut off")
        dictionary = data[8:8 + size]
        if dictionary[:4] == struct.pack("<I", FRAME):
            dictionary = _decoded(zstandard.ZstdDecompressor(), dictionary, 0)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    for begin, end in frames(data):
        raw, at = _decoded(decoder, data[begin:end], begin), 0
        while at < len(raw):
            found, at = parse(raw, at)
            yield found


def _decoded(decoder: zstandard.ZstdDecompressor, data: bytes, at: int) -> bytes:
    """A frame's content, whether or not its header says how long it is."""
    try:
        reader = decoder.decompressobj()
        out = reader.decompress(data)
        if not reader.eof:
            raise BadArchive(f"the frame at byte {at} does not end")
        return out
    except zstandard.ZstdError as error:
        raise BadArchive(f"the frame at byte {at}: {error}") from error


# ---- tables ------------------------------------------------------------------

def train_dictionary(pages: DataFrame, html_column: str = "html", sample: int = 300, size: int = 64 << 10) -> bytes:
    """A dictionary from ``sample`` pages at most (it decides sizes, never contents); empty if that is too little."""
    texts = [(r[0] or "").encode() for r in pages.select(F.substring(html_column, 1, 16384)).limit(sample).collect()]
    try:
        return zstandard.train_dictionary(size, texts, level=3).as_bytes() if sum(map(len, texts)) > 20 * size else b""
    except zstandard.ZstdError:
        return b""


def write_warc(pages: DataFrame, folder: str, dictionary: bytes, least: int = 100, archive_bytes: int = 16 << 20, date: str | None = None) -> DataFrame:
    """Write a record per row of ``page_id, url, html`` below ``folder``; a row per file: ``part, attempt, file, records``.

    All records have one ``date`` (that of the call, if none is given) and an id of their own.

    Null html: the empty payload; null ``page_id``: a record without number;
    null url: no target field. Of records with equal payloads of ``least``
    bytes or more, those with the smallest ``page_id`` are responses (all of
    them, should that number repeat, and all if no number is known), the
    others revisit it. A file is closed once its raw records reach
    ``archive_bytes``. An empty table gives no file.

    Only payloads with several records make the table of digests, and it
    meets the pages in a plain equi-join: broadcast if small, else a
    sort-merge join whose hot digests adaptive execution splits.
    """
    spark = pages.sparkSession
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    source = source.withColumn("digest", F.sha2("payload", 256))
    repeated = staged(source.where(F.length("payload") >= least).groupBy("digest")
                      .agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"), F.count("*").alias("_n"))
                      .where((F.col("_n") > 1) & F.col("first").isNotNull())
                      .select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")), "warc-repeats")
    rows = source.join(repeated, "digest", "left").select("page_id", "url", "payload", "digest", "first_id", "first_url")
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    run = uuid.uuid4().bytes
    shipped = spark.sparkContext.broadcast(dictionary)  # bounded by the size asked for

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = zstandard.ZstdCompressionDict(shipped.value) if shipped.value else None
        encoder = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)
        parts, files, out, raw, n = PartFiles(folder, ".warc.zst"), [], [leading_frame(shipped.value)], 0, 0

        def close() -> None:
            nonlocal out, raw, n
            files.append({"part": parts.part, "attempt": parts.attempt, "file": parts.write(b"".join(out)), "records": n})
            out, raw, n = out[:1], 0, 0

        for batch in pieces(batches, "payload"):
            for page_id, url, payload, digest, first, first_url in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                revisit = first is not None and page_id != first
                place = run + struct.pack("<qqqq", parts.part, parts.attempt, len(files), n)
                key = uuid.UUID(bytes=hashlib.blake2b(place, digest_size=16).digest(), version=4)
                data = record(page_id, url, payload, digest, first, revisit, f"<urn:uuid:{key}>", date, first_url)
                out.append(encoder.compress(data))
                raw, n = raw + len(data), n + 1
                if raw >= archive_bytes:
                    close()
        if n:
            close()
        yield pa.RecordBatch.from_pylist(files, schema=pa.schema(
            [("part", pa.int64()), ("attempt", pa.int64()), ("file", pa.string()), ("records", pa.int64())]))

    return rows.mapInArrow(write, "part long, attempt long, file string, records long")


def read_warc(spark: SparkSession, folder: str, attempts: dict[int, int] | None = None) -> DataFrame:
    """Every record of the archives in ``folder``: the columns of ``RECORD``. A damaged file fails with :class:`BadArchive`.

    Records of other tools have no ``page_id`` and no ``refers_to``; a revisit without our length has null ``payload_bytes``, and one
    with another digest than SHA-256 has the digest as the field shows it. Records that are no HTTP messages have their block as payload.
    ``attempts`` leaves out what write tasks left that Spark did not commit.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD.split(", ")]
        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                if attempts is not None and not is_committed(path.as_py(), attempts):
                    continue
                rows, held = [], 0
                for row in read_archive(content.as_py()):
                    rows.append(row)
                    held += len(row[2] or b"") + 200
                    if held > 8 << 20:
                        yield _batch(names, rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(names, rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("path", "content").mapInArrow(read, RECORD)


def _batch(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write the archives into a fresh shared folder, then read every record back."""
    spark = pages.sparkSession
    folder = run_dir(spark, "warc") + "/archives"
    written = staged(write_warc(pages, folder, train_dictionary(pages), **options), "warc-files")
    attempts = {r["part"]: r["attempt"] for r in written.select("part", "attempt").distinct().collect()}  # a row per write task
    return read_warc(spark, folder, attempts) if attempts else spark.createDataFrame([], RECORD)
