"""WARC archives compressed with Zstandard: one frame for each record, and the dictionary in a leading skippable frame.

Records are written by the tasks that hold the pages, in archives of about archive_bytes, in the shared folder. A task writes under a
temporary name and renames, and its archives' names depend on its partition alone, so a repeated task leaves the same files. The reader
takes one archive at a time, finds the frames from their block headers, and checks each record's headers, lengths and digests. It
reads archives of other writers too: WARC 1.0 and 1.1, with or without a dictionary, records of any type and any id.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.shared import filesystem, new_path, start, written

DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
VERSION = b"WARC/1.1"
VERSIONS = ("WARC/1.0", "WARC/1.1")
_PAGE = re.compile(r"<urn:page:(-?[0-9]{1,18})>")
_HASHES = {"sha1": hashlib.sha1, "sha256": hashlib.sha256, "md5": hashlib.md5}
DATE = "2000-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """A damaged archive or record."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()  # noqa: S324 - the format's digest


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a response with its HTTP message, or a revisit of an equal payload without it."""
    name = "none" if page_id is None else str(page_id)
    head = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
    ]
    if url:
        head.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%-._~"))
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[str]) -> dict[str, str]:
    """Header lines as a dict with lower-case names; a line that begins with white space goes on with the one before."""
    fields, last = {}, None
    for line in lines:
        if line[:1] in (" ", "\t") and last is not None:
            fields[last] += " " + line.strip()
            continue
        k, colon, v = line.partition(":")
        if not colon:
            raise WarcError(f"header without a colon: {line[:80]}")
        last = k.strip().lower()
        fields[last] = v.strip()
    return fields


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record; WarcError where they aren't sound."""
    head, found, rest = data.partition(b"\r\n\r\n")
    try:
        lines = head.decode().split("\r\n")
    except UnicodeDecodeError as e:
        raise WarcError("the header isn't text") from e
    if not found or lines[0] not in VERSIONS:
        raise WarcError("no WARC header")
    fields = _fields(lines[1:])
    for k in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if k not in fields:
            raise WarcError(f"no {k}")
    size = fields["content-length"]
    if not (size.isascii() and size.isdecimal()) or len(rest) != int(size) + 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError("the block's length is not the stated one")
    _check(fields.get("warc-block-digest"), rest[:-4])
    return fields, rest[:-4]


def _check(stated: str | None, *forms: bytes) -> None:
    """A digest in base32 or hex has to be that of one of the forms; one of another kind isn't checked."""
    name, _, value = (stated or "").partition(":")
    make = _HASHES.get(name.lower().replace("-", ""))
    if make is None or not value:
        return
    for data in forms:
        h = make(data)
        if value.upper() in (base64.b32encode(h.digest()).decode(), base64.b32encode(h.digest()).decode().rstrip("=")) or value.lower() == h.hexdigest():
            return
    raise WarcError("the digest is not the stated one")


def _http(block: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers and body of an HTTP message, or None where the block isn't one. Header bytes are taken as Latin-1."""
    if not block.startswith(b"HTTP/") and not re.match(rb"[A-Z]+ [^\r\n]* HTTP/[0-9.]+\r\n", block):
        return None
    head, found, body = block.partition(b"\r\n\r\n")
    if not found and not block.endswith(b"\r\n"):
        raise WarcError("no end of the HTTP header")
    return _fields([x for x in head.decode("latin-1").split("\r\n")[1:] if x]), body


def _unchunked(body: bytes) -> bytes | None:
    """The body of a chunked message; None where it isn't one."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,8}", size):
            return None
        n = int(size, 16)
        if not n:
            return b"".join(out)
        if body[end + 2 + n : end + 4 + n] != b"\r\n":
            return None
        out.append(body[end + 2 : end + 2 + n])
        at = end + 4 + n


def payload_of(fields: dict[str, str], block: bytes) -> bytes:
    """The payload of a record: the body of an HTTP message, chunks joined, else the block. Checked against the message's length and the
    record's digest, unless the record says that it is truncated."""
    if not fields.get("content-type", "").lower().startswith("application/http"):
        _check(fields.get("warc-payload-digest"), block)
        return block
    message = _http(block)
    if message is None:
        raise WarcError("no HTTP header")
    head, body = message
    chunks = _unchunked(body) if "chunked" in head.get("transfer-encoding", "").lower() else None
    if "warc-truncated" in fields:
        return body if chunks is None else chunks
    if chunks is None and "transfer-encoding" not in head and stated_length(head) not in (None, len(body)):
        raise WarcError("the payload's length is not the stated one")
    _check(fields.get("warc-payload-digest"), *([body] if chunks is None else [chunks, body]))
    return body if chunks is None else chunks


def stated_length(head: dict[str, str]) -> int | None:
    size = head.get("content-length")
    if size is not None and not (size.isascii() and size.isdecimal()):
        raise WarcError("no number for a length")
    return None if size is None else int(size)


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def frames(data: memoryview) -> Iterator[memoryview]:
    """Each frame, whole; where one ends is read from its block headers. Skippable frames are passed over."""
    at, size = 0, len(data)
    while at < size:
        if size - at < 8:
            raise WarcError("the archive breaks off")
        magic, length = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + length
            if at > size:
                raise WarcError("the archive breaks off")
            continue
        if magic != FRAME_MAGIC:
            raise WarcError("not a frame")
        try:
            begin, what = at, zstd.get_frame_parameters(bytes(data[at : at + 18]))
            at += zstd.frame_header_size(bytes(data[at : at + 18]))
        except zstd.ZstdError as e:
            raise WarcError(f"a frame's header can't be read: {e}") from e
        last = False
        while not last:
            if at + 3 > size:
                raise WarcError("the archive breaks off")
            header = data[at] | data[at + 1] << 8 | data[at + 2] << 16
            last, kind, length = bool(header & 1), header >> 1 & 3, header >> 3
            at += 3 + (1 if kind == 1 else length)
        at += 4 * what.has_checksum
        if at > size:
            raise WarcError("the archive breaks off")
        yield data[begin:at]


def decoder(data: memoryview) -> zstd.ZstdDecompressor:
    """With the dictionary of the leading skippable frame, plain or itself compressed, if there is one."""
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        length = struct.unpack_from("<I", data, 4)[0]
        inner = bytes(data[8 : 8 + length])
        if len(inner) < length:
            raise WarcError("the archive breaks off")
        if inner[:4] == struct.pack("<I", FRAME_MAGIC):
            try:
                inner = zstd.ZstdDecompressor().decompressobj().decompress(inner)
            except zstd.ZstdError as e:
                raise WarcError(f"the dictionary can't be decoded: {e}") from e
        return zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(inner))
    return zstd.ZstdDecompressor()


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive."""
    view = memoryview(data)
    z = decoder(view)
    for frame in frames(view):
        try:
            raw = z.decompressobj().decompress(frame)
        except zstd.ZstdError as e:
            raise WarcError(f"a frame can't be decoded: {e}") from e
        yield parse(raw)


def train(samples: list[bytes], size: int = 16 << 10) -> bytes:
    """A dictionary of the samples; where there are too few, their last bytes; empty without samples."""
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-size:]


def _write(folder: str, dictionary: bytes, archive_bytes: int, level: int):  # noqa: ANN202
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, root = filesystem(folder)
        z = zstd.ZstdCompressor(level=level, write_checksum=True, dict_data=zstd.ZstdCompressionDict(dictionary) if dictionary else None)
        out, temporary, size, records, done = None, "", 0, 0, []

        def close() -> None:
            nonlocal out
            out.close()
            name = f"{root}/part-{task.partitionId():06d}-{len(done):05d}.warc.zst"
            if fs.get_file_info(name).type != pafs.FileType.NotFound:
                fs.delete_file(name)
            fs.move(temporary, name)
            done.append((name, records, size))
            out = None

        for batch in batches:
            for page_id, url, html, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    temporary = f"{root}/_part-{task.partitionId():06d}-{len(done):05d}-{task.taskAttemptId()}"
                    out, size, records = fs.open_output_stream(temporary, compression=None), 0, 0
                    size += out.write(dictionary_frame(dictionary)) if dictionary else 0
                size += out.write(z.compress(record(page_id, url, html.encode(), first)))
                records += 1
                if size >= archive_bytes:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({
            "archive": pa.array([folder.rstrip("/") + "/" + n.rsplit("/", 1)[1] for n, _, _ in done], pa.string()),
            "records": pa.array([r for _, r, _ in done], pa.int64()), "bytes": pa.array([b for _, _, b in done], pa.int64()),
        })

    return write


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = 32 << 20, level: int = 3, sample_rows: int = 1000, hot_rows: int = 100_000) -> DataFrame:
    """Write a record for each row of pages (page_id, url, html); returns archive, records and bytes of each archive, written.

    Of rows with equal payloads of min_bytes or more, those with the smallest page_id are responses and the others revisit it. A null
    html is empty; a null page_id is written as none, is always a response and is referred to by none; a null url is left out. Rows
    that repeat the smallest page_id are responses too. An empty table writes no archive. Other columns are ignored.
    The dictionary is trained on about sample_rows pages of up to 64 KB, taken by hash. A payload that many pages share meets its
    smallest page_id by a broadcast of the at most count / hot_rows hot digests, and is spread by page and by the partition that reads it; others
    meet it in a join on the digest. Equal digests are equal payloads. A payload of any length is one record, held whole by its task.
    """
    start(pages)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumn("digest", F.sha1("html"))
    groups = pages.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = written(groups, "digests")
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    share = min(1.0, 2.0 * sample_rows / max(1, total))
    bound = int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1
    sample = pages.where((F.xxhash64("page_id", "digest") <= bound) & (F.octet_length("html") <= 65536)).limit(sample_rows)
    dictionary = train([bytes(r.encode()) for (r,) in sample.select("html").collect() if r])

    shared = groups.where("n > 1 and first is not null").select("digest", "first", "n")
    hot = shared.where(F.col("n") > hot_rows).select("digest", F.col("first").alias("hot_first"))
    rows = pages.join(F.broadcast(hot), "digest", "left")
    spread = F.when(F.col("hot_first").isNull(), F.col("digest")).otherwise(F.concat_ws("-", F.lit(""), F.col("page_id").cast("string"), F.spark_partition_id().cast("string")))
    cold = shared.where(F.col("n") <= hot_rows).select(F.col("digest").alias("meet"), "first")
    rows = rows.withColumn("meet", spread).join(cold, "meet", "left").withColumn("first", F.coalesce("hot_first", "first"))
    rows = rows.select("page_id", "url", "html", F.when((F.octet_length("html") >= min_bytes) & (F.col("page_id") != F.col("first")), F.col("first")).alias("first"))
    return written(rows.mapInArrow(_write(folder, dictionary, archive_bytes, level), "archive string, records long, bytes long"), "archives")


READ = "page_id long, record_id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, refers_to_id string"


def _row(fields: dict[str, str], block: bytes) -> dict:
    """A record's row of READ."""
    page = lambda v: int(m[1]) if v and (m := _PAGE.fullmatch(v)) else None
    revisit = fields["warc-type"] == "revisit"
    payload = None if revisit else payload_of(fields, block)
    message = _http(block) if revisit else None
    digest = fields.get("warc-payload-digest")
    digest = digest.removeprefix("sha1:") if digest else None if revisit else digest_of(payload)
    return {
        "page_id": page(fields["warc-record-id"]), "record_id": fields["warc-record-id"], "url": fields.get("warc-target-uri"), "payload": payload,
        "payload_bytes": len(payload) if payload is not None else stated_length(message[0]) if message else None, "payload_digest": digest, "record_type": fields["warc-type"],
        "refers_to": page(fields.get("warc-refers-to")), "refers_to_id": fields.get("warc-refers-to"),
    }


def _read(types: Sequence[str] | None):  # noqa: ANN202
    names = [x.split()[0] for x in READ.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = filesystem(path)
                with fs.open_input_stream(name, compression=None) as f:
                    data = f.read()
                rows: dict[str, list] = {c: [] for c in names}
                held = 0
                for fields, block in read_archive(data):
                    if types is not None and fields["warc-type"] not in types:
                        continue
                    for c, v in _row(fields, block).items():
                        rows[c].append(v)
                    held += len(block)
                    if held > 16 << 20:
                        yield _batch(rows)
                        rows, held = {c: [] for c in names}, 0
                yield _batch(rows)

    return read


def _batch(rows: dict[str, list]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "payload": pa.binary(), "payload_bytes": pa.int64(), "refers_to": pa.int64()}
    return pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.string())) for c, v in rows.items()})


def read_warc(archives: DataFrame, types: Sequence[str] | None = ("response", "revisit")) -> DataFrame:
    """The records of archives (column archive): page_id, record_id, url, payload (null for revisits), payload_bytes, payload_digest, record_type,
    refers_to and refers_to_id.

    Records of other types than `types` (None: all) are checked like all others and then passed over: warcinfo, request, metadata. page_id and refers_to
    are numbers where an id is one that write_warc gives, else null. A payload is the body of an HTTP message (chunks joined), or the block of
    another record; its length is checked where the message states one, its digest and the block's where the record has one of SHA-1, SHA-256 or MD5;
    a response without a digest gets its SHA-1. A revisit's payload_bytes is the length that its HTTP header states, null without one.
    A record that fails a check raises WarcError, with nothing left out silently; an empty table gives no rows.
    """
    start(archives)
    n = max(1, archives.count())
    return archives.select("archive").repartition(n).mapInArrow(_read(types), READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """What reading back the archives of pages gives for each page, without url and payload. For cases, see write_warc."""
    folder = new_path(pages.sparkSession, "warc")
    return read_warc(write_warc(pages, folder)).drop("record_id", "url", "payload", "refers_to_id")


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN g USING (hex)
"""
