"""WARC archives in Zstandard form: one frame per record, the dictionary in front.

An archive begins with a skippable frame that holds the compression dictionary; each
record follows as a frame of its own, so any record can be decoded from its offset alone.
Records with equal payloads are written once as a response and else as revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.llm.shared import materialise, shared_folder, table
from pagewell.llm.token_files import open_output

# Fixed values of the format.
SKIPPABLE, DICTIONARY, FRAME = 0x184D2A5D, 0xEC30A437, b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

DATE = "2025-01-01T00:00:00Z"
ID = "urn:pagewell:page:"
#: A new archive is begun beyond so many bytes; read so many at a time.
ARCHIVE_BYTES, READ_BYTES = 256 << 20, 1 << 20
#: The dictionary is trained on so many pages (those with the least hash), this much of each.
DICTIONARY_PAGES, DICTIONARY_CHARS, DICTIONARY_BYTES = 256, 16_384, 64 << 10
#: So many times the sample is expected below the bound that it is taken from.
SPARE = 4
#: Digests of repeated payloads, about 60 bytes each, are broadcast up to so many.
BROADCAST_DIGESTS = 500_000
ARCHIVES = "path string, records long"
RECORDS = ("record_id string, record_type string, target_uri string, date string, "
           "payload_bytes long, payload_digest string, refers_to string, payload binary, error string")


def train_dictionary(pages: DataFrame, html: str = "html", key: str = "page_id") -> bytes:
    """A dictionary from a bounded sample; empty where the sample is too small for one.

    The least hashes of a uniform hash lie below a bound that follows from the number of
    pages, so tasks send about `SPARE` times the sample together, however many they are.
    """
    share = min(1.0, SPARE * DICTIONARY_PAGES / max(1, pages.count()))
    bound = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    rows = pages.where(F.col(html).isNotNull() & (F.xxhash64(key) <= bound)).select(
        F.substring(F.col(html), 1, DICTIONARY_CHARS).alias("html"), F.xxhash64(key).alias("h"))
    sample = [r["html"].encode() for r in rows.orderBy("h", "html").limit(DICTIONARY_PAGES).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes() if len(sample) > 7 else b""
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor().compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(packed)) + packed


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", "sha1:" + _digest(block)), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """A response, or a revisit of the page `refers_to` with the same payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"),
               ("WARC-Record-ID", f"<{ID}{page}>"), ("WARC-Date", DATE),
               ("WARC-Payload-Digest", "sha1:" + _digest(payload)),
               ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID}{refers_to}>")]
    return _record(headers, http if refers_to is not None else http + payload)


def _write(folder: str, dictionary: bytes):
    def run(batches):
        context = TaskContext.get()
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        # An explicit content size lets the reader check the length of each frame.
        press = zstandard.ZstdCompressor(level=6, dict_data=known, write_checksum=True)
        sink, name, size, records, count = None, "", 0, 0, 0
        done = []
        for batch in batches:
            for page, url, html, to in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    name = f"{folder}/pages-{context.partitionId():06d}-{context.taskAttemptId()}-{count}.warc.zst"
                    sink, records, count = open_output(name), 0, count + 1
                    info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:pagewell:archive:{name.rpartition('/')[2]}>"),
                                    ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
                                   b"software: pagewell\r\nformat: WARC File Format 1.1\r\n")
                    head = (dictionary_frame(dictionary) if dictionary else b"") + press.compress(info)
                    sink.write(head)
                    size = len(head)
                page = "null" if page is None else str(page)
                frame = press.compress(page_record(page, url, (html or "").encode(), None if to is None else str(to)))
                sink.write(frame)
                size, records = size + len(frame), records + 1
                if size >= ARCHIVE_BYTES:
                    sink.close()
                    done.append((name, records))
                    sink = None
        if sink is not None:
            sink.close()
            done.append((name, records))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["path", "records"])
    return run


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, key: str = "page_id",
                   url: str = "url", html: str = "html") -> DataFrame:
    """Writes a record per page into archives in `folder`; gives `path, records` of them.

    A null html is an empty payload. Of equal payloads of at least `least_bytes` bytes the
    one with the largest key is the response and the others revisit it; rows that share
    that key are all responses, and so are payloads whose keys are all null. Archives of
    tasks that failed or ran twice are in no table. No pages give no archive. Other columns
    are not written.
    """
    rows = pages.select(F.col(key).alias("page"), F.col(url).cast("string").alias("url"),
                        F.col(html).cast("string").alias("html"))
    content = F.coalesce(F.col("html"), F.lit(""))
    digest = F.unhex(F.sha1(content.cast("binary")))
    repeated = materialise(
        rows.where(F.octet_length(content) >= least_bytes).select(digest.alias("_digest"), "page")
        .groupBy("_digest").agg(F.max("page").alias("to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and to is not null").drop("n"), "payloads")
    side = F.broadcast(repeated) if repeated.count() <= BROADCAST_DIGESTS else repeated
    to = F.when(F.col("page").isNull() | (F.col("page") < F.col("to")), F.col("to"))
    dealt = rows.join(side, digest == F.col("_digest"), "left").select("page", "url", "html", to.alias("to"))
    return materialise(dealt.mapInArrow(_write(folder, train_dictionary(pages, html, key)), ARCHIVES), "archives")


def _open_input(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        path = re.sub("^file:/+", "/", path)
    if "://" not in path:
        return fs.LocalFileSystem().open_input_stream(path)
    system, inside = fs.FileSystem.from_uri(path)
    return system.open_input_stream(inside)


def frames(stream):
    """The decoded frames of an archive one after another; the dictionary is loaded first."""
    buffer = stream.read(READ_BYTES)
    decoder = zstandard.ZstdDecompressor()
    if len(buffer) >= 8 and struct.unpack_from("<I", buffer)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", buffer, 4)[0]
        while len(buffer) < 8 + size:
            more = stream.read(READ_BYTES)
            if not more:
                raise ValueError("The dictionary frame is cut off")
            buffer += more
        held, buffer = buffer[8:8 + size], buffer[8 + size:]
        if held.startswith(FRAME):
            held = zstandard.ZstdDecompressor().decompress(held)
        if struct.unpack_from("<I", held)[0] != DICTIONARY:
            raise ValueError("The leading frame holds no dictionary")
        decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
    while True:
        buffer = buffer or stream.read(READ_BYTES)
        if not buffer:
            return
        frame, parts = decoder.decompressobj(), []
        while True:
            parts.append(frame.decompress(buffer))
            if frame.eof:
                buffer = frame.unused_data
                break
            buffer = stream.read(READ_BYTES)
            if not buffer:
                raise ValueError("The last frame is cut off")
        yield b"".join(parts)


def parse_record(data: bytes) -> dict:
    """A record's fields, with `error` where headers, lengths or digests are not right."""
    out = dict.fromkeys(c.split()[0] for c in RECORDS.split(", "))
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    out.update(record_type=fields.get("warc-type"), record_id=fields.get("warc-record-id", "").strip("<>"),
               date=fields.get("warc-date"), target_uri=fields.get("warc-target-uri"))
    if "warc-refers-to" in fields:
        out["refers_to"] = fields["warc-refers-to"].strip("<>")
    missing = [k for k in REQUIRED if not fields.get(k.lower())]
    if not gap or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        out["error"] = "no WARC version line"
    elif missing:
        out["error"] = "missing " + ", ".join(missing)
    elif not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        out["error"] = "the content has another length than its header says"
    else:
        block = rest[:-4]
        if fields.get("warc-block-digest", "sha1:" + _digest(block)) != "sha1:" + _digest(block):
            out["error"] = "the block has another digest"
        elif out["record_type"] in ("response", "revisit"):
            http, gap, payload = block.partition(b"\r\n\r\n")
            said = re.search(rb"(?im)^content-length:\s*(\d+)", http)
            digest = fields.get("warc-payload-digest", "")
            if not gap or not said:
                out["error"] = "no HTTP header with a length"
            elif out["record_type"] == "response" and (len(payload) != int(said[1]) or digest != "sha1:" + _digest(payload)):
                out["error"] = "the payload has another length or digest"
            elif out["record_type"] == "revisit" and (payload or not out["refers_to"] or fields.get("warc-profile") != PROFILE):
                out["error"] = "a revisit without a reference, or with a payload"
            else:
                out.update(payload_bytes=int(said[1]), payload_digest=digest.removeprefix("sha1:"),
                           payload=payload if out["record_type"] == "response" else None)
    return out


def read_archives(archives: DataFrame, payload: bool = True) -> DataFrame:
    """`RECORDS` of all archives in the table, one per frame; without `payload` that is null.

    A record that is not right has its `error` set. An archive whose framing is broken
    gives the records before the break and one row with the error.
    """
    names = [c.split()[0] for c in RECORDS.split(", ")]
    schema = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string())
                        for n in names])

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with _open_input(path) as stream:
                    decoded = frames(stream)
                    while True:
                        try:
                            data = next(decoded)
                        except StopIteration:
                            break
                        except (ValueError, zstandard.ZstdError) as error:
                            rows.append(dict.fromkeys(names) | {"error": f"{path}: {error}"})
                            break
                        record = parse_record(data)
                        if not payload:
                            record["payload"] = None
                        rows.append(record)
                        size += len(record["payload"] or b"")
                        if size > 4 << 20 or len(rows) >= 5_000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = max(1, archives.count())
    return archives.select("path").repartition(files).mapInArrow(run, RECORDS)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    archives = write_archives(table(spark, sf_dir, "pages"), shared_folder(spark, "warc"))
    records = read_archives(archives, payload=False).where(
        F.coalesce("record_type", F.lit("")) != "warcinfo")

    def page(name):
        return F.expr(f"try_cast(substring({name}, {len(ID) + 1}) as bigint)")

    bad = F.raise_error(F.concat(F.lit("Record not right: "), F.coalesce("error", F.lit(""))))
    return records.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest",
        F.when(F.col("error").isNull(), F.col("record_type")).otherwise(bad.cast("string")).alias("record_type"),
        page("refers_to").alias("refers_to"))


QUERIES = {"op6_warc": op6_warc}
