"""WARC archives compressed with an embedded Zstandard dictionary.

Every task writes one archive, and there are as many tasks as the payloads' bytes ask for,
so archives are of bounded size. An archive's first frame is a skippable frame (magic
0x184D2A5D) that holds a dictionary built from the first records of the archive; each
record after it is a Zstandard frame of its own, compressed with that dictionary.

Spark's own text writer stores the frames, one per row, so archives go to any file
system that Spark can write and are committed like any other output. It puts a line
separator after each row; the separator used here is an empty skippable frame, which
every Zstandard reader passes over.
"""

from __future__ import annotations

import base64
import io
import re
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellata.llm.common import col, joined, numbered, ship_code, stored, text_of, with_row

#: An empty skippable frame: magic 0x184D2A50, length 0. All its bytes are ASCII.
SEPARATOR = struct.pack("<II", 0x184D2A50, 0).decode()
DICTIONARY_MAGIC = 0x184D2A5D
#: Payloads under this many bytes are always stored.
LEAST_REVISIT = 1000
#: Bytes of records from which a dictionary is built (held in memory meanwhile), and
#: its largest size.
SAMPLE_BYTES, DICTIONARY_BYTES = 4 << 20, 64 << 10
#: Bytes of payloads in an archive, about (pages are dealt evenly by their row numbers); and
#: those that are worth a task of their own while there are fewer tasks than the session's.
ARCHIVE_BYTES, TASK_BYTES = 128 << 20, 16 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- records ---------------------------------------------------------------------

def _uri(url: str | None) -> str:
    """``url`` fit for a header line: blanks and control characters escaped."""
    if not url:
        return "urn:stellata:no-uri"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_id(page_id, row: int) -> str:
    return f"<urn:stellata:page:{'' if page_id is None else page_id}:{row}>"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def response(page_id, row: int, url, payload: bytes, sha1: str, date: str) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    return _record([("WARC-Type", "response"), ("WARC-Record-ID", record_id(page_id, row)),
                    ("WARC-Date", date), ("WARC-Target-URI", _uri(url)),
                    ("WARC-Payload-Digest", f"sha1:{digest}"),
                    ("Content-Type", "application/http; msgtype=response")], http + payload)


def revisit(page_id, row: int, url, sha1: str, refers_to: str, date: str) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    return _record([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(page_id, row)),
                    ("WARC-Date", date), ("WARC-Target-URI", _uri(url)),
                    ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Profile", REVISIT_PROFILE),
                    ("WARC-Refers-To", refers_to)], b"")


# --- archives --------------------------------------------------------------------

def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """A trained dictionary; too few records to train on become its raw content."""
    try:
        return zstandard.train_dictionary(size, records)
    except zstandard.ZstdError:
        raw = b"".join(records)[-size:]
        return zstandard.ZstdCompressionDict(raw.ljust(8, b"\0"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def frames(records, level: int = 3, sample: int = SAMPLE_BYTES):
    """The frames of one archive: the dictionary, then one frame per record. Only the
    records of the sample are held; no records, no frames."""
    held, n, compressor = [], 0, None

    def begin():
        made = build_dictionary(held)
        data = made.as_bytes()
        zipper = zstandard.ZstdCompressor(level=level, dict_data=made, write_checksum=True)
        return struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data, zipper

    for record in records:
        if compressor is not None:
            yield compressor.compress(record)
            continue
        held.append(record)
        n += len(record)
        if n >= sample:
            head, compressor = begin()
            yield head
            yield from map(compressor.compress, held)
            held = []
    if compressor is None and held:
        head, compressor = begin()
        yield head
        yield from map(compressor.compress, held)


def records(archive):
    """(headers, block) of each record of an archive's bytes, decompressed as a stream.
    Header names are in lower case; an empty archive has no records."""
    view = memoryview(archive)
    dictionary = None
    if len(view) >= 8:
        magic, size = struct.unpack("<II", view[:8])
        if magic == DICTIONARY_MAGIC:
            dictionary = zstandard.ZstdCompressionDict(bytes(view[8:8 + size]))
            view = view[8 + size:]
    unzip = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    stream = io.BufferedReader(unzip.stream_reader(view, read_across_frames=True), 1 << 16)
    while True:
        line = stream.readline()
        if not line:
            return
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record ends early")
        yield headers, block


# --- on Spark --------------------------------------------------------------------

def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          date: str = "1970-01-01T00:00:00Z", least: int = LEAST_REVISIT, level: int = 3,
          archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one record per row of ``pages`` to archives in the folder ``path``.

    Of rows with equal payloads of at least ``least`` bytes, the one with the largest id
    (then the last as the table is read) is stored as a response and the others revisit
    it; smaller payloads are all responses. Payloads are equal when their lengths, SHA-1 and
    SHA-256 are. A null payload is empty, a null url gets a placeholder, and null
    ids are the smallest. Repeated rows are records of their own. An empty table
    writes an empty folder; other columns are ignored. Any plan may stand behind
    ``pages``: rows are numbered once. A page of more than ``archive_bytes`` has a larger archive.
    """
    spark = pages.sparkSession
    pages, row_col = with_row(pages)
    rows = numbered(pages, row_col, id=col(id_col), url=col(url_col).cast("string"), payload=text_of(payload_col))
    data = F.encode("payload", "UTF-8")
    facts = stored(rows.select("row", "id", F.octet_length("payload").alias("n"), F.sha1(data).alias("sha1"),
                               F.unhex(F.sha2(data, 256)).alias("sha256")), "payloads")
    same = ["n", "sha1", "sha256"]
    big = facts.where(F.col("n") >= least)
    copies = stored(big.groupBy(*same).agg(F.count("*").alias("copies"), F.max(F.struct("id", "row")).alias("of"))
                    .where("copies > 1"), "copies")
    again = (joined(big.join(copies, same, "left_semi"), copies, same, "copies", inner=True)
             .where("of.row <> row").select("row", F.col("of.id").alias("of_id"), F.col("of.row").alias("of_row")))
    total = facts.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // archive_bytes),
                min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES)))
    ready = (rows.withColumn("sha1", F.sha1(data)).withColumn("payload", data).repartition(parts, "row")
             .join(again.repartition(parts, "row"), "row", "left")
             .select("row", "id", "url", "sha1", F.when(F.col("of_row").isNull(), F.col("payload")).alias("payload"),
                     "of_id", "of_row"))

    def run(batches):
        def made():
            for batch in batches:
                for r in zip(*(batch.column(c) for c in ("row", "id", "url", "sha1", "payload", "of_id", "of_row"))):
                    row, key, url, sha1, payload, of_id, of_row = (x.as_py() for x in r)
                    if of_row is None:
                        yield response(key, row, url, payload, sha1, date)
                    else:
                        yield revisit(key, row, url, sha1, record_id(of_id, of_row), date)

        held, size = [], 0
        for frame in frames(made(), level):
            held.append(frame)
            size += len(frame)
            if size >= 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["frame"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["frame"])

    # a binary value cast to string keeps its bytes, and the text writer writes them so
    (ready.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", SEPARATOR).text(path))


def read(spark, path: str) -> DataFrame:
    """The records of the archives in ``path``: record_id, record_type, target_uri, date,
    payload_digest (hex SHA-1 as the header says), refers_to (a record id) and payload
    (of a response, without the HTTP head)."""
    ship_code(spark)
    names = ("warc-record-id", "warc-type", "warc-target-uri", "warc-date", "warc-payload-digest", "warc-refers-to")
    columns = ["record_id", "record_type", "target_uri", "date", "payload_digest", "refers_to"]

    def run(batches):
        def batch_of(held):
            return pa.RecordBatch.from_arrays(
                [pa.array([h[i] for h in held], pa.string()) for i in range(6)]
                + [pa.array([h[6] for h in held], pa.binary())], names=[*columns, "payload"])

        for batch in batches:
            for archive in batch.column("content"):
                held, size = [], 0
                for headers, block in records(archive.as_buffer()):
                    found = [headers.get(n) for n in names]
                    if found[4]:
                        found[4] = base64.b32decode(found[4].removeprefix("sha1:")).hex()
                    payload = block.partition(b"\r\n\r\n")[2] if found[1] == "response" else None
                    held.append((*found, payload))
                    size += len(block)
                    if size >= 1 << 23:
                        yield batch_of(held)
                        held, size = [], 0
                if held:
                    yield batch_of(held)

    return (spark.read.format("binaryFile").load(path).select("content")
            .mapInArrow(run, ", ".join(f"{c} string" for c in columns) + ", payload binary"))


def inventory(stored_records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """What the archives hold, per page: page_id, payload_bytes, payload_digest,
    record_type and refers_to (a page id).

    Responses are measured on the payload that was read back; a revisit has the length of
    the response that it refers to, and the digest of its header."""
    key = lambda c: F.regexp_extract(c, r"^<urn:stellata:page:(.*):[0-9]+>$", 1)
    id_of = lambda c: F.when(key(c) != "", key(c)).cast(id_type)
    # read once: what is kept is a few numbers per record
    facts = stored(stored_records.select(
        "record_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.col("record_type") == "response", F.sha1("payload")).otherwise(F.col("payload_digest"))
        .alias("payload_digest")), "inventory")
    target = facts.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("of_bytes"))
    return facts.join(target, "refers_to", "left").select(
        id_of("record_id").alias("page_id"), F.coalesce("payload_bytes", "of_bytes").alias("payload_bytes"),
        "payload_digest", "record_type", id_of("refers_to").alias("refers_to"))
