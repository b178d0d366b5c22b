r"""WARC archives, compressed record by record with a Zstandard dictionary that leads each file.

An archive is a Spark text output without lines: every row is one Zstandard frame, and the "line separator" is an empty
skippable frame, which decoders pass over. So archives are written by Spark's own committer to any store it reaches, a
lost task leaves nothing behind, and each file is a plain ``.warc.zst``: a skippable frame with the dictionary, then a
warcinfo record, then one frame per record.

The dictionary is trained on a bounded sample of the records to be archived: of the ``sample_records`` smallest draws (a
hash of page id and URL), up to ``sample_bytes`` each, and several such pieces of large records where records are few.
Records are archived whole. Rows are counted first, so a threshold on the draw lets about that many through; only their
draws reach the driver, then the pieces of those chosen, whatever the number of tasks. With too few samples to train on,
archives have no dictionary frame.

An archive holds at most ``archive_rows`` rows of about ``row_bytes``, each some whole frames; then its task begins the next
one, which the same two frames lead.

Equal payloads of at least ``min_bytes`` are stored once: the page with the largest id is the response, the others are
revisit records that name it. The search for equal payloads groups digests only; pages then meet their digest's response
in a join with two plain sides, of which adaptive execution splits a payload that very many pages share.

Defined cases: NULL html is an empty payload, NULL url an empty target; a NULL page id counts as smallest and is read
back as NULL; rows equal in id and payload are all responses if they have the largest id; an empty table gives no files
and no rows. Columns besides page_id, url and html are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import durable

SKIPPABLE = 0x184D2A50  # up to ...5F
DICTIONARY_FRAME = 0x184D2A5D
PIECES = 16  # of one record in the sample
TOP = (1 << 63) - 1
SEPARATOR = struct.pack("<II", SKIPPABLE, 0)  # an empty skippable frame; plain ASCII
DATE = "2026-01-01T00:00:00Z"  # pages carry no date
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Settings:
    min_bytes: int = 0
    dictionary_bytes: int = 1 << 16
    sample_records: int = 1_000
    sample_bytes: int = 1 << 15
    level: int = 6
    row_bytes: int = 1 << 20
    archive_rows: int = 96


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _block(headers: list[tuple[str, str]], body: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One response or revisit record. A revisit has the HTTP header of its page, which tells the payload's length."""
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _id(page_id)),
               ("WARC-Target-URI", target), ("WARC-Date", DATE),
               ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)),
               ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _id(refers_to))]
    return _block(headers, http if revisit else http + payload)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return headers, rest[:int(headers["content-length"])]


def train_dictionary(records: list[bytes], size: int) -> bytes:
    """Empty if there is too little to train on."""
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes, level: int):
    if not dictionary:
        return zstandard.ZstdCompressor(level=level)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=data)


def _write_partition(dictionary: bytes, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = _compressor(dictionary, settings.level).compress
        lead = struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary if dictionary else b""
        lead += compress(_block([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:archive:info>"), ("WARC-Date", DATE),
                                 ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        frames: list[bytes] = []
        held = rows = 0

        def given() -> pa.RecordBatch:
            nonlocal held, rows
            # Spark begins a new file after every ``archive_rows`` rows of a task.
            row = (lead if rows % settings.archive_rows == 0 else b"") + b"".join(frames)
            frames.clear()
            held, rows = 0, rows + 1
            return pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], names=["frame"])

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for row in batch.slice(at, 500).to_pylist():
                    frames.append(compress(record(row["page_id"], row["url"], row["payload"], row["refers_to"],
                                                  row["revisit"])))
                    held += len(frames[-1])
                    if held >= settings.row_bytes:
                        yield given()
        if frames:
            yield given()
    return run


def payload(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def plan(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to, revisit) for every page."""
    rows = pages.select("page_id", "url", payload(F.col("html")).alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    shared = durable(rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha")
                     .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return (rows.join(shared, "sha", "left")
            .select("page_id", "url", "payload", F.when(revisit, F.col("largest")).alias("refers_to"),
                    revisit.alias("revisit")))


def sample_dictionary(pages: DataFrame, settings: Settings = Settings()) -> bytes:
    """A dictionary from at most ``sample_records`` pieces of records, of at most ``sample_bytes`` each."""
    wanted, size = settings.sample_records, settings.sample_bytes
    drawn = (pages.select("page_id", "url", F.col("html").cast("binary").alias("payload"))
             .where(F.octet_length("payload") > 0)
             .withColumn("draw", F.shiftrightunsigned(F.xxhash64("page_id", "url"), 1)))
    rows = drawn.count() if wanted else 0
    share, chosen = (wanted + 6 * wanted ** 0.5 + 10) / max(rows, 1), []
    while rows and wanted:
        # Narrow rows, one per draw: as many as are wanted and a few more. Only where rows repeat are they too few at first.
        bound = drawn.where(F.col("draw") < F.lit(int(min(share, 1.0) * TOP))) if share < 1.0 else drawn
        if share < 1.0:
            chosen = [r["draw"] for r in bound.select("draw").distinct().collect()]
        else:
            chosen = [r["draw"] for r in bound.select("draw").distinct().orderBy("draw").limit(wanted).collect()]
        if len(chosen) >= wanted or share >= 1.0:
            break
        share *= 4
    chosen = sorted(chosen)[:wanted]
    if not chosen:
        return b""
    each = min(PIECES, -(-wanted // len(chosen)))
    head = F.struct("page_id", "url", F.substring("payload", 1, each * size).alias("head"))
    some = (drawn.where(F.col("draw").isin(chosen)).groupBy("draw").agg(F.min_by(head, F.xxhash64("payload")).alias("r"))
            .orderBy("draw").collect())
    pieces = [(at, r["draw"], record(r["r"]["page_id"], r["r"]["url"], bytes(r["r"]["head"][at:at + size]), None, False))
              for r in some for at in range(0, len(r["r"]["head"]), size)]
    pieces.sort(key=lambda p: p[:2])  # the first piece of every record before further ones
    return train_dictionary([p for _, _, p in pieces[:wanted]], settings.dictionary_bytes)


def write(pages: DataFrame, path: str, settings: Settings = Settings()) -> None:
    """Archive pages (page_id, url, html) under ``path``; each task's rows become one file, or more if they are many."""
    frames = plan(pages, settings.min_bytes).mapInArrow(
        _write_partition(sample_dictionary(pages, settings), settings), "frame binary")
    (frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR.decode())
     .option("maxRecordsPerFile", settings.archive_rows).text(path))


def records(content: bytes) -> Iterator[bytes]:
    """The decompressed records of one archive, in order."""
    decompressor, at, view = zstandard.ZstdDecompressor(), 0, memoryview(content)
    while at < len(content):
        magic, length = struct.unpack_from("<II", content, at)
        if magic & 0xFFFFFFF0 == SKIPPABLE:
            if magic == DICTIONARY_FRAME and length:
                dictionary = zstandard.ZstdCompressionDict(content[at + 8:at + 8 + length])
                decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
            at += 8 + length
            continue
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            piece = view[at:at + 65536]
            parts.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        yield b"".join(parts)


def _number(uri: str) -> int | None:
    digits = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


READ = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "intact boolean")


def _read_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in READ.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
    rows: list[tuple] = []

    def given() -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(names)
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        for content in batch.column(0):
            for raw in records(content.as_py()):
                headers, block = parse(raw)
                if headers["warc-type"] == "warcinfo":
                    continue
                http, _, body = block.partition(b"\r\n\r\n")
                length = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
                digest, revisit = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"] == "revisit"
                rows.append((_number(headers["warc-record-id"]), headers["warc-target-uri"], length, digest,
                             headers["warc-type"], _number(headers["warc-refers-to"]) if revisit else None,
                             revisit or (len(body) == length and payload_digest(body) == digest)))
                if len(rows) >= 20_000:
                    yield given()
    yield given()


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``; ``intact``: the stored payload has its digest and length."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read_partition, READ)
